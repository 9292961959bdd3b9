"""Work ledgers: queues, resumption, overlapping batches, coverage gates, receipts and unambiguous references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_queues(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows once for each queue whose rule holds, with a column `queue` to partition a sink by; none: not at all."""
    names = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return rows.withColumn("queue", F.explode(names))


def unfinished(wanted: DataFrame, ledger: DataFrame, key: list[str], done: Column) -> DataFrame:
    """Wanted rows whose key has no finished row in the ledger."""
    return wanted.join(ledger.filter(done).select(*key), key, "left_anti")


def merged_batches(rows: DataFrame, key: list[str], batch: str) -> DataFrame:
    """Overlapping batches as one: of rows with the same key, that of the earliest batch stays."""
    w = Window.partitionBy(*key).orderBy(batch)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def attach(states: DataFrame, events: DataFrame, key: list[str], tick: str, offset: int, value: str) -> DataFrame:
    """Each state with the event `offset` ticks before it, if there is one; n_events over 1 marks a collision."""
    at = events.select(*key, (F.col(tick) + offset).alias(tick), F.col(value).alias("_v"))
    one = at.groupBy(*key, tick).agg(F.count(F.lit(1)).alias("n_events"), F.min("_v").alias("event"))
    out = states.join(one, [*key, tick], "left")
    return out.withColumn("n_events", F.coalesce("n_events", F.lit(0))).withColumn("event", F.when(F.col("n_events") == 1, F.col("event")))


def candidates(events: DataFrame, entities: DataFrame, key: list[str], entity: str, allowed: bool = False) -> DataFrame:
    """Events with the status of their candidates and, where there is just one, that entity as `chosen`.

    Entities are counted, not their names. unique: one; branch_required: several; else no_legal_matching_entity where
    the entities were narrowed to allowed ones, no_legal_ability_entity where not.
    """
    known = entities.filter(F.col(entity).isNotNull()).groupBy(*key).agg(F.countDistinct(entity).alias("n_entities"), F.min(entity).alias("chosen"))
    n = F.coalesce("n_entities", F.lit(0))
    none = "no_legal_matching_entity" if allowed else "no_legal_ability_entity"
    out = events.join(known, key, "left").withColumn("status", F.when(n == 0, none).when(n == 1, "unique").otherwise("branch_required"))
    return out.withColumn("chosen", F.when(n == 1, F.col("chosen"))).drop("n_entities")


def exceeding(part: DataFrame, whole: DataFrame, token: str) -> DataFrame:
    """Tokens that the part counts more often than the whole, or that the whole lacks."""
    a = part.groupBy(token).agg(F.count(F.lit(1)).alias("n_part"))
    b = whole.groupBy(token).agg(F.count(F.lit(1)).alias("n_whole"))
    return a.join(b, token, "left").withColumn("n_whole", F.coalesce("n_whole", F.lit(0))).filter("n_part > n_whole")


def coverage_gate(rows: DataFrame, stratum: str, ok: Column, least: int, rate: float) -> DataFrame:
    """Counts of each stratum and its verdict: too_few, low_rate or pass."""
    out = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(ok).alias("successes"))
    low = F.col("successes") < F.col("attempts") * F.lit(rate)
    return out.withColumn("verdict", F.when(F.col("successes") < least, "too_few").when(low, "low_rate").otherwise("pass"))


def lane_order(shards: DataFrame, lane: list[str], first: str, starts: str) -> DataFrame:
    """Shards of each lane in order of their first tick; lanes that begin in the middle of an episode are left out."""
    w = Window.partitionBy(*lane).orderBy(first)
    out = shards.withColumn("place", F.row_number().over(w)).withColumn("_begins", F.first(starts).over(w))
    return out.filter("_begins").drop("_begins")


def references(attributes: DataFrame, names: DataFrame, value: str, name: str, node: str) -> DataFrame:
    """Attributes whose value names exactly one node, with that node as target."""
    one = names.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias(value)).agg(F.count(F.lit(1)).alias("_n"), F.min(node).alias("target")).filter("_n = 1")
    return attributes.join(one.drop("_n"), value)


def receipt(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """A sha256 for each row over its fields as text, null as a lone backslash-N; recomputing it verifies the row."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("\\N")) for f in [*key, *fields]])
    return rows.withColumn("receipt", F.sha2(text, 256))
