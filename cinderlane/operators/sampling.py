"""Deterministic sampling and selection: hash-ordered quotas, rank bins, covers, targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(seed: str, key: str) -> Column:
    return F.sha2(F.concat(F.lit(seed + ":"), F.col(key).cast("string")).cast("binary"), 256)


def quota_sample(rows: DataFrame, key: str, stratum: str, quota: int, seed: str) -> DataFrame:
    """`quota` rows of each stratum, first in hash order."""
    w = Window.partitionBy(stratum).orderBy(hash_order(seed, key), key)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= quota)


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with their place from 0 in a total order. Places come from the counts of the partitions of one range
    exchange, which is written first where a checkpoint folder is set, so that both readers see the same partitions."""
    parts = rows.repartitionByRange(*[F.col(c) for c in order]).withColumn("_p", F.spark_partition_id())
    if rows.sparkSession.sparkContext.getCheckpointDir():
        parts = parts.checkpoint()
    parts = parts.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return parts.join(F.broadcast(sizes.drop("_n")), "_p").withColumn(name, F.col("_before") + F.col("_r") - 1).drop("_p", "_r", "_before")


def rank_bins(rows: DataFrame, value: str, key: str, bins: int, name: str) -> DataFrame:
    """Equal bins by rank, 0 .. bins-1."""
    n = rows.count()
    out = ranked(rows, [value, key], "_rank")
    return out.withColumn(name, F.least(F.lit(bins - 1), F.floor(F.col("_rank") * bins / F.lit(max(n, 1)))).cast("int")).drop("_rank")


def stratified_draw(rows: DataFrame, values: list[str], key: str, bins: int, n: int, seed: str) -> DataFrame:
    """`n` rows drawn from the grid of rank bins of the values, round after round: first in hash order of each cell."""
    out = rows
    for i, v in enumerate(values):
        out = rank_bins(out, v, key, bins, f"bin{i}")
    cell = [f"bin{i}" for i in range(len(values))]
    out = out.withColumn("round", F.row_number().over(Window.partitionBy(*cell).orderBy(hash_order(seed, key), key)))
    return out.orderBy("round", *cell).limit(n)


def ranked_scan(rows: DataFrame, key: str, wanted: Column, n: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """(the first n rows in hash order that are wanted, counts of wanted and other rows)."""
    ok = F.coalesce(wanted, F.lit(False))
    counts = rows.groupBy(ok.alias("wanted")).agg(F.count(F.lit(1)).alias("n"))
    return rows.filter(ok).orderBy(hash_order(seed, key), key).limit(n), counts


def diverse(rows: DataFrame, key: str, tags: str, cards: str, n: int, share: float = 0.08) -> list:
    """Keys of a greedy diversity sample of n rows: each round takes the row that adds most, sum of 1 / (1 + times seen)
    over its tags plus `share` of the same over its cards, ties to the larger key. n is small: a round is one pass, and
    only the counts of what was seen, bounded by the n rows taken, go out."""
    seen: tuple[dict, dict] = ({}, {})
    chosen: list = []

    def worth(column: str, counts: dict) -> Column:
        times = F.create_map(*[F.lit(x) for kv in counts.items() for x in kv]) if counts else None
        one = lambda t: F.lit(1.0) if times is None else 1.0 / (1.0 + F.coalesce(times[t], F.lit(0)))
        return F.aggregate(F.coalesce(F.transform(F.array_distinct(column), one), F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + x)

    for _ in range(n):
        left = rows.filter(~F.col(key).isin(chosen)) if chosen else rows
        best = left.withColumn("_w", worth(tags, seen[0]) + share * worth(cards, seen[1])).orderBy(F.desc("_w"), F.desc(key)).select(key, tags, cards).first()
        if best is None:
            break
        chosen.append(best[0])
        for counts, found in zip(seen, best[1:], strict=True):
            for x in set(found or []):
                counts[x] = counts.get(x, 0) + 1
    return chosen


def cover(rows: DataFrame, target: str, order: str) -> DataFrame:
    """Rows that are the first to bring some target, with how many they bring."""
    first = rows.groupBy(target).agg(F.min(order).alias(order))
    return first.groupBy(order).agg(F.count(F.lit(1)).alias("new_targets"))


def newest_eligible(rows: DataFrame, key: str, order: str, eligible: Column, value: str) -> DataFrame:
    """(key, status, chosen): the newest eligible row's value of each key.

    unavailable: none is eligible; unique_eligible: one, whatever its order. Of several, an unknown (null or negative)
    order of any leaves them ambiguous_creation_order_unknown, a tie ambiguous_latest_tie; else inferred_newest_eligible.
    """
    ok = F.coalesce(eligible, F.lit(False))
    known = F.col(order).isNotNull() & (F.col(order) >= 0)
    top = F.max(F.when(ok, F.col(order))).over(Window.partitionBy(key))
    rows = rows.withColumn("_ok", ok).withColumn("_top", top)
    newest = F.col("_ok") & (F.col(order) == F.col("_top"))
    found = rows.groupBy(key).agg(
        F.count_if("_ok").alias("n"), F.count_if(F.col("_ok") & ~known).alias("unknown"), F.count_if(newest).alias("ties"), F.min(F.when(F.col("_ok"), F.col(value))).alias("only"), F.min(F.when(newest, F.col(value))).alias("last")
    )
    status = F.when(F.col("n") == 0, "unavailable").when(F.col("n") == 1, "unique_eligible").when(F.col("unknown") > 0, "ambiguous_creation_order_unknown")
    status = status.when(F.col("ties") > 1, "ambiguous_latest_tie").otherwise("inferred_newest_eligible")
    chosen = F.when(F.col("status") == "unique_eligible", F.col("only")).when(F.col("status") == "inferred_newest_eligible", F.col("last"))
    return found.withColumn("status", status).select(key, "status", chosen.alias("chosen"))


def fill_to(base: DataFrame, live: DataFrame, key: str, order: str, target: int, strict: bool = False) -> DataFrame:
    """base, then live rows not in it in order until `target` rows; the rest is overflow (part column).

    strict raises if base is larger than the target or both together can't reach it.
    """
    have = base.select(key).distinct()
    fresh = ranked(live.join(have, key, "left_anti").groupBy(key).agg(F.min(order).alias(order)), [order, key], "_rank")
    room = target - have.count()
    if strict and (room < 0 or fresh.count() < room):
        raise ValueError("base exceeds the target" if room < 0 else "too few rows for the target")
    part = F.when(F.col("_rank") < max(0, room), "live").otherwise("overflow").alias("part")
    return have.select(key, F.lit("base").alias("part")).unionByName(fresh.select(key, part))
