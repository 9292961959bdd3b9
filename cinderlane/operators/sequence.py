"""Window and sequence operators over integer clocks: all partition by a key and order by a tick or ordinal."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(events: DataFrame, key: str, tick: str, kind: str, order: str) -> DataFrame:
    """One row for each tick of a key: what came strictly before it, how long ago, and how much.

    Events of one tick are joint: none of them sees the others. The first interval has no start and is null.
    """
    joint = events.groupBy(key, tick).agg(
        F.count(F.lit(1)).alias("n"), F.min_by(kind, order).alias("first_kind"), F.max_by(kind, order).alias("last_kind"), F.min(order).alias("anchor")
    )
    w = Window.partitionBy(key).orderBy(tick)
    return joint.select(
        key, tick, "n", "first_kind", F.lag("last_kind").over(w).alias("previous_kind"), (F.col(tick) - F.lag(tick).over(w)).alias("interval"),
        F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("n_before"), F.lead(tick).over(w).isNull().alias("censored"),
    )


def rotation(plays: DataFrame, key: list[str], card: str, order: list[str], hand: int = 4) -> DataFrame:
    """For each play of a deck of 2 * hand cards drawn in rotation: is it possible, and which card comes next?

    A card can't come back until `hand` other plays have passed. From play `hand` on, the card next in line is the one
    played `hand` plays ago, and the hand is the deck without the last `hand` plays.
    """
    line = Window.partitionBy(*key).orderBy(*order)
    numbered = plays.withColumn("n", F.row_number().over(line) - 1)
    own = Window.partitionBy(*key, card).orderBy("n")
    out = numbered.withColumn("gap", F.col("n") - F.lag("n").over(own))
    recent = Window.partitionBy(*key).orderBy("n").rowsBetween(-hand, -1)
    return out.select(
        *key, "n", card, "gap", (F.coalesce(F.col("gap"), F.lit(hand + 1)) > hand).alias("possible"),
        F.lag(card, hand).over(Window.partitionBy(*key).orderBy("n")).alias("next_card"),
        F.when(F.col("n") >= hand, F.array_sort(F.array_distinct(F.collect_list(card).over(recent)))).alias("away"),
    )


def first_impossible(rotated: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key: is its whole sequence possible, and where does it first fail?"""
    return rotated.groupBy(*key).agg(F.bool_and("possible").alias("valid"), F.min(F.when(~F.col("possible"), F.col("n"))).alias("failing"), F.count(F.lit(1)).alias("plays"))


def revealed(events: DataFrame, key: str, tick: str, item: str, most: int = 8) -> DataFrame:
    """The first `most` different items of each key in the order first seen (ties by item), with their first ticks."""
    seen = events.groupBy(key, item).agg(F.min(tick).alias("seen"))
    order = Window.partitionBy(key).orderBy("seen", item)
    return seen.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def burn_in_windows(rows: DataFrame, key: str, order: list[str], length: int, burn: int) -> DataFrame:
    """Windows of `length` target rows, each preceded by up to `burn` rows of the window before (is_burn)."""
    n = rows.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
    own = F.floor(F.col("n") / length).cast("int")
    both = F.filter(F.array(own, F.when(F.col("n") % length >= length - burn, own + 1)), lambda x: x.isNotNull())
    out = n.withColumn("window", F.explode(both)).withColumn("is_burn", F.floor(F.col("n") / length) < F.col("window"))
    targets = F.sum((~F.col("is_burn")).cast("int")).over(Window.partitionBy(key, "window"))
    return out.withColumn("targets", targets).filter("targets > 0").drop("targets")


def chunks(rows: DataFrame, key: str, tick: str, order: list[str], gap: int, size: int) -> DataFrame:
    """Sessions broken where the tick jumps by more than `gap`, cut into chunks of `size` rows."""
    w = Window.partitionBy(key).orderBy(*order)
    broken = F.coalesce(F.col(tick) - F.lag(tick).over(w) > gap, F.lit(True)).cast("int")
    out = rows.withColumn("broken", broken).withColumn("session", F.sum("broken").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = F.row_number().over(Window.partitionBy(key, "session").orderBy(*order))
    return out.withColumn("chunk", F.floor((inside - 1) / size).cast("int")).drop("broken")


def rolling_sums(rows: DataFrame, key: str, tick: str, amount: str, spans: dict[str, int]) -> DataFrame:
    """Sums of amount over the last `span` ticks up to and including each row's tick, and over the key's life so far."""
    w = Window.partitionBy(key).orderBy(tick)
    out = rows
    for name, span in spans.items():
        out = out.withColumn(name, F.sum(amount).over(w.rangeBetween(-(span - 1), 0)))
    return out.withColumn("lifetime", F.sum(amount).over(w.rangeBetween(Window.unboundedPreceding, 0)))


def changes(rows: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """Change data: spawned or updated rows of each key, and a bit for each field that differs from the row before."""
    w = Window.partitionBy(key).orderBy(*order)
    first = F.row_number().over(w) == 1
    mask = F.lit(0)
    for i, f in enumerate(fields):
        mask = mask + F.when(first | ~F.col(f).eqNullSafe(F.lag(f).over(w)), 1 << i).otherwise(0)
    out = rows.withColumn("n", F.row_number().over(w)).withColumn("mask", mask)
    return out.withColumn("change", F.when(F.col("n") == 1, "spawned").when(F.col("mask") > 0, "updated").otherwise("same"))


def rebuilt(deltas: DataFrame, key: str, fields: list[str], every: int) -> DataFrame:
    """Fields of every row from deltas: an anchor row in each `every` holds all of them, others what their mask names."""
    w = Window.partitionBy(key, "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    out = deltas.withColumn("block", F.floor((F.col("n") - 1) / every))
    for i, f in enumerate(fields):
        told = ((F.col("n") - 1) % every == 0) | (F.col("mask").bitwiseAND(F.lit(1 << i)) != 0)
        # a told null must not be skipped, so the value travels inside a struct
        out = out.withColumn(f"re_{f}", F.last(F.when(told, F.struct(F.col(f).alias("v"))), True).over(w)["v"])
    return out.drop("block")


def jumps(rows: DataFrame, key: list[str], order: list[str], tick: str) -> DataFrame:
    """Ticks that repeat (0), jump (over 1) or go back (under 0) against the row before."""
    step = F.col(tick) - F.lag(tick).over(Window.partitionBy(*key).orderBy(*order))
    kind = F.when(step == 0, "repeat").when(step < 0, "back").when(step > 1, "gap").otherwise("next")
    return rows.withColumn("step", step).withColumn("kind", kind)


def nearest(rows: DataFrame, key: str, tick: str, bearing: Column) -> DataFrame:
    """As-of in both directions: tick of the last bearing row strictly before, and of the first at or after, a row's tick.

    Rows of one tick see each other only in `after`. Both frames grow along their order, so a lane is read once each way.
    """
    own = F.when(bearing, F.col(tick))
    before = Window.partitionBy(key).orderBy(tick).rangeBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(key).orderBy(F.desc(tick)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("before", F.max(own).over(before)).withColumn("after", F.min(own).over(after))


def last_k(rows: DataFrame, key: str, order: list[str], value: str, k: int) -> DataFrame:
    """The k values before each row, oldest first; only k rows are ever held."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-k, -1)
    return rows.withColumn("last", F.collect_list(value).over(w))


def accepted_prefix(rows: DataFrame, key: str, order: list[str], accepted: Column) -> DataFrame:
    """Length of each key's leading run of accepted rows; what isn't known to be accepted ends it."""
    n = rows.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
    return n.groupBy(key).agg(F.coalesce(F.min(F.when(~F.coalesce(accepted, F.lit(False)), F.col("n"))), F.count(F.lit(1))).cast("long").alias("prefix"), F.count(F.lit(1)).alias("n"))


def advantages(steps: DataFrame, key: str, order: str, gamma: float, decay: float, period: float = 5.0) -> DataFrame:
    """(key, order, advantage, ret): generalised advantages along each key's steps, backwards.

    Needs reward, value, next_value, elapsed, terminated, truncated and valid. A step that takes `elapsed` ticks is
    discounted by elapsed / period. It bootstraps from its own next_value unless terminated; what follows counts only
    if the step neither terminated nor was truncated and the next step is there and valid. Steps that aren't valid
    have advantage 0. A lane is one episode and its steps pass one after the other, so a lane is a group.
    """

    def lane(t: pa.Table) -> pa.Table:
        t = t.sort_by(order)
        col = {c: t.column(c).to_numpy() for c in ("reward", "value", "next_value", "elapsed", "terminated", "truncated", "valid")}
        discount, trace = gamma ** (col["elapsed"] / period), decay ** (col["elapsed"] / period)
        delta = col["reward"] + discount * np.where(col["terminated"], 0.0, col["next_value"]) - col["value"]
        goes_on = ~(col["terminated"] | col["truncated"]) & np.r_[col["valid"][1:], False]
        out, running = np.zeros(len(delta)), 0.0
        for i in range(len(delta) - 1, -1, -1):
            running = delta[i] + discount[i] * trace[i] * goes_on[i] * running if col["valid"][i] else 0.0
            out[i] = running
        return pa.table({key: t.column(key), order: t.column(order), "advantage": pa.array(out), "ret": pa.array(out + col["value"])})

    kinds = {f.name: f.dataType.simpleString() for f in steps.schema.fields}
    return steps.groupBy(key).applyInArrow(lane, f"{key} {kinds[key]}, {order} {kinds[order]}, advantage double, ret double")


def shaped_reward(own: Column, enemy: Column, next_own: Column, next_enemy: Column, start: tuple[float, float], elapsed: Column, terminated: Column, outcome: Column, gamma: float, beta: float, period: float = 5.0) -> Column:
    """(terminal, shaping, total) of a transition: the outcome where it ends, and beta times the change of potential
    (own over own start, less enemy over enemy start), discounted by elapsed ticks; nothing follows a terminal."""
    potential = lambda a, b: a / start[0] - b / start[1]
    later = F.when(terminated, 0.0).otherwise(potential(next_own, next_enemy))
    shaping = beta * (F.pow(F.lit(gamma), elapsed / period) * later - potential(own, enemy))
    terminal = F.when(terminated, outcome.cast("double")).otherwise(0.0)
    return F.struct(terminal.alias("terminal"), shaping.alias("shaping"), (terminal + shaping).alias("total"))


def truncation_differences(run: Callable[[DataFrame], DataFrame], rows: DataFrame, tick: str, cutoff: int, keys: list[str], fields: list[str]) -> DataFrame:
    """Rows of run(rows) before the cutoff that differ from run(rows before the cutoff), or are in one of them only.

    An operator that looks only back has none.
    """
    from cinderlane.operators.joins import reconcile

    early = F.col(tick) < cutoff
    return reconcile(run(rows).filter(early), run(rows.filter(early)), keys, fields).filter("status <> 'same'").select(*keys, "status")


def recent_events(states: DataFrame, events: DataFrame, key: str, tick: str, event: str, span: int = 5) -> DataFrame:
    """(key, tick, event) of events in the last `span` ticks up to each state; an event repeated in the input counts
    once. Each event meets at most the states of `span` ticks, by equal ticks, not by a range."""
    once = events.dropDuplicates([key, event]).select(key, F.col(event), F.explode(F.sequence(F.col(tick), F.col(tick) + span - 1)).alias(tick))
    return states.select(key, tick).distinct().join(once, [key, tick])


def deals(plays: DataFrame, layout: DataFrame, key: str, card: str, order: str, hand: int = 4) -> DataFrame:
    """(key, possible, failing): do a key's plays fit its observed starting hand and queue?

    layout has (key, card, place): places 0 .. hand-1 are the hand, then the queue in order. A card of the hand can be
    played at once, one at queue place q after q + 1 plays, and a played card again after `hand` others. failing is the
    number of the first play that doesn't fit; a card that the layout lacks never does.
    """
    n = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    rows = plays.withColumn("n", n).join(layout.select(key, card, "place"), [key, card], "left")
    again = F.lag("n").over(Window.partitionBy(key, card).orderBy("n"))
    first = F.greatest(F.lit(0), F.col("place") - hand + 1)
    fits = F.when(again.isNotNull(), F.col("n") - again > hand).otherwise(F.col("n") >= first)
    rows = rows.withColumn("fits", F.coalesce(fits, F.lit(False)) & F.col("place").isNotNull())
    return rows.groupBy(key).agg(F.bool_and("fits").alias("possible"), F.min(F.when(~F.col("fits"), F.col("n"))).alias("failing"))
