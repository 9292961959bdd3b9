"""Offline metrics of predictions, as sums that merge: every metric is a sum over the rows whose label is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds of a tick, the least rate whose logarithm is taken, and the width of the board in cells.
TICK_SECONDS, LEAST_RATE, BOARD_COLUMNS = 0.05, 1.1754943508222875e-38, 18


def exposure(ticks: Column) -> Column:
    """Seconds of an interval; one tick at least."""
    return F.greatest(ticks, F.lit(1)) * TICK_SECONDS


def event_probability(rate: Column, ticks: Column) -> Column:
    """That an event of a constant rate happens within the interval."""
    return -F.expm1(-rate * exposure(ticks))


def point_process_loss(rate: Column, ticks: Column, happened: Column) -> Column:
    """Negative log-likelihood of one interval of a piecewise exponential process: intervals without an own event are
    censored at their end and add their exposure alone."""
    return rate * exposure(ticks) - F.when(happened, F.log(F.greatest(rate, F.lit(LEAST_RATE)))).otherwise(0.0)


def place_of(scores: Column, label: Column) -> Column:
    """How many choices come before the label (0: it is the first): larger scores, and equal ones further left; null where
    the label names no score. Null and NaN scores come last."""
    clean = F.transform(scores, lambda s: F.when(s.isNull() | F.isnan(s), float("-inf")).otherwise(s))
    own = F.get(clean, label.cast("int"))
    ahead = F.filter(clean, lambda s, i: (s > own) | ((s == own) & (i < label)))
    return F.when(own.isNotNull(), F.size(ahead))


def cell_distance(a: Column, b: Column) -> Column:
    """Cells between two cells of the board, as the crow flies."""
    row = lambda c: F.floor(c / BOARD_COLUMNS)
    column = lambda c: c % BOARD_COLUMNS
    return F.sqrt(F.pow(row(a) - row(b), 2) + F.pow(column(a) - column(b), 2))


def metric_rows() -> dict[str, tuple[Column, Column, Column]]:
    """name -> (value, where it counts, weight) for predictions: rate, ticks, happened, timing_known, card_scores, card,
    cell, target, weight. Losses are weighted, rates of hits and errors aren't; unknown labels are null."""
    weight, one = F.greatest(F.coalesce(F.col("weight"), F.lit(0)), F.lit(0)).cast("double"), F.lit(1.0)
    timed = F.coalesce(F.col("timing_known"), F.lit(False)) & F.col("rate").isNotNull() & F.col("ticks").isNotNull() & F.col("happened").isNotNull()
    probability, loss = event_probability(F.col("rate"), F.col("ticks")), point_process_loss(F.col("rate"), F.col("ticks"), F.col("happened"))
    place = place_of(F.col("card_scores"), F.col("card"))
    off, placed = cell_distance(F.col("cell"), F.col("target")), F.col("cell").isNotNull() & F.col("target").isNotNull()
    finite = ~F.isnan(loss) & (F.abs(loss) < float("inf"))
    return {
        "loss_timing": (loss, timed & finite, weight), "timing_brier": (F.pow(probability - F.col("happened").cast("double"), 2), timed, one), "rate_mean": (F.col("rate").cast("double"), timed, one),
        "card_top1": ((place == 0).cast("double"), place.isNotNull(), one), "card_top3": ((place < 3).cast("double"), place.isNotNull(), one),
        "position_mean_cell_error": (off, placed, one), "position_within_1_cell": ((off <= 1).cast("double"), placed, one),
    }


def metric_sums(predictions: DataFrame, by: list[str]) -> DataFrame:
    """(by, metric, total, weight, rows) of predictions: sums that can be added up over any batches."""
    aggs = []
    for name, (value, counts, weight) in metric_rows().items():
        each = F.coalesce(counts, F.lit(False))
        aggs.append(F.struct(
            F.lit(name).alias("metric"), F.coalesce(F.sum(F.when(each, value * weight)), F.lit(0.0)).alias("total"),
            F.coalesce(F.sum(F.when(each, weight)), F.lit(0.0)).alias("weight"), F.count_if(each).alias("rows"),
        ).alias(name))
    wide = predictions.groupBy(*by).agg(*aggs)
    return wide.select(*by, F.explode(F.array(*metric_rows())).alias("m")).select(*by, "m.*")


def merged_metrics(sums: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, metric, value, rows): means over all that was added up, null where no row with weight counted."""
    out = sums.groupBy(*(by or []), "metric").agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"), F.sum("rows").alias("rows"))
    return out.select(*(by or []), "metric", F.when(F.col("weight") > 0, F.col("total") / F.col("weight")).alias("value"), "rows")


def ratio_projection(sample: DataFrame, total_rows: int, shards: int, factor: float = 1.35, overhead: int = 64 * 1024) -> DataFrame:
    """One row that projects the bytes of total_rows from a sample (rows, bytes) of units: the largest unit's bytes a row
    for all, with an overhead a shard and a safety factor, beside the ratio estimate and its 95 % interval (by the spread
    of the units about the ratio). A sample without rows or bytes gives nulls."""
    d = sample.agg(
        F.count(F.lit(1)).alias("units"), F.sum("rows").alias("sample_rows"), F.sum("bytes").alias("sample_bytes"), F.max(F.when(F.col("rows") > 0, F.col("bytes") / F.col("rows"))).alias("maximum_rate"),
        F.sum(F.col("rows").cast("double") * F.col("rows")).alias("_rr"), F.sum(F.col("rows").cast("double") * F.col("bytes")).alias("_rb"), F.sum(F.col("bytes").cast("double") * F.col("bytes")).alias("_bb"),
    )
    some = (F.col("sample_rows") > 0) & (F.col("sample_bytes") > 0)
    d = d.withColumn("rate", F.when(some, F.col("sample_bytes") / F.col("sample_rows")))
    spread = (F.col("_bb") - 2 * F.col("rate") * F.col("_rb") + F.col("rate") * F.col("rate") * F.col("_rr")) / F.greatest(F.col("units") - 1, F.lit(1))
    error = F.sqrt(F.greatest(spread, F.lit(0.0)) / F.col("units")) / (F.col("sample_rows") / F.col("units"))
    projected = F.when(some, F.ceil(F.col("maximum_rate") * total_rows) + shards * overhead)
    return d.select(
        "units", "sample_rows", "sample_bytes", "rate", "maximum_rate", ((F.col("rate") - 1.96 * error) * total_rows).alias("low"), ((F.col("rate") + 1.96 * error) * total_rows).alias("high"),
        projected.alias("projected"), F.ceil(projected * factor).alias("projected_safe"),
    )

