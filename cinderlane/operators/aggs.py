"""Aggregations: dedupe with priorities, conflicts, coverage and quotas, cross-tabs, intervals, rasters, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in the order, by a ranked window that Spark limits before the shuffle."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def conflicts(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys with more than one different value, null counting as one."""
    return rows.groupBy(*key).agg(F.countDistinct(F.coalesce(F.col(value).cast("string"), F.lit("\0"))).alias("n_values"), F.count(F.lit(1)).alias("n")).filter("n_values > 1")


def coverage(rows: DataFrame, token: str, group: str) -> DataFrame:
    """Rows and different groups of each token."""
    pairs = rows.groupBy(token, group).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(token).agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("groups"))


def quota(n: Column, divisor: int, cap: int) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(cap), F.floor(n / divisor))).cast("long")


def wilson(successes: Column, trials: Column, z: float = 1.959963984540054) -> Column:
    """(lower, upper) of the Wilson interval, inside [0, 1]; null without trials."""
    p = successes / trials
    middle, spread = p + z * z / (2 * trials), z * F.sqrt(p * (1 - p) / trials + z * z / (4 * trials * trials))
    scale = 1 + z * z / trials
    lower, upper = F.greatest(F.lit(0.0), (middle - spread) / scale), F.least(F.lit(1.0), (middle + spread) / scale)
    return F.when(trials > 0, F.struct(lower.alias("lower"), upper.alias("upper")))


def strict_stat(stat: Column, value: Column) -> Column:
    """A group's statistic, or null if any member is unknown."""
    return F.when(F.count(value) == F.count(F.lit(1)), stat)


def raster(points: DataFrame, group: list[str], cell: str, weight: str) -> DataFrame:
    """Occupied cells only: weights summed, clipped to 1 and quantised to 0..255."""
    out = points.filter(F.col(cell).isNotNull()).groupBy(*group, cell).agg(F.sum(weight).alias("w"))
    return out.withColumn("level", F.rint(F.least(F.greatest(F.col("w"), F.lit(0.0)), F.lit(1.0)) * 255).cast("int")).drop("w")


def vocabulary(rows: DataFrame, token: str) -> DataFrame:
    """Tokens numbered from 1 in order; 0 is padding. Numbers come from the counts of range partitions."""
    from cinderlane.operators.sampling import ranked

    return ranked(rows.select(token).filter(F.col(token).isNotNull()).distinct(), [token], "_n").select(token, (F.col("_n") + 1).cast("int").alias("id"))


def padding(lengths: DataFrame, batch: str, length: str) -> DataFrame:
    """Longest row and the share of padding of each batch."""
    out = lengths.groupBy(batch).agg(F.max(length).alias("longest"), F.sum(length).alias("real"), F.count(F.lit(1)).alias("n"))
    return out.select(batch, "longest", "n", (1 - F.col("real") / (F.col("longest") * F.col("n"))).alias("padding"))
