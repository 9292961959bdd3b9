"""Leak-free splits: connected components over shared keys, deterministic weighted fill, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.operators.rounds import cut


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes of edges; root is the least node of the component.

    First each node whose neighbours are all smaller hands them to the least of them and waits for that one's root, so
    that only what is left is linked again: where edges tie many large nodes to few small ones, little is. Then rounds of
    star contraction: every node's larger neighbours, then its smaller ones, are handed to the least node that it knows.
    Rounds grow with the logarithm of the longest path. A node's neighbours are never gathered: its least one is
    pre-aggregated and met in a join, whose hubs can be split. Edges without two ends are left out; edges are read twice.
    """
    every = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).dropna()
    alone = every.filter("x = y").select(F.col("x").alias("node"))
    every = every.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    turned = every.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("e")).select("e.*")
    ends = cut(turned.groupBy("x").agg(F.min("y").alias("low"), (F.max("y") < F.col("x")).alias("last")))
    waiting = ends.filter("last").select(F.col("x").alias("node"), "low")
    links = every.join(ends.filter("low < x").hint("merge"), "x")
    links = links.select(F.when(F.col("last"), F.greatest("y", "low")).otherwise(F.col("x")).alias("x"), F.when(F.col("last"), F.least("y", "low")).otherwise(F.col("y")).alias("y"))
    links = cut(links.filter("x <> y").distinct())
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = cut(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("low")))
        large = both.join(least.hint("merge"), "x").filter("y > x").select(F.col("y").alias("x"), F.col("low").alias("y")).filter("x <> y").distinct()
        large = cut(large)
        least = cut(large.groupBy("x").agg(F.min("y").alias("low")))
        small = large.join(least.hint("merge"), "x").filter("y <> low").select(F.col("y").alias("x"), F.col("low").alias("y"))
        new = cut(small.unionByName(least.select("x", F.col("low").alias("y"))).select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).filter("x <> y").distinct())
        done = new.count() == links.count() and new.join(links, ["x", "y"], "left_anti").isEmpty()
        links = new
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = links.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(links.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())
    alone = alone.unionByName(waiting.select(F.col("low").alias("node"))).distinct()
    alone = alone.join(ends.filter("last").select(F.col("x").alias("node")), "node", "left_anti").join(nodes.select("node"), "node", "left_anti")
    nodes = cut(nodes.unionByName(alone.select("node", F.col("node").alias("root"))))
    return nodes.unionByName(waiting.join(nodes.select(F.col("node").alias("low"), "root"), "low").select("node", "root"))


def _in_hash_order(groups: DataFrame, key: str, weight: str, seed: str) -> DataFrame:
    """groups with _hash and _before, the weight of all groups before in hash order. Running sums are taken inside 4,096
    runs of the hash order; only the runs' totals are summed in one place."""
    rows = groups.withColumn("_hash", F.sha2(F.concat(F.lit(seed + ":"), F.col(key).cast("string")).cast("binary"), 256))
    rows = rows.withColumn("_run", F.coalesce(F.conv(F.substring("_hash", 1, 3), 16, 10).cast("int"), F.lit(-1)))
    to_here = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("_run").agg(F.sum(weight).alias("_sum")).select("_run", F.coalesce(F.sum("_sum").over(to_here), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_run").orderBy("_hash", key).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0))).join(F.broadcast(runs), "_run")
    return rows.withColumn("_before", F.col("_start") + F.col("_inside")).drop("_start", "_inside", "_run")


def holdout_fill(groups: DataFrame, key: str, weight: str, validation: float, test: float, seed: str) -> DataFrame:
    """groups (key, weight above 0) with split: in hash order test is filled to its share of the weight, then validation,
    and train has the rest; each has at least one group, for which the last groups are kept back.

    A group goes whole. Fewer than three groups raise ValueError, and so do shares that leave nothing for training.
    """
    if not 0 < validation < 1 or not 0 < test < 1 or validation + test >= 1:
        raise ValueError("shares of validation and test have to be above 0 and below 1 together")
    n, total = groups.agg(F.count(F.lit(1)), F.sum(weight)).first()
    if n < 3:
        raise ValueError(f"{n} groups for three splits")
    goal = lambda share: max(1, round(total * share))
    rows = cut(_in_hash_order(groups, key, weight, seed))
    last, second = [r._hash for r in rows.orderBy(F.desc("_hash"), F.desc(key)).select("_hash").limit(2).collect()]
    in_test = (F.col("_before") < goal(test)) & (F.col("_hash") < second)
    filled = rows.agg(F.max(F.when(in_test, F.col("_before") + F.col(weight)))).first()[0]
    in_validation = (F.col("_before") < filled + goal(validation)) & (F.col("_hash") < last)
    return rows.select(*groups.columns, F.when(in_test, "test").when(in_validation, "validation").otherwise("train").alias("split"))


def weighted_fill(groups: DataFrame, key: str, weight: str, shares: list[tuple[str, float]], seed: str) -> DataFrame:
    """Whole groups to splits by their place in hash order against the cumulative weight. A group larger than its split's
    share still goes there whole."""
    total = groups.agg(F.sum(weight)).first()[0] or 0
    out, top, split = _in_hash_order(groups, key, weight, seed), 0.0, None
    for name, share in shares:
        top += share * total
        split = F.when(F.col("_before") < top, name) if split is None else split.when(F.col("_before") < top, name)
    return out.withColumn("split", F.coalesce(split, F.lit(shares[-1][0]))).select(*groups.columns, "split")


def leaks(rows: DataFrame, key: str, split: str) -> DataFrame:
    """Keys found in more than one split."""
    return rows.groupBy(key).agg(F.countDistinct(split).alias("n_splits")).filter("n_splits > 1")
