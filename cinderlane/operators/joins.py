"""Joins with an account of what met and what didn't; interval, pairing, lineage and parity joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.operators.rounds import cut


def required(left: DataFrame, right: DataFrame, on: list[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(joined rows, left rows without a match); strict raises if any lacks one."""
    missing = left.join(right.select(*on), on, "left_anti")
    if strict and not missing.isEmpty():
        raise ValueError("rows without a match")
    return left.join(right, on), missing


def reconcile(left: DataFrame, right: DataFrame, on: list[str], fields: list[str]) -> DataFrame:
    """Full outer join on keys: only_left, only_right, differs or same for each."""
    a = left.select(*on, *[F.col(f).alias(f"l_{f}") for f in fields], F.lit(True).alias("in_l"))
    b = right.select(*on, *[F.col(f).alias(f"r_{f}") for f in fields], F.lit(True).alias("in_r"))
    same = reduce(lambda x, y: x & y, [F.col(f"l_{f}").eqNullSafe(F.col(f"r_{f}")) for f in fields], F.lit(True))
    status = F.when(F.col("in_r").isNull(), "only_left").when(F.col("in_l").isNull(), "only_right").when(same, "same").otherwise("differs")
    return a.join(b, on, "full_outer").withColumn("status", status).drop("in_l", "in_r")


def parity(left: DataFrame, right: DataFrame, on: list[str], fields: list[str], allowed: list[str] | None = None) -> DataFrame:
    """(keys, field, left_value, right_value, reason) of each field that differs between two results.

    reason: differs, only_left or only_right; a key that one side lacks has a row for each field. Fields in `allowed`
    may differ.
    """
    compared = [f for f in fields if f not in (allowed or [])]
    a = left.select(*on, *[F.col(f).cast("string").alias(f"l_{f}") for f in compared], F.lit(True).alias("in_l"))
    b = right.select(*on, *[F.col(f).cast("string").alias(f"r_{f}") for f in compared], F.lit(True).alias("in_r"))
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"l_{f}").alias("left_value"), F.col(f"r_{f}").alias("right_value")) for f in compared])
    reason = F.when(F.col("in_r").isNull(), "only_left").when(F.col("in_l").isNull(), "only_right").otherwise("differs")
    out = a.join(b, on, "full_outer").select(*on, reason.alias("reason"), F.explode(each).alias("d")).select(*on, "d.*", "reason")
    return out.filter((F.col("reason") != "differs") | ~F.col("left_value").eqNullSafe(F.col("right_value")))


def lookup_interval(rows: DataFrame, value: str, bands: DataFrame, low: str = "lo", high: str = "hi") -> DataFrame:
    """Rows with each band that holds their value (lo <= value < hi), nulls where there is none.

    A band lies in one or two cells of a grid as wide as itself, rounded up to a power of two, and a value looks into
    its cell of each such grid; there are as many as bands have sizes. So a wide band doesn't widen the cells of narrow
    ones, and bands meet values in an equi-join. Bands that hold nothing, or have no bounds, are left out.
    """
    sized = bands.filter(F.col(high) > F.col(low)).withColumn("_grid", F.ceil(F.log2((F.col(high) - F.col(low)).cast("double"))).cast("int"))
    grids = sorted(r._grid for r in sized.select("_grid").distinct().collect())
    at = lambda v, g: F.floor(v / F.pow(F.lit(2.0), g)).cast("long")
    placed = sized.withColumn("_cell", F.explode(F.array_distinct(F.array(at(F.col(low), F.col("_grid")), at(F.col(high), F.col("_grid"))))))
    if len(grids) <= 1:
        own = rows.withColumn("_grid", F.lit(grids[0] if grids else 0)).withColumn("_cell", at(F.col(value), F.col("_grid")))
        within = (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
        return own.alias("r").join(placed.alias("b"), (F.col("r._grid") == F.col("b._grid")) & (F.col("r._cell") == F.col("b._cell")) & within, "left").drop("_grid", "_cell")
    looks = rows.withColumn("_look", F.explode(F.array(*[F.struct(F.lit(g).alias("_grid"), at(F.col(value), F.lit(g)).alias("_cell")) for g in grids]))).select(*rows.columns, "_look.*")
    found = looks.join(placed, ["_grid", "_cell"]).filter((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("_grid", "_cell")
    missed = rows.join(found.select(value).distinct(), value, "left_anti").select(*rows.columns)
    return found.unionByName(missed, allowMissingColumns=True)


def pair_next(rows: DataFrame, key: str, order: list[str], first: Column, second: Column, value: str) -> DataFrame:
    """Rows of the first kind with the value of the row right after, if that is of the second kind, else unmatched."""
    w = Window.partitionBy(key).orderBy(*order)
    out = rows.withColumn("_next", F.lead(F.struct(second.alias("is"), F.col(value).alias("v"))).over(w)).filter(first)
    out = out.withColumn("answer", F.when(F.col("_next.is"), F.col("_next.v")))
    return out.withColumn("matched", F.coalesce(F.col("_next.is"), F.lit(False))).drop("_next")


def two_sided(rows: DataFrame, key: list[str], side: str, value: str) -> DataFrame:
    """Each side's row with its counterpart's value, for keys that have exactly two sides."""
    both = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 2")
    a = rows.join(both, key, "left_semi")
    b = a.select(*key, F.col(side).alias("other_side"), F.col(value).alias("other_value"))
    return a.join(b, key).filter(F.col(side) != F.col("other_side"))


def lineage(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, depth, status): each node's chain of parents to its end, by doubling jumps.

    status: root (no parent), linked, dangling (the chain leaves the nodes) or cycle; the last two have no root and no
    depth. Rounds grow with the logarithm of the longest chain; a chain that goes on for more rounds than the nodes
    allow is a cycle.
    """
    own = nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent")).dropDuplicates(["node"])
    have = own.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    up = own.join(have, "parent", "left").select("node", F.coalesce("parent", "node").alias("at"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"), (F.col("parent").isNotNull() & F.col("there").isNull()).alias("lost"))
    for _ in range(max(1, own.count()).bit_length() + 1):
        far = up.select(F.col("node").alias("at"), F.col("at").alias("far"), F.col("depth").alias("more"), F.col("lost").alias("gone"))
        up = up.join(far, "at", "left").select("node", F.coalesce("far", "at").alias("at"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), (F.col("lost") | F.coalesce("gone", F.lit(False))).alias("lost"))
        up = cut(up)
        moving = up.select(F.col("at").alias("node"), "lost").filter(~F.col("lost")).join(own.filter("parent is not null").select("node"), "node", "left_semi")
        if moving.isEmpty():
            break
    ends = own.filter("parent is null").select(F.col("node").alias("at"), F.lit(True).alias("end"))
    out = up.join(ends, "at", "left")
    status = F.when(F.col("lost"), "dangling").when(F.col("end").isNull(), "cycle").when(F.col("depth") == 0, "root").otherwise("linked")
    fine = status.isin("root", "linked")
    return out.select("node", F.when(fine, F.col("at")).alias("root"), F.when(fine, F.col("depth")).alias("depth"), status.alias("status"))


def credited(nodes: DataFrame, node: str, parent: str, counts: str) -> DataFrame:
    """(node, credited): the nearest node up the chain, itself included, whose `counts` is true; null if there is none,
    the chain leaves the nodes or turns in a circle. Undecided nodes jump to where the node that they point to points, so
    that rounds grow with the logarithm of the longest chain."""
    own = nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent"), F.coalesce(F.col(counts), F.lit(False)).alias("ok")).dropDuplicates(["node"])
    state = cut(own.select("node", F.when(F.col("ok"), F.col("node")).alias("credited"), F.when(~F.col("ok"), F.col("parent")).alias("at")))
    for _ in range(max(1, state.count()).bit_length() + 1):
        if state.filter("at is not null").isEmpty():
            break
        step = state.select(F.col("node").alias("at"), F.col("credited").alias("_found"), F.col("at").alias("_far"))
        open_ = F.col("credited").isNull() & F.col("_found").isNull()
        state = cut(state.join(step, "at", "left").select("node", F.coalesce("credited", "_found").alias("credited"), F.when(open_, F.col("_far")).alias("at")))
    return state.select("node", "credited")


def owned_parents(rows: DataFrame, key: str, owner: str, slots: list[str]) -> DataFrame:
    """rows with `parent`: the first of the slots that names a row of the same owner, and `origin`, that slot's name or
    unknown."""
    out = rows
    for s in slots:
        named = rows.select(F.col(key).alias(s), F.col(owner).alias(f"_{s}_owner")).dropDuplicates([s])
        out = out.join(named, s, "left").withColumn(f"_{s}", F.when(F.col(f"_{s}_owner") == F.col(owner), F.col(s)))
    origin = F.coalesce(*[F.when(F.col(f"_{s}").isNotNull(), F.lit(s)) for s in slots], F.lit("unknown"))
    return out.select(*rows.columns, F.coalesce(*[F.col(f"_{s}") for s in slots]).alias("parent"), origin.alias("origin"))


def inherited(attributes: DataFrame, parents: DataFrame, node: str, field: str, value: str, parent: str, most: int = 32) -> DataFrame:
    """(node, field, value, depth): attributes of every node, its own before its nearest ancestor's.

    attributes has (node, field, value), parents (node, parent), one parent each. A field that a node gives two values
    is unknown there and hides its ancestors' (value null). A chain still going after `most` levels raises. A level's
    joins are merges: a broadcast in each would send tables of just under the limit to the driver again and again.
    """
    own = attributes.groupBy(node, field).agg(F.countDistinct(F.coalesce(F.col(value).cast("string"), F.lit("\0"))).alias("_n"), F.min(value).alias("_v"))
    own = cut(own.select(node, field, F.when(F.col("_n") == 1, F.col("_v")).alias(value)))
    every = attributes.select(node).unionByName(parents.select(node)).distinct()
    at = every.withColumn("_at", F.col(node))
    found = own.withColumn("depth", F.lit(0))
    up = parents.select(F.col(node).alias("_at"), F.col(parent).alias("_up")).filter("_up is not null")
    for depth in range(1, most + 1):
        at = at.join(up.hint("merge"), "_at").select(node, F.col("_up").alias("_at"))
        at = cut(at)
        if at.isEmpty():
            break
        found = found.unionByName(at.join(own.withColumnRenamed(node, "_at").hint("merge"), "_at").select(node, field, value, F.lit(depth).alias("depth")))
    else:
        raise ValueError("a chain of parents that is too long or turns in a circle")
    return found.groupBy(node, field).agg(F.min_by(value, "depth").alias(value), F.min("depth").alias("depth"))
