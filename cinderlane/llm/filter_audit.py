"""Filter interaction audit: what each filter of a chain removes, in every order of the filters.

Each filter has an id table of the rows that fail it, written once. What a set of filters (a prefix of some order)
leaves of a filter's table comes from the smaller set by one left-anti join with the table of the filter added; what it
takes away comes from one left-semi join with the same table. A prefix's results don't depend on the order inside it,
so n filters need n joins of each kind, over 2^(n-1) sets, and not one for each of the n! orders. The tables hold row
ids, parts and two label flags, never texts. All joins are on unique row ids, so no key is hot.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common

#: The rows that fail at least one filter, as a table beside those of the filters.
ANY = ""


def words(text: Column) -> Column:
    """Words between ASCII white space, repeats included."""
    return F.array_remove(F.split(text, common.SPACE_RE), "")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides: short, repetitive, upper case, special characters."""
    found, capitals = words(text), F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(found) < 200,
        "B": 100 * F.size(F.array_distinct(found)) < 50 * F.size(found),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def repeated(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """rows with a boolean column: the key occurs in a row of smaller order. Null orders are smaller than none.

    The keys that occur twice are written first, so that the join with them can split hot ones."""
    first = common.materialise(rows.groupBy(key).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1"))
    both = rows.alias("r").join(first.alias("f").hint("merge"), F.col(f"r.{key}") == F.col(f"f.{key}"), "left")
    return both.select("r.*", F.coalesce(F.col(f"r.{order}") > F.col("f.first"), F.lit(False)).alias(name))


def flags_of(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic: one row an id; of several rows one that says so is enough."""
    says = lambda c: F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0))
    return labels.groupBy("doc_id").agg(says("quality").alias("good"), says("toxic").alias("toxic"))


def check_documents(docs: DataFrame, labels: DataFrame, part: str) -> tuple[DataFrame, list[str]]:
    """id, part, good, toxic and a boolean for each of the five filters, one row a document, and the filters' names."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = text_filters(text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("id"), "doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), *[c.alias(f) for f, c in named.items()],
    )
    rows = repeated(common.materialise(rows), "digest", "doc_id", "E")
    rows = rows.join(flags_of(labels), "doc_id", "left").fillna(0, ["good", "toxic"])
    names = [*named, "E"]
    return common.materialise(rows.select("id", "part", "good", "toxic", *names)), names


def prefix_counts(checked: DataFrame, filters: list[str]) -> DataFrame:
    """part, prefix (bits of the filters applied before), filter, and of the filter's failing rows: removed (failing
    none of the prefix), good and toxic among them, added (failing the prefix's last filter and none before it)."""
    failing = {f: common.materialise(checked.filter(F.col(f)).select("id", "part", "good", "toxic")) for f in filters}
    any_of = checked.filter(reduce(Column.__or__, map(F.col, filters))).select("id", "part", "good", "toxic")
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    left = [union([t.withColumn("filter", F.lit(f)).withColumn("prefix", F.lit(0)) for f, t in [(ANY, any_of), *failing.items()]])]
    taken = []
    for bit, f in enumerate(filters):
        before = union(left).filter(F.col("filter") != f).withColumn("prefix", F.col("prefix").bitwiseOR(F.lit(1 << bit)))
        ids = failing[f].select("id")
        left.append(common.materialise(before.join(ids, "id", "left_anti")))
        taken.append(before.join(ids, "id", "left_semi"))
    at = ["part", "prefix", "filter"]
    kept = union(left).groupBy(at).agg(F.count(F.lit(1)).alias("removed"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    gone = union(taken).groupBy(at).agg(F.count(F.lit(1)).alias("added"))
    return kept.join(gone, at, "full").fillna(0)


def _steps(filters: list[str]) -> list[dict]:
    """Every step of every order: its filter, and the cells of the counts that it needs."""
    bit, out = {f: 1 << i for i, f in enumerate(filters)}, []
    for order in permutations(filters):
        for i, f in enumerate(order):
            before = sum(bit[x] for x in order[:i])
            adds = [before & (2 * bit[x] - 1) for x in order[:i]]
            out.append({"filter_order": "".join(order), "step": i + 1, "f": f, "own": f"{before}{f}", "after": f"{before | bit[f]}{ANY}", "adds": [f"{m}{f}" for m in adds], "alone": f"{sum(bit.values()) - bit[f]}{f}"})
    return out


def audit(checked: DataFrame, filters: list[str]) -> DataFrame:
    """A row for each part, order of the filters and step, zeros included, with the counts of the step.

    checked: id (unique), part, good, toxic (0 or 1) and a boolean for each filter, as check_documents gives them.
    Filters are named by one letter each; at most seven, as there is a row for each of their orders. An empty table
    has no parts and so no rows. Each part gathers one small cell for each set of filters, never its rows.
    """
    if len(filters) > 7 or any(len(f) != 1 for f in filters):
        raise ValueError("at most seven filters, named by one letter each")
    n = len(filters)
    counts = common.materialise(prefix_counts(checked, filters))
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), F.bit_count("prefix") + 1)
    shares = counts.filter(F.col("filter") != ANY).groupBy("part", "filter").agg(F.sum(F.col("removed") * weight).alias("share"))
    shares = shares.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("filter", "share"))).alias("shares"))
    cell = F.struct(F.concat(F.col("prefix").cast("string"), "filter"), F.struct("removed", "good", "toxic", "added"))
    cells = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    failing = checked.filter(reduce(Column.__or__, map(F.col, filters))).select("id")
    clean = checked.join(failing, "id", "left_anti").groupBy("part").agg(F.count(F.lit(1)).alias("clean"))
    parts = checked.select("part").distinct().join(clean, "part", "left").join(cells, "part", "left").join(shares, "part", "left")
    kind = "array<struct<filter_order string, step int, f string, own string, after string, adds array<string>, alone string>>"
    rows = parts.withColumn("s", F.explode(F.from_json(F.lit(json.dumps(_steps(filters))), kind)))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    of = lambda key, name: zero(F.col("cells")[key][name])
    return rows.select(
        "part", "s.filter_order", "s.step",
        (zero(F.col("clean")) + of(F.col("s.after"), "removed")).alias("kept"),
        of(F.col("s.own"), "removed").alias("removed"),
        F.aggregate("s.adds", F.lit(0).cast("long"), lambda a, k: a + of(k, "added")).alias("redundant"),
        of(F.col("s.alone"), "removed").alias("unique_fails"),
        of(F.col("s.own"), "good").alias("good_lost"), of(F.col("s.own"), "toxic").alias("toxic_lost"),
        zero(F.col("shares")[F.col("s.f")]).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of the five text filters over documents (doc_id, text, part column) with labels (doc_id, quality, toxic).

    Rows are told apart, not ids: rows of one id count each. Null texts are empty, null parts are the part ''. A
    text counts as repeated (filter E) where a row of a smaller doc_id has the same; rows of null id neither repeat
    others nor are repeated. Ids labelled twice have a label where one row says so; ids without labels have none.
    Texts of any length are read once, inside one expression. Other columns play no part.
    """
    return audit(*check_documents(docs.select("doc_id", "text", part), labels.select("doc_id", "quality", "toxic"), part))
