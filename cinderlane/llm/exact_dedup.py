"""Exact dedup: distributed most-significant-digit radix partitioning of texts.

Each round splits every open group by its texts' next run of bytes (a "digit" of some bytes, growing eightfold by
round, so that rounds grow with the logarithm of the longest text). A group of one row is done, and so is a group
whose texts ended inside the digit: its rows have the same bytes from first to last, so equality needs no digest.
Only rows of groups that are neither go on, with only the bytes not yet read. Counts are pre-aggregated before their
shuffle and kept only for groups of two or more; rows meet them in a plain join whose hot keys Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.llm import common

FIRST_DIGIT = 64
GROWTH = 8


def normalised(text: str = "text") -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), common.SPACE_RE, " ")


def groups_of_equal(docs: DataFrame, key: Column, carry: list[Column], first: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """carry columns with keep_id (smallest doc_id of the rows of equal key), group_size and kept.

    docs needs doc_id. A null doc_id counts as larger than any; among rows of equal key and smallest doc_id one stays.
    An empty table gives an empty result.
    """
    names = [f"c{i}" for i in range(len(carry))]
    out_names = docs.select(*carry).columns
    left = docs.select(*[c.alias(n) for c, n in zip(carry, names, strict=True)], F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("group"), key.cast("binary").alias("rest"))
    width, done = first, []
    while True:
        left = left.withColumn("digit", F.substring("rest", 1, width))
        found = (
            left.groupBy("group", "digit").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("keep"))
            .filter("size > 1").withColumn("next", F.monotonically_increasing_id())
        )
        found = common.materialise(found)
        # always the same join: rows meet counts by key at every size, and hot keys are split
        state = left.join(found.hint("merge"), ["group", "digit"], "left").select(
            *names, "id", F.coalesce("keep", "id").alias("keep"), F.coalesce("size", F.lit(1)).alias("size"), "next",
            (F.col("next").isNotNull() & (F.octet_length("digit") == width)).alias("open"),
            F.when(F.col("next").isNotNull() & (F.octet_length("digit") == width), F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        )
        state = common.materialise(state)
        done.append(state.filter(~F.col("open")))
        left = state.filter("open").select(*names, "id", F.col("next").alias("group"), "rest")
        width *= growth
        if left.isEmpty():
            break
    # keys of "next" are unique within a round; the round tells groups of different rounds apart
    rows = done[0].withColumn("round", F.lit(0))
    for i, d in enumerate(done[1:], 1):
        rows = rows.unionByName(d.withColumn("round", F.lit(i)))
    least = F.col("next").isNotNull() & F.col("id").eqNullSafe(F.col("keep"))
    first_of = Window.partitionBy("round", "next").orderBy("id")
    kept = rows.filter(least).withColumn("kept", F.row_number().over(first_of) == 1)
    rest = rows.filter(~least).withColumn("kept", F.col("next").isNull())
    both = kept.unionByName(rest)
    return both.select(*[F.col(n).alias(o) for n, o in zip(names, out_names, strict=True)], F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept")


def exact_dedup(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256 and the columns named in carry.

    Texts are equal when their white space is (see normalised). Null texts count as empty and equal each other.
    """
    key = normalised()
    cols = [F.col("doc_id"), F.sha2(key.cast("binary"), 256).alias("text_sha256"), *[F.col(c).alias(f"own_{c}") for c in carry or []]]
    out = groups_of_equal(docs, key, cols)
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256", *[F.col(f"own_{c}").alias(f"doc_{c}") for c in carry or []])
