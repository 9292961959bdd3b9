"""A cleaning pipeline over documents: each stage applies one operator to all that its predecessor kept.

run(spark, sf_dir) applies STAGES in order, writing each result to the shared folder and reading it again. All stages
but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlane.llm import bpe, common, exact_dedup, langid, mixing, neardup
from cinderlane.llm.queries import MIX_TARGETS, tokenizer_path


def _stage(f):
    """A stage that first deletes the tables behind the result it reads, if that was written; its own belong to this call."""

    @wraps(f)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.forget_source(docs)
        name = f"{f.__name__} {uuid.uuid4().hex}"
        with common.scope(name):
            return common.marked(f(spark, docs, sf_dir), name)

    return staged


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: null texts and texts without a letter. The model learns here.

    Repeated rows, null ids and rows of any other column's values are decided on by their text alone; an empty table
    stays empty; further columns, also ones named like this stage's own, are kept as they are.
    """
    model = langid.train(docs, ~common.remainder_is(5, 0))
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    found = langid.identify(docs.select(rest, "text"), model)
    return found.filter(F.col("lang_pred") != langid.UNDETERMINED).select("row.*", "text").select(*docs.columns)


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of equal texts, and of rows that repeat it one.

    Null texts count as empty, null ids as larger than any; an empty table stays empty; further columns are kept.
    """
    found = exact_dedup.exact_dedup(docs, carry=docs.columns)
    return found.filter("kept").select(*[F.col(f"doc_{c}").alias(c) for c in docs.columns])


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of near copies: five-word shingles, similarity 0.8 or more.

    Each text is decided on by itself, also where texts share a doc_id; null ids count as larger than any. Null texts
    and texts without words stay. Rows equal in id and text stay or go together (the stage before leaves none); an
    empty table stays empty; further columns are kept.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = neardup.near_duplicates(docs.select(row.alias("doc_id"), "text"), shingle=5, similarity=0.8)
    rest = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id.id").alias("id"), F.col("doc_id.text").alias("hash")).distinct()
    mine = docs.select(F.struct(*docs.columns).alias("row"))
    same = (F.xxhash64("row.text") == F.col("hash")) & F.col("row.doc_id").eqNullSafe(F.col("id"))
    return mine.join(rest, same, "left_anti").select("row.*")


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document in as many copies as its fitted rate gives: languages meet their target shares of the tokens, those
    without a target keep their share.

    Rows are told apart by id and text, so that null and repeated ids have rates too; rows equal in both have one.
    Where no language is named all rates are 1; an empty table stays empty; further columns are kept.
    """
    key = F.xxhash64("doc_id", "text")
    rates = mixing.mix(docs.select(key.alias("doc_id"), "text"), docs, "lang", MIX_TARGETS)
    times = rates.select(F.col("doc_id").alias("key"), mixing.copies().alias("times")).filter("times > 0").dropDuplicates(["key"])
    mine = docs.select(key.alias("key"), F.struct(*docs.columns).alias("row"))
    return mine.join(times, "key").select("row", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("row.*")


@_stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digest of their decoded text.

    One row for each row; null texts count as empty; an empty table gives an empty result; further columns aren't kept.
    """
    out = bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "lang", "source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixed", mixed), ("encoded", encoded)]

#: SQL can't express trained classifiers, fingerprints over components or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, own = common.table(spark, sf_dir, "documents"), uuid.uuid4().hex
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            with common.scope(f"{own} {k}"):
                docs = common.materialise(docs)
            common.drop(spark, f"{own} {k - 1}")
    return docs
