"""Readers: given tables, JSON lines that keep broken rows, line-numbered compressed streams, tar members, CSV sections."""

from __future__ import annotations

import gzip
import io
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_documents(spark: SparkSession, path: str, schema: T.StructType, one_per_file: bool = False) -> DataFrame:
    """JSON objects under a path; an unreadable one becomes a row with its text in `_bad`."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    return reader.option("multiLine", one_per_file).option("recursiveFileLookup", True).json(path)


def latest_lines(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """An append-only ledger: bad lines are skipped and the last line of each key wins."""
    lines = numbered_lines(spark, path).withColumn("r", F.from_json("line", schema)).filter("r is not null")
    return lines.groupBy(F.col(f"r.{key}").alias("_k")).agg(F.max_by("r", F.struct("path", "n")).alias("r")).filter("_k is not null").select("r.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, line) of text files, plain, gzip or zstd: line numbers need the whole file in order, so a file is the
    unit of work and is read as a stream."""

    def read(frames):
        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                if p.endswith(".gz"):
                    stream = gzip.open(io.BytesIO(raw), "rt", encoding="utf-8", errors="replace")
                elif p.endswith(".zst"):
                    import zstandard

                    stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True), encoding="utf-8", errors="replace")
                else:
                    stream = io.StringIO(raw.decode("utf-8", "replace"))
                rows: list[tuple] = []
                for n, line in enumerate(stream):
                    rows.append((p, n, line.rstrip("\n")))
                    if len(rows) == 20_000:
                        yield pd.DataFrame(rows, columns=["path", "n", "line"])
                        rows = []
                yield pd.DataFrame(rows, columns=["path", "n", "line"]).astype({"n": "int64"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(read, "path string, n long, line string")


def tar_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, size, sha256, content) of tar archives; the archive is the unit of work."""

    def read(frames):
        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(raw)) as t:
                    for m in t:
                        if m.isfile():
                            yield pd.DataFrame({"archive": [p], "member": [m.name], "size": [m.size], "content": [t.extractfile(m).read()]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    out = files.mapInPandas(read, "archive string, member string, size long, content binary")
    return out.withColumn("sha256", F.sha2("content", 256))


def sections(rows: DataFrame, name: str, group: str, line: str) -> DataFrame:
    """Continuation rows take the last name above them in their file."""
    w = Window.partitionBy(group).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(F.when(F.trim(name) != "", F.col(name)), True).over(w))


def first_row(rows: DataFrame, group: str, line: str, wanted) -> DataFrame:
    """The first wanted row of each group."""
    return rows.filter(wanted).groupBy(group).agg(F.min_by(F.struct(*rows.columns), line).alias("r")).select("r.*")


def write_routed(rows: DataFrame, path: str, column: str) -> None:
    """One pass; each class of rows in a folder of its own. Fails if the folder is there."""
    rows.write.partitionBy(column).mode("errorifexists").parquet(path)


def write_shards(rows: DataFrame, path: str, split: str, order: list[str], most: int) -> None:
    """Files of at most `most` rows for each split, in order."""
    rows.repartitionByRange(split, *order).sortWithinPartitions(split, *order).write.option("maxRecordsPerFile", most).partitionBy(split).mode("errorifexists").parquet(path)


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of published files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def verify_manifest(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Files that are missing, extra or changed."""
    from cinderlane.operators.joins import reconcile

    out = reconcile(manifest, found, ["path"], ["length", "sha256"])
    return out.filter("status <> 'same'").select("path", F.when(F.col("status") == "only_left", "missing").when(F.col("status") == "only_right", "extra").otherwise("changed").alias("problem"))


def content_digest(manifest: DataFrame) -> DataFrame:
    """(files, bytes, content_sha256) of a manifest (path, length, sha256): a digest over its entries in order of path.

    It is a tree: entries are digested in 256 groups by a hash of the path, then the groups' digests are, so that no
    place has more than a group of lines. Any file that is added, missing, renamed or changed changes it. An empty
    manifest has the digest of the empty text.
    """
    line = F.concat_ws("\n", "path", F.col("length").cast("string"), "sha256")
    group = F.substring(F.sha2(F.col("path").cast("binary"), 256), 1, 2)
    parts = manifest.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"), F.array_sort(F.collect_list(F.struct("path", line.alias("line")))).alias("lines"))
    parts = parts.select("n", "b", F.struct("g", F.sha2(F.array_join(F.transform("lines", lambda x: x.line), "\n").cast("binary"), 256).alias("d")).alias("s"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: F.concat(x.g, x.d)), "\n")
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"), F.sha2(whole.cast("binary"), 256).alias("content_sha256"))


def read_back(written: DataFrame, found: DataFrame, ordinal: str) -> DataFrame:
    """Rows of what was to be written that aren't found as they were: (ordinal, problem), problem one of missing, extra,
    changed, reordered (the row is there at another place) and repeated (a place is there twice).

    Both have the same columns, with the ordinal (not null, unique in written) of each row. Rows are compared by a
    digest of all their columns, nulls told from empty texts. No row means that all is as it was written.
    """
    values = [c for c in written.columns if c != ordinal]
    digest = F.sha2(F.to_json(F.struct(*[F.array(F.col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(values)])).cast("binary"), 256)
    side = lambda d, c: d.select(F.col(ordinal).alias("_at"), digest.alias("_d")).groupBy("_at").agg(F.min("_d").alias(c), F.count(F.lit(1)).alias(f"_n{c}"))
    both = side(written, "_w").join(side(found, "_f"), "_at", "full")
    elsewhere = found.select(digest.alias("_w")).distinct().withColumn("_moved", F.lit(True))
    both = both.join(elsewhere, "_w", "left")
    problem = (
        F.when(F.col("_w").isNull(), "extra").when(F.col("_n_f") > 1, "repeated").when(F.col("_f").isNull() & F.col("_moved"), "reordered").when(F.col("_f").isNull(), "missing")
        .when(F.col("_w") == F.col("_f"), None).when(F.col("_moved"), "reordered").otherwise("changed")
    )
    return both.select(F.col("_at").alias(ordinal), problem.alias("problem")).filter("problem IS NOT NULL")


def shard_offsets(rows: DataFrame, split: str, shard: str, order: list[str], items: str) -> DataFrame:
    """rows with first and stop: where the row's items (an array) stand among all items of its shard, in order; what a
    flat column with offsets holds. Sums run inside a shard, whose size the writer bounds."""
    w = Window.partitionBy(split, shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.greatest(F.size(items), F.lit(0))).over(w)
    return rows.withColumn("stop", stop).withColumn("first", F.col("stop") - F.greatest(F.size(items), F.lit(0)))
