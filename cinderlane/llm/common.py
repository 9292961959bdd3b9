"""Shared helpers of the text operators: tables, shared storage, bounded training samples, word caches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, the word separator of the contracts: [\x20\x09-\x0D].
SPACE_RE = r"[\x20\x09-\x0D]+"


_own_dir: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where none is set, a local session gets a folder of this machine
    (tests); a cluster has to name one that all its machines share."""
    global _own_dir
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = _own_dir = _own_dir or "file://" + tempfile.mkdtemp(prefix="spark-")
    return found.rstrip("/")


_scopes: dict[str, list[str]] = {}
_scope: str | None = None


@contextmanager
def scope(name: str):
    """Tables materialised inside belong to the name, and drop() can delete them."""
    global _scope
    before, _scope = _scope, name
    try:
        yield
    finally:
        _scope = before


def drop(spark: SparkSession, name: str) -> None:
    """Delete the tables that belong to the name; nothing may read them any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in _scopes.pop(name, []):
        place = jvm.org.apache.hadoop.fs.Path(p)
        place.getFileSystem(conf).delete(place, True)


#: Where a result's schema tells which call made it; written with Parquet files and read back with them.
_MARK = "cinderlane.made_by"


def marked(result: DataFrame, name: str) -> DataFrame:
    """The result with the name of its scope in its first column's metadata."""
    first = result.schema.fields[0]
    return result.withMetadata(first.name, {**(first.metadata or {}), _MARK: name})


def forget_source(docs: DataFrame) -> None:
    """Where docs is a written copy of a marked result, delete the tables made for that result, and no others.

    Results of other calls keep theirs, written or not; so does this one while docs still reads them.
    """
    for name in {(f.metadata or {}).get(_MARK) for f in docs.schema.fields} & _scopes.keys():
        files = docs.inputFiles()
        if files and not any(p.rpartition("/")[2] in f for f in files for p in _scopes[name]):
            drop(docs.sparkSession, name)


def materialise(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    if _scope is not None:
        _scopes.setdefault(_scope, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Arrow batches of at most so many rows in jobs that run inside, where whole texts go to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def with_columns(schema: T.StructType, **added: str) -> T.StructType:
    """A new schema with columns of the named types at its end."""
    return T.StructType([*schema.fields, *[T.StructField(n, T._parse_datatype_string(k)) for n, k in added.items()]])


def id_crc(col: Column | str = "doc_id") -> Column:
    """crc32 of an id as text; ids that are null count as remainder -1."""
    col = F.col(col) if isinstance(col, str) else col
    return F.crc32(col.cast("string").cast("binary"))


def remainder_is(modulus: int, value: int, col: str = "doc_id") -> Column:
    return F.coalesce(id_crc(col) % modulus == value, F.lit(False))


def hash_sample(rows: DataFrame, key: str, most: int, count: int | None = None) -> DataFrame:
    """The `most` rows that come first by a hash of their key: first those under a threshold that about `most` rows
    pass, so that hardly more than these leave their partitions at any size of the table."""
    n = rows.count() if count is None else count
    rank = F.xxhash64(F.col(key))
    if n > most:
        share = min(1.0, (most + 5 * most**0.5 + 20) / n)
        rows = rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(1 << 40)) < int(share * (1 << 40)))
    return rows.orderBy(rank, key).limit(most)


def sample_texts(docs: DataFrame, keys: list, limit: int, max_chars: int, columns: list[str]):
    """Whole texts of a bounded set of documents as a pandas frame: at most `limit` rows of `max_chars` each."""
    if not keys:
        return docs.sparkSession.createDataFrame([], docs.select(*columns).schema).toPandas()
    rows = docs.filter(F.col("doc_id").isin(keys) & (F.length("text") <= max_chars))
    return rows.select(*columns).limit(limit).toPandas()


def sampled_labels(labels: DataFrame, label: str, allowed: Column, per_class: int) -> dict[int, int]:
    """doc_id -> label for at most `per_class` ids of each of the labels 0 and 1, in the order of an id hash.

    Null ids or labels are left out; of an id labelled both ways, label 1 counts.
    """
    found: dict[int, int] = {}
    for value in (0, 1):
        ids = labels.filter(allowed & (F.col(label) == value) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
        found |= {r.doc_id: value for r in hash_sample(ids, "doc_id", per_class).collect()}
    return found


def pad_codes(words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of words as padded matrices, grouped by length so that a long word pads only its like.

    Returns (positions in words, uint32 matrix [n, width] padded with 0, lengths) per group.
    """
    lens = np.fromiter(map(len, words), np.int64, len(words))
    width = np.maximum(8, 2 ** np.ceil(np.log2(np.maximum(lens, 1))).astype(np.int64))
    out = []
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for part in np.array_split(at, max(1, len(at) * int(w) // 500_000 + 1)):
            if len(part):
                codes = np.array([words[i] for i in part], dtype=f"<U{w}").view(np.uint32).reshape(len(part), w)
                out.append((part, codes, lens[part]))
    return out


class WordCache:
    """Values of distinct words, computed once for each batch of new words.

    `compute` maps a list of words to an array [n, width]. The cache is emptied beyond `most` words, so a
    worker's memory stays bounded whatever the vocabulary.
    """

    def __init__(self, compute: Callable[[list], np.ndarray], width: int, most: int = 150_000):
        self.compute, self.width, self.most = compute, width, most
        self.clear()

    def clear(self) -> None:
        self.ids: dict = {}
        self.values = np.zeros((0, self.width))

    def lookup(self, words: list) -> np.ndarray:
        """Row of self.values for each word."""
        if len(self.ids) > self.most:
            self.clear()
        new = [w for w in set(words) if w not in self.ids]
        if new:
            base = len(self.values)
            self.values = np.concatenate([self.values, self.compute(new)])
            self.ids.update(zip(new, range(base, base + len(new)), strict=True))
        return np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))


def doc_slices(token_lists: list[list]) -> tuple[list, np.ndarray]:
    """All tokens of a batch in one list, and where each document ends in it."""
    flat = [w for x in token_lists for w in x]
    return flat, np.cumsum([len(x) for x in token_lists])


def sum_by_doc(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of rows of values by document; documents without tokens give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return np.diff(total[ends], axis=0, prepend=total[:1])


def slices(texts: pa.Array, most: int = 2_000_000):
    """A column's texts in lists of about `most` bytes together, so that a batch is never all Python strings at once."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = np.flatnonzero(np.diff(np.cumsum(size) // most)) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(size)], strict=True):
        if hi > lo:
            yield texts.slice(lo, hi - lo).to_pylist()


def chunks(texts: list, most: int = 3_000_000):
    """Runs of positions whose texts have about `most` characters together; one long text makes a run alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
