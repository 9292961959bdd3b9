"""Ranked lexical search with bit-sliced Bloom signatures.

Index: documents of like size share blocks. A block is a bit matrix with a column for each document and a row for each
position of a Bloom filter; a document sets four positions for each of its terms and for each level of how often it
holds the term. Search: the rows of a term's positions, and-ed, are a bitmap of the documents that may hold it
that often; it misses none. A term's weighted slices, summed by document, bound the document's score from above. The
ten best bounds of all blocks are scored from their texts; their tenth score is a floor that every result must reach.
A second pass over the index finds all documents whose bound reaches the floor, and these are scored from their texts.
So nothing is left out that isn't proven to be out, and false positives of the filter cost time only.

Shape: one pass over texts without a shuffle makes blocks and statistics; queries go in blocks of a stated size, each
two passes over the index; a task keeps the best of each query, not its documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.llm import common

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Least frequencies of the levels: a document that holds a term 5 times is at 1, 2, 3 and 4, and not at 6.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 512, 1024, 4096, 16384, 65536, 1 << 20])
PROBES, BITS_A_KEY, GROWTH = 4, 14, 1.25
BLOCK_BITS, BLOCK_DOCS = 1 << 23, 2048
#: Candidates up to this many rows are sent to all tasks (some 10 MB); more meet the texts in a shuffled join.
SENT = 200_000
_MADE = "width long, ids array<long>, lengths array<long>, bits binary, term string, df long, n_docs long, n_terms long"


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_LOWER))


class _Hashes(dict):
    """64-bit hash of each term, remembered for the frequent ones."""

    def __missing__(self, term: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[term] = h = xxhash.xxh64_intdigest(term)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def positions(hashes: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """Rows [n, PROBES] of terms (64-bit hashes) at a level."""
    a = _mixed(hashes + np.asarray(level).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    b = _mixed(a) | np.uint64(1)
    return ((a[..., None] + np.arange(PROBES, dtype=np.uint64) * b[..., None]) % np.uint64(width)).astype(np.int64)


def width_for(keys: int) -> int:
    """Rows of the block for documents of so many keys: the next step of a geometric scale."""
    steps = max(0, int(np.ceil(np.log(max(1, keys * BITS_A_KEY / 64)) / np.log(GROWTH))))
    while (width := int(64 * GROWTH**steps)) < keys * BITS_A_KEY:
        steps += 1
    return width


class _Block:
    def __init__(self, width: int):
        self.width, self.most = width, int(np.clip(BLOCK_BITS // width // 8 * 8, 8, BLOCK_DOCS))
        self.ids, self.lengths, self.bits = [], [], np.zeros((width, self.most // 8), np.uint8)

    def add(self, doc_id, length: int, keys: np.ndarray) -> None:
        at = len(self.ids)
        self.bits[keys, at >> 3] |= np.uint8(1 << (at & 7))
        self.ids.append(doc_id)
        self.lengths.append(length)

    def row(self) -> dict:
        used = -(-len(self.ids) // 8)
        return {"width": self.width, "ids": self.ids, "lengths": self.lengths, "bits": self.bits[:, :used].tobytes()}


_SCHEMA = pa.schema([("width", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("bits", pa.binary()), ("term", pa.string()), ("df", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])


def _indexer(wanted: frozenset, blocks: bool):
    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, open_blocks, df, n_docs, n_terms = _Hashes(), {}, Counter(), 0, 0
        one = lambda row: pa.RecordBatch.from_pylist([row], _SCHEMA)
        for batch in batches:
            at = 0
            ids = batch.column("doc_id").to_pylist()
            for texts in common.slices(batch.column("text")):
                for text in texts:
                    doc_id, at = ids[at], at + 1
                    found = Counter(terms_of(text))
                    if not found:
                        continue
                    tf = np.fromiter(found.values(), np.int64, len(found))
                    n, h = int(tf.sum()), np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
                    n_docs, n_terms = n_docs + 1, n_terms + n
                    df.update(wanted.intersection(found))
                    if not blocks:
                        continue
                    levels = np.searchsorted(LEVELS, tf, "right")
                    width = width_for(int(levels.sum()))
                    each = np.arange(levels.max())[None, :] < levels[:, None]
                    which, level = np.nonzero(each)
                    if width not in open_blocks:
                        open_blocks[width] = _Block(width)
                    block = open_blocks[width]
                    block.add(doc_id, n, positions(h[which], level, width).ravel())
                    if len(block.ids) == block.most:
                        yield one(block.row())
                        del open_blocks[width]
        for block in open_blocks.values():
            yield one(block.row())
        if n_docs:
            yield pa.RecordBatch.from_pylist([{"term": t, "df": k} for t, k in df.items()], _SCHEMA)
            yield one({"n_docs": n_docs, "n_terms": n_terms})

    return index


def build(docs: DataFrame, terms: Iterable[str], blocks: bool = True) -> DataFrame:
    """The index of all documents (doc_id, text) as a table: rows with bits are blocks (left out if not wanted), rows
    with a term hold document frequencies of the given terms, the others document and term counts, a row for each task."""
    rows = docs.select("doc_id", F.col("text").cast("string"))
    with common.small_batches(rows.sparkSession):
        return common.materialise(rows.mapInArrow(_indexer(frozenset(terms), blocks), _MADE))


def weight(n_docs: int, df: int) -> int:
    return int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))))


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score by frequency and length measure, before its weight; grows with the frequency."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Queries:
    """A block of queries: terms with weights, and each query's terms as positions in them."""

    def __init__(self, items: list[list[str]], df: dict[str, int], n_docs: int, n_terms: int):
        self.terms = sorted({t for x in items for t in x if df.get(t)})
        at = {t: i for i, t in enumerate(self.terms)}
        self.items = [np.array(sorted({at[t] for t in x if t in at}), np.int64) for x in items]
        self.weights = np.array([weight(n_docs, df[t]) for t in self.terms], np.int64)
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in self.terms], np.uint64)
        self.n_docs, self.n_terms = n_docs, n_terms

    def measure(self, lengths: np.ndarray) -> np.ndarray:
        return 10 + 90 * lengths * self.n_docs // self.n_terms

    def bounds(self, width: int, lengths: np.ndarray, bits: bytes) -> np.ndarray:
        """Upper bounds of scores [queries, documents of a block]."""
        n = len(lengths)
        slices = np.frombuffer(bits, np.uint8).reshape(width, -1)
        m, out = self.measure(lengths), np.zeros((len(self.items), n), np.int64)
        step = max(64, (1 << 21) // n)
        for lo in range(0, len(self.terms), step):
            most = np.zeros((min(step, len(self.terms) - lo), n), np.int64)
            live, here = np.arange(len(most)), None
            for level in range(len(LEVELS)):
                seen = np.bitwise_and.reduce(slices[positions(self.hashes[lo + live], level, width)], axis=1)
                seen = seen if here is None else seen & here
                some = seen.any(1)
                live, here = live[some], seen[some]
                if not len(live):
                    break
                # frequencies below the next level, and no more than all terms of the document
                top = LEVELS[level + 1] - 1 if level + 1 < len(LEVELS) else np.iinfo(np.int64).max
                i, j = np.nonzero(np.unpackbits(here, axis=1, count=n, bitorder="little"))
                most[live[i], j] = np.minimum(top, lengths[j])
            value = parts(most, m) * self.weights[lo : lo + len(most), None]
            for q, own in enumerate(self.items):
                own = own[(own >= lo) & (own < lo + len(most))] - lo
                if len(own):
                    out[q] += value[own].sum(0)
        return out

    def score(self, text: str | None, wanted: Iterable[int]) -> list[int]:
        """Exact scores of one text for the wanted queries."""
        found = Counter(terms_of(text))
        m = self.measure(np.array(sum(found.values()), np.int64))
        tf = np.fromiter((found.get(t, 0) for t in self.terms), np.int64, len(self.terms))
        value = parts(tf, m) * self.weights
        return [int(value[self.items[q]].sum()) for q in wanted]


_NO_ID = np.iinfo(np.int64).max
_FOUND = "query int, doc_id long, score long"
_FOUND_SCHEMA = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _blocks(batches: Iterable[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            width, ids, lengths, bits = (batch.column(c)[i] for c in ("width", "ids", "lengths", "bits"))
            own = np.array([_NO_ID if x is None else x for x in ids.as_py()], np.int64)
            yield width.as_py(), own, np.asarray(lengths.values.to_numpy(), np.int64), bits.as_py()


def _rows(query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(ids, mask=ids == _NO_ID), pa.array(score)], schema=_FOUND_SCHEMA)


def _best_bounds(queries: Queries, k: int):
    """The k best bounds of each query over a task's blocks, ties to the smaller id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.items]
        for width, ids, lengths, bits in _blocks(batches):
            for q, row in enumerate(queries.bounds(width, lengths, bits)):
                have, named = best[q]
                floor = max(1, have[-1] if len(have) == k else 1)
                at = np.flatnonzero(row >= floor)
                if len(at):
                    s, d = np.concatenate([have, row[at]]), np.concatenate([named, ids[at]])
                    first = np.lexsort((d, -s))[:k]
                    best[q] = s[first], d[first]
        for q, (s, d) in enumerate(best):
            if len(s):
                yield _rows(np.full(len(s), q), d, s)

    return run


def _reaching(queries: Queries, floors: dict[int, tuple[int, int]]):
    """All documents whose bound is over the query's floor, or equals it with an id that could still win the tie."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, ids, lengths, bits in _blocks(batches):
            for q, row in enumerate(queries.bounds(width, lengths, bits)):
                floor, last = floors.get(q, (0, _NO_ID))
                at = np.flatnonzero((row > floor) | ((row == floor) & (floor > 0) & (ids <= last)))
                if len(at):
                    yield _rows(np.full(len(at), q), ids[at], row[at])

    return run


def _scored(docs: DataFrame, candidates: DataFrame, queries: Queries) -> DataFrame:
    """Exact scores over 0 of the candidates' documents, each text read once for all its queries."""
    asked = common.materialise(candidates.select("query", "doc_id").distinct().groupBy("doc_id").agg(F.collect_set("query").alias("queries")))
    asked = F.broadcast(asked) if asked.count() <= SENT else asked.hint("merge")
    rows = docs.alias("d").join(asked.alias("a"), F.col("d.doc_id").eqNullSafe(F.col("a.doc_id"))).select("d.doc_id", "text", "queries")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                wanted = batch.column("queries")[i].as_py()
                doc_id = batch.column("doc_id")[i].as_py()
                scores = queries.score(batch.column("text")[i].as_py(), wanted)
                out += [{"query": q, "doc_id": doc_id, "score": s} for q, s in zip(wanted, scores, strict=True) if s > 0]
            yield pa.RecordBatch.from_pylist(out, _FOUND_SCHEMA)

    return common.materialise(rows.mapInArrow(run, _FOUND))


def _first(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, index: DataFrame, stats: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """item_id, rank, doc_id, score of a block of items [(item_id, terms)]. stats: build() for the items' terms."""
    spark = docs.sparkSession
    n_docs, n_terms = stats.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = {r.term: r.df for r in stats.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    queries = Queries([x for _, x in items], df, n_docs, n_terms)
    blocks = index.filter("bits IS NOT NULL").select("width", "ids", "lengths", "bits")
    with common.small_batches(spark, 16):
        likely = common.materialise(_first(blocks.mapInArrow(_best_bounds(queries, k), _FOUND), k).drop("rank"))
    known = _first(_scored(docs, likely, queries), k)
    floors = {r.query: (r.score, _NO_ID if r.doc_id is None else r.doc_id) for r in known.filter(F.col("rank") == k).collect()}
    with common.small_batches(spark, 16):
        open_rows = common.materialise(blocks.mapInArrow(_reaching(queries, floors), _FOUND))
    found = _first(_scored(docs, open_rows, queries), k)
    names = spark.createDataFrame([(i, x[0]) for i, x in enumerate(items)], "query int, item_id long")
    return found.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block: int = 1000) -> DataFrame:
    """The k best documents (doc_id, text) of each row of items (item_id, text): item_id, rank, doc_id, score.

    Only documents with a score over 0 are named, fewer than k where there are fewer. Ties go to the smaller doc_id,
    null ids last. Null and termless texts match nothing. Rows are told apart, not ids: each repeated item has its own
    results, and repeated documents each take a rank. Empty tables give no rows. Texts of any length are read whole.
    Other columns play no part. Items go in blocks of `block` rows, read one after the other, each with two passes
    over the index; only a block and the scores at its floors are in the driver.
    """
    docs, out, index = docs.select("doc_id", "text"), None, None
    rows = items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    while now := [(r.item_id, terms_of(r.text)) for r in islice(rows, block)]:
        terms = {t for _, x in now for t in x}
        stats = build(docs, terms, blocks=index is None)
        index = stats if index is None else index
        found = search_block(docs, index, stats, now, k)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
