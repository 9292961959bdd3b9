"""SimHash near-dedup over word shingles, with a byte-position inverted index and count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at most d bits share at least 8 - d of
them, the guaranteed minimum of matches. Posting lists of single positional bytes would hold n / 256 fingerprints
each, so tallying pairs on them grows with the square of the input; the index keeps the intersections of as many lists
as the guaranteed minimum instead (for d = 4: the 70 ways to choose four positions, with the four bytes there). A pair
reaches the minimum tally exactly if it meets in at least one of these lists. There its positional matches are
tallied, the pair is kept at the minimum or more, and its differing bits are verified. Lists longer than BLOCK are
compared block against block in tasks of their own, so that no list is collected whole. Equal fingerprints count once,
and a list gives a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common
from cinderlane.llm.components import connected_components

SEED = 42
BLOCK = 2048


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle of a text, repeats included; fewer words make one shingle, none give none."""
    words = (text or b"").lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))


def majority(h: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed 64-bit integer."""
    count = np.zeros(64, np.int64)
    for part in np.array_split(h, len(h) // 65536 + 1):
        count += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<i8")[0])


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of one text as a signed 64-bit integer; without words 0."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) for every row of docs, whole texts; ASCII letters are lower-cased, words end at ASCII white space."""

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fp = pa.array((fingerprint(t.as_py(), shingle) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], names=["doc_id", "fp"])

    schema = common.with_columns(docs.select("doc_id").schema, fp="long")
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def bit_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes are equal in pairs whose exclusive or is x."""
    return 8 - sum(((x >> np.uint64(8 * k)) & np.uint64(0xFF)).astype(bool).view(np.int8) for k in range(8))


def linked(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Matrix of verified links between two blocks: pairs are retained whose tally of equal positional bytes reaches
    the guaranteed minimum, and the retained ones are verified on their differing bits."""
    x = a[:, None] ^ b[None, :]
    kept = shared_bytes(x) >= 8 - bits
    kept[kept] = np.bitwise_count(x[kept]) <= bits
    return kept


def forest(fps: np.ndarray, bits: int, split: int | None = None) -> list[tuple[int, int]]:
    """Edges that connect what is linked among fps (with split: between the first `split` and all)."""
    n = len(fps)
    root = np.arange(n)
    edges = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for lo in range(0, split or n, 256):
        hi = min(split or n, lo + 256)
        for i, row in enumerate(linked(fps[lo:hi], fps, bits), lo):
            for j in np.flatnonzero(row):
                if j != i and (a := top(i)) != (c := top(j)):
                    root[max(a, c)] = min(a, c)
                    edges.append((int(fps[i].view(np.int64)), int(fps[j].view(np.int64))))
    return edges


def links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all verified links."""
    if not 0 <= bits < 8:
        raise ValueError("count filtering guarantees a match for fewer than eight differing bits only")
    chosen = list(combinations(range(8), 8 - bits))

    def postings(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo in range(0, len(fp), 20_000):
                part = fp[lo : lo + 20_000]
                keys = []
                for places in chosen:
                    mask = np.uint64(sum(0xFF << (8 * p) for p in places))
                    keys.append(part & mask)
                which = np.repeat(np.arange(len(chosen), dtype=np.int16), len(part))
                yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(part, len(chosen)).view(np.int64))], names=["choice", "bytes", "fp"])

    lists = distinct.select("fp").mapInArrow(postings, "choice short, bytes long, fp long")
    lists = lists.repartition("choice", "bytes").sortWithinPartitions("choice", "bytes", "fp")

    def read(batches):
        """Streams posting lists in order. Edges of short ones go out as (a, b); rows of long ones as they are."""
        held: list[np.ndarray] = []
        last, long = None, False
        edges: list[tuple[int, int]] = []

        def close():
            nonlocal held
            if not long and held:
                fps = np.concatenate(held)
                if len(fps) > 1:
                    edges.extend(forest(fps, bits))
            held = []

        def out(rows, long_rows=()):
            a = [x[0] for x in rows] + [x[2] for x in long_rows]
            b = [x[1] for x in rows] + [None] * len(long_rows)
            c = [None] * len(rows) + [x[0] for x in long_rows]
            d = [None] * len(rows) + [x[1] for x in long_rows]
            types = (pa.int64(), pa.int64(), pa.int16(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((a, b, c, d), types, strict=True)], names=["a", "b", "choice", "bytes"])

        for b in batches:
            choice, key, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.view(np.uint64)
            if not len(fp):
                continue
            cut = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
            starts, stops = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
            whole = np.arange(len(starts)) > 0
            whole[-1] = False
            two = whole & (stops - starts == 2)
            ok = starts[two]
            ok = ok[shared_bytes(fp[ok] ^ fp[ok + 1]) >= 8 - bits]
            ok = ok[bit_distance(fp[ok], fp[ok + 1]) <= bits]
            edges.extend(zip(fp[ok].view(np.int64).tolist(), fp[ok + 1].view(np.int64).tolist(), strict=True))
            over = []
            for g in np.flatnonzero(~whole | (stops - starts > 2)):
                s, e, at = starts[g], stops[g], (choice[starts[g]], key[starts[g]])
                if at != last:
                    close()
                    last, long = at, False
                held.append(fp[s:e].copy())
                if long or sum(map(len, held)) > BLOCK:
                    long = True
                    over.extend((int(at[0]), int(at[1]), int(v)) for x in held for v in x.view(np.int64))
                    held = []
            if len(edges) > 50_000 or over:
                yield out(edges, over)
                edges = []
        close()
        yield out(edges)

    found = common.materialise(lists.mapInArrow(read, "a long, b long, choice short, bytes long"))
    short = found.filter("b is not null").select("a", "b")
    if found.filter("b is null").isEmpty():
        return short.distinct()
    return short.unionByName(_long_lists(found.filter("b is null"), bits)).distinct()


def _long_lists(rows: DataFrame, bits: int) -> DataFrame:
    """Links inside long posting lists: each list in blocks of about BLOCK, each pair of its blocks a group."""
    sizes = common.materialise(rows.groupBy("choice", "bytes").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n")))
    rows = rows.join(sizes, ["choice", "bytes"]).withColumn("mine", F.pmod(F.xxhash64("a"), F.col("n")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("choice", "bytes", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "a")

    def pairs(key, t):
        mine, fp = t.column("mine").to_numpy(), t.column("a").to_numpy().view(np.uint64)
        first = fp[mine == key[2].as_py()]
        second = fp[mine != key[2].as_py()]
        e = forest(np.concatenate([first, second]), bits, len(first))
        return pa.table({"a": pa.array([x[0] for x in e], pa.int64()), "b": pa.array([x[1] for x in e], pa.int64())})

    return rows.groupBy("choice", "bytes", "i", "j").applyInArrow(pairs, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """One row for each row of docs: doc_id, fp, fingerprint (16 hex digits) and component_id.

    component_id is the smallest doc_id reachable over links of at most `bits` differing bits. Texts that are null or
    without words have fingerprint zero and link like any other. Repeated rows and rows of equal texts have a result
    each; ties don't arise, as a component has one smallest id. Null ids never name a component unless all its ids are
    null. Texts of any length are read whole; other columns play no part. An empty table gives an empty result.
    """
    fps = common.materialise(fingerprints(docs, shingle))
    nodes = common.materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = common.materialise(connected_components(links(nodes, bits)))
    known = common.materialise(nodes.join(roots, nodes.fp == roots.node).select("fp", "root", "least"))
    least = common.materialise(known.groupBy("root").agg(F.min("least").alias("component")))
    named = common.materialise(known.join(least, "root").select("fp", "component"))
    every = nodes.join(named, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    every = common.materialise(every)
    out = fps.join(every, "fp")
    return out.select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
