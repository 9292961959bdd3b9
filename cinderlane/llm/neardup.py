"""Near-duplicates at a given shingle similarity, by wide SimHash fingerprints.

Sixty-four bits can't tell a similarity of 0.8 from chance by shared positional bytes, so the fingerprint here has 1,280:
160 positional bytes over the distinct shingles of a text. At similarity s a bit differs with probability
arccos(2s / (1 + s)) / pi, 0.15 at 0.8. The index holds the intersections of three positional posting lists for LISTS
choices of positions, so that a list has about n / 2^24 unrelated members; a pair that meets in a list shares the
minimum of three bytes. A sketch of 64 further bits filters the members of a list, all 1,280 bits filter pairs, the
equal positional bytes of a pair are tallied and retained at a minimum (count filtering), and every retained pair is
verified on its shingles. Recall is a matter of probability: 0.91 at a similarity of exactly 0.8, by
calculation and in tests over 45 to 1,000 shingles, more above. More bytes to choose from make it less uneven from pair
to pair, so that fewer lists, and less to shuffle, give the same recall. Texts of few shingles, whose bits tell less, also meet
in lists of their smallest shingle hashes: two of them at the similarity share one of these for certain.

A group of copies never becomes its pairs. First each text is verified against its nearest one only, which joins most of
what belongs together. Then lists whose members are all in one component are done; in the others, members of different
components are compared block against block, verified where they stand, and only edges that join something leave the
task. Every pair that shares a list and passes the filters is so decided.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common, simhash
from cinderlane.llm.components import connected_components

LONGS, LISTS, MINIMUM = 20, 150, 3
#: Bits of the 64-bit sketch beyond which members of a list aren't compared further.
FAR = 19
#: Texts of at most so many shingles are also found by these, and differ in at most SHORT_BITS of all bits.
SHORT, SHORT_BITS = 40, 330
#: Members of a list that are compared with each other in one task, and shingles that these have together.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
_pick = random.Random(7)
CHOICES = np.array([sorted(_pick.sample(range(8, 8 * LONGS), MINIMUM)) for _ in range(LISTS)])


def most_bits(similarity: float, deviations: float) -> int:
    """Differing bits at a similarity: as many as expected and some standard deviations."""
    p, n = math.acos(2 * similarity / (1 + similarity)) / math.pi, 64 * LONGS
    return int(n * p + deviations * math.sqrt(n * p * (1 - p)))


def least_bytes(similarity: float, deviations: float) -> int:
    """Equal positional bytes at a similarity: as many as expected less some standard deviations."""
    p, n = (1 - math.acos(2 * similarity / (1 + similarity)) / math.pi) ** 8, 8 * LONGS
    return max(MINIMUM, int(n * p - deviations * math.sqrt(n * p * (1 - p))))


def tally(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many positional bytes are equal in each pair of fingerprints (rows of x and y)."""
    return sum(simhash.shared_bytes(x[:, k] ^ y[:, k]) for k in range(LONGS))


def _tally_sql(x: str, y: str):
    """The same tally as a Column over two columns of fingerprints."""
    same = lambda v: sum((F.call_function("shiftright", v, F.lit(8 * k)).bitwiseAND(F.lit(255)) == 0).cast("int") for k in range(8))
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b)), F.lit(0), lambda n, v: n + same(v))


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """LONGS 64-bit integers over distinct shingle hashes."""
    out = np.zeros(LONGS, np.int64)
    for k in range(LONGS):
        x = h + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[k] = simhash.majority(x ^ (x >> np.uint64(31)))
    return out


def wide_fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, wide, shingles) for every row of docs: fingerprint and sorted 32-bit hashes of the distinct shingles;
    both are null for texts without words."""

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            for lo in range(0, len(texts), 500):
                wide, sets = [], []
                for t in texts.slice(lo, 500):
                    h = np.unique(simhash.shingle_hashes(t.as_py(), shingle))
                    wide.append(wide_fingerprint(h).tolist() if len(h) else None)
                    sets.append(np.unique((h >> np.uint64(32)).astype(np.uint32).view(np.int32)) if len(h) else None)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, 500), pa.array(wide, pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.int32()))], names=["doc_id", "wide", "shingles"])

    schema = common.with_columns(docs.select("doc_id").schema, wide="array<long>", shingles="array<int>")
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def _wide(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, LONGS)


def _postings(similarity: float):
    """(list, sketch, node): LISTS rows for each node, and for one of few shingles as many of its smallest hashes as
    can't all be missing from a text of that similarity. Lists of the second kind are negative."""

    def run(batches):
        for b in batches:
            node, wide, sets = b.column(0).to_numpy(), _wide(b.column(1)).view(np.int64), b.column(2)
            for lo in range(0, len(node), 2_000):
                part, own = wide[lo : lo + 2_000], node[lo : lo + 2_000]
                places = np.ascontiguousarray(part).view(np.uint8).reshape(len(part), 8 * LONGS).astype(np.int64)
                lists = sum(places[:, CHOICES[:, k]] << (8 * k) for k in range(MINIMUM)) | (np.arange(LISTS) << 24)
                keys, sketch, of = [lists.ravel()], [np.repeat(part[:, 0], LISTS)], [np.repeat(own, LISTS)]
                for i, s in enumerate(sets.slice(lo, 2_000)):
                    if s.is_valid:
                        least = s.values.to_numpy()[: len(s) - math.ceil(similarity * len(s) - 1e-9) + 1].astype(np.int64)
                        keys.append(least - (1 << 40))
                        sketch.append(np.full(len(least), part[i, 0]))
                        of.append(np.full(len(least), own[i]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, sketch, of)], names=["list", "sketch", "node"])

    return run


def _members(batches):
    """Streams posting lists in order, BLOCK members at a time: (list, node, near, bits) with each member's nearest one.

    Members of a whole list that have none near enough are left out: the sketch rules out all their pairs there.
    """
    key, sketch, node = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut_list = np.iinfo(np.int64).min

    def out(key, sketch, node):
        nonlocal cut_list
        sketch = sketch.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        stops = np.r_[starts[1:], len(key)]
        two = starts[stops - starts == 2]
        d = np.bitwise_count(sketch[two] ^ sketch[two + 1]).astype(np.int32)
        ok = (d <= FAR) | (key[two] < 0) | (key[two] == cut_list)
        two, d = two[ok], d[ok]
        rows = [(key[two], node[two], node[two + 1], d), (key[two], node[two + 1], node[two], d)]
        for g in np.flatnonzero(stops - starts != 2):
            for lo in range(starts[g], stops[g], BLOCK):
                at = slice(lo, min(lo + BLOCK, stops[g]))
                n, long = at.stop - lo, stops[g] - starts[g] > BLOCK or key[lo] == cut_list
                if n == 1 and not long:
                    continue
                near, least = np.zeros(n, np.int64), np.full(n, 99, np.int32)
                for i in range(0, n if n > 1 else 0, 128):
                    x = np.bitwise_count(sketch[at][i : i + 128, None] ^ sketch[at][None, :]).astype(np.int32)
                    x[np.arange(len(x)), np.arange(i, i + len(x))] = 99
                    near[i : i + 128], least[i : i + 128] = node[at][x.argmin(1)], x.min(1)
                keep = (least <= FAR) | long | (key[lo] < 0)
                rows.append((key[at][keep], node[at][keep], near[keep], least[keep]))
        cols = [np.concatenate(x) for x in zip(*rows, strict=True)]
        none = pa.array(cols[3] > 64)
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], mask=cols[3] > 64), pa.array(cols[3], mask=none.to_numpy(zero_copy_only=False))], names=["list", "node", "near", "bits"]
        )

    for b in batches:
        key, sketch, node = (np.concatenate([x, b.column(i).to_numpy()]) for i, x in enumerate((key, sketch, node)))
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))  # the last list may go on in the next batch
        if len(key) - last > BLOCK:  # long lists go in parts
            yield out(key, sketch, node)
            cut_list, last = key[-1], len(key)
        elif last:
            yield out(key[:last], sketch[:last], node[:last])
        key, sketch, node = key[last:], sketch[last:], node[last:]
    if len(key):
        yield out(key, sketch, node)


def _alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) that reach the tally of positional bytes (texts of few shingles: any) and whose shingles
    are that similar; at most one pair for each node comes here."""
    side = lambda v, w: sets.select(F.col("node").alias(v), F.col("shingles").alias(w), F.col("wide").alias(f"wide_{w}"))
    both = F.size(F.array_intersect("x", "y"))
    alike = both >= (F.size("x") + F.size("y") - both) * F.lit(similarity) - 1e-9
    few = (F.size("x") <= SHORT) & (F.size("y") <= SHORT)
    counted = few | (_tally_sql("wide_x", "wide_y") >= least_bytes(similarity, 5))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").filter(counted & alike).select("a", "b")


def _joined_up(known: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) after more edges between the nodes of known; only roots take part in the rounds."""
    root = lambda end: known.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
    between = edges.join(root("a"), "a").join(root("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    up = connected_components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return common.materialise(known.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")))


def _across(members: DataFrame, known: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) that join components: members of a list in different ones, block against block, verified there.

    A list whose members are in one component has nothing to join. A pair of blocks gives a forest of its links.
    """
    most, least = most_bits(similarity, 3), least_bytes(similarity, 5)
    rows = members.select("list", "node").join(known, "node")
    rows = rows.join(sets.select("node", F.size("shingles").alias("size")), "node")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("n")
    sizes = rows.groupBy("list").agg(blocks, F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("list", "n")
    rows = rows.join(sizes, "list").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("list", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "root")
    rows = rows.join(sets, "node")

    def joins(key, t):
        node, root, mine = (t.column(c).to_numpy() for c in ("node", "root", "mine"))
        wide, sets = _wide(t.column("wide").combine_chunks()), t.column("shingles").combine_chunks()
        first, second = np.flatnonzero(mine == key[1].as_py()), np.flatnonzero(mine == key[2].as_py())
        size, top, out = np.diff(sets.offsets.to_numpy()), {int(r): int(r) for r in np.unique(root)}, []

        def find(r: int) -> int:
            while top[r] != r:
                top[r] = top[top[r]]
                r = top[r]
            return r

        for part in np.array_split(first, len(first) // 128 + 1) if len(top) > 1 and len(second) else []:
            d = sum(np.bitwise_count(wide[part, k][:, None] ^ wide[second, k][None, :]).astype(np.int16) for k in range(LONGS))
            few = (size[part] <= SHORT)[:, None] & (size[second] <= SHORT)[None, :]
            near = (d <= np.where(few, max(SHORT_BITS, most), most)) & (root[part][:, None] != root[second][None, :])
            x, y = np.nonzero(near)
            counted = few[x, y] | (tally(wide[part[x]], wide[second[y]]) >= least)
            x, y = x[counted], y[counted]
            for k in np.argsort(d[x, y], kind="stable"):
                a, b = part[x[k]], second[y[k]]
                if (p := find(int(root[a]))) != (q := find(int(root[b]))) and _alike(sets[a].values.to_numpy(), sets[b].values.to_numpy(), similarity):
                    top[max(p, q)] = min(p, q)
                    out.append((int(node[a]), int(node[b])))
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return rows.groupBy("list", "i", "j").applyInArrow(joins, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row for each row of docs: doc_id and component_id, the smallest doc_id reachable over verified links.

    Texts without words (null ones too) link to nothing. Rows with equal fingerprints, such as repeated rows, are one
    node. Rows with null ids have a null component unless an equal row has an id, and never name one of others. Texts
    of any length are read whole; other columns play no part. An empty table gives an empty result.
    """
    with common.small_batches(docs.sparkSession):
        fps = common.materialise(wide_fingerprints(docs, shingle))
    few = F.when(F.size("shingles") <= SHORT, F.col("shingles")).alias("few")
    nodes = fps.filter("wide is not null").select("wide", "doc_id", few).groupBy("wide").agg(F.min("doc_id").alias("least"), F.any_value("few").alias("few"))
    nodes = common.materialise(nodes.withColumn("node", F.monotonically_increasing_id()))
    lists = nodes.select("node", "wide", "few").mapInArrow(_postings(similarity), "list long, sketch long, node long")
    lists = lists.repartition("list").sortWithinPartitions("list", "node")
    members = common.materialise(lists.mapInArrow(_members, "list long, node long, near long, bits int"))
    # only nodes that share a list need their shingles: each text is sent to its node once
    wanted = nodes.select("node", "wide").join(members.select("node"), "node", "left_semi")
    sets = common.materialise(fps.select("wide", "shingles").join(wanted, "wide").groupBy("node").agg(F.any_value("wide").alias("wide"), F.any_value("shingles").alias("shingles")))
    nearest = members.filter("near is not null").groupBy("node").agg(F.min_by("near", F.struct("bits", "near")).alias("near"))
    edges = _verified(nearest.select(F.col("node").alias("a"), F.col("near").alias("b")), sets, similarity)
    known = _joined_up(nodes.select("node", F.col("node").alias("root")), edges)
    known = _joined_up(known, _across(members, known, sets, similarity))
    named = nodes.select("node", "wide", "least").join(known, "node")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.materialise(named.join(least, "root").select("wide", "component_id"))
    return fps.select("doc_id", "wide").join(named, "wide", "left").select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
