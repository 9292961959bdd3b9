"""Language-model scoring by subword lattice likelihood.

The pieces and their order are those of an existing unigram vocabulary; its scores give each piece a prior. A word,
marked at its start, is a lattice of all its segmentations into pieces (single bytes for characters without one). A
forward recursion in log space adds up all of them, and expected counts of pieces in the distinct training words
(forward and backward) update the pieces' probabilities, with the prior as pseudo-counts. A word seen in training has
one more arc, the whole word, weighted by its count less a discount; the discounts together are the weight of the
pieces' arcs (absolute discounting, so the probabilities of all words add up to at most one). The text's log
probability is the sum over its words and the end.

Scoring never joins documents with words one by one: each block of documents sends one posting row for each of its
distinct words, the words' counts and scores come from an aggregation over all training documents, and the two meet in
a join on the word, after which sums by document are added up before they are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common

BASE, MARK = np.uint64(0x100000001B3), "▁"
PSEUDO = 30_000.0


@dataclass
class Lattice:
    """Pieces of a vocabulary with log probabilities (natural), the last one being the end of a text."""

    pieces: list[str]
    logp: np.ndarray = field(repr=False)
    byte_ids: np.ndarray = field(repr=False)

    @classmethod
    def load(cls, path: str) -> Lattice:
        """From a sentencepiece file. Scores that are ranks (0, -1, -2 ...) become a Zipf law; others are log
        probabilities as they are."""
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        score = np.array([sp.get_score(i) for i in range(n)])
        plain = np.array([not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) for i in range(n)])
        ranks = score[plain].min() < -1000
        p = 1 / (10 - np.minimum(score, 0)) if ranks else np.exp(score)
        p = np.where(plain, p, 0)
        p[[i for i in range(n) if sp.is_byte(i)]] = p[plain].min() / 100
        byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        p = np.append(p, p.sum() / 300)  # the end: a text of three hundred pieces
        with np.errstate(divide="ignore"):
            return cls([*[x if k else "" for x, k in zip(names, plain, strict=True)], "\n"], np.log(p / p.sum()), byte_ids)

    def __post_init__(self):
        self.longest = max([len(x) for x in self.pieces[:-1]], default=1)
        own = {_hash(x): i for i, x in enumerate(self.pieces[:-1]) if x}
        # beginnings of pieces are in the tables too, with id -1: where none goes on, no longer piece starts
        every = {_hash(x[:k]): -1 for x in self.pieces[:-1] for k in range(1, len(x))} | own
        h = np.fromiter(every, np.uint64, len(every))
        self.keys, self.ids = np.append(h, np.uint64(0)), np.append(np.fromiter(every.values(), np.int64, len(every)), -1)
        self.tables, left = [], np.arange(len(h))
        while len(left):
            t = np.full(1 << 18, len(h), np.int32)
            slot = _slot(h[left], len(self.tables))
            t[slot] = left
            left = left[t[slot] != left]
            self.tables.append(t)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are those of pieces or of their beginnings, and the pieces' ids (beginnings: -1)."""
        rows, ids, left = [], [], np.arange(len(h))
        for k, t in enumerate(self.tables):
            i = t[_slot(h[left], k)]
            hit = self.keys[i] == h[left]
            rows.append(left[hit])
            ids.append(self.ids[i[hit]])
            left = left[~hit & (i < len(self.keys) - 1)]
        return np.concatenate(rows), np.concatenate(ids)

    def arcs(self, c: np.ndarray, lens: np.ndarray):
        """Yields (start, end, rows, piece ids, log probabilities) over the places of padded words c, by start; piece
        -1: a character's bytes."""
        for start in range(c.shape[1]):
            left = np.flatnonzero(start < lens)
            h = np.zeros(len(left), np.uint64)
            for size in range(1, min(self.longest, c.shape[1] - start) + 1):
                h = h * BASE + c[left, start + size - 1].astype(np.uint64) + np.uint64(1)
                rows, ids = self.find(h)
                piece = ids >= 0
                use, score = rows[piece], self.logp[ids[piece]]
                ids = ids[piece]
                if size == 1 and len(use) < len(left):
                    lost = np.ones(len(left), bool)
                    lost[use] = False
                    lost = np.flatnonzero(lost)
                    score = np.concatenate([score, self.byte_scores(c[left[lost], start])])
                    use, ids = np.concatenate([use, lost]), np.concatenate([ids, np.full(len(lost), -1)])
                if len(use):
                    yield start, start + size, left[use], ids, score
                rows = rows[start + size < lens[left[rows]]]
                left, h = left[rows], h[rows]
                if not len(left):
                    break

    def byte_scores(self, codes: np.ndarray) -> np.ndarray:
        u, back = np.unique(codes, return_inverse=True)
        own = [self.logp[self.byte_ids[list(chr(x).encode("utf-8", "surrogatepass"))]].sum() for x in u]
        return np.array(own)[back]

    def forward(self, c: np.ndarray, lens: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Log of the summed probability of all segmentations up to each place, [places + 1, words]."""
        alpha = np.full((c.shape[1] + 1, len(c)), -np.inf)
        alpha[0] = 0
        for arc in self.arcs(c, lens):
            start, end, rows, _, score = arc
            if keep is not None:
                keep.append(arc)
            alpha[end][rows] = np.logaddexp(alpha[end][rows], alpha[start][rows] + score)
        return alpha

    def score(self, words: list[str]) -> np.ndarray:
        """Natural log probability of each word (marked here)."""
        out = np.zeros(len(words))
        for at, c, lens in common.pad_codes([MARK + w for w in words]):
            for part in np.array_split(np.arange(len(at)), len(at) // 20_000 + 1):
                wide = int(lens[part].max(initial=1))
                alpha = self.forward(c[part][:, :wide], lens[part])
                out[at[part]] = alpha[lens[part], np.arange(len(part))]
        return out

    def expect(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of times each piece is used in words that occur counts times."""
        total = np.zeros(len(self.pieces))
        for at, c, lens in common.pad_codes([MARK + w for w in words]):
            for part in np.array_split(np.arange(len(at)), len(at) // 20_000 + 1):
                if not len(part):
                    continue
                wide, r = int(lens[part].max()), np.arange(len(part))
                kept: list = []
                alpha = self.forward(c[part][:, :wide], lens[part], kept)
                whole = alpha[lens[part], r]
                beta = np.full((wide + 1, len(part)), -np.inf)
                beta[lens[part], r] = 0
                for start, end, rows, ids, score in reversed(kept):
                    x = score + beta[end][rows]
                    used = np.exp(np.minimum(alpha[start][rows] + x - whole[rows], 0)) * counts[at[part[rows]]]
                    total += np.bincount(ids + 1, weights=used, minlength=len(total) + 1)[1:]
                    beta[start][rows] = np.logaddexp(beta[start][rows], x)
        return total

    def updated(self, expected: np.ndarray) -> Lattice:
        """Probabilities after counts, with PSEUDO counts spread as the present ones."""
        p = expected + PSEUDO * np.exp(self.logp)
        with np.errstate(divide="ignore"):
            return Lattice(self.pieces, np.log(p / p.sum()), self.byte_ids)


def _hash(s: str) -> int:
    x = 0
    for ch in s:
        x = (x * int(BASE) + ord(ch) + 1) % 2**64
    return x


def _slot(h: np.ndarray, k: int) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15 + 2 * k)) >> np.uint64(46)).astype(np.int64)


END = b""


def postings(docs: DataFrame, held_out: Column) -> DataFrame:
    """(block, word, docs, times, train): one row for each distinct word of a block of documents.

    docs holds places in the block, times how often the word is in each, train the sum over documents that aren't
    held out. The end (an empty word) also carries the documents' ids and held_out. Null texts count as empty.
    """

    def run(batches):
        for b in batches:
            blocks, ids = b.column(0), b.column(1)
            held, texts = b.column(2).to_numpy(zero_copy_only=False).astype(bool), b.column(3).cast(pa.binary()).to_pylist()
            for lo, hi in common.chunks(texts, 12_000_000):
                n = hi - lo
                tokens = [(t or b"").lower().split() for t in texts[lo:hi]]
                index = dict.fromkeys(w for x in tokens for w in x)
                words = [END, *index]
                index = dict(zip(words, range(len(words)), strict=True))
                ends = np.cumsum([len(x) for x in tokens])
                flat = np.fromiter((index[w] for x in tokens for w in x), np.int64, int(ends[-1]))
                # a number for each word and document: sorted, they are the posting lists one after the other
                key, times = np.unique(flat * n + np.repeat(np.arange(n), np.diff(ends, prepend=0)), return_counts=True)
                key, times = np.concatenate([np.arange(n), key]), np.concatenate([np.ones(n, np.int64), times])
                word, place = key // n, key % n
                train = np.bincount(word, weights=times * ~held[lo:hi][place], minlength=len(words)).astype(np.int64)
                cuts = pa.array(np.searchsorted(word, np.arange(len(words) + 1)).astype(np.int32))
                once = pa.array(np.r_[0, np.full(len(words), n)].astype(np.int32))  # only the first row, the end, has these
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(words), blocks[lo].as_py())), pa.array(words, pa.binary()),
                        pa.ListArray.from_arrays(cuts, pa.array(place.astype(np.int32))), pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                        pa.array(train), pa.ListArray.from_arrays(once, ids.slice(lo, n)), pa.ListArray.from_arrays(once, b.column(2).slice(lo, n)),
                    ],
                    names=["block", "word", "docs", "times", "train", "ids", "held"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("block"), F.col("doc_id"), held_out.alias("held"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"block long, word binary, docs array<int>, times array<int>, train long, ids array<{kind}>, held array<boolean>")


def _words(column: pa.Array) -> list[str]:
    return [w.decode("utf-8", "replace") for w in column.to_pylist()]


def expected_counts(counts: DataFrame, lattice: Lattice) -> np.ndarray:
    """Expected uses of each piece over the distinct words of the table (word, c) with c > 0; at most one row for each
    piece reaches the driver."""

    def run(batches):
        total = np.zeros(len(lattice.pieces))
        for b in batches:
            words = _words(b.column(0))
            real = [w for w in words if w]
            total[-1] += len(words) - len(real)
            total += lattice.expect(real, np.ones(len(real)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "n"])

    out = np.zeros(len(lattice.pieces))
    for r in counts.filter("c > 0").select("word", "c").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r.piece] = r.n
    return out


def word_scores(counts: DataFrame, lattice: Lattice, n: int, v: int, discount: float) -> DataFrame:
    """(word, c, lp): log10 probability of each word, over the pieces' arcs and, for c > 0, the whole word's.

    n and v are the sum of c and how many words have c > 0; with n = 0 only the pieces' arcs count.
    """

    def run(batches):
        for b in batches:
            words, c = _words(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
            lp = np.full(len(words), lattice.logp[-1])
            real = np.fromiter((bool(w) for w in words), bool, len(words))
            lp[real] = lattice.score([w for w in words if w])
            if n:
                with np.errstate(divide="ignore"):
                    lp = np.logaddexp(np.log(np.maximum(c - discount, 0) / n), lp + np.log(discount * v / n))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lp / np.log(10))], names=["word", "c", "lp"])

    return counts.select("word", "c").mapInArrow(run, "word binary, c long, lp double")


def score(docs: DataFrame, vocabulary: str, held_out: Column, rounds: int = 2) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Counts come from all documents that aren't held out, and so do the pieces' probabilities, in `rounds` updates, and
    the discount (words seen once against words seen twice).
    Without training documents counts are zero and the pieces keep their prior. Null texts count as empty: one token,
    the end.
    """
    rows = common.materialise(postings(docs, F.coalesce(held_out, F.lit(False))))
    counts = common.materialise(rows.groupBy("word").agg(F.sum("train").alias("c")))
    c = F.col("c")
    n, v, once, twice = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)).first()
    discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    lattice = Lattice.load(vocabulary)
    for _ in range(rounds if n else 0):
        lattice = lattice.updated(expected_counts(counts, lattice))
    scored = common.materialise(word_scores(counts, lattice, n, v, discount))
    base = F.log10((F.col("c") + 0.1) / (n + 0.1 * (v + 1)))
    joined = rows.select("block", "word", "docs", "times").join(scored, "word")
    flat = joined.select("block", "c", base.alias("base"), "lp", F.inline(F.arrays_zip("docs", "times")))
    sums = flat.groupBy("block", "docs").agg(
        F.sum("times").alias("n_tokens"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("times") * F.col("base")).alias("base_score"), F.sum(F.col("times") * F.col("lp")).alias("score"),
    )
    ids = rows.filter(F.octet_length("word") == 0).select("block", F.inline(F.arrays_zip("docs", "ids", "held"))).withColumnRenamed("ids", "doc_id")
    return ids.join(sums, ["block", "docs"]).select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )
