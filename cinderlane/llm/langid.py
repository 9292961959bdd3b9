"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters of the words, framed by blanks, are hashed into a fixed number of buckets for each order. A document's
value of a bucket is its share of the document's n-grams times the inverse document frequency. The weights are
trained with follow-the-regularised-leader (elastic net: L1 keeps the table sparse), then a temperature is fitted on
documents that training did not see. Scoring folds the inverse document frequency into the weights, so that a
word's share of the score is computed once for each distinct word of a batch and added up over the whole text, in one
pass and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.llm import common

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SCALE = 20.0
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point: is it a letter?"""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def features(words: list[str]):
    """Yields (positions, bucket matrix, valid matrix, letters) of lower-cased words framed by blanks.

    Everything but letters counts as a blank; an n-gram of blanks alone isn't valid. Buckets of an order start at
    BUCKETS times its place in ORDERS.
    """
    for at, c, lens in common.pad_codes(words):
        known = letter_table()[c]
        c = np.pad(np.where(known, c, 32).astype(np.uint32), ((0, 0), (1, 1)), constant_values=32)
        seen = np.pad(known, ((0, 0), (1, 1)))
        cols, valid = [], []
        for o, n in enumerate(ORDERS):
            wide = c.shape[1] - n + 1
            h, full = np.full((len(c), wide), n, np.uint32), np.zeros((len(c), wide), bool)
            for k in range(n):
                h = (h ^ c[:, k : k + wide]) * np.uint32(0x9E3779B1)
                full |= seen[:, k : k + wide]
            cols.append(((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)) + np.uint32(o * BUCKETS))
            valid.append(full)
        yield at, np.concatenate(cols, axis=1), np.concatenate(valid, axis=1), known.sum(1)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray = field(repr=False)  # [buckets of all orders, labels], with the inverse document frequency
    bias: np.ndarray
    temperature: float

    def word_values(self, words: list[str]) -> np.ndarray:
        """Each word's sums of weights by label, its n-grams and its letters."""
        k = len(self.labels)
        out = np.zeros((len(words), k + 2))
        for at, h, valid, letters in features(words):
            for i in range(k):
                out[at, i] = np.where(valid, self.weights[:, i][h], 0).sum(1)
            out[at, k], out[at, k + 1] = valid.sum(1), letters
        return out

    def predictor(self):
        k = len(self.labels)
        cache = common.WordCache(self.word_values, k + 2)

        def predict(texts: list[str | None]) -> tuple[list[str], list[float]]:
            if not k:
                return [UNDETERMINED] * len(texts), [0.0] * len(texts)
            flat, ends = common.doc_slices([(t or "").lower().split() for t in texts])
            ids = cache.lookup(flat)
            s = common.sum_by_doc(cache.values[ids], ends)
            p = softmax((s[:, :k] / np.maximum(s[:, k : k + 1], 1) * SCALE + self.bias) / self.temperature)
            best, none = p.argmax(1), s[:, k + 1] == 0
            return (
                [UNDETERMINED if x else self.labels[b] for b, x in zip(best, none, strict=True)],
                [0.0 if x else float(q[b]) for q, b, x in zip(p, best, none, strict=True)],
            )

        return predict


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(texts: list[str], labels: list[str], epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01) -> Model:
    """FTRL-proximal over documents, one at a time, then temperature scaling on each fifth document."""
    names = sorted(set(labels))
    k, size = len(names), len(ORDERS) * BUCKETS
    rows, df = [], np.zeros(size)
    for text in texts:
        words, times = np.unique(np.array(text.lower().split(), dtype=object), return_counts=True)
        ids, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        for at, h, valid, _ in features(words.tolist()):
            ids.append(h[valid].astype(np.int64))
            values.append(np.broadcast_to(times[at][:, None], valid.shape)[valid])
        i, back = np.unique(np.concatenate(ids), return_inverse=True)
        v = np.bincount(back, weights=np.concatenate(values), minlength=len(i))
        df[i] += 1
        rows.append((i, v / max(v.sum(), 1)))
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    y = np.array([names.index(x) for x in labels])
    z, n, bias = np.zeros((size, k)), np.zeros((size, k)), np.zeros(k)

    def weight(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    learn = [j for j in range(len(rows)) if j % 5] or list(range(len(rows)))
    held = [j for j in range(len(rows)) if j % 5 == 0]
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for j in order.permutation(learn):
            i, v = rows[j]
            x = v * idf[i] * SCALE
            w = weight(i)
            p = softmax(x @ w + bias)
            p[y[j]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
            bias -= 0.05 * p
    w = weight(np.arange(size))
    out = [(rows[j][1] * idf[rows[j][0]] * SCALE) @ w[rows[j][0]] + bias for j in held]
    temperature = 1.0
    if out:
        grid = np.geomspace(0.05, 5, 60)
        loss = [-np.mean([np.log(softmax(o / t)[y[j]] + 1e-12) for o, j in zip(out, held, strict=True)]) for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    return Model(names, np.asfortranarray(w * idf[:, None], np.float32), bias, temperature)


def train(docs: DataFrame, allowed: Column, most: int = 2500, max_chars: int = 20_000, most_languages: int = 200) -> Model:
    """Fit on at most `most` documents of at most `max_chars` characters, in the order of an id hash.

    The most frequent `most_languages` languages have equal shares of the sample, or all their documents if these are
    fewer. All three bounds are parameters. Null ids, null languages and texts without a letter teach nothing.
    """
    fit_for = allowed & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") <= max_chars) & F.col("text").rlike(r"\p{L}")
    rows = docs.filter(fit_for).select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not sizes:
        return fit([], [])
    each = max(1, most // len(sizes))
    wide = each + 5 * each**0.5 + 20
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, wide / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
    few = rows.filter(place < F.coalesce(share[F.col("lang")], F.lit(0.0)))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    found = few.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= each).drop("r").toPandas().sort_values(["doc_id", "lang"])
    return fit(found.text.tolist(), found.lang.tolist())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score added (columns of these names are replaced).

    Every row is kept, repeated rows too, and so are columns of any other name; an empty table gives an empty result.
    Texts that are null, empty or without a letter get `und` and 0.0; with no labelled row to learn from, all do. Texts
    and words of any length are read whole. A tie between languages goes to the first name in order.
    """

    @F.arrow_udf("lang_pred string, score double")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = model.predictor()
        for texts in columns:
            for part in common.slices(texts):
                names, scores = f(part)
                yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    row = F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row")
    return kept.select(row, predict(F.col("text").cast("string")).alias("found")).select("row.*", "found.lang_pred", "found.score")
