"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words and of their hashed character n-grams; a softmax
over that average gives the label. Training is stochastic gradient descent in numpy. The output layer is linear, so a
word's whole share of the score is one number: scoring computes it once for each distinct word of a batch and adds
it up over the whole text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common

BUCKETS = 1 << 17
NGRAMS = (1, 2, 3, 4)


def features(words: list[str]):
    """Yields (positions, bucket matrix, valid matrix): the word's own bucket first, then those of its n-grams."""
    for at, c, lens in common.pad_codes(words):
        c = np.concatenate([np.full((len(c), 1), 60, np.uint32), c, np.zeros((len(c), 1), np.uint32)], axis=1)
        c[np.arange(len(c)), lens + 1] = 62
        place = np.arange(c.shape[1])
        whole = np.full(len(c), 0x811C9DC5, np.uint32)
        for k in range(c.shape[1]):
            whole = np.where(k < lens + 2, (whole ^ c[:, k]) * np.uint32(0x01000193), whole)
        cols, valid = [whole[:, None]], [np.ones((len(c), 1), bool)]
        for n in NGRAMS:
            if c.shape[1] < n:
                continue
            h = np.full((len(c), c.shape[1] - n + 1), n, np.uint32)
            for k in range(n):
                h = (h ^ c[:, k : k + h.shape[1]]) * np.uint32(0x9E3779B1)
            cols.append(h)
            valid.append(place[None, : h.shape[1]] + n <= lens[:, None] + 2)
        h = np.concatenate(cols, axis=1)
        yield at, (h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1), np.concatenate(valid, axis=1)


@dataclass
class Model:
    logit: np.ndarray = field(repr=False)  # a bucket's vector times the difference of the output rows
    bias: float

    def word_values(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), 2))
        for at, h, valid in features(words):
            out[at, 0] = np.where(valid, self.logit[h], 0).sum(1)
            out[at, 1] = valid.sum(1)
        return out

    def scorer(self):
        cache = common.WordCache(self.word_values, 2)

        def score(texts: list[str | None]) -> np.ndarray:
            flat, ends = common.doc_slices([(t or "").split() for t in texts])
            ids = cache.lookup(flat)
            s = common.sum_by_doc(cache.values[ids], ends)
            return 1 / (1 + np.exp(-np.clip(s[:, 0] / np.maximum(s[:, 1], 1) + self.bias, -40, 40)))

        return score


def fit(texts: list[str], labels: list[int], dim: int = 8, epochs: int = 5, rate: float = 0.5) -> Model:
    """SGD over documents; each class has half the weight. One class only, or no document: its constant score."""
    y = np.asarray(labels, int)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    rng = np.random.default_rng(11)
    emb = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    out, bias = np.zeros((2, dim)), np.zeros(2)
    rows = []
    for t in texts:
        words, n = np.unique(np.array((t or "").split() or [""], dtype=object), return_counts=True)
        ids, w = [], []
        for at, h, valid in features(words.tolist()):
            ids.append(h[valid])
            w.append(np.broadcast_to(n[at][:, None], valid.shape)[valid])
        u, inv = np.unique(np.concatenate(ids), return_inverse=True)
        c = np.bincount(inv, weights=np.concatenate(w))
        rows.append((u.astype(np.int64), c / c.sum()))
    share = len(y) / (2 * np.maximum(np.bincount(y, minlength=2), 1))
    steps = 0
    for _ in range(epochs):
        for j in rng.permutation(len(rows)):
            ids, c = rows[j]
            lr = rate * (1 - steps / (epochs * len(rows)))
            steps += 1
            x = c @ emb[ids]
            z = out @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[j]] -= 1
            p *= share[y[j]]
            back = out.T @ p
            out -= lr * np.outer(p, x)
            bias -= lr * 0.1 * p
            emb[ids] -= lr * 20 * c[:, None] * back
    return Model((emb @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", per_class: int = 900, max_chars: int = 20_000) -> Model:
    """Fit on at most `per_class` labelled documents of each class (both bounds are parameters)."""
    found = common.sampled_labels(labels, label, allowed, per_class)
    rows = common.sample_texts(docs, list(found), 2 * per_class, max_chars, ["doc_id", "text"]).sort_values(["doc_id", "text"])
    return fit(rows.text.tolist(), [found[i] for i in rows.doc_id])


def score(docs: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """docs with score (0 to 1, higher: label 1 likelier) and predicted; the text column decides alone.

    Every row is kept, repeated rows too, and so are columns of any other name; an empty table gives an empty result.
    A null text counts as empty and gets the model's constant. Texts and words of any length are read whole.
    """

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = model.scorer()
        for texts in columns:
            for part in common.slices(texts):
                yield pa.array(f(part), pa.float64())

    kept = docs.drop("score", "predicted")
    row = F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row")
    out = kept.select(row, scored(F.col("text").cast("string")).alias("score"))
    return out.select("row.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
