"""Toxicity: a support vector machine on a gap-tolerant subsequence string kernel, with Nystrom landmarks.

The kernel of two words counts their common letter subsequences of three and four letters, each gap (an inserted or
left-out letter, in either word) costing a factor DECAY, normalised by the words' own kernels; words whose
longest common subsequence has under four letters, or under SHARED of the shorter word, are unrelated (kernel 0). A sentence is labelled
by its document; its decision is that of its most telling word, so training alternates between choosing each
sentence's witness and fitting the machine (hinge loss) on the landmarks' Nystrom features, with the hardest words of
clean documents as negatives and the landmarks with one inserted letter as further positives. A document scores as its worst sentence does, which is its worst word. Letters spelt
one by one ("i d i o t", "i.d.i.o.t") also count as one word.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame

from cinderlane.llm import common

DECAY = 0.75
DEPTH = 4
SHARED = 0.6
USED = (3, 4)
LONGEST = 24
_spelt = re.compile(rb"\x01{4,}")
_strip = re.compile(r"[\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """Distinct white-space tokens of a text, and runs of four or more single letters joined."""
    tokens = (text or "").split()
    found = set(tokens)
    single = bytes(map((1).__eq__, map(len, tokens)))
    if b"\1\1\1\1" in single:
        found.update("".join(tokens[m.start() : m.end()]) for m in _spelt.finditer(single))
    return found


def letters(token: str) -> str:
    """The token's letters, lower-cased; tokens beyond LONGEST letters are cut into overlapping parts elsewhere."""
    return _strip.sub("", token.lower()) if not token.isalpha() else token.lower()


def parts(word: str) -> list[str]:
    """A word as pieces of at most LONGEST letters that overlap by half, so that no part of it goes unread."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def pair_kernels(left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """k_q(left, right) for q = 1..DEPTH, row by row of two matrices of code points padded with 0.

    state[q][j] holds the decayed matches of q+1 letters that end at letter j of the right word.
    """
    n = len(left)
    x, z = np.ascontiguousarray(left.T), np.ascontiguousarray(right.T)
    state = np.zeros((DEPTH, len(z), n), np.float32)
    total = [np.zeros(n, np.float32) for _ in range(DEPTH)]
    for i in range(len(x)):
        run = np.zeros((DEPTH, n), np.float32)  # decayed sums of state[q] over the letters before j
        for j in range(len(z)):
            same = (z[j] == x[i]) & (x[i] != 0)
            old = state[:, j].copy()
            state[:, j] *= DECAY
            for q in range(DEPTH):
                new = np.where(same, 1.0 if q == 0 else run[q - 1], 0).astype(np.float32)
                state[q, j] += new
                total[q] += new
            run = DECAY * run + old
    return total


@dataclass
class Landmarks:
    words: list[str]

    def __post_init__(self):
        width = max([len(w) for w in self.words], default=1)
        self.codes = np.zeros((len(self.words), width), np.uint32)
        for i, w in enumerate(self.words):
            self.codes[i, : len(w)] = [ord(x) for x in w]
        self.norms = np.array([np.sqrt(np.maximum(x, 1e-12)) for x in pair_kernels(self.codes, self.codes)])
        # for each letter, at which places of each landmark it stands, as bits
        self.alphabet = np.array(sorted({ord(x) for w in self.words for x in w}), np.uint32)
        self.places = np.zeros((len(self.alphabet) + 1, len(self.words)), np.uint32)
        for i, a in enumerate(self.alphabet):
            self.places[i] = ((self.codes == a) << np.arange(width)).sum(1)

    def related(self, c: np.ndarray) -> np.ndarray:
        """[n, landmarks]: do they share a long subsequence? (Bit-parallel longest common subsequence.)"""
        at = np.minimum(np.searchsorted(self.alphabet, c), len(self.alphabet) - 1)
        at = np.where(self.alphabet[at] == c, at, len(self.alphabet))
        v = np.full((len(c), len(self.words)), 0xFFFFFFFF, np.uint32)
        for i in range(c.shape[1]):
            u = v & self.places[at[:, i]]
            v = (v + u) | (v - u)
        shorter = np.minimum((c != 0).sum(1)[:, None], (self.codes != 0).sum(1)[None, :])
        return np.bitwise_count(~v) >= np.maximum(DEPTH, np.ceil(SHARED * shorter))

    def kernel(self, words: list[str]):
        """Yields (word positions, landmark positions, values) of the pairs that share a long subsequence.

        The value is the mean over USED of the normalised kernels; it is 0 for all other pairs.
        """
        for at, c, lens in common.pad_codes(words):
            c = c[:, : int(lens.max(initial=1))]
            for part in np.array_split(np.arange(len(at)), len(at) // 20_000 + 1):
                w, z = np.nonzero(self.related(c[part]))
                if not len(w):
                    continue
                used, back = np.unique(w, return_inverse=True)
                own = [np.sqrt(x) for x in pair_kernels(c[part][used], c[part][used])]
                for k in np.array_split(np.arange(len(w)), len(w) // 20_000 + 1):
                    both = pair_kernels(c[part][w[k]], self.codes[z[k]])
                    value = sum(both[q - 1] / (own[q - 1][back[k]] * self.norms[q - 1][z[k]]) for q in USED) / len(USED)
                    yield at[part][w[k]], z[k], value

    def matrix(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)))
        for w, z, value in self.kernel(words):
            out[w, z] = value
        return out


@dataclass
class Model:
    landmarks: list[str]
    beta: np.ndarray = field(repr=False)
    bias: float
    slope: float
    shift: float

    def word_scores(self, tokens: list[str], marks: Landmarks | None) -> np.ndarray:
        """Decision value of each token: that of its best part; no shared subsequence gives the bias."""
        pieces: dict[str, int] = {}
        owner, piece = [], []
        for i, w in enumerate(map(letters, tokens)):
            if len(w) >= DEPTH:
                for p in (w,) if len(w) <= LONGEST else parts(w):
                    owner.append(i)
                    piece.append(pieces.setdefault(p, len(pieces)))
        out = np.full(len(tokens), self.bias)
        if pieces and self.landmarks:
            value = np.full(len(pieces), self.bias)
            for w, z, k in marks.kernel(list(pieces)):
                np.add.at(value, w, k * self.beta[z])
            np.maximum.at(out, np.array(owner), value[piece])
        return out[:, None]

    def scorer(self):
        marks = Landmarks(self.landmarks) if self.landmarks else None
        cache = common.WordCache(lambda w: self.word_scores(w, marks), 1)

        def score(texts: list[str | None]) -> np.ndarray:
            flat, ends = common.doc_slices([list(words_of(t)) for t in texts])
            ids = cache.lookup(flat)
            value = np.append(cache.values[ids, 0], self.bias)
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            best = np.maximum.reduceat(value, np.minimum(starts, len(value) - 1)) if len(ends) else np.zeros(0)
            best = np.where(ends > starts, best, self.bias)
            return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -40, 40)))

        return score


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]], most: int) -> list[str]:
    """Words whose documents are toxic far more often than chance, by the likelihood ratio of a 2 x 2 table."""
    t, c = Counter(w for d in toxic for w in d), Counter(w for d in clean for w in d)
    nt, nc = max(len(toxic), 1), max(len(clean), 1)

    def gain(a: int, b: int) -> float:
        total = 0.0
        for x, e in ((a, (a + b) * nt / (nt + nc)), (b, (a + b) * nc / (nt + nc))):
            total += x * np.log(x / e) if x else 0.0
        return total

    ranked = sorted(((gain(n, c[w]), w) for w, n in t.items() if len(w) >= DEPTH and n / nt > 3 * c[w] / nc), key=lambda x: (-x[0], x[1]))
    return [w for g, w in ranked[:most] if g >= 2.5]


def fit(texts: list[str], labels: list[int], most: int = 48, rounds: int = 4, penalty: float = 0.5) -> Model:
    """Alternate between witnesses and a linear machine in the landmarks' feature space; see the module's docstring.

    Equal training texts count once. Without both classes the score is a constant.
    """
    seen = dict(zip(texts, labels, strict=True))
    docs = [({p for t in words_of(s) for p in parts(letters(t)) if len(p) >= DEPTH}, y) for s, y in seen.items()]
    toxic, clean = [d for d, y in docs if y and d], [d for d, y in docs if not y and d]
    chosen = choose_landmarks(toxic, clean, most)
    if not toxic or not clean or not chosen:
        return Model([], np.zeros(0), 0.0, 1.0, 0.0 if not labels else (4.0 if all(labels) else -4.0))
    marks = Landmarks(chosen)
    count = Counter(w for d in clean for w in d)
    vocab = sorted(set().union(*toxic) | {w for w, _ in count.most_common(120_000)})
    index = {w: i for i, w in enumerate(vocab)}
    k = marks.matrix(vocab)
    values, vectors = np.linalg.eigh(marks.matrix(marks.words))
    half = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    phi = k @ half
    bent = marks.matrix([w[:i] + x + w[i:] for w in marks.words for i in range(1, len(w)) for x in (w[i], "x", "*")]) @ half
    bags = [np.array([index[w] for w in d]) for d in toxic]
    told = {index[w] for w in marks.words}  # landmarks are words of toxic sentences far beyond chance: always witnesses
    sure = [np.array([i for i in x if i in told], int) for x in bags]
    negative = np.array(sorted(index[w] for w in count if w in index))
    w, b = half @ np.ones(len(marks.words)), -0.5
    for _ in range(rounds):
        f = phi @ w + b
        positive = np.concatenate([np.union1d(y, x[[np.argmax(f[x])]]) for x, y in zip(bags, sure, strict=True)]).astype(int)
        hard = negative[np.argsort(-f[negative], kind="stable")[: max(4000, 4 * len(positive))]]
        x = np.concatenate([phi[positive], bent, phi[hard]])
        y = np.concatenate([np.ones(len(positive) + len(bent)), -np.ones(len(hard))])
        w, b = machine(x, y, penalty)
    f = phi @ w + b
    top = np.array([f[[index[p] for p in d if p in index]].max(initial=b) for d, _ in docs])
    truth = np.array([y for _, y in docs], float)
    slope, shift = platt(top, truth)
    return Model(marks.words, half @ w, float(b), slope, shift)


def machine(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 25) -> tuple[np.ndarray, float]:
    """Linear support vector machine on the squared hinge loss, by Newton steps over the rows inside the margin."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.diag(np.r_[np.full(x.shape[1], penalty), 1e-3])
    for _ in range(steps):
        inside = y * (x1 @ w) < 1
        a = x1[inside]
        new = np.linalg.solve(ridge + a.T @ a, a.T @ y[inside])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def platt(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve for decision values, by Newton steps with a small ridge."""
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * f + c, -30, 30)))
        r, v = y - p, p * (1 - p)
        g = np.array([(r * f).sum() - 1e-2 * a, r.sum() - 1e-2 * c])
        h = np.array([[(v * f * f).sum() + 1e-2, (v * f).sum()], [(v * f).sum(), v.sum() + 1e-2]])
        d = np.linalg.solve(h, g)
        a, c = a + np.clip(d[0], -2, 2), c + np.clip(d[1], -2, 2)
    return float(max(a, 1e-3)), float(c)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", per_class: int = 1500, max_chars: int = 20_000) -> Model:
    """Fit on at most `per_class` labelled documents of each class (both bounds are parameters)."""
    found = common.sampled_labels(labels, label, allowed, per_class)
    rows = common.sample_texts(docs, list(found), 2 * per_class, max_chars, ["doc_id", "text"]).sort_values(["doc_id", "text"])
    return fit(rows.text.tolist(), [found[i] for i in rows.doc_id])
