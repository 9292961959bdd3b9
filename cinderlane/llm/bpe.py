"""BPE encoding and decoding: speculate with greedy longest matches, verify pairs, merge exactly only where that fails.

A sequence of tokens is what byte-pair merging gives exactly if each two neighbours are: if merging the two tokens'
joined symbols gives these two tokens again. So a greedy longest match proposes each word's tokens, all pairs of
neighbours of a batch are checked at once by undoing merges on both sides of the boundary, latest merge first, and
only words with a failing pair are merged rule by rule. Results of distinct white-space tokens are kept for the batch,
as no rule of the vocabulary crosses white space.
"""

from __future__ import annotations

import gc
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common

NONE = np.iinfo(np.int64).max
#: Words of more characters are proposed and merged one at a time, in lists instead of padded matrices.
LONG = 256
BASE, END = 0x100000001B3, 3
BASE64 = np.uint64(BASE)


def byte_alphabet() -> list[str]:
    """The printable stand-in for each byte in byte-level vocabularies: itself if printable, else 256 and up."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A tokenizers file with NFC and lower-casing, a splitting pattern, byte-level symbols and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.rules = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.bytes = byte_alphabet()
        self.longest = max(map(len, self.ids))
        self._index()

    def symbols(self, token: str) -> list[str]:
        """A token's base symbols: its characters, the last one with the end mark if it has one."""
        if self.end and token.endswith(self.end) and token != self.end:
            stem = token[: -len(self.end)]
            return [*stem[:-1], stem[-1] + self.end]
        return list(token)

    def _index(self) -> None:
        """Arrays by token id: the rank of the merge that makes it (-1 for base symbols), its left and right part."""
        n = max(self.ids.values()) + 1
        self.rank, self.left, self.right = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        base = {s for t in self.ids for s in self.symbols(t)[:1] + self.symbols(t)[-1:] if len(self.symbols(t)) == 1}
        for (a, b), r in self.rules.items():
            i = self.ids[a + b]
            if a + b not in base and self.rank[i] < 0:
                self.rank[i], self.left[i], self.right[i] = r, self.ids[a], self.ids[b]
        keys = np.array([self.ids[a] * n + self.ids[b] for a, b in self.rules], np.int64)
        order = np.argsort(keys)
        self.n, self.keys, self.key_ranks = n, keys[order], np.fromiter(self.rules.values(), np.int64, len(keys))[order]
        # a token that merging its own symbols doesn't give is never proposed
        self.made = np.array([self.ids[a + b] for a, b in self.rules], np.int64)  # by rank
        made = np.flatnonzero(self.rank >= 0)
        sound = set(made[self.compatible(self.left[made], self.right[made], self.rank[made])].tolist())
        self.proposed = {t: i for t, i in self.ids.items() if i in sound or t in base}

        self.symbol = np.array([self.ids.get(chr(i), -1) for i in range(512)], np.int64)
        self.last_symbol = np.array([self.ids.get(chr(i) + self.end, -1) for i in range(512)], np.int64)
        self.rank_of: dict[int, int] | None = None  # ranks by key, for long words only
        self._hashes()

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.key_ranks[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """For pairs of token ids: would merging leave this boundary alone (until the rank `below`)?

        Undoes merges from the latest: at each moment, a rule for the two symbols at the boundary that ranks before
        the merge that was done next would have crossed it. Equal rules apply from the left.
        """
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        limit = np.full(len(a), NONE) if below is None else below.astype(np.int64).copy()
        good, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            bad = self.pair_rank(a[live], b[live]) < limit[live]
            good[live[bad]] = False
            live = live[~bad]
            ra, rb = self.rank[a[live]], self.rank[b[live]]
            from_left = ra > rb
            more = (ra >= 0) | (rb >= 0)
            i, j = live[more & from_left], live[more & ~from_left]
            limit[i], a[i] = self.rank[a[i]], self.right[a[i]]
            limit[j], b[j] = self.rank[b[j]] + 1, self.left[b[j]]
            live = live[more]
        return good

    def merge_all(self, s: np.ndarray, out: np.ndarray, where: np.ndarray) -> None:
        """Exact merging of many words at once, rows of base symbols s padded with -1, into rows `where` of out.

        In each round every word merges its lowest-ranked, leftmost pair, so each row loses one column; rows without a
        rule left are done.
        """
        ranks = self._ranks(s[:, :-1], s[:, 1:])
        while len(s):
            if not ranks.shape[1]:
                out[where, : s.shape[1]] = s
                return
            k = ranks.argmin(1)
            go = ranks[np.arange(len(s)), k] < NONE
            out[where[~go], : s.shape[1]] = s[~go]
            where, s, k, ranks = where[go], s[go], k[go], ranks[go]
            r = np.arange(len(s))
            s[r, k] = self.made[ranks[r, k]]
            keep = np.ones(s.shape, bool)
            keep[r, k + 1] = False
            s = s[keep].reshape(len(s), keep.shape[1] - 1)
            ranks = ranks[keep[:, 1:]].reshape(len(s), keep.shape[1] - 2)  # the rank inside the merged token goes
            if ranks.shape[1]:
                left, right = k > 0, k < ranks.shape[1]
                ranks[r[left], k[left] - 1] = self._ranks(s[r[left], k[left] - 1], s[r[left], k[left]])
                ranks[r[right], k[right]] = self._ranks(s[r[right], k[right]], s[r[right], k[right] + 1])

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where((a >= 0) & (b >= 0), self.pair_rank(a, b), NONE)

    def encode_long(self, word: str) -> np.ndarray:
        """Token ids of one long word: the same greedy proposal and checks, and merging by a heap of ranked pairs."""
        out, at, n = array("q"), 0, len(word)
        while at < n:
            for size in range(min(self.longest, n - at), 0, -1):
                piece = word[at : at + size]
                i = self.proposed.get(piece + self.end if at + size == n else piece)
                if i is not None and (at + size == n or not self.end or not piece.endswith(self.end)):
                    break
            else:
                break
            out.append(i)
            at += size
        found = np.array(out, np.int64)
        if at < n or not self.compatible(found[:-1], found[1:]).all():
            found = self.merge_long(word)
        return found

    def merge_long(self, word: str) -> np.ndarray:
        """Exact merging of one word: the pair of the lowest rank, leftmost first, until no rule is left."""
        if self.rank_of is None:
            self.rank_of = dict(zip(self.keys.tolist(), self.key_ranks.tolist(), strict=True))
        rank_of, n = self.rank_of.get, len(word)
        s = array("q", (int(self.symbol[min(ord(c), 511)]) for c in word))
        s[n - 1] = int(self.last_symbol[min(ord(word[-1]), 511)])
        before, after = array("q", range(-1, n - 1)), array("q", range(1, n + 1))

        def pair(i: int, j: int) -> int | None:
            return rank_of(s[i] * self.n + s[j]) if s[i] >= 0 and s[j] >= 0 else None

        heap = [r << 40 | i for i in range(n - 1) if (r := pair(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 40, top & (1 << 40) - 1
            if s[i] == -2 or (j := after[i]) >= n or pair(i, j) != rank:
                continue
            s[i], s[j], after[i] = int(self.made[rank]), -2, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := pair(i, after[i])) is not None:
                    heapq.heappush(heap, r << 40 | i)
            if before[i] >= 0 and (r := pair(before[i], i)) is not None:
                heapq.heappush(heap, r << 40 | before[i])
        left = np.array(s, np.int64)
        return left[left >= 0]

    def words(self, token: str) -> list[str]:
        """Byte-level words of a white-space token, after normalisation."""
        if not token.isascii():
            token = unicodedata.normalize("NFC", token).replace("Σ", "σ")
        low = token.lower()
        found = [low] if low.isalpha() else self.word.findall(low)
        if low.isascii() and low.isprintable():
            return found
        return ["".join([self.bytes[b] for b in w.encode("utf-8", "surrogatepass")]) for w in found]

    def _hashes(self) -> None:
        """Polynomial hashes of the proposed tokens' characters (END for the word end), in tables without clashes."""
        names = list(self.proposed)
        self.token = np.array([self.proposed[t] for t in names] + [-1], np.int64)
        h = np.zeros(len(names) + 1, np.uint64)
        for i, t in enumerate(names):
            stem, end = (t[: -len(self.end)], True) if self.end and t.endswith(self.end) and t != self.end else (t, False)
            x = 0
            for c in stem:
                x = (x * BASE + ord(c)) % 2**64
            h[i] = (x * BASE + END) % 2**64 if end else x
        self.hash, self.tables, left = h, [], np.arange(len(names))
        while len(left):
            t = np.full(1 << 19, len(names), np.int32)
            slot = self._slot(h[left], len(self.tables))
            t[slot] = left
            left = left[t[slot] != left]
            self.tables.append(t)

    @staticmethod
    def _slot(h: np.ndarray, k: int) -> np.ndarray:
        return ((h * np.uint64(0x9E3779B97F4A7C15 + 2 * k)) >> np.uint64(45)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Token id of each hash, -1 if it is none's."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for k, t in enumerate(self.tables):
            i = t[self._slot(h[left], k)]
            hit = (self.hash[i] == h[left]) & (i < len(self.hash) - 1)
            out[left[hit]] = self.token[i[hit]]
            left = left[~hit]
        return out

    def greedy(self, c: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Longest matches from the left of words given as padded characters: rows of token ids, padded with -1.

        A row whose matches don't end with the word's end has -2 at its head.
        """
        rows, width = c.shape
        out, count, at = np.full((rows, width + 1), -1, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        prefix = np.zeros((rows, width + 1), np.uint64)
        power = np.ones(width + 2, np.uint64)
        for k in range(width):
            prefix[:, k + 1] = prefix[:, k] * BASE64 + c[:, k]
        for k in range(width + 1):
            power[k + 1 : k + 2] = power[k : k + 1] * BASE64
        live = np.arange(rows)
        while len(live):
            rest = n[live] - at[live]
            got, size = np.full(len(live), -1, np.int64), np.zeros(len(live), np.int64)
            for take in range(min(int(rest.max()), self.longest), 0, -1):
                may = np.flatnonzero((got < 0) & (rest >= take))
                if not len(may):
                    continue
                i, r = live[may], rest[may]
                h = prefix[i, at[i] + take] - prefix[i, at[i]] * power[take]
                found = self.find(np.where(r == take, h * BASE64 + np.uint64(END), h))
                got[may], size[may] = found, np.where(found >= 0, take, 0)
            ok = got >= 0
            out[live[~ok], 0] = -2
            live, got, size = live[ok], got[ok], size[ok]
            out[live, count[live]] = got
            count[live] += 1
            at[live] += size
            live = live[at[live] < n[live]]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all byte-level words, one after the other, and where each word's ids end."""
        results, lens = [], np.zeros(len(words), np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(size > LONG):
            out = self.encode_long(words[i])
            lens[i] = len(out)
            results.append((np.array([i]), out[None, :]))
        usual = np.flatnonzero(size <= LONG)
        for at, c, n in common.pad_codes([words[i] for i in usual]):
            at = usual[at]
            c = c[:, : int(n.max(initial=1))]
            out = self.greedy(c, n)
            i, j = np.nonzero((out[:, 1:] >= 0) & (out[:, :-1] >= 0))
            key, back = np.unique(out[i, j] * self.n + out[i, j + 1], return_inverse=True)
            wrong = out[:, 0] == -2
            wrong[i[~self.compatible(key // self.n, key % self.n)[back]]] = True
            again = np.flatnonzero(wrong)
            if len(again):
                s = np.where(c[again] > 0, self.symbol[np.minimum(c[again], 511)], -1)
                last = (np.arange(len(again)), n[again] - 1)
                s[last] = self.last_symbol[c[again][last]]
                out[again] = -1
                self.merge_all(s, out, again)
            lens[at] = (out >= 0).sum(1)
            results.append((at, out))
        ends = np.cumsum(lens)
        flat = np.zeros(int(lens.sum()), "<u4")
        for at, out in results:
            i, j = np.nonzero(out >= 0)
            flat[(ends - lens)[at][i] + j] = out[i, j]
        return flat, ends


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: What ends a token in the vocabulary's pattern but isn't white space to it: str.split() would cut there.
_separators = regex.compile("[\x1c-\x1f]")
_space = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


class Encoder:
    """Encodes and decodes texts; keeps the results of distinct white-space tokens, emptied beyond `most`."""

    def __init__(self, path: str, most: int = 120_000):
        self.v, self.most = vocabulary(path), most
        self.ids: dict[str, bytes] = {}
        self.names: dict[str, str] = {}

    def learn(self, tokens: set[str]) -> None:
        if len(self.ids) > self.most:
            self.ids.clear()
            self.names.clear()
        new = [t for t in tokens if t not in self.ids]
        index: dict[str, int] = {}
        at: list[int | list[int]] = []
        for t in new:
            low = t.lower()
            if low.isascii() and low.isalpha():
                at.append(index.setdefault(low, len(index)))
            else:
                k = [index.setdefault(w, len(index)) for w in self.v.words(t)]
                at.append(k[0] if len(k) == 1 else k)
        flat, ends = self.v.encode_words(list(index))
        name = list(map(self.v.names.__getitem__, flat.tolist()))
        raw, cut = flat.tobytes(), [0, *ends.tolist()]
        packed = [raw[4 * a : 4 * b] for a, b in zip(cut, cut[1:], strict=False)]
        named = [" ".join(name[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
        for t, k in zip(new, at, strict=True):
            if isinstance(k, int):
                self.ids[t], self.names[t] = packed[k], named[k]
            else:
                self.ids[t] = b"".join([packed[i] for i in k])
                self.names[t] = " ".join([named[i] for i in k])

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        runs, tokens = [], set()
        for t in texts:
            pieces = self.v.special_re.split(t) if t and "<|" in t else [t or ""]
            run = [w for p in pieces for w in self.cut(p)] if len(pieces) > 1 else self.cut(pieces[0])
            runs.append(run)
            tokens.update(run)
        self.learn(tokens - self.v.special.keys())
        for t, i in self.v.special.items():
            self.ids[t], self.names[t] = np.array([i], "<u4").tobytes(), t
        ids, names = self.ids.__getitem__, self.names.__getitem__
        return [(b"".join(map(ids, run)), " ".join(filter(None, map(names, run)))) for run in runs]

    def cut(self, piece: str) -> list[str]:
        if piece in self.v.special:
            return [piece]
        return [x for x in _space.split(piece) if x] if _separators.search(piece) else piece.split()


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """docs with ids (little-endian unsigned 32-bit integers, packed) and decoded (columns of these names replaced).

    Every row is kept, repeated rows too, and so are columns of any other name; an empty table gives an empty result.
    Null texts count as empty and give no ids and an empty text. A text or a word of any length is encoded whole. The
    strings of special tokens in a text are these tokens. The vocabulary has no decoder: decoding joins token strings
    by spaces. Only texts go to Python and only ids and decoded texts come back.
    """

    @F.arrow_udf("ids binary, decoded string")
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        was_on = gc.isenabled()
        gc.disable()  # millions of small strings and no cycles: collecting costs a third of the time
        try:
            e = Encoder(path)
            for texts in columns:
                for part in common.slices(texts, 1_000_000):
                    found = e.encode(part)
                    yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.string())], names=["ids", "decoded"])
        finally:
            if was_on:
                gc.enable()

    kept = docs.drop("ids", "decoded")
    row = F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row")
    out = kept.select(row, encode(F.col("text").cast("string")).alias("coded"))
    return out.select("row.*", "coded.ids", "coded.decoded")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
