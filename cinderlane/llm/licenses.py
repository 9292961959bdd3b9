"""License scans by patience alignment of documents with license templates.

A template's words anchor where they are unique in both the text's window and the template; the longest increasing
subsequence of these anchors is kept, and the gaps between anchors are aligned the same way (equal words at either end
of a gap match directly). Coverage is the share of the template's words so aligned. Windows are found first: a
two-pointer pass over the places of template words marks stretches that hold enough different ones.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

# Notices as their licenses word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "all-rights-reserved": "All rights reserved.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
}
_word = re.compile(r"\w+(?:\.\d+)*")


def words(text: str) -> list[str]:
    return _word.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (sorted by the first place) whose second places increase, by patience piles."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        back[i] = at[k - 1] if k else -1
        tops[k : k + 1], at[k : k + 1] = [y], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), increasing in both. Gaps are kept on a stack, so depth doesn't matter."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        al, ah, bl, bh = todo.pop()
        while al < ah and bl < bh and a[al] == b[bl]:
            out.append((al, bl))
            al, bl = al + 1, bl + 1
        while al < ah and bl < bh and a[ah - 1] == b[bh - 1]:
            ah, bh = ah - 1, bh - 1
            out.append((ah, bh))
        if al >= ah or bl >= bh:
            continue
        ca, cb = Counter(a[al:ah]), Counter(b[bl:bh])
        where = {w: i for i, w in enumerate(b[bl:bh], bl) if cb[w] == 1}
        anchors = increasing([(i, where[a[i]]) for i in range(al, ah) if ca[a[i]] == 1 and a[i] in where])
        for i, j in anchors:
            out.append((i, j))
            todo.append((al, i, bl, j))
            al, bl = i + 1, j + 1
        if anchors:
            todo.append((al, ah, bl, bh))
    return sorted(out)


def best_apart(found: list[tuple]) -> list[tuple]:
    """Of places that overlap, the one of the highest coverage (then of the most words, then the first name)."""
    kept: list[tuple] = []
    starts: list[int] = []
    for x in sorted(found, key=lambda x: (-x[1], -x[4], x[0], x[2])):
        k = bisect_left(starts, x[2])
        if (k and kept[k - 1][3] >= x[2]) or (k < len(kept) and kept[k][2] <= x[3]):
            continue
        kept.insert(k, x)
        starts.insert(k, x[2])
    return kept


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self.least = least
        self.templates = {n: w for n, t in sorted(templates.items()) if (w := words(t))}
        # a text that covers `least` of a template has one of these words: more than the words that it may lack
        self.keys: dict[str, list[str]] = {}
        for n, w in self.templates.items():
            rare, own = sorted(set(w), key=lambda x: (-len(x), x)), Counter(w)
            spare, keys = len(w) - least * len(w), []
            while rare and sum(own[k] for k in keys) <= spare:
                keys.append(rare.pop(0))
            self.keys[n] = keys

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, first word, last word, aligned words) of each place found, in order."""
        low = (text or "").lower()
        names = [n for n in self.templates if any(k in low for k in self.keys[n])]
        if not names:
            return []
        found, out = words(low), []
        for n in names:
            w = self.templates[n]
            own, span = Counter(w), len(w) + len(w) // 2 + 2
            hits = [i for i, x in enumerate(found) if x in own]
            have: Counter = Counter()
            total, lo, free = 0, 0, -1
            for hi, i in enumerate(hits):
                have[found[i]] += 1
                total += have[found[i]] <= own[found[i]]
                while hits[lo] <= free or i - hits[lo] >= span:
                    total -= have[found[hits[lo]]] <= own[found[hits[lo]]]
                    have[found[hits[lo]]] -= 1
                    lo += 1
                    if lo > hi:
                        break
                if total < self.least * len(w) or i <= free:
                    continue
                if total < len(w) and hi + 1 < len(hits) and hits[hi + 1] - hits[lo] < span:
                    continue  # the next word still fits the window and may add to it
                first = hits[lo]
                pairs = align(found[first : i + 1], w)
                if pairs and len(pairs) >= self.least * len(w):
                    free = first + pairs[-1][0]
                    out.append((n, len(pairs) / len(w), first + pairs[0][0], free, len(pairs)))
        return best_apart(out)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """doc_id, license, coverage, first_word, last_word, matched: one row for each place of a license in a document.

    Whole texts are read; words are numbered from 0. Null and empty texts have no rows; repeated rows repeat theirs.
    """
    chosen = TEMPLATES if templates is None else templates

    def run(batches):
        s = Scanner(chosen, least)
        for b in batches:
            rows = [(i, *r) for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True) for r in s.scan(t.as_py())]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            types = (b.schema.field(0).type, pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "license", "coverage", "first_word", "last_word", "matched"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, license string, coverage double, first_word int, last_word int, matched int")
