"""Filter audit, chat formatting and lexical search against brute force and on odd tables."""

import hashlib
import math
import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from cinderlane.llm import chat, filter_audit, lexical, queries

DATA = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels conversations".split()
ODD = [None, "", "   ", "a", "word", "x " * 30_000, "Σας ΝΑΙ", "A|B C", "<|im_end|> x", "\x1c\x00 ctl", "日本語 123", "😀 🇫🇷", "z" * 200_000]


def as_set(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_chat", "op13_lexical"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert as_set(got.collect()) == as_set(want) and len(want) > 9


# --- filter audit


def audit_by_hand(rows):
    """rows: (part, failing letters, good, toxic)."""
    out = {}
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for i, f in enumerate(order):
                gone, left = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                fails = [r for r in own if f in r[0]]
                out[part, "".join(order), i + 1] = [len(left), len(gone), len(fails) - len(gone), sum(r[0] == f for r in fails), sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for f in "ABCDE":
            at = [k for k in out if k[0] == part and k[1][k[2] - 1] == f]
            total = sum(out[k][1] for k in at)
            for k in at:
                out[k].append(total)
    return {k: tuple(v) for k, v in out.items()}


def test_audit_of_every_combination(spark):
    rng = random.Random(3)
    rows = [(p, "".join(f for f in "ABCDE" if rng.random() < q), int(rng.random() < 0.3), int(rng.random() < 0.2)) for p, q in (("en", 0.4), ("", 0.1), ("none", 0.0)) for _ in range(60)]
    frame = spark.createDataFrame([(i, p, g, t, *[f in fails for f in "ABCDE"]) for i, (p, fails, g, t) in enumerate(rows)], "id long, part string, good int, toxic int, " + ", ".join(f"{f} boolean" for f in "ABCDE"))
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.audit(frame, list("ABCDE")).collect()}
    assert got == audit_by_hand(rows) and len(got) == 3 * 600


def test_audit_of_odd_tables(spark):
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, 0.1, "x") for i, t in enumerate(ODD)] + [(3, "a", "en", 0.2, "y"), (20, "a", "en", 0.3, "z"), (None, "a", "en", 0.4, "w")], "doc_id long, text string, lang string, part double, id string")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (20, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    space = " \t\n\x0b\x0c\r"

    def fails(doc_id, text):
        words = [w for w in "".join(" " if c in space else c for c in text or "").split(" ") if w]
        again = doc_id is not None and any(d is not None and d < doc_id and (x or "") == (text or "") for d, x in texts)
        return "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * sum("A" <= c <= "Z" for c in text or "") > 3 * len(text or "")) + "D" * any(c in "#$%&*|" for c in text or "") + "E" * again

    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(r.lang or "", fails(r.doc_id, r.text), int(r.doc_id == 3), int(r.doc_id in (3, 20))) for r in docs.collect()]
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.filter_audit(docs, labels).collect()}
    assert got == audit_by_hand(rows)
    assert filter_audit.filter_audit(docs.limit(0), labels).isEmpty()
    assert filter_audit.filter_audit(docs, labels.limit(0)).filter("good_lost + toxic_lost > 0").isEmpty()
    with pytest.raises(ValueError, match="seven"):
        filter_audit.audit(docs, list("ABCDEFGH"))


# --- chat


@given(st.text(st.sampled_from("<|\\im_endstar>\nx"), max_size=30), st.text(st.sampled_from("<|\\im_endstar>\nx"), max_size=30))
def test_turns_come_back(role, text):
    piece, lo, hi = chat.format_turn(role, text)
    assert chat.parse(piece + piece) == [(role, text)] * 2
    assert chat.unescape(piece[lo:hi]) == text and piece.count(chat.START) == piece.count(chat.END) == 1
    with pytest.raises(ValueError, match="no turn"):
        chat.parse(piece + "x")


def random_conversations(spark, seed=5):
    rng, rows = random.Random(seed), []
    for conv in range(120):
        n = rng.choice([1, 2, 3, 5, 40]) if conv % 10 else 60
        rows += [(conv, i, ("user", "assistant")[i % 2], f"t{rng.randrange(2 if conv % 3 else 1)} <|im_end|>") for i in range(n)]
    rows += [(500, i, "user", "long one " * 9) for i in range(700)]  # one conversation with a third of all rows
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rows


def test_tree_shares_first_turns_and_attends_to_ancestors(spark):
    frame, rows = random_conversations(spark)
    nodes, members = chat.tree(frame.repartition(7))
    nodes, members = nodes.orderBy("start").collect(), members.collect()
    paths = {}
    for conv, _, role, text in rows:
        paths.setdefault(conv, []).append((role, text))
    prefixes = {tuple(p[: i + 1]) for p in paths.values() for i in range(len(p))}
    assert len(nodes) == len(prefixes)  # each shared turn once
    sequence = "".join(n.text for n in nodes)
    at = 0
    for n in nodes:  # no gaps, position = tokens attended to
        assert n.start == at and n.chars == len(n.text)
        at += n.chars
        assert n.position == sum(a.hi - a.lo for a in n.ancestors) and all(a.hi <= n.start for a in n.ancestors)
    by_start = {n.start: n for n in nodes}
    seen = {}
    for m in members:
        n = by_start[m.start]
        path = paths[m.conv_id][: m.k]
        assert "".join(sequence[a.lo : a.hi] for a in n.ancestors) + n.text == "".join(chat.format_turn(*t)[0] for t in path)
        assert n.tree == min([a.lo for a in n.ancestors] + [n.start])
        assert (n.loss_lo is None) == (path[-1][0] != "assistant")
        assert n.loss_lo is None or chat.unescape(sequence[n.loss_lo : n.loss_hi]) == path[-1][1]
        seen[m.conv_id, m.k] = 1
    assert len(seen) == len(rows)
    # depth first: a subtree is one stretch of the sequence
    spans = {}
    for m in members:
        path = tuple(paths[m.conv_id][: m.k])
        for i in range(len(path)):
            lo, hi, own = spans.get(path[: i + 1], (m.start, m.start, set()))
            own.add(m.start)
            spans[path[: i + 1]] = min(lo, m.start), max(hi, m.start), own
    assert all(sum(by_start[s].chars for s in own) == hi + by_start[hi].chars - lo for lo, hi, own in spans.values())


def test_chat_of_odd_tables(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, "<|im_start|>"), (1, 1, "a\nb\\", "same"), (1, 1, "a\nb\\", "same"), (None, 1, "assistant", "null id"), (None, None, "user", "x"), (2, 1, "assistant", "z" * 300_000), (3, 0, "assistant", "<\\|im_end|>"), (3, 1, "assistant", "|>")]
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, start int, node string")
    got = {r.conv_id: r for r in chat.read_back(*chat.tree(frame)).collect()}
    want = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    for conv, turns in want.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert got[conv].n_turns == len(turns) and got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_chars == len(learned) and got[conv].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv].formatted_chars == sum(len(chat.format_turn(*t)[0]) for t in turns)
    assert len(got) == len(want)
    assert chat.read_back(*chat.tree(frame.limit(0))).isEmpty()


# --- lexical search


def search_by_hand(docs, items, k=10):
    found = [(d, Counter(lexical.terms_of(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, n_terms, df = len(found), sum(n for _, _, n in found), Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c, n in found:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(lexical.terms_of(text)) if t in c)
            if s > 0:
                rows.append((-s, d is None, d, s))
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:k])]
    return Counter(out)


def test_search_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(300)], k=rng.choice([1, 3, 20, 200, 2000]))) for _ in range(250)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 - i, texts[3]) for i in range(60)] + [(7, "w1 w2"), (None, texts[4]), (None, None)] + [(2000 + i, t) for i, t in enumerate(ODD)]
    items = [(i, " ".join(rng.sample(words, rng.choice([1, 5, 30])))) for i in range(40)] + [(0, texts[3]), (0, texts[3]), (None, "w1"), (50, None), (51, "WORD Σας unknown"), (52, "x a"), (53, texts[100])]
    frame = spark.createDataFrame([(d, t, 1, "q", 0.5) for d, t in docs], "doc_id long, text string, item_id int, query string, score double").repartition(5)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    want = search_by_hand(docs, items)
    assert as_set(lexical.search(frame, asked).collect()) == want
    monkeypatch.setattr(lexical, "SENT", 0)  # texts meet candidates in a shuffled join, queries in several blocks
    assert as_set(lexical.search(frame, asked, block=20).collect()) == want
    assert lexical.search(frame.limit(0), asked).isEmpty() and lexical.search(frame, asked.limit(0)).isEmpty()


@pytest.mark.parametrize("size", [1, 7, 300, 5000])
def test_bounds_never_fall_short_and_exclude_most(size):
    rng = np.random.default_rng(size)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, size) % 20_000) for _ in range(40)]
    found = [Counter(lexical.terms_of(t)) for t in texts]
    items = [[f"w{int(x)}" for x in rng.zipf(1.3, 20) % 20_000] for _ in range(30)]
    df = Counter(t for c in found for t in c)
    q = lexical.Queries(items, df, len(texts), sum(c.total() for c in found))
    exact = np.array([q.score(t, range(len(items))) for t in texts]).T
    total, over = 0, 0
    for c, col in zip(found, exact.T, strict=True):
        levels = np.searchsorted(lexical.LEVELS, np.array(list(c.values())), "right")
        width = lexical.width_for(int(levels.sum()))
        block = lexical._Block(width)
        h = np.array([lexical.xxhash.xxh64_intdigest(t) for t in c], np.uint64)
        which, level = np.nonzero(np.arange(levels.max())[None, :] < levels[:, None])
        block.add(1, c.total(), lexical.positions(h[which], level, width).ravel())
        bound = q.bounds(width, np.array([c.total()]), block.row()["bits"])[:, 0]
        assert (bound >= col).all()
        total, over = total + len(col), over + int((bound > 1.3 * col + 1).sum())
    assert over < 0.25 * total


def test_every_level_is_reached():
    tf = np.array([1, 2, 3, 4, 5, 6, 1 << 20, 1 << 22])
    assert np.searchsorted(lexical.LEVELS, tf, "right").tolist() == [1, 2, 3, 4, 4, 5, len(lexical.LEVELS), len(lexical.LEVELS)]
    assert (np.diff(lexical.LEVELS) > 0).all()
