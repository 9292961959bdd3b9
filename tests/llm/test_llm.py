"""The operators against brute force, the tokenizers library and held-out labels, and their edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cinderlane.llm import bpe, common, components, exact_dedup, langid, licenses, lm, mixing, neardup, quality, queries, simhash, topk, toxicity

DATA = "/root/testdata/sf0.001"
BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", "   ", "a", "word", "x " * 30_000, "Σας ΝΑΙ", "d'été l'heure", "<|endoftext|> x", "\x1c\x00 ctl", "日本語 123", "😀 🇫🇷"]


def odd_docs(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(3, "a", "en", "s", 0), (None, "null id", None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()


# --- SimHash


def naive_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_components(ids, fps, bits):
    root = {i: i for i in range(len(fps))}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and top(i) != top(j):
                root[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [least.get(top(i)) for i in range(len(ids))]


def test_simhash_against_brute_force(spark, docs):
    got = {r.doc_id: r for r in simhash.simhash_components(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    fps = [naive_fingerprint(r.text) for r in rows]
    assert [got[r.doc_id].fingerprint for r in rows] == [f"{f:016x}" for f in fps]
    assert [got[r.doc_id].component_id for r in rows] == naive_components([r.doc_id for r in rows], fps, 4)


def test_links_of_planted_fingerprints_with_long_lists(spark, monkeypatch):
    rng = random.Random(8)
    fps = []
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.append(f)
        for _ in range(rng.randrange(4)):
            for b in rng.sample(range(64), rng.choice([3, 4, 5])):
                f ^= 1 << b
            fps.append(f)
    center = rng.getrandbits(64)
    fps += [center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = naive_components(signed, fps, 4)
    for block in (2048, 16):
        monkeypatch.setattr(simhash, "BLOCK", block)
        edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4)
        found = {r.node: r.root for r in components.connected_components(edges).collect()}
        assert [found.get(s, s) for s in signed] == want


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200) if i % 50] + [(7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert got == {i: (i - 1) // 50 * 50 + 1 for i in range(1, 201)}
    assert components.connected_components(edges.limit(0)).isEmpty()


def test_near_duplicates_of_edited_texts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows, copies = [], []
    for k in range(60):
        words = [word() for _ in range(300)]
        rows.append((10 * k, " ".join(words)))
        for i in range(1, 4):  # one edit takes five shingles: five edits leave 0.85, forty leave 0.2
            new = list(words)
            for at in rng.sample(range(300), 5 if i < 3 else 40):
                new[at] = word()
            rows.append((10 * k + i, " ".join(new)))
            copies += [(10 * k, 10 * k + i)] * (i < 3)
    base = [word() for _ in range(200)]
    rows += [(5000 + i, " ".join([*base[:i], "edit", *base[i:]])) for i in range(190)]
    rows += [(7000 + i, t) for i, t in enumerate(ODD)] + [(7004, "word"), (None, "word"), (None, "alone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = neardup.near_duplicates(frame).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r.component_id for r in out}
    assert sum(got[a] == got[b] for a, b in copies) >= 0.95 * len(copies)
    assert all(got[10 * k + 3] == 10 * k + 3 for k in range(60))
    assert {got[5000 + i] for i in range(190)} == {5000}
    assert all(got[7000 + i] == 7000 + i for i in range(len(ODD)))
    assert sorted(str(r.component_id) for r in out if r.doc_id is None) == ["7004", "None"]
    assert neardup.near_duplicates(frame.limit(0)).isEmpty()


@pytest.mark.parametrize("n", [45, 120, 400, 1000])
def test_recall_of_lists_and_filters_at_the_limit(n):
    """Pairs of exactly 0.8: how many share a list and pass both filters."""
    rng, pairs, found = np.random.default_rng(n), 1000, 0
    shared = n * 8 // 9
    for _ in range(pairs):
        h = rng.integers(0, 2**64, shared + 2 * (n - shared), np.uint64)
        a, b = (neardup.wide_fingerprint(x) for x in (h[:n], np.r_[h[:shared], h[n:]]))
        same = (a.view(np.uint8) == b.view(np.uint8))[neardup.CHOICES].all(1).any()
        bits = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))
        found += bool(same and bits[0] <= neardup.FAR and bits.sum() <= neardup.most_bits(0.8, 3))
    print(n, found / pairs)
    assert found >= 0.88 * pairs


def test_near_duplicates_of_a_large_family(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = [word() for _ in range(300)]
    texts = [list(base) for _ in range(1001)]
    for new in texts[1:]:
        for at in rng.sample(range(300), 5):
            new[at] = word()
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    assert set(root) == {0}
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(neardup, "BLOCK", 16, raising=False)  # lists in several blocks
    got = [r.component_id for r in neardup.near_duplicates(frame).collect()]
    assert got.count(0) >= 0.95 * len(texts)


# --- exact dedup


def test_exact_dedup(spark):
    long = "long text " * 9000
    texts = ["a  b", "a\tb", "a b", None, "", long, long + "x", long, "a b c", long + "x", "q" * 64, "q" * 64, "q" * 65, "q" * 512]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(0, "a b", "en", "s", 0), (None, "", "en", "s", 0)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS), carry=["text"]).collect()
    import re

    clean = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(clean(t), []).append(d)
    assert len(got) == len(rows)
    for r in got:
        own = groups[clean(r.doc_text)]
        assert r.group_size == len(own) and r.keep_id == min(x for x in own if x is not None)
        assert r.text_sha256 == hashlib.sha256(clean(r.doc_text).encode()).hexdigest()
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(spark.createDataFrame([], DOCS)).isEmpty()


# --- top k


def test_top_k_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 3, 4) / 4], 0) for i in range(120)]
    rows += [(200, None, 0), (250, [float("nan")] * 4, 0), (300, [1.0, None, 0.0, 0.0], 0), (350, [1.0], 0), (None, [1.0] * 4, 0)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), F.col("vec_id") % 50 == 0).collect()
    ok = {i: [math.floor(x * 256) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and x == x for x in v)}
    want = []
    for q in (i for i in ok if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ok[q], v, strict=False)), i) for i, v in ok.items() if i != q)
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).isEmpty()


def test_top_k_of_repeated_rows(spark):
    rows = [(50, [1.0]), (50, [1.0]), (7, [2.0]), (8, [3.0]), (8, [3.0]), (9, [0.5]), (50, [2.5])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    ints = [(i, int(v[0] * 256)) for i, v in rows]
    want = []
    for n, (i, v) in enumerate(ints):
        if i == 50:
            scored = sorted((-v * w, j) for m, (j, w) in enumerate(ints) if m != n)[:5]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    with pytest.raises(OverflowError):
        topk.top_k(spark.createDataFrame([(50, [1e12, 1e12])], "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)


# --- BPE


def test_bpe_equals_the_library(spark, docs):
    tokenizer = Tokenizer.from_file(BPE)
    both = docs.unionByName(odd_docs(spark)).select("doc_id", "text")
    for r in bpe.encode_decode(both, BPE).collect():
        want = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == tokenizer.decode(want, skip_special_tokens=False)


def test_greedy_needs_the_check():
    v = bpe.vocabulary(BPE)
    words = [w for w in ("thionble", "edreou", "heedbleea", "rerheat", "the", "a") if w]
    flat, ends = v.encode_words(words)
    want = [Tokenizer.from_file(BPE).encode(w, add_special_tokens=False).ids for w in words]
    assert [flat[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)] == want


def test_bpe_of_long_words():
    t, e = Tokenizer.from_file(BPE), bpe.Encoder(BPE)
    rng = random.Random(2)
    words = ["".join(rng.choices("etaoinshrdlu", k=n)) for n in (255, 256, 257, 3000)] + ["ab" * 700, "日本語" * 400, "é" * 999, "thequickbrownfox" * 60]
    for w, (ids, _) in zip(words, e.encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(w, add_special_tokens=False).ids
    one = "".join(rng.choices("etaoinshrdlu", k=200_000))
    assert np.frombuffer(e.encode([one])[0][0], "<u4").tolist() == t.encode(one, add_special_tokens=False).ids


# --- language model


def naive_word(lattice, logp, word):
    w, a = lm.MARK + word, [0.0]
    for e in range(1, len(w) + 1):
        xs = [a[s] + logp[w[s:e]] for s in range(max(0, e - lattice.longest), e) if w[s:e] in logp]
        if w[e - 1] not in logp:
            xs.append(a[e - 1] + sum(lattice.logp[lattice.byte_ids[b]] for b in w[e - 1].encode()))
        top = max(xs)
        a.append(top + math.log(sum(math.exp(x - top) for x in xs)))
    return a[-1]


def test_lm_counts_and_scores(spark, docs):
    held = common.remainder_is(10, 0)
    both = docs.select("doc_id", "text").limit(60).unionByName(spark.createDataFrame([(900 + i, t) for i, t in enumerate(ODD)] + [(903, "a")], "doc_id long, text string"))
    rows = both.collect()
    tokens = {i: [*(r.text or "").encode().lower().split(), b""] for i, r in enumerate(rows)}
    out = lambda r: zlib.crc32(str(r.doc_id).encode()) % 10 == 0
    c = Counter(w for i, r in enumerate(rows) if not out(r) for w in tokens[i])
    n, v = sum(c.values()), len(c)
    lattice = lm.Lattice.load(PIECES)
    counts = spark.createDataFrame([(w, k) for w, k in c.items()], "word binary, c long")
    for _ in range(2):
        lattice = lattice.updated(lm.expected_counts(counts, lattice))
    assert np.exp(lattice.logp).sum() == pytest.approx(1)
    logp = {p: x for p, x in zip(lattice.pieces, lattice.logp, strict=True) if p}
    once, twice = (sum(k == x for k in c.values()) for x in (1, 2))
    d = once / (once + 2 * twice)
    pieces = {w: math.exp(naive_word(lattice, logp, w.decode()) if w else lattice.logp[-1]) if len(w) < 99 else 0 for i in tokens for w in set(tokens[i])}
    words = {w: math.log10(max(c[w] - d, 0) / n + d * v / n * p) for w, p in pieces.items()}
    want = sorted(
        (r.doc_id, out(r), len(tokens[i]), sum(c[w] > 0 for w in tokens[i]), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[i]), 5), round(sum(words[w] for w in tokens[i]), 5))
        for i, r in enumerate(rows)
    )
    got = lm.score(both, PIECES, held).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got) == want


# --- classifiers


def test_language_on_held_out_documents(spark):
    got = queries.op8_langid(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    odd = langid.identify(odd_docs(spark), langid.train(odd_docs(spark).limit(0), F.lit(True)))
    assert {r.lang_pred for r in odd.collect()} == {"und"} and odd.count() == len(ODD) + 2
    model = langid.train(spark.read.parquet(f"{DATA}/documents.parquet"), F.lit(True), most=80)
    named = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd_docs(spark), model).collect()}
    assert named[0] == named[1] == named[2] == ("und", 0.0) and 0 <= named[5][1] <= 1


@pytest.mark.parametrize(("name", "label", "least"), [("op2_quality", "quality", 0.9), ("op4_toxicity", "toxic", 0.9)])
def test_classifiers_on_held_out_documents(spark, name, label, least):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col(label) == F.col("predicted")).cast("int"))).first()[0] >= least


def test_classifiers_on_odd_texts(spark):
    labels = spark.createDataFrame([(3, 1, 1), (4, 0, 0), (4, 0, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    for train in (quality.train, toxicity.train):
        for lab in (labels, labels.limit(0)):
            out = quality.score(odd_docs(spark), train(odd_docs(spark), lab, F.lit(True))).collect()
            assert len(out) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in out)


def test_toxicity_tolerates_gaps():
    bad = ["you are a moron today", "what a clown this is", "only a moron would", "that clown again", "some moron came"] * 3
    good = ["a fine day for all", "the morning was cold", "we went to town", "a clear sound came", "more on this later"] * 3
    bad = [f"{t} {i}" for i, t in enumerate(bad)]
    good = [f"{t} {i}" for i, t in enumerate(good)]
    f = toxicity.fit(bad + good, [1] * len(bad) + [0] * len(good)).scorer()
    high = f(["such a moron", "such a morxon", "m o r o n", "m.o.r.o.n he is", "clowwn"])
    assert high.min() > f(["such a fine town", "more on", ""]).max()


# --- licenses


def test_licenses(spark):
    rows = [(1, "Intro. Released under the MIT License. End"), (2, "released UNDER mit License, and All rights reserved. x All rights reserved!"), (3, None), (4, "all the rights"), (5, "word " * 20_000 + "Licensed under CC BY-NC 4.0.")]
    got = {(r.doc_id, r.license, r.first_word, round(r.coverage, 2)) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "mit", 1, 1.0), (2, "mit", 0, 0.8), (2, "all-rights-reserved", 5, 1.0), (2, "all-rights-reserved", 9, 1.0), (5, "cc-by-nc-4.0", 20_000, 1.0)}


def test_alignment_is_increasing_and_equal():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(15))] for _ in "ab")
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    run = licenses.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 4)])
    assert run == [(1, 1), (2, 2), (4, 4)]


# --- mixing


def test_mixing_meets_targets(spark, docs):
    targets = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}
    out = mixing.mix(docs, docs, "lang", targets)
    k = len(out.first().domains)
    got = out.agg(F.min("rate"), F.sum("n_tokens"), *[F.sum(F.col("rate") * F.col("n_tokens") * F.element_at("p", i + 1)) for i in range(k)]).first()
    assert got[0] >= 0
    for name, reached in zip(out.first().domains, got[2:], strict=True):
        assert reached / got[1] == pytest.approx(targets[name], abs=0.01)


def test_mixing_of_odd_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix(empty, empty, "lang").isEmpty()
    rates = mixing.mix(odd_docs(spark), odd_docs(spark), "lang", {"en": 1.0}).collect()
    assert all(r.rate >= 0 and sum(r.p) == pytest.approx(1) for r in rates)


# --- pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "mixed", "encoded"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        new = common.materialise(stage(spark, docs, DATA))
        if name in ("language", "exact", "near"):
            assert new.columns == docs.columns and new.exceptAll(docs).isEmpty()
        counts.append(new.count())
        docs = new
    assert counts[0] >= counts[1] > counts[2] >= counts[3] and counts[4] == counts[5] > 0


def test_stages_keep_rows_of_null_and_repeated_ids(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    a, b, c, d, e = (" ".join(word() for _ in range(120)) for _ in range(5))
    rows = [(1, a), (2, a + " end"), (2, b), (None, c), (None, c + " end"), (None, d), (None, d[7:]), (4, d + " end"), (None, e)]
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], DOCS)
    kept = corpus_pipeline.near(spark, docs, DATA).collect()
    texts = Counter((r.doc_id, r.text) for r in kept)
    one_of_c = [(None, t) for t in (c, c + " end") if (None, t) in texts]
    assert len(one_of_c) == 1 and texts == Counter([(1, a), (2, b), (4, d + " end"), (None, e), *one_of_c])
    mixed = corpus_pipeline.mixed(spark, docs, DATA).collect()  # no language named: all rates are 1
    assert Counter((r.doc_id, r.text) for r in mixed) == Counter(rows)


def test_stages_of_two_tables_in_turn(spark, tmp_path):
    """A stage deletes only what the result that it reads, written, was made from."""
    docs = [spark.createDataFrame([(k + i, f"text {k + i // 2}", "en", "s", 0) for i in range(6)], DOCS) for k in (0, 100)]
    stage = dict(corpus_pipeline.STAGES)["exact"]
    a = stage(spark, docs[0], DATA)
    b = stage(spark, docs[1], DATA)
    assert {r.doc_id for r in a.collect()} == {0, 2, 4}
    a.write.parquet(f"{tmp_path}/a")
    again = spark.read.parquet(f"{tmp_path}/a")
    made = {k: list(v) for k, v in common._scopes.items()}
    next_one = stage(spark, again, DATA)
    gone = made.keys() - common._scopes.keys()
    assert len(gone) == 1 and {r.doc_id for r in next_one.collect()} == {0, 2, 4}  # a's tables, as a was written and read
    assert {r.doc_id for r in b.collect()} == {100, 102, 104}
    chained = stage(spark, b, DATA)  # b was never written: its tables stay
    assert {r.doc_id for r in chained.collect()} == {100, 102, 104} and {r.doc_id for r in b.collect()} == {100, 102, 104}


def test_mixing_keeps_the_share_of_unlisted_domains(spark):
    rng = random.Random(6)
    own = {n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(8)] for n in ("en", "de", "it", "pt")}
    rows = [(i, " ".join(rng.choices(own[n], k=60)), n, "s", 0) for i, n in enumerate(["en"] * 60 + ["de"] * 20 + ["it"] * 15 + ["pt"] * 5)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(docs, docs, "lang", queries.MIX_TARGETS).join(docs.select("doc_id", "lang"), "doc_id")
    got = {r.lang: r.w / 6000 for r in out.groupBy("lang").agg(F.sum(F.col("rate") * F.col("n_tokens")).alias("w")).collect()}
    assert got == pytest.approx({"it": 0.15, "pt": 0.05, "en": 0.8 * 2 / 3, "de": 0.8 / 3}, abs=0.02)


def test_mixing_of_many_domains(spark):
    rows = [(i, f"word{i % 80} " * 60, f"l{i % 80:02}" if i % 80 else "en", "s", 0) for i in range(160)]
    docs = spark.createDataFrame(rows, DOCS)
    members = mixing.learn_domains(docs, "lang", listed=["en"], most_domains=64)
    assert len(members[0]) == 64 and members[0][-1] == "other" and "en" in members[0]
    assert sum(map(math.exp, members[1])) == pytest.approx(1)


def test_rows_of_mixing_are_rows_of_the_table(spark):
    rows = [(1, "ein wort", "de"), (1, "one word", "en"), (None, "two words", "en"), (None, "three", "en"), (1, "ein wort", "de"), (2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    out = mixing.mix(docs, docs, "lang", {"en": 0.5, "de": 0.25, "xx": 0.25}).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in out) == Counter([(1, 2), (1, 2), (1, 2), (None, 2), (None, 1), (2, 0)])
    assert all(r.unmet == ["xx"] and r.goal == pytest.approx([3.0, 6.0]) for r in out)


def test_stages_on_odd_tables(spark):
    kind = DOCS + ", times int, score double, node string, row string, lang_pred string"
    rows = [(i, t, "en", "s", 0, 1, 0.5, "n", "r", "p") for i, t in enumerate(ODD)] + [(None, "null id here", None, None, None, 7, 0.1, "m", "q", None)] * 2
    docs = spark.createDataFrame(rows, kind)
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, DATA)
        assert stage(spark, docs.limit(0), DATA).isEmpty()
        if name != "encoded":
            assert new.columns == docs.columns
        if name in ("near", "mixed"):  # nothing alike, one language: all rows stay
            assert new.count() == docs.count()
        if name == "language":
            assert {r.doc_id for r in new.collect()} == {3, 4, 5, 6, 7, 8, 9, 10, None}
        if name == "exact":
            assert new.count() == len(ODD) - 1 + 1 - 1 + (ODD[1] == "")  # null is the empty text; one of the two repeated rows
        if name == "encoded":
            assert new.count() == docs.count()


@pytest.mark.parametrize("name", [q for q in queries.QUERIES if q.startswith("op") and q not in ("op3_topk", "op11_filter_audit", "op12_chat", "op13_lexical")])
def test_operators_on_empty_and_wider_tables(spark, tmp_path, name):
    docs = spark.createDataFrame([(1, "one two three", "en", "s", 3, 0.5, "x"), (2, "vier fünf", "de", "s", 3, 0.5, "x"), (2, "vier fünf", "de", "s", 3, 0.5, "x")], DOCS + ", score double, fp string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    for rows, folder in ((docs, f"{tmp_path}/a"), (docs.limit(0), f"{tmp_path}/b")):
        rows.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        found = queries.QUERIES[name](spark, folder)
        n = found.count()
        assert n == (0 if name == "op5_licenses" else rows.count())


def test_near_duplicates_recall_on_a_given_table(spark):
    """Pairs of different texts at 0.8 or more, found by brute force, against components of the operator."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts: dict = {}
    for r in docs.collect():
        w = (r.text or "").encode().lower().split()
        if w:
            texts.setdefault(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))), r.doc_id)
    sets, where = list(texts), {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    both = Counter((i, j) for ids in where.values() for i in ids for j in ids if i < j)
    pairs = [(texts[sets[i]], texts[sets[j]]) for (i, j), n in both.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert pairs and sum(got[a] == got[b] for a, b in pairs) >= 0.9 * len(pairs)
    print(len(pairs), sum(got[a] == got[b] for a, b in pairs))
