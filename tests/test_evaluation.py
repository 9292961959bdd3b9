"""Metrics, projections, components and published content against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cinderlane.operators import metrics, splits
from cinderlane.sources import tables

KIND = "batch int, rate double, ticks long, happened boolean, timing_known boolean, weight double, card_scores array<double>, card int, cell int, target int"


def test_metrics_by_hand(spark):
    rows = [
        (1, 0.5, 40, True, True, 2.0, [0.1, 0.9, 0.9], 2, 19, 0), (1, 0.0, 0, True, True, 1.0, [1.0, None, float("nan")], 1, 5, 5), (1, 1.0, 20, False, True, 0.0, None, 0, None, 3),
        (1, 9.0, 20, False, False, 5.0, [3.0, 2.0, 1.0, 0.0], 3, 17, 18), (1, None, 20, True, True, 1.0, [1.0], 7, 1, None), (2, None, None, None, None, None, None, None, None, None),
    ]
    sums = metrics.metric_sums(spark.createDataFrame(rows, KIND), ["batch"])
    got = {(r.batch, r.metric): (r.value, r.rows) for r in metrics.merged_metrics(sums, ["batch"]).collect()}
    loss = (2.0 * (0.5 * 2 - math.log(0.5)) + 1.0 * (0.0 - math.log(metrics.LEAST_RATE))) / 3.0
    brier = ((1 - math.exp(-1.0) - 1) ** 2 + (0.0 - 1) ** 2 + (1 - math.exp(-1.0)) ** 2) / 3
    want = {"loss_timing": (loss, 3), "timing_brier": (brier, 3), "rate_mean": (0.5, 3), "card_top1": (0.0, 3), "card_top3": (2 / 3, 3), "position_mean_cell_error": ((math.sqrt(2) + 0 + math.sqrt(1 + 17**2)) / 3, 3), "position_within_1_cell": (1 / 3, 3)}
    assert {k[1]: v for k, v in got.items() if k[0] == 1} == {k: (pytest.approx(v), n) for k, (v, n) in want.items()}
    assert all(v == (None, 0) for k, v in got.items() if k[0] == 2) and len(got) == 14
    assert metrics.merged_metrics(metrics.metric_sums(spark.createDataFrame([], KIND), ["batch"])).isEmpty()


def test_sums_merge_to_the_whole(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.random(), rng.randrange(50), rng.random() < 0.5, rng.random() < 0.8, rng.random(), [rng.random() for _ in range(4)], rng.randrange(5), rng.randrange(576), rng.randrange(576)) for _ in range(300)]
    frame = spark.createDataFrame(rows, KIND)
    whole = metrics.metric_sums(frame.withColumn("batch", F.lit(0)), ["batch"])
    got = [{r.metric: (pytest.approx(r.value), r.rows) for r in metrics.merged_metrics(s).collect()} for s in (whole, metrics.metric_sums(frame, ["batch"]))]
    assert {k: v[1] for k, v in got[0].items()} == {k: v[1] for k, v in got[1].items()} and all(got[0][k][0].expected == got[1][k][0] for k in got[0])


def test_projection(spark):
    one = metrics.ratio_projection(spark.createDataFrame([(10, 1000), (20, 2000), (5, 500)], "rows long, bytes long"), 1_000_000, 3).first()
    assert (one.rate, one.low, one.high, one.projected, one.projected_safe) == (100.0, 100e6, 100e6, 100_000_000 + 3 * 65_536, math.ceil((100_000_000 + 3 * 65_536) * 1.35))
    wide = metrics.ratio_projection(spark.createDataFrame([(10, 500), (10, 1500), (0, 0)], "rows long, bytes long"), 100, 0).first()
    assert wide.rate == 100.0 and wide.maximum_rate == 150.0 and wide.low < 10_000 < wide.high and wide.projected == 15_000
    assert metrics.ratio_projection(spark.createDataFrame([], "rows long, bytes long"), 100, 1).first().projected is None


def components_by_hand(edges):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    return {x: top(x) for x in list(root)}


@pytest.mark.parametrize("kind", ["random", "chain", "hub"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {"random": [(rng.randrange(400), rng.randrange(400)) for _ in range(220)], "chain": [(i, i + 1) for i in range(300)], "hub": [(9999, i) for i in range(300)] + [(5, 5), (700, 700), (800, 801), (801, 800)]}[kind]
    frame = spark.createDataFrame(edges + [(None, 1), (2, None)], "a long, b long")
    got = {r.node: r.root for r in splits.components(frame, "a", "b").collect()}
    assert got == components_by_hand(edges)
    assert splits.components(frame.limit(0), "a", "b").isEmpty()


def test_fill_leaves_no_split_empty(spark):
    for weights in ([1, 1, 1], [100, 1, 1], [1, 1, 500, 2], [3] * 40):
        frame = spark.createDataFrame([(f"g{i}", w) for i, w in enumerate(weights)], "k string, w long")
        got = splits.holdout_fill(frame, "k", "w", 0.1, 0.2, "s").collect()
        assert {r.split for r in got} == {"test", "validation", "train"} and len(got) == len(weights)
    assert {s: sum(r.w for r in got if r.split == s) for s in ("test", "validation")} == {"test": 24, "validation": 12}
    with pytest.raises(ValueError, match="three splits"):
        splits.holdout_fill(frame.limit(2), "k", "w", 0.1, 0.2, "s")
    with pytest.raises(ValueError, match="shares"):
        splits.holdout_fill(frame, "k", "w", 0.6, 0.4, "s")


def test_digest_tells_every_change(spark):
    files = [(f"dir/{i}.bin", i, f"{i:064x}") for i in range(700)]
    digest = lambda rows: tables.content_digest(spark.createDataFrame(rows, "path string, length long, sha256 string").repartition(3)).first()
    first = digest(files)
    assert (first.files, first.bytes) == (700, sum(range(700))) and digest(files[::-1]).content_sha256 == first.content_sha256
    others = [files[1:], [("dir/new", 1, "a"), *files], [("dir/0", *files[0][1:]), *files[1:]], [(files[0][0], 1, files[0][2]), *files[1:]], [(*files[0][:2], "b"), *files[1:]]]
    assert len({digest(o).content_sha256 for o in others} | {first.content_sha256}) == 6
    assert digest([]).files == 0


def test_read_back(spark):
    kind = "at int, a string, b double"
    written = [(0, "x", 1.0), (1, None, 2.0), (2, "", 2.0), (3, "y", None), (4, "z", 5.0), (5, "w", 6.0)]
    frame = lambda rows: spark.createDataFrame(rows, kind)
    problems = lambda rows: {r.at: r.problem for r in tables.read_back(frame(written), frame(rows), "at").collect()}
    assert problems(written) == {}
    assert problems([(0, "x", 1.0), (1, "", 2.0), (2, None, 2.0), (3, "y", 0.0), (5, "w", 6.0), (5, "w", 6.0), (9, "n", 1.0)]) == {1: "reordered", 2: "reordered", 3: "changed", 4: "missing", 5: "repeated", 9: "extra"}


def test_offsets_of_ragged_rows(spark):
    rows = [("a", 0, 1, [1, 2]), ("a", 0, 2, []), ("a", 0, 3, None), ("a", 0, 4, [3]), ("a", 1, 1, [4]), ("b", 0, 1, [5, 6, 7])]
    got = {tuple(r)[:3]: (r.first, r.stop) for r in tables.shard_offsets(spark.createDataFrame(rows, "split string, shard int, n int, v array<int>"), "split", "shard", ["n"], "v").collect()}
    assert got == {("a", 0, 1): (0, 2), ("a", 0, 2): (2, 2), ("a", 0, 3): (2, 2), ("a", 0, 4): (2, 3), ("a", 1, 1): (0, 1), ("b", 0, 1): (0, 3)}
