"""Count filtering of the near-duplicate stage: tallies of equal positional bytes before a pair is verified."""

import numpy as np
from pyspark.sql import functions as F

from cinderlane.llm import neardup


def test_tally_counts_equal_bytes_and_hardly_loses_links(spark):
    rng, least, lost = np.random.default_rng(3), neardup.least_bytes(0.8, 5), 0
    assert neardup.MINIMUM < least < 30
    rows = []
    for i in range(300):
        h = rng.integers(0, 2**64, 220, dtype=np.uint64)
        a, b = (neardup.wide_fingerprint(x) for x in (h[:200], h[20:]))  # 180 of 220 shared: 0.82
        n = int(neardup.tally(a[None, :].view(np.uint64), b[None, :].view(np.uint64))[0])
        assert n == (a.view(np.uint8) == b.view(np.uint8)).sum()
        lost += n < least
        if i < 20:
            rows.append((a.tolist(), b.tolist(), n))
    assert lost <= 1
    d = spark.createDataFrame(rows, "x array<long>, y array<long>, n int")
    assert d.filter(neardup._tally_sql("x", "y") != F.col("n")).isEmpty()


def test_pairs_below_the_tally_are_not_retained(spark):
    shingles = list(range(60))
    sets = spark.createDataFrame([(1, [0] * 20, shingles), (2, [0] * 20, shingles), (3, [-1] * 20, shingles)], "node long, wide array<long>, shingles array<int>")
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert [(r.a, r.b) for r in neardup._verified(pairs, sets, 0.8).collect()] == [(1, 2)]
