import itertools
import random

import pytest
from pyspark.sql import functions as F

from cinderlane.operators import sequence


def brute_rotation(cards):
    """All starting hands and queues, filtered play by play: (valid, first failing play)."""
    states = {(tuple(sorted(h)), q) for h in itertools.combinations(range(8), 4) for q in itertools.permutations([c for c in range(8) if c not in h])}
    for i, c in enumerate(cards):
        states = {(tuple(sorted([*(x for x in h if x != c), q[0]])), (*q[1:], c)) for h, q in states if c in h}
        if not states:
            return False, i
    return True, None


def test_rotation_against_all_states(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(12):
        cards, line = list(range(8)), []
        rng.shuffle(cards)
        for _ in range(14):
            c = cards.pop(rng.randrange(4))
            cards.append(c)
            line.append(c if rng.random() > 0.04 else rng.randrange(8))
        want[k] = brute_rotation(line)
        rows += [(k, i, c) for i, c in enumerate(line)]
    df = spark.createDataFrame(rows, "k int, i int, card int")
    got = sequence.first_impossible(sequence.rotation(df, ["k"], "card", ["i"]), ["k"]).collect()
    assert {r.k: (r.valid, r.failing) for r in got} == want


def test_same_tick_events_do_not_see_each_other(spark):
    df = spark.createDataFrame([(1, 5, "a", 1), (1, 5, "b", 2), (1, 9, "c", 3)], "k int, tick long, kind string, id long")
    rows = sequence.intervals(df, "k", "tick", "kind", "id").orderBy("tick").collect()
    assert [(r.n, r.previous_kind, r.interval, r.n_before, r.censored) for r in rows] == [(2, None, None, 0, False), (1, "b", 4, 2, True)]


def test_deltas_rebuild_nulls(spark):
    rows = [(1, i, v) for i, v in enumerate([None, "a", "a", None, None, "b", None, "c", "c", None])]
    df = spark.createDataFrame(rows, "k int, t int, f string")
    d = sequence.changes(df, "k", ["t"], ["f"])
    thin = d.withColumn("f", F.when((F.col("mask") > 0) | ((F.col("n") - 1) % 4 == 0), F.col("f")))
    got = sequence.rebuilt(thin, "k", ["f"], 4).orderBy("t").collect()
    assert [r.re_f for r in got] == [r[2] for r in rows]


def test_advantages_against_a_loop(spark):
    rng = random.Random(2)
    steps = [(1, i, rng.random(), rng.random(), rng.random(), 1.0 + i % 3, i == 5, i == 9, i != 12) for i in range(20)]
    kind = "k int, t long, reward double, value double, next_value double, elapsed double, terminated boolean, truncated boolean, valid boolean"
    got = {r.t: r for r in sequence.advantages(spark.createDataFrame(steps, kind), "k", "t", 0.9, 0.8).collect()}
    running, later = 0.0, False
    for _, t, reward, value, follows, elapsed, over, cut, valid in reversed(steps):
        go = 0.9 ** (elapsed / 5)
        running = reward + go * (0 if over else follows) - value + go * 0.8 ** (elapsed / 5) * (running if later and not over and not cut else 0) if valid else 0.0
        later = valid
        assert got[t].advantage == pytest.approx(running) and got[t].ret == pytest.approx(running + value)


def test_same_tick_rows_are_after_not_before(spark):
    df = spark.createDataFrame([(1, 5, True, 1), (1, 5, False, 2), (1, 8, False, 3), (1, 9, True, 4)], "k int, tick long, b boolean, id int")
    got = {r.id: (r.before, r.after) for r in sequence.nearest(df, "k", "tick", F.col("b")).collect()}
    assert got == {1: (None, 5), 2: (None, 5), 3: (5, 9), 4: (5, 9)}


def test_deals_against_a_simulation(spark):
    rng = random.Random(9)
    plays, layout, want = [], [], {}
    for k in range(40):
        cards = rng.sample(range(8), 8)
        layout += [(k, c, p) for p, c in enumerate(cards)]
        hand, queue, failing = cards[:4], cards[4:], None
        for n in range(12):
            c = rng.choice(hand) if rng.random() > 0.05 else rng.randrange(8)
            if failing is None and c not in hand:
                failing = n
            if failing is None:
                hand.remove(c)
                hand.append(queue.pop(0))
                queue.append(c)
            plays.append((k, c, n))
        want[k] = (failing is None, failing)
    got = sequence.deals(spark.createDataFrame(plays, "k int, c int, n int"), spark.createDataFrame(layout, "k int, c int, place int"), "k", "c", "n")
    assert {r.k: (r.possible, r.failing) for r in got.collect()} == want


def test_truncation_changes_nothing_before_it(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("tick", F.unix_seconds(F.col("ts").cast("timestamp")))
    cut = e.agg(F.percentile_approx("tick", 0.5)).first()[0]
    cols = ["user_id", "tick", "n", "previous_kind", "interval", "n_before"]
    full = sequence.intervals(e, "user_id", "tick", "event_type", "event_id").filter(F.col("tick") < cut).select(*cols)
    part = sequence.intervals(e.filter(F.col("tick") < cut), "user_id", "tick", "event_type", "event_id").select(*cols)
    assert full.exceptAll(part).isEmpty() and part.exceptAll(full).isEmpty()
