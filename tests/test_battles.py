import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinderlane.functions import scalars as S
from cinderlane.operators import battles as B
from cinderlane.operators import joins, sampling

PLAY = "struct<side string, card string, time_raw int, x int, y int>"
BATTLE = f"battle_tag string, card_plays array<{PLAY}>, duration_seconds int, indexed boolean, team_tags array<string>, opponent_tags array<string>, team_crowns int, opponent_crowns int, metadata struct<players string, draft string, team_deck array<string>, opponent_deck array<string>>"
DECK = list("abcdefgh")
GOOD = dict(tag="t", plays=[("team", "A-ev1", 1, 5, 5), ("opponent", "b", 1, 0, 32000)], seconds=300, indexed=True, one=["#x"], two=["#y"], c1=3, c2=0, meta=("1v1", "0", DECK, DECK))
CASES = [
    ({}, [], "confirmed_1v1"),
    ({"meta": None}, [], "uncertain_1v1"),
    ({"indexed": False}, ["missing_index_metadata"], "confirmed_1v1"),
    ({"tag": " ", "plays": []}, ["missing_battle_tag", "missing_card_plays"], "rejected"),
    ({"plays": None, "seconds": 361}, ["invalid_duration", "missing_card_plays"], "rejected"),
    ({"plays": [("team", "a", 9, 1, 1), ("team", "b", 3, 18001, None), ("x", "a", -1, -1, -1)]}, ["invalid_side", "invalid_x", "invalid_y", "nonmonotonic_tick"], "rejected"),
    ({"plays": [("team", "a", 9, 1, 1), ("opponent", "_invalid", -1, 1, 1), ("team", "b", 9, 1, 1)]}, ["invalid_card", "invalid_tick"], "rejected"),
    ({"plays": [("team", c, i, 1, 1) for i, c in enumerate("abcdefghi")]}, ["team_more_than_8_cards", "team_play_not_in_deck"], "rejected"),
    ({"one": ["#x", "#z"], "c1": 4, "c2": None}, ["invalid_opponent_crowns", "invalid_team_crowns", "team_size_2"], "rejected"),
    ({"meta": ("2v2", None, DECK[:7], DECK)}, ["draft_or_special_selection", "incomplete_list_deck", "list_not_1v1"], "rejected"),
]


def test_battle_reasons(spark):
    rows = [tuple((GOOD | c).values()) for c, _, _ in CASES]
    got = spark.createDataFrame(rows, BATTLE).coalesce(1).withColumn("r", B.battle_reasons()).withColumn("c", B.battle_class(F.col("r"))).collect()
    assert [(r.r, r.c) for r in got] == [(r, c) for _, r, c in CASES]
    eight = spark.createDataFrame(rows[:1], BATTLE).select(B.battle_reasons(every_card=True).alias("r")).first().r
    assert eight == ["opponent_incomplete_observed_cycle", "team_incomplete_observed_cycle"]


def test_points_and_views(spark):
    p = spark.createDataFrame([(1, 2, 100, 200, 0), (1, 2, 100, 200, 1), (1, 2, None, 200, 1), (1, 2, 100, 200, 2), (1, 2, 0, 0, 0)], "x int, y int, x_raw int, y_raw int, data_i int")
    got = [r.p and tuple(r.p) for r in p.coalesce(1).select(B.native_point(F.struct("*")).alias("p")).collect()]
    assert got == [(17900, 31800, 0, "raw_marker"), (100, 200, 1, "raw_marker"), (1, 2, None, "legacy_xy"), None, None]
    e = spark.createDataFrame([(0, 10, 20, 7), (1, 0, 31_999, 8)], "side int, x int, y int, elixir int")
    got = {(r.actor, r.relation): (r.x, r.y, r.elixir) for r in B.side_views(e, ["elixir"]).collect()}
    assert got == {(0, 0): (10, 20, 7), (0, 1): (0, 31_999, None), (1, 0): (17_999, 0, 8), (1, 1): (17_989, 31_979, None)}


def test_chains(spark):
    rows = [(1, None, False), (2, 1, True), (3, 2, False), (4, 99, False), (5, 6, False), (6, 5, False), (7, 5, False), (8, 8, True), (9, 3, False)]
    n = spark.createDataFrame(rows, "n int, p int, ok boolean")
    got = {r.node: (r.root, r.depth, r.status) for r in joins.lineage(n, "n", "p").collect()}
    assert got == {1: (1, 0, "root"), 2: (1, 1, "linked"), 3: (1, 2, "linked"), 4: (None, None, "dangling"), **{i: (None, None, "cycle") for i in (5, 6, 7, 8)}, 9: (1, 3, "linked")}
    assert {r.node: r.credited for r in joins.credited(n, "n", "p", "ok").collect()} == {1: None, 2: 2, 3: 2, 4: None, 5: None, 6: None, 7: None, 8: 8, 9: 2}
    a = spark.createDataFrame([(1, "f", "x"), (2, "f", "y"), (2, "f", "z"), (1, "g", "v")], "n int, field string, value string")
    up = n.filter("n < 4").select("n", "p")
    got = {(r.n, r.field): (r.value, r.depth) for r in joins.inherited(a, up, "n", "field", "value", "p").collect()}
    assert got == {(1, "f"): ("x", 0), (1, "g"): ("v", 0), (2, "f"): (None, 0), (2, "g"): ("v", 1), (3, "f"): (None, 1), (3, "g"): ("v", 2)}
    with pytest.raises(ValueError, match="circle"):
        joins.inherited(a, n.select("n", "p"), "n", "field", "value", "p", most=6)


def test_diverse_sample_against_a_loop(spark):
    rng = random.Random(3)
    rows = [(i, rng.sample("abcdef", rng.randrange(4)), rng.sample("uvwxyz", 2)) for i in range(40)]
    seen, cards, left, want = Counter(), Counter(), list(rows), []
    for _ in range(9):
        best = max(left, key=lambda r: (sum(1 / (1 + seen[t]) for t in r[1]) + 0.08 * sum(1 / (1 + cards[c]) for c in r[2]), r[0]))
        left.remove(best)
        want.append(best[0])
        seen.update(best[1])
        cards.update(best[2])
    assert sampling.diverse(spark.createDataFrame(rows, "k int, t array<string>, c array<string>"), "k", "t", "c", 9) == want


def test_expected_rows_and_log_tiers(spark):
    assert B.expect_rows(spark.range(3), 3).count() == 3
    with pytest.raises(ValueError, match="3 rows"):
        B.expect_rows(spark.range(3), 4)
    rows = [(0, 0, None), (1, 0, None), (1, 1, [("team",), ("opponent",)]), (2, 1, [("team",)])]
    got = spark.createDataFrame(rows, "a int, b int, ability_plays array<struct<side string>>").coalesce(1).select(B.ability_log_tier([F.col("a"), F.col("b")]).alias("t")).collect()
    assert [r.t for r in got] == ["source_reports_zero", "count_only_missing_ticks", "observed_ticks_identity_runtime_resolved", "observed_tick_count_mismatch"]


def test_upgrades_beat_the_row_held_so_far(spark):
    rows = [("a", 2, 0, 1), ("a", 1, 1, 2), ("a", 3, 2, 3), ("b", 1, 0, 1), ("b", 1, 0, 2), ("b", 1, 1, 3), ("c", 3, 0, 1), ("c", 2, 1, 2), ("d", 1, 0, 1), ("d", 2, 0, 2), ("d", 3, 0, 3)]
    got = B.upgraded(spark.createDataFrame(rows, "k string, v int, p int, o int"), "k", "v", "p", ["o"]).collect()
    assert {r.k: (r.v, r.p, r.o, r.duplicates, r.upgrades) for r in got} == {"a": (3, 2, 3, 2, 1), "b": (1, 1, 3, 2, 0), "c": (3, 0, 1, 1, 0), "d": (3, 0, 3, 2, 2)}


def test_names_take_the_first_family_with_exactly_one(spark):
    rows = [("x", "F", 1), ("x", "F", 2), ("x", "G", 3), ("y", "other", 4), ("y", "other", 4), ("z", "F", 5), ("z", "F", 6), ("w", "other", 7), ("w", "other2", 8), ("v", "G", 9), ("v", "F", 10)]
    got = B.preferred(spark.createDataFrame(rows, "name string, family string, node int"), "name", "family", "node", ["F", "G"]).collect()
    assert {r.name: r.node for r in got} == {"x": 3, "y": 4, "z": None, "w": None, "v": 10}


def test_events_are_known_by_their_identity(spark):
    rows = [(1, "a", 5, 1, 1, "p"), (1, "b", 5, 1, 2, "q"), (1, "a", 5, 2, 3, "p"), (1, "a", 5, 2, 4, "z"), (1, "c", 5, 3, 5, "p"), (1, "d", 4, 4, 6, "p"), (1, None, 6, 5, 7, "p"), (1, None, 6, 5, 8, "p"), (2, "a", 1, 1, 9, "p")]
    got = B.observed(spark.createDataFrame(rows, "k int, id string, t int, frame int, o int, v string"), ["k"], "id", "t", "frame", "o", ["v"]).collect()
    assert {r.o: (r.observed_tick, r.status) for r in got} == {1: (5, "fresh"), 2: (5, "fresh"), 4: (6, "conflict"), 5: (6, "fresh"), 6: (4, "late"), 7: (6, "fresh"), 8: (6, "fresh"), 9: (1, "fresh")}


def test_tower_keys_swap_lanes_for_side_one(spark):
    rows = [(rel, role, lane, side) for rel in (0, 1) for role in ("king", "princess") for lane in (0, 1) for side in (0, 1)]
    got = spark.createDataFrame(rows, "rel int, role string, lane int, side int").withColumn("key", S.tower_key(*map(F.col, ("rel", "role", "lane", "side")))).collect()
    assert [r.key for r in got] == [0, 0, 0, 0, 1, 2, 2, 1, 3, 3, 3, 3, 4, 5, 5, 4]
