import pytest
from pyspark.sql import functions as F

from cinderlane.operators import records as R

LIVE = """schema_version int, timestamp string, draft boolean, rounds array<struct<team array<struct<card_levels map<string,int>>>, opponent array<struct<card_levels map<string,int>>>>>,
 team_deck array<string>, opponent_deck array<string>, team_base array<string>, opponent_base array<string>, team_cycle boolean, opponent_cycle boolean, ability_plays array<struct<side string>>,
 team_abilities int, opponent_abilities int, team_crowns int, opponent_crowns int"""
DECK = list("abcdefgh")
PLAYER = [({c: 11 for c in DECK},)]
GOOD = (3, "1700000000", False, [(PLAYER, PLAYER)], DECK, DECK, DECK, DECK, True, True, [("team",)], 1, None, 0, 3)
NAMES = [c.strip().split(" ")[0] for c in "schema_version,timestamp,draft,rounds,team_deck,opponent_deck,team_base,opponent_base,team_cycle,opponent_cycle,ability_plays,team_abilities,opponent_abilities,team_crowns,opponent_crowns".split(",")]
LIVE_CASES = [
    ({}, []),
    ({"timestamp": "1700000000000"}, []),
    ({"timestamp": None}, ["before_version_window", "timestamp_missing"]),
    ({"draft": None, "schema_version": 2}, ["draft_or_unknown", "not_schema_v3"]),
    ({"rounds": [(PLAYER, PLAYER)] * 2}, ["not_standard_1v1"]),
    ({"rounds": []}, ["not_standard_1v1", "opponent_deck_incomplete", "team_deck_incomplete"]),
    ({"team_deck": DECK[:7] + ["_invalid"], "opponent_deck": DECK[:7] + ["a"]}, ["opponent_deck_incomplete", "team_deck_incomplete"]),
    ({"team_base": DECK[:7], "opponent_cycle": False}, ["opponent_cycle_invalid", "team_observed_cycle_incomplete"]),
    ({"ability_plays": None, "team_crowns": None}, ["ability_events_missing", "team_crowns_missing"]),
    ({"ability_plays": [("opponent",)]}, ["opponent_ability_count_mismatch", "team_ability_count_mismatch"]),
]


def test_live_reasons(spark):
    rows = [tuple({**dict(zip(NAMES, GOOD, strict=True)), **change}.values()) for change, _ in LIVE_CASES]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {LIVE}")
    got = {r.i: r.x for r in d.select("i", R.live_reasons(1_700_000_000).alias("x")).collect()}
    assert [got[i] for i in range(len(rows))] == [want for _, want in LIVE_CASES]
    assert d.limit(0).select(R.live_reasons(1)).count() == 0


PLAY = "struct<time_raw int, time double, side string, marker_index int, card string, x_raw int, y_raw int, data_i int>"
ABILITY = "struct<time_raw int, time double, side string, marker_index int, ability_id string>"
SOURCE = f"""battle_tag string, catalog_tag string, schema_version int, timestamp int, version_timestamp int, battle_time_utc string, catalog_timestamp int, duration_seconds double,
 card_plays array<{PLAY}>, ability_plays array<{ABILITY}>, team_deck array<string>, opponent_deck array<string>"""
CLEAN = dict(tag="t", named="t", version=5, stamp=1_700_000_000, other=None, utc="2023-11-14T22:13:20Z", at=1_700_000_000, seconds=10.0, plays=[(20, 1.0, "team", 2, "a", 100, 200, 0)], abilities=[(5, None, "opponent", 1, None)], one=["a"], two=["b"])
SOURCE_CASES = [
    ({}, []),
    ({"utc": "2023-11-14T23:13:20+01:00"}, []),
    ({"named": "u", "version": 4, "stamp": 1}, ["battle_identity_mismatch", "timestamp_conflicts_with_catalog", "unsupported_source_schema"]),
    ({"stamp": None, "utc": None}, ["source_timestamp_missing"]),
    ({"utc": "2023-11-14T22:13:20"}, ["utc_time_conflicts_with_catalog"]),
    ({"utc": "yesterday"}, ["invalid_utc_time"]),
    ({"seconds": None}, ["duration_missing_or_invalid"]),
    ({"seconds": 0.99}, ["duration_not_integer_tick"]),
    ({"seconds": 0.5}, ["deploy_after_declared_duration"]),
    ({"plays": None, "abilities": [], "one": []}, ["card_plays_missing_or_invalid", "team_deck_missing"]),
    ({"plays": [(-1, 1.0, "x", 1, "", 1, 1, 2)]}, ["deploy_card_identity_missing", "deploy_integer_tick_missing", "deploy_raw_coordinate_provenance_missing", "deploy_side_unknown", "deploy_tick_seconds_disagree", "duplicate_marker_index"]),
    ({"plays": [(20, 1.1, "team", None, "a", 18001, 0, 1)]}, ["deploy_coordinates_outside_arena", "deploy_marker_order_unknown", "deploy_tick_seconds_disagree"]),
]


def test_source_issues_and_normal_events(spark):
    rows = [(i, *{**CLEAN, **change}.values()) for i, (change, _) in enumerate(SOURCE_CASES)]
    d = spark.createDataFrame(rows, f"i int, {SOURCE}")
    got = {r.i: (r.x, r.e) for r in d.select("i", R.source_issues().alias("x"), R.normal_events().alias("e")).collect()}
    assert [got[i][0] for i in range(len(rows))] == [want for _, want in SOURCE_CASES]
    first = got[0][1]
    assert [(e.kind, e.at, e.marker, e.identity, e.x, e.y) for e in first] == [("ability", 5, 1, None, None, None), ("deploy", 20, 2, "a", 17900, 31800)]
    assert got[9][1] == []


def test_side_record(spark):
    base = list("abcdefgh")
    full = [f"{c}-ev1" if c == "a" else c for c in base]
    rows = [
        (0, base, full, {c: 12 for c in full}, 3, 2, 2),
        (1, base, full[:7], {}, 3, 1, 2),
        (2, base, full, {"b": 1}, 2, 2, 2),
        (3, base, None, None, None, None, 0),
    ]
    d = spark.createDataFrame(rows, "i int, deck array<string>, source array<string>, levels map<string,int>, version int, logged int, expected int")
    r = {x.i: x.r for x in d.select("i", R.side_record("deck", "source", "levels", "version", "logged", "expected").alias("r")).collect()}
    assert r[0].forms == full and r[0].card_levels == [12] * 8 and r[0].abilities_complete and r[0].abilities_missing == 0
    assert r[1].forms is None and not r[1].exact_levels and not r[1].abilities_complete and r[1].abilities_missing == 1
    assert r[2].exact_forms and not r[2].exact_levels and r[2].card_levels is None and not r[2].abilities_complete
    assert not r[3].exact_forms and r[3].abilities_complete


def test_leaking_columns(spark):
    d = spark.createDataFrame([(1, 2, 3)], "tick int, Enemy_Hand_0 int, card_id int")
    assert R.leaking_columns(d) == ["Enemy_Hand_0"]
    assert R.leaking_columns(d, ["tick", "card_id"]) == ["Enemy_Hand_0", "card_id"]


def test_scaled_features_null_and_repeats(spark):
    d = spark.createDataFrame([(1, "cost", 5.0), (1, "velocity_x", -5.0), (1, "mood", 1.0), (2, "cost", None), (2, "damage", float("nan")), (3, "cost", 1.0), (3, "cost", 1.0), (4, "cost", -1.0)], "k int, feature string, value double")
    got = sorted((r.k, r.feature, r.scaled, r.issue) for r in R.scaled_features(d, ["k"], {"cost": 10.0, "velocity_x": 10.0, "damage": 5000.0}).collect() if r.issue is None)
    assert got == [(1, "cost", 0.5, None), (1, "velocity_x", -0.5, None)]
    issues = sorted((r.k, r.issue) for r in R.scaled_features(d, ["k"], {"cost": 10.0, "velocity_x": 10.0, "damage": 5000.0}).collect() if r.issue)
    assert issues == [(1, "unsupported"), (2, "not_finite"), (2, "not_finite"), (3, "duplicate"), (3, "duplicate"), (4, "negative")]


def test_terminal_anchors(spark):
    records = spark.createDataFrame([("#a", "r", "/x/A.json"), ("#b", "r", "/x/b.json"), ("#c", "s", "/x/c.json"), ("#d", "r", None)], "battle_tag string, root string, source_path string")
    url = "https://h/b?tag=%23{}&team_crowns={}&opponent_crowns=1"
    index = spark.createDataFrame([("r", "D:\\y\\a.JSON", "battle", url.format("a", 2)), ("r", "b.json", "battle", url.format("b", 1)), ("r", "b.json", "battle", url.format("b", 3)), ("r", "c.json", "battle", url.format("c", 1)), ("r", "", "battle", url.format("d", 1)), ("r", "b.json", "player", None)], "root string, saved_path string, kind string, url string")
    got = {r.battle_tag: (r.status, r.team_crowns, r.opponent_crowns) for r in R.terminal_anchors(records, index).collect()}
    assert got == {"#a": ("matched", 2, 1), "#b": ("conflict", None, None), "#c": ("missing", None, None), "#d": ("missing", None, None)}


def test_label_legality(spark):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1000, 0), (1, 17999, 31999), (1, 18000, 0), (1, -1, 0), (1, None, 0), (2, 0, 0), (3, 0, 0)], "slot int, x int, y int")
    slots = spark.createDataFrame([(1, "m"), (2, "n")], "slot int, mask string")
    masks = spark.createDataFrame([("m", "1" + "0" * 574 + "1")], "mask string, cells string")
    got = sorted((r.slot, str(r.x), r.legal, r.reason) for r in R.label_legality(labels, slots, masks, ["slot"]).collect())
    off = "position_not_in_mask"
    assert got == sorted([(1, "0", True, None), (1, "1000", False, off), (1, "17999", True, None), (1, "18000", False, off), (1, "-1", False, off), (1, "None", False, off), (2, "0", False, "payload_not_staged"), (3, "0", False, "no_captured_mask")])


@pytest.mark.parametrize(("cost", "packed", "elixir", "want"), [(4, 0, 10000, (40000, 30000)), (None, 0x5FFFFFFF, 60000, (50000, 0)), (None, -1, 0, (150000, 150000))])
def test_cost_refusals(spark, cost, packed, elixir, want):
    d = spark.createDataFrame([(13, cost, packed, elixir), (12, 1, 1, 1)], "result_code int, card_cost long, packed long, elixir_raw long")
    assert [(r.cost_raw, r.deficit) for r in R.cost_refusals(d).collect()] == [want]


def test_settled(spark):
    tasks = spark.createDataFrame([("a", "pending"), ("b", "leased"), ("c", "done"), ("d", "pending"), ("e", "leased")], "k string, status string")
    results = spark.createDataFrame([("a", 1, True, False, False, None), ("a", 2, True, True, False, None), ("b", 1, False, None, None, ""), ("c", 1, False, None, False, "x"), ("d", 1, False, None, True, "x")], "k string, n int, success boolean, frame_valid boolean, retry boolean, failure string")
    got = {r.k: (r.settled, r.error) for r in R.settled(tasks, results, "k", "n").collect()}
    assert got == {"a": ("done", None), "b": ("failed", "failed"), "c": ("done", None), "d": ("pending", None), "e": ("leased", None)}


def test_sparse_rows_come_back(spark):
    grids = {(g, r): [(g * 7 + r * 3 + i) % 4 if r else 0 for i in range(6)] for g in range(2) for r in range(3)}
    d = spark.createDataFrame([(g, r, i, v) for (g, r), row in grids.items() for i, v in enumerate(row)], "g int, r int, cell int, v int")
    out = R.packed_rows(d, "g", "r", "cell", "v").withColumn("back", R.dense(6)).collect()
    assert {(x.g, x.r): x.back for x in out} == grids
    for x in out:
        assert x.offset == sum(sum(v != 0 for v in grids[x.g, r]) for r in range(x.r)) and x.cells == sorted(x.cells)


def test_usable_and_observed(spark):
    ledger = spark.createDataFrame([("a", "usable"), ("a", "usable"), ("b", "captured"), ("c", "usable")], "k string, status string")
    sets = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 1, "x")], "k string, root int, path string")
    assert [tuple(r) for r in R.usable(ledger, sets, "k").collect()] == [("a", "y")]
    rows = spark.createDataFrame([(1,), (2,), (3,), (None,)], "card long")
    catalog, forms = spark.createDataFrame([(1, "one")], "id long, name string"), spark.createDataFrame([(2, 1, "evolution", "one-ev1")], "id long, base long, form string, name string")
    got = {r.card: (r.base_card_id, r.card_form, r.form_name) for r in R.observed_cards(rows, "card", catalog, forms).collect()}
    assert got == {1: (1, "base", "one"), 2: (1, "evolution", "one-ev1"), 3: (3, "unknown", "3"), None: (None, "unknown", None)}
    d = F.struct(F.lit(None).cast("int").alias("invisible"), F.lit(-100).alias("speed"), F.lit(-100).alias("hit_speed"), F.lit(1.0).alias("damage"), F.lit(None).cast("double").alias("heal"))
    assert rows.limit(1).select(R.effect_kind(d)).first()[0] == "stun"


def test_plan_issues(spark):
    kind = "k int, schema int, side string, card string, tick int, marker int, n int, form string, flag int, provenance string, transform string, duration_ticks int"
    fine = ("royaleapi_data_i_to_libg_native_v1", "identity", 20)
    plays = [(1, 5, "team", "A-ev1", 5, 0, 0, "a", None, *fine), (1, 5, "team", "b", 5, 1, 1, "b", 1, *fine), (1, 5, "opponent", "a", 4, 1, 2, "a", 0, *fine), (1, 5, "x", "a", 41, 3, 3, "a", 0, "old", "rotate_180", 20),
             (1, 5, "team", "z", None, None, 4, "z", 1, *fine), (1, 5, "opponent", None, 40, 5, 5, None, 0, fine[0], "rotate_180", 20), (2, 3, "team", "a", -1, None, 0, None, None, None, None, 20), (2, 3, "team", "b", 1, None, 1, None, None, None, None, 20), (2, 3, "team", "b", 2, 0, 2, None, None, None, None, 20)]
    decks = spark.createDataFrame([(1, "team", ["a", "b"]), (1, "opponent", ["a-hero"]), (2, "team", ["b"])], "k int, side string, deck array<string>")
    out = R.plan_issues(spark.createDataFrame(plays, kind), decks, "k", ["n"]).collect()
    assert {(r.k, r.n): r.issues for r in out} == {
        (1, 0): ["several_at_one_tick"], (1, 1): ["repeated_marker", "several_at_one_tick"], (1, 2): ["card_form_inconsistent", "coordinates_inconsistent", "not_sorted", "repeated_marker"],
        (1, 3): ["coordinates_inconsistent", "invalid_side", "tick_outside_duration"], (1, 4): ["card_not_in_deck", "marker_missing", "tick_outside_duration"], (1, 5): ["card_not_in_deck"],
        (2, 0): ["card_not_in_deck", "tick_outside_duration"], (2, 1): [], (2, 2): [],
    }
    assert {r.n: r.marker for r in out if r.k == 2} == {0: 0, 1: 1, 2: 0}  # the place stands in; repeats don't count there


def test_extents(spark):
    d = spark.createDataFrame([(0, 1, 1, 10, 10), (0, 0, 1, 10, 10), (0, 5, 4, 10, 10), (0, 5, 11, 10, 10), (0, 10, 10, 10, 9), (0, None, 1, 10, 10)], "start int, action_stop int, censor int, stop int, tick_count int")
    out = R.extents(d).collect()
    assert [r.retained for r in out] == [1, None, None, None, None, None]
    assert [r.issues for r in out] == [[], *[["bounds_out_of_order"]] * 3, ["tick_count_differs"], ["bounds_out_of_order"]]
