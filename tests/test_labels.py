"""Labels of decision windows and their parity, rule by rule."""

from cinderlane.operators import labels

DECISION, MASK = "battle long, tick long, side int, elixir double, end_tick long", "mask string, cells string"
COMMAND = "battle long, side int, line long, execution_tick long, accepted boolean, kind string, deck_index long, entity long, x long, y long"
CANDIDATE = "battle long, tick long, side int, uid long, allowed boolean, cost double, ability boolean, grid boolean, first_only boolean, hand_slot int, group int, building boolean, half_x double, half_y double, off_x double, off_y double, mask string"


def labelled(spark, windows, candidates, bad=(), elixir=10.0, side=0):
    """windows: commands of one window each, as (execution offset, kind, which, x, y[, accepted])."""
    decisions = [(i, 5, side, elixir, 10 if i else 9) for i in range(len(windows))]
    commands = [(i, side, n, 6 + c[0], c[5] if len(c) > 5 else True, c[1], c[2] if c[1] == "play" else None, c[2] if c[1] == "ability" else None, c[3], c[4]) for i, w in enumerate(windows) for n, c in enumerate(w)]
    offered = [(i, 5, side, *c) for i in range(len(windows)) for c in candidates]
    masks = [("open", "1" * 576), ("shut", "0" * 576), ("row0", "1" * 18 + "0" * 558)]
    frames = [spark.createDataFrame(r, k) for r, k in ((decisions, DECISION), (commands, COMMAND), (offered, CANDIDATE), (masks, MASK), (list(bad), "battle long, tick long"))]
    return labels.command_labels(*frames)


def play(uid, cost=1.0, slot=None, group=-1, first=False, building=False, half=1.0, mask="open", allowed=True):
    return (uid, allowed, cost, False, True, first, uid if slot is None else slot, group, building, half, half, 0.0, 0.0, mask)


ABILITIES = [(10_000_000 + e, True, 1.0, True, False, False, -1, -1, False, None, None, 0.0, 0.0, None) for e in (0, 1)]
OFFERED = [play(0), play(1, 6.0), play(2, 6.0), play(3, slot=0), play(4, group=5), play(5, group=5), play(6, first=True), play(7, building=True), play(8, building=True), play(9, building=True, half=None), play(10, mask="shut"), play(11, mask="row0"), play(12, allowed=False), play(13), play(13), *ABILITIES]


def test_labels_rule_by_rule(spark):
    at = lambda uid, offset=0, x=500, y=500, *more: (offset, "play", uid, x, y, *more)
    ability = lambda entity, offset=0: (offset, "ability", entity, None, None)
    gone = lambda uid: f"expert_candidate_unavailable:{uid}"
    cases = [
        ([], "incomplete_window"), ([], "observed_wait"), ([at(0)], "action"), ([at(0), at(0), at(0)], "more_than_two_actions"), ([at(0, 0, 500, 500, False)], "source_action_rejected_or_unresolved"),
        ([at(0, 0, 502, 500)], "unrepresentable:source target not representable"), ([at(0, 0, 501, 499)], "action"), ([at(0, 0, -500, 500)], "unrepresentable:source target outside board"), ([at(0, 0, None, 1)], "unrepresentable:noninteger source target"),
        ([at(77)], gone(77)), ([at(12)], gone(12)), ([at(13)], gone(13)), ([at(10)], gone(10)), ([at(11, 0, 500, 1500)], "expert_target_illegal"), ([at(11)], "action"), ([at(1), at(2)], gone(2)), ([at(1), at(0)], "action"), ([at(0), at(0)], gone(0)),
        ([at(0), at(3)], gone(3)), ([at(4), at(5)], gone(5)), ([at(0), at(6)], gone(6)), ([at(6), at(0)], "action"), ([ability(0), ability(1)], gone(10_000_001)), ([ability(0), at(0)], "action"), ([at(0, 3), at(1, 2)], "expert_delay_illegal"), ([at(0, 2), at(1, 4)], "action"),
        ([at(7), at(8, 0, 1500, 500)], "expert_target_illegal"), ([at(7), at(8, 0, 2500, 500)], "action"), ([at(7), at(9, 0, 9500, 500)], gone(9)), ([at(9), at(0)], "action"), ([(0, "taunt", 1, 1, 1)], gone(-1)),
    ]
    n = len(cases)
    out = {r.battle: r for r in labelled(spark, [c[0] for c in cases] + [[], []], OFFERED, bad=[(n, 10), (n + 1, 11), (n + 1, 4)]).collect()}
    assert {i: out[i].label for i in range(n)} == {i: c[1] for i, c in enumerate(cases)}
    assert out[n].label == "incomplete_window" and out[n + 1].label == "observed_wait"
    assert all(r.known == (r.label in ("action", "observed_wait")) for r in out.values())
    pair = out[25]
    assert (pair.actions, pair.uid_1, pair.cell_1, pair.delay_1, pair.uid_2, pair.cell_2, pair.delay_2) == (2, 0, 0, 2, 1, 0, 4)
    assert (out[23].cell_1, out[23].uid_1) == (-1, 10_000_000) and out[3].uid_1 is None and out[3].actions == 0


def test_side_one_sees_the_board_turned(spark):
    (r,) = labelled(spark, [[], [(0, "play", 0, 500, 500)]], OFFERED, side=1).filter("battle = 1").collect()
    assert (r.label, r.cell_1) == ("action", 575)


def test_parity_names_each_difference(spark):
    kind = "battle long, tick long, side int, known boolean, actions long, uid_1 long, cell_1 long, delay_1 long, uid_2 long, cell_2 long, delay_2 long"
    act, wait, none = (True, 1, 3, 9, 2, None, None, None), (True, 0, *[None] * 6), (False, 0, *[None] * 6)
    derived = [(i, 0, 0, *v, l) for i, (v, l) in enumerate([(act, "action"), (wait, "observed_wait"), (none, "incomplete_window"), (act, "action"), (act, "action"), (wait, "observed_wait"), (act, "action"), (none, "more_than_two_actions")])]
    stored = [(0, 0, 0, *act), (1, 0, 0, *wait), (2, 0, 0, *none), (3, 0, 0, True, 1, 3, 10, 2, None, None, None), (4, 0, 0, True, 1, 3, 9, 7, None, None, None), (5, 0, 0, *none), (7, 0, 0, *wait), (9, 0, 0, *wait), (1, 0, 0, *wait)]
    got = {r.battle: (r.problem, r.label) for r in labels.label_parity(spark.createDataFrame(stored, kind), spark.createDataFrame(derived, kind + ", label string")).collect()}
    assert got == {1: ("repeated", "observed_wait"), 3: ("action_differs", "action"), 4: ("invalid_action", "action"), 5: ("known_differs", "observed_wait"), 6: ("not_stored", "action"), 7: ("known_differs", "more_than_two_actions"), 9: ("not_derived", None)}


def test_candidates_as_a_function_label_as_rows_do(spark):
    from pyspark.sql import functions as F

    at = lambda uid, offset=0, x=500, y=500: (offset, "play", uid, x, y)
    windows = [[], [], [at(0)], [at(1), at(2)], [at(13)], [at(77)], [at(10)], [at(11, 0, 500, 1500)], [at(7), at(8, 0, 1500, 500)], [(0, "ability", 0, None, None), at(0)], [at(0), at(0), at(0)]]
    kinds = [f.split() for f in CANDIDATE.split(", ")[4:]]
    once = [c for c in OFFERED if c[0] != 13]
    struct = lambda c: F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(c[1:], kinds, strict=True)])
    offer = lambda uid: F.coalesce(*[F.when(uid == c[0], struct(c)) for c in once])
    by_rows, rows, real = labelled(spark, windows, once), None, labels.command_labels
    try:
        labels.command_labels = lambda decisions, commands, _, masks, bad: real(decisions, commands, offer, masks, bad)
        rows = labelled(spark, windows, once)
    finally:
        labels.command_labels = real
    assert sorted(rows.collect()) == sorted(by_rows.collect())


def test_unknown_keys_match_nothing(spark):
    decisions = [(1, None, 0, 9.0, 20), (1, 5, None, 9.0, 20), (1, 5, 0, 9.0, 20)]
    commands = [(1, 0, 1, None, True, "play", 0, None, 500, 500), (1, None, 2, 6, True, "play", 0, None, 500, 500)]
    frames = [spark.createDataFrame(r, k) for r, k in ((decisions, DECISION), (commands, COMMAND), ([], CANDIDATE), ([], MASK), ([(1, None), (None, 5)], "battle long, tick long"))]
    got = {(r.tick, r.side): (r.label, r.actions) for r in labels.command_labels(*frames).collect()}
    assert got == {(None, 0): ("incomplete_window", 0), (5, None): ("observed_wait", 0), (5, 0): ("observed_wait", 0)}


def test_parity_of_unknown_keys_and_of_repeated_derived_rows(spark):
    kind = "battle long, tick long, side int, known boolean, actions long, uid_1 long, cell_1 long, delay_1 long, uid_2 long, cell_2 long, delay_2 long"
    wait, none = (True, 0, *[None] * 6), (False, 0, *[None] * 6)
    stored = [(1, None, 0, *wait), (1, None, 0, *wait), (2, 0, 0, *none), (3, 0, 0, *wait), (3, 0, 0, *none)]
    derived = [(1, None, 0, *wait, "a"), (2, 0, 0, *wait, "b"), (2, 0, 0, *wait, "c"), (2, 0, 0, *none, "d")]
    got = sorted((r.battle, r.problem, r.label or "") for r in labels.label_parity(spark.createDataFrame(stored, kind), spark.createDataFrame(derived, kind + ", label string")).collect())
    assert got == [(1, "not_derived", ""), (1, "not_stored", "a"), (2, "known_differs", "b"), (2, "known_differs", "c"), (3, "not_derived", "")]
