"""Boards on packed words against boards of cells."""

import random

from pyspark.sql import functions as F

from cinderlane.operators import arena

TOWER = "k long, side int, role int, x long, y long, hp long"
MASK = "mask string, data_id long, cells string, cost_raw long"
OPEN = "1" * 576


def board(cells, side, card, data, towers):
    """The rules cell by cell."""
    if data is None or data <= 0 or len(cells) != 576 or set(cells) - {"0", "1"}:
        return None
    if (card // 10**6 == 28 and card != 28_000_006) or data // 10**6 == 28 or {card, data} & {26_000_032, 27_000_013}:
        return cells
    at = lambda r, c: cells[18 * r + c] == "1"
    gone = [not any(s == 1 - side and role == 1 and hp > 0 and (x >= 9000) == lane for s, role, x, y, hp in towers) for lane in (False, True)]
    out = ""
    for r in range(32):
        for c in range(18):
            ok = at(r, c) and at(r, 17 - c) and at(31 - r, c) and at(31 - r, 17 - c)
            own = r <= 14 or r == 16 if side == 0 else r >= 17 or r == 15
            pocket = gone[c >= 9] and (16 <= r <= 20 if side == 0 else 11 <= r <= 15)
            under = False
            for _, role, x, y, hp in towers:
                half = 2000 if role == 0 else 1500
                if hp > 0 and (x - half) // 1000 <= c < (x + half + 999) // 1000 and (y - half) // 1000 <= r < (y + half + 999) // 1000:
                    under = True
            out += "1" if ok and (own or pocket) and not under else "0"
    return out


def test_derived_boards_against_cells(spark):
    rng = random.Random(2)
    masks = [(f"m{i}", rng.choice([26_000_001, 26_000_032, 28_000_001, 0, None]) if i % 4 == 3 else 26_000_001, "".join(rng.choices("01", [1, 9], k=576)) if i else OPEN, 3) for i in range(8)] + [("short", 26_000_001, "101", 3), ("odd", 26_000_001, "x" * 576, 3)]
    towers = [(k, rng.randrange(2), rng.randrange(2), rng.randrange(-1000, 19_500), rng.randrange(-1000, 33_500), rng.choice([0, 5, 900])) for k in range(30) for _ in range(rng.choice([0, 1, 4, 6]))]
    slots = [(k, i, rng.randrange(2), rng.choice([26_000_007, 28_000_006, 28_000_004, 27_000_013]), rng.choice([m[0] for m in masks] + ["none"])) for k in range(32) for i in range(6)]
    d = arena.derived_masks(spark.createDataFrame(slots, "k long, n int, side int, card_id long, mask string"), spark.createDataFrame(masks, MASK), spark.createDataFrame(towers, TOWER), ["k"])
    got = {(r.k, r.n): r.b for r in d.select("k", "n", arena.unpack(arena.mask_words()).alias("b")).collect()}
    by_mask = {m[0]: m for m in masks}
    for k, n, side, card, mask in slots:
        m = by_mask.get(mask)
        assert got[k, n] == (board(m[2], side, card, m[1], [t[1:] for t in towers if t[0] == k]) if m else None)
    assert len(got) == len(slots)


def test_labels_and_locked_pockets(spark):
    masks = spark.createDataFrame([("m", 26_000_001, OPEN, 4000)], MASK)
    towers = spark.createDataFrame([(1, 1, 1, 3500, 25_500, 1400), (1, 1, 0, 9000, 29_000, 2400), (1, 0, 1, 3500, 6500, 0), (2, 1, 1, 3500, 18_500, 10)], TOWER)
    moments = spark.createDataFrame([(1, 200, True, [0, 1], [2], 5000, 3000), (2, 99, False, [0], None, 4000, None)], "k long, tick int, commands_allowed boolean, hand_0 array<int>, hand_1 array<int>, elixir_0 long, elixir_1 long")
    labels = [
        (1, 200, 0, 0, 3500, 17_500, 26_000_001, "m"),  # the left pocket, locked by the tower behind it
        (1, 200, 0, 0, 14_500, 17_500, 26_000_001, "m"),  # the right one is open
        (1, 200, 0, 7, 3500, 3500, 26_000_001, "m"),
        (1, 200, 1, 2, 3500, 14_500, 26_000_001, "m"),  # own princess gone: the enemy's pocket is open, but it costs too much
        (1, 200, 0, 0, -1, 40_000, 26_000_001, "m"),
        (1, 200, 0, 0, 9500, 29_500, 28_000_001, "m"),  # a spell goes anywhere
        (2, 99, 0, 0, 3500, 18_500, 26_000_001, "m"),  # under the tower: closed, but not by the pocket alone
        (3, 5, 0, 0, 1, 1, 26_000_001, "m"),
        (1, 200, 0, 0, 1, 1, 26_000_001, None),
    ]
    frame = spark.createDataFrame(labels, "k long, tick int, side int, deck_index int, x long, y long, card_id long, mask string")
    got = {tuple(r)[:8]: (r.legal, r.issues, r.locked) for r in arena.check_labels(frame, masks, towers, moments, ["k"]).collect()}
    closed = "position_not_in_derived_native_mask"
    want = [[closed], [], ["deck_index_not_in_hand"], ["insufficient_native_elixir"], [closed], [], ["deployment_gate_not_open", "native_commands_not_allowed", closed], ["no_reference"], ["no_reference"]]
    assert [got[r][1] for r in labels] == want and [got[r][0] for r in labels] == [w == [] for w in want]
    assert [tuple(got[r][2]) if got[r][2] else None for r in labels] == [(1, 3500, 25_500, 1400, 0, 17, 3), *[None] * 8]


def test_labels_find_what_the_board_has(spark):
    rng = random.Random(6)
    masks = [(f"m{i}", rng.choice([*[26_000_001] * 5, 26_000_032, 28_000_001, 0, None]), "".join(rng.choices("01", [1, 6], k=576)) if i % 3 else OPEN, 3) for i in range(12)] + [("short", 26_000_001, "101", 3), ("odd", 26_000_001, "x" * 576, 3)]
    towers = [(k, rng.choice([0, 1]), rng.choice([0, 1, 1, 1]), rng.randrange(-1000, 19_500), rng.randrange(-1000, 33_500), rng.choice([0, 5, 900, None])) for k in range(30) for _ in range(rng.choice([0, 1, 2, 4, 6]))]
    labels = [(k, i, 200, rng.choice([0, 1, 0, 1, 2]), 0, rng.randrange(-1500, 19_500), rng.choice([rng.randrange(-1500, 33_500), rng.randrange(11_000, 21_000)]), rng.choice([26_000_007, 26_000_007, 28_000_006, 28_000_004, 27_000_013, None]), rng.choice([m[0] for m in masks] + ["none"])) for k in range(32) for i in range(100)]
    frame = spark.createDataFrame(labels, "k long, n int, tick int, side int, deck_index int, x long, y long, card_id long, mask string")
    moments = spark.createDataFrame([(k, 200, True, [0], [0], 9000, 9000) for k in range(32)], "k long, tick int, commands_allowed boolean, hand_0 array<int>, hand_1 array<int>, elixir_0 long, elixir_1 long")
    masks, towers = spark.createDataFrame(masks, MASK), spark.createDataFrame(towers, TOWER)
    row, column = F.floor(F.col("y") / 1000), F.floor(F.col("x") / 1000)
    boards = arena.derived_masks(frame, masks, towers, ["k"])
    side = lambda name: F.when(F.col("side") == 0, F.when(column < 9, F.col(f"{name}_1_0")).otherwise(F.col(f"{name}_1_1"))).otherwise(F.when(column < 9, F.col(f"{name}_0_0")).otherwise(F.col(f"{name}_0_1")))
    at = lambda name: arena.cell_open([F.col(f"{name}{k}") for k in range(arena.WORDS)], row, column)
    pocket = F.when(F.col("side") == 0, row.between(17, 20)).otherwise(row.between(11, 14))
    locked = F.coalesce(~F.col("any_where") & pocket & at("sym") & ~at("foot") & ~at("m") & (side("alive") == 1), F.lit(False))
    want = {(r.k, r.n): ("no_reference" if not r.known else "" if r.open else "position_not_in_derived_native_mask", r.locked and r.known, tuple(r.tower) if r.locked and r.known else None) for r in boards.select("k", "n", F.col("m0").isNotNull().alias("known"), at("m").alias("open"), locked.alias("locked"), side("tower").alias("tower")).collect()}
    got = {(r.k, r.n): (",".join(r.issues), r.locked is not None, (r.locked.tower_x, r.locked.tower_y, r.locked.tower_hp) if r.locked else None) for r in arena.check_labels(frame, masks, towers, moments, ["k"]).collect()}
    assert got == want and len(got) == len(labels) and sum(v[1] for v in got.values()) > 5
    assert {v[0] for v in got.values()} == {"no_reference", "", "position_not_in_derived_native_mask"}


def test_variants_by_tick(spark):
    slots = spark.createDataFrame([(1, 0, 5, "base", False), (1, 1, 6, "unused", True)], "battle int, deck_index int, card_id long, mask string, by_tick boolean")
    variants = spark.createDataFrame([(1, 1, 10, "v10"), (1, 1, 20, "a"), (1, 1, 20, "b")], "battle int, deck_index int, tick int, mask string")
    labels = spark.createDataFrame([(1, 0, 10), (1, 1, 10), (1, 1, 20), (1, 1, 30), (1, 2, 10)], "battle int, deck_index int, tick int")
    for exact, last in ((True, "no_exact_variant"), (False, None)):
        got = {(r.deck_index, r.tick): (r.mask, r.pick_issue) for r in arena.pick_variants(labels, slots, variants, ["battle", "deck_index"], exact).collect()}
        assert got == {(0, 10): ("base", None), (1, 10): ("v10", None), (1, 20): (None, "no_exact_variant"), (1, 30): (None, last), (2, 10): (None, "no_slot")}


def test_rectangles_against_cells(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(2), rng.randrange(-3000, 21_000), rng.randrange(-3000, 35_000), rng.choice([0.0, 0.5, 1.0, 1.3, 20.0]), rng.choice([0.5, 2.0, 0.2]), rng.choice([-2, 1, 5, None])) for _ in range(150)]
    want = {}
    for k, x, y, hx, hy, a in rows:
        for r in range(32):
            for c in range(18):
                if x / 1000 - hx <= c + 0.5 < x / 1000 + hx and y / 1000 - hy <= r + 0.5 < y / 1000 + hy and a:
                    want[k, r, c] = want.get((k, r, c), 0) + a
    got = {(r.k, r.row, r.column): r.amount for r in arena.covered(spark.createDataFrame(rows, "k int, x long, y long, half_x double, half_y double, amount int"), ["k"]).collect()}
    assert got == {k: v for k, v in want.items() if v} and len(got) > 500


def test_planes_route_kinds(spark):
    kind = "k int, relation int, kind string, x long, y long, hp long, flying int, shield long, threat long, half_x double, half_y double"
    rows = [
        (1, 0, "troop", 500, 500, 300, 0, 50, None, None, None), (1, 0, "troop", 700, 900, 100, 1, None, 500, None, None), (1, 0, "unknown", 500, 500, -1, None, None, None, None, None),
        (1, 1, "building", 18_000, 32_000, None, None, None, None, None, None), (1, 1, "king", 9000, 29_000, 2400, None, None, None, 1.0, 1.0),
        (1, 1, "projectile", 0, 0, None, 1, None, None, 3.0, 3.0), (1, 0, "area", 500, 500, None, None, None, None, None, None), (1, 0, "troop", 18_001, 500, 900, 0, None, None, None, None),
    ]
    got = {(r.plane, r.row, r.column): r.value for r in arena.semantic_planes(spark.createDataFrame(rows, kind), ["k"]).collect()}
    king = {(9, r, c): 1.0 for r in (28, 29) for c in (8, 9)}
    assert got == {(0, 0, 0): 1.0, (1, 0, 0): 1.0, (4, 0, 0): 0.04, (5, 0, 0): 0.005, (6, 0, 0): 0.1, (18, 0, 0): 1.0, (9, 31, 17): 1.0, (10, 0, 0): 1.0, (11, 29, 9): 0.24, **king}
    assert arena.semantic_planes(spark.createDataFrame([], kind), ["k"]).isEmpty()
    assert arena.derived_masks(spark.createDataFrame([], "k long, side int, card_id long, mask string"), spark.createDataFrame([], MASK), spark.createDataFrame([], TOWER), ["k"]).filter(F.col("m0") > 0).isEmpty()
