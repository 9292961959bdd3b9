"""Boards of cells packed into words: derived legality masks, label checks against them, and planes of rectangles.

A board has 18 columns and 32 rows. Three rows share a word of 54 bits, which are the text of its cells read as a number
(row r is in word r//3, the first row and column 0 highest; the last word's third row is zero), so that a board is eleven
longs and a text needs no turning: unions of footprints are bit_or aggregates, intersections single
expressions, and no step makes a row for each cell.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COLUMNS, ROWS, CELL, ROWS_A_WORD = 18, 32, 1000, 3
WORDS, BITS = -(-ROWS // ROWS_A_WORD), COLUMNS * ROWS_A_WORD
#: The columns right of the middle, the depth of a pocket, and cards that deploy anywhere.
LANE_SPLIT, POCKET_DEPTH = 9, 5
MIRROR_CARD, SPELL_FAMILY, GLOBAL_CARDS = 28_000_006, 28, (26_000_032, 27_000_013)
#: Issues of a label, in the order of their checks, and the first tick at which cards deploy.
LABEL_ISSUES = ("deck_index_not_in_hand", "deployment_gate_not_open", "native_commands_not_allowed", "insufficient_native_elixir", "position_not_in_derived_native_mask")
GATE_TICK = 100

_long = lambda v: F.lit(v).cast("long")


def _shift(row: int) -> int:
    return COLUMNS * (ROWS_A_WORD - 1 - row % ROWS_A_WORD)


def words_of(rows: Iterable[int], columns: Iterable[int]) -> list[int]:
    """The words of a rectangle of rows and columns, as numbers."""
    across = sum(1 << COLUMNS - 1 - c for c in columns)
    out = [0] * WORDS
    for r in rows:
        out[r // ROWS_A_WORD] |= across << _shift(r)
    return out


#: Rows that each side owns with the bridge row, and the pockets of each lane that open when its tower is gone.
OWN_ROWS = (words_of([*range(0, 15), 16], range(COLUMNS)), words_of([15, *range(17, ROWS)], range(COLUMNS)))
POCKETS = tuple(tuple(words_of(range(16, 16 + POCKET_DEPTH) if side == 0 else range(16 - POCKET_DEPTH, 16), columns) for columns in (range(LANE_SPLIT), range(LANE_SPLIT, COLUMNS))) for side in (0, 1))
#: The boards opened to a side, by its number of 0 to 7: the side, then whether the left and the right lane's enemy tower is gone.
OPENED = [[OWN_ROWS[s][k] | left * POCKETS[s][0][k] | right * POCKETS[s][1][k] for k in range(WORDS)] for s in (0, 1) for left in (0, 1) for right in (0, 1)]
#: Rows in which a locked pocket can be the only reason for a closed cell.
LOCKED_ROWS = ((17, 20), (11, 14))


def _rows_of(word: int) -> range:
    return range(word * ROWS_A_WORD, min(ROWS, (word + 1) * ROWS_A_WORD))


def _packed(row: str, word: int) -> str:
    """SQL for one word of rows whose cells are the decimal digits of a number: its remainder by 8 is its last three digits
    read in base two, as 10 and 2 differ by 8."""
    return " | ".join(f"shiftleft({row}{r} div {10 ** i} & 7L, {_shift(r) + i})" for r in _rows_of(word) for i in range(0, COLUMNS, 3))


def _upside(name: str, word: int) -> str:
    """SQL for one word of a board with its rows in reverse order."""
    line = lambda r: f"((shiftright({name}{r // ROWS_A_WORD}, {_shift(r)}) & {(1 << COLUMNS) - 1}L)"
    return "(" + " | ".join(f"shiftleft({line(ROWS - 1 - r)}), {_shift(r)})" for r in _rows_of(word)) + ")"


def _clean(cells: str) -> Column:
    """The text of a board, or null where it isn't one."""
    return F.when((F.length(cells) == COLUMNS * ROWS) & F.col(cells).rlike(r"\A[01]*\z"), F.col(cells))


def pack(masks: DataFrame, cells: str = "cells") -> DataFrame:
    """masks with own0.. (the words of its cells, a text of 0 and 1 row by row) and sym0.. (cells open in all four of
    the cell, its mirror images across the middle column and the middle row, and both). Texts of another length or
    with other characters give nulls."""
    # bytes: a substring of a text is looked for from its start
    texts = masks.withColumn("_text", _clean(cells)).withColumns({"_cells": F.col("_text").cast("binary"), "_turned": F.reverse("_text").cast("binary")})
    numbers = texts.withColumns({f"{name}{r}": F.substring(text, r * COLUMNS + 1, COLUMNS).cast("string").cast("long") for name, text in (("_r", "_cells"), ("_s", "_turned")) for r in range(ROWS)})
    words = numbers.withColumns({f"{name}{k}": F.expr(_packed(row, k)) for name, row in (("own", "_r"), ("_t", "_s")) for k in range(WORDS)})
    out = {f"sym{k}": F.expr(" & ".join([f"own{k}", f"_t{k}", _upside("own", k), _upside("_t", k)])) for k in range(WORDS)}
    return words.withColumns(out).drop("_text", "_cells", "_turned", *[f"_t{k}" for k in range(WORDS)], *[f"{name}{r}" for name in ("_r", "_s") for r in range(ROWS)])


def unpack(words: list[Column]) -> Column:
    """The board as a text of 0 and 1, row by row."""
    return F.concat(*[F.substring(F.bin(w.bitwiseOR(_long(1 << BITS))), 2, len(_rows_of(k)) * COLUMNS) for k, w in enumerate(words)])


def _inside(row: Column, column: Column) -> Column:
    return (row >= 0) & (row < ROWS) & (column >= 0) & (column < COLUMNS)


def cell_open(words: list[Column], row: Column, column: Column, board: Column | int = 0) -> Column:
    """Whether a cell of the board is 1; null outside the board. Words may hold several boards, one after the other."""
    word = F.get(F.array(*words), (F.floor(row / ROWS_A_WORD) + board * WORDS).cast("int"))
    bit = BITS - 1 - F.pmod(row, F.lit(ROWS_A_WORD)) * COLUMNS - column
    return F.when(_inside(row, column), F.call_function("shiftright", word, bit.cast("int")).bitwiseAND(_long(1)) == 1)


def byte_open(board: str, row: Column, column: Column) -> Column:
    """Whether a cell of a board's text, given as bytes, is 1; null outside the board."""
    at = (row * COLUMNS + column + 1).cast("int")
    return F.when(_inside(row, column), F.substring(F.col(board), at, F.lit(1)) == F.lit(b"1"))


def with_footprint(rows: DataFrame, half: Column) -> DataFrame:
    """rows (x, y) with _f0..: the words of the cells that a square of a half extent around the point touches, cut at the
    board's edge."""
    at = lambda v, most: F.least(F.greatest(F.floor(v / CELL), _long(0)), _long(most))
    x, y, h = F.col("x"), F.col("y"), F.col("_half")
    d = rows.withColumn("_half", half).withColumns({"_c0": at(x - h, COLUMNS), "_c1": at(x + h + CELL - 1, COLUMNS), "_r0": at(y - h, ROWS), "_r1": at(y + h + CELL - 1, ROWS)})
    d = d.withColumn("_across", F.expr(f"greatest(shiftleft(1L, int({COLUMNS} - _c0)) - shiftleft(1L, int({COLUMNS} - _c1)), 0L)"))
    word = lambda k: " | ".join(f"if(_r0 <= {r} AND _r1 > {r}, shiftleft(_across, {_shift(r)}), 0L)" for r in _rows_of(k))
    return d.withColumns({f"_f{k}": F.expr(word(k)) for k in range(WORDS)}).drop("_half", "_c0", "_c1", "_r0", "_r1", "_across")


def tower_boards(towers: DataFrame, key: list[str]) -> DataFrame:
    """A row for each key of living towers (side, role 0 king or 1 princess, x, y, hp): foot0.. (cells under them) and for
    each side and lane its princess towers: alive_s_l (how many) and tower_s_l (x, y, hp of the one, where there is one)."""
    # dealt by key first: sums of a task of the input would hold nearly a row of words for each of its towers
    lives = towers.filter("hp > 0").select(*key, "side", "role", "x", "y", "hp").repartition(*key)
    rows = with_footprint(lives, F.when(F.col("role") == 0, 4).otherwise(3) * (CELL // 2))
    aggs = [F.coalesce(F.bit_or(F.col(f"_f{k}")), _long(0)).alias(f"foot{k}") for k in range(WORDS)]
    lanes = [f"{side}_{lane}" for side in (0, 1) for lane in (0, 1)]
    for name in lanes:
        side, lane = map(int, name.split("_"))
        here = (F.col("side") == side) & (F.col("role") == 1) & ((F.col("x") >= LANE_SPLIT * CELL).cast("int") == lane)
        # a struct's maximum would be found by sorting the rows of words
        aggs += [F.count_if(here).alias(f"alive_{name}"), *[F.max(F.when(here, F.col(c))).alias(f"_{c}_{name}") for c in ("x", "y", "hp")]]
    one = {f"tower_{name}": F.when(F.col(f"alive_{name}") == 1, F.struct(*[F.col(f"_{c}_{name}").alias(c) for c in ("x", "y", "hp")])) for name in lanes}
    return rows.groupBy(*key).agg(*aggs).withColumns(one).drop(*[f"_{c}_{name}" for name in lanes for c in ("x", "y", "hp")])


def with_towers(rows: DataFrame, boards: DataFrame, key: list[str]) -> DataFrame:
    """rows (side) with their key's row of tower_boards and _open, the number of what OPENED has for them."""
    none = {f"foot{k}": F.coalesce(f"foot{k}", _long(0)) for k in range(WORDS)}
    none |= {f"alive_{s}_{lane}": F.coalesce(f"alive_{s}_{lane}", _long(0)) for s in (0, 1) for lane in (0, 1)}
    gone = lambda lane: F.when(F.col("side") == 0, F.col(f"alive_1_{lane}") == 0).otherwise(F.col(f"alive_0_{lane}") == 0).cast("int")
    d = rows.join(boards, key, "left").withColumns(none)
    return d.withColumn("_open", F.when(F.col("side").isin(0, 1), F.col("side").cast("int") * 4 + gone(0) * 2 + gone(1)))


def deploys_anywhere(card: Column, data: Column) -> Column:
    """Spells by card (the mirror card goes by what it became) or by what the card became, and cards named as global."""
    family = lambda c: F.floor(c / 1_000_000) == SPELL_FAMILY
    return (family(card) & (card != MIRROR_CARD)) | family(data) | card.isin(*GLOBAL_CARDS) | data.isin(*GLOBAL_CARDS)


def derived_masks(slots: DataFrame, masks: DataFrame, towers: DataFrame, key: list[str]) -> DataFrame:
    """slots with the words m0.. of the board on which their card may be placed now, and foot0.., sym0.., any_where and
    the towers for further checks.

    slots: key (of a moment), side, card_id, mask; masks: mask (unique), data_id, cells; towers: key, side, role, x, y, hp.
    A card that deploys anywhere has its mask as it is. Others have the mask's fourfold symmetric part within their
    side's rows, the bridge row and the pockets whose enemy princess tower is gone, less the cells under living towers.
    Moments without towers have open pockets. Slots without a mask, or whose data_id isn't positive, have null words.
    """
    packed = pack(masks.select("mask", "data_id", "cells")).withColumn("_ok", F.col("data_id") > 0).drop("cells")
    d = with_towers(slots.join(packed, "mask", "left"), tower_boards(towers, key), key).withColumn("any_where", deploys_anywhere(F.col("card_id"), F.col("data_id")))
    out = {}
    for k in range(WORDS):
        opened = F.get(F.array(*[_long(board[k]) for board in OPENED]), F.col("_open"))
        placed = F.col(f"sym{k}").bitwiseAND(opened).bitwiseAND(F.bitwise_not(F.col(f"foot{k}")))
        out[f"m{k}"] = F.when(F.col("_ok"), F.when(F.col("any_where"), F.col(f"own{k}")).otherwise(placed))
    return d.withColumns(out).drop("_open")


def mask_words() -> list[Column]:
    return [F.col(f"m{k}") for k in range(WORDS)]


def locked_pocket(x: Column, y: Column, symmetric: Column, under: Column, placed: Column) -> Column:
    """On rows of with_towers with any_where: what closes the cell of a point, where that is a pocket locked by the one
    living enemy princess tower of its lane, and nothing else: (tower_side, tower_x, tower_y, tower_hp, lane, row, column),
    else null. Of the cell are given: whether it is open in the mask's symmetric part, under a tower, and open in all."""
    row, column = F.floor(y / CELL), F.floor(x / CELL)
    side, lane = F.col("side"), (column >= LANE_SPLIT).cast("int")
    rows = F.when(side == 0, row.between(*LOCKED_ROWS[0])).otherwise(row.between(*LOCKED_ROWS[1]))
    pick = lambda name: F.when((side == 0) & (lane == 0), F.col(f"{name}_1_0")).when(side == 0, F.col(f"{name}_1_1")).when(lane == 0, F.col(f"{name}_0_0")).otherwise(F.col(f"{name}_0_1"))
    only = ~F.col("any_where") & rows & symmetric & (pick("alive") == 1) & ~under & ~placed
    tower = pick("tower")
    proof = F.struct((1 - side).alias("tower_side"), tower["x"].alias("tower_x"), tower["y"].alias("tower_y"), tower["hp"].alias("tower_hp"), lane.alias("lane"), row.cast("int").alias("row"), column.cast("int").alias("column"))
    return F.when(only, proof)


def pick_variants(labels: DataFrame, slots: DataFrame, variants: DataFrame, slot: list[str], exact: bool = True) -> DataFrame:
    """labels (slot, tick) with card_id, mask and pick_issue. slots: slot (unique), card_id, mask, by_tick; variants: slot,
    tick, mask. A slot that is by_tick takes the mask of its one variant at the label's tick; without one, or with
    several, it has none and the issue no_exact_variant. exact=False lets a label without a variant pass without a mask."""
    at = variants.groupBy(*slot, "tick").agg(F.count(F.lit(1)).alias("_n"), F.max("mask").alias("_variant"))
    d = labels.join(slots, slot, "left").join(at, [*slot, "tick"], "left")
    n = F.coalesce("_n", F.lit(0))
    by_tick = F.coalesce(F.col("by_tick"), F.lit(False))
    issue = F.when(F.col("card_id").isNull(), "no_slot").when(by_tick & ((n > 1) | (F.lit(exact) & (n == 0))), "no_exact_variant")
    return d.select(*labels.columns, "card_id", F.when(by_tick, F.when(n == 1, F.col("_variant"))).otherwise(F.col("mask")).alias("mask"), issue.alias("pick_issue"))


def check_labels(labels: DataFrame, masks: DataFrame, towers: DataFrame, moments: DataFrame, key: list[str]) -> DataFrame:
    """labels with legal, issues (LABEL_ISSUES in order) and locked (see locked_pocket).

    labels: key, tick, side, deck_index, x, y, card_id, mask; masks: mask, data_id, cells, cost_raw; moments: key (unique),
    tick, commands_allowed, hand_0 and hand_1 (arrays of deck indices), elixir_0 and elixir_1. Labels without a moment
    or a mask have the one issue no_reference.

    A label needs one cell of its board. What the mask has there, and at the three cells that mirror it, is read where
    label and mask meet, so that no board goes on to the moments. Tables join by merging: a mask takes more than its file.
    """
    row, column = F.floor(F.col("y") / CELL), F.floor(F.col("x") / CELL)
    texts = masks.select("mask", "data_id", _clean("cells").cast("binary").alias("_cells"), "cost_raw").hint("merge")
    own = byte_open("_cells", row, column)
    mirrored = [byte_open("_cells", r, c) for r, c in ((row, COLUMNS - 1 - column), (ROWS - 1 - row, column), (ROWS - 1 - row, COLUMNS - 1 - column))]
    any_where = deploys_anywhere(F.col("card_id"), F.col("data_id"))
    cells = labels.join(texts, "mask", "left").select(
        *labels.columns, "cost_raw", any_where.alias("any_where"), ((F.col("data_id") > 0) & F.col("_cells").isNotNull()).alias("_board"), own.alias("_own"), reduce(Column.__and__, mirrored, own).alias("_sym"),
    )
    d = with_towers(cells, tower_boards(towers, key).hint("merge"), key).join(moments.drop("tick").withColumn("_there", F.lit(True)).hint("merge"), key, "left")
    d = d.withColumn("_under", cell_open([F.col(f"foot{k}") for k in range(WORDS)], row, column))
    opened = cell_open([_long(w) for board in OPENED for w in board], row, column, F.col("_open"))
    d = d.withColumn("_placed", F.when(F.col("any_where"), F.col("_own")).otherwise(F.col("_sym") & opened & ~F.col("_under")))
    of_side = lambda name: F.when(F.col("side") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))
    broken = [
        ~F.coalesce(F.array_contains(of_side("hand"), F.col("deck_index")), F.lit(False)), F.col("tick") < GATE_TICK, ~F.coalesce(F.col("commands_allowed"), F.lit(False)),
        F.coalesce(of_side("elixir") < F.col("cost_raw"), F.lit(True)), ~F.coalesce(F.col("_placed"), F.lit(False)),
    ]
    known = F.coalesce(F.col("_there") & F.col("_board") & (F.col("any_where") | F.col("_open").isNotNull()), F.lit(False))
    issues = F.when(known, F.array_compact(F.array(*[F.when(b, name) for b, name in zip(broken, LABEL_ISSUES, strict=True)]))).otherwise(F.array(F.lit("no_reference")))
    locked = locked_pocket(F.col("x"), F.col("y"), F.col("_sym"), F.col("_under"), F.col("_placed"))
    return d.select(*labels.columns, (F.size(issues) == 0).alias("legal"), issues.alias("issues"), F.when(known, locked).alias("locked"))


def covered(rectangles: DataFrame, key: list[str], amount: str = "amount") -> DataFrame:
    """(key, row, column, amount): sums of whole amounts over the cells that rectangles cover; sums of zero are left out.

    rectangles: x, y (in thousandths of a cell), half_x, half_y (cells). One covers the cells whose middle is in
    [x - half_x, x + half_x) and [y - half_y, y + half_y), cut at the board's edge. It becomes four signed corners
    whatever its area; sums down the rows and along the columns give the cells. A key gathers a row of 18 sums for
    each board row that holds a corner. Null amounts count as nothing.
    """
    bound = lambda v, half, most: F.least(F.greatest(F.ceil(v / CELL + half - 0.5), _long(0)), _long(most))
    spans = rectangles.filter(F.col(amount).isNotNull()).select(
        *key, F.col(amount).cast("long").alias("_a"), bound(F.col("x"), -F.col("half_x"), COLUMNS).alias("_c0"), bound(F.col("x"), F.col("half_x"), COLUMNS).alias("_c1"),
        bound(F.col("y"), -F.col("half_y"), ROWS).alias("_r0"), bound(F.col("y"), F.col("half_y"), ROWS).alias("_r1"),
    ).filter("_r1 > _r0 AND _c1 > _c0")
    corner = lambda r, c, sign: F.struct(F.col(r).alias("row"), F.col(c).alias("column"), (sign * F.col("_a")).alias("_a"))
    corners = F.array(corner("_r0", "_c0", 1), corner("_r0", "_c1", -1), corner("_r1", "_c0", -1), corner("_r1", "_c1", 1))
    corners = spans.select(*key, F.explode(corners).alias("s")).select(*key, "s.*")
    along = corners.groupBy(*key, "row").agg(*[F.sum(F.when(F.col("column") <= i, F.col("_a")).otherwise(0)).alias(f"_s{i}") for i in range(COLUMNS)])
    down = Window.partitionBy(*key).orderBy("row")
    lines = along.select(*key, "row", F.lead("row").over(down).alias("_next"), F.array(*[F.sum(f"_s{i}").over(down) for i in range(COLUMNS)]).alias("_line")).filter("_next IS NOT NULL")
    cells = lines.select(*key, "row", "_next", F.posexplode("_line").alias("column", amount)).filter(F.col(amount) != 0)
    return cells.select(*key, F.explode(F.sequence("row", F.col("_next") - 1)).alias("row"), "column", amount).withColumn("row", F.col("row").cast("int"))


#: Planes by side (relation 0 own, 1 enemy) with the divisor of their sums, and the planes of areas.
SIDE_PLANES = {"ground": 1, "flying": 1, "building": 1, "projectile": 1, "hp": 10_000, "shield": 10_000, "threat": 5_000}
AREA_PLANE = 18
STANDING = ("building", "king", "princess")


def semantic_planes(entities: DataFrame, key: list[str]) -> DataFrame:
    """(key, plane, row, column, value): what stands, moves and works in each cell, cells of zero left out.

    entities: relation (0 own, 1 enemy), kind, x, y (thousandths of a cell), hp (unknown: null or negative), and
    nullable flying, shield, threat, half_x, half_y. Planes of a side are those of SIDE_PLANES, seven a side; buildings
    and towers with an extent cover their rectangle, all else its cell. Kinds that are neither standing nor
    projectiles count as ground or flying only where flying is known. Entities off the board are left out. Sums are of
    whole numbers, divided last.
    """
    base, n = F.col("relation") * len(SIDE_PLANES), len(SIDE_PLANES)
    place = {name: i for i, name in enumerate(SIDE_PLANES)}
    standing = F.col("kind").isin(*STANDING)
    extent = standing & (F.coalesce(F.col("half_x"), F.lit(0)) + F.coalesce(F.col("half_y"), F.lit(0)) > 0)
    moves = ~standing & (F.col("kind") != "projectile") & F.col("flying").isNotNull()
    item = lambda plane, amount, when, area=False: F.when(when, F.struct(plane.cast("int").alias("plane"), amount.cast("long").alias("amount"), F.lit(area).alias("area")))
    one = F.lit(1)
    items = F.array_compact(F.array(
        item(base + place["building"], one, extent, True), item(base + place["building"], one, standing & ~extent), item(base + place["projectile"], one, F.col("kind") == "projectile"),
        item(base + F.when(F.col("flying") > 0, place["flying"]).otherwise(place["ground"]), one, moves), item(base + place["hp"], F.col("hp"), F.col("hp") >= 0),
        item(base + place["shield"], F.col("shield"), F.col("shield").isNotNull()), item(base + place["threat"], F.col("threat"), F.col("threat").isNotNull()),
        item(F.lit(AREA_PLANE) + F.col("relation"), one, F.col("kind") == "area"),
    ))
    on_board = F.col("x").between(0, COLUMNS * CELL) & F.col("y").between(0, ROWS * CELL)
    # dealt by key first: sums of a task of the input would hold nearly a row for each of its items
    there = entities.filter(on_board).repartition(*key)
    rows = there.select(*key, "x", "y", F.coalesce("half_x", F.lit(0)).alias("half_x"), F.coalesce("half_y", F.lit(0)).alias("half_y"), F.explode(items).alias("i")).select("*", "i.*")
    cell = lambda v, most: F.least(F.floor(F.col(v) / CELL), _long(most - 1)).cast("int")
    points = rows.filter(~F.col("area")).groupBy(*key, "plane", cell("y", ROWS).alias("row"), cell("x", COLUMNS).alias("column")).agg(F.sum("amount").alias("amount"))
    both = points.unionByName(covered(rows.filter("area"), [*key, "plane"]))
    sums = both.groupBy(*key, "plane", "row", "column").agg(F.sum("amount").alias("amount")).filter("amount <> 0")
    scale = F.element_at(F.array(*[F.lit(float(v)) for v in SIDE_PLANES.values()]), F.when(F.col("plane") < 2 * n, F.col("plane") % n).otherwise(0).cast("int") + 1)
    return sums.select(*key, "plane", "row", "column", (F.col("amount") / scale).alias("value"))
