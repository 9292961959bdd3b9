"""Action labels of decision windows, made from command streams and held against stored ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.operators.arena import CELL, COLUMNS, ROWS

#: Ticks of a decision window, delays that an action may have in it, and the actions it may hold.
WINDOW_TICKS, DELAYS, MOST_ACTIONS = 5, (0, 1, 2, 3, 4), 2
ABILITY_BASE = 10_000_000
KEY = ["battle", "tick", "side"]
A_COMMAND, A_DECISION, A_BAD_TICK = 0, 1, 2


def window_of(execution_tick: Column) -> Column:
    """The decision tick whose window holds an execution tick, from 1 on."""
    return (F.floor((execution_tick - 1) / WINDOW_TICKS) * WINDOW_TICKS).cast("long")


def target_cell(x: Column, y: Column, side: Column) -> Column:
    """(cell, error) of a point as its side sees the board; points off the cells' centres aren't guessed at."""
    u, v = F.when(side == 1, COLUMNS * CELL - 1 - x).otherwise(x), F.when(side == 1, ROWS * CELL - 1 - y).otherwise(y)
    off = lambda c: F.abs(F.pmod(c, F.lit(CELL)) - CELL // 2) > 1
    error = F.when(x.isNull() | y.isNull(), "noninteger source target").when(~(u.between(0, COLUMNS * CELL - 1) & v.between(0, ROWS * CELL - 1)), "source target outside board").when(off(u) | off(v), "source target not representable")
    cell = F.floor(v / CELL) * COLUMNS + F.floor(u / CELL)
    return F.struct(F.when(error.isNull(), cell).cast("long").alias("cell"), error.alias("error"))


def candidate_uid(kind: Column, deck_index: Column, entity: Column) -> Column:
    return F.when(kind == "play", deck_index).when(kind == "ability", ABILITY_BASE + F.coalesce(entity, F.lit(-1))).otherwise(-1).cast("long")


def _gathered(decisions: DataFrame, commands: DataFrame, bad_ticks: DataFrame) -> DataFrame:
    """Decisions and the first two commands of their windows, as rows beside each other that know their window.

    _kind tells them apart, _n is how many commands a window has, _all whether all were accepted, _spoilt whether a bad
    tick touches it, _order the place of a command and _c what it does. One union and one order serve all of that, so
    that rows are dealt once at most, and not at all if the frames are dealt by battle.
    """
    c = commands.withColumn("tick", window_of(F.col("execution_tick"))).dropna(subset=KEY).withColumn("_to", F.when(F.col("kind") == "play", target_cell(F.col("x"), F.col("y"), F.col("side"))))
    does = F.struct(candidate_uid(F.col("kind"), F.col("deck_index"), F.col("entity")).alias("uid"), F.coalesce("_to.cell", F.lit(-1).cast("long")).alias("cell"), F.col("_to.error").alias("error"), (F.col("execution_tick") - 1 - F.col("tick")).alias("delay"))
    c = c.select(*KEY, F.lit(A_COMMAND).alias("_kind"), F.col("line").alias("_line"), F.coalesce("accepted", F.lit(False)).cast("int").alias("_accepted"), does.alias("_c"))
    # a bad tick lies in at most two windows: the one it begins or is inside of, and the one it ends
    bad, start = F.col("tick"), (F.floor(F.col("tick") / WINDOW_TICKS) * WINDOW_TICKS).cast("long")
    touched = bad_ticks.dropna(subset=["battle", "tick"]).select("battle", F.explode(F.array_distinct(F.array(start, F.when(bad % WINDOW_TICKS == 0, start - WINDOW_TICKS).otherwise(start)))).alias("tick"), F.lit(A_BAD_TICK).alias("_kind"))
    rows = decisions.withColumn("_kind", F.lit(A_DECISION)).unionByName(c, allowMissingColumns=True).unionByName(touched, allowMissingColumns=True)
    kind, lane = F.col("_kind"), Window.partitionBy(*KEY)
    both = Window.partitionBy("battle", "tick").orderBy("side", "_kind", "_line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_spoilt", F.max(kind == A_BAD_TICK).over(both)).filter(kind != A_BAD_TICK)
    rows = rows.withColumn("_order", F.row_number().over(lane.orderBy("_kind", "_line")))
    rows = rows.withColumns({"_n": F.count("_c").over(lane), "_all": F.min("_accepted").over(lane), "_asked": F.max(kind).over(lane) == A_DECISION})
    return rows.filter((kind == A_DECISION) | (F.col("_asked") & (F.col("_order") <= MOST_ACTIONS))).drop("_line", "_accepted", "_asked")


def _matched(rows: DataFrame, candidates: DataFrame | Callable[[Column], Column], masks: DataFrame) -> DataFrame:
    """The decisions of gathered rows with their first two commands and the one candidate that each names, as structs one and two."""
    about = ["allowed", "cost", "ability", "grid", "first_only", "hand_slot", "group", "building", "half_x", "half_y", "off_x", "off_y", "mask"]
    columns, is_command = rows.columns, F.col("_kind") == A_COMMAND
    if callable(candidates):
        rows = rows.withColumn("_about", F.when(is_command, candidates(F.col("_c.uid")))).withColumn("_times", F.col("_about").isNotNull().cast("long"))
    else:
        # merge: rows that explode hands out aren't in Spark's size estimate, which would send all candidates to the driver
        offered = candidates.groupBy(*KEY, F.col("uid").alias("_uid")).agg(F.count(F.lit(1)).alias("_times"), F.max(F.struct(*about)).alias("_about")).hint("merge")
        rows = rows.withColumn("_uid", F.col("_c.uid")).join(offered, [*KEY, "_uid"], "left")
    rows = rows.withColumn("_mask", F.col("_about.mask")).join(masks.select(F.col("mask").alias("_mask"), "cells", F.contains("cells", F.lit("1")).alias("_any")), "_mask", "left")
    step = F.struct(
        *[F.col(f"_c.{f}").alias(f) for f in ("uid", "cell", "error", "delay")], F.coalesce("_times", F.lit(0)).alias("times"), *[F.col(f"_about.{a}").alias(a) for a in about],
        F.col("_any").alias("any"), F.substr("cells", (F.col("_c.cell") + 1).cast("int"), F.lit(1)).eqNullSafe(F.lit("1")).alias("open"),
    )
    rows = rows.select(*columns, F.when(is_command, step).alias("_step"))
    at = lambda n: F.max(F.when(F.col("_order") == n, F.col("_step"))).over(Window.partitionBy(*KEY))
    return rows.withColumns({"one": at(1), "two": at(2)}).filter(~is_command)


def _problem(step: Column, before: Column | None, elixir: Column) -> Column:
    """The first reason why a command can't be a label at its decision, null if there is none. before: the action ahead."""
    is_ability = F.coalesce(step["ability"], F.lit(False))
    legal = (step["times"] == 1) & F.coalesce(step["allowed"], F.lit(False)) & (~F.coalesce(step["grid"], F.lit(False)) | F.coalesce(step["any"], F.lit(False)))
    left, blocked, late = elixir, F.lit(False), F.lit(False)
    if before is not None:
        left = elixir - before["cost"]
        same = lambda name: F.coalesce((before[name] >= 0) & (step[name] == before[name]), F.lit(False))
        used = (step["uid"] == before["uid"]) | (same("hand_slot") & ~is_ability) | same("group")
        pair = F.coalesce(before["building"] & step["building"], F.lit(False))
        sized = before["half_x"].isNotNull() & step["half_x"].isNotNull()
        legal = legal & ~F.coalesce(step["first_only"], F.lit(False)) & ~(F.coalesce(before["ability"], F.lit(False)) & is_ability) & ~used & ~(pair & ~sized)
        column, row = (lambda s: s["cell"] % COLUMNS + 0.5 + s["off_x"]), (lambda s: F.floor(s["cell"] / COLUMNS) + 0.5 + s["off_y"])
        near = (F.abs(column(step) - column(before)) < step["half_x"] + before["half_x"]) & (F.abs(row(step) - row(before)) < step["half_y"] + before["half_y"])
        blocked, late = pair & F.coalesce(near, F.lit(False)), step["delay"] < before["delay"]
    legal = legal & (step["cost"] <= left + 1e-6)
    return (
        F.when(step["error"].isNotNull(), F.concat(F.lit("unrepresentable:"), step["error"])).when(~F.coalesce(legal, F.lit(False)), F.concat(F.lit("expert_candidate_unavailable:"), step["uid"].cast("string")))
        .when(F.coalesce(step["grid"], F.lit(False)) != (step["cell"] >= 0), "target_mode_mismatch").when((step["cell"] >= 0) & (~step["open"] | blocked), "expert_target_illegal")
        .when(~step["delay"].isin(*DELAYS) | late, "expert_delay_illegal")
    )


def command_labels(decisions: DataFrame, commands: DataFrame, candidates: DataFrame | Callable[[Column], Column], masks: DataFrame, bad_ticks: DataFrame) -> DataFrame:
    """decisions with label, known, actions (how many) and for each of two actions uid, cell and delay (null without one).

    decisions: battle, tick, side (unique), elixir, end_tick (last tick of the battle); commands: battle, side, line,
    execution_tick, accepted, kind (play or ability), deck_index, entity, x, y; candidates: battle, tick, side, uid,
    allowed, cost, ability, grid (takes a target), first_only, hand_slot, group, building, half_x, half_y (null: not
    known), off_x, off_y, mask, or where each uid occurs once at most a function that gives the struct of a uid's candidate at battle,
    tick and side, null without one, which makes no rows for candidates that no command names; masks: mask (unique), cells; bad_ticks: battle, tick.
    Decisions, commands and bad_ticks that are dealt by battle stay where they are.
    Labels, first that holds: incomplete_window (it ends after the battle or holds a bad tick, its last included),
    more_than_two_actions, source_action_rejected_or_unresolved, the reason why a command can't be chosen at the
    decision, action, observed_wait. Only the last two are known. The second action is judged by what the first leaves:
    elixir, hand, groups, abilities, later delays, and room beside a building.
    """
    d = _matched(_gathered(decisions, commands, bad_ticks), candidates, masks)
    n = F.col("_n")
    whole = (F.col("tick") + WINDOW_TICKS <= F.col("end_tick")) & ~F.col("_spoilt")
    why = F.coalesce(_problem(F.col("one"), None, F.col("elixir")), F.when(n > 1, _problem(F.col("two"), F.col("one"), F.col("elixir"))))
    label = (
        F.when(~F.coalesce(whole, F.lit(False)), "incomplete_window").when(n > MOST_ACTIONS, "more_than_two_actions").when(F.col("_all") == 0, "source_action_rejected_or_unresolved")
        .when(n == 0, "observed_wait").otherwise(F.coalesce(why, F.lit("action")))
    )
    d = d.withColumn("label", label).withColumn("known", F.col("label").isin("action", "observed_wait"))
    acts = F.col("label") == "action"
    steps = [F.when(acts, F.col(f"{s}.{f}")).alias(f"{f}_{i}") for i, s in ((1, "one"), (2, "two")) for f in ("uid", "cell", "delay")]
    return d.select(*decisions.columns, "label", "known", F.when(acts, n).otherwise(0).cast("long").alias("actions"), *steps)


def label_parity(stored: DataFrame, derived: DataFrame) -> DataFrame:
    """(battle, tick, side, problem, label) of decisions whose stored label isn't the one derived again.

    Both have battle, tick, side, known, actions and uid, cell, delay of two actions; derived has label. Problems, first
    that holds: not_stored, not_derived, repeated (stored more than once), invalid_action (stored with a number of
    actions, delays or targets that no action has), known_differs (label: the derived reason), action_differs. Actions
    are compared only where both are known; an unknown label has nothing to compare.
    """
    steps = [f"{f}_{i}" for i in (1, 2) for f in ("uid", "cell", "delay")]
    values = ["known", "actions", *steps]
    # one union instead of a join, which would deal both sides by all three keys; an unknown key is no other's equal
    rows = stored.select(*KEY, *values, F.lit(None).cast("string").alias("label"), F.lit(True).alias("_stored")).unionByName(derived.select(*KEY, *values, "label", F.lit(False).alias("_stored")))
    is_stored, unknown = F.col("_stored"), F.greatest(*[F.col(c).isNull() for c in KEY])
    rows = rows.select(*KEY, "label", "_stored", F.struct(*values).alias("_v"), (unknown & is_stored).alias("_apart"))
    lane = Window.partitionBy(*KEY, "_apart")
    rows = rows.withColumn("_first", F.row_number().over(lane.orderBy("_stored"))).withColumns({"_n": F.count(F.when(is_stored, 1)).over(lane), "_s": F.min(F.when(is_stored, F.col("_v"))).over(lane)})
    # a derived row each, and one for what is stored only
    d = rows.filter(~is_stored | (F.col("_first") == 1)).withColumn("_d", F.when(~is_stored, F.col("_v")))
    s, t = F.col("_s"), F.col("_d")
    one = lambda i: s[f"uid_{i}"].isNotNull() & s[f"delay_{i}"].isin(*DELAYS) & s[f"cell_{i}"].between(-1, COLUMNS * ROWS - 1)
    none = lambda i: s[f"uid_{i}"].isNull() & s[f"cell_{i}"].isNull() & s[f"delay_{i}"].isNull()
    valid = F.when(s["actions"] == 0, none(1) & none(2)).when(s["actions"] == 1, one(1) & none(2)).when(s["actions"] == 2, one(1) & one(2) & (s["delay_1"] <= s["delay_2"])).otherwise(False)
    same = s["actions"].eqNullSafe(t["actions"])
    for f in steps:
        same = same & s[f].eqNullSafe(t[f])
    problem = (
        F.when(s.isNull(), "not_stored").when(t.isNull(), "not_derived").when(F.col("_n") > 1, "repeated").when(~F.coalesce(valid, F.lit(False)), "invalid_action")
        .when(~s["known"].eqNullSafe(t["known"]), "known_differs").when(s["known"] & ~same, "action_differs")
    )
    return d.select(*KEY, problem.alias("problem"), "label").filter("problem IS NOT NULL")
