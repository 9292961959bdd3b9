"""Recorded matches as nested documents: audits with named reasons, version windows, coordinates, side views, facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.functions import scalars as S

# Groups of reasons in their order of priority.
QUARANTINE = [
    ("definite_2v2", ["team_size_2", "opponent_size_2"]),
    ("corrupt_or_empty", ["missing_battle_tag", "missing_card_plays"]),
    ("confirmed_special_mode", ["list_not_1v1", "draft_or_special_selection"]),
    ("invalid_result_metadata", ["invalid_duration", "invalid_team_crowns", "invalid_opponent_crowns"]),
    ("multi_deck_or_parser_anomaly", ["team_more_than_8_cards", "opponent_more_than_8_cards"]),
]
SIDES = ("team", "opponent")


def _when(rules: dict[str, Column]) -> list[Column]:
    return [F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]


def _card(play: Column) -> Column:
    return F.lower(F.trim(F.coalesce(play["card"], F.lit(""))))


def played(side: str, plays: str = "card_plays") -> Column:
    """Different base cards that a side played; cards that can't be told are left out."""
    mine = F.filter(plays, lambda p: (p["side"] == side) & ~_card(p).isin("", "_invalid"))
    return F.coalesce(F.array_distinct(F.transform(mine, lambda p: S.base_token(_card(p)))), F.array().cast("array<string>"))


def goes_back(plays: str = "card_plays") -> Column:
    """Does a play of a known side come before the latest good tick so far?"""
    known = F.filter(plays, lambda p: p["side"].isin(*SIDES) & (p["time_raw"] >= 0))
    start = F.struct(F.lit(-1).cast("long").alias("top"), F.lit(False).alias("bad"))
    step = lambda a, p: F.struct(F.greatest(a["top"], p["time_raw"].cast("long")).alias("top"), (a["bad"] | (p["time_raw"] < a["top"])).alias("bad"))
    return F.aggregate(known, start, step)["bad"]


def battle_reasons(every_card: bool = False) -> Column:
    """Sorted reasons against a battle, one row each.

    Needs battle_tag, card_plays (side, card, time_raw, x, y), duration_seconds, indexed (is it in the index?), team_tags,
    opponent_tags, team_crowns, opponent_crowns, and metadata (players, draft, team_deck, opponent_deck), null where
    there is none. every_card asks for exactly eight cards a side.
    """
    p = F.coalesce(F.col("card_plays"), F.array())
    some = lambda f: F.exists("card_plays", lambda x: F.coalesce(f(x), F.lit(True)))
    mine = lambda f: some(lambda x: x["side"].isin(*SIDES) & F.coalesce(f(x), F.lit(True)))
    m = F.col("metadata")
    deck = {s: F.coalesce(m[f"{s}_deck"], F.array().cast("array<string>")) for s in SIDES}
    full = (F.size(deck["team"]) == 8) & (F.size(deck["opponent"]) == 8)
    rules = {
        "missing_battle_tag": F.coalesce(F.trim("battle_tag"), F.lit("")) == "",
        "missing_card_plays": F.size(p) == 0,
        "invalid_duration": ~F.coalesce(F.col("duration_seconds").between(1, 360), F.lit(False)),
        "invalid_side": some(lambda x: ~x["side"].isin(*SIDES)),
        "invalid_card": mine(lambda x: _card(x).isin("", "_invalid")),
        "invalid_tick": mine(lambda x: x["time_raw"] < 0),
        "nonmonotonic_tick": goes_back(),
        "invalid_x": mine(lambda x: ~x["x"].between(0, 18000)),
        "invalid_y": mine(lambda x: ~x["y"].between(0, 32000)),
        "missing_index_metadata": ~F.coalesce(F.col("indexed"), F.lit(False)),
        "list_not_1v1": m.isNotNull() & ~F.coalesce(m["players"] == "1v1", F.lit(False)),
        "draft_or_special_selection": m.isNotNull() & ~F.coalesce(m["draft"].isin("0", "False", "false"), F.lit(False)),
        "incomplete_list_deck": m.isNotNull() & ~full,
    }
    found = _when(rules)
    for s in SIDES:
        tags, crowns = F.filter(f"{s}_tags", lambda t: F.coalesce(t, F.lit("")) != ""), F.col(f"{s}_crowns")
        size = F.when(F.col(f"{s}_tags").isNull(), 0).otherwise(F.size(tags))
        found.append(F.when(size != 1, F.concat(F.lit(f"{s}_size_"), size)))
        found += _when({
            f"invalid_{s}_crowns": ~F.coalesce(crowns.between(0, 3), F.lit(False)),
            f"{s}_more_than_8_cards": F.size(played(s)) > 8,
            f"{s}_incomplete_observed_cycle": F.lit(every_card) & (F.size(played(s)) != 8),
            f"{s}_play_not_in_deck": m.isNotNull() & full & (F.size(F.array_except(played(s), F.transform(deck[s], S.base_token))) > 0),
        })
    return F.array_sort(F.array_compact(F.array(*found)))


def battle_class(reasons: Column) -> Column:
    """rejected for any reason but a missing index row; confirmed_1v1 with metadata and full decks; else uncertain_1v1."""
    m = F.col("metadata")
    full = F.coalesce((F.size(m["team_deck"]) == 8) & (F.size(m["opponent_deck"]) == 8), F.lit(False))
    hard = F.size(F.array_except(reasons, F.array(F.lit("missing_index_metadata")))) > 0
    return F.when(hard, "rejected").when(m.isNotNull() & full, "confirmed_1v1").otherwise("uncertain_1v1")


def version_window(rows: DataFrame, timestamp: str, cursor: str, least: int) -> DataFrame:
    """rows with version_timestamp, its quality and accepted: an exact time, else the list cursor as an upper bound, else
    recent_first_page, which passes."""
    exact, upper = S.unix_seconds_of(F.col(timestamp)), F.col(cursor).cast("long")
    quality = F.when(exact.isNotNull(), "exact").when(upper.isNotNull(), "list_cursor_upper_bound").otherwise("recent_first_page")
    out = rows.withColumn("version_timestamp", F.coalesce(exact, upper)).withColumn("quality", quality)
    return out.withColumn("accepted", F.coalesce(F.col("version_timestamp") >= least, F.lit(True)))


def cursor_of(url: Column) -> Column:
    """Unix seconds of a page's cursor (before=, seconds or milliseconds), or null."""
    found = F.regexp_extract(url, r"[?&]before=(\d{10,13})(?:&|#|$)", 1)
    return S.unix_seconds_of(F.when(found != "", found))


def native_point(play: Column) -> Column:
    """(x, y, flag, provenance) of a play: raw markers rotated for flag 0 and as they are for 1, else the old x and y.

    null where the raw flag or place is impossible or the point is off the board.
    """
    raw = play["x_raw"].isNotNull() & play["y_raw"].isNotNull() & play["data_i"].isNotNull()
    sound = play["data_i"].isin(0, 1) & play["x_raw"].between(0, 18000) & play["y_raw"].between(0, 32000)
    turned = lambda v, top: F.when(play["data_i"] == 0, top - v).otherwise(v)
    x = F.when(~raw, play["x"]).when(sound, turned(play["x_raw"], 18000)).cast("int")
    y = F.when(~raw, play["y"]).when(sound, turned(play["y_raw"], 32000)).cast("int")
    point = F.struct(x.alias("x"), y.alias("y"), F.when(raw, play["data_i"]).alias("flag"), F.when(raw, "raw_marker").otherwise("legacy_xy").alias("provenance"))
    return F.when(x.between(0, 17999) & y.between(0, 31999), point)


def coordinate_tier(plays: str = "card_plays") -> Column:
    """(tier, events, exact, zero, one, legacy) of a battle's plays by their raw markers."""
    good = lambda p: p["x_raw"].isNotNull() & p["y_raw"].isNotNull() & F.coalesce(p["data_i"].isin(0, 1), F.lit(False))
    n = F.coalesce(F.size(plays), F.lit(0))
    count = lambda f: F.coalesce(F.size(F.filter(plays, f)), F.lit(0))
    exact = count(good)
    tier = F.when((n > 0) & (exact == n), "all_card_events_raw_data_i").when(exact > 0, "partial_raw_data_i").otherwise("legacy_xy_only")
    return F.struct(
        tier.alias("tier"), n.alias("events"), exact.alias("exact"), count(lambda p: good(p) & (p["data_i"] == 0)).alias("zero"),
        count(lambda p: good(p) & (p["data_i"] == 1)).alias("one"), (n - exact).alias("legacy"),
    )


def ability_log_tier(counts: list[Column], events: str = "ability_plays") -> Column:
    """How complete a battle's ability log is, from the counts that the source reports for both sides."""
    counts = [F.coalesce(c, F.lit(0)) for c in counts]
    of = lambda side: F.size(F.filter(events, lambda e: e["side"] == side))
    seen = [of(s) for s in SIDES]
    same = (seen[0] == counts[0]) & (seen[1] == counts[1])
    return (
        F.when((counts[0] == 0) & (counts[1] == 0), "source_reports_zero").when(F.col(events).isNull(), "count_only_missing_ticks")
        .when(same, "observed_ticks_identity_runtime_resolved").otherwise("observed_tick_count_mismatch")
    )


def side_views(entities: DataFrame, private: list[str]) -> DataFrame:
    """Each entity (side, x, y) as either side sees it: relation 0 for own, enemy's private columns null, the board
    turned for side 1."""
    out = entities.withColumn("actor", F.explode(F.array(F.lit(0), F.lit(1))))
    out = out.withColumn("relation", (F.col("side") != F.col("actor")).cast("int"))
    turned = S.rotated(F.col("x"), F.col("y"))
    point = {c: F.when(F.col("actor") == 0, F.col(c)).otherwise(turned[c]) for c in ("x", "y")}
    return out.withColumns(point | {c: F.when(F.col("relation") == 0, F.col(c)) for c in private}).drop("side")


def public_scalars(n_own: Column, n_enemy: Column, hp: Column, most_hp: Column, most: int = 64) -> Column:
    """Ratios and clipped log counts of a side's view, each in [0, 1]; a ratio of unknown parts is unknown."""
    scale = lambda n: F.least(F.lit(1.0), F.log1p(n) / F.log1p(F.lit(float(most))))
    return F.struct(scale(n_own).alias("own"), scale(n_enemy).alias("enemy"), F.when(most_hp > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), hp / most_hp))).alias("hp"))


def censored(tick: Column, opening: int, terminated: Column, crowns: Column, phase: Column, terminal: list[int]) -> Column:
    """Is no action possible: before the opening, after the end, at three crowns or in a terminal phase?"""
    return (tick < opening) | F.coalesce(terminated, F.lit(False)) | F.coalesce(crowns >= 3, F.lit(False)) | F.coalesce(phase.isin(*terminal), F.lit(False))


def trusted(end: Column, divergence: Column, tail: int) -> Column:
    """Does a window end early enough before the first divergence? Without one all windows do."""
    return F.coalesce(end <= divergence - tail, F.lit(True))


def stream_facts(frames: DataFrame, events: DataFrame, capture: str) -> DataFrame:
    """One row for each capture: ticks and their gaps and repeats, gaps in the events' sequence of each epoch, keys that
    stand for different things, keys without lineage, and damage.

    frames has (capture, line, tick); events (capture, epoch, line, sequence, key, identity, explained, damage). A
    repeated tick is no gap; a jump or a step back is.
    """
    step = F.col("tick") - F.lag("tick").over(Window.partitionBy(capture).orderBy("line"))
    ticks = frames.withColumn("step", step).groupBy(capture).agg(
        F.min_by("tick", "line").alias("first_tick"), F.max_by("tick", "line").alias("last_tick"), F.count(F.lit(1)).alias("frames"),
        F.count_if(~F.col("step").isin(0, 1)).alias("frame_gaps"), F.count_if(F.col("step") == 0).alias("repeats"))
    jump = F.col("sequence") - F.lag("sequence").over(Window.partitionBy(capture, "epoch").orderBy("line"))
    told = events.withColumn("jump", jump)
    keys = told.groupBy(capture, "key").agg(F.countDistinct("identity").alias("n"), F.bool_or("explained").alias("explained"), F.sum("damage").alias("damage"), F.count_if(F.col("jump") != 1).alias("gaps"))
    facts = keys.groupBy(capture).agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("reused"), F.count_if(~F.coalesce("explained", F.lit(False))).alias("without_lineage"), F.sum("gaps").alias("sequence_gaps"), F.sum("damage").alias("damage"))
    return ticks.join(facts, capture, "left")


def observed(events: DataFrame, key: list[str], identity: str, tick: str, frame: str, order: str, payload: list[str]) -> DataFrame:
    """Events once each with observed_tick and status: an event whose identity came before with the same tick and payload
    is dropped, one that differs from it is a conflict, and one behind the latest tick of earlier frames is late. Events
    of a frame that repeats the tick before are seen one tick later. Different events of one frame are no repeats.

    frame numbers the frames of a key as they come, order the events; rows without an identity stand for themselves.
    """
    same = Window.partitionBy(*key, identity).orderBy(order)
    told = F.struct(tick, *payload)
    first = F.first(told).over(same.rowsBetween(Window.unboundedPreceding, 0))
    again = F.col(identity).isNotNull() & (F.row_number().over(same) > 1)
    before = Window.partitionBy(*key).orderBy(frame).rangeBetween(Window.unboundedPreceding, -1)
    out = events.withColumn("_again", again).withColumn("_equal", told.eqNullSafe(first)).withColumn("_top", F.max(tick).over(before))
    out = out.filter(~(F.col("_again") & F.col("_equal"))).withColumn("observed_tick", F.col(tick) + F.coalesce((F.col(tick) == F.col("_top")).cast("int"), F.lit(0)))
    status = F.when(F.col("_again"), "conflict").when(F.coalesce(F.col(tick) < F.col("_top"), F.lit(False)), "late").otherwise("fresh")
    return out.withColumn("status", status).drop("_again", "_equal", "_top")


def deployment_totals(births: DataFrame, damage: DataFrame, as_of: int) -> DataFrame:
    """Damage by deployment and kind of target, how many descendants it has, and whether all of them are dead, from what
    was observed by a tick.

    births has (key, deployment, observed, died), one row a key; damage (source_key, target_kind, amount, observed).
    """
    seen = births.filter((F.col("observed") <= as_of) & F.col("deployment").isNotNull())
    done = damage.filter(F.col("observed") <= as_of).groupBy(F.col("source_key").alias("key")).agg(
        F.sum(F.when(F.col("target_kind") == "unit", F.col("amount"))).alias("unit"), F.sum(F.when(F.col("target_kind") == "tower", F.col("amount"))).alias("tower"))
    return seen.join(done, "key", "left").groupBy("deployment").agg(
        F.coalesce(F.sum("unit"), F.lit(0.0)).alias("unit_damage"), F.coalesce(F.sum("tower"), F.lit(0.0)).alias("tower_damage"), F.count(F.lit(1)).alias("descendants"),
        F.bool_and(F.coalesce(F.col("died") <= as_of, F.lit(False))).alias("all_dead"))


def union_batches(batches: dict[str, DataFrame]) -> DataFrame:
    """All batches with their names and priorities, in the order given."""
    parts = [d.withColumn("batch", F.lit(n)).withColumn("priority", F.lit(i)) for i, (n, d) in enumerate(batches.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def upgraded(rows: DataFrame, key: str, version: str, priority: str, order: list[str]) -> DataFrame:
    """Each key's row of the highest version, then of the latest batch, then the first to come, with duplicates and
    upgrades: how many further rows it had, and how many rows came with a higher version than all before them.

    Rows come by priority and then by order.
    """
    came = Window.partitionBy(key).orderBy(priority, *order)
    held = F.max(version).over(came.rowsBetween(Window.unboundedPreceding, -1))
    out = rows.withColumn("_up", F.coalesce(F.col(version) > held, F.lit(False)))
    w = Window.partitionBy(key)
    out = out.withColumn("duplicates", F.count(F.lit(1)).over(w) - 1).withColumn("upgrades", F.count_if("_up").over(w))
    best = Window.partitionBy(key).orderBy(F.desc(version), F.desc(priority), *order)
    return out.withColumn("_best", F.row_number().over(best)).filter("_best = 1").drop("_up", "_best")


def facts_of(rows: DataFrame, key: list[str], fields: dict[str, tuple[str, float]]) -> DataFrame:
    """Wide rows as (key, field, value): fields name a known column and a factor; what isn't known is left out."""
    each = F.array(*[F.when(F.col(known) == 1, F.struct(F.lit(f).alias("field"), (F.col(f) * factor).cast("double").alias("value"))) for f, (known, factor) in fields.items()])
    return rows.select(*key, F.explode(F.array_compact(each)).alias("r")).select(*key, "r.*")


def certificates(rows: DataFrame, flags: list[str]) -> DataFrame:
    """(capability, total, verified, certified): verified in every row, and in one at least."""
    sums = rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("capability"), F.col(f).alias("verified")) for f in flags])).alias("r")
    out = sums.select(each, "total").select("r.capability", "total", "r.verified")
    return out.withColumn("certified", (F.col("total") > 0) & (F.col("verified") == F.col("total")))


def preferred(names: DataFrame, name: str, family: str, node: str, order: list[str]) -> DataFrame:
    """(name, node): the one node of a name; where there are several, that of the first family of the order that has
    exactly one, and null where no family has."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(family))
    n = names.select(name, node, F.when(place > 0, place).alias("_p")).groupBy(name, "_p").agg(F.countDistinct(node).alias("_n"), F.min(node).alias("_low"), F.max(node).alias("_high"))
    one = F.when((F.col("_n") == 1) & F.col("_p").isNotNull(), F.struct("_p", F.col("_low").alias("v")))
    out = n.groupBy(name).agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"), F.min(one).alias("_first"))
    return out.select(name, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_first.v")).alias(node))


def expect_rows(rows: DataFrame, n: int) -> DataFrame:
    """rows, or an error if they aren't n: a guard before anything is published."""
    if (found := rows.count()) != n:
        raise ValueError(f"{found} rows instead of {n}")
    return rows
