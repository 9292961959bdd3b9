"""Source records before they become training rows: entry checks, normal form, side records, anchors, masks, refusals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.functions import scalars as S

SIDES = ("team", "opponent")
# Parts of column names that no training table may have, and identifiers that may not be numbers.
FORBIDDEN = ["enemy_hand", "opponent_hand", "enemy_elixir", "opponent_elixir", "privileged", "hidden_state", "native_rng", "unrevealed"]
IDENTIFIERS = ["card_id", "card_token", "entity_id", "native_id", "data_id"]


def _named(rules: dict[str, Column]) -> list[Column]:
    return [F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]


def _sorted(found: list[Column]) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def live_reasons(least: int) -> Column:
    """Sorted reasons against a live record; none if it is accepted.

    Needs schema_version, timestamp (text, seconds or milliseconds), draft, rounds (an array of a team and an opponent
    array of players with card_levels), team_deck and opponent_deck, team_base and opponent_base (observed base cards),
    team_cycle and opponent_cycle (does the cycle hold?), ability_plays, team_abilities and opponent_abilities
    (the counts reported), team_crowns and opponent_crowns. What isn't known counts against the record.
    """
    stamp, rounds = S.unix_seconds_of(F.col("timestamp")), F.col("rounds")
    players = {s: F.try_element_at(rounds, F.lit(1))[s] for s in SIDES}
    single = (F.size(rounds) == 1) & (F.size(players["team"]) == 1) & (F.size(players["opponent"]) == 1)
    rules = {
        "not_schema_v3": F.coalesce(F.col("schema_version"), F.lit(0)) < 3,
        "timestamp_missing": stamp.isNull(),
        "before_version_window": F.coalesce(stamp, F.lit(0)) < least,
        "draft_or_unknown": ~F.coalesce(~F.col("draft"), F.lit(False)),
        "not_standard_1v1": ~F.coalesce(single, F.lit(False)),
        "ability_events_missing": F.col("ability_plays").isNull(),
    }
    for s in SIDES:
        deck, levels = F.col(f"{s}_deck"), F.try_element_at(players[s], F.lit(1))["card_levels"]
        named = F.forall(deck, lambda c: ~F.coalesce(c, F.lit("")).isin("", "_invalid"))
        full = (F.size(deck) == 8) & (F.size(F.array_distinct(deck)) == 8) & named & (F.size(levels) == 8)
        cycle = F.coalesce(F.size(f"{s}_base") == 8, F.lit(False))
        logged = F.size(F.filter("ability_plays", lambda e: e["side"] == s))  # noqa: B023
        rules |= {
            f"{s}_deck_incomplete": ~F.coalesce(full, F.lit(False)),
            f"{s}_observed_cycle_incomplete": ~cycle,
            f"{s}_cycle_invalid": cycle & ~F.coalesce(F.col(f"{s}_cycle"), F.lit(False)),
            f"{s}_ability_count_mismatch": logged != F.coalesce(F.col(f"{s}_abilities"), F.lit(0)),
            f"{s}_crowns_missing": F.col(f"{s}_crowns").isNull(),
        }
    return _sorted(_named(rules))


def _common(e: Column, i: Column, kind: str, source: str, identity: str, place: bool) -> Column:
    tick = F.when(e["time_raw"] >= 0, e["time_raw"])
    marker = F.when(e["marker_index"] >= 0, e["marker_index"])
    known = F.lit(place) & e["data_i"].isin(0, 1) & e["x_raw"].isNotNull() & e["y_raw"].isNotNull() if place else F.lit(False)
    turned = lambda c, top: F.when(e["data_i"] == 0, top - e[c]).otherwise(e[c])
    x, y = (F.when(known, turned("x_raw", 18000)), F.when(known, turned("y_raw", 32000))) if place else (F.lit(None), F.lit(None))
    return F.struct(
        F.coalesce(tick, F.lit(-1)).cast("long").alias("at"), F.coalesce(marker, F.lit(-1)).cast("long").alias("marker"), F.lit(source).alias("source_list"), i.cast("long").alias("source_index"),
        F.lit(kind).alias("kind"), e["side"].alias("side"), e[identity].alias("identity"), x.cast("long").alias("x"), y.cast("long").alias("y"))


def normal_events() -> Column:
    """Plays and abilities as one array in the order of tick, marker, list and place; -1 where tick or marker is unknown.

    x and y are native coordinates of plays with raw markers, null for others.
    """
    plays = F.transform("card_plays", lambda e, i: _common(e, i, "deploy", "card_plays", "card", True))
    abilities = F.transform("ability_plays", lambda e, i: _common(e, i, "ability", "ability_plays", "ability_id", False))
    return F.array_sort(F.concat(F.coalesce(plays, F.array()), F.coalesce(abilities, F.array())))


def source_issues() -> Column:
    """Sorted issues of a source record against its catalogue row; none if it is clean.

    Needs battle_tag, catalog_tag, schema_version, timestamp, version_timestamp, battle_time_utc (ISO text), catalog_timestamp,
    duration_seconds, card_plays, ability_plays (time_raw, time, side, marker_index), team_deck and opponent_deck.
    """
    stamp, seconds = F.col("catalog_timestamp").cast("long"), F.col("duration_seconds")
    ticks = F.when((seconds >= 0) & ~F.isnan(seconds) & (seconds < 1e12), F.bround(seconds * 20))
    utc = F.col("battle_time_utc")
    zoned, read = utc.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(utc)
    rules = {
        "battle_identity_mismatch": ~F.col("battle_tag").eqNullSafe(F.col("catalog_tag")),
        "unsupported_source_schema": ~F.coalesce(F.col("schema_version").isin(3, 5), F.lit(False)),
        "timestamp_conflicts_with_catalog": F.col("timestamp") != stamp,
        "version_timestamp_conflicts_with_catalog": F.col("version_timestamp") != stamp,
        "invalid_utc_time": utc.isNotNull() & read.isNull(),
        "utc_time_conflicts_with_catalog": read.isNotNull() & (~zoned | (F.unix_micros(read) != stamp * 1_000_000)),
        "source_timestamp_missing": F.coalesce(F.col("timestamp"), F.col("version_timestamp")).isNull() & utc.isNull(),
        "duration_missing_or_invalid": ticks.isNull(),
        "duration_not_integer_tick": F.abs(ticks - seconds * 20) > 1e-6,
        "team_deck_missing": ~F.coalesce(F.size("team_deck") > 0, F.lit(False)),
        "opponent_deck_missing": ~F.coalesce(F.size("opponent_deck") > 0, F.lit(False)),
    }
    for kind, field in (("deploy", "card_plays"), ("ability", "ability_plays")):
        some = lambda f: F.exists(field, lambda e: F.coalesce(f(e), F.lit(False)))  # noqa: B023, E731
        whole = lambda e: F.coalesce(e["time_raw"] >= 0, F.lit(False))
        rules |= {
            f"{field}_missing_or_invalid": F.col(field).isNull(),
            f"{kind}_integer_tick_missing": some(lambda e: ~whole(e)),
            f"{kind}_after_declared_duration": some(lambda e: whole(e) & (e["time_raw"] > ticks)),
            f"{kind}_tick_seconds_disagree": some(lambda e: e["time"].isNotNull() & (~whole(e) | F.isnan(e["time"]) | (F.abs(e["time"] * 20 - e["time_raw"]) > 1e-5))),
            f"{kind}_side_unknown": some(lambda e: ~F.coalesce(e["side"].isin(*SIDES), F.lit(False))),
            f"{kind}_marker_order_unknown": some(lambda e: ~F.coalesce(e["marker_index"] >= 0, F.lit(False))),
        }
    raw = lambda e: F.coalesce(e["data_i"].isin(0, 1), F.lit(False)) & e["x_raw"].isNotNull() & e["y_raw"].isNotNull()
    markers = F.filter(F.transform(normal_events(), lambda e: e["marker"]), lambda m: m >= 0)
    rules |= {
        "deploy_coordinates_outside_arena": F.exists("card_plays", lambda e: raw(e) & ~(e["x_raw"].between(0, 18000) & e["y_raw"].between(0, 32000))),
        "deploy_raw_coordinate_provenance_missing": F.exists("card_plays", lambda e: ~raw(e)),
        "deploy_card_identity_missing": F.exists("card_plays", lambda e: F.coalesce(e["card"], F.lit("")) == ""),
        "duplicate_marker_index": F.size(F.array_distinct(markers)) < F.size(markers),
    }
    return _sorted(_named(rules))


def side_record(deck: str, source: str, levels: str, version: str, logged: str, expected: str) -> Column:
    """(forms, exact_forms, card_levels, exact_levels, abilities_complete, abilities_missing) of one side's record.

    A base card's form is the last of the source deck with its base name; forms and levels are null unless all are known.
    """
    let = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))  # noqa: E731  (worked out once, however often it is used)
    bases = F.struct(F.transform(source, lambda v: F.struct(S.base_token(v).alias("base"), v.alias("card"))).alias("source"), F.transform(deck, S.base_token).alias("deck"))
    found = let(bases, lambda b: F.transform(b["deck"], lambda c: F.try_element_at(F.filter(b["source"], lambda v: v["base"] == c), F.lit(-1))["card"]))
    due, seen = F.coalesce(F.col(expected), F.lit(0)), F.coalesce(F.col(logged), F.lit(0))

    def record(forms):
        exact = F.coalesce((F.size(source) == 8) & F.forall(forms["found"], lambda f: f.isNotNull()), F.lit(False))
        known = exact & F.coalesce(F.forall(forms["each"], lambda n: n.isNotNull()), F.lit(False))
        return F.struct(
            F.when(exact, forms["found"]).alias("forms"), exact.alias("exact_forms"), F.when(known, forms["each"]).alias("card_levels"), known.alias("exact_levels"),
            (((F.coalesce(F.col(version), F.lit(1)) >= 3) & (seen == due)) | (due == 0)).alias("abilities_complete"), F.greatest(F.lit(0), due - seen).alias("abilities_missing"))

    return let(found, lambda f: let(F.struct(f.alias("found"), F.transform(f, lambda c: F.try_element_at(levels, c)).alias("each")), record))


def leaking_columns(rows: DataFrame, continuous: list[str] = ()) -> list[str]:
    """Names of columns that tell what a player can't know, and of identifiers used as continuous numbers."""
    return [c for c in rows.columns if any(f in c.lower() for f in FORBIDDEN) or (c in continuous and any(f in c.lower() for f in IDENTIFIERS))]


def effect_kind(d: Column) -> Column:
    """Kind of an effect by its definition's invisible, speed, hit_speed, damage and heal; null where not defined."""
    return (
        F.when(d["invisible"] == 1, "invisibility").when((d["speed"] == -100) & (d["hit_speed"] == -100), "stun").when(d["damage"] > 0, "damage")
        .when(d["heal"] > 0, "heal").when(d["speed"] < 0, "slow").when(d["speed"] > 100, "speed").otherwise("unknown")
    )


def scaled_features(facts: DataFrame, key: list[str], scales: dict[str, float]) -> DataFrame:
    """(key, feature, value, scaled, issue) of facts (key, feature, value); scaled is null where there is an issue."""
    scale = F.try_element_at(F.create_map(*[F.lit(x) for pair in scales.items() for x in pair]), F.col("feature"))
    n = F.count(F.lit(1)).over(Window.partitionBy(*key, "feature"))
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    issue = F.when(scale.isNull(), "unsupported").when(n > 1, "duplicate").when(~finite, "not_finite").when(~F.col("feature").startswith("velocity_") & (F.col("value") < 0), "negative")
    return facts.withColumn("issue", issue).withColumn("scaled", F.when(F.col("issue").isNull(), F.col("value") / scale)).select(*key, "feature", "value", "scaled", "issue")


def terminal_anchors(records: DataFrame, index: DataFrame) -> DataFrame:
    """records (battle_tag, root, source_path) with team_crowns, opponent_crowns and status.

    index has root, saved_path, kind and url, whose query names tag and crowns; files meet by their lower-case names in
    a root. conflict: its index rows differ; missing: none, or of another tag. Anything but matched is an error upstream.
    """
    name = lambda c: F.lower(F.regexp_extract(F.translate(c, "\\", "/"), r"([^/]*)$", 1))
    part = lambda k: F.url_decode(F.regexp_extract("url", rf"[?&]{k}=([^&#]*)", 1))
    crowns = [part(f"{s}_crowns").try_cast("int").alias(f"{s}_crowns") for s in SIDES]
    known = index.filter("kind = 'battle'").select("root", name(F.col("saved_path")).alias("_name"), F.struct(part("tag").alias("tag"), *crowns).alias("_v"))
    known = known.filter("_name <> '' and _v.tag <> '' and _v.team_crowns is not null and _v.opponent_crowns is not null")
    known = known.groupBy("root", "_name").agg(F.min("_v").alias("_v"), (F.min("_v") != F.max("_v")).alias("_differ"))
    out = records.withColumn("_name", name(F.col("source_path"))).join(known, ["root", "_name"], "left")
    status = F.when(F.col("_differ"), "conflict").when(F.coalesce(F.col("_v.tag") == F.col("battle_tag"), F.lit(False)), "matched").otherwise("missing")
    out = out.withColumn("status", status)
    return out.select(*records.columns, *[F.when(F.col("status") == "matched", F.col(f"_v.{s}_crowns")).alias(f"{s}_crowns") for s in SIDES], "status")


def label_legality(labels: DataFrame, slots: DataFrame, masks: DataFrame, slot: list[str], across: int = 18, cell: int = 1000) -> DataFrame:
    """labels (slot, x, y) with legal and reason: their slot's mask (slots: slot, mask), its cells (masks: mask, cells, a
    text of 0 and 1 row by row), and whether the cell of the point is open there. Slots and masks are unique."""
    at = F.floor(F.col("x") / cell) + across * F.floor(F.col("y") / cell)
    on = (F.col("x") >= 0) & (F.col("x") < across * cell) & (F.col("y") >= 0)
    legal = F.coalesce(on & (F.substr("cells", (at + 1).cast("int"), F.lit(1)) == "1"), F.lit(False))
    out = labels.join(slots.select(*slot, "mask"), slot, "left").join(masks.select("mask", "cells"), "mask", "left")
    reason = F.when(F.col("mask").isNull(), "no_captured_mask").when(F.col("cells").isNull(), "payload_not_staged").when(~legal, "position_not_in_mask")
    return out.select(*labels.columns, legal.alias("legal"), reason.alias("reason"))


def cost_refusals(refused: DataFrame, code: int = 13) -> DataFrame:
    """Refusals of a code with cost_raw and deficit: card_cost, else the highest four bits of packed, in ten-thousandths,
    less elixir_raw, at least 0."""
    cost = F.coalesce(F.col("card_cost"), F.shiftrightunsigned(F.col("packed").bitwiseAND(0xFFFFFFFF), 28)) * 10000
    return refused.filter(F.col("result_code") == code).withColumn("cost_raw", cost.cast("long")).withColumn("deficit", F.greatest(F.lit(0).cast("long"), F.col("cost_raw") - F.col("elixir_raw")))


def refusal_reasons(receipts: DataFrame, capture: str) -> DataFrame:
    """(capture, reason, n, first_tick): refused receipts by their first named reason, else their code; the rows without
    a capture are the totals. receipts has accepted, reason, result_reason, result_code, tick and line."""
    named = lambda c: F.when(F.col(c) != "", F.col(c))
    why = F.coalesce(named("reason"), named("result_reason"), F.concat(F.lit("result_code_"), F.coalesce(F.col("result_code").cast("string"), F.lit("None"))))
    each = receipts.filter(~F.col("accepted")).groupBy(capture, why.alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min_by("tick", "line").alias("first_tick"))
    total = each.groupBy("reason").agg(F.sum("n").alias("n"), F.min("first_tick").alias("first_tick"))
    return each.unionByName(total.withColumn(capture, F.lit(None).cast(dict(receipts.dtypes)[capture])))


def settled(tasks: DataFrame, results: DataFrame, key: str, order: str) -> DataFrame:
    """tasks (key, status) with settled and error, after results that a crash left behind.

    A pending or leased task is done by its earliest successful result with a sound frame, or failed by an unsuccessful
    one that isn't to be tried again; results has success, frame_valid, retry and failure. Of results that tie, an
    unsuccessful one counts.
    """
    counts = F.when(F.col("success"), F.coalesce("frame_valid", F.lit(False))).otherwise(~F.coalesce("retry", F.lit(False)))
    first = results.filter(counts).groupBy(key).agg(F.min(F.struct(order, "success", "failure")).alias("_r"))
    open_ = F.col("status").isin("pending", "leased") & F.col("_r").isNotNull()
    good = F.coalesce(F.col("_r.success"), F.lit(False))
    new = F.when(open_ & good, "done").when(open_, "failed").otherwise(F.col("status"))
    error = F.when(open_ & ~good, F.left(F.coalesce(F.when(F.col("_r.failure") != "", F.col("_r.failure")), F.lit("failed")), F.lit(4000)))
    return tasks.join(first, key, "left").select(*tasks.columns, new.alias("settled"), error.alias("error"))


def observed_cards(rows: DataFrame, card: str, catalog: DataFrame, forms: DataFrame) -> DataFrame:
    """rows with base_card_id, card_form and form_name: of the catalogue (id, name), else of the forms (id, base, form,
    name), else unknown. Ids are unique there."""
    base = catalog.select(F.col("id").alias(card), F.col("name").alias("_name"), F.lit(True).alias("_base"))
    form = forms.select(F.col("id").alias(card), F.col("base").alias("_of"), F.col("form").alias("_form"), F.col("name").alias("_as"))
    out = rows.join(base, card, "left").join(form, card, "left")
    own = F.col("_base").isNotNull()
    return out.select(
        *rows.columns, F.when(own, F.col(card)).otherwise(F.coalesce("_of", card)).alias("base_card_id"), F.when(own, "base").otherwise(F.coalesce("_form", F.lit("unknown"))).alias("card_form"),
        F.when(own, F.col("_name")).otherwise(F.coalesce("_as", F.col(card).cast("string"))).alias("form_name"))


def usable(ledger: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """(key, path) of usable entries that have a compiled set; of several roots (root, path) the first wins,
    and of a root's paths the smallest."""
    first = available.groupBy(key).agg(F.min(F.struct("root", "path"))["path"].alias("path"))
    return ledger.filter("status = 'usable'").select(key).distinct().join(first, key)


def packed_rows(cells: DataFrame, group: str, row: str, cell: str, value: str) -> DataFrame:
    """One sparse row for each row of a group: offset, cells in their order and values; zeros and unknown values go, and
    values of a repeated cell add up.

    offset counts the cells of the group's rows before it, so that a group's rows lie end to end.
    """
    # dealt by row first: sums of a task of the input would hold nearly all of its cells
    one = cells.repartition(group, row).groupBy(group, row, cell).agg(F.sum(value).alias(value))
    packed = one.groupBy(group, row).agg(F.array_sort(F.collect_list(F.when(F.col(value) != 0, F.struct(F.col(cell).alias("c"), F.col(value).alias("v"))))).alias("_p"))
    before = F.sum(F.size("_p")).over(Window.partitionBy(group).orderBy(row).rowsBetween(Window.unboundedPreceding, -1))
    return packed.select(group, row, F.coalesce(before, F.lit(0)).alias("offset"), F.col("_p.c").alias("cells"), F.col("_p.v").alias("values"))


def dense(width: int, cells: str = "cells", values: str = "values") -> Column:
    """A sparse row as an array of a fixed width, zero where it has no cell."""
    at = F.map_from_arrays(cells, values)
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at(at, i), F.lit(0)))


#: Where a schema-5 play's coordinates come from, and how they were turned by its flag.
COORDINATES, TURNS = "royaleapi_data_i_to_libg_native_v1", {0: "rotate_180", 1: "identity"}


def plan_issues(plays: DataFrame, decks: DataFrame, battle: str, order: list[str], slack: int = 20) -> DataFrame:
    """plays (battle, schema, side, card, tick, marker, form, flag, provenance, transform, duration_ticks) with place,
    marker and issues, sorted; none where a play can be replayed.

    decks has one row for each battle and side with deck, an array of cards. A play is outside where its tick is unknown,
    below 0 or more than slack beyond the duration; it is unsorted where it comes before the play ahead of it. Only
    plays of schema 5 must have markers of their own, the form that their deck has, and coordinates of known origin
    (TURNS; no flag counts as 1); in other schemas a play without a
    marker has its place in the battle, from 0.
    """
    side = F.coalesce(F.col("side").isin(*SIDES), F.lit(False))
    base = lambda c: S.base_token(F.lower(F.trim(c)))
    own = F.get(F.filter("_deck", lambda c: base(c) == base(F.col("card"))), F.lit(0))
    line = Window.partitionBy(battle)
    many = lambda *c: F.count(F.lit(1)).over(Window.partitionBy(battle, *c)) > 1
    out = plays.withColumn("_back", F.col("tick") < F.lag("tick").over(line.orderBy(*order))).withColumn("place", F.row_number().over(line.orderBy(*order)) - 1)
    strict = F.coalesce(F.col("schema") == 5, F.lit(False))
    out = out.withColumn("_same", many("side", "tick")).withColumn("_marked", many("marker")).withColumn("_unmarked", F.col("marker").isNull())
    out = out.withColumn("marker", F.when(strict, F.col("marker")).otherwise(F.coalesce("marker", "place")))
    out = out.join(decks.select(battle, "side", F.col("deck").alias("_deck")), [battle, "side"], "left").withColumn("_own", own)
    turned = F.when(F.coalesce(F.col("flag") == 0, F.lit(False)), TURNS[0]).otherwise(TURNS[1])
    rules = {
        "invalid_side": ~side,
        "card_not_in_deck": side & F.col("_own").isNull(),
        "tick_outside_duration": ~F.coalesce(F.col("tick").between(0, F.col("duration_ticks") + slack), F.lit(False)),
        "several_at_one_tick": side & F.col("tick").isNotNull() & F.col("_same"),
        "marker_missing": strict & F.col("_unmarked"),
        "repeated_marker": strict & ~F.col("_unmarked") & F.col("_marked"),
        "card_form_inconsistent": strict & F.col("_own").isNotNull() & ~F.col("form").eqNullSafe(F.col("_own")),
        "coordinates_inconsistent": strict & ~(F.col("provenance").eqNullSafe(F.lit(COORDINATES)) & F.col("transform").eqNullSafe(turned)),
        "not_sorted": F.col("_back"),
    }
    return out.withColumn("issues", _sorted(_named(rules))).select(*plays.columns, "place", "issues")


def extents(rows: DataFrame) -> DataFrame:
    """rows of a prefix (start, action_stop, censor, stop, tick_count) with issues and retained, the ticks before the
    censor; null where there is an issue. Stops are exclusive; unknown bounds count as out of order."""
    ordered = (F.col("start") < F.col("action_stop")) & (F.col("action_stop") <= F.col("censor")) & (F.col("censor") <= F.col("stop"))
    issues = _sorted(_named({
        "bounds_out_of_order": ~F.coalesce(ordered, F.lit(False)),
        "tick_count_differs": ~F.coalesce(F.col("stop") - F.col("start") == F.col("tick_count"), F.lit(False)),
    }))
    return rows.withColumn("issues", issues).withColumn("retained", F.when(F.size("issues") == 0, F.col("censor") - F.col("start")))
