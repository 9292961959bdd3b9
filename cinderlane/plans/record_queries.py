"""Queries of the source record operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlane.operators import records as R
from cinderlane.plans.queries import EV, events, query
from cinderlane.plans.replay_queries import PLAYS, plays_of
from cinderlane.sources.tables import table

JOINED = "array_to_string(list_sort(list_filter([{}], lambda v: v IS NOT NULL)), ',')"


def cards(n):
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("c"), i.cast("string")))


@query(f"""
WITH a AS (SELECT o_orderkey, count(*) FILTER (WHERE side = 'team') AS n1, count(*) FILTER (WHERE side = 'opponent') AS n2 FROM {PLAYS} WHERE n > 4 GROUP BY 1), o AS (SELECT *, o_orderkey AS k FROM orders)
SELECT k AS o_orderkey, {JOINED.format('''CASE WHEN k % 6 < 3 THEN 'not_schema_v3' END, CASE WHEN k % 17 = 0 THEN 'timestamp_missing' END, CASE WHEN k % 17 = 0 OR k % 31 < 10 THEN 'before_version_window' END,
  CASE WHEN k % 7 < 2 THEN 'draft_or_unknown' END, CASE WHEN k % 11 = 0 THEN 'not_standard_1v1' END, CASE WHEN a.o_orderkey IS NULL THEN 'ability_events_missing' END,
  CASE WHEN k % 5 = 0 OR k % 3 = 0 THEN 'team_deck_incomplete' END, CASE WHEN k % 3 = 0 THEN 'opponent_deck_incomplete' END, CASE WHEN k % 4 = 0 THEN 'team_observed_cycle_incomplete' END,
  CASE WHEN k % 4 > 0 AND k % 9 = 0 THEN 'team_cycle_invalid' END, CASE WHEN k % 13 = 0 THEN 'opponent_cycle_invalid' END, CASE WHEN n1 <> k % 3 THEN 'team_ability_count_mismatch' END,
  CASE WHEN n2 <> 0 THEN 'opponent_ability_count_mismatch' END, CASE WHEN k % 19 = 0 THEN 'opponent_crowns_missing' END''')} AS reasons FROM o LEFT JOIN a USING (o_orderkey)""")
def live_entry(spark, sf):
    """Reasons against each live record."""
    k = F.col("o_orderkey")
    log = plays_of(spark, sf).filter("n > 4").groupBy("o_orderkey").agg(F.collect_list(F.struct("side")).alias("ability_plays"))
    levels = F.map_from_arrays(cards(8), F.array_repeat(F.lit(11), 8))
    player = F.struct(F.when(k % 3 > 0, levels).alias("card_levels"))
    rounds = F.array_repeat(F.struct(F.array(player).alias("team"), F.array(player).alias("opponent")), F.when(k % 11 == 0, 2).otherwise(1))
    stamp = F.when(k % 17 > 0, ((k % 31) * F.when(k % 2 == 0, 1000).otherwise(1) + F.when(k % 2 == 0, 1_700_000_000_000).otherwise(1_700_000_000)).cast("string"))
    d = table(spark, sf, "orders").join(log, "o_orderkey", "left").select(
        "o_orderkey", (k % 6).cast("int").alias("schema_version"), stamp.alias("timestamp"), F.when(k % 7 > 0, k % 7 == 1).alias("draft"), rounds.alias("rounds"),
        F.when(k % 5 == 0, cards(7)).otherwise(cards(8)).alias("team_deck"), cards(8).alias("opponent_deck"), F.when(k % 4 > 0, cards(8)).alias("team_base"), cards(8).alias("opponent_base"),
        (k % 9 > 0).alias("team_cycle"), F.when(k % 13 > 0, True).alias("opponent_cycle"), "ability_plays", (k % 3).cast("int").alias("team_abilities"), F.lit(None).cast("int").alias("opponent_abilities"),
        F.lit(0).alias("team_crowns"), F.when(k % 19 > 0, 1).alias("opponent_crowns"))
    return d.select("o_orderkey", F.concat_ws(",", R.live_reasons(1_700_000_010)).alias("reasons"))


def sources(spark, sf):
    """Orders with their lines as plays, and lines after the fourth again as abilities."""
    p = plays_of(spark, sf).withColumn("time", F.when(F.col("n") % 3 > 0, F.col("time_raw") / 20 + F.when(F.col("n") == 5, 1).otherwise(0))).withColumn("marker_index", F.when(F.col("n") < 7, (F.col("n") - F.when(F.col("x") % 10 == 0, 1).otherwise(0)).cast("int")))
    order = lambda *c: F.transform(F.array_sort(F.collect_list(F.struct("n", F.struct(*c).alias("e")))), lambda s: s["e"])
    shared = ["time_raw", "time", "side", "marker_index"]
    plays = p.filter("n <= 4").groupBy("o_orderkey").agg(order(*shared, "card", "x_raw", "y_raw", "data_i").alias("card_plays"))
    abilities = p.filter("n > 4").groupBy("o_orderkey").agg(order(*shared, F.col("card").alias("ability_id")).alias("ability_plays"))
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").join(plays, "o_orderkey", "left").join(abilities, "o_orderkey", "left").select(
        "o_orderkey", k.alias("battle_tag"), (k + F.when(k % 23 == 0, 1).otherwise(0)).alias("catalog_tag"), (k % 6).cast("int").alias("schema_version"), F.when(k % 2 == 0, 1_700_000_000 + k % 3).alias("timestamp"),
        F.when(k % 8 == 1, 1_700_000_000).alias("version_timestamp"), F.when(k % 8 == 3, "2023-11-14T22:13:20Z").when(k % 8 == 5, "2023-11-14T22:13:20").when(k % 8 == 7, F.when(k % 3 == 0, "soon")).alias("battle_time_utc"),
        F.lit(1_700_000_000).alias("catalog_timestamp"), F.when(k % 29 > 0, (k % 10) + F.when(k % 10 == 4, 0.01).otherwise(0)).cast("double").alias("duration_seconds"), "card_plays", "ability_plays",
        cards(8).alias("team_deck"), F.when(k % 37 > 0, cards(8)).alias("opponent_deck"))


SOURCES = f"""p AS (SELECT *, CASE WHEN n < 7 THEN n - CASE WHEN x % 10 = 0 THEN 1 ELSE 0 END END AS m, n % 3 > 0 AS timed, coalesce(xr IS NOT NULL AND d IN (0, 1), false) AS raw, CASE WHEN o_orderkey % 29 > 0 THEN (o_orderkey % 10) * 20 END AS stop FROM {PLAYS})"""


@query(f"""
WITH {SOURCES}, g AS (SELECT o_orderkey, bool_or(n <= 4) AS plays, bool_or(n > 4) AS abilities, bool_or(n <= 4 AND t < 0) AS a, bool_or(n > 4 AND t < 0) AS b, bool_or(n <= 4 AND t >= 0 AND t > stop) AS c, bool_or(n > 4 AND t >= 0 AND t > stop) AS d,
  bool_or(n <= 4 AND timed AND t < 0) AS e, bool_or(n > 4 AND timed AND (t < 0 OR n = 5)) AS f, bool_or(n <= 4 AND side = 'other') AS g, bool_or(n > 4 AND side = 'other') AS h, bool_or(n > 4 AND m IS NULL) AS j,
  bool_or(n <= 4 AND raw AND (xr > 18000 OR yr > 32000)) AS q, bool_or(n <= 4 AND NOT raw) AS r, count(m) > count(DISTINCT m) AS s FROM p GROUP BY 1), o AS (SELECT *, o_orderkey AS k FROM orders)
SELECT k AS o_orderkey, {JOINED.format('''CASE WHEN k % 23 = 0 THEN 'battle_identity_mismatch' END, CASE WHEN k % 6 NOT IN (3, 5) THEN 'unsupported_source_schema' END, CASE WHEN k % 2 = 0 AND k % 3 > 0 THEN 'timestamp_conflicts_with_catalog' END,
  CASE WHEN k % 8 = 7 AND k % 3 = 0 THEN 'invalid_utc_time' END, CASE WHEN k % 8 = 5 THEN 'utc_time_conflicts_with_catalog' END, CASE WHEN k % 8 = 7 AND k % 3 > 0 THEN 'source_timestamp_missing' END, CASE WHEN k % 29 = 0 THEN 'duration_missing_or_invalid' END,
  CASE WHEN k % 29 > 0 AND k % 10 = 4 THEN 'duration_not_integer_tick' END, CASE WHEN k % 37 = 0 THEN 'opponent_deck_missing' END, CASE WHEN plays IS NOT TRUE THEN 'card_plays_missing_or_invalid' END, CASE WHEN abilities IS NOT TRUE THEN 'ability_plays_missing_or_invalid' END,
  CASE WHEN a THEN 'deploy_integer_tick_missing' END, CASE WHEN b THEN 'ability_integer_tick_missing' END, CASE WHEN c THEN 'deploy_after_declared_duration' END, CASE WHEN g.d THEN 'ability_after_declared_duration' END, CASE WHEN e THEN 'deploy_tick_seconds_disagree' END,
  CASE WHEN f THEN 'ability_tick_seconds_disagree' END, CASE WHEN g.g THEN 'deploy_side_unknown' END, CASE WHEN h THEN 'ability_side_unknown' END, CASE WHEN j THEN 'ability_marker_order_unknown' END, CASE WHEN q THEN 'deploy_coordinates_outside_arena' END,
  CASE WHEN r THEN 'deploy_raw_coordinate_provenance_missing' END, CASE WHEN s THEN 'duplicate_marker_index' END''')} AS issues FROM o LEFT JOIN g USING (o_orderkey)""")
def source_issues(spark, sf):
    """Issues of each source record against its catalogue row."""
    return sources(spark, sf).select("o_orderkey", F.concat_ws(",", R.source_issues()).alias("issues"))


@query(f"""
WITH {SOURCES}, e AS (SELECT o_orderkey, CASE WHEN n <= 4 THEN 'deploy' ELSE 'ability' END AS kind, row_number() OVER (PARTITION BY o_orderkey ORDER BY greatest(t, -1), coalesce(m, -1), CASE WHEN n <= 4 THEN 'card_plays' ELSE 'ability_plays' END, n) - 1 AS place, greatest(t, -1)::BIGINT AS tick FROM p)
SELECT o_orderkey, place, tick, kind FROM e""")
def normal_events(spark, sf):
    """Plays and abilities of each record as one ordered sequence."""
    e = sources(spark, sf).select("o_orderkey", F.posexplode(R.normal_events()).alias("place", "e"))
    return e.select("o_orderkey", F.col("place").cast("long").alias("place"), F.col("e.at").alias("tick"), "e.kind")


@query("""
WITH c AS (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderkey % 5 > 0 AS exact_forms, o_orderkey % 5 > 0 AND o_orderkey % 3 > 0 AS exact_levels, CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'c7-ev1' ELSE 'c7' END END AS last_form, CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 3 > 0 THEN 14 END AS last_level,
  (o_orderkey % 4 = 3 AND coalesce(n, 0) = o_orderkey % 6) OR o_orderkey % 6 = 0 AS abilities_complete, greatest(0, o_orderkey % 6 - coalesce(n, 0)) AS abilities_missing FROM orders LEFT JOIN c USING (o_orderkey)""")
def side_records(spark, sf):
    """Exact forms and levels of a deck by base names, and how complete the ability log is."""
    k = F.col("o_orderkey")
    n = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("logged"))
    source = F.transform(F.when(k % 5 == 0, cards(7)).otherwise(cards(8)), lambda c: F.concat(c, F.when(k % 2 == 0, "-ev1").otherwise("")))
    d = table(spark, sf, "orders").join(n, "o_orderkey", "left").withColumns({"deck": cards(8), "source": source, "version": k % 4, "expected": k % 6})
    known = F.map_from_arrays("source", F.transform(F.sequence(F.lit(7), F.size("source") + 6), lambda i: i))
    d = d.withColumn("levels", F.when(k % 3 > 0, known))
    r = d.select("o_orderkey", R.side_record("deck", "source", "levels", "version", "logged", "expected").alias("r"))
    return r.select("o_orderkey", "r.exact_forms", "r.exact_levels", F.col("r.forms")[7].alias("last_form"), F.col("r.card_levels")[7].alias("last_level"), "r.abilities_complete", "r.abilities_missing")


@query("""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'invisibility' WHEN p_size % 5 = 0 AND p_partkey % 2 = 0 THEN 'stun' WHEN p_partkey % 11 = 0 THEN 'damage' WHEN p_partkey % 13 = 0 THEN 'heal' WHEN p_size % 5 = 0 THEN 'slow' WHEN p_size % 5 = 1 THEN 'speed' ELSE 'unknown' END AS kind FROM part""")
def effect_kinds(spark, sf):
    """Kinds of effects by their attributes."""
    k, n = F.col("p_partkey"), F.col("p_size")
    d = F.struct(F.when(n % 7 == 0, 1).alias("invisible"), F.when(n % 5 == 0, -100).when(n % 5 == 1, 135).when(n % 5 == 2, 100).alias("speed"), F.when(k % 2 == 0, -100).alias("hit_speed"),
                 F.when(k % 11 == 0, 40.0).otherwise(0.0).alias("damage"), F.when(k % 13 == 0, 9.5).alias("heal"))
    return table(spark, sf, "part").select("p_partkey", R.effect_kind(d).alias("kind"))


@query("""
WITH f AS (SELECT l_orderkey, ['cost', 'velocity_x', 'damage', 'mood'][l_linenumber % 4 + 1] AS feature, CASE WHEN l_partkey % 10 > 0 THEN l_partkey % 100 - 20 END::DOUBLE AS value FROM lineitem),
g AS (SELECT *, CASE feature WHEN 'cost' THEN 10 WHEN 'velocity_x' THEN 16 WHEN 'damage' THEN 5000 END AS scale, count(*) OVER (PARTITION BY l_orderkey, feature) AS n FROM f),
h AS (SELECT *, CASE WHEN scale IS NULL THEN 'unsupported' WHEN n > 1 THEN 'duplicate' WHEN value IS NULL THEN 'not_finite' WHEN feature <> 'velocity_x' AND value < 0 THEN 'negative' END AS issue FROM g)
SELECT l_orderkey, feature, value, CASE WHEN issue IS NULL THEN value / scale END AS scaled, issue FROM h""")
def scaled_features(spark, sf):
    """Features over their scales, or why not."""
    name = F.element_at(F.array(*map(F.lit, ["cost", "velocity_x", "damage", "mood"])), (F.col("l_linenumber") % 4 + 1).cast("int"))
    f = table(spark, sf, "lineitem").select("l_orderkey", name.alias("feature"), F.when(F.col("l_partkey") % 10 > 0, F.col("l_partkey") % 100 - 20).cast("double").alias("value"))
    return R.scaled_features(f, ["l_orderkey"], {"cost": 10.0, "velocity_x": 16.0, "damage": 5000.0})


@query("""
WITH i AS (SELECT o_orderkey AS k, o_custkey % 5 = 0 AS other, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 4 END AS c, o_orderkey % 7 = 0 AND o_orderkey % 2 = 0 AS twice FROM orders WHERE o_orderkey % 11 > 0)
SELECT o_orderkey, CASE WHEN s = 'matched' THEN c END AS team_crowns, CASE WHEN s = 'matched' THEN 1 END AS opponent_crowns, s AS status FROM (SELECT o_orderkey, c, CASE WHEN k IS NULL OR c IS NULL THEN 'missing' WHEN twice THEN 'conflict' WHEN other THEN 'missing' ELSE 'matched' END AS s FROM orders LEFT JOIN i ON k = o_orderkey)""")
def terminal_anchors(spark, sf):
    """Final crowns of each record from the URL of its index row, by root and file name."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    root, tag = F.concat(F.lit("r"), (k % 3).cast("string")), F.concat(F.lit("#"), k.cast("string"))
    records = o.select("o_orderkey", tag.alias("battle_tag"), root.alias("root"), F.concat(F.lit("/data/in/"), k.cast("string"), F.lit(".JSON")).alias("source_path"))
    url = F.concat(F.lit("https://host/b?tag=%23"), k.cast("string"), F.when(F.col("o_custkey") % 5 == 0, "x").otherwise(""), F.lit("&team_crowns="), F.when(k % 3 > 0, (k % 4).cast("string")).otherwise("no"), F.lit("&opponent_crowns="), F.col("c"))
    twice = F.explode(F.when((k % 7 == 0) & (k % 2 == 0), F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1"))))
    index = o.filter(k % 11 > 0).withColumn("c", twice).select(root.alias("root"), F.concat(F.lit("C:\\in\\"), k.cast("string"), F.lit(".json")).alias("saved_path"), F.lit("battle").alias("kind"), url.alias("url"))
    return R.terminal_anchors(records, index).select("o_orderkey", F.col("team_crowns").cast("long").alias("team_crowns"), "opponent_crowns", "status")


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey * 37 % 18300 AS x, l_partkey * 53 % 32000 AS y FROM lineitem),
j AS (SELECT l.*, s_nationkey, n_nationkey, x < 18000 AND ((x // 1000 + 18 * (y // 1000)) * (n_nationkey + 3)) % 5 < 3 AS ok FROM l LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 7 > 0 LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 5 > 0)
SELECT l_orderkey, l_linenumber, coalesce(ok, false) AS legal, CASE WHEN s_nationkey IS NULL THEN 'no_captured_mask' WHEN n_nationkey IS NULL THEN 'payload_not_staged' WHEN NOT ok THEN 'position_not_in_mask' END AS reason FROM j""")
def label_legality(spark, sf):
    """Is each play's cell open in the mask of its slot?"""
    k = F.col("l_partkey")
    labels = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", (k * 37 % 18300).alias("x"), (k * 53 % 32000).alias("y"))
    slots = table(spark, sf, "supplier").filter("s_suppkey % 7 > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("mask"))
    cells = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(575)), lambda i: F.when(i * (F.col("n_nationkey") + 3) % 5 < 3, "1").otherwise("0")), "")
    masks = table(spark, sf, "nation").filter("n_nationkey % 5 > 0").select(F.col("n_nationkey").alias("mask"), cells.alias("cells"))
    return R.label_legality(labels, slots, masks, ["l_suppkey"]).select("l_orderkey", "l_linenumber", "legal", "reason")


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 2 = 0 THEN l_partkey % 9 ELSE (l_partkey * 2654435761 % 4294967296) >> 28 END * 10000 AS cost_raw, l_orderkey % 10 * 10000 AS e FROM lineitem WHERE l_suppkey % 3 = 0)
SELECT l_orderkey, l_linenumber, cost_raw, greatest(0, cost_raw - e) AS deficit FROM c""")
def cost_refusals(spark, sf):
    """Refusals for want of resources, what they cost and what was short."""
    k = F.col("l_partkey")
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_suppkey") % 3 == 0, 13).otherwise(7).alias("result_code"), F.when(k % 2 == 0, k % 9).alias("card_cost"), (k * 2654435761 % 4294967296).alias("packed"), (F.col("l_orderkey") % 10 * 10000).alias("elixir_raw"))
    return R.cost_refusals(d).select("l_orderkey", "l_linenumber", "cost_raw", "deficit")


@query(f"""
WITH e AS (SELECT user_id, event_id, tick, CASE WHEN event_id % 3 > 0 THEN event_type WHEN event_id % 2 = 0 THEN 'late' ELSE 'result_code_' || event_id % 7 END AS reason FROM {EV} WHERE value <= 50),
g AS (SELECT user_id, reason, count(*) AS n, arg_min(tick, event_id) AS first_tick FROM e GROUP BY 1, 2)
SELECT * FROM g UNION ALL SELECT NULL, reason, sum(n)::BIGINT, min(first_tick) FROM g GROUP BY reason""")
def refusal_reasons(spark, sf):
    """Reasons of refusals of each capture and of all."""
    k = F.col("event_id")
    d = events(spark, sf).select("user_id", "tick", k.alias("line"), (F.col("value") > 50).alias("accepted"), F.when(k % 3 > 0, F.col("event_type")).otherwise("").alias("reason"), F.when(k % 2 == 0, "late").alias("result_reason"), (k % 7).alias("result_code"))
    return R.refusal_reasons(d.filter("accepted is not null"), "user_id")


@query("""
WITH q AS (SELECT l_orderkey, min({'n': l_linenumber, 'good': l_returnflag = 'A', 'why': l_linestatus}) AS r FROM lineitem WHERE CASE WHEN l_returnflag = 'A' THEN l_linenumber % 2 = 1 ELSE l_partkey % 3 > 0 END GROUP BY 1), r AS (SELECT l_orderkey, r.good, r.why FROM q),
t AS (SELECT o_orderkey, ['pending', 'leased', 'done', 'failed'][o_orderkey % 4 + 1] AS status FROM orders)
SELECT o_orderkey, status, CASE WHEN status IN ('done', 'failed') OR good IS NULL THEN status WHEN good THEN 'done' ELSE 'failed' END AS settled, CASE WHEN status NOT IN ('done', 'failed') AND NOT good THEN why END AS error FROM t LEFT JOIN r ON l_orderkey = o_orderkey""")
def settled_tasks(spark, sf):
    """Tasks whose results were written before a crash get their status."""
    status = F.element_at(F.array(*map(F.lit, ["pending", "leased", "done", "failed"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    tasks = table(spark, sf, "orders").select("o_orderkey", status.alias("status"))
    n = F.col("l_linenumber")
    results = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), n.alias("n"), (F.col("l_returnflag") == "A").alias("success"), (n % 2 == 1).alias("frame_valid"), (F.col("l_partkey") % 3 == 0).alias("retry"), F.col("l_linestatus").alias("failure"))
    return R.settled(tasks, results, "o_orderkey", "n")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 = 1 THEN l_partkey - 1 ELSE l_partkey END AS base_card_id, CASE l_partkey % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'evolution' ELSE 'unknown' END AS card_form, CASE WHEN l_partkey % 3 < 2 THEN p_name ELSE l_partkey::VARCHAR END AS form_name FROM lineitem JOIN part ON p_partkey = l_partkey""")
def observed_cards(spark, sf):
    """Observed forms as their base cards."""
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(k.alias("id"), (k - 1).alias("base"), F.lit("evolution").alias("form"), F.col("p_name").alias("name"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return R.observed_cards(rows, "l_partkey", p.filter("id % 3 = 0"), p.filter("id % 3 = 1")).drop("l_partkey")


@query("""
SELECT o_orderkey, arg_min(l_partkey, l_linenumber::BIGINT * 1000000000 + l_partkey) AS path FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_returnflag IN ('A', 'R') GROUP BY 1""")
def usable_sets(spark, sf):
    """Usable entries that have a compiled set, from the first root that holds it."""
    entries = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "usable").otherwise("captured").alias("status"))
    sets = table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R")).select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("root"), F.col("l_partkey").alias("path"))
    return R.usable(entries, sets, "o_orderkey")


@query("""
WITH c AS (SELECT o_custkey, o_orderkey, l_linenumber - 1 AS cell, sum(l_partkey % 4) AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3),
r AS (SELECT o_custkey, o_orderkey, count(*) FILTER (WHERE v > 0) AS n, sum(v * 100 ** cell)::BIGINT AS grid FROM c GROUP BY 1, 2)
SELECT o_custkey, o_orderkey, coalesce(sum(n) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset", n, grid FROM r""")
def sparse_grids(spark, sf):
    """Rows of cells packed end to end, and dense again."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    c = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_linenumber") - 1).cast("int").alias("cell"), (F.col("l_partkey") % 4).cast("int").alias("v")).join(o, "o_orderkey")
    p = R.packed_rows(c, "o_custkey", "o_orderkey", "cell", "v")
    grid = F.aggregate(F.reverse(R.dense(8)), F.lit(0).cast("long"), lambda a, x: a * 100 + x)
    return p.select("o_custkey", "o_orderkey", F.col("offset").cast("long").alias("offset"), F.size("cells").cast("long").alias("n"), grid.alias("grid"))


@query(f"""
WITH p AS (SELECT o_orderkey AS k, side, CASE WHEN no_card THEN NULL ELSE card END AS card, n, t, d, CASE WHEN n < 7 THEN n END AS m, o_orderkey % 8 * 20 AS stop, o_orderkey % 6 = 5 AS strict FROM {PLAYS}),
q AS (SELECT *, side <> 'other' AS good, t < lag(t) OVER (PARTITION BY k ORDER BY n, t) AS back, count(*) OVER (PARTITION BY k, side, t) > 1 AS same, count(*) OVER (PARTITION BY k, m) > 1 AS marked FROM p)
SELECT k AS o_orderkey, count(*) FILTER (WHERE NOT good) AS invalid_side, count(*) FILTER (WHERE good AND (card IS NULL OR card > 7)) AS card_not_in_deck, count(*) FILTER (WHERE t < 0 OR t > stop + 20) AS tick_outside_duration, count(*) FILTER (WHERE good AND same) AS several_at_one_tick,
  count(*) FILTER (WHERE strict AND m IS NULL) AS marker_missing, count(*) FILTER (WHERE strict AND m IS NOT NULL AND marked) AS repeated_marker, count(*) FILTER (WHERE strict AND good AND card <= 7 AND card % 4 = 3) AS card_form_inconsistent,
  count(*) FILTER (WHERE strict AND (n % 5 = 4 OR d IS NULL OR d = 2)) AS coordinates_inconsistent, count(*) FILTER (WHERE back) AS not_sorted FROM q GROUP BY 1""")
def plan_issues(spark, sf):
    """How many plays of each match can't be replayed, by reason."""
    k = F.col("o_orderkey")
    number = F.regexp_extract("card", r"(\d+)", 1)
    form = F.concat(F.lit("c"), number, F.when(number.try_cast("int") % 4 == 3, "-ev1").otherwise(""))
    turn = F.when(F.col("data_i") == 0, "rotate_180").when(F.col("data_i") == 1, "identity")
    p = plays_of(spark, sf).select("o_orderkey", (k % 6).cast("int").alias("schema"), "side", "card", "n", F.col("time_raw").alias("tick"), F.when(F.col("n") < 7, F.col("n")).alias("marker"), form.alias("form"), F.col("data_i").alias("flag"),
                                   F.when(F.col("n") % 5 < 4, R.COORDINATES).alias("provenance"), turn.alias("transform"), (k % 8 * 20).alias("duration_ticks"))
    decks = table(spark, sf, "orders").select("o_orderkey", F.explode(F.array(F.lit("team"), F.lit("opponent"))).alias("side"), cards(8).alias("deck"))
    names = ["invalid_side", "card_not_in_deck", "tick_outside_duration", "several_at_one_tick", "marker_missing", "repeated_marker", "card_form_inconsistent", "coordinates_inconsistent", "not_sorted"]
    return R.plan_issues(p, decks, "o_orderkey", ["n", "tick"]).groupBy("o_orderkey").agg(*[F.count_if(F.array_contains("issues", x)).alias(x) for x in names])


@query("""
WITH e AS (SELECT o_orderkey, o_orderkey % 5 AS a, o_orderkey % 5 + 100 + o_orderkey % 3 AS d, o_orderkey % 5 + o_orderkey % 120 AS b, o_orderkey % 5 + o_orderkey % 120 + o_orderkey % 4 AS c, 100 + o_orderkey % 3 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS n FROM orders),
f AS (SELECT *, NOT (a < b AND b <= c AND c <= d) AS x, d - a <> n AS y FROM e)
SELECT o_orderkey, CASE WHEN x AND y THEN 'bounds_out_of_order,tick_count_differs' WHEN x THEN 'bounds_out_of_order' WHEN y THEN 'tick_count_differs' ELSE '' END AS issues, CASE WHEN NOT x AND NOT y THEN c - a END AS retained FROM f""")
def extent_contracts(spark, sf):
    """Bounds of valid prefixes, and the ticks that they keep."""
    k = F.col("o_orderkey")
    e = table(spark, sf, "orders").select("o_orderkey", (k % 5).alias("start"), (k % 120).alias("b"), (k % 4).alias("c"), (100 + k % 3).alias("n"))
    e = e.withColumns({"action_stop": F.col("start") + F.col("b"), "censor": F.col("start") + F.col("b") + F.col("c"), "stop": F.col("start") + F.col("n"), "tick_count": F.col("n") + F.when(k % 7 == 0, 1).otherwise(0)})
    return R.extents(e).select("o_orderkey", F.concat_ws(",", "issues").alias("issues"), "retained")
