"""Queries of the match operators. Matches are made of orders and their lines; SQL works on the lines alone."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cinderlane.functions import scalars as S
from cinderlane.operators import battles as B
from cinderlane.operators import joins, sampling, sequence
from cinderlane.plans.queries import EV, PARENTS, events, parents, query
from cinderlane.sources.tables import table
from cinderlane.streaming import incremental


def plays_of(spark, sf):
    """Lines as plays of two sides; some have impossible values."""
    k, n = F.col("l_partkey"), F.col("l_linenumber")
    side = F.when(k % 101 == 0, "other").when(n % 2 == 0, "team").otherwise("opponent")
    card = F.when(k % 103 == 0, "_invalid").otherwise(F.concat(F.lit("c"), (F.col("l_suppkey") % 10).cast("string"), F.when(k % 5 == 0, "-ev1").otherwise("")))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), n.alias("n"), side.alias("side"), card.alias("card"), (n * 20 - (k % 3) * 15 - F.when(k % 107 == 0, 200).otherwise(0)).cast("int").alias("time_raw"),
        (k * 37 % 18200).cast("int").alias("x"), (k * 53 % 32300).cast("int").alias("y"), F.when(k % 4 > 0, k * 41 % 18200).cast("int").alias("x_raw"), F.when(k % 4 > 0, k * 59 % 32300).cast("int").alias("y_raw"), F.when(k % 9 > 0, k % 3).cast("int").alias("data_i"))


PLAYS = """(SELECT l_orderkey AS o_orderkey, l_linenumber AS n, CASE WHEN l_partkey % 101 = 0 THEN 'other' WHEN l_linenumber % 2 = 0 THEN 'team' ELSE 'opponent' END AS side, l_partkey % 103 = 0 AS no_card, l_suppkey % 10 AS card,
  (l_linenumber * 20 - (l_partkey % 3) * 15 - CASE WHEN l_partkey % 107 = 0 THEN 200 ELSE 0 END)::INTEGER AS t, (l_partkey * 37 % 18200)::INTEGER AS x, (l_partkey * 53 % 32300)::INTEGER AS y,
  CASE WHEN l_partkey % 4 > 0 THEN (l_partkey * 41 % 18200)::INTEGER END AS xr, CASE WHEN l_partkey % 4 > 0 THEN (l_partkey * 59 % 32300)::INTEGER END AS yr, CASE WHEN l_partkey % 9 > 0 THEN (l_partkey % 3)::INTEGER END AS d FROM lineitem)"""


def battles(spark, sf):
    p = plays_of(spark, sf)
    plays = p.groupBy("o_orderkey").agg(F.array_sort(F.collect_list(F.struct("n", "time_raw", *[c for c in p.columns if c not in ("o_orderkey", "n", "time_raw")]))).alias("card_plays"))
    k = F.col("o_orderkey")
    deck = lambda n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("c"), i.cast("string")))
    tags = lambda name: F.array(F.concat(F.lit(name), F.col("o_custkey").cast("string")))
    meta = F.struct(F.when(k % 59 == 0, "2v2").otherwise("1v1").alias("players"), F.when(k % 61 == 0, "1").otherwise("0").alias("draft"), F.when(k % 5 == 0, deck(7)).otherwise(deck(8)).alias("team_deck"), deck(8).alias("opponent_deck"))
    return table(spark, sf, "orders").join(plays, "o_orderkey", "left").select(
        "o_orderkey", "card_plays", F.when(k % 53 == 0, "").otherwise(k.cast("string")).alias("battle_tag"), (k % 370).cast("int").alias("duration_seconds"), (k % 47 != 0).alias("indexed"),
        F.when(k % 43 == 0, F.concat(tags("#a"), tags("#b"))).otherwise(tags("#a")).alias("team_tags"), tags("#c").alias("opponent_tags"), (k % 5).cast("int").alias("team_crowns"), F.when(k % 41 > 0, k % 4).cast("int").alias("opponent_crowns"),
        F.when(k % 3 > 0, meta).alias("metadata"))


@query(f"""
WITH p AS (SELECT *, max(CASE WHEN side <> 'other' AND t >= 0 THEN t END) OVER (PARTITION BY o_orderkey ORDER BY n, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM {PLAYS}),
g AS (SELECT o_orderkey, bool_or(side = 'other') AS a, bool_or(side <> 'other' AND no_card) AS b, bool_or(side <> 'other' AND t < 0) AS c, bool_or(side <> 'other' AND t >= 0 AND t < top) AS d, bool_or(side <> 'other' AND x > 18000) AS e,
  bool_or(side <> 'other' AND y > 32000) AS f, count(DISTINCT card) FILTER (WHERE side = 'team' AND NOT no_card) AS n1, count(DISTINCT card) FILTER (WHERE side = 'opponent' AND NOT no_card) AS n2,
  max(card) FILTER (WHERE side = 'team' AND NOT no_card) AS m1, max(card) FILTER (WHERE side = 'opponent' AND NOT no_card) AS m2 FROM p GROUP BY 1),
r AS (SELECT o.o_orderkey AS k, k % 3 > 0 AS meta, k % 5 > 0 AS full_deck, list_sort(list_filter([CASE WHEN k % 53 = 0 THEN 'missing_battle_tag' END, CASE WHEN g.o_orderkey IS NULL THEN 'missing_card_plays' END,
  CASE WHEN k % 370 NOT BETWEEN 1 AND 360 THEN 'invalid_duration' END, CASE WHEN a THEN 'invalid_side' END, CASE WHEN b THEN 'invalid_card' END, CASE WHEN c THEN 'invalid_tick' END, CASE WHEN d THEN 'nonmonotonic_tick' END,
  CASE WHEN e THEN 'invalid_x' END, CASE WHEN f THEN 'invalid_y' END, CASE WHEN k % 47 = 0 THEN 'missing_index_metadata' END, CASE WHEN k % 43 = 0 THEN 'team_size_2' END, CASE WHEN k % 5 > 3 THEN 'invalid_team_crowns' END, CASE WHEN k % 41 = 0 THEN 'invalid_opponent_crowns' END,
  CASE WHEN n1 > 8 THEN 'team_more_than_8_cards' END, CASE WHEN n2 > 8 THEN 'opponent_more_than_8_cards' END, CASE WHEN k % 3 > 0 AND k % 59 = 0 THEN 'list_not_1v1' END, CASE WHEN k % 3 > 0 AND k % 61 = 0 THEN 'draft_or_special_selection' END,
  CASE WHEN k % 3 > 0 AND k % 5 = 0 THEN 'incomplete_list_deck' END, CASE WHEN k % 3 > 0 AND k % 5 > 0 AND m1 > 7 THEN 'team_play_not_in_deck' END, CASE WHEN k % 3 > 0 AND k % 5 > 0 AND m2 > 7 THEN 'opponent_play_not_in_deck' END], lambda v: v IS NOT NULL)) AS r
  FROM (SELECT *, o_orderkey AS k FROM orders) o LEFT JOIN g ON g.o_orderkey = o.k)
SELECT k AS o_orderkey, array_to_string(r, ',') AS reasons, CASE WHEN len(list_filter(r, lambda v: v <> 'missing_index_metadata')) > 0 THEN 'rejected' WHEN meta AND full_deck THEN 'confirmed_1v1' ELSE 'uncertain_1v1' END AS class,
  CASE WHEN len(r) = 0 THEN NULL WHEN list_contains(r, 'team_size_2') THEN 'definite_2v2' WHEN list_has_any(r, ['missing_battle_tag', 'missing_card_plays']) THEN 'corrupt_or_empty' WHEN list_has_any(r, ['list_not_1v1', 'draft_or_special_selection']) THEN 'confirmed_special_mode'
  WHEN list_has_any(r, ['invalid_duration', 'invalid_team_crowns', 'invalid_opponent_crowns']) THEN 'invalid_result_metadata' WHEN list_has_any(r, ['team_more_than_8_cards', 'opponent_more_than_8_cards']) THEN 'multi_deck_or_parser_anomaly' ELSE 'other' END AS grp FROM r""")
def battle_audit(spark, sf):
    """Reasons against each match, its class and its quarantine group."""
    from cinderlane.operators.audit import first_group

    a = battles(spark, sf).withColumn("reasons", B.battle_reasons())
    return a.select("o_orderkey", F.concat_ws(",", "reasons").alias("reasons"), B.battle_class(F.col("reasons")).alias("class"), first_group(F.col("reasons"), B.QUARANTINE).alias("grp"))


@query(f"""
SELECT o_orderkey, CASE WHEN n > 0 AND e = n THEN 'all_card_events_raw_data_i' WHEN e > 0 THEN 'partial_raw_data_i' ELSE 'legacy_xy_only' END AS tier, coalesce(n, 0)::INTEGER AS events, coalesce(e, 0)::INTEGER AS exact, coalesce(z, 0)::INTEGER AS zero, coalesce(e - z, 0)::INTEGER AS one, coalesce(n - e, 0)::INTEGER AS legacy
FROM orders LEFT JOIN (SELECT o_orderkey, count(*) AS n, count(*) FILTER (WHERE xr IS NOT NULL AND d IN (0, 1)) AS e, count(*) FILTER (WHERE xr IS NOT NULL AND d = 0) AS z FROM {PLAYS} GROUP BY 1) USING (o_orderkey)""")
def coordinate_tiers(spark, sf):
    """How many plays of each match have raw coordinates."""
    return battles(spark, sf).select("o_orderkey", B.coordinate_tier().alias("t")).select("o_orderkey", "t.*")


@query(f"""
WITH q AS (SELECT *, xr IS NOT NULL AND d IS NOT NULL AS raw FROM {PLAYS}),
c AS (SELECT o_orderkey, n, raw, d, CASE WHEN NOT raw THEN x WHEN d IN (0, 1) AND xr <= 18000 AND yr <= 32000 THEN CASE WHEN d = 0 THEN 18000 - xr ELSE xr END END AS px, CASE WHEN NOT raw THEN y WHEN d IN (0, 1) AND xr <= 18000 AND yr <= 32000 THEN CASE WHEN d = 0 THEN 32000 - yr ELSE yr END END AS py FROM q)
SELECT o_orderkey, n, px AS x, py AS y, CASE WHEN raw THEN d END AS flag, CASE WHEN raw THEN 'raw_marker' ELSE 'legacy_xy' END AS provenance FROM c WHERE px BETWEEN 0 AND 17999 AND py BETWEEN 0 AND 31999""")
def native_points(spark, sf):
    """P10: places of plays on the board, and where they come from."""
    p = plays_of(spark, sf)
    return p.select("o_orderkey", "n", B.native_point(F.struct("x", "y", "x_raw", "y_raw", "data_i")).alias("p")).filter("p is not null").select("o_orderkey", "n", "p.*")


@query(f"""
WITH c AS (SELECT o_orderkey, count(*) FILTER (WHERE n > 4 AND side = 'team') AS a, count(*) FILTER (WHERE n > 4 AND side = 'opponent') AS b, count(*) FILTER (WHERE n > 4) AS s FROM {PLAYS} GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 = 0 THEN 'source_reports_zero' WHEN s IS NULL OR s = 0 THEN 'count_only_missing_ticks' WHEN a = o_orderkey % 4 AND b = o_orderkey % 3 THEN 'observed_ticks_identity_runtime_resolved' ELSE 'observed_tick_count_mismatch' END AS tier
FROM orders LEFT JOIN c USING (o_orderkey)""")
def ability_tiers(spark, sf):
    """How complete each match's second log is, against the counts reported for it."""
    log = plays_of(spark, sf).filter("n > 4").groupBy("o_orderkey").agg(F.collect_list(F.struct("side", "time_raw")).alias("ability_plays"))
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey").join(log, "o_orderkey", "left").select("o_orderkey", B.ability_log_tier([(k % 4).cast("int"), (k % 3).cast("int")]).alias("tier"))


@query(f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN tick END AS t, CASE WHEN event_id % 5 > 0 THEN tick + 86400 END AS c FROM {EV}), v AS (SELECT *, coalesce(t, c) AS v FROM e)
SELECT event_id, coalesce(v, -1) AS version_timestamp, CASE WHEN t IS NOT NULL THEN 'exact' WHEN c IS NOT NULL THEN 'list_cursor_upper_bound' ELSE 'recent_first_page' END AS quality, coalesce(v >= 1705000000, true) AS accepted FROM v""")
def version_window(spark, sf):
    """Time, its quality and whether it is recent enough; every other exact time is in milliseconds, and
    cursors are read from a URL."""
    k, t = F.col("event_id"), F.col("tick")
    url = F.when(k % 5 > 0, F.concat(F.lit("https://host/list?x=1&before="), (t + 86400).cast("string"), F.lit("#top"))).otherwise("https://host/list")
    e = events(spark, sf).select("event_id", F.when(k % 3 > 0, F.when(k % 2 == 0, t * 1000).otherwise(t)).cast("string").alias("stamp"), B.cursor_of(url).alias("cursor"))
    return B.version_window(e, "stamp", "cursor", 1_705_000_000).drop("stamp", "cursor").withColumn("version_timestamp", F.coalesce("version_timestamp", F.lit(-1)))


@query("""
SELECT c_custkey, a AS actor, (c_custkey % 2 <> a)::INTEGER AS relation, CASE WHEN a = 0 THEN c_custkey * 37 % 18000 ELSE 17999 - c_custkey * 37 % 18000 END AS x, CASE WHEN a = 0 THEN c_custkey * 53 % 32000 ELSE 31999 - c_custkey * 53 % 32000 END AS y,
  CASE WHEN c_custkey % 2 = a THEN c_acctbal END AS c_acctbal FROM customer, range(2) t(a)""")
def side_views(spark, sf):
    """Each entity as either side sees it."""
    k = F.col("c_custkey")
    return B.side_views(table(spark, sf, "customer").select("c_custkey", (k % 2).alias("side"), (k * 37 % 18000).alias("x"), (k * 53 % 32000).alias("y"), "c_acctbal"), ["c_acctbal"])


@query(f"""
WITH f AS (SELECT user_id, event_id, tick // 86400 AS d, event_type, value, tick // 86400 - lag(tick // 86400) OVER (PARTITION BY user_id ORDER BY event_id) AS step, event_id // 7 - lag(event_id // 7) OVER (PARTITION BY user_id, event_id % 2 ORDER BY event_id) AS jump FROM {EV}),
t AS (SELECT user_id, arg_min(d, event_id) AS first_tick, arg_max(d, event_id) AS last_tick, count(*) AS frames, count(*) FILTER (WHERE step NOT IN (0, 1)) AS frame_gaps, count(*) FILTER (WHERE step = 0) AS repeats, count(*) FILTER (WHERE jump <> 1) AS sequence_gaps, sum(value) AS damage FROM f GROUP BY 1),
k AS (SELECT user_id, event_id % 5 AS k, count(DISTINCT event_type) AS n, bool_or(value > 90) AS ok FROM f GROUP BY 1, 2)
SELECT t.user_id, first_tick, last_tick, frames, frame_gaps, repeats, count(*) AS keys, count(*) FILTER (WHERE n > 1) AS reused, count(*) FILTER (WHERE NOT ok) AS without_lineage, any_value(sequence_gaps)::BIGINT AS sequence_gaps, round(any_value(damage), 6) AS damage
FROM t JOIN k ON t.user_id = k.user_id GROUP BY ALL""")
def stream_integrity(spark, sf):
    """Gaps, repeats, reused keys, lineage and damage of each stream."""
    e = events(spark, sf).withColumn("d", F.floor(F.col("tick") / 86400))
    frames = e.select("user_id", F.col("event_id").alias("line"), F.col("d").alias("tick"))
    told = e.select("user_id", (F.col("event_id") % 2).alias("epoch"), F.col("event_id").alias("line"), F.floor(F.col("event_id") / 7).alias("sequence"), (F.col("event_id") % 5).alias("key"), F.col("event_type").alias("identity"), (F.col("value") > 90).alias("explained"), F.col("value").alias("damage"))
    return B.stream_facts(frames, told, "user_id").withColumn("damage", F.round("damage", 6))


ATTRIBUTES = "(SELECT p_partkey AS node, 'size' AS field, p_size::VARCHAR AS value FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'brand', p_brand FROM part WHERE p_partkey % 4 = 0 UNION ALL SELECT p_partkey, 'brand', p_type FROM part WHERE p_partkey % 8 = 0 UNION ALL SELECT p_partkey, 'name', p_name FROM part WHERE p_partkey < 4)"


@query(f"""
WITH RECURSIVE a AS (SELECT node, field, CASE WHEN count(DISTINCT value) = 1 THEN min(value) END AS value FROM {ATTRIBUTES} GROUP BY 1, 2), up AS (SELECT p_partkey AS k, CASE WHEN p_partkey > 1 THEN p_partkey // 2 END AS up FROM part),
c(node, cur, depth) AS (SELECT k, k, 0 FROM up UNION ALL SELECT c.node, up.up, depth + 1 FROM c JOIN up ON up.k = c.cur WHERE up.up IS NOT NULL)
SELECT c.node, a.field, arg_min(struct_pack(v := a.value), depth).v AS value, min(depth)::INTEGER AS depth FROM c JOIN a ON a.node = c.cur GROUP BY 1, 2""")
def inherit_attributes(spark, sf):
    """Attributes of each node, its own before its ancestors'; what a node gives twice is unknown."""
    p = table(spark, sf, "part")
    one = lambda name, value, where: p.filter(where).select(F.col("p_partkey").alias("node"), F.lit(name).alias("field"), F.col(value).cast("string").alias("value"))
    own = one("size", "p_size", "p_partkey % 3 = 0").unionByName(one("brand", "p_brand", "p_partkey % 4 = 0")).unionByName(one("brand", "p_type", "p_partkey % 8 = 0")).unionByName(one("name", "p_name", "p_partkey < 4"))
    up = p.select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") > 1, F.floor(F.col("p_partkey") / 2)).alias("parent"))
    return joins.inherited(own, up, "node", "field", "value", "parent")


@query(f"""
WITH RECURSIVE n AS (SELECT k, up, (p_size > 30) AS ok FROM {PARENTS} q JOIN part ON p_partkey = q.k), c(node, cur, up, ok, depth) AS (SELECT k, k, up, ok, 0 FROM n UNION ALL SELECT c.node, n.k, n.up, n.ok, depth + 1 FROM c JOIN n ON n.k = c.up WHERE NOT c.ok AND depth < 30)
SELECT node, max(CASE WHEN ok THEN cur END) AS credited FROM c GROUP BY 1""")
def credited_unit(spark, sf):
    """The nearest ancestor that counts."""
    return joins.credited(parents(spark, sf).withColumn("ok", F.col("p_size") > 30), "k", "up", "ok")


@query("""
WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderkey - 1 AS slot, o_orderkey - 32 AS context FROM orders)
SELECT o.k, CASE WHEN a.s = o.s THEN a.k WHEN b.s = o.s THEN b.k END AS parent, CASE WHEN a.s = o.s THEN 'slot' WHEN b.s = o.s THEN 'context' ELSE 'unknown' END AS origin FROM o LEFT JOIN o a ON a.k = o.slot LEFT JOIN o b ON b.k = o.context""")
def owned_parents(spark, sf):
    """Parent by slot, else by context, of the same owner only."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), (F.col("o_orderkey") - 1).alias("slot"), (F.col("o_orderkey") - 32).alias("context"))
    return joins.owned_parents(o, "k", "s", ["slot", "context"]).select("k", "parent", "origin")


@query(f"""
WITH e AS (SELECT user_id, tick, count(*) AS n FROM {EV} GROUP BY 1, 2), cut AS (SELECT (min(tick) + max(tick)) // 2 AS middle FROM e),
a AS (SELECT user_id, tick, lag(tick) OVER w AS p, lead(tick) OVER w AS f FROM e WINDOW w AS (PARTITION BY user_id ORDER BY tick)), b AS (SELECT user_id, tick, lag(tick) OVER w AS p, lead(tick) OVER w AS f FROM (SELECT e.* FROM e, cut WHERE tick < middle) WINDOW w AS (PARTITION BY user_id ORDER BY tick))
SELECT 'backward' AS operator, count(*) FILTER (WHERE a.p IS DISTINCT FROM b.p) AS differing FROM a JOIN b ON a.user_id = b.user_id AND a.tick = b.tick UNION ALL SELECT 'forward', count(*) FILTER (WHERE a.f IS DISTINCT FROM b.f) FROM a JOIN b ON a.user_id = b.user_id AND a.tick = b.tick""")
def causality_truncate(spark, sf):
    """Rows that change when what comes after the middle is cut off: none for an operator that looks back, some for
    one that looks ahead."""
    e = events(spark, sf)
    cut = e.agg(F.floor((F.min("tick") + F.max("tick")) / 2)).first()[0]
    run = lambda d: sequence.intervals(d, "user_id", "tick", "event_type", "event_id")
    count = lambda name, f: sequence.truncation_differences(run, e, "tick", cut, ["user_id", "tick"], f).agg(F.lit(name).alias("operator"), F.count(F.lit(1)).alias("differing"))
    return count("backward", ["interval", "n_before", "previous_kind"]).unionByName(count("forward", ["censored"]))


@query(f"""
SELECT DISTINCT s.user_id, s.tick, e.event_id FROM {EV} s JOIN {EV} e ON e.user_id = s.user_id AND e.tick <= s.tick AND e.tick > s.tick - 600 WHERE e.event_type = 'purchase'""")
def recent_purchases(spark, sf):
    """Purchases of the last ten minutes at each of a user's ticks."""
    e = events(spark, sf)
    bought = e.filter("event_type = 'purchase'").withColumn("slot", F.floor(F.col("tick") / 600))
    # ticks are seconds: meet by slots of ten minutes, this and the one before
    near = e.select("user_id", "tick").distinct().withColumn("slot", F.explode(F.array(F.floor(F.col("tick") / 600), F.floor(F.col("tick") / 600) - 1)))
    hit = near.join(bought.select("user_id", "slot", "event_id", F.col("tick").alias("at")), ["user_id", "slot"])
    return hit.filter((F.col("at") <= F.col("tick")) & (F.col("at") > F.col("tick") - 600)).select("user_id", "tick", "event_id")


@query("""
WITH p AS (SELECT user_id, (event_id * 7 + floor(value)::BIGINT) % 8 AS card, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events),
g AS (SELECT *, (card + user_id) % 9 AS place, lag(n) OVER (PARTITION BY user_id, card ORDER BY n) AS again FROM p),
f AS (SELECT user_id, n, place < 8 AND CASE WHEN again IS NOT NULL THEN n - again > 4 ELSE n >= greatest(0, place - 3) END AS fits FROM g)
SELECT user_id, bool_and(fits) AS possible, min(CASE WHEN NOT fits THEN n END) AS failing FROM f GROUP BY 1""")
def observed_deals(spark, sf):
    """Do a user's plays fit an observed starting hand and queue?"""
    plays = table(spark, sf, "events").select("user_id", "event_id", ((F.col("event_id") * 7 + F.floor("value")) % 8).alias("card"))
    users = plays.select("user_id").distinct().withColumn("card", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))))
    layout = users.withColumn("place", (F.col("card") + F.col("user_id")) % 9).filter("place < 8")
    return sequence.deals(plays, layout, "user_id", "card", "event_id").select("user_id", "possible", F.col("failing").cast("long").alias("failing"))


@query("""
WITH b AS (SELECT o_orderkey AS k, o_custkey AS d FROM orders WHERE o_orderkey % 10 < 8), e AS (SELECT l_orderkey AS k, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS u, sum(l_quantity) FILTER (WHERE l_returnflag <> 'R') AS t FROM lineitem WHERE l_linenumber <= 4 GROUP BY 1)
SELECT d AS deployment, coalesce(sum(u), 0) AS unit_damage, coalesce(sum(t), 0) AS tower_damage, count(*) AS descendants, bool_and(b.k % 4 > 0) AS all_dead FROM b LEFT JOIN e ON e.k = b.k GROUP BY 1""")
def deployment_totals(spark, sf):
    """Damage of each deployment by kind of target, and whether all of it is dead."""
    k = F.col("o_orderkey")
    births = table(spark, sf, "orders").select(k.alias("key"), F.col("o_custkey").alias("deployment"), (k % 10).alias("observed"), F.when(k % 4 > 0, k % 3).alias("died"))
    hits = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_key"), F.when(F.col("l_returnflag") == "R", "unit").otherwise("tower").alias("target_kind"), F.col("l_quantity").alias("amount"), (F.col("l_linenumber") + 3).alias("observed"))
    return B.deployment_totals(births, hits, 7)


@query("""
WITH u AS (SELECT o_custkey AS k, o_orderkey % 5 AS v, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS p, o_orderkey AS o FROM orders),
h AS (SELECT *, (SELECT count(*) FROM u y WHERE y.k = x.k) - 1 AS duplicates, NOT EXISTS (SELECT 1 FROM u y WHERE y.k = x.k AND (y.p, y.o) < (x.p, x.o) AND y.v >= x.v) AND EXISTS (SELECT 1 FROM u y WHERE y.k = x.k AND (y.p, y.o) < (x.p, x.o)) AS up FROM u x),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC, p DESC, o) AS r FROM h)
SELECT r.k AS o_custkey, v AS version, list_value('first', 'second', 'third')[p + 1] AS batch, o AS o_orderkey, duplicates, (SELECT count(*) FROM h WHERE h.k = r.k AND h.up) AS upgrades FROM r WHERE r = 1""")
def union_upgrades(spark, sf):
    """Batches as one table, the highest version and latest batch of each key, duplicates and upgrades."""
    o = table(spark, sf, "orders").withColumn("version", F.col("o_orderkey") % 5)
    both = B.union_batches({"first": o.filter("o_orderstatus = 'F'"), "second": o.filter("o_orderstatus = 'O'"), "third": o.filter("o_orderstatus NOT IN ('F', 'O')")})
    return B.upgraded(both, "o_custkey", "version", "priority", ["o_orderkey"]).select("o_custkey", "version", "batch", "o_orderkey", "duplicates", "upgrades")


@query("""
SELECT l_orderkey, l_linenumber, 'l_discount' AS field, l_discount * 100 AS value FROM lineitem WHERE l_orderkey % 2 = 1 UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax * 1000 FROM lineitem WHERE l_linenumber % 2 = 1""")
def wide_facts(spark, sf):
    """Value columns with known bits as long facts."""
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax", (F.col("l_orderkey") % 2).alias("a"), (F.col("l_linenumber") % 2).alias("b"))
    return B.facts_of(x, ["l_orderkey", "l_linenumber"], {"l_discount": ("a", 100.0), "l_tax": ("b", 1000.0)})


@query("""
WITH s AS (SELECT count(*) AS total, count(*) FILTER (WHERE l_quantity > 0) AS a, count(*) FILTER (WHERE l_discount > 0) AS b FROM lineitem)
SELECT 'quantity' AS capability, total, a AS verified, a = total AND total > 0 AS certified FROM s UNION ALL SELECT 'discount', total, b, b = total AND total > 0 FROM s""")
def capability_certificates(spark, sf):
    """What holds in every row."""
    x = table(spark, sf, "lineitem").select((F.col("l_quantity") > 0).alias("quantity"), (F.col("l_discount") > 0).alias("discount"))
    return B.certificates(x, ["quantity", "discount"])


@query("""
WITH n AS (SELECT p_size * 40 + p_partkey % 40 AS name, p_brand AS family, p_partkey AS node FROM part), g AS (SELECT name, family, count(DISTINCT node) AS n, min(node) AS v FROM n GROUP BY 1, 2),
t AS (SELECT name, count(DISTINCT node) AS n, min(node) AS v FROM n GROUP BY 1), one AS (SELECT * FROM g WHERE n = 1)
SELECT t.name, CASE WHEN t.n = 1 THEN t.v ELSE coalesce(a.v, b.v, c.v) END AS node FROM t LEFT JOIN one a ON a.name = t.name AND a.family = 'Brand#22' LEFT JOIN one b ON b.name = t.name AND b.family = 'Brand#11' LEFT JOIN one c ON c.name = t.name AND c.family = 'Brand#33'""")
def preferred_names(spark, sf):
    """Names to nodes: a single node, else by a preference of families; several candidates in all of them give none."""
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select((F.col("p_size") * 40 + k % 40).alias("name"), F.col("p_brand").alias("family"), k.alias("node"))
    return B.preferred(p, "name", "family", "node", ["Brand#22", "Brand#11", "Brand#33"])


@query("""
WITH e AS (SELECT user_id AS k, event_id // 2 AS id, event_id // 3 % 50 AS t, event_id // 4 AS frame, event_id, event_type AS v FROM events),
f AS (SELECT k, frame, max(t) AS top FROM e GROUP BY 1, 2), b AS (SELECT e.*, (SELECT max(f.top) FROM f WHERE f.k = e.k AND f.frame < e.frame) AS top FROM e),
c AS (SELECT b.*, o.event_id IS NOT NULL AS again, o.t = b.t AND o.v = b.v AS equal FROM b LEFT JOIN (SELECT k, id, min(event_id) AS first FROM e GROUP BY 1, 2) m ON m.k = b.k AND m.id = b.id AND m.first < b.event_id LEFT JOIN e o ON o.event_id = m.first)
SELECT event_id, t + CASE WHEN t = top THEN 1 ELSE 0 END AS observed_tick, CASE WHEN again THEN 'conflict' WHEN t < top THEN 'late' ELSE 'fresh' END AS status FROM c WHERE NOT again OR NOT equal""")
def late_and_duplicate(spark, sf):
    """Repeats of an event dropped, conflicts and late events told, events of resampled ticks seen one tick later."""
    i = F.col("event_id")
    e = table(spark, sf, "events").select("user_id", F.floor(i / 2).alias("id"), (F.floor(i / 3) % 50).alias("t"), F.floor(i / 4).alias("frame"), "event_id", "event_type")
    return B.observed(e, ["user_id"], "id", "t", "frame", "event_id", ["event_type"]).select("event_id", "observed_tick", "status")


@query("SELECT event_id, user_id, event_type, value FROM events WHERE value >= 10 AND event_type <> 'error'")
def stream_dedupe_validate(spark, sf):
    """Events as a stream of files, validated and deduplicated, all that is there; equal to the batch."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        raise ValueError("spark.checkpoint.dir has to name a shared folder")
    out = f"{where.rstrip('/')}/stream-{uuid.uuid4().hex}"
    rules = {"low": F.col("value") < 10, "error": F.col("event_type") == "error"}
    stream = incremental.dedupe_stream(incremental.stream_table(spark, sf, "events"), "event_id", rules)
    incremental.run_available(stream.filter("accepted").select("event_id", "user_id", "event_type", "value"), f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")


@query("""SELECT o_orderkey, rank FROM (SELECT o_orderkey, row_number() OVER (ORDER BY sha256('scan:' || o_orderkey::VARCHAR), o_orderkey) AS rank FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F') WHERE rank <= 200""")
def ranked_scan(spark, sf):
    """The first 200 in hash order that are wanted."""
    wanted = (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F")
    found, _ = sampling.ranked_scan(table(spark, sf, "orders"), "o_orderkey", wanted, 200, "scan")
    return sampling.ranked(found.withColumn("h", sampling.hash_order("scan", "o_orderkey")), ["h", "o_orderkey"], "r").select("o_orderkey", (F.col("r") + 1).alias("rank"))


@query("""
WITH b AS (SELECT o_orderkey, least(3, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) * 4 // count(*) OVER ())::INTEGER AS bin0, least(3, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) * 4 // count(*) OVER ())::INTEGER AS bin1 FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY bin0, bin1 ORDER BY sha256('draw:' || o_orderkey::VARCHAR), o_orderkey) AS round FROM b) SELECT o_orderkey, bin0, bin1, round::INTEGER AS round FROM r ORDER BY round, bin0, bin1 LIMIT 200""")
def stratified_draw(spark, sf):
    """200 drawn round by round from a grid of price and date bins."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return sampling.stratified_draw(o, ["o_totalprice", "o_orderdate"], "o_orderkey", 4, 200, "draw").select("o_orderkey", "bin0", "bin1", "round")


@query()
def diverse_sample(spark, sf):
    """T4: twelve parts of the greatest diversity of type words and brands, taken greedily (tested by brute force)."""
    p = table(spark, sf, "part").select("p_partkey", F.split("p_type", " ").alias("tags"), F.array("p_brand").alias("cards"))
    keys = sampling.diverse(p, "p_partkey", "tags", "cards", 12)
    return p.filter(F.col("p_partkey").isin(keys)).select("p_partkey", F.array_position(F.array(*map(F.lit, keys)), F.col("p_partkey")).alias("place"))


@query("""
SELECT to_json(struct_pack(orders := count(*), open := count(*) FILTER (WHERE o_orderstatus = 'O'), customers := count(DISTINCT o_custkey)))::VARCHAR AS summary FROM orders""")
def run_summary(spark, sf):
    """One row of counters as JSON."""
    c = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.countDistinct("o_custkey").alias("customers"))
    return c.select(F.to_json(F.struct("orders", "open", "customers")).alias("summary"))


@query(r"""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 0 END AS flags, lower(p_brand) AS base, trunc((p_size - 25) * 37 / 100.0)::BIGINT AS level, (p_partkey % 2 * 3 + CASE WHEN p_partkey % 3 = 0 THEN 0 WHEN p_partkey % 5 = 1 THEN 2 - p_partkey % 2 ELSE 1 + p_partkey % 2 END)::INTEGER AS tower,
  strftime(to_timestamp(1700000000 + p_partkey * 86400) AT TIME ZONE 'UTC', '%Y-%m') AS month, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 30 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS rate FROM part""")
def scalar_forms(spark, sf):
    """Tokens with forms, levels, towers, months and step rates."""
    k = F.col("p_partkey")
    token = F.concat(F.lit(" "), F.col("p_brand"), F.when(k % 3 == 0, "-EV1").otherwise(""), F.when(k % 2 == 0, "-hero").otherwise(""))
    t = S.split_token(token)
    return table(spark, sf, "part").select(
        "p_partkey", t["flags"].alias("flags"), t["base"].alias("base"), S.scaled_level(F.col("p_size") - 25, F.lit(37)).alias("level"), S.tower_key(k % 2, F.when(k % 3 == 0, "king").otherwise("princess"), k % 2, k % 5).alias("tower"),
        S.month_of(1700000000 + k * 86400).alias("month"), S.step_rate(F.col("p_size"), [(10, 1.0), (30, 2.0)]).alias("rate"))
