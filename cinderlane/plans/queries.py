"""Queries that apply the operators to the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlane.functions import scalars as S
from cinderlane.operators import aggs, audit, joins, sampling, sequence, splits
from cinderlane.sources.tables import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


EV = "(SELECT *, floor(epoch(ts))::BIGINT AS tick FROM events)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("tick", S.seconds(F.col("ts")))


@query(f"""
WITH j AS (SELECT user_id, tick, count(*) AS n, arg_min(event_type, event_id) AS first_kind, arg_max(event_type, event_id) AS last_kind FROM {EV} GROUP BY 1, 2)
SELECT user_id, tick, n, first_kind, lag(last_kind) OVER w AS previous_kind, tick - lag(tick) OVER w AS "interval",
  coalesce(sum(n) OVER (PARTITION BY user_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS n_before,
  lead(tick) OVER w IS NULL AS censored
FROM j WINDOW w AS (PARTITION BY user_id ORDER BY tick)""")
def event_intervals(spark, sf):
    """The flagship."""
    return sequence.intervals(events(spark, sf), "user_id", "tick", "event_type", "event_id").drop("anchor")


CARDS = "(SELECT user_id, event_id, (event_id * 7 + floor(value)::BIGINT) % 8 AS card, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events)"


def plays(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_id", ((F.col("event_id") * 7 + F.floor("value")) % 8).alias("card"))


@query(f"""
WITH g AS (SELECT user_id, n, n - lag(n) OVER (PARTITION BY user_id, card ORDER BY n) AS gap FROM {CARDS})
SELECT user_id, bool_and(coalesce(gap, 5) > 4) AS valid, min(CASE WHEN gap <= 4 THEN n END) AS failing, count(*) AS plays FROM g GROUP BY 1""")
def rotation_validity(spark, sf):
    """Is a sequence of plays possible in a rotation of eight cards, four in hand?"""
    return sequence.first_impossible(sequence.rotation(plays(spark, sf), ["user_id"], "card", ["event_id"]), ["user_id"])


@query(f"""
SELECT user_id, n, card, lag(card, 4) OVER w AS next_card,
  CASE WHEN n >= 4 THEN list_sort(list_distinct([lag(card, 1) OVER w, lag(card, 2) OVER w, lag(card, 3) OVER w, lag(card, 4) OVER w]))::VARCHAR END AS away
FROM {CARDS} WINDOW w AS (PARTITION BY user_id ORDER BY n)""")
def exact_hand_next(spark, sf):
    """The card next in line, and the cards out of the hand, before each play."""
    r = sequence.rotation(plays(spark, sf), ["user_id"], "card", ["event_id"])
    shown = F.concat(F.lit("["), F.array_join(F.col("away").cast("array<string>"), ", "), F.lit("]"))
    return r.select("user_id", F.col("n").cast("long").alias("n"), "card", "next_card", shown.alias("away"))


@query(f"""
WITH s AS (SELECT user_id, event_type, min(tick) AS seen FROM {EV} GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen, event_type) AS place FROM s)
SELECT * FROM r WHERE place <= 8""")
def revealed_first8(spark, sf):
    """The first eight kinds seen of each user, in order."""
    return sequence.revealed(events(spark, sf), "user_id", "tick", "event_type")


@query("""
WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events),
b AS (SELECT user_id, event_id, n, n // 16 AS "window", false AS is_burn FROM n
      UNION ALL SELECT user_id, event_id, n, n // 16 + 1, true FROM n WHERE n % 16 >= 12)
SELECT b.* FROM b WHERE EXISTS (SELECT 1 FROM n WHERE n.user_id = b.user_id AND n.n // 16 = b."window")""")
def burn_in_windows(spark, sf):
    """Windows of sixteen targets with a burn-in of four."""
    out = sequence.burn_in_windows(table(spark, sf, "events"), "user_id", ["ts", "event_id"], 16, 4)
    return out.select("user_id", "event_id", F.col("n").cast("long").alias("n"), "window", "is_burn")


@query(f"""
WITH b AS (SELECT user_id, event_id, tick, CASE WHEN tick - lag(tick) OVER w > 3600 OR lag(tick) OVER w IS NULL THEN 1 ELSE 0 END AS broken FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY tick, event_id)),
s AS (SELECT *, sum(broken) OVER (PARTITION BY user_id ORDER BY tick, event_id) AS session FROM b)
SELECT user_id, event_id, session, (row_number() OVER (PARTITION BY user_id, session ORDER BY tick, event_id) - 1) // 4 AS chunk FROM s""")
def session_chunks(spark, sf):
    """Sessions broken by gaps of over an hour, in chunks of four."""
    return sequence.chunks(events(spark, sf), "user_id", "tick", ["tick", "event_id"], 3600, 4).select("user_id", "event_id", "session", "chunk")


@query(f"""
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY tick RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW), 6) AS hour,
  round(sum(value) OVER (PARTITION BY user_id ORDER BY tick RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW), 6) AS day,
  round(sum(value) OVER (PARTITION BY user_id ORDER BY tick RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS lifetime FROM {EV}""")
def rolling_amounts(spark, sf):
    """Sums over an hour, a day and the life so far."""
    out = sequence.rolling_sums(events(spark, sf), "user_id", "tick", "value", {"hour": 3600, "day": 86400})
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in ("hour", "day", "lifetime")])


CHANGED = """(SELECT o_custkey, o_orderkey, n, a + b AS mask FROM (SELECT o_custkey, o_orderkey, row_number() OVER w AS n,
  CASE WHEN row_number() OVER w = 1 OR o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER w THEN 1 ELSE 0 END AS a,
  CASE WHEN row_number() OVER w = 1 OR o_orderpriority IS DISTINCT FROM lag(o_orderpriority) OVER w THEN 2 ELSE 0 END AS b
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)))"""


def order_changes(spark, sf):
    return sequence.changes(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query(f"SELECT o_custkey, o_orderkey, mask, CASE WHEN n = 1 THEN 'spawned' WHEN mask > 0 THEN 'updated' ELSE 'same' END AS change FROM {CHANGED}")
def change_events(spark, sf):
    """Spawned and updated rows with the mask of changed fields."""
    return order_changes(spark, sf).select("o_custkey", "o_orderkey", "mask", "change")


@query("SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def rebuild_state(spark, sf):
    """Anchors and deltas give back every row."""
    d = order_changes(spark, sf)
    told = d.withColumn("o_orderstatus", F.when((F.col("n") % 8 == 1) | (F.col("mask").bitwiseAND(F.lit(1)) != 0), F.col("o_orderstatus")))
    told = told.withColumn("o_orderpriority", F.when((F.col("n") % 8 == 1) | (F.col("mask").bitwiseAND(F.lit(2)) != 0), F.col("o_orderpriority")))
    out = sequence.rebuilt(told, "o_custkey", ["o_orderstatus", "o_orderpriority"], 8)
    return out.select("o_orderkey", F.col("re_o_orderstatus").alias("status"), F.col("re_o_orderpriority").alias("priority"))


@query(f"""
SELECT event_id, CASE WHEN s = 0 THEN 'repeat' WHEN s < 0 THEN 'back' WHEN s > 1 THEN 'gap' ELSE 'next' END AS kind
FROM (SELECT event_id, tick - lag(tick) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM {EV})""")
def tick_jumps(spark, sf):
    """Repeats, gaps and steps back."""
    return sequence.jumps(events(spark, sf), ["user_id"], ["event_id"], "tick").select("event_id", "kind")


@query(f"""
SELECT event_id, coalesce(tick - max(CASE WHEN event_type = 'purchase' THEN tick END) OVER (PARTITION BY user_id ORDER BY tick RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS since,
  coalesce(min(CASE WHEN event_type = 'purchase' THEN tick END) OVER (PARTITION BY user_id ORDER BY tick RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - tick, -1) AS until FROM {EV}""")
def asof_before_after(spark, sf):
    """Time since the nearest purchase strictly before, and until that at or after, each event's tick; -1 for none."""
    return sequence.nearest(events(spark, sf), "user_id", "tick", F.col("event_type") == "purchase").select("event_id", F.coalesce(F.col("tick") - F.col("before"), F.lit(-1)).alias("since"), F.coalesce(F.col("after") - F.col("tick"), F.lit(-1)).alias("until"))


@query("""
SELECT event_id, concat_ws(',', lag(event_type, 2) OVER w, lag(event_type, 1) OVER w) AS last FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def last_two_commands(spark, sf):
    """The two kinds before each event."""
    return sequence.last_k(table(spark, sf, "events"), "user_id", ["event_id"], "event_type", 2).select("event_id", F.concat_ws(",", "last").alias("last"))


@query("""
WITH n AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events)
SELECT user_id, coalesce(min(CASE WHEN NOT value < 90 THEN n END), count(*))::BIGINT AS prefix, count(*) AS n FROM n GROUP BY 1""")
def accepted_prefix(spark, sf):
    """Leading events below a value."""
    return sequence.accepted_prefix(table(spark, sf, "events"), "user_id", ["event_id"], F.col("value") < 90)


@query("""
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 6) AS spent, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM events""")
def running_cost(spark, sf):
    """Running sum and step to the row before."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf, "events").select("event_id", F.round(F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)), 6).alias("spent"), (F.col("event_id") - F.lag("event_id").over(w)).alias("step"))


STEPS = """(SELECT user_id, event_id, value / 100 AS reward, value / 50 AS v, (value + 1) / 60 AS next_v, 1 + event_id % 7 AS elapsed, event_type = 'purchase' AS terminated, event_type = 'error' AS truncated,
  value < 95 AS valid, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back, lag(value < 95) OVER (PARTITION BY user_id ORDER BY event_id DESC) AS later FROM events)"""


@query(f"""
WITH RECURSIVE s AS (SELECT *, reward + power(0.99, elapsed / 5.0) * CASE WHEN terminated THEN 0 ELSE next_v END - v AS delta,
  power(0.99 * 0.95, elapsed / 5.0) * CASE WHEN NOT terminated AND NOT truncated AND coalesce(later, false) THEN 1 ELSE 0 END AS carry FROM {STEPS}),
r AS (SELECT user_id, event_id, back, v, CASE WHEN valid THEN delta ELSE 0.0 END AS adv FROM s WHERE back = 1
  UNION ALL SELECT s.user_id, s.event_id, s.back, s.v, CASE WHEN s.valid THEN s.delta + s.carry * r.adv ELSE 0.0 END FROM r JOIN s ON s.user_id = r.user_id AND s.back = r.back + 1)
SELECT user_id, event_id, round(adv, 6) + 0.0 AS advantage, round(adv + v, 6) + 0.0 AS ret FROM r""")
def gae(spark, sf):
    """Advantages backwards over each user's events, with terminal, truncated and invalid steps."""
    v = F.col("value")
    steps = table(spark, sf, "events").select(
        "user_id", "event_id", (v / 100).alias("reward"), ((v + 1) / 60).alias("next_value"), (1 + F.col("event_id") % 7).cast("double").alias("elapsed"), (F.col("event_type") == "purchase").alias("terminated"),
        (F.col("event_type") == "error").alias("truncated"), (v < 95).alias("valid"), (v / 50).alias("value"))
    out = sequence.advantages(steps, "user_id", "event_id", 0.99, 0.95)
    return out.select("user_id", "event_id", *[(F.round(c, 6) + 0.0).alias(c) for c in ("advantage", "ret")])


@query("""
WITH t AS (SELECT event_id, value AS own, 100 - value AS enemy, lead(value) OVER w AS own2, 100 - lead(value) OVER w AS enemy2, lead(event_id) OVER w - event_id AS elapsed, event_type = 'purchase' AS ended, sign(value - 50)::INTEGER AS outcome
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
s AS (SELECT event_id, CASE WHEN ended THEN outcome::DOUBLE ELSE 0.0 END AS terminal, 0.5 * (power(0.99, elapsed / 5.0) * CASE WHEN ended THEN 0 ELSE own2 / 80 - enemy2 / 90 END - (own / 80 - enemy / 90)) AS shaping FROM t WHERE elapsed IS NOT NULL)
SELECT event_id, terminal, round(shaping, 9) + 0.0 AS shaping, round(terminal + shaping, 9) + 0.0 AS total FROM s""")
def shaped_reward(spark, sf):
    """Outcome and potential-based reward of each transition."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    t = table(spark, sf, "events").withColumn("next", F.lead("value").over(w)).withColumn("elapsed", F.lead("event_id").over(w) - F.col("event_id")).filter("elapsed is not null")
    v, ended = F.col("value"), F.col("event_type") == "purchase"
    r = sequence.shaped_reward(v, 100 - v, F.col("next"), 100 - F.col("next"), (80.0, 90.0), F.col("elapsed"), ended, S.signed_outcome(v, F.lit(50)), 0.99, 0.5)
    return t.select("event_id", r.alias("r")).select("event_id", "r.terminal", *[(F.round(f"r.{c}", 9) + 0.0).alias(c) for c in ("shaping", "total")])


@query("""SELECT * EXCLUDE (r) FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def dedupe_latest(spark, sf):
    """One row for each key, the newest."""
    return aggs.best_per_key(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_values, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def conflict_keys(spark, sf):
    """Keys with different values."""
    return aggs.conflicts(table(spark, sf, "lineitem"), ["l_partkey"], "l_suppkey")


ORDER_RULES = """list_sort(list_filter([CASE WHEN o_totalprice < 5000 THEN 'small' END, CASE WHEN o_totalprice > 300000 THEN 'large' END,
  CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_orderpriority LIKE '5%' THEN 'low_priority' END], lambda x: x IS NOT NULL))"""


def audited_orders(spark, sf):
    o = table(spark, sf, "orders")
    found = audit.reasons({"small": F.col("o_totalprice") < 5000, "large": F.col("o_totalprice") > 300000, "pending": F.col("o_orderstatus") == "P", "low_priority": F.col("o_orderpriority").startswith("5")})
    return o.withColumn("reasons", found).withColumn("class", audit.classify(F.col("reasons"), ["low_priority"]))


@query(f"""
SELECT o_orderkey, array_to_string(r, ',') AS reasons, CASE WHEN len(list_filter(r, lambda x: x <> 'low_priority')) > 0 THEN 'rejected' WHEN len(r) > 0 THEN 'uncertain' ELSE 'confirmed' END AS class,
  CASE WHEN list_contains(r, 'small') OR list_contains(r, 'large') THEN 'price' WHEN list_contains(r, 'pending') THEN 'state' WHEN len(r) > 0 THEN 'other' END AS grp
FROM (SELECT o_orderkey, {ORDER_RULES} AS r FROM orders)""")
def audit_reasons(spark, sf):
    """Reasons, class and quarantine group of each order."""
    a = audited_orders(spark, sf)
    group = audit.first_group(F.col("reasons"), [("price", ["small", "large"]), ("state", ["pending"])])
    return a.select("o_orderkey", F.concat_ws(",", "reasons").alias("reasons"), "class", group.alias("grp"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest({ORDER_RULES}) AS reason FROM orders) GROUP BY 1")
def quarantine_top(spark, sf):
    """How often each reason occurs."""
    return audit.reason_counts(audited_orders(spark, sf))


@query("""
SELECT r.rule, r.v::BIGINT AS violations, total FROM (SELECT count(*) AS total, count(*) FILTER (WHERE l_quantity > 45) AS a, count(*) FILTER (WHERE l_discount < 0) AS b, count(*) FILTER (WHERE l_shipdate IS NULL) AS c FROM lineitem) t,
  LATERAL (SELECT unnest([{'rule': 'large_quantity', 'v': a}, {'rule': 'negative_discount', 'v': b}, {'rule': 'no_date', 'v': c}]) AS r)""")
def constraint_suite(spark, sf):
    """All rules in one pass."""
    return audit.suite(table(spark, sf, "lineitem"), {"large_quantity": F.col("l_quantity") > 45, "negative_discount": F.col("l_discount") < 0, "no_date": F.col("l_shipdate").isNull()})


@query("SELECT o_orderkey, c_mktsegment, sign(o_totalprice - c_acctbal)::INTEGER AS outcome FROM orders JOIN customer ON o_custkey = c_custkey")
def enrich_outcome(spark, sf):
    """Identity and outcome from the other table."""
    got, _ = joins.required(table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), table(spark, sf, "customer"), ["c_custkey"])
    return got.select("o_orderkey", "c_mktsegment", S.signed_outcome(F.col("o_totalprice"), F.col("c_acctbal")).alias("outcome"))


@query("SELECT doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS labelled FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def anti_semi_prune(spark, sf):
    """Rows of rejected keys go, rows of selected keys are marked."""
    d, lab = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    known = lab.select("doc_id").distinct().withColumn("labelled", F.lit(True))
    return d.join(lab.filter("toxic = 1"), "doc_id", "left_anti").join(known, "doc_id", "left").select("doc_id", F.coalesce("labelled", F.lit(False)).alias("labelled"))


@query("SELECT doc_id, coalesce(quality, 1 - (n_chars % 2)::INTEGER, 0) AS quality, CASE WHEN quality IS NULL THEN 'embedded' ELSE 'list' END AS origin FROM documents LEFT JOIN labels USING (doc_id)")
def fallback_metadata(spark, sf):
    """The list's metadata, else the document's own."""
    j = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return j.select("doc_id", F.coalesce("quality", (1 - F.col("n_chars") % 2).cast("int"), F.lit(0)).alias("quality"), F.when(F.col("quality").isNull(), "embedded").otherwise("list").alias("origin"))


@query("""
SELECT nationkey, CASE WHEN r.n IS NULL THEN 'only_left' WHEN l.n IS NULL THEN 'only_right' WHEN l.n = r.n THEN 'same' ELSE 'differs' END AS status
FROM (SELECT s_nationkey AS nationkey, count(*) AS n FROM supplier GROUP BY 1) l FULL JOIN (SELECT c_nationkey AS nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1) r USING (nationkey)""")
def reconcile_full(spark, sf):
    """Two catalogues against each other."""
    a = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    b = table(spark, sf, "customer").filter("c_acctbal > 0").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return joins.reconcile(a, b, ["nationkey"], ["n"]).select("nationkey", "status")


@query("""
SELECT conv_id, turn, CASE WHEN nr = 'assistant' THEN nt END AS answer_turn, coalesce(nr = 'assistant', false) AS matched
FROM (SELECT conv_id, turn, role, lead(role) OVER w AS nr, lead(turn) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user'""")
def pair_turns(spark, sf):
    """Each request with the answer right after it."""
    out = joins.pair_next(table(spark, sf, "conversations").drop("text"), "conv_id", ["turn"], F.col("role") == "user", F.col("role") == "assistant", "turn")
    return out.select("conv_id", "turn", F.col("answer").alias("answer_turn"), "matched")


@query("""
WITH s AS (SELECT conv_id, role, count(*) AS n FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1, 2), b AS (SELECT conv_id FROM s GROUP BY 1 HAVING count(*) = 2)
SELECT a.conv_id, a.role, a.n, o.role AS other_side, o.n AS other_value FROM s a JOIN s o ON a.conv_id = o.conv_id AND a.role <> o.role WHERE a.conv_id IN (SELECT conv_id FROM b)""")
def two_sided_pairs(spark, sf):
    """Both sides, each with the other."""
    s = table(spark, sf, "conversations").filter(F.col("role").isin("user", "assistant")).groupBy("conv_id", "role").agg(F.count(F.lit(1)).alias("n"))
    return joins.two_sided(s, ["conv_id"], "role", "n")


@query(f"""
WITH w AS (SELECT user_id, (tick - 1) // 3600 * 3600 AS win, string_agg(event_type, ',' ORDER BY event_id) AS kinds, count(*) AS n FROM {EV} GROUP BY 1, 2)
SELECT user_id, win, n, CASE WHEN n > 2 THEN 'too_many' WHEN contains(kinds, 'error') THEN 'rejected' WHEN contains(kinds, 'purchase') THEN 'action' ELSE 'wait' END AS label FROM w""")
def window_label(spark, sf):
    """Commands by decision window, and the window's label."""
    e = events(spark, sf).withColumn("win", S.decision_window(F.col("tick"), 3600))
    w = e.groupBy("user_id", "win").agg(F.sort_array(F.collect_set("event_type")).alias("kinds"), F.count(F.lit(1)).alias("n"))
    label = F.when(F.col("n") > 2, "too_many").when(F.array_contains("kinds", "error"), "rejected").when(F.array_contains("kinds", "purchase"), "action").otherwise("wait")
    return w.select("user_id", "win", "n", label.alias("label"))


@query("""
WITH b AS (SELECT i AS band, i * 25000.0 AS lo, (i + 1) * 25000.0 AS hi FROM range(0, 25) t(i))
SELECT o_orderkey, band FROM orders LEFT JOIN b ON o_totalprice >= lo AND o_totalprice < hi""")
def interval_lookup(spark, sf):
    """The band that holds each price."""
    bands = spark.range(25).select(F.col("id").alias("band"), (F.col("id") * 25000.0).alias("lo"), ((F.col("id") + 1) * 25000.0).alias("hi"))
    return joins.lookup_interval(table(spark, sf, "orders"), "o_totalprice", bands).select("o_orderkey", "band")


PARENTS = "(SELECT p_partkey AS k, CASE WHEN p_partkey % 97 = 0 THEN -p_partkey WHEN p_partkey % 89 = 0 THEN p_partkey WHEN p_partkey > 1 THEN p_partkey // 2 END AS up FROM part)"


def parents(spark, sf):
    """Each part's parent is half its key; some name a parent that isn't there, some themselves."""
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(k.alias("k"), F.when(k % 97 == 0, -k).when(k % 89 == 0, k).when(k > 1, F.floor(k / 2)).alias("up"), "p_size", "p_brand")


@query(f"""
WITH RECURSIVE c(node, cur, up, depth) AS (SELECT k, k, up, 0 FROM {PARENTS} UNION ALL SELECT c.node, p.k, p.up, c.depth + 1 FROM c JOIN {PARENTS} p ON p.k = c.up WHERE c.depth < 40),
e AS (SELECT node, arg_max(cur, depth) AS cur, arg_max(struct_pack(u := up), depth).u AS up, max(depth) AS depth FROM c GROUP BY 1)
SELECT node, CASE WHEN up IS NULL THEN cur END AS root, CASE WHEN up IS NULL THEN depth END AS depth, CASE WHEN up < 0 THEN 'dangling' WHEN up >= 0 THEN 'cycle' WHEN depth = 0 THEN 'root' ELSE 'linked' END AS status FROM e""")
def lineage_root(spark, sf):
    """The root of each part's chain of parents, dangling chains and cycles told apart."""
    return joins.lineage(parents(spark, sf), "k", "up").select("node", "root", F.col("depth").cast("int").alias("depth"), "status")


@query("""
WITH a AS (SELECT l_orderkey, sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey, sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem WHERE l_linenumber BETWEEN 2 AND 5 GROUP BY 1),
j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, a.q AS aq, b.q AS bq, a.n AS an, b.n AS bn, CASE WHEN b.l_orderkey IS NULL THEN 'only_left' WHEN a.l_orderkey IS NULL THEN 'only_right' ELSE 'differs' END AS reason FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey)
SELECT l_orderkey, 'q' AS field, aq::VARCHAR AS left_value, bq::VARCHAR AS right_value, reason FROM j WHERE reason <> 'differs' OR aq IS DISTINCT FROM bq
UNION ALL SELECT l_orderkey, 'n', an::VARCHAR, bn::VARCHAR, reason FROM j WHERE reason <> 'differs' OR an IS DISTINCT FROM bn""")
def parity_diff(spark, sf):
    """Fields that differ between two results, and keys that one of them lacks."""
    x = table(spark, sf, "lineitem")
    f = lambda d: d.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("long").alias("q"), F.count(F.lit(1)).alias("n"))
    return joins.parity(f(x), f(x.filter("l_linenumber between 2 and 5")), ["l_orderkey"], ["q", "n"])


@query("""
WITH c AS (SELECT p_brand AS token, count(l_orderkey) AS uses, count(DISTINCT l_orderkey) AS groups FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1)
SELECT token, uses, groups, greatest(1, least(500, groups // 4)) AS quota, greatest(0, 1500 - uses) AS deficit FROM c""")
def token_coverage(spark, sf):
    """Uses and orders of each token, its quota and what it lacks; tokens never used are there with zeros."""
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("token"))
    used = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey")).join(parts, "p_partkey")
    every = parts.groupBy("token").agg(F.count_if(F.lit(False)).alias("zero"))
    c = every.join(aggs.coverage(used, "token", "l_orderkey"), "token", "left").select("token", *[F.coalesce(x, F.col("zero")).alias(x) for x in ("uses", "groups")])
    return c.select("token", "uses", "groups", aggs.quota(F.col("groups"), 4, 500).alias("quota"), F.greatest(F.lit(0), 1500 - F.col("uses")).cast("long").alias("deficit"))


@query("SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())")
def crosstab(spark, sf):
    """Cross-tabs in one pass."""
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "o_totalprice")
    sets = [[F.col("status"), F.col("priority")], [F.col("status")], []]
    return o.groupingSets(sets, "status", "priority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""
SELECT lang, good, n, round((good / n + 3.841458820694124 / (2 * n) - 1.959963984540054 * sqrt(good / n * (1 - good / n) / n + 3.841458820694124 / (4 * n * n))) / (1 + 3.841458820694124 / n), 9) AS lower,
  round((good / n + 3.841458820694124 / (2 * n) + 1.959963984540054 * sqrt(good / n * (1 - good / n) / n + 3.841458820694124 / (4 * n * n))) / (1 + 3.841458820694124 / n), 9) AS upper
FROM (SELECT lang, sum(quality)::DOUBLE AS good, count(*)::DOUBLE AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1)""")
def wilson_by_lang(spark, sf):
    """Interval of the share of good documents."""
    g = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").groupBy("lang").agg(F.sum("quality").cast("double").alias("good"), F.count(F.lit(1)).cast("double").alias("n"))
    return g.withColumn("w", aggs.wilson(F.col("good"), F.col("n"))).select("lang", "good", "n", F.round("w.lower", 9).alias("lower"), F.round("w.upper", 9).alias("upper"))


@query("""
SELECT o_orderstatus AS status, count(*) AS attempted, count(*) FILTER (WHERE o_totalprice >= 5000) AS accepted, count(*) FILTER (WHERE o_totalprice < 5000) AS rejected, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1""")
def yield_summary(spark, sf):
    """Counts by status that add up."""
    ok = F.col("o_totalprice") >= 5000
    return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("attempted"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"), F.round(F.avg("o_totalprice"), 6).alias("mean"))


@query("""
SELECT l_orderkey, count(*) AS n, round(var_pop(l_quantity), 9) AS spread, round(covar_pop(l_quantity, l_discount), 9) + 0.0 AS together, max(l_quantity) - min(l_quantity) AS span, CASE WHEN count(l_tax) = count(*) THEN round(sum(l_tax), 6) END AS tax FROM lineitem GROUP BY 1""")
def formation_stats(spark, sf):
    """Statistics of each group, null where a member is unknown."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.var_pop("l_quantity"), 9).alias("spread"), (F.round(F.covar_pop("l_quantity", "l_discount"), 9) + 0.0).alias("together"),
        (F.max("l_quantity") - F.min("l_quantity")).alias("span"), aggs.strict_stat(F.round(F.sum("l_tax"), 6), F.col("l_tax")).alias("tax"))


@query("""
SELECT c_nationkey AS side, (c_custkey * 37 % 32000 // 1000 * 18 + c_custkey * 53 % 18000 // 1000)::INTEGER AS cell,
  CASE WHEN sum(c_acctbal) <= 0 THEN 0 WHEN sum(c_acctbal) >= 5000 THEN 255 ELSE round_even(sum(c_acctbal) / 5000 * 255, 0)::INTEGER END AS level
FROM customer GROUP BY 1, 2""")
def grid_raster(spark, sf):
    """Weights by cell, clipped and quantised, occupied cells only."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("side"), S.grid_cell(F.col("c_custkey") * 53 % 18000, F.col("c_custkey") * 37 % 32000).alias("cell"), (F.col("c_acctbal") / 5000).alias("w"))
    return aggs.raster(c, ["side"], "cell", "w")


@query("SELECT p_type, dense_rank() OVER (ORDER BY p_type) AS id FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)")
def vocab(spark, sf):
    """Tokens numbered in order."""
    return aggs.vocabulary(table(spark, sf, "part"), "p_type")


HASH = "(('0x' || substr(sha256({0}), 1, 16))::UBIGINT)"


@query(f"""
SELECT o_custkey, CASE WHEN b < 9000 THEN 'train' WHEN b < 9500 THEN 'validation' ELSE 'test' END AS split, n
FROM (SELECT o_custkey, {HASH.format("'split-v1:' || o_custkey::VARCHAR")} % 10000 AS b, count(*) AS n FROM orders GROUP BY 1, 2)""")
def player_split(spark, sf):
    """Players to splits by hash."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).withColumn("split", S.fixed_partition(F.col("o_custkey"), "split-v1:"))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT a, b FROM (SELECT 'c' || o_custkey AS a, 'o' || o_orderkey AS b FROM orders UNION ALL SELECT 's' || l_suppkey, 'o' || l_orderkey FROM lineitem)), ends AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), nodes AS (SELECT DISTINCT a AS node FROM ends),
c(node, root) USING KEY (node) AS (SELECT node, node FROM nodes UNION (SELECT x.node, min(y.root) FROM recurring.c x JOIN ends ON ends.a = x.node JOIN c y ON y.node = ends.b WHERE y.root < x.root GROUP BY x.node)),
g AS (SELECT root, count(*) AS n FROM c GROUP BY root), h AS (SELECT *, coalesce(sum(n) OVER (ORDER BY sha256('split-1:' || root), root ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM g)
SELECT root, n, CASE WHEN before < total * 0.1 THEN 'test' WHEN before < total * 0.2 THEN 'validation' ELSE 'train' END AS split FROM h""")
def components_split(spark, sf):
    """Orders that share a customer or a supplier are one component; whole components go to splits. Each row of
    lineitem counts: where suppliers tie all orders together, as in the given tables, one split gets them all."""
    o, x = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    # a node is a number: a key and, in its last two bits, its kind, suppliers lowest, as they tie the most together
    node = lambda key, kind: F.col(key).cast("long") * 4 + kind
    edges = o.select(node("o_custkey", 1).alias("a"), node("o_orderkey", 2).alias("b"))
    edges = edges.unionByName(x.select(node("l_suppkey", 0).alias("a"), node("l_orderkey", 2).alias("b")))
    nodes = splits.components(edges, "a", "b").select("root", F.col("node").bitwiseAND(F.lit(3)).alias("kind"), F.shiftright("node", 2).alias("key"))
    # the least name is that of the least number of its kind, sign and length
    names = nodes.groupBy("root", "kind", (F.col("key") < 0).alias("below"), F.length(F.col("key").cast("string")).alias("digits")).agg(F.min(F.abs("key")).alias("key"), F.count(F.lit(1)).alias("n"))
    name = F.concat(F.element_at(F.array(F.lit("s"), F.lit("c"), F.lit("o")), (F.col("kind") + 1).cast("int")), F.when(F.col("below"), "-").otherwise(""), F.col("key").cast("string"))
    sizes = names.groupBy(F.col("root").alias("_root")).agg(F.min(name).alias("root"), F.sum("n").alias("n")).drop("_root")
    return splits.weighted_fill(sizes, "root", "n", [("test", 0.1), ("validation", 0.1), ("train", 0.8)], "split-1")


@query("""SELECT * EXCLUDE (h) FROM (SELECT o_orderkey, o_orderstatus, sha256('q1:' || o_orderkey::VARCHAR) AS h, row_number() OVER (PARTITION BY o_orderstatus ORDER BY sha256('q1:' || o_orderkey::VARCHAR), o_orderkey) AS rank FROM orders) WHERE rank <= 50""")
def quota_sample(spark, sf):
    """Fifty of each stratum in hash order."""
    return sampling.quota_sample(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", 50, "q1").select("o_orderkey", "o_orderstatus", "rank")


@query("""
SELECT o_orderkey, least(3, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) * 4 // count(*) OVER ())::INTEGER AS price_bin FROM orders""")
def stratified_bins(spark, sf):
    """Equal bins by rank."""
    return sampling.rank_bins(table(spark, sf, "orders"), "o_totalprice", "o_orderkey", 4, "price_bin").select("o_orderkey", "price_bin")


@query("SELECT first AS p_partkey, count(*) AS new_targets FROM (SELECT p_brand, min(p_partkey) AS first FROM part GROUP BY 1) GROUP BY 1")
def greedy_cover(spark, sf):
    """T5: parts that are first to bring a brand."""
    return sampling.cover(table(spark, sf, "part"), "p_brand", "p_partkey")


@query("""
WITH b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), l AS (SELECT o_custkey AS k, min(o_orderkey) AS o FROM orders WHERE o_custkey NOT IN (SELECT k FROM b) GROUP BY 1),
r AS (SELECT k, row_number() OVER (ORDER BY o, k) AS n FROM l)
SELECT k AS o_custkey, 'base' AS part FROM b UNION ALL SELECT k, CASE WHEN n <= greatest(0, 1000 - (SELECT count(*) FROM b)) THEN 'live' ELSE 'overflow' END FROM r""")
def finalize_target(spark, sf):
    """A base filled up to a target; the rest overflows."""
    o = table(spark, sf, "orders")
    return sampling.fill_to(o.filter("o_orderstatus = 'F'"), o, "o_custkey", "o_orderkey", 1000)


@query(f"""
WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 11 <> 0 THEN tick // 86400 END AS day FROM {EV} WHERE value < 50), t AS (SELECT user_id, count(*) AS n, count(day) AS known, max(day) AS top, min(event_id) AS "only" FROM e GROUP BY 1),
h AS (SELECT e.user_id, count(*) AS ties, min(event_id) AS "last" FROM e JOIN t ON e.user_id = t.user_id AND e.day = t.top GROUP BY 1),
j AS (SELECT u.user_id, "only", "last", CASE WHEN n IS NULL THEN 'unavailable' WHEN n = 1 THEN 'unique_eligible' WHEN known < n THEN 'ambiguous_creation_order_unknown' WHEN ties > 1 THEN 'ambiguous_latest_tie' ELSE 'inferred_newest_eligible' END AS status
  FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN t USING (user_id) LEFT JOIN h USING (user_id))
SELECT user_id, status, CASE WHEN status = 'unique_eligible' THEN "only" WHEN status = 'inferred_newest_eligible' THEN "last" END AS chosen FROM j""")
def newest_eligible(spark, sf):
    """The newest eligible event, or why there is no choice."""
    e = events(spark, sf).withColumn("day", F.when(F.col("event_id") % 11 != 0, F.floor(F.col("tick") / 86400)))
    return sampling.newest_eligible(e, "user_id", "day", F.col("value") < 50, "event_id")


@query("SELECT o_orderpriority AS kind, o_orderstatus AS state FROM orders WHERE o_custkey % 2 = 0 EXCEPT ALL SELECT o_orderpriority, o_orderstatus FROM orders WHERE o_custkey % 2 = 1")
def multiset_diff(spark, sf):
    """What one side has more of."""
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("state"), (F.col("o_custkey") % 2).alias("m"))
    return o.filter("m = 0").drop("m").exceptAll(o.filter("m = 1").drop("m"))


@query("SELECT conv_id, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY 1")
def contiguous_markers(spark, sf):
    """Are the turns 0 .. n-1?"""
    n = F.count(F.lit(1))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(((F.min("turn") == 0) & (F.max("turn") == n - 1) & (F.countDistinct("turn") == n)).alias("contiguous"))


@query(r"""SELECT page_id, count(*) AS n, count(DISTINCT v) AS n_different FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?:href|src)="([^"]*)"', 1)) AS v FROM pages) GROUP BY 1""")
def html_attributes(spark, sf):
    """S3: attribute values of saved pages."""
    v = table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('(?:href|src)="([^"]*)"'), 1)).alias("v"))
    return v.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("v").alias("n_different"))


@query(r"""SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS host, 'url:' || lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)) || regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS grp FROM pages""")
def url_parts(spark, sf):
    """Host and source group of URLs."""
    p = table(spark, sf, "pages")
    return p.select("page_id", F.lower(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]*)", 1)).alias("host"), S.source_group(F.col("url")).alias("grp"))


@query("""SELECT event_id, j.key AS path, json_extract_string(j.value, '$') AS value FROM events, json_each(props::JSON) j""")
def json_flatten(spark, sf):
    """Nested documents as (path, value) rows."""
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return e.select("event_id", F.explode("m").alias("path", "value"))


@query("SELECT conv_id % 16 AS batch, max(n) AS longest, count(*) AS n, round(1 - sum(n) / (max(n) * count(*)), 9) AS padding FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) GROUP BY 1")
def padding_fraction(spark, sf):
    """Longest row and padding of each batch."""
    n = table(spark, sf, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("len"))
    out = aggs.padding(n.withColumn("batch", F.col("conv_id") % 16), "batch", "len")
    return out.withColumn("padding", F.round("padding", 9))


@query("""
WITH p AS (SELECT quality AS y, (doc_id * 2654435761 % 1000) / 1000.0::DOUBLE AS p, 1 + doc_id % 3 AS w FROM labels WHERE quality IS NOT NULL)
SELECT round(sum(w * (p - y) * (p - y)) / sum(w), 9) AS brier, round(sum(w * CASE WHEN (p >= 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) / sum(w), 9) AS top1, sum(w)::BIGINT AS weight FROM p""")
def metrics_eval(spark, sf):
    """Weighted metrics of predictions; null when there are none."""
    p = table(spark, sf, "labels").filter("quality is not null").select(F.col("quality").alias("y"), (F.col("doc_id") * 2654435761 % 1000 / 1000.0).alias("p"), (1 + F.col("doc_id") % 3).alias("w"))
    right = F.when((F.col("p") >= 0.5) == (F.col("y") == 1), 1.0).otherwise(0.0)
    return p.agg(F.round(F.sum(F.col("w") * (F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))) / F.sum("w"), 9).alias("brier"), F.round(F.sum(F.col("w") * right) / F.sum("w"), 9).alias("top1"), F.sum("w").cast("long").alias("weight"))


@query(f"""
SELECT o_orderkey, round({HASH.format("'s:order:' || o_orderkey::VARCHAR")}::DOUBLE / 18446744073709551616.0, 9) AS bucket, upper(trim(o_orderpriority)) AS tag FROM orders""")
def hash_buckets(spark, sf):
    """H1, H6: place in [0, 1) and a clean tag."""
    return table(spark, sf, "orders").select("o_orderkey", F.round(S.hash_bucket("s", "order", F.col("o_orderkey")), 9).alias("bucket"), S.clean_tag(F.col("o_orderpriority")).alias("tag"))


@query("""
SELECT event_type, count(*) AS rows_seen, count(value) AS known, min(floor(epoch(ts))::BIGINT) AS first_tick, max(floor(epoch(ts))::BIGINT) AS last_tick, count(DISTINCT user_id) AS keys FROM events GROUP BY 1""")
def stream_facts(spark, sf):
    """Extent, presence and identities of each kind."""
    return events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows_seen"), F.count("value").alias("known"), F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"), F.countDistinct("user_id").alias("keys"))
