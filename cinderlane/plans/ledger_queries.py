"""Queries of the ledger operators over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlane.operators import ledger
from cinderlane.plans.queries import EV, events, query
from cinderlane.sources.tables import table


@query("""
SELECT o_orderkey, queue FROM (SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice > 200000 THEN 'review' END, CASE WHEN o_orderstatus = 'F' THEN 'archive' END,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END], lambda x: x IS NOT NULL)) AS queue FROM orders)""")
def multi_queue(spark, sf):
    """A row may go to several queues."""
    rules = {"review": F.col("o_totalprice") > 200000, "archive": F.col("o_orderstatus") == "F", "urgent": F.col("o_orderpriority").startswith("1")}
    return ledger.to_queues(table(spark, sf, "orders"), rules).select("o_orderkey", "queue")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def resume_work(spark, sf):
    """Keys without a finished row."""
    done = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return ledger.unfinished(table(spark, sf, "customer").select("c_custkey"), done, ["c_custkey"], F.col("o_orderstatus") == "F")


@query(f"SELECT user_id, tick // 3600 AS hour, min(event_id) AS event_id, count(*) - 1 AS overlapping FROM {EV} GROUP BY 1, 2")
def merge_batches(spark, sf):
    """Of overlapping batches the earliest row of a key stays."""
    e = events(spark, sf).withColumn("hour", F.floor(F.col("tick") / 3600))
    n = e.groupBy("user_id", "hour").agg((F.count(F.lit(1)) - 1).alias("overlapping"))
    return ledger.merged_batches(e, ["user_id", "hour"], "event_id").join(n, ["user_id", "hour"]).select("user_id", "hour", "event_id", "overlapping")


@query("""
WITH a AS (SELECT conv_id, turn + 1 AS turn, count(*) AS n, min(role) AS role FROM conversations GROUP BY 1, 2)
SELECT c.conv_id, c.turn, coalesce(a.n, 0) AS n_events, CASE WHEN a.n = 1 THEN a.role END AS event FROM conversations c LEFT JOIN a ON c.conv_id = a.conv_id AND c.turn = a.turn""")
def attach_events(spark, sf):
    """The event one turn before each turn, collisions marked."""
    c = table(spark, sf, "conversations")
    return ledger.attach(c.select("conv_id", "turn"), c.select("conv_id", "turn", "role"), ["conv_id"], "turn", 1, "role")


@query("""
WITH k AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n, min(l_linenumber) AS chosen FROM lineitem WHERE l_quantity > 25 GROUP BY 1)
SELECT o_orderkey, CASE WHEN n IS NULL THEN 'no_legal_matching_entity' WHEN n = 1 THEN 'unique' ELSE 'branch_required' END AS status, CASE WHEN n = 1 THEN chosen END AS chosen FROM orders LEFT JOIN k ON o_orderkey = l_orderkey""")
def candidate_status(spark, sf):
    """Unique, several or no candidates of each row."""
    known = table(spark, sf, "lineitem").filter("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return ledger.candidates(table(spark, sf, "orders").select("o_orderkey"), known, ["o_orderkey"], "l_linenumber", allowed=True)


@query("""
SELECT a.k AS nationkey, a.n AS n_part, coalesce(b.n, 0) AS n_whole FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) a
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) b ON a.k = b.k WHERE a.n > coalesce(b.n, 0)""")
def success_within_source(spark, sf):
    """Tokens counted more often in the part than in the whole."""
    part = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return ledger.exceeding(part, table(spark, sf, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nationkey")), "nationkey")


@query("""
SELECT *, CASE WHEN successes < 20 THEN 'too_few' WHEN successes < attempts * 0.5::DOUBLE THEN 'low_rate' ELSE 'pass' END AS verdict
FROM (SELECT p_brand, count(*) AS attempts, count(*) FILTER (WHERE p_size > 25) AS successes FROM part GROUP BY 1)""")
def coverage_gate(spark, sf):
    """Counts and rates of each stratum against thresholds."""
    return ledger.coverage_gate(table(spark, sf, "part"), "p_brand", F.col("p_size") > 25, 20, 0.5)


@query("""
WITH s AS (SELECT o_custkey, o_orderkey, row_number() OVER w AS place, first_value(o_orderstatus <> 'P') OVER w AS begins FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, o_orderkey, place FROM s WHERE begins""")
def lane_order(spark, sf):
    """Shards of each lane in order, lanes that begin in the middle left out."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderstatus") != "P").alias("starts"))
    return ledger.lane_order(o, ["o_custkey"], "o_orderkey", "starts").select("o_custkey", "o_orderkey", F.col("place").cast("long").alias("place"))


@query("""
WITH n AS (SELECT n_regionkey AS r, count(*) AS c, min(n_nationkey) AS target FROM nation WHERE n_nationkey < 7 GROUP BY 1 HAVING count(*) = 1)
SELECT s_suppkey, target FROM supplier JOIN n ON s_nationkey % 5 = r""")
def unambiguous_references(spark, sf):
    """References that name exactly one node."""
    a = table(spark, sf, "supplier").select("s_suppkey", (F.col("s_nationkey") % 5).alias("named"))
    return ledger.references(a, table(spark, sf, "nation").filter("n_nationkey < 7"), "named", "n_regionkey", "n_nationkey").select("s_suppkey", "target")


@query("SELECT c_custkey, sha256(c_custkey::VARCHAR || '|' || coalesce(c_name, '\\N') || '|' || coalesce(c_mktsegment, '\\N')) AS receipt FROM customer")
def row_receipts(spark, sf):
    """A hash of each row that can be recomputed."""
    return ledger.receipt(table(spark, sf, "customer"), ["c_custkey"], ["c_name", "c_mktsegment"]).select("c_custkey", "receipt")
