"""Queries of metrics, projections, components and published content, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlane.operators import metrics, sampling, splits
from cinderlane.plans.queries import query
from cinderlane.sources import tables
from cinderlane.sources.tables import table

METRIC_NAMES = ["loss_timing", "timing_brier", "rate_mean", "card_top1", "card_top3", "position_mean_cell_error", "position_within_1_cell"]


@query("""
WITH p AS (SELECT l_orderkey % 16 AS batch, (l_partkey % 100) / 50.0::DOUBLE AS rate, greatest(l_quantity::BIGINT - 3, 1) * 0.05::DOUBLE AS seconds, l_returnflag = 'R' AS happened, l_suppkey % 7 > 0 AS known, (l_linenumber % 3)::DOUBLE AS weight,
    list_transform(range(4), lambda j: (l_partkey * (j + 3) % 17)::DOUBLE) AS scores, CASE WHEN l_suppkey % 6 < 5 THEN l_suppkey % 6 END AS card, l_partkey % 576 AS cell, CASE WHEN l_orderkey % 16 <> 3 AND l_suppkey % 4 > 0 THEN l_suppkey * 7 % 576 END AS target FROM lineitem),
q AS (SELECT *, CASE WHEN card < 4 THEN len(list_filter(list_zip(scores, range(4)), lambda s: s[1] > scores[card + 1] OR (s[1] = scores[card + 1] AND s[2] < card))) END AS place, sqrt((cell // 18 - target // 18) ** 2 + (cell % 18 - target % 18) ** 2) AS off FROM p),
m AS (
  SELECT batch, 'loss_timing' AS metric, rate * seconds - CASE WHEN happened THEN ln(greatest(rate, 1.1754943508222875e-38)) ELSE 0 END AS v, weight AS w FROM q WHERE known
  UNION ALL SELECT batch, 'timing_brier', (1 - exp(-rate * seconds) - happened::INT) ** 2, 1 FROM q WHERE known UNION ALL SELECT batch, 'rate_mean', rate, 1 FROM q WHERE known
  UNION ALL SELECT batch, 'card_top1', (place = 0)::INT, 1 FROM q WHERE place IS NOT NULL UNION ALL SELECT batch, 'card_top3', (place < 3)::INT, 1 FROM q WHERE place IS NOT NULL
  UNION ALL SELECT batch, 'position_mean_cell_error', off, 1 FROM q WHERE off IS NOT NULL UNION ALL SELECT batch, 'position_within_1_cell', (off <= 1)::INT, 1 FROM q WHERE off IS NOT NULL),
a AS (SELECT batch, metric, CASE WHEN sum(w) > 0 THEN round(sum(v * w) / sum(w), 6) END AS value, count(*) AS n FROM m GROUP BY GROUPING SETS ((batch, metric), (metric)))
SELECT coalesce(k.batch::VARCHAR, 'all') AS batch, k.metric, a.value, coalesce(a.n, 0) AS rows FROM (SELECT batch, metric FROM (SELECT DISTINCT batch FROM q UNION ALL SELECT NULL), (SELECT DISTINCT metric FROM m)) k LEFT JOIN a ON a.batch IS NOT DISTINCT FROM k.batch AND a.metric = k.metric""")
def prediction_metrics(spark, sf):
    """Metrics of predictions by batch, and of all batches from the batches' sums; null where no label is known."""
    x, part, supp = table(spark, sf, "lineitem"), F.col("l_partkey"), F.col("l_suppkey")
    batch = (F.col("l_orderkey") % 16).alias("batch")
    p = x.select(
        batch, (part % 100 / 50.0).alias("rate"), (F.col("l_quantity").cast("long") - 3).alias("ticks"), (F.col("l_returnflag") == "R").alias("happened"), (supp % 7 > 0).alias("timing_known"), (F.col("l_linenumber") % 3).alias("weight"),
        F.array(*[(part * (j + 3) % 17).cast("double") for j in range(4)]).alias("card_scores"), F.when(supp % 6 < 5, supp % 6).alias("card"), (part % 576).alias("cell"), F.when((F.col("l_orderkey") % 16 != 3) & (supp % 4 > 0), supp * 7 % 576).alias("target"))
    sums = metrics.metric_sums(p, ["batch"])
    each = metrics.merged_metrics(sums, ["batch"]).withColumn("batch", F.col("batch").cast("string"))
    every = metrics.merged_metrics(sums).withColumn("batch", F.lit("all"))
    return each.unionByName(every).select("batch", "metric", F.round("value", 6).alias("value"), "rows")


@query("""
WITH o AS (SELECT o_orderkey, o_totalprice, o_orderdate FROM orders), u AS (SELECT l_orderkey, count(*) AS rows, sum(l_quantity)::BIGINT AS bytes FROM lineitem GROUP BY 1),
b AS (SELECT o_orderkey, least(3, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) * 4 // count(*) OVER ()) AS i, least(3, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) * 4 // count(*) OVER ()) AS j FROM o),
r AS (SELECT *, row_number() OVER (PARTITION BY i, j ORDER BY sha256('size:' || o_orderkey::VARCHAR), o_orderkey) AS round FROM b), s AS (SELECT coalesce(u.rows, 0) AS rows, coalesce(u.bytes, 0) AS bytes FROM (SELECT o_orderkey FROM r ORDER BY round, i, j LIMIT 400) k LEFT JOIN u ON u.l_orderkey = k.o_orderkey),
t AS (SELECT count(*) AS n, sum(rows) AS r, sum(bytes) AS b, max(CASE WHEN rows > 0 THEN bytes / rows END) AS m, sum(bytes) / sum(rows) AS q FROM s), e AS (SELECT sqrt(sum((bytes - q * rows) ** 2) / greatest(max(n) - 1, 1) / max(n)) / (max(r) / max(n)) AS se FROM s, t), l AS (SELECT count(*) AS total FROM lineitem)
SELECT n AS units, r::BIGINT AS sample_rows, b::BIGINT AS sample_bytes, round(q, 6) AS rate, round(m, 6) AS maximum_rate, round((q - 1.96 * se) * total, 2) AS low, round((q + 1.96 * se) * total, 2) AS high, (ceil(m * total) + 8 * 65536)::BIGINT AS projected, ceil((ceil(m * total) + 8 * 65536) * 1.35)::BIGINT AS projected_safe FROM t, e, l""")
def size_projection(spark, sf):
    """Bytes of all lines projected from 400 orders drawn over a grid of price and date."""
    o, x = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), table(spark, sf, "lineitem")
    units = x.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").cast("long").alias("bytes"))
    drawn = sampling.stratified_draw(o, ["o_totalprice", "o_orderdate"], "o_orderkey", 4, 400, "size").select("o_orderkey").join(units, "o_orderkey", "left").fillna(0)
    out = metrics.ratio_projection(drawn, x.count(), 8)
    return out.select("units", "sample_rows", "sample_bytes", *[F.round(c, d).alias(c) for c, d in (("rate", 6), ("maximum_rate", 6), ("low", 2), ("high", 2))], "projected", "projected_safe")


@query("""
WITH RECURSIVE p AS (SELECT p_partkey AS k, CASE WHEN p_partkey > 1 AND p_partkey % 5 > 0 THEN p_partkey // 2 END AS up FROM part), t(node, root) AS (SELECT k, k FROM p WHERE up IS NULL UNION ALL SELECT p.k, t.root FROM p JOIN t ON p.up = t.node),
g AS (SELECT root, sum(1 + node % 7)::BIGINT AS weight FROM t GROUP BY 1), h AS (SELECT *, sha256('split-2:' || root::VARCHAR) AS h FROM g), c AS (SELECT *, coalesce(sum(weight) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (ORDER BY h DESC) AS left_over, sum(weight) OVER () AS total FROM h),
a AS (SELECT *, before < greatest(1, round_even(total * 0.2, 0)) AND left_over > 2 AS is_test FROM c), f AS (SELECT max(before + weight) AS filled FROM a WHERE is_test)
SELECT t.node, t.root, CASE WHEN is_test THEN 'test' WHEN before < filled + greatest(1, round_even(total * 0.1, 0)) AND left_over > 1 THEN 'validation' ELSE 'train' END AS split FROM t JOIN a ON a.root = t.root, f""")
def forest_split(spark, sf):
    """Parts tied to the part of half their key, as components; whole components fill test, validation and train."""
    k = F.col("p_partkey")
    part = table(spark, sf, "part")
    edges = part.select(k.alias("a"), F.when((k > 1) & (k % 5 > 0), F.floor(k / 2)).otherwise(k).alias("b"))
    found = splits.components(edges, "a", "b")
    weights = found.groupBy("root").agg(F.sum(1 + F.col("node") % 7).alias("weight"))
    filled = splits.holdout_fill(weights, "root", "weight", 0.1, 0.2, "split-2")
    return found.join(filled.select("root", "split"), "root").select("node", "root", "split")


@query("""
WITH f AS (SELECT 'part-' || p_partkey || '.bin' AS path, p_size::BIGINT AS length, sha256(p_name) AS sha FROM part), l AS (SELECT path, length, path || chr(10) || length || chr(10) || sha AS line, substr(sha256(path), 1, 2) AS g FROM f),
p AS (SELECT g, count(*) AS n, sum(length) AS b, sha256(string_agg(line, chr(10) ORDER BY path)) AS d FROM l GROUP BY g)
SELECT sum(n)::BIGINT AS files, sum(b)::BIGINT AS bytes, sha256(string_agg(g || d, chr(10) ORDER BY g)) AS content_sha256 FROM p""")
def published_digest(spark, sf):
    """Files, bytes and one digest of a manifest with an entry for each part."""
    part = table(spark, sf, "part")
    manifest = part.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string"), F.lit(".bin")).alias("path"), F.col("p_size").cast("long").alias("length"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha256"))
    return tables.content_digest(manifest)


@query("""
WITH w AS (SELECT event_id AS pos, event_type || '/' || user_id AS v FROM events), f AS (SELECT CASE WHEN event_id % 50 = 7 AND event_id + 1 <= (SELECT max(event_id) FROM events) THEN event_id + 1 WHEN event_id % 50 = 8 THEN event_id - 1 ELSE event_id END AS pos, CASE WHEN event_id % 31 = 3 THEN 'other' ELSE event_type || '/' || user_id END AS v FROM events WHERE event_id % 41 <> 5
  UNION ALL SELECT -event_id - 1, 'extra' FROM events WHERE event_id % 97 = 0 UNION ALL SELECT event_id, event_type || '/' || user_id FROM events WHERE event_id % 89 = 1),
g AS (SELECT pos, min(sha256(v)) AS d, count(*) AS n FROM f GROUP BY 1)
SELECT coalesce(w.pos, g.pos) AS event_id, CASE WHEN w.pos IS NULL THEN 'extra' WHEN g.n > 1 THEN 'repeated' WHEN g.pos IS NULL THEN CASE WHEN w.v IN (SELECT v FROM f) THEN 'reordered' ELSE 'missing' END WHEN w.v IN (SELECT v FROM f) THEN 'reordered' ELSE 'changed' END AS problem
FROM w FULL JOIN g ON w.pos = g.pos WHERE w.pos IS NULL OR g.pos IS NULL OR g.n > 1 OR sha256(w.v) <> g.d""")
def readback_problems(spark, sf):
    """Events read back with some rows moved, changed, missing, added and repeated."""
    e, i = table(spark, sf, "events"), F.col("event_id")
    value = F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"))
    written = e.select(i.alias("event_id"), value.alias("v"))
    top = e.agg(F.max("event_id")).first()[0]
    moved = F.when((i % 50 == 7) & (i + 1 <= top), i + 1).when(i % 50 == 8, i - 1).otherwise(i)
    found = e.filter(i % 41 != 5).select(moved.alias("event_id"), F.when(i % 31 == 3, "other").otherwise(value).alias("v"))
    found = found.unionByName(e.filter(i % 97 == 0).select((-i - 1).alias("event_id"), F.lit("extra").alias("v"))).unionByName(e.filter(i % 89 == 1).select(i.alias("event_id"), value.alias("v")))
    return tables.read_back(written, found, "event_id")
