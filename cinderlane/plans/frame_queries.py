"""Queries of the frame operators over lines as objects of suppliers' frames, with SQL that joins frame to frame."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cinderlane.operators import frames
from cinderlane.plans.queries import ORACLE_SQL, query
from cinderlane.sources.tables import table
from cinderlane.streaming import assembler, incremental

#: A supplier is a stream, a line number a tick, a line an object; parts of one key merge in a frame. Some suppliers' ticks have a gap.
OBJECTS = """(SELECT l_suppkey AS stream, l_linenumber::BIGINT + CASE WHEN l_suppkey % 9 = 4 AND l_linenumber > 4 THEN 1 ELSE 0 END AS tick, (l_partkey % 3 + 3) * 1000000 + l_partkey % 60 AS "key", min(l_partkey % 2)::INT AS side, min((l_orderkey % 4 + 3) * 1000000 + l_orderkey % 60) AS target,
  CASE WHEN min(l_orderkey) % 5 > 0 THEN list(l_returnflag ORDER BY l_returnflag) END AS effects, min(l_quantity)::BIGINT AS hp, min(l_linestatus) AS mode FROM lineitem GROUP BY 1, 2, 3)"""
FRAMES = "f AS (SELECT *, min(CASE WHEN tick > first_tick AND step > 1 THEN tick END) OVER (PARTITION BY stream) AS gap FROM (SELECT stream, tick, min(tick) OVER (PARTITION BY stream) AS first_tick, tick - lag(tick) OVER (PARTITION BY stream ORDER BY tick) AS step FROM (SELECT DISTINCT stream, tick FROM o))), g AS (SELECT stream, tick, first_tick FROM f WHERE gap IS NULL OR tick < gap)"


def objects(spark, sf, dealt=False):
    """Objects of frames; dealt: lines are dealt by stream first, so that their sums need no other shuffle."""
    line, k = table(spark, sf, "lineitem"), F.col("l_partkey")
    tick = F.col("l_linenumber").cast("long") + F.when((F.col("l_suppkey") % 9 == 4) & (F.col("l_linenumber") > 4), 1).otherwise(0)
    if dealt:
        line = line.select("l_suppkey", "l_linenumber", "l_partkey", "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus").repartition("l_suppkey")
    effects = F.when(F.min("l_orderkey") % 5 > 0, F.array_sort(F.collect_list("l_returnflag")))
    return line.groupBy(F.col("l_suppkey").alias("stream"), tick.alias("tick"), ((k % 3 + 3) * 1_000_000 + k % 60).alias("key")).agg(
        F.min(k % 2).cast("int").alias("side"), F.min((F.col("l_orderkey") % 4 + 3) * 1_000_000 + F.col("l_orderkey") % 60).alias("target"), effects.alias("effects"), F.min("l_quantity").cast("long").alias("hp"), F.min("l_linestatus").alias("mode"))


@query(f"""
WITH o AS (SELECT * FROM {OBJECTS}), {FRAMES}, t AS (SELECT o.* EXCLUDE (target), q."key" AS target FROM o JOIN g USING (stream, tick) LEFT JOIN o q ON q.stream = o.stream AND q.tick = o.tick AND q."key" = o.target),
p AS (SELECT g.stream, g.tick FROM g WHERE g.tick > g.first_tick),
e AS (SELECT b.stream, b.tick, b."key", b.side, unnest(list_distinct(list_concat(a.effects, b.effects))) AS name, a.effects AS x, b.effects AS y FROM t b JOIN t a ON a.stream = b.stream AND a.tick = b.tick - 1 AND a."key" = b."key" WHERE a.effects IS NOT NULL AND b.effects IS NOT NULL),
n AS (SELECT *, len(list_filter(x, lambda v: v = name)) AS c, len(list_filter(y, lambda v: v = name)) AS d FROM e)
SELECT b.stream, b.tick, CASE WHEN b."key" < 4000000 THEN 'area_create' WHEN b."key" < 5000000 THEN 'projectile_spawn' ELSE 'spawn' END AS kind, b."key", b.side, NULL::VARCHAR AS other, NULL AS name FROM t b JOIN p USING (stream, tick) LEFT JOIN t a ON a.stream = b.stream AND a.tick = b.tick - 1 AND a."key" = b."key" WHERE a."key" IS NULL
UNION ALL SELECT p.stream, p.tick, 'despawn', a."key", a.side, NULL, NULL FROM p JOIN t a ON a.stream = p.stream AND a.tick = p.tick - 1 LEFT JOIN t b ON b.stream = p.stream AND b.tick = p.tick AND b."key" = a."key" WHERE b."key" IS NULL
UNION ALL SELECT b.stream, b.tick, CASE WHEN b.target IS NULL THEN 'target_lose' WHEN a.target IS NULL THEN 'target_acquire' ELSE 'target_change' END, b."key", b.side, b.target::VARCHAR, NULL FROM t b JOIN t a ON a.stream = b.stream AND a.tick = b.tick - 1 AND a."key" = b."key" WHERE a.target IS DISTINCT FROM b.target
UNION ALL SELECT stream, tick, CASE WHEN c = 0 THEN 'effect_apply' WHEN d = 0 THEN 'effect_remove' ELSE 'effect_stack' END, "key", side, NULL, name FROM n WHERE c <> d""")
def object_events(spark, sf):
    """Appearances, removals, targets and effects between consecutive frames."""
    o = objects(spark, sf)
    return frames.object_events(o.select("stream", "tick"), o).withColumn("other", F.col("other").cast("string"))


@query(f"""
WITH o AS (SELECT * FROM {OBJECTS}), {FRAMES}, t AS (SELECT o.*, g.first_tick FROM o JOIN g USING (stream, tick)),
j AS (SELECT b.*, a."key" IS NULL AS fresh, CASE WHEN a.hp IS DISTINCT FROM b.hp THEN 1 ELSE 0 END + CASE WHEN a.mode IS DISTINCT FROM b.mode THEN 2 ELSE 0 END AS d FROM t b LEFT JOIN t a ON a.stream = b.stream AND a.tick = b.tick - 1 AND a."key" = b."key"),
k AS (SELECT *, CASE WHEN (tick - first_tick) % 3 = 0 THEN 'anchor' WHEN fresh THEN 'spawned' WHEN d > 0 THEN 'updated' END AS change, CASE WHEN (tick - first_tick) % 3 = 0 OR fresh THEN 3 ELSE d END AS mask FROM j)
SELECT stream, tick, "key", change, mask, CASE WHEN mask & 1 > 0 THEN hp END AS hp, CASE WHEN mask & 2 > 0 THEN mode END AS mode FROM k WHERE change IS NOT NULL
UNION ALL SELECT p.stream, p.tick, a."key", 'removed', 0, NULL, NULL FROM g p JOIN t a ON a.stream = p.stream AND a.tick = p.tick - 1 LEFT JOIN t b ON b.stream = p.stream AND b.tick = p.tick AND b."key" = a."key" WHERE b."key" IS NULL AND (p.tick - p.first_tick) % 3 > 0""")
def entity_deltas(spark, sf):
    """Anchors in every third frame and deltas with removals between them."""
    o = objects(spark, sf)
    return frames.entity_deltas(o.select("stream", "tick"), o, ["hp", "mode"], 3)


@query(f"""WITH o AS (SELECT * FROM {OBJECTS}), {FRAMES} SELECT o.stream, o.tick, o."key", o.hp, o.mode FROM o JOIN g USING (stream, tick)""")
def entity_rebuild(spark, sf):
    """Every object of every frame back from anchors and deltas, removals included."""
    o = objects(spark, sf)
    return frames.entity_states(frames.entity_deltas(o.select("stream", "tick"), o, ["hp", "mode"], 3), frames.bounds(o), ["hp", "mode"], 3)


@query(f"""
WITH o AS (SELECT * FROM {OBJECTS}), {FRAMES} SELECT stream, tick, kind, "key"::VARCHAR AS "key", side::VARCHAR AS side, other, name FROM ({ORACLE_SQL['object_events']})
UNION ALL SELECT g.stream, g.tick, 'frame', (count(o."key") FILTER (o.side = s.side))::VARCHAR, s.side::VARCHAR, (count(o."key") FILTER (o.side <> s.side))::VARCHAR, NULL FROM g JOIN o USING (stream, tick), (SELECT unnest([0, 1])::INT AS side) s WHERE g.tick % 5 = 0 GROUP BY g.stream, g.tick, s.side
UNION ALL SELECT DISTINCT stream, gap, 'broken', NULL, NULL, NULL, NULL FROM f WHERE gap IS NOT NULL""")
def stream_assembly(spark, sf):
    """The same changes from a stream of frames with keyed state, with each fifth frame of both sides."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        raise ValueError("spark.checkpoint.dir has to name a shared folder")
    out = f"{where.rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = objects(spark, sf, dealt=True).groupBy("stream", "tick").agg(F.collect_list(F.struct("key", "side", "target", "effects")).alias("objects"))
    none = F.array()
    rows = rows.select("stream", F.col("tick").alias("line"), "tick", "objects", none.cast("array<struct<key:bigint,side:int,parent:bigint>>").alias("births"), none.cast("array<struct<sequence:bigint,source:bigint,amount:double>>").alias("damage"))
    rows.write.parquet(f"{out}/in")
    with assembler.rocksdb(spark):
        incremental.run_available(assembler.assemble(spark.readStream.schema(rows.schema).parquet(f"{out}/in")), f"{out}/rows", f"{out}/state")
    found = spark.read.schema(assembler.EVENT).parquet(f"{out}/rows")
    return found.select("stream", "tick", "kind", *[F.col(c).cast("string").alias(c) for c in ("key", "side", "other")], F.when(F.col("kind") != "frame", F.col("name")).alias("name"))
