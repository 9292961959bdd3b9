"""Queries of the board operators, with SQL that expands boards into cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlane.operators import arena
from cinderlane.plans.queries import query
from cinderlane.sources.tables import table

#: Lines as towers of their order's moment, parts as masks, lines again as labels: one reading for Spark, one for SQL.
BOARD_SQL = """t AS (SELECT l_orderkey AS k, l_linenumber % 2 AS side, CASE WHEN l_linenumber <= 4 THEN 1 ELSE 0 END AS role, (l_partkey * 37) % 18300 - 100 AS x, (l_suppkey * 53 * l_linenumber) % 32500 - 200 AS y, l_quantity::BIGINT - 15 AS hp FROM lineitem),
f AS (SELECT *, CASE WHEN role = 0 THEN 2000 ELSE 1500 END AS h FROM t WHERE hp > 0),
cover AS (SELECT k, floor((x - h) / 1000)::INT AS c0, floor((x + h + 999) / 1000)::INT AS c1, unnest(range(greatest(0, floor((y - h) / 1000)::INT), least(32, floor((y + h + 999) / 1000)::INT))) AS r FROM f),
shut AS (SELECT DISTINCT k, r * 18 + unnest(range(greatest(0, c0), least(18, c1))) AS i FROM cover), bare AS (SELECT k, list(i) AS shut FROM shut GROUP BY k),
alive AS (SELECT k, side, (x >= 9000)::INT AS lane, count(*) AS n, max(struct_pack(x := x, y := y, hp := hp)) AS tower FROM f WHERE role = 1 GROUP BY ALL),
cells AS (SELECT a, i, (i * a % 7 < 6)::INT AS o, (i * a % 7 < 6 AND (i // 18 * 18 + 17 - i % 18) * a % 7 < 6 AND ((31 - i // 18) * 18 + i % 18) * a % 7 < 6 AND (575 - i) * a % 7 < 6)::INT AS s FROM (SELECT unnest(range(576)) AS i), (SELECT unnest(range(3, 26)) AS a)),
masks AS (SELECT a, list(o ORDER BY i) AS own, list(s ORDER BY i) AS sym FROM cells GROUP BY a),
empty AS (SELECT k, list((NOT list_contains(shut, i))::INT ORDER BY i) AS bare FROM (SELECT k, shut, unnest(range(576)) AS i FROM bare) GROUP BY k),
slot AS (SELECT row_number() OVER () AS id, l_orderkey AS k, l_linenumber AS n, l_linenumber % 2 AS side, l_partkey AS m, l_partkey % 23 + 3 AS a, l_suppkey, CASE l_suppkey % 6 WHEN 0 THEN 28000006 WHEN 1 THEN 28000010 WHEN 2 THEN 27000013 ELSE 26000100 END AS card,
  CASE l_partkey % 5 WHEN 0 THEN 28000000 + l_partkey % 100 WHEN 1 THEN 26000032 WHEN 2 THEN -(l_partkey % 3) ELSE 26001000 + l_partkey % 100 END AS data, l_partkey * 91 % 19000 - 500 AS x, l_suppkey * 217 % 33000 - 500 AS y FROM lineitem),
known AS (SELECT *, (card // 1000000 = 28 AND card <> 28000006) OR data // 1000000 = 28 OR card IN (26000032, 27000013) OR data IN (26000032, 27000013) AS anywhere FROM slot),
z AS (SELECT w.*, masks.own, masks.sym, coalesce(empty.bare, list_transform(range(576), lambda i: 1)) AS bare, l.n IS NULL AS left_open, r.n IS NULL AS right_open FROM known w JOIN masks USING (a) LEFT JOIN empty ON empty.k = w.k
  LEFT JOIN alive l ON l.k = w.k AND l.side = 1 - w.side AND l.lane = 0 LEFT JOIN alive r ON r.k = w.k AND r.side = 1 - w.side AND r.lane = 1),
board AS (SELECT *, CASE WHEN data > 0 THEN CASE WHEN anywhere THEN own ELSE list_transform(list_zip(sym, bare), lambda e, q: CASE WHEN e[1] = 1 AND e[2] = 1 AND
  (CASE WHEN side = 0 THEN q <= 270 OR q BETWEEN 289 AND 306 ELSE q > 306 OR q BETWEEN 271 AND 288 END
   OR ((q - 1) // 18 BETWEEN CASE WHEN side = 0 THEN 16 ELSE 11 END AND CASE WHEN side = 0 THEN 20 ELSE 15 END AND CASE WHEN (q - 1) % 18 < 9 THEN left_open ELSE right_open END)) THEN 1 ELSE 0 END) END END AS cells FROM z)"""


def boards(spark, sf):
    """(labels, masks, towers, moments) made of lines, parts and orders; a label's order is its moment."""
    line, n = table(spark, sf, "lineitem"), F.col("l_linenumber")
    part, p = table(spark, sf, "part"), F.col("p_partkey")
    towers = line.select(F.col("l_orderkey").alias("k"), (n % 2).alias("side"), F.when(n <= 4, 1).otherwise(0).alias("role"), (F.col("l_partkey") * 37 % 18300 - 100).alias("x"), (F.col("l_suppkey") * 53 * n % 32500 - 200).alias("y"), (F.col("l_quantity").cast("long") - 15).alias("hp"))
    seven = F.concat(*[F.when(i * (p % 23 + 3) % 7 < 6, "1").otherwise("0") for i in range(7)])  # cell i is as cell i % 7
    cells = F.substring(F.repeat(seven, 83), 1, 576)
    data = F.when(p % 5 == 0, 28_000_000 + p % 100).when(p % 5 == 1, 26_000_032).when(p % 5 == 2, -(p % 3)).otherwise(26_001_000 + p % 100)
    masks = part.select(p.alias("mask"), data.alias("data_id"), cells.alias("cells"), (p % 11 * 1000).alias("cost_raw"))
    s = F.col("l_suppkey")
    card = F.when(s % 6 == 0, 28_000_006).when(s % 6 == 1, 28_000_010).when(s % 6 == 2, 27_000_013).otherwise(26_000_100)
    labels = line.select(F.col("l_orderkey").alias("k"), n.alias("n"), (F.col("l_orderkey") % 200).alias("tick"), (n % 2).alias("side"), (n % 8).alias("deck_index"), (F.col("l_partkey") * 91 % 19000 - 500).alias("x"), (s * 217 % 33000 - 500).alias("y"), card.alias("card_id"), F.col("l_partkey").alias("mask"))
    k = F.col("o_orderkey")
    hand = lambda side: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: (k + side + j) % 8)
    moments = table(spark, sf, "orders").filter(k % 17 > 0).select(k.alias("k"), (k % 200).alias("tick"), (k % 13 > 0).alias("commands_allowed"), hand(0).alias("hand_0"), hand(1).alias("hand_1"), (k % 9 * 1000).alias("elixir_0"), (k % 7 * 2000).alias("elixir_1"))
    return labels, masks, towers, moments


@query(f"""
WITH {BOARD_SQL} SELECT k AS l_orderkey, n AS l_linenumber, list_sum(cells)::BIGINT AS open_cells, md5(array_to_string(cells, '')) AS board FROM board""")
def derived_masks(spark, sf):
    """Where each slot's card may be placed at its moment."""
    labels, masks, towers, _ = boards(spark, sf)
    d = arena.derived_masks(labels, masks, towers, ["k"])
    counted = sum((F.bit_count(w) for w in arena.mask_words()[1:]), F.bit_count(F.col("m0")))
    return d.select(F.col("k").alias("l_orderkey"), F.col("n").alias("l_linenumber"), counted.cast("long").alias("open_cells"), F.md5(arena.unpack(arena.mask_words())).alias("board"))


@query(f"""
WITH {BOARD_SQL}, j AS (SELECT *, x >= 0 AND x < 18000 AND y >= 0 AND y < 32000 AS inside, x // 1000 AS c, y // 1000 AS r, (x >= 9000)::INT AS lane, 1 + 18 * (y // 1000) + x // 1000 AS q FROM board),
v AS (SELECT j.*, data > 0 AND j.k % 17 > 0 AS known, list_filter(list_value(
  CASE WHEN NOT list_contains(list_transform(range(4), lambda e: (j.k + j.side + e) % 8), j.n % 8) THEN 'deck_index_not_in_hand' END, CASE WHEN j.k % 200 < 100 THEN 'deployment_gate_not_open' END,
  CASE WHEN j.k % 13 = 0 THEN 'native_commands_not_allowed' END, CASE WHEN CASE WHEN j.side = 0 THEN j.k % 9 * 1000 ELSE j.k % 7 * 2000 END < j.m % 11 * 1000 THEN 'insufficient_native_elixir' END,
  CASE WHEN NOT inside OR cells[q] = 0 THEN 'position_not_in_derived_native_mask' END), lambda w: w IS NOT NULL) AS issues,
  NOT anywhere AND inside AND sym[q] = 1 AND bare[q] = 1 AND cells[q] = 0 AND g.n = 1 AND CASE WHEN j.side = 0 THEN r BETWEEN 17 AND 20 ELSE r BETWEEN 11 AND 14 END AS closed, g.tower
  FROM j LEFT JOIN alive g ON g.k = j.k AND g.side = 1 - j.side AND g.lane = j.lane)
SELECT k AS l_orderkey, n AS l_linenumber, known AND len(issues) = 0 AS legal, CASE WHEN known THEN array_to_string(issues, ',') ELSE 'no_reference' END AS issues, CASE WHEN known AND closed THEN concat_ws(':', tower.x, tower.y, tower.hp, lane, r, c) END AS locked FROM v""")
def deployment_labels(spark, sf):
    """J13 on J14: each label against its moment and its derived board, with the reasons, and pockets that a tower locks."""
    out = arena.check_labels(*boards(spark, sf), ["k"])
    locked = F.when(F.col("locked").isNotNull(), F.concat_ws(":", *[F.col(f"locked.{c}").cast("string") for c in ("tower_x", "tower_y", "tower_hp", "lane", "row", "column")]))
    return out.select(F.col("k").alias("l_orderkey"), F.col("n").alias("l_linenumber"), "legal", F.concat_ws(",", "issues").alias("issues"), locked.alias("locked"))


@query("""
WITH e AS (SELECT l_orderkey AS k, l_linenumber % 2 AS rel, list_value('troop', 'building', 'king', 'projectile', 'area', 'princess', 'unknown')[1 + l_suppkey % 7] AS kind, l_partkey * 37 % 18600 - 300 AS x, l_suppkey * 53 % 32700 - 300 AS y,
    l_quantity::BIGINT - 5 AS hp, CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 2 END AS flying, CASE WHEN l_partkey % 4 = 0 THEN l_partkey % 900 END AS shield, CASE WHEN l_suppkey % 5 = 0 THEN l_partkey % 700 END AS threat,
    CASE WHEN l_partkey % 5 > 0 THEN (l_partkey % 6) * 0.5 END AS hx, CASE WHEN l_partkey % 5 > 0 THEN (l_suppkey % 5) * 0.5 END AS hy FROM lineitem),
b AS (SELECT *, kind IN ('building', 'king', 'princess') AS stands, coalesce(hx, 0) + coalesce(hy, 0) > 0 AS wide, least(31, y // 1000) AS r, least(17, x // 1000) AS c FROM e WHERE x BETWEEN 0 AND 18000 AND y BETWEEN 0 AND 32000),
cells AS (SELECT i // 18 AS r, i % 18 AS c FROM (SELECT unnest(range(576)) AS i)),
p AS (
  SELECT k, rel * 7 + 2 AS plane, cells.r, cells.c, 1.0 AS v FROM b JOIN cells ON cells.c + 0.5 >= x / 1000 - coalesce(hx, 0) AND cells.c + 0.5 < x / 1000 + coalesce(hx, 0) AND cells.r + 0.5 >= y / 1000 - coalesce(hy, 0) AND cells.r + 0.5 < y / 1000 + coalesce(hy, 0) WHERE stands AND wide
  UNION ALL SELECT k, rel * 7 + 2, r, c, 1.0 FROM b WHERE stands AND NOT wide UNION ALL SELECT k, rel * 7 + 3, r, c, 1.0 FROM b WHERE kind = 'projectile'
  UNION ALL SELECT k, rel * 7 + flying, r, c, 1.0 FROM b WHERE NOT stands AND kind <> 'projectile' AND flying IS NOT NULL UNION ALL SELECT k, rel * 7 + 4, r, c, hp / 10000 FROM b WHERE hp >= 0
  UNION ALL SELECT k, rel * 7 + 5, r, c, shield / 10000 FROM b WHERE shield IS NOT NULL UNION ALL SELECT k, rel * 7 + 6, r, c, threat / 5000 FROM b WHERE threat IS NOT NULL UNION ALL SELECT k, 18 + rel, r, c, 1.0 FROM b WHERE kind = 'area')
SELECT k AS l_orderkey, plane::INT AS plane, r::INT AS "row", c::INT AS "column", round(sum(v::DOUBLE), 6) AS value FROM p GROUP BY ALL HAVING sum(v) > 0""")
def semantic_planes(spark, sf):
    """Entities of each order, made of its lines, as planes of cells."""
    line, part, supp = table(spark, sf, "lineitem"), F.col("l_partkey"), F.col("l_suppkey")
    kinds = F.array(*[F.lit(k) for k in ("troop", "building", "king", "projectile", "area", "princess", "unknown")])
    e = line.select("l_orderkey", (F.col("l_linenumber") % 2).alias("relation"), F.get(kinds, (supp % 7).cast("int")).alias("kind"), (part * 37 % 18600 - 300).alias("x"), (supp * 53 % 32700 - 300).alias("y"), (F.col("l_quantity").cast("long") - 5).alias("hp"),
                    F.when(part % 3 > 0, part % 2).alias("flying"), F.when(part % 4 == 0, part % 900).alias("shield"), F.when(supp % 5 == 0, part % 700).alias("threat"), F.when(part % 5 > 0, part % 6 * 0.5).alias("half_x"), F.when(part % 5 > 0, supp % 5 * 0.5).alias("half_y"))
    return arena.semantic_planes(e, ["l_orderkey"]).withColumn("value", F.round("value", 6))
