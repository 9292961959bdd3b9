"""Queries of the definition operators, with SQL that walks documents and chains step by step."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinderlane.operators import definitions
from cinderlane.plans.queries import query
from cinderlane.sources.tables import table


@query("""
WITH d AS (SELECT event_id, concat('{"user":', user_id, ',"kind":"', event_type, '","props":', props, ',"tags":["', event_id % 7, '","', CASE event_id % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' ELSE 'x y' END, '",[', event_id % 5, '.5,{"deep":{"er":[', event_id, ',"1_0",[]]}}]],"none":null,"blank":"","empty":[],"void":{}', CASE WHEN event_id % 101 > 0 THEN '}' END) AS doc FROM events),
t AS (SELECT event_id, substr(t.fullkey, 3) AS path, t.type AS k, t.atom ->> '$' AS s, t.value AS v FROM (SELECT * FROM d WHERE json_valid(doc)) d, json_tree(d.doc) t),
n AS (SELECT *, CASE WHEN k = 'VARCHAR' THEN try_cast(replace(s, '_', '') AS DOUBLE) WHEN k IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN s::DOUBLE END AS num FROM t)
SELECT event_id, path, CASE WHEN k = 'BOOLEAN' OR lower(s) IN ('true', 'false') THEN 'boolean' WHEN k = 'ARRAY' THEN 'empty_list' WHEN num IS NOT NULL THEN 'number' ELSE 'string' END AS kind,
  CASE WHEN k = 'BOOLEAN' OR lower(s) IN ('true', 'false') THEN (lower(s) = 'true')::INT ELSE num END::DOUBLE AS number, CASE WHEN k = 'ARRAY' THEN '' WHEN k = 'VARCHAR' AND lower(s) NOT IN ('true', 'false') AND num IS NULL THEN s END AS string
FROM n WHERE (k = 'ARRAY' AND v = '[]') OR (k NOT IN ('ARRAY', 'OBJECT', 'NULL') AND s <> '')
UNION ALL SELECT event_id, '', 'invalid', NULL, doc FROM d WHERE NOT json_valid(doc)""")
def json_facts(spark, sf):
    """Documents nested five deep as typed facts, with broken ones among them."""
    e, i = table(spark, sf, "events"), F.col("event_id")
    flag = F.when(i % 3 == 0, "TRUE").when(i % 3 == 1, "false").otherwise("x y")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    s = lambda c: c.cast("string")
    doc = text('{"user":', s(F.col("user_id")), ',"kind":"', F.col("event_type"), '","props":', F.col("props"), ',"tags":["', s(i % 7), '","', flag, '",[', s(i % 5), '.5,{"deep":{"er":[', s(i), ',"1_0",[]]}}]],"none":null,"blank":"","empty":[],"void":{}', F.when(i % 101 > 0, "}").otherwise(""))
    return definitions.flatten(e.select("event_id", doc.alias("doc")), ["event_id"], "doc")


DEFINITIONS = """p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 20 = 19 THEN p_partkey - 1 ELSE p_partkey END AS m, p_partkey // 2 AS q, p_size, p_brand FROM part),
f AS (SELECT *, 'n' || m AS name, list_value('CHARACTER', 'AEO', 'EXT', 'AREA_EFFECT_OBJECT', 'BUILDING')[1 + k % 5] AS family FROM p),
n AS (SELECT f.*, f.family || '.' || f.name AS node, CASE f.k % 4 WHEN 0 THEN o.family || '.' || o.name WHEN 1 THEN o.name WHEN 2 THEN 'AREA_EFFECT_OBJECT.' || o.name ELSE 'missing' || f.k END AS base FROM f LEFT JOIN f o ON o.k = f.q AND f.q > 0)"""


def definition_attributes(spark, sf):
    """Parts as definitions: a part names the one of half its key as its base, in one of four ways."""
    part, k = table(spark, sf, "part"), F.col("p_partkey")
    families = F.array(*[F.lit(x) for x in ("CHARACTER", "AEO", "EXT", "AREA_EFFECT_OBJECT", "BUILDING")])
    name = lambda key: F.concat(F.lit("n"), F.when(key % 20 == 19, key - 1).otherwise(key).cast("string"))
    family = lambda key: F.get(families, (key % 5).cast("int"))
    q = F.floor(k / 2)
    base = F.when(k % 4 == 0, F.when(q > 0, F.concat(family(q), F.lit("."), name(q)))).when(k % 4 == 1, F.when(q > 0, name(q))).when(k % 4 == 2, F.when(q > 0, F.concat(F.lit("AREA_EFFECT_OBJECT."), name(q)))).otherwise(F.concat(F.lit("missing"), k.cast("string")))
    d = part.select(F.concat(family(k), F.lit("."), name(k)).alias("node"), k.alias("k"), base.alias("base"), "p_size", "p_brand")
    fact = lambda field, number, text, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(field).alias("field"), number.cast("double").alias("number"), text.cast("string").alias("text")))
    none, key = F.lit(None), F.col("k")
    sign = F.when(key % 6 == 0, "+").when(key % 6 == 1, "=").when(key % 6 == 2, "*").otherwise("+")
    given = F.array_compact(F.array(
        fact("Base", none, F.col("base"), F.col("base").isNotNull()), fact("Hit", F.col("p_size"), none, key % 3 == 0), fact("Hit[0]", none, sign, key % 2 == 0), fact("Hit[1]", key % 50, none, (key % 2 == 0) & (key % 7 > 0)),
        fact("Key", key, none), fact("Brand", none, F.col("p_brand"), key % 4 == 0), fact("Brand", none, F.lit("other"), key % 12 == 0),
    ))
    return d.select("node", F.explode(given).alias("f")).select("node", "f.*")


@query(f"""
WITH RECURSIVE {DEFINITIONS},
a AS (SELECT node, 'Base' AS field, NULL::DOUBLE AS number, base AS text FROM n WHERE base IS NOT NULL UNION ALL SELECT node, 'Hit', p_size, NULL FROM n WHERE k % 3 = 0
  UNION ALL SELECT node, 'Hit[0]', NULL, list_value('+', '=', '*', '+', '+', '+')[1 + k % 6] FROM n WHERE k % 2 = 0 UNION ALL SELECT node, 'Hit[1]', k % 50, NULL FROM n WHERE k % 2 = 0 AND k % 7 > 0
  UNION ALL SELECT node, 'Brand', NULL, p_brand FROM n WHERE k % 4 = 0 UNION ALL SELECT node, 'Brand', NULL, 'other' FROM n WHERE k % 12 = 0 UNION ALL SELECT node, 'Key', k, NULL FROM n),
u AS (SELECT node, field, min(number) AS number, min(text) AS text, count(DISTINCT coalesce(number::VARCHAR, '') || '/' || coalesce(text, '')) > 1 AS clash FROM a GROUP BY 1, 2),
w AS (SELECT node, bool_or(field = 'Hit') AS has_hit, max(CASE WHEN field = 'Hit' AND NOT clash THEN number END) AS hit, bool_or(field = 'Hit' AND clash) AS hit_clash, max(CASE WHEN field = 'Hit[0]' AND NOT clash THEN text END) AS sign, max(CASE WHEN field = 'Hit[1]' AND NOT clash THEN number END) AS operand,
  bool_or(field = 'Brand') AS has_brand, max(CASE WHEN field = 'Brand' AND NOT clash THEN text END) AS brand, max(CASE WHEN field = 'Base' AND NOT clash THEN text END) AS base FROM u GROUP BY 1),
r AS (SELECT node, base, split_part(node, '.', 1) AS family, contains(base, '.') AS dot, CASE WHEN contains(base, '.') THEN split_part(base, '.', 2) ELSE base END AS bare FROM w WHERE base IS NOT NULL),
b AS (SELECT r.*, e.node AS ext, (SELECT count(*) FROM w x WHERE split_part(x.node, '.', 2) = r.bare) AS names, (SELECT min(x.node) FROM w x WHERE split_part(x.node, '.', 2) = r.bare) AS only_one,
  (SELECT count(*) FROM w x WHERE x.node = r.family || '.' || r.base OR (r.family IN ('AEO', 'AREA_EFFECT_OBJECT') AND x.node IN ('AEO.' || r.base, 'AREA_EFFECT_OBJECT.' || r.base))) AS same,
  (SELECT min(x.node) FROM w x WHERE x.node = r.family || '.' || r.base OR (r.family IN ('AEO', 'AREA_EFFECT_OBJECT') AND x.node IN ('AEO.' || r.base, 'AREA_EFFECT_OBJECT.' || r.base))) AS sibling
  FROM r LEFT JOIN w e ON e.node = 'EXT.' || r.bare AND r.dot AND starts_with(e.base, split_part(r.base, '.', 1) || '.')),
l AS (SELECT node, CASE WHEN base IN (SELECT node FROM w) THEN base WHEN ext IS NOT NULL THEN ext WHEN same = 1 THEN sibling WHEN same = 0 AND names = 1 THEN only_one END AS parent FROM b
  UNION ALL SELECT split_part(base, '.', 1) || '.' || split_part(node, '.', 2), node FROM w WHERE starts_with(node, 'EXT.') AND contains(base, '.') AND split_part(base, '.', 1) || '.' || split_part(node, '.', 2) NOT IN (SELECT node FROM w)),
v AS (SELECT coalesce(w.node, l.node) AS id, l.parent, w.* EXCLUDE (node) FROM w FULL JOIN l ON l.node = w.node),
t(node, hit, brand) AS (SELECT id, CASE WHEN hit_clash THEN NULL WHEN sign IS NULL THEN hit WHEN sign = '=' THEN operand WHEN sign = '+' THEN hit + operand END, brand FROM v WHERE parent IS NULL
  UNION ALL SELECT v.id, CASE WHEN coalesce(v.hit_clash, false) THEN NULL WHEN v.sign IS NULL THEN CASE WHEN coalesce(v.has_hit, false) THEN v.hit ELSE t.hit END WHEN v.sign = '=' THEN v.operand WHEN v.sign = '+' THEN CASE WHEN v.has_hit THEN v.hit ELSE t.hit END + v.operand END,
  CASE WHEN coalesce(v.has_brand, false) THEN v.brand ELSE t.brand END FROM v JOIN t ON v.parent = t.node)
SELECT node, 'Hit' AS field, hit AS number, NULL AS text FROM t WHERE hit IS NOT NULL UNION ALL SELECT node, 'Brand', NULL, brand FROM t WHERE brand IS NOT NULL""")
def effective_definitions(spark, sf):
    """Two fields of each definition, its own over those of its base, with operators, aliases and conflicts."""
    return definitions.effective(definition_attributes(spark, sf)).filter(F.col("field").isin("Hit", "Brand"))


@query(f"""
WITH {DEFINITIONS}, c AS (SELECT node, count(*) AS times, min(base) AS base, count(DISTINCT base) AS bases FROM n GROUP BY 1), w AS (SELECT node, base, split_part(node, '.', 1) AS family, CASE WHEN contains(base, '.') THEN split_part(base, '.', 2) ELSE base END AS bare FROM c WHERE bases = 1),
every AS (SELECT DISTINCT node, split_part(node, '.', 2) AS name FROM n)
SELECT w.node, w.base AS declared, CASE WHEN w.base IN (SELECT node FROM every) THEN 'qualified' WHEN contains(w.base, '.') AND EXISTS (SELECT 1 FROM w e WHERE e.node = 'EXT.' || w.bare AND starts_with(e.base, split_part(w.base, '.', 1) || '.')) THEN 'extension'
  WHEN s.same = 1 THEN 'family' WHEN s.same = 0 AND (SELECT count(*) FROM every e WHERE e.name = w.bare) = 1 THEN 'unique' ELSE 'unknown' END AS how
FROM w JOIN (SELECT w.node, count(e.node) AS same FROM w LEFT JOIN every e ON e.node = w.family || '.' || w.base OR (w.family IN ('AEO', 'AREA_EFFECT_OBJECT') AND e.node IN ('AEO.' || w.base, 'AREA_EFFECT_OBJECT.' || w.base)) GROUP BY 1) s USING (node)""")
def base_resolution(spark, sf):
    """How the name of each definition's base was resolved."""
    return definitions.resolved_bases(definitions.facts(definition_attributes(spark, sf))).select("node", "declared", "how")
