"""Definition documents: flattened to typed facts, and inherited from named bases with override operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlane.operators.rounds import cut

#: What reads as a number: digits that single underscores may part, a point, an exponent, white space around.
NUMBER = r"^\s*[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
#: Families that share their names, and the family of extensions.
SHARED_FAMILIES, EXTENSION = ("AEO", "AREA_EFFECT_OBJECT"), "EXT"
OPERATORS = ("+", "-", "*", "/", "=")
_FINITE = 1.7976931348623157e308


def flatten(docs: DataFrame, key: list[str], text: str, most: int = 100) -> DataFrame:
    """(key, path, kind, number, string): every value inside JSON documents of any depth, a round for each level.

    Paths are keys joined by dots, with [i] for places in arrays. Kinds: number, boolean (number 0 or 1), string,
    empty_list. Texts 'true' and 'false' are booleans in any case, texts that read as finite numbers are numbers; nulls,
    empty texts and empty objects have no row. A document that isn't JSON has one row of kind invalid, with its text as
    the string (objects that repeat a key aren't). Numbers beyond the finite ones are of kind nonfinite, without a value,
    for the caller to reject. Null documents have no row.
    Documents nested deeper than `most` raise.
    """
    spark = docs.sparkSession
    parsed = docs.select(*key, F.col(text).alias("_text"), F.try_parse_json(text).alias("_v")).filter("_text IS NOT NULL")
    bad = parsed.filter("_v IS NULL").select(*key, F.lit("").alias("path"), F.lit("invalid").alias("kind"), F.lit(None).cast("double").alias("number"), F.col("_text").alias("string"))
    found, level = [bad], parsed.filter("_v IS NOT NULL").select(*key, F.lit("").alias("path"), "_v")
    for _ in range(most):
        inner = spark.tvf.variant_explode_outer(F.col("_v").outer())
        # a value that opens isn't kept beside each of its parts
        own = F.when(F.col("pos").isNull(), F.col("_v")).alias("_v")
        rows = cut(level.lateralJoin(inner).select(*key, "path", own, F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_value")))
        found.append(_leaves(rows.filter("_pos IS NULL"), key))
        deeper = F.when(F.col("_key").isNull(), F.concat("path", F.lit("["), "_pos", F.lit("]"))).when(F.col("path") == "", F.col("_key")).otherwise(F.concat("path", F.lit("."), "_key"))
        level = rows.filter("_pos IS NOT NULL").select(*key, deeper.alias("path"), F.col("_value").alias("_v"))
        if level.isEmpty():
            out = found[0]
            for rows in found[1:]:
                out = out.unionByName(rows)
            return out
    raise ValueError(f"documents nested deeper than {most}")


def _leaves(rows: DataFrame, key: list[str]) -> DataFrame:
    rows = rows.withColumn("_kind", F.expr("schema_of_variant(_v)")).withColumn("_s", F.try_variant_get("_v", "$", "string"))
    is_text, is_truth = F.col("_kind") == "STRING", F.col("_kind") == "BOOLEAN"
    is_list = F.col("_kind").startswith("ARRAY")
    said = F.lower("_s").isin("true", "false")
    # each in a column of its own, and kept or left out by an explode: a filter would be pushed below all of them and
    # work out every text again for each mention
    rows = rows.withColumn("_read", F.when(is_text & F.col("_s").rlike(NUMBER), F.translate("_s", "_ \t\n\r\x0b\x0c", "").try_cast("double")))
    read = F.when(F.abs("_read") <= _FINITE, F.col("_read"))
    is_number = ~(is_text | is_truth | is_list) & ~F.col("_kind").startswith("OBJECT") & (F.col("_kind") != "VOID")
    number = F.when(is_truth | (is_text & said), (F.lower("_s") == "true").cast("double")).when(is_text, read).when(is_number, F.try_variant_get("_v", "$", "double"))
    rows, number, known = rows.withColumn("_number", number), F.col("_number"), F.coalesce(F.abs("_read") <= _FINITE, F.lit(False))
    kind = (
        F.when(is_truth | (is_text & said), "boolean").when(is_text & (F.col("_s") == ""), None).when(is_text & known, "number").when(is_text, "string")
        .when(is_list, "empty_list").when(is_number & (F.abs(number) <= _FINITE), "number").when(is_number, "nonfinite")
    )
    fact = F.struct(kind.alias("kind"), number.alias("number"), F.when(is_list, "").when(is_text, F.col("_s")).alias("string"))
    out = rows.select(*key, "path", F.explode(F.filter(F.array(fact), lambda f: f["kind"].isNotNull())).alias("_f")).select(*key, "path", "_f.*")
    value = lambda c, *kinds: F.when(F.col("kind").isin(*kinds), F.col(c)).alias(c)
    return out.select(*key, "path", "kind", value("number", "number", "boolean"), value("string", "string", "empty_list"))


def facts(attributes: DataFrame) -> DataFrame:
    """(node, field, number, text, conflict) once each; a field that a node gives two different values is a conflict."""
    d = attributes.select("node", "field", F.struct("number", "text").alias("_v")).groupBy("node", "field").agg(F.min("_v").alias("_v"), F.max("_v").alias("_w"))
    clash = ~F.col("_v").eqNullSafe(F.col("_w"))
    value = lambda c: F.when(~clash, F.col(f"_v.{c}")).alias(c)
    return d.select("node", "field", value("number"), value("text"), clash.alias("conflict"))


def resolved_bases(known: DataFrame, base: str = "Base") -> DataFrame:
    """(node, declared, parent, how) of nodes (family.name) whose facts name a base; parent is null where it stays unknown.

    how: qualified (a node has just that name), family (a node of the same family has it, or of either family that
    share names), extension (an extension of that name declares a base in the family named), unique (one node of all
    has that bare name), unknown. Extensions come before families, families before unique names; two matches are unknown.
    """
    nodes = known.select("node").distinct()
    named = known.filter((F.col("field") == base) & F.col("text").isNotNull() & (F.col("text") != "")).select("node", F.col("text").alias("declared"))
    part = lambda c, i: F.split(c, r"\.", 2)[i]
    d = named.withColumn("_family", part("node", 0)).withColumn("_dot", F.contains("declared", F.lit(".")))
    d = d.withColumn("_bare", F.when(F.col("_dot"), F.get(F.split("declared", r"\.", 2), F.lit(1))).otherwise(F.col("declared")))
    d = d.join(nodes.select(F.col("node").alias("declared"), F.lit(True).alias("_there")), "declared", "left")
    families = F.when(F.col("_family").isin(*SHARED_FAMILIES), F.array(*[F.lit(f) for f in SHARED_FAMILIES])).otherwise(F.array("_family"))
    tried = d.select("node", F.explode(F.transform(families, lambda f: F.concat(f, F.lit("."), F.col("declared")))).alias("_try"))
    own = tried.join(nodes.withColumnRenamed("node", "_try"), "_try", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.min("_try").alias("_own"))
    extended = named.filter(F.col("node").startswith(EXTENSION + ".")).select(F.col("node").alias("_ext"), F.col("declared").alias("_ext_base"))
    unique = nodes.groupBy(F.coalesce(F.get(F.split("node", r"\.", 2), F.lit(1)), F.col("node")).alias("_bare")).agg(F.count(F.lit(1)).alias("_names"), F.min("node").alias("_only"))
    d = d.join(own, "node", "left").withColumn("_ext", F.concat(F.lit(EXTENSION + "."), "_bare")).join(extended, "_ext", "left").join(unique, "_bare", "left")
    ext = F.col("_dot") & F.coalesce(F.startswith("_ext_base", F.concat(part("declared", 0), F.lit("."))), F.lit(False))
    how = F.when(F.col("_there"), "qualified").when(ext, "extension").when(F.col("_n") == 1, "family").when(F.col("_n").isNull() & (F.col("_names") == 1), "unique").otherwise("unknown")
    d = d.withColumn("how", how)
    parent = F.when(F.col("how") == "qualified", F.col("declared")).when(F.col("how") == "extension", F.col("_ext")).when(F.col("how") == "family", F.col("_own")).when(F.col("how") == "unique", F.col("_only"))
    return d.select("node", "declared", parent.alias("parent"), "how")


def overrides(known: DataFrame) -> DataFrame:
    """(node, field, op, number, text): what each node does to the value that it inherits. op set puts the value (null: it
    becomes unknown), add adds to a number and makes all else unknown.

    A fact sets its field. A field's own X[0] that is an operator acts after that with X[1]: = sets a number, + adds
    one, other operators and operands make X unknown. A conflict makes its field unknown.
    """
    plain = known.select("node", "field", F.col("conflict").alias("_conflict"), F.lit("set").alias("_op"), F.col("number").alias("_number"), F.col("text").alias("_text"))
    acts = known.filter(~F.col("conflict") & F.col("field").endswith("[0]") & F.col("text").isin(*OPERATORS)).select("node", F.expr("left(field, length(field) - 3)").alias("field"), F.col("text").alias("_sign"))
    operand = known.filter(~F.col("conflict") & F.col("field").endswith("[1]")).select("node", F.expr("left(field, length(field) - 3)").alias("field"), F.col("number").alias("_operand"))
    d = plain.join(acts.join(operand, ["node", "field"], "left"), ["node", "field"], "full")
    clash, own = F.coalesce("_conflict", F.lit(False)), F.col("_op").isNotNull()
    put, add = (F.col("_sign") == "=") & F.col("_operand").isNotNull(), (F.col("_sign") == "+") & F.col("_operand").isNotNull()
    op = F.when(~clash & add & ~own, "add").otherwise("set")
    number = F.when(clash, None).when(F.col("_sign").isNull(), F.col("_number")).when(put, F.col("_operand")).when(add & own, F.col("_number") + F.col("_operand")).when(add, F.col("_operand"))
    text = F.when(~clash & F.col("_sign").isNull(), F.col("_text"))
    return d.select("node", "field", op.alias("op"), number.cast("double").alias("number"), text.alias("text"))


def effective(attributes: DataFrame, base: str = "Base") -> DataFrame:
    """(node, field, number, text): facts of each node, its own over those of its base, as far as they are known.

    attributes: node (family.name), field, number or text. See facts, resolved_bases and overrides for conflicts, names
    and operators. Names that an extension adds to the family of its base are nodes, too, with the extension's facts.
    What a node does to a field is a step that composes with its base's, so chains are folded by doubling: rounds grow
    with the logarithm of the longest chain. Nodes that are their own ancestors raise ValueError.
    """
    known = cut(facts(attributes))
    bases = resolved_bases(known, base)
    nodes = known.select("node").distinct()
    extended = bases.filter(F.col("node").startswith(EXTENSION + ".") & F.contains("declared", F.lit(".")))
    alias = extended.select(F.concat(F.split("declared", r"\.", 2)[0], F.lit("."), F.split("node", r"\.", 2)[1]).alias("node"), F.col("node").alias("parent")).join(nodes, "node", "left_anti")
    links = cut(bases.filter("parent IS NOT NULL").select("node", "parent").unionByName(alias))
    steps = cut(overrides(known))
    for _ in range(max(1, links.count()).bit_length() + 1):
        if links.isEmpty():
            break
        above = links.join(steps.select(F.col("node").alias("parent"), "field", F.col("op").alias("_op"), F.col("number").alias("_number"), F.col("text").alias("_text")), "parent").drop("parent")
        d = steps.join(above, ["node", "field"], "full")
        folded = F.col("op") == "add"
        number = F.when(F.col("op").isNull(), F.col("_number")).when(folded & F.col("_op").isNotNull(), F.col("number") + F.col("_number")).otherwise(F.col("number"))
        steps = cut(d.select(
            "node", "field", F.when(F.col("op").isNull() | (folded & F.col("_op").isNotNull()), F.col("_op")).otherwise(F.col("op")).alias("op"),
            number.alias("number"), F.when(F.col("op").isNull(), F.col("_text")).otherwise(F.col("text")).alias("text"),
        ))
        links = cut(links.join(links.select(F.col("node").alias("parent"), F.col("parent").alias("_far")), "parent").select("node", F.col("_far").alias("parent")))
    else:
        raise ValueError(f"definitions inherit from themselves: {[r.node for r in links.select('node').distinct().limit(5).collect()]}")
    return steps.filter((F.col("op") == "set") & (F.col("number").isNotNull() | F.col("text").isNotNull())).select("node", "field", "number", "text")


def known_or(value: Column, unknown: float = 0.0) -> Column:
    """A value with its known bit, as trained on: (value or a stand-in, 0 or 1)."""
    return F.struct(F.coalesce(value, F.lit(unknown)).alias("value"), value.isNotNull().cast("int").alias("known"))
