"""Row audits: named rules give sorted reasons, reasons give a class; suites count violations in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(rules: dict[str, Column]) -> Column:
    """Sorted names of the rules that a row breaks; a rule that is null (unknown) isn't broken."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])))


def classify(found: Column, soft: list[str]) -> Column:
    """rejected for any hard reason, uncertain for soft ones alone, else confirmed."""
    hard = F.size(F.array_except(found, F.array(*map(F.lit, soft))))
    return F.when(hard > 0, "rejected").when(F.size(found) > 0, "uncertain").otherwise("confirmed")


def first_group(found: Column, groups: list[tuple[str, list[str]]], other: str = "other") -> Column:
    """Name of the first group that shares a reason, in the order given."""
    cases = [(F.arrays_overlap(found, F.array(*map(F.lit, names))), name) for name, names in groups]
    return reduce(lambda acc, x: F.when(x[0], x[1]).otherwise(acc), reversed(cases), F.when(F.size(found) > 0, other))


def reason_counts(audited: DataFrame, column: str = "reasons") -> DataFrame:
    return audited.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def suite(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations, total): every rule counted in one pass over rows."""
    counts = rows.agg(F.count(F.lit(1)).alias("total"), *[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias(n) for n, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("long").alias("violations")) for n in rules])
    return counts.select(F.explode(pairs).alias("r"), "total").select("r.rule", "r.violations", "total")


def split_good(rows: DataFrame, rules: dict[str, Column], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, violations with their reasons); strict raises if there are any."""
    audited = rows.withColumn("reasons", reasons(rules))
    bad = audited.filter(F.size("reasons") > 0)
    if strict and not bad.isEmpty():
        raise ValueError("rows violate: " + ", ".join(r.reason for r in reason_counts(bad).orderBy("reason").collect()))
    return audited.filter(F.size("reasons") == 0).drop("reasons"), bad


def missing_fields(columns: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))


def failure_class(message: Column, rules: list[tuple[str, str]], other: str = "unclassified") -> Column:
    """Class of the first rule whose text the message holds."""
    return reduce(lambda acc, r: F.when(F.contains(message, F.lit(r[0])), r[1]).otherwise(acc), reversed(rules), F.lit(other))
