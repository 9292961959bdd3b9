"""Scalar functions as column expressions: hash buckets, token and path clean-up, grid cells, clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_64 = 2.0**64


def hash_prefix(text: Column) -> Column:
    """First eight bytes of the text's SHA-256 as an unsigned number (decimal, as it exceeds a bigint)."""
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def hash_bucket(seed: str, namespace: str, value: Column) -> Column:
    """Deterministic place of a value in [0, 1)."""
    return hash_prefix(F.concat(F.lit(f"{seed}:{namespace}:"), value.cast("string"))).cast("double") / TWO_64


def fixed_partition(value: Column, namespace: str = "") -> Column:
    """train, validation or test by the hash of namespace and value modulo 10,000 (9,000, 500 and 500 shares)."""
    m = (hash_prefix(F.concat(F.lit(namespace), value.cast("string"))) % 10000).cast("int")
    return F.when(m < 9000, "train").when(m < 9500, "validation").otherwise("test")


def base_token(token: Column) -> Column:
    """Without a form suffix such as -ev1 or -hero."""
    return F.regexp_replace(token, r"-(ev\d+|hero)$", "")


def split_token(token: Column) -> Column:
    """(base, flags) of a trimmed, lower-cased token: all form suffixes off its end; bit 0 for -ev1, bit 1 for -hero.
    A token without a base is null."""
    low = F.lower(F.trim(token))
    end = F.regexp_extract(low, r"((?:-ev1|-hero)+)$", 1)
    base = F.regexp_replace(low, r"(?:-ev1|-hero)+$", "")
    return F.when(base != "", F.struct(base.alias("base"), (end.contains("-ev1").cast("int") + 2 * end.contains("-hero").cast("int")).alias("flags")))


def unix_seconds_of(value: Column) -> Column:
    """Numbers beyond 1e10 are milliseconds; text that isn't a number is null."""
    v = value.try_cast("double")
    return F.floor(F.when(v > 1e10, v / 1000).otherwise(v)).cast("long")


def seconds(ts: Column) -> Column:
    """Whole seconds of a timestamp with or without time zone (session time zone: UTC)."""
    return F.unix_seconds(ts.cast("timestamp"))


def decision_window(tick: Column, width: int = 5, first: int = 0) -> Column:
    """Start of the decision that a command falls into (decision < tick <= decision + width), or null before the first."""
    w = (first + F.floor((tick - first - 1) / width) * width).cast("long")
    return F.when(tick > first, w)


def grid_cell(x: Column, y: Column, columns: int = 18, rows: int = 32, size: int = 1000) -> Column:
    """Cell number of a point, null outside the board."""
    c, r = F.floor(x / size), F.floor(y / size)
    return F.when((c >= 0) & (c < columns) & (r >= 0) & (r < rows), (r * columns + c).cast("int"))


def rotated(x: Column, y: Column, width: int = 18000, height: int = 32000) -> Column:
    """The point seen from the other side: 0 becomes the last place of the board; clamped to the board."""
    clamp = lambda v, top: F.greatest(F.lit(0), F.least(F.lit(top), v))
    return F.struct(clamp(width - 1 - x, width - 1).alias("x"), clamp(height - 1 - y, height - 1).alias("y"))


def half_cell(x: Column, y: Column, size: int = 1000, off: int = 1) -> Column:
    """grid_cell of a point that lies within `off` of its cell's centre, else null."""
    near = lambda v: F.abs(v % size - size // 2) <= off
    return F.when(near(x) & near(y), grid_cell(x, y))


def tower_key(relation: Column, role: Column, lane: Column, side: Column) -> Column:
    """One number for a tower: 0 or 3 by relation, the king 0, others 1 for the left lane (0) and 2 for the right as side 0
    sees them; side 1 looks the other way."""
    seen = F.when(side == 1, 1 - lane).otherwise(lane)
    return (relation * 3 + F.when(role == "king", 0).otherwise(1 + seen)).cast("int")


def source_group(url: Column, explicit: Column | None = None) -> Column:
    """explicit:id where there is one, else url: with scheme and host lower-cased, the path as it is and no query;
    null without either."""
    part = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)"
    scheme, host, path = (F.regexp_extract(url, part, i) for i in (1, 2, 3))
    found = F.when(scheme != "", F.concat(F.lit("url:"), F.lower(scheme), F.lit("://"), F.lower(host), path))
    if explicit is None:
        return found
    return F.when(F.trim(explicit) != "", F.concat(F.lit("explicit:"), F.trim(explicit))).otherwise(found)


def two_tags(tags: Column) -> Column:
    """The two different players of an array of tags, cleaned and sorted; null unless there are exactly two."""
    found = F.array_sort(F.array_distinct(F.filter(F.transform(tags, clean_tag), lambda t: t != "")))
    return F.when(F.size(found) == 2, found)


def month_of(seconds_: Column) -> Column:
    """Calendar month (UTC session) of Unix seconds as yyyy-MM."""
    return F.date_format(F.timestamp_seconds(seconds_), "yyyy-MM")


def utc_seconds(text: Column) -> Column:
    """Unix seconds of ISO text that names its zone; null for text without one or that isn't a time."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text)
    return F.unix_seconds(zoned.try_cast("timestamp"))


def step_rate(tick: Column, steps: list[tuple[int, float]]) -> Column:
    """Rate in force at a tick: the value of the last step (start, value) that has begun."""
    out = F.lit(None).cast("double")
    for start, value in sorted(steps):
        out = F.when(tick >= start, F.lit(float(value))).otherwise(out)
    return out


def clean_tag(tag: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(tag), "^#+", ""))


def clean_path(path: Column) -> Column:
    """Lower case, forward slashes, no repeated or dot segments."""
    one = F.regexp_replace(F.lower(F.translate(path, "\\", "/")), "/+", "/")
    return F.regexp_replace(F.regexp_replace(one, r"(?<=/)(\./)+", ""), r"^(\./)+", "")


def mask_items(mask: Column, items: Column) -> Column:
    """Items of an array whose bit is set in mask."""
    return F.filter(items, lambda x, i: F.shiftright(mask, i).bitwiseAND(F.lit(1)) == 1)


def signed_outcome(own: Column, other: Column) -> Column:
    return F.signum((own - other).cast("double")).cast("int")


def scaled_level(base: Column, multiplier: Column) -> Column:
    """base * multiplier percent, truncated towards zero."""
    v = base * multiplier / 100
    return F.when(v < 0, F.ceil(v)).otherwise(F.floor(v)).cast("long")


def digest_of(*columns: str) -> Column:
    """SHA-256 of the columns as JSON, in name order: stable inside this library."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)
