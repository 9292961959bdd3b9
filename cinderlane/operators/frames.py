"""Objects in consecutive frames of a stream: appearances, removals, targets and effects, and deltas with anchors.

A stream's ticks follow one another without a gap, so frame numbers are differences of ticks and a key's gap in them is
a removal: no step orders a stream's frames in one place. Windows are by stream and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.operators.rounds import cut

#: Kinds of appearance by the ranges of keys, and of changes of a target and an effect.
AREAS_BELOW, PROJECTILES_BELOW = 4_000_000, 5_000_000
KEY = ["stream", "key"]
_EVENTS = "array<struct<tick:bigint,kind:string,other:bigint,name:string>>"


def bounds(frames: DataFrame) -> DataFrame:
    """(stream, first, last, gap) of frames (stream, tick): its ticks from the first up to the last before a gap, and the
    tick after the gap, if there is one. Repeated frames count once. Rows without a stream or tick are left out."""
    own = frames.select("stream", "tick").dropna().distinct()
    before = own.select("stream", (F.col("tick") + 1).alias("tick"))
    starts = own.join(before, ["stream", "tick"], "left_anti")
    first = starts.groupBy("stream").agg(F.min("tick").alias("first"))
    gap = starts.join(first, "stream").filter("tick > first").groupBy("stream").agg(F.min("tick").alias("gap"))
    ends = own.join(own.select("stream", (F.col("tick") - 1).alias("tick")), ["stream", "tick"], "left_anti").groupBy("stream").agg(F.min("tick").alias("last"))
    return first.join(ends, "stream").join(gap, "stream", "left").select("stream", "first", "last", "gap")


def _placed(frames: DataFrame, objects: DataFrame) -> DataFrame:
    """Objects of the frames before the first gap, once each, with what the key held in the frame before, if it was there."""
    rows = objects.dropDuplicates(["stream", "tick", "key"]).join(bounds(frames), "stream").filter("tick BETWEEN first AND last")
    w = Window.partitionBy(*KEY).orderBy("tick")
    values = [c for c in objects.columns if c not in ("stream", "tick", "key")]
    rows = rows.withColumn("_then", F.lag(F.struct("tick", *values)).over(w)).withColumn("_next", F.lead("tick").over(w))
    return rows.withColumn("_then", F.when(F.col("_then.tick") == F.col("tick") - 1, F.col("_then"))).withColumn("_leaves", (F.col("tick") < F.col("last")) & ~F.coalesce(F.col("_next") == F.col("tick") + 1, F.lit(False)))


def appearance(key: Column) -> Column:
    return F.when(key < AREAS_BELOW, "area_create").when(key < PROJECTILES_BELOW, "projectile_spawn").otherwise("spawn")


def object_events(frames: DataFrame, objects: DataFrame) -> DataFrame:
    """(stream, tick, kind, key, side, other, name) of changes between consecutive frames.

    frames: stream, tick (a frame without objects is one, too); objects: stream, tick, key, side, target (a key or null)
    and effects (array of names or null: not known). Kinds: area_create, projectile_spawn, spawn (the key wasn't in the
    frame before), despawn (it isn't in the next; no claim that it died), target_acquire, target_lose, target_change
    (other: the target now; a target that is no object of the frame is none), effect_apply, effect_remove, effect_stack
    (name: the effect, where its number changed; both frames have to know theirs). The first frame makes no events, and
    neither do frames from a stream's first gap on. Repeated rows of an object count once.
    """
    there = objects.select("stream", "tick", F.col("key").alias("target")).distinct().withColumn("_there", F.lit(True))
    known = objects.join(there, ["stream", "tick", "target"], "left").withColumn("target", F.when(F.col("_there"), F.col("target")))
    rows = _placed(frames, known.select("stream", "tick", "key", "side", "target", "effects"))
    none, then = F.lit(None), F.col("_then")
    event = lambda when, kind, at, other, name: F.when(when, F.struct(at.alias("tick"), kind.alias("kind"), other.cast("long").alias("other"), name.cast("string").alias("name")))
    now, was = F.col("target"), then["target"]
    aims = F.when(now.isNull(), "target_lose").when(was.isNull(), "target_acquire").otherwise("target_change")
    count = lambda names, x: F.size(F.filter(names, lambda y: y == x))
    both = then.isNotNull() & F.col("effects").isNotNull() & then["effects"].isNotNull()
    changed = F.filter(F.array_distinct(F.concat(F.col("effects"), then["effects"])), lambda x: count(F.col("effects"), x) != count(then["effects"], x))
    effects = F.transform(changed, lambda x: F.struct(
        F.col("tick").alias("tick"), F.when(count(then["effects"], x) == 0, "effect_apply").when(count(F.col("effects"), x) == 0, "effect_remove").otherwise("effect_stack").alias("kind"), none.cast("long").alias("other"), x.alias("name")))
    single = F.array_compact(F.array(
        event(then.isNull() & (F.col("tick") > F.col("first")), appearance(F.col("key")), F.col("tick"), none, none),
        event(F.col("_leaves"), F.lit("despawn"), F.col("tick") + 1, none, none),
        event(then.isNotNull() & ~now.eqNullSafe(was), aims, F.col("tick"), now, none),
    ))
    return rows.select("stream", "key", "side", F.explode(F.concat(single, F.when(both, effects).otherwise(F.array().cast(_EVENTS)))).alias("e")).select("stream", "e.tick", "e.kind", "key", "side", "e.other", "e.name")


def entity_deltas(frames: DataFrame, objects: DataFrame, fields: list[str], every: int) -> DataFrame:
    """(stream, tick, key, change, mask, fields): what a reader needs to rebuild every frame.

    Each `every`-th frame of a stream, its first included, is an anchor: all of its objects with all fields. Between them
    objects are spawned (all fields), updated (mask: a bit for each field that changed, only these are told) or removed
    (in the first frame without them; nothing is told). Objects that stay as they are have no row.
    """
    rows = _placed(frames, objects.select("stream", "tick", "key", *fields))
    then = F.col("_then")
    full = (1 << len(fields)) - 1
    differs = sum((F.when(F.col(f).eqNullSafe(then[f]), 0).otherwise(1 << i) for i, f in enumerate(fields)), F.lit(0))
    anchor = (F.col("tick") - F.col("first")) % every == 0
    change = F.when(anchor, "anchor").when(then.isNull(), "spawned").when(differs > 0, "updated")
    mask = F.when(anchor | then.isNull(), full).otherwise(differs)
    told = [F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.col(f)).alias(f) for i, f in enumerate(fields)]
    stay = rows.withColumn("mask", mask).withColumn("change", change).filter("change IS NOT NULL").select("stream", "tick", "key", "change", "mask", *told)
    gone = rows.filter(F.col("_leaves") & ((F.col("tick") + 1 - F.col("first")) % every != 0))
    gone = gone.select("stream", (F.col("tick") + 1).alias("tick"), "key", F.lit("removed").alias("change"), F.lit(0).alias("mask"), *[F.lit(None).cast(objects.schema[f].dataType).alias(f) for f in fields])
    return stay.unionByName(gone)


def entity_states(deltas: DataFrame, ends: DataFrame, fields: list[str], every: int) -> DataFrame:
    """(stream, tick, key, fields) of every object in every frame, from deltas and the streams' bounds: each stretch
    between two anchors is rebuilt by itself, so a reader can begin at any anchor."""
    # deltas are written, so that a task doesn't hold the sorts that make them and those that read them at once
    d = cut(deltas).join(ends.select("stream", "first", "last"), "stream").withColumn("_block", F.floor((F.col("tick") - F.col("first")) / every))
    w = Window.partitionBy(*KEY, "_block").orderBy("tick")
    until = w.rowsBetween(Window.unboundedPreceding, 0)
    stop = F.least(F.col("first") + (F.col("_block") + 1) * every, F.col("last") + 1)
    d = d.withColumn("_until", F.coalesce(F.lead("tick").over(w), stop))
    for i, f in enumerate(fields):
        said = F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.struct(F.col(f).alias("v")))
        d = d.withColumn(f"_{f}", F.last(said, True).over(until)["v"])
    live = d.filter("change <> 'removed'").select("stream", "key", F.explode(F.sequence("tick", F.col("_until") - 1)).alias("tick"), *[F.col(f"_{f}").alias(f) for f in fields])
    return live.select("stream", "tick", "key", *fields)


def sightings(births: DataFrame) -> DataFrame:
    """(stream, key, side, parent, root): lineage of births (stream, order, key, side, parent), a key's first birth only.

    A parent counts where it was born before in the stream and belongs to the same side; else the key is a root. Chains
    are joined by doubling (see joins.lineage) on keys that carry their stream.
    """
    from cinderlane.operators.joins import lineage

    own = births.groupBy("stream", "key").agg(F.min_by(F.struct("side", "parent", "order"), "order").alias("b")).select("stream", "key", "b.*")
    up = own.select("stream", F.col("key").alias("parent"), F.col("side").alias("_side"), F.col("order").alias("_order"))
    own = own.join(up, ["stream", "parent"], "left")
    fits = (F.col("_side") == F.col("side")) & (F.col("_order") < F.col("order"))
    own = own.withColumn("parent", F.when(fits, F.col("parent")))
    named = own.select(F.struct("stream", "key").alias("node"), F.when(F.col("parent").isNotNull(), F.struct("stream", F.col("parent").alias("key"))).alias("up"))
    roots = lineage(named, "node", "up").select(F.col("node.stream").alias("stream"), F.col("node.key").alias("key"), F.col("root.key").alias("root"))
    return own.select("stream", "key", "side", "parent").join(roots, ["stream", "key"])
