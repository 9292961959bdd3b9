"""Stateful assembly of frame streams: object changes, lineage, damage and actor frames as the frames come in.

The batch form of the same results is in operators/frames.py; tests hold the two against each other.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from cinderlane.operators.frames import AREAS_BELOW, PROJECTILES_BELOW

#: Columns of a stream of frames.
FRAME = (
    "stream long, line long, tick long, objects array<struct<key:bigint,side:int,target:bigint,effects:array<string>>>, "
    "births array<struct<key:bigint,side:int,parent:bigint>>, damage array<struct<sequence:bigint,source:bigint,amount:double>>"
)
EVENT = "stream long, tick long, kind string, key long, side int, other long, name string, amount double"
_NAMES = [c.split()[0] for c in EVENT.split(", ")]
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams that start inside keep their state in RocksDB, which keyed state needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, _PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: All that is kept of a stream, as one value: each call of the state store costs more than a frame does.
_KEPT = "tick long, line long, sequence long, broken boolean, objects string, births string, damage string, recent string"


def _packed(kept: dict) -> str:
    return json.dumps([[k, *v] for k, v in kept.items()], separators=(",", ":"))


def _unpacked(text: str) -> dict:
    return {k: tuple(v) for k, *v in json.loads(text)}


class Assembler(StatefulProcessor):
    def __init__(self, every: int, history: int, idle_ms: int | None, ttl_ms: int | None):
        self.every, self.history, self.idle_ms, self.ttl_ms = every, history, idle_ms, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", _KEPT, self.ttl_ms)

    def _changes(self, tick: int, was: dict, now: dict) -> list[tuple]:
        out = []
        for k in now.keys() - was.keys():
            kind = "area_create" if k < AREAS_BELOW else "projectile_spawn" if k < PROJECTILES_BELOW else "spawn"
            out.append((tick, kind, k, now[k][0], None, None, None))
        out += [(tick, "despawn", k, was[k][0], None, None, None) for k in was.keys() - now.keys()]
        for k in now.keys() & was.keys():
            (side, target, effects), (_, aimed, before) = now[k], was[k]
            if target != aimed:
                out.append((tick, "target_lose" if target is None else "target_acquire" if aimed is None else "target_change", k, side, target, None, None))
            if effects is not None and before is not None and effects != before:
                a, b = Counter(before), Counter(effects)
                out += [(tick, "effect_apply" if not a[n] else "effect_remove" if not b[n] else "effect_stack", k, side, None, n, None) for n in a.keys() | b.keys() if a[n] != b[n]]
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, seen, sequence, broken, *texts = self.kept.get() or (None, -1, 0, False, "[]", "[]", "[]", "[]")
        objects, births, damage = map(_unpacked, texts[:3])
        recent = json.loads(texts[3])
        out: list[tuple] = []
        lines = [r for frame in rows for r in zip(*[frame[c].tolist() for c in ("line", "tick", "told")], strict=True)]
        for line, tick, text in sorted(lines, key=lambda r: r[0]):
            if broken or line <= seen:
                continue
            seen = line
            again = tick == last
            if last is not None and not again and tick != last + 1:
                broken = True
                out.append((tick, "broken", None, None, None, None, None))
                break
            # what a repeated tick tells was not in its first frame, so it is seen a tick later
            observed, events = tick + again, []
            told = json.loads(text)
            for k, side, parent in ((b["key"], b["side"], b.get("parent")) for b in told.get("births", ())):
                if k not in births:
                    up = births.get(parent)
                    births[k] = (side, up[1] if up and up[0] == side else k)
                    events.append((observed, "birth", k, side, births[k][1], None, None))
            for number, source, amount in ((d["sequence"], d.get("source"), float(d["amount"])) for d in told.get("damage", ())):
                if number <= sequence:
                    continue
                if number != sequence + 1:
                    events.append((observed, "damage_gap", None, None, number, None, None))
                sequence = number
                side, root = births.get(source, (None, None))
                if root is not None:
                    damage[root] = (damage.get(root, (0.0,))[0] + amount,)
                events.append((observed, "damage", source, side, root, None, amount))
            if not again:
                given: dict = {}
                for o in told.get("objects", ()):
                    given.setdefault(o["key"], (o["side"], o.get("target"), sorted(o["effects"]) if "effects" in o else None))
                now = {k: (side, target if target in given else None, effects) for k, (side, target, effects) in given.items()}
                if last is not None:
                    events += self._changes(tick, objects, now)
                objects = now
            recent = [t for t in recent if t > tick - self.history] + [e[0] for e in events]
            out += events
            if tick % self.every == 0 and not again:
                sides = Counter(o[0] for o in objects.values())
                done = Counter()
                for root, (amount,) in damage.items():
                    done[births[root][0]] += amount
                shown = sum(t <= tick for t in recent)
                out += [(tick, "frame", sides[s], s, sides[1 - s], str(shown), float(done[s])) for s in (0, 1)]
            last = tick
        self.kept.update((last, seen, sequence, broken, _packed(objects), _packed(births), _packed(damage), json.dumps(recent)))
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        if out:
            yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A stream that is silent for long is closed: its state goes."""
        kept = self.kept.get()
        self.kept.clear()
        last = kept[0] if kept else None
        yield self._frame(key, [(last, "closed", None, None, None, None, None)])

    def _frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *r) for r in rows], columns=_NAMES, dtype=object)

    def close(self) -> None:
        pass


def assemble(frames: DataFrame, every: int = 5, history: int = 5, idle_ms: int | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Events of a stream of frames (FRAME), as EVENT. Start the query inside rocksdb().

    Kinds: those of operators.frames.object_events; birth (other: its root), damage (key: the source, other: its root,
    amount), damage_gap (other: the number after the gap), frame (each `every`-th tick and side: key own objects, other
    enemy objects, amount the damage of its roots, name the events seen in the last `history` ticks), broken (a tick that
    doesn't follow; the rest of the stream is left out), closed (nothing came for idle_ms, and the state went).
    Frames may come in any order inside a micro-batch; lines already read are left out. A repeated tick brings births
    and damage, seen one tick later, and no changes of objects. ttl_ms bounds how long untouched state is kept. Either
    time makes the query look at the clock, so that it goes on after all that is available was read; run it with a
    trigger that repeats, not with availableNow.
    """
    clock = "None" if idle_ms is None and ttl_ms is None else "ProcessingTime"
    # nested columns go to Python as text: empty batches of them end the worker
    told = frames.select("stream", "line", "tick", F.to_json(F.struct("objects", "births", "damage")).alias("told"))
    return told.groupBy("stream").transformWithStateInPandas(
        statefulProcessor=Assembler(every, history, idle_ms, ttl_ms), outputStructType=EVENT, outputMode="Append", timeMode=clock
    )
