"""Stream assembly in several micro-batches with a restart, against the batch operators."""

import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cinderlane.operators import frames
from cinderlane.streaming import assembler, incremental


def capture(seed=3):
    """Frames of three streams: one with repeated ticks, one with a gap."""
    rng, rows = random.Random(seed), []
    for stream in (1, 2, 3):
        line, sequence, born = 0, 0, set()
        for tick in range(4, 34):
            for again in range(1 + (stream == 2 and tick % 6 == 0)):
                line += 1
                keys = [k for k in (3_000_001, 4_000_002, 5_000_003, 5_000_004, 5_000_005, 5_000_006) if rng.random() < 0.7]
                objects = [(k, k % 2, rng.choice([*keys, 77, None]), rng.choice([None, [], ["a"], ["a", "b"], ["a", "a"]])) for k in keys]
                births = [(k, k % 2, rng.choice([None, 5_000_003, 5_000_004, 3_000_001, 9])) for k in keys if k not in born and rng.random() < 0.5]
                born |= {b[0] for b in births}
                sequence += 1 + (rng.random() < 0.1)
                damage = [(sequence, rng.choice([*keys, 9]), float(rng.randrange(9)))]
                rows.append((stream, line, tick + (stream == 3 and tick > 20), objects, births, damage))
    return rows


@pytest.fixture(scope="module")
def streamed(spark):
    rows = capture()
    folder = tempfile.mkdtemp(prefix="spark-")
    cut = [lambda r: r[1] <= 9, lambda r: 9 < r[1] <= 21, lambda r: r[1] > 20]  # lines come twice at the last border
    for i, wanted in enumerate(cut):
        part = [r for r in rows if wanted(r)]
        random.Random(i).shuffle(part)
        spark.createDataFrame(part, assembler.FRAME).repartition(2).write.parquet(f"{folder}/in/{i}")
        stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in/0").schema).option("recursiveFileLookup", True).parquet(f"{folder}/in")
        with assembler.rocksdb(spark):  # a new run each time: the state comes back from the checkpoint
            incremental.run_available(assembler.assemble(stream), f"{folder}/out", f"{folder}/state")
    return rows, spark.read.parquet(f"{folder}/out").cache()


def first_frames(rows):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        if (r[0], r[2]) not in seen:
            seen.add((r[0], r[2]))
            out.append(r)
    return out


def test_changes_equal_the_batch(spark, streamed):
    rows, got = streamed
    own = first_frames(rows)
    objects = spark.createDataFrame([(r[0], r[2], *o) for r in own for o in r[3]], "stream long, tick long, key long, side int, target long, effects array<string>")
    want = frames.object_events(spark.createDataFrame([(r[0], r[2]) for r in own], "stream long, tick long"), objects)
    seen = got.filter(~F.col("kind").isin("birth", "damage", "damage_gap", "frame", "broken")).select(*want.columns)
    assert Counter(map(tuple, seen.collect())) == Counter(map(tuple, want.collect())) and want.count() > 300


def test_lineage_damage_and_frames_equal_the_batch(spark, streamed):
    rows, got = streamed
    ok = [r for r in sorted(rows) if not (r[0] == 3 and r[2] > 20)]
    births = spark.createDataFrame([(r[0], r[1] * 100 + i, *b) for r in ok for i, b in enumerate(r[4])], "stream long, order long, key long, side int, parent long")
    roots = {(r.stream, r.key): (r.side, r.root) for r in frames.sightings(births).collect()}
    assert {(r.stream, r.key): (r.side, r.other) for r in got.filter("kind = 'birth'").collect()} == roots
    assert any(k[1] != root for k, (_, root) in roots.items())
    known, total, told, number, gaps, ticks = set(), Counter(), Counter(), {}, 0, {}
    want = {}
    for r in ok:
        again = ticks.get(r[0]) == r[2]
        ticks[r[0]] = r[2]
        known |= {(r[0], b[0]) for b in r[4]}
        for n, source, amount in r[5]:
            gaps += n != number.get(r[0], 0) + 1
            number[r[0]] = n
            side, root = roots[r[0], source] if (r[0], source) in known else (None, None)
            total[r[0], side] += amount
            told[r[0], r[2] + again, source, root, amount] += 1
        if r[2] % 5 == 0 and not again:
            sides = Counter(o[1] for o in r[3])
            for s in (0, 1):
                want[r[0], r[2], s] = sides[s], sides[1 - s], total[r[0], s]
    assert Counter((r.stream, r.tick, r.key, r.other, r.amount) for r in got.filter("kind = 'damage'").collect()) == told
    assert got.filter("kind = 'damage_gap'").count() == gaps > 0
    assert {(r.stream, r.tick, r.side): (r.key, r.other, r.amount) for r in got.filter("kind = 'frame'").collect()} == want
    assert [(r.stream, r.tick) for r in got.filter("kind = 'broken'").collect()] == [(3, 22)]


def test_history_counts_events_seen_in_five_ticks(streamed):
    rows, got = streamed
    events = [(r.stream, r.tick) for r in got.filter("kind NOT IN ('frame', 'broken')").collect()]
    for r in got.filter("kind = 'frame' AND stream <> 2").collect():
        assert int(r.name) == sum(s == r.stream and r.tick - 5 < t <= r.tick for s, t in events)


def test_silent_streams_are_closed(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    spark.createDataFrame([r for r in capture() if r[0] == 1], assembler.FRAME).coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).parquet(f"{folder}/in")
    with assembler.rocksdb(spark):
        rows = assembler.assemble(stream, idle_ms=300, ttl_ms=60_000)
        query = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(processingTime="500 milliseconds").start(f"{folder}/out")
        try:
            for _ in range(60):
                query.awaitTermination(1)
                done = query.lastProgress and query.lastProgress.batchId >= 2
                if done and [(r.tick, r.stream) for r in spark.read.parquet(f"{folder}/out").filter("kind = 'closed'").collect()] == [(33, 1)]:
                    break
            else:
                raise AssertionError("the stream was not closed")
        finally:
            query.stop()


class Counted:
    """A state handle that counts how often its states are called."""

    def __init__(self):
        self.calls, self.values = 0, {}

    def getValueState(self, name, *_):
        return self._state(name)

    getMapState = getListState = getValueState

    def _state(self, name):
        def call(what):
            def run(*args):
                self.calls += 1
                if what in ("update", "put"):
                    self.values[name] = args[0]
                return self.values.get(name, () if what in ("iterator", "get") and name != "kept" else None)

            return run

        return type("State", (), {w: staticmethod(call(w)) for w in ("exists", "get", "update", "put", "clear", "iterator", "updateValue", "removeKey")})()


def test_a_stream_calls_its_state_twice_whatever_it_holds():
    import json

    import pandas as pd

    def told(tick):
        return json.dumps({"objects": [{"key": k, "side": k % 2, "effects": ["a"] * (k % 3)} for k in range(tick, tick + 50)], "births": [{"key": k, "side": k % 2} for k in range(tick, tick + 50)], "damage": [{"sequence": tick, "source": tick, "amount": 1.5}]})

    handle, out = Counted(), []
    for ticks in ((1, 2, 3), (4, 5)):  # two micro-batches
        stream = assembler.Assembler(5, 5, None, None)
        stream.init(handle)
        frames = [pd.DataFrame([(1, t, t, told(t))], columns=["stream", "line", "tick", "told"]) for t in reversed(ticks)]
        out += [r for d in stream.handleInputRows((1,), iter(frames), None) for r in d.itertuples(index=False)]
    assert handle.calls <= 4
    assert [(r.tick, r.key, r.side, r.other, r.amount) for r in out if r.kind == "frame"] == [(5, 25, 0, 25, 3.0), (5, 25, 1, 25, 4.5)]
    assert sorted((r.tick, r.key) for r in out if r.kind == "despawn") == [(t, t - 1) for t in range(2, 6)]
