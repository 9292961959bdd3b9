"""Incremental validation and deduplication with Structured Streaming, and its batch equivalent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlane.operators import audit


def validated(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return rows.withColumn("reasons", audit.reasons(rules)).withColumn("accepted", F.size("reasons") == 0)


def dedupe_stream(stream: DataFrame, key: str, rules: dict[str, Column], ts: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Validated rows, the first of each key; with ts, keys are forgotten once the watermark passes them."""
    out = validated(stream, rules)
    if ts is None:
        return out.dropDuplicates([key])
    return out.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Write all that is available as Parquet and stop; a later run goes on from the checkpoint."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(out)
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's folder or file as a stream of files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}.parquet*")


def tumbling(stream: DataFrame, ts: str, width: str, delay: str, keys: list[str]) -> DataFrame:
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))


def assemble(stream: DataFrame, key: str, tick: str, every: int = 5) -> DataFrame:
    """Stateful frames of each episode, in order: (key, tick, frames, repeats, status). Emits every `every`-th tick.

    A repeated tick counts as a repeat, a step of more than one or backwards ends the episode as broken.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, count, repeats, status = state.get if state.exists else (-1, 0, 0, "ok")
        out = []
        ticks = sorted(t for f in frames for t in f[tick].tolist())
        for t in ticks:
            if status != "ok":
                break
            if t == last:
                repeats += 1
                continue
            if last >= 0 and t != last + 1:
                status = "broken"
                out.append((k[0], int(t), count, repeats, status))
                break
            last, count = int(t), count + 1
            if t % every == 0:
                out.append((k[0], int(t), count, repeats, status))
        state.update((last, count, repeats, status))
        yield pd.DataFrame(out, columns=[key, "tick", "frames", "repeats", "status"])

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind}, tick long, frames long, repeats long, status string", "last long, frames long, repeats long, status string", "append", "NoTimeout"
    )
