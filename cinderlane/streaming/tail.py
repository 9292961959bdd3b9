"""Collection from the end of a growing index: new lines validated, deduplicated and routed, up to a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlane.sources import archives
from cinderlane.streaming.incremental import validated


def collect(spark: SparkSession, path: str, out: str, schema: str, key: str, ts: str, rules: dict[str, Column], delay: str = "1 day", part_bytes: int = archives.PART_BYTES) -> None:
    """Read what the index (JSON lines below path) has gained since the last call with this folder, and write its rows to
    out/accepted and out/rejected (with reasons), a folder for each batch.

    schema names the fields, key the tag that is taken once while its time ts is within the watermark's delay, rules the
    reasons to reject. Lines that aren't JSON objects are rejected as unreadable. Offsets and seen tags are in out/state:
    a run that failed begins its last batch again and replaces what it wrote, so nothing is lost or written twice.
    """
    lines = archives.register(spark).readStream.format("tail").option("partBytes", part_bytes).load(path)
    read = lines.withColumn("_r", F.from_json("line", schema)).withColumn("_bad", F.col("_r").isNull() | F.col(f"_r.{key}").isNull())
    rows = read.select("path", "offset", F.when(F.col("_bad"), F.col("line")).alias("line"), "_r.*", "_bad").withColumn(ts, F.coalesce(F.col(ts), F.current_timestamp()))
    # what can't be read has no tag: its place stands for it
    tag = F.when(F.col("_bad"), F.concat("path", F.lit("#"), F.col("offset").cast("string"))).otherwise(F.concat(F.lit("="), F.col(key).cast("string")))
    once = rows.withColumn("_tag", tag).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["_tag"])
    checked = validated(once, {"unreadable": F.col("_bad"), **{n: ~F.col("_bad") & c for n, c in rules.items()}}).drop("_bad", "_tag")

    def route(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, wanted in (("accepted", F.col("accepted")), ("rejected", ~F.col("accepted"))):
            batch.filter(wanted).drop("accepted").write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        batch.unpersist()

    query = checked.writeStream.foreachBatch(route).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def progress(spark: SparkSession, out: str, target: int) -> DataFrame:
    """One row: accepted, rejected, target, missing (how many are still wanted), done, and the reasons of rejections with
    their counts, most frequent first."""
    a, r = (spark.read.option("recursiveFileLookup", True).parquet(f"{out}/{name}") for name in ("accepted", "rejected"))
    reasons = r.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    listed = reasons.agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "reason"))), lambda x: F.struct(x["reason"].alias("reason"), (-x["m"]).alias("n"))).alias("reasons"))
    counts = a.agg(F.count(F.lit(1)).alias("accepted")).crossJoin(r.agg(F.count(F.lit(1)).alias("rejected"))).crossJoin(listed)  # three single rows
    missing = F.greatest(F.lit(target) - F.col("accepted"), F.lit(0))
    return counts.select("accepted", "rejected", F.lit(target).alias("target"), missing.alias("missing"), (missing == 0).alias("done"), "reasons")
