"""Loops over DataFrames: where a round's rows are written so that the next one doesn't plan it again."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def cut(rows: DataFrame) -> DataFrame:
    """rows, written to the checkpoint folder now. Where none is set, a local session gets a temporary one; on a cluster
    spark.checkpoint.dir has to name a folder that the driver and all executors share."""
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
    return rows.checkpoint()


def cut_dealt(rows: DataFrame) -> DataFrame:
    """cut for rows that the next steps want dealt as they are: only a plan that isn't adaptive tells how its rows are
    dealt, so this one is planned and run without adaption."""
    conf, name = rows.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return cut(rows)
    finally:
        conf.set(name, before)
