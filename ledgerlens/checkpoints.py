"""Frames written to the folder that all executors share, cut off from the plans that made them."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that deletes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_checkpoints(spark: SparkSession) -> None:
    """Make DataFrame.checkpoint() usable: the cluster's shared folder; on one machine, a temporary one where none is set."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ledgerlens-"))


def saved(df: DataFrame) -> DataFrame:
    """The frame, computed once and written to the checkpoint folder.

    A checkpoint carries on Spark's estimate of its size, which joins multiply from round to round; so the rows become a
    frame of their own, without an estimate, and adaptive execution goes by sizes as they are.
    """
    shared_checkpoints(df.sparkSession)
    done = df.checkpoint()._jdf
    return DataFrame(df.sparkSession._jsparkSession.internalCreateDataFrame(done.queryExecution().toRdd(), done.schema(), False), df.sparkSession)


def saved_alone(df: DataFrame) -> DataFrame:
    """As saved; nothing reads the shuffles behind the frame again, so Spark deletes their files once it is written.

    The plan is a copy: one that df itself has run keeps its shuffles.
    """
    conf = df.sparkSession.conf
    was = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return saved(df.select("*"))
    finally:
        conf.set(CLEANUP, was)
