"""Cutting lineage so that it survives the loss of an executor."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is used in local mode only: on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tributary-checkpoint-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)
