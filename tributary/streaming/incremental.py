"""Incremental loads and the labelled streaming extension."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.plans.durable import checkpoint_dir


def delta(df: DataFrame, watermark: str, since: object | None) -> DataFrame:
    """Rows whose watermark is strictly greater than what was last seen; all of them at first."""
    return df if since is None else df.filter(F.col(watermark) > F.lit(since))


def to_run(pipelines: DataFrame, datasets: DataFrame) -> DataFrame:
    """Pipelines to run after a sync: those triggered by a new dataset version that are not disabled."""
    return pipelines.filter("on_dataset_version and status <> 'disabled'").join(datasets.select("dataset").distinct(), "dataset", "left_semi")


def reset_reviews(curated: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Approved datasets that a pipeline wrote again wait for review."""
    new = refreshed.select("dataset").distinct().withColumn("__new", F.lit(True))
    return curated.join(new, "dataset", "left").withColumn("status", F.when(F.col("__new") & (F.col("status") == "approved"), "pending_review").otherwise(F.col("status"))).drop("__new")


def mappings_to_apply(mappings: DataFrame, approved: DataFrame) -> DataFrame:
    return mappings.filter("auto_apply_on_review").join(approved.filter("status = 'approved'").select("dataset"), "dataset", "left_semi")


def stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table's files as a stream."""
    path = f"{folder}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path if _is_dir(spark, path) else f"{folder}/{table}.parque[t]")


def _is_dir(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def run_available(df: DataFrame, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Runs a stream over what is available into a table in the shared folder, and reads that table."""
    spark = df.sparkSession
    at = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    if each is not None or mode != "append":
        def write(batch: DataFrame, epoch: int) -> None:
            (each or (lambda b, _: None))(batch, epoch)
            batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{at}/out")

        q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(write).start()
    else:
        q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").option("path", f"{at}/out").format("parquet").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{at}/out")


def windowed_counts(events: DataFrame, at: str, by: str, late: str = "10 minutes", size: str = "1 day") -> DataFrame:
    """Counts for each window and kind; rows later than the watermark are not counted."""
    e = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return e.groupBy(F.window(at, size), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def distinct_within(events: DataFrame, key: str, at: str, late: str = "3650 days") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([key])
