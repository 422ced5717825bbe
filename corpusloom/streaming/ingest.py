"""Structured Streaming: new captures as they arrive, replacement by key in micro-batches, and windowed counts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sinks import commits


def new_files(spark: SparkSession, folder: str, schema: T.StructType, form: str = "parquet", at_once: int = 100) -> DataFrame:
    """A stream of the rows of files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", at_once).format(form).load(folder)


def event_counts(events: DataFrame, late: str = "10 minutes", length: str = "1 hour") -> DataFrame:
    """Events of each type and window; rows later than ``late`` are left out, which bounds the state."""
    windows = F.window("ts", length)
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need a time with zone
    counted = timed.withWatermark("ts", late).groupBy(windows.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def distinct_events(events: DataFrame, key: str, late: str = "10 minutes") -> DataFrame:
    """Each event once, also if a source sends it again within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


#: Versions that readers may still be at; older data folders are removed.
KEPT = 3


def replace_partitions(root: str, key: str, order: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch that replaces rows by key in a Parquet table.

    Keys are hashed to ``buckets``. A batch reads and writes only the buckets
    that it touches, to a folder of its own, and a commit points each of them
    there; a batch that is repeated after a failure finds its number in the log
    and does nothing. Folders that none of the last versions names are removed.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        log = commits.Log(spark, root)
        if log.state().high.get("batch", -1) >= number:
            return
        bucketed = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        new = bucketed.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("_rn = 1").drop("_rn").persist()
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most ``buckets``

        def change(state: commits.State) -> commits.State:
            high, merged = state.high | {"batch": number}, new
            paths = [f"{root}/{f}" for b in touched for f in state.folders.get(str(b), ())]
            if paths:
                old = spark.read.schema(batch.schema).parquet(*paths).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
                both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
                newest = Window.partitionBy(key).orderBy(F.desc(order), F.desc("_new"))  # an older row that arrives late replaces nothing
                merged = both.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn", "_new")
            folder = f"data/{uuid.uuid4().hex}"
            if touched:
                merged.write.partitionBy("bucket").parquet(f"{root}/{folder}")
            return commits.State(0, state.folders | {str(b): [f"{folder}/bucket={b}"] for b in touched}, {"table": json.loads(batch.schema.json())}, high, f"batch {number}")

        log.commit(change)
        new.unpersist()
        log.vacuum(KEPT)

    return write


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The table that replace_partitions keeps, as of its newest version; None before the first batch."""
    state = commits.Log(spark, root).state()
    if not state.version:
        return None
    schema = T.StructType.fromJson(state.schemas["table"])
    paths = [f"{root}/{f}" for some in state.folders.values() for f in some]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
