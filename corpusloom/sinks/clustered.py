"""Relations laid out by key: files of disjoint ranges, each in order, with the range of each in a small table.

A scan of a key or a range asks that table for its files and reads no others,
and gets each file's rows as they are sorted. A key of very many rows has
several files, which follow each other in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.gates import Refused

RANGES = "_ranges"


def write(rows: DataFrame, folder: str, key: str, order: Sequence[str], files: int | None = None) -> int:
    """Write a relation by ranges of key and order; returns the number of files. A null key is refused."""
    spark = rows.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order).write.mode("errorifexists").parquet(f"{folder}/data"))
    ranges_of(spark.read.parquet(f"{folder}/data"), key).coalesce(1).write.parquet(f"{folder}/{RANGES}")
    known = spark.read.parquet(f"{folder}/{RANGES}")
    count, nulls = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("nulls"), F.lit(0))).first()
    if nulls:
        raise Refused("null-key")
    return count


def ranges_of(data: DataFrame, key: str) -> DataFrame:
    """(file, low, high, rows, nulls) of each file; the name is the file's own, so that no text is worked on row by row."""
    return data.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"))


def files_of(spark: SparkSession, folder: str, low: object, high: object) -> list[str]:
    """The files that may hold keys from low to high, in order; as many as there are, never all rows."""
    ranges = spark.read.parquet(f"{folder}/{RANGES}").filter((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
    return [f"{folder}/data/{r.file}" for r in ranges.orderBy("low", "high", "file").collect()]


def scan(spark: SparkSession, folder: str, key: str, low: object, high: object | None = None) -> DataFrame:
    """The rows of a key, or of keys from low to high. Only their files are read; a file's rows come in its order."""
    high = low if high is None else high
    schema = spark.read.parquet(f"{folder}/data").schema
    wanted = files_of(spark, folder, low, high)
    rows = spark.read.schema(schema).parquet(*wanted) if wanted else spark.createDataFrame([], schema)
    return rows.filter(F.col(key).between(F.lit(low), F.lit(high)))
