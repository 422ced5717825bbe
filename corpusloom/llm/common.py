"""What the operators of this subpackage share: shared folders, staged tables, tokenizer paths."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ship

_STAGED: list[tuple[object, object]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where that is unset, as in tests on one machine, a local folder is
    taken and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, removed when this process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _STAGED.append((hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())))
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that no later step reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _remove_staged() -> None:
    for path, system in _STAGED:
        try:
            system.delete(path, True)
        except Exception:  # the JVM may be gone already
            return


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Later steps reread these files instead of computing ``df`` anew, also when
    an executor is lost.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


#: Rows that go to a Python worker at once, the same for every operator; Spark bounds their bytes as well.
BATCH = 1000


def prepare(spark: SparkSession) -> None:
    """Get a session ready for operators with Python workers.

    Bounds the rows of a batch, for long texts, and sends this package to the
    executors, once for each Spark context.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) != BATCH:
        spark.conf.set(key, str(BATCH))
    ship(spark)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def only(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` with just the named columns under new names, so that no other column can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])
