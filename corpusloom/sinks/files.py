"""Small files written as they are: a file for each row, byte-for-byte copies, and JSON in fixed layouts."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(rows: DataFrame, folder: str, name: str = "name", data: str = "data") -> DataFrame:
    """Write each row's bytes to a file of its name, by a rename at the end, so that a task that runs again leaves the same; (name, sha256, bytes). Names are unique and have no folders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pa.fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            out = []
            for file, value in zip(batch.column("name"), batch.column("data"), strict=True):
                file, value = file.as_py(), value.as_py() or b""
                staged = f"{base}/.{attempt}-{file}"
                with system.open_output_stream(staged, compression=None) as sink:
                    sink.write(value)
                system.move(staged, f"{base}/{file}")
                out.append((file, hashlib.sha256(value).hexdigest(), len(value)))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else ([], [], []), (pa.string(), pa.string(), pa.int64()), strict=True)], names=["name", "sha256", "bytes"])

    return rows.select(F.col(name).alias("name"), F.col(data).cast("binary").alias("data")).mapInArrow(run, "name string, sha256 string, bytes long")


def copied(spark: SparkSession, source: str, target: str) -> None:
    """A file copied byte for byte, by the cluster's file systems; an existing target is replaced."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)


def one_entry_a_line(head: dict[str, object], name: str, entries: Sequence[dict]) -> str:
    """A JSON object with a list of which each entry has a line of its own, two spaces of indent for each level, and a line feed at the end."""
    say = lambda v: json.dumps(v, ensure_ascii=False)
    lines = [f"  {say(k)}: {say(v)}," for k, v in head.items()]
    listed = ",\n".join(f"    {say(e)}" for e in entries)
    return "\n".join(["{", *lines, f"  {say(name)}: [" + (f"\n{listed}\n  ]" if entries else "]"), "}"]) + "\n"


def pretty(value: object) -> str:
    """JSON with two spaces of indent and a line feed at the end."""
    return json.dumps(value, ensure_ascii=False, indent=2) + "\n"
