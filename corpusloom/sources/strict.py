"""JSON files read strictly: a Spark data source that gives a row for each file, its value or one refusal.

Files are dealt to partitions by bytes, at least one a partition; a task reads
a file, scans its bytes once and compares the value with a shape, so that
nothing that a schema would bend or drop gets through.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusloom.functions import scanner
from corpusloom.session import ship

#: Bytes of the files of a partition; larger files have one of their own.
PART_BYTES = 1 << 25
SCHEMA = "path string, json string, code string, at string, line long, `column` long, sha256 string, bytes long"
#: How a kind is called in refusals; a shape takes each value as it is or not at all.
_KINDS = {T.LongType: int, T.StringType: str, T.BooleanType: bool}


def misshapen(value: object, kind: T.DataType, path: str = "$", nullable: bool = True) -> tuple[str, str] | None:
    """(code, path) of the first place at which a value isn't of a type: keys in another order, missing or unknown ones, other kinds of values.

    A field that may be null may also be missing. Codes: keys, kind.
    """
    if value is None:
        return None if nullable else ("kind", path)
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            return "kind", path
        names = [f.name for f in kind.fields if f.name in value or not f.nullable]
        if list(value) != names:
            return "keys", path
        parts = ((value[f.name], f.dataType, path + scanner.step(f.name), f.nullable) for f in kind.fields if f.name in value)
    elif isinstance(kind, T.ArrayType):
        if not isinstance(value, list):
            return "kind", path
        parts = ((v, kind.elementType, f"{path}[{i}]", kind.containsNull) for i, v in enumerate(value))
    elif isinstance(kind, T.MapType):
        if not isinstance(value, dict):
            return "kind", path
        parts = ((v, kind.valueType, path + scanner.step(k), kind.valueContainsNull) for k, v in value.items())
    else:
        return None if type(value) is _KINDS[type(kind)] else ("kind", path)
    return next((found for p in parts if (found := misshapen(*p))), None)


@dataclass
class Files(InputPartition):
    """The files of a partition."""

    paths: tuple[str, ...]


class StrictReader(DataSourceReader):
    """Lists the files on the driver, without reading them, and reads them in tasks."""

    def __init__(self, path: str, suffix: str, shape: str | None, part_bytes: int):
        self.path, self.suffix, self.shape, self.part_bytes = path, suffix, shape, part_bytes

    def partitions(self) -> Sequence[InputPartition]:
        system, base = pa.fs.FileSystem.from_uri(self.path) if "://" in self.path else (pa.fs.LocalFileSystem(), self.path)
        info = system.get_file_info(base)
        listed = [info] if info.is_file else system.get_file_info(pa.fs.FileSelector(base, recursive=True))
        files = sorted((f.path, f.size) for f in listed if f.is_file and f.path.endswith(self.suffix) and not any(p[:1] in "._" for p in f.path.removeprefix(base).split("/") if p))
        out: list[Files] = []
        held, size = [], 0
        for path, more in files:
            if held and size + more > self.part_bytes:
                out.append(Files(tuple(held)))
                held, size = [], 0
            held.append(path)
            size += more
        return [*out, Files(tuple(held))] if held else out or [Files(())]

    def read(self, partition: Files) -> Iterator[tuple]:
        system = pa.fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else pa.fs.LocalFileSystem()
        kind = T.StructType.fromJson(json.loads(self.shape)) if self.shape else None
        shape = (lambda value, path: misshapen(value, kind, path, False)) if kind else None
        for path in partition.paths:
            with system.open_input_file(path) as source:
                data = source.read()
            yield self.row(path, data, shape)

    @staticmethod
    def row(path: str, data: bytes, shape) -> tuple:
        told = (hashlib.sha256(data).hexdigest(), len(data))
        try:
            value = scanner.scan(data, shape=shape)
        except scanner.Fault as why:
            return (path, None, why.code, why.path, why.line or None, why.column or None, *told)
        return (path, json.dumps(value, ensure_ascii=False), None, None, None, None, *told)


class StrictJson(DataSource):
    """Options: path, suffix of the names (.json), shape, a StructType as JSON, and partBytes."""

    @classmethod
    def name(cls) -> str:
        return "strictjson"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return StrictReader(self.options["path"], self.options.get("suffix", ".json"), self.options.get("shape"), int(self.options.get("partBytes", PART_BYTES)))


def read(spark: SparkSession, path: str, shape: T.StructType | None = None, suffix: str = ".json", part_bytes: int = PART_BYTES) -> DataFrame:
    """(path, json, code, at, line, column, sha256, bytes) of the JSON files below a folder, in the order of their paths within a partition.

    ``json`` is null where ``code`` says why a file is refused, with the path
    in the document and, for faults of the text, line and column.
    """
    ship(spark)
    spark.dataSource.register(StrictJson)
    reader = spark.read.format("strictjson").option("suffix", suffix).option("partBytes", part_bytes)
    return (reader.option("shape", shape.json()) if shape is not None else reader).load(path)


def values(rows: DataFrame, shape: T.StructType) -> DataFrame:
    """(path, sha256, ...) of the files that aren't refused, their fields as columns."""
    parsed = rows.filter("code is null").select("path", "sha256", F.from_json("json", shape, {"mode": "FAILFAST"}).alias("_v"))
    return parsed.select("path", "sha256", "_v.*")
