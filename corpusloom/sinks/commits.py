"""A commit log over the relations of a folder: numbered versions, one writer each, and ids that are never given twice.

Each entry of the log is a file named by its number, and only one writer can
create it. An entry has the whole state (the data folders of each relation and
the highest id that each ever gave), so that one entry tells a reader all. A
writer stages its data in folders of its own, then tries to create the next
entry; if another was first it looks at the new state, decides again and tries
again. Data folders are never changed once an entry names them.

The file system has to create a name for one writer only: local folders do by
links, HDFS and the like by a rename that replaces nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators import links, loading
from corpusloom.operators.gates import Refused

#: Times that a writer tries again after another was first.
ATTEMPTS = 20


@dataclass
class State:
    """What a version is: the data folders of each relation in order, the schema of each, and the highest id that each gave."""

    version: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    high: dict[str, int] = field(default_factory=dict)
    note: str = ""

    def text(self) -> str:
        return json.dumps({"version": self.version, "folders": self.folders, "schemas": self.schemas, "high": self.high, "note": self.note}, sort_keys=True)


#: Takes the state that a writer builds on and says what it becomes; called again after a conflict.
Change = Callable[[State], State]


class Log:
    """The versions of a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/_log"))

    def versions(self) -> list[int]:
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.root}/_log"))]
        return sorted(int(n[:20]) for n in names if n.endswith(".json") and n[:20].isdigit())

    def state(self, version: int | None = None) -> State:
        """The newest state, or that of a version; an empty one before the first."""
        known = self.versions()
        if version is None and not known or version == 0:
            return State()
        wanted = known[-1] if version is None else version
        if wanted not in known:
            raise Refused("version-missing")
        rows = self.spark.read.text(self._name(wanted), wholetext=True).first()
        try:
            return State(**json.loads(rows[0]))
        except (TypeError, ValueError):
            raise Refused("version-unreadable") from None

    def _name(self, version: int) -> str:
        return f"{self.root}/_log/{version:020d}.json"

    def _create(self, version: int, text: str) -> bool:
        """Whether this writer was the one to create an entry; its text is there as a whole or not at all."""
        staged = f"{self.root}/_log/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(staged), True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            return self._claim(staged, self._name(version))
        finally:
            self._fs.delete(self._path(staged), False)

    def _claim(self, staged: str, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        if self._fs.getScheme() != "file":
            return not self._fs.exists(self._path(name)) and self._fs.rename(self._path(staged), self._path(name))
        local = lambda p: jvm.java.nio.file.Path.of(self._path(p).toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
        try:
            jvm.java.nio.file.Files.createLink(local(name), local(staged))
        except Exception as why:
            if "FileAlreadyExistsException" in str(why):
                return False
            raise
        return True

    def commit(self, change: Change, attempts: int = ATTEMPTS) -> State:
        """Make the next version from the newest one; with a conflict again from the one that came between."""
        for _ in range(attempts):
            before = self.state()
            after = change(before)
            after.version = before.version + 1
            if self._create(after.version, after.text()):
                return after
        raise Refused("conflict")

    def stage(self, rows: DataFrame, relation: str) -> str:
        """Write rows to a data folder that no entry names yet."""
        folder = f"{relation}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        return folder

    def read(self, relation: str, state: State | None = None) -> DataFrame:
        """A relation as of a state, by default the newest."""
        state = self.state() if state is None else state
        if relation not in state.schemas:
            raise Refused("relation-missing")
        schema = T.StructType.fromJson(state.schemas[relation])
        paths = [f"{self.root}/{f}" for f in state.folders.get(relation, ())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def append(self, relation: str, rows: DataFrame, ids: str | None = None, order: str | None = None) -> State:
        """Add rows; with ``ids`` they are numbered on from the highest id that the relation ever gave, in the order of ``order``, which is unique.

        Rows are dealt by ranges of ``order`` and staged once; ranges are
        counted, and only a row for each range is ever in one place.
        """
        if ids is not None:
            ranged = self.stage(rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "_ranges")
            staged = self.spark.read.parquet(f"{self.root}/{ranged}")
            n = staged.count()

        def change(state: State) -> State:
            new, high = rows, state.high.get(relation, 0)
            if ids is not None:
                new = loading.surrogate_ids(staged, "_range", order, "_range", high + 1).drop("_range").withColumnRenamed("id", ids)
                high += n
            schema = _nullable(new.schema)
            if relation in state.schemas and state.schemas[relation] != schema:
                raise Refused("schema")
            folder = self.stage(new, relation)
            return State(0, state.folders | {relation: [*state.folders.get(relation, []), folder]}, state.schemas | {relation: schema}, state.high | {relation: high}, f"append {relation}")

        try:
            return self.commit(change)
        finally:
            if ids is not None:
                self._fs.delete(self._path(f"{self.root}/{ranged}"), True)

    def rewrite(self, relation: str, make: Callable[[DataFrame], DataFrame], note: str = "rewrite") -> State:
        """Replace a relation by what ``make`` gives of it; the highest id stays what it was, also where its rows go."""

        def change(state: State) -> State:
            new = make(self.read(relation, state))
            folder = self.stage(new, relation)
            return State(0, state.folders | {relation: [folder]}, state.schemas | {relation: _nullable(new.schema)}, state.high, f"{note} {relation}")

        return self.commit(change)

    def delete(self, relation: str, condition: Column) -> State:
        """Remove the rows for which a condition holds; rows where it is null stay."""
        return self.rewrite(relation, lambda df: df.filter(~F.coalesce(condition, F.lit(False))), "delete")

    def migrate(self, relation: str, schema: list[tuple[str, str, object]]) -> State:
        """Rebuild a relation in other columns (name, type, default): kept ones as they are, new ones with their default."""
        return self.rewrite(relation, lambda df: loading.backfill(df, schema), "migrate")

    def residue(self, keep: int = 1) -> list[str]:
        """Data folders that none of the last ``keep`` versions names: left by writers that failed or lost, or by versions gone by."""
        named = {f for v in self.versions()[-keep:] for folders in self.state(v).folders.values() for f in folders}
        out = []
        for relation in self._fs.listStatus(self._path(self.root)):
            name = relation.getPath().getName()
            if relation.isDirectory() and name != "_log":
                mine = [f"{name}/{folder.getPath().getName()}" for folder in self._fs.listStatus(relation.getPath())]
                out += [m for m in mine if not any(f == m or f.startswith(f"{m}/") for f in named)]
        return sorted(out)

    def vacuum(self, keep: int = 1) -> int:
        """Remove the residue; returns how many folders. No other writer may be staging."""
        return sum(self._fs.delete(self._path(f"{self.root}/{f}"), True) for f in self.residue(keep))

    def preflight(self, some: Sequence[links.Link], keep: int = 1) -> DataFrame:
        """(code, detail, n) of what should not be there before relations are rebuilt: residue of writers, and children without parent over the links between stored relations."""
        state = self.state()
        left = [("residue", f, 1) for f in self.residue(keep)]
        out = self.spark.createDataFrame(left, "code string, detail string, n long")
        known = [k for k in some if {k.child, k.parent} <= state.schemas.keys()]
        if known:
            tables = {r: self.read(r, state) for r in {x for k in known for x in (k.child, k.parent)}}
            lost = links.violations(tables, known).filter("n > 0")
            out = out.unionByName(lost.select(F.lit("link").alias("code"), F.col("name").alias("detail"), "n"))
        return out


def _nullable(schema: T.StructType) -> dict:
    """A schema as files have it: every column may be null."""
    return json.loads(T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).json())
