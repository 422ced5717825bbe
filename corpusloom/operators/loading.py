"""Loading relations: replace by key, backfill, surrogate ids, schema comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replace_by_key(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` without the rows whose key comes anew, and the new rows. Relations below take the same keys, which is the cascade."""
    keys = new.select(F.col(key).alias("_k")).distinct()
    return existing.join(keys, F.col(key) == F.col("_k"), "left_anti").unionByName(new)


def cascade(parents_gone: DataFrame, key: str, children: DataFrame, child_key: str) -> DataFrame:
    """Children whose parent isn't among those gone."""
    return children.join(parents_gone.select(F.col(key).alias("_k")).distinct(), F.col(child_key) == F.col("_k"), "left_anti")


def set_null(parents_gone: DataFrame, key: str, children: DataFrame, child_key: str) -> DataFrame:
    """Children with a null in place of a key that is gone."""
    gone = parents_gone.select(F.col(key).alias("_k")).distinct()
    joined = children.join(gone, F.col(child_key) == F.col("_k"), "left")
    kept = F.when(F.col("_k").isNull(), F.col(child_key)).alias(child_key)
    return joined.select(*[kept if c == child_key else F.col(c) for c in children.columns])


def backfill(rows: DataFrame, schema: Sequence[tuple[str, str, object]]) -> DataFrame:
    """Rows in the given columns (name, type, default): stored ones as they are, missing ones with their default."""
    has = set(rows.columns)
    return rows.select(*[(F.col(n) if n in has else F.lit(default)).cast(kind).alias(n) for n, kind, default in schema])


def surrogate_ids(rows: DataFrame, owner_order: str, order: str, owner: str, start: int = 1) -> DataFrame:
    """Rows with ``id``, counted in the order of owners and of rows within them.

    Rows are numbered within their owner and shifted by the owners before; only
    the owners, one row for each, are ever in a single window.
    """
    sizes = rows.groupBy(owner, owner_order).agg(F.count(F.lit(1)).alias("_n"))
    shift = F.coalesce(F.sum("_n").over(Window.orderBy(owner_order, owner).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select(F.col(owner).alias("_o"), shift.alias("_base"))
    at = F.row_number().over(Window.partitionBy(owner).orderBy(order)).cast("long") - 1 + start
    return rows.withColumn("_at", at).join(bases, F.col(owner) == F.col("_o")).withColumn("id", F.col("_at") + F.col("_base")).drop("_at", "_o", "_base")


def positions(rows: DataFrame, owner: str, order: str, reference: DataFrame, reference_id: str, reference_owner: str, reference_order: str, key: str) -> DataFrame:
    """``rows`` with ``position``, the place among its ordered siblings of the row that ``key`` refers to, or null."""
    at = F.row_number().over(Window.partitionBy(reference_owner).orderBy(reference_order)) - 1
    places = reference.select(F.col(reference_id).alias("_rid"), at.cast("long").alias("position"))
    return rows.join(places, F.col(key) == F.col("_rid"), "left").drop("_rid")


def restamp(rows: DataFrame, owner: str, *order: str) -> DataFrame:
    """Rows with ``ordinal`` from 0 in the order of fragment and place in it."""
    return rows.withColumn("ordinal", (F.row_number().over(Window.partitionBy(owner).orderBy(*order)) - 1).cast("long"))


def schema_differences(df: DataFrame, expected: T.StructType, relation: str) -> list[tuple[str, str, str]]:
    """(relation, column, problem) between a DataFrame and a schema; names are compared exactly, though Spark resolves them without case."""
    have = {f.name: f for f in df.schema.fields}
    out = []
    for f in expected.fields:
        if f.name not in have:
            near = [n for n in have if n.lower() == f.name.lower()]
            out.append((relation, f.name, "case" if near else "missing"))
        elif have[f.name].dataType != f.dataType:
            out.append((relation, f.name, "type"))
        elif have[f.name].nullable and not f.nullable:
            out.append((relation, f.name, "nullable"))
    names = {f.name for f in expected.fields}
    lower = {n.lower() for n in names}
    out += [(relation, n, "unknown") for n in have if n not in names and n.lower() not in lower]
    return out


def audited(rows: DataFrame, relation: str, spec: Sequence[tuple[str, str, bool]], key: Sequence[str]) -> DataFrame:
    """(relation, column, problem, n) where a relation isn't what a specification (name, type, may be null) and a key ask for.

    Names and types are those of the schema: missing, case, type, unknown, with
    n 0. Nulls and repeated keys are those of the rows: one aggregate for all
    columns, one grouping for the key; n counts the rows that are null and the
    keys that occur twice or more, of which a null in the key is part.
    """
    kinds = {kind: T.StructType.fromDDL(f"c {kind}")["c"].dataType for _, kind, _ in spec}
    expected = T.StructType([T.StructField(n, kinds[kind]) for n, kind, _ in spec])
    said = [(r, c, problem, 0) for r, c, problem in schema_differences(rows, expected, relation)]
    have = set(rows.columns)
    required = [n for n, _, nullable in spec if not nullable and n in have]
    told = rows.sparkSession.createDataFrame(said, "relation string, column string, problem string, n long")
    say = lambda df, column, problem: df.filter("n > 0").select(F.lit(relation).alias("relation"), column.alias("column"), F.lit(problem).alias("problem"), F.col("n").cast("long").alias("n"))
    if required:
        counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        told = told.unionByName(say(counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in required]))), F.col("c"), "null"))
    again = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").agg(F.count(F.lit(1)).alias("n"))
    return told.unionByName(say(again, F.lit(",".join(key)), "key"))


def classify_first(rows: DataFrame, rules: Sequence[tuple[Column, str]], default: str, name: str = "verdict") -> DataFrame:
    """Rows with the verdict of the first rule that holds; the order decides."""
    chain = F.when(rules[0][0], rules[0][1])
    for condition, verdict in rules[1:]:
        chain = chain.when(condition, verdict)
    return rows.withColumn(name, chain.otherwise(default))


def closure(edges: DataFrame, start: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """Nodes that are reached from ``start`` (node) over ``edges`` (src, dst), with the least number of steps.

    Breadth first: a join per level and an anti join against what was seen.
    Each level is checkpointed to the shared folder.
    """
    seen = frontier = start.select("node", F.lit(0).alias("depth")).distinct()
    for depth in range(1, most_rounds):
        step = edges.join(frontier, F.col("src") == F.col("node")).select(F.col("dst").alias("node")).distinct()
        frontier = step.join(seen.select(F.col("node").alias("_s")), F.col("node") == F.col("_s"), "left_anti").select("node", F.lit(depth).alias("depth")).checkpoint()
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
    raise RuntimeError("the closure did not settle")
