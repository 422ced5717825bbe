"""Gates of a release: each is a DataFrame of violations (code, norma_id, ordinal, detail); all must be empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import hashing
from corpusloom.functions.numbers import is_canonical
from corpusloom.functions.text import substantive
from corpusloom.operators import identity, integrity

MAX_SAFE = integrity.MAX_SAFE
#: Columns that tell the generations of a schema apart.
SECOND = {"article": ("source_unit_id",), "transitory_provision": ("source_unit_id",), "source_gap": ("reason",), "norma_front_matter": ("present",)}
LEVELS = {"libro": 0, "titulo": 1, "capitulo": 2, "seccion": 3}


class Refused(Exception):
    """A release that a gate stops; ``code`` is fixed and names no content."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


def violation(rows: DataFrame, code: str, norma: str = "norma_id", ordinal: str | None = None, detail: Column | None = None) -> DataFrame:
    return rows.select(F.lit(code).alias("code"), F.col(norma).cast("long").alias("norma_id"), (F.col(ordinal) if ordinal else F.lit(None)).cast("long").alias("ordinal"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def generation(tables: dict[str, DataFrame]) -> int:
    """2 if all columns of the second generation are there, by exact name, else 1."""
    return 2 if all(t in tables and set(cols) <= set(tables[t].columns) for t, cols in SECOND.items()) else 1


def blank_texts(t: dict[str, DataFrame]) -> list[DataFrame]:
    fm = t["norma_front_matter"]
    return [
        violation(t["article"].filter(~substantive(F.col("body"))), "blank-article", ordinal="doc_order"),
        violation(t["transitory_provision"].filter(~substantive(F.col("body"))), "blank-transitory", ordinal="doc_order"),
        violation(fm.filter((F.col("present") == 1) & ~substantive(F.col("body"))), "blank-front-matter"),
        violation(fm.filter(((F.col("present") == 1) != (F.col("body") != "")) | ~F.col("present").isin(0, 1)), "front-matter-state"),
    ]


def source_ids(t: dict[str, DataFrame]) -> list[DataFrame]:
    three = [t["article"], t["transitory_provision"], t["source_gap"]]
    out = [violation(df.filter(F.col("source_unit_id").isNotNull() & ~F.col("source_unit_id").between(1, MAX_SAFE)), "source-id-range", ordinal="doc_order") for df in three]
    shared = integrity.shared_namespace([(df, F.col("norma_id"), F.col("source_unit_id")) for df in three])
    out.append(violation(shared, "source-id-shared", "owner", detail=F.col("id")))
    out += [violation(df.filter("source_unit_id is null"), "coordinate-missing", ordinal="doc_order") for df in three[:2]]
    return out


def shapes(t: dict[str, DataFrame]) -> list[DataFrame]:
    nodes = t["hierarchy_node"]
    out = [violation(t["article"].filter(~is_canonical(F.col("number"))), "number", ordinal="doc_order", detail=F.col("number")), violation(nodes.filter(~F.col("kind").isin(*LEVELS)), "heading-kind", ordinal="doc_order")]
    for name in ("article", "transitory_provision", "hierarchy_node"):
        out.append(violation(integrity.not_contiguous(t[name], ["norma_id"], ["doc_order"], "doc_order"), f"order-{name}", ordinal="doc_order"))
    level = F.element_at(F.create_map(*[F.lit(x) for p in LEVELS.items() for x in p]), F.col("kind"))
    w = Window.partitionBy("norma_id").orderBy("doc_order").rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(level == k, F.struct("doc_order", "id")), True).over(w) for k in range(4)]
    nearest = F.greatest(*[F.when(level > k, last[k]) for k in range(4)])
    wrong = nodes.withColumn("_p", nearest).filter(~F.col("_p.id").eqNullSafe(F.col("parent_id")))
    out.append(violation(wrong, "heading-parent", ordinal="doc_order"))
    for name in ("article", "transitory_provision"):
        out.append(violation(integrity.orphans(t[name], nodes, "hierarchy_node_id", "id"), f"node-{name}", ordinal="doc_order"))
    return out


def keys(t: dict[str, DataFrame]) -> list[DataFrame]:
    out = [violation(integrity.repeated_keys(t["article"], ["norma_id", "number"]), "article-key", detail=F.col("number"))]
    out.append(violation(integrity.repeated_keys(t["transitory_provision"], ["norma_id", "number", "attaches_to"]), "transitory-key", detail=F.col("number")))
    out.append(violation(integrity.repeated_keys(t["source_gap"], ["norma_id", "source_unit_id"]), "gap-key", detail=F.col("source_unit_id")))
    out += [violation(integrity.orphans(t[n], t["norma"], "norma_id", "id"), f"norma-{n}") for n in ("article", "transitory_provision", "source_gap", "hierarchy_node", "norma_front_matter")]
    return out


def hashes(t: dict[str, DataFrame]) -> list[DataFrame]:
    """Stored content hashes that aren't those of the articles."""
    made = identity.content_hashes(t["article"]).withColumnRenamed("content_hash", "_made")
    joined = t["norma"].join(made, F.col("id") == F.col("norma_id"), "left")
    empty = F.lit(f"{hashing.OFFSET:016x}")
    return [violation(joined.filter(~F.coalesce("_made", empty).eqNullSafe(F.col("content_hash"))), "content-hash", "id")]


def publishable(warnings: DataFrame, approved: DataFrame, dropped: DataFrame) -> list[DataFrame]:
    """Warnings beyond the approved ones, each as often as approved, and dropped units; (doc, warning) and (doc, line, number)."""
    return [violation(integrity.multiset_minus(warnings, approved), "warning", "doc", detail=F.col("warning")), violation(dropped, "dropped", "doc", ordinal="line", detail=F.col("number"))]


def ledger_gaps(gaps: DataFrame, ledger: DataFrame) -> list[DataFrame]:
    """Gaps that differ from the ledger's in order, id, reason or caption."""
    known = ledger.filter("kind = 'known-gap'").withColumn("doc_order", F.row_number().over(Window.partitionBy("doc").orderBy("order")) - 1)
    found = integrity.positional_differences(gaps, known, ["doc"], ["doc_order"], ["source_unit_id", "reason", "caption"])
    return [violation(found, "gap-ledger", "doc", ordinal="position")]


def counts(measured: DataFrame, expected: DataFrame, fields: list[str]) -> list[DataFrame]:
    """Authorities whose measures differ from those expected, and those missing or unexpected; key norma_id."""
    return [violation(integrity.compare_keyed(expected, measured, "norma_id", fields), "measure", detail=F.col("problems"))]


def release(t: dict[str, DataFrame]) -> DataFrame:
    """All violations of the relations of a release."""
    return union([*blank_texts(t), *source_ids(t), *shapes(t), *keys(t), *hashes(t)])


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def require_none(violations: DataFrame) -> None:
    """Raise Refused with the first code, if there is a violation."""
    first = violations.orderBy("code", "norma_id", "ordinal").first()
    if first is not None:
        raise Refused(first["code"])
