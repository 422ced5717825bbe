"""Aggregations of a load report. Sums, counts and maxima are combined on the map side by Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measures(tables: dict[str, tuple[DataFrame, Column | None]], key: str) -> DataFrame:
    """A row for each key with the rows of each table, and how many of them meet the table's condition.

    One grouped scan for each table, in place of a query for each key and
    measure.
    """
    out = None
    for name, (df, condition) in tables.items():
        aggs = [F.count(F.lit(1)).alias(f"n_{name}")] + ([F.count_if(condition).alias(f"n_{name}_set")] if condition is not None else [])
        part = df.groupBy(key).agg(*aggs)
        out = part if out is None else out.join(part, key, "full_outer")
    return out.select(key, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in out.columns if c != key])


def census(rows: DataFrame, ident: str, owner: str) -> DataFrame:
    """One row about an id column: rows, rows without id, rows with a positive one, distinct owners of these; zeros for an empty table."""
    fine = F.col(ident) > 0
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col(ident).isNull(), 1).otherwise(0)), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(fine, 1).otherwise(0)), F.lit(0)).alias("n_positive"),
        F.count_distinct(F.when(fine, F.col(owner))).alias("n_owners"),
    )


def summary_by_kind(rows: DataFrame, key: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Rows of each kind in a column of its own, and all in ``total``; kinds are fixed, so that no extra pass looks for them."""
    return rows.groupBy(key).agg(*[F.count_if(F.col(kind) == k).alias(k) for k in kinds], F.count(F.lit(1)).alias("total"))


def totals(rows: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """A row for each key and one, with a null key, for all; both from one pass."""
    return rows.rollup(key).agg(F.count(F.lit(1)).alias("n"), *[s.alias(n) for n, s in sums.items()])


def accounting(summary: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """Rows whose parts don't add up to the total."""
    return summary.filter(sum((F.col(p) for p in parts), F.lit(0)) != F.col(total))


def ordered_text(rows: DataFrame, keys: Sequence[str], order: str, text: str, separator: str = " ") -> DataFrame:
    """The texts of each key joined in order."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(lines, lambda x: x["t"]), separator).alias(text))


def pattern_ratio(documents: DataFrame, text: str, pattern: str, extracted: Column) -> DataFrame:
    """Documents in which a pattern occurs more often than units were extracted."""
    out = documents.withColumn("occurrences", F.regexp_count(F.col(text), F.lit(pattern)).cast("long")).withColumn("extracted", extracted)
    return out.filter("occurrences > extracted")
