"""Grouped counts over parent and child relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def child_counts(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, name: str) -> DataFrame:
    """Rows of ``children`` for each parent, 0 where there are none.

    The children are counted by key first, so that the join moves one row for
    each parent whatever the number of its children; null child keys belong
    to no parent.
    """
    counted = children.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        parents.join(counted, F.col(parent_key) == F.col("_key"), "left")
        .select(*[parents[c] for c in parents.columns], F.coalesce("_n", F.lit(0)).cast("long").alias(name))
    )
