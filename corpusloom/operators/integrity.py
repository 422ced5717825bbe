"""Joins and key checks that guard a relational load. Each check returns the rows that violate it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_SAFE = 9007199254740991


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose key is set and has no parent. The parent's key is unique, so a plain anti join is equal to NOT IN and needs no null handling."""
    keyed = children.filter(F.col(child_key).isNotNull())
    return keyed.join(parents.select(F.col(parent_key).alias("_pk")), F.col(child_key) == F.col("_pk"), "left_anti")


def foreign_key_violations(links: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(constraint, n) for each (name, child, child key, parent, parent key) that has orphans."""
    found = [orphans(c, p, ck, pk).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("constraint"), "n") for name, c, ck, p, pk in links]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def not_listed(rows: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows whose key isn't in the list. Unlike NOT IN over an empty list of nulls, an empty list lets every row through."""
    return rows.join(listed.select(F.col(listed_key).alias("_lk")).distinct(), F.col(key) == F.col("_lk"), "left_anti")


def dependants(children: DataFrame, child_keys: Sequence[str], parents: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """One row: the number of children that refer to a row of ``parents`` by the (composite) key."""
    on = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(child_keys)]
    named = parents.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_keys)]).distinct()
    return children.join(named, on, "left_semi").agg(F.count(F.lit(1)).alias("n_dependants"))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def shared_namespace(tables: Sequence[tuple[DataFrame, Column, Column]]) -> DataFrame:
    """(owner, id, n) for ids that several of the tables, or several rows of one, use within one owner. Null ids are no ids."""
    every = None
    for df, owner, ident in tables:
        part = df.select(owner.alias("owner"), ident.alias("id")).filter("id is not null")
        every = part if every is None else every.unionByName(part)
    return repeated_keys(every, ["owner", "id"])


def not_increasing(rows: DataFrame, partition: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value isn't greater than that of the row before them."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return rows.withColumn("_before", F.lag(value).over(w)).filter(F.col("_before").isNotNull() & (F.col(value) <= F.col("_before"))).drop("_before")


def not_contiguous(rows: DataFrame, partition: Sequence[str], order: Sequence[str], ordinal: str) -> DataFrame:
    """Rows whose ordinal isn't their position from 0."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return rows.withColumn("_at", F.row_number().over(w) - 1).filter(~F.col("_at").eqNullSafe(F.col(ordinal))).drop("_at")


def positional_differences(left: DataFrame, right: DataFrame, partition: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Positions at which two ordered lists differ, or which only one has: partition, position, and the side's presence.

    Both lists are numbered by the same keys, so that the join needs no
    further exchange after the windows'.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    a = left.select(*partition, F.row_number().over(w).alias("position"), F.struct(*fields).alias("_a"))
    b = right.select(*partition, F.row_number().over(w).alias("position"), F.struct(*fields).alias("_b"))
    joined = a.join(b, [*partition, "position"], "full_outer")
    differs = ~F.col("_a").eqNullSafe(F.col("_b"))
    return joined.filter(differs).select(*partition, "position", F.col("_a").isNotNull().alias("in_left"), F.col("_b").isNotNull().alias("in_right"))


def compare_keyed(expected: DataFrame, actual: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, problems): missing, unexpected, or the names of the fields that differ, for each key with a problem."""
    e = expected.select(F.col(key).alias("_ek"), *[F.col(f).alias(f"_e_{f}") for f in fields])
    a = actual.select(F.col(key).alias("_ak"), *[F.col(f).alias(f"_a_{f}") for f in fields])
    joined = e.join(a, F.col("_ek") == F.col("_ak"), "full_outer")
    both = F.col("_ek").isNotNull() & F.col("_ak").isNotNull()
    notes = [F.when(F.col("_ak").isNull(), "missing"), F.when(F.col("_ek").isNull(), "unexpected")]
    notes += [F.when(both & ~F.col(f"_e_{f}").eqNullSafe(F.col(f"_a_{f}")), f) for f in fields]
    return joined.select(F.coalesce("_ek", "_ak").alias(key), F.array_join(F.array_compact(F.array(*notes)), ",").alias("problems")).filter("problems <> ''")


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, as a map filled in order keeps it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def multiset_minus(rows: DataFrame, budget: DataFrame) -> DataFrame:
    """Rows left when each row of the budget takes one equal row away."""
    return rows.exceptAll(budget)


def marker_bijection(lines: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """(key, violation) where lines and events don't meet one to one: unknown, lost, repeated_line, repeated_event."""
    a = lines.groupBy(F.col(key).alias("_l")).agg(F.count(F.lit(1)).alias("_nl"))
    b = events.groupBy(F.col(key).alias("_e")).agg(F.count(F.lit(1)).alias("_ne"))
    joined = a.join(b, F.col("_l") == F.col("_e"), "full_outer")
    what = F.when(F.col("_e").isNull(), "unknown").when(F.col("_l").isNull(), "lost").when(F.col("_nl") > 1, "repeated_line").when(F.col("_ne") > 1, "repeated_event")
    return joined.select(F.coalesce("_l", "_e").alias(key), what.alias("violation")).filter("violation is not null")


def contained_in(points: DataFrame, spans: DataFrame, partition: str, point: str, start: str, end: str) -> DataFrame:
    """Points strictly inside a span of their partition, spans not overlapping.

    The last span that starts before a point is found with a window instead of
    a range join, so that the work grows with rows and not with pairs.
    """
    rows = points.select(F.col(partition), F.col(point).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_s"), F.lit(None).cast("long").alias("_end"))
    opens = spans.select(F.col(partition), F.col(start).alias("_at"), F.lit(0).alias("_side"), F.col(start).cast("long").alias("_s"), F.col(end).cast("long").alias("_end"))
    w = Window.partitionBy(partition).orderBy("_at", F.desc("_side")).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.unionByName(opens).withColumn("_from", F.last("_s", True).over(w)).withColumn("_to", F.last("_end", True).over(w))
    return found.filter("_side = 1 and _from < _at and _at < _to").select(partition, F.col("_at").alias(point), F.col("_from").alias(start), F.col("_to").alias(end))
