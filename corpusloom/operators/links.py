"""The links between relations as data: their order, a review of them, and deletes that follow them.

A delete goes through the relations level by level, parents first, so that each
relation is read once however many links lead to it. What goes on a level is
known by its keys, which are checkpointed, so that the plan doesn't grow with
the levels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import integrity, loading

#: What happens to a child when its parent goes.
CASCADE, SET_NULL, RESTRICT = "cascade", "null", "restrict"


@dataclass(frozen=True)
class Link:
    """Keys of a child that refer to keys of a parent."""

    name: str
    child: str
    child_keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]
    action: str = CASCADE


class Cycle(ValueError):
    """Links that lead back to where they begin; says over which relations."""


def levels(links: Sequence[Link], relations: Sequence[str]) -> list[list[str]]:
    """Relations by level: each after all that it refers to. Links of a relation to itself don't count; other cycles raise Cycle."""
    parents = {r: {k.parent for k in links if k.child == r and k.parent != r} for r in relations}
    unknown = {k.name for k in links if k.child not in parents or k.parent not in parents}
    if unknown:
        raise ValueError(f"links of unknown relations: {', '.join(sorted(unknown))}")
    out: list[list[str]] = []
    left = dict(parents)
    while left:
        free = sorted(r for r, above in left.items() if not above & left.keys())
        if not free:
            raise Cycle(" -> ".join(_circle(left)))
        out.append(free)
        left = {r: above for r, above in left.items() if r not in free}
    return out


def _circle(left: dict[str, set[str]]) -> list[str]:
    """A cycle among relations of which each has a parent among them."""
    path = [min(left)]
    while True:
        above = min(left[path[-1]] & left.keys())
        if above in path:
            return [*path[path.index(above) :], above]
        path.append(above)


def review(spark: SparkSession, found: Sequence[Link], reviewed: Sequence[Link]) -> DataFrame:
    """(name, problems) of links that aren't the reviewed ones: missing, unexpected, or the fields that differ."""
    kind = "name string, child string, child_keys string, parent string, parent_keys string, action string"
    table = lambda some: spark.createDataFrame([(k.name, k.child, ",".join(k.child_keys), k.parent, ",".join(k.parent_keys), k.action) for k in some], kind)
    return integrity.compare_keyed(table(reviewed), table(found), "name", ["child", "child_keys", "parent", "parent_keys", "action"])


def violations(tables: dict[str, DataFrame], links: Sequence[Link]) -> DataFrame:
    """(name, n) of children without parent for each link, a null in any key being no reference."""
    out = None
    for k in links:
        keyed = tables[k.child].select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(k.child_keys)]).na.drop()
        parents = tables[k.parent].select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(k.parent_keys)])
        on = [F.col(f"_c{i}") == F.col(f"_p{i}") for i in range(len(k.child_keys))]
        part = keyed.join(parents, on, "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit(k.name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Deleted:
    """What a delete leaves, how it got there, and what forbids it."""

    tables: dict[str, DataFrame]
    report: DataFrame
    refused: DataFrame


def delete(tables: dict[str, DataFrame], links: Sequence[Link], root: str, condition: Column) -> Deleted:
    """Delete the rows of ``root`` for which a condition holds, and follow the links.

    Children go with their parents (cascade), lose the reference (null) or
    forbid the delete (restrict), unless they go themselves. ``report`` has
    (relation, level, gone, changed, left); ``refused`` (name, n) of the links
    that forbid it: if it has a row, the tables are to be left as they were.
    """
    spark = tables[root].sparkSession
    gone: dict[str, DataFrame] = {}
    out, report, refused = dict(tables), None, None
    for level, relations in enumerate(levels(links, list(tables))):
        for name in relations:
            mine = [k for k in links if k.child == name and k.parent != name and k.parent in gone]
            rows = tables[name].withColumn("_gone", F.coalesce(condition, F.lit(False)) if name == root else F.lit(False))
            for i, k in enumerate(mine):
                keys = gone[k.parent].select(*[F.col(c).alias(f"_p{j}") for j, c in enumerate(k.parent_keys)]).distinct().withColumn(f"_hit{i}", F.lit(True))
                on = [F.col(c) == F.col(f"_p{j}") for j, c in enumerate(k.child_keys)]
                rows = rows.join(keys, on, "left").drop(*[f"_p{j}" for j in range(len(k.parent_keys))])
                hit = F.coalesce(F.col(f"_hit{i}"), F.lit(False))
                rows = rows.withColumn(f"_hit{i}", hit).withColumn("_gone", F.col("_gone") | hit if k.action == CASCADE else F.col("_gone"))
            if name != root and not mine:
                continue
            for k in (k for k in links if k.child == k.parent == name and k.action == CASCADE):
                rows = _with_descendants(rows, k)
            stays = ~F.col("_gone")
            lose = {c: F.col(f"_hit{i}") for i, k in enumerate(mine) if k.action == SET_NULL for c in k.child_keys}
            changed = F.lit(False)
            for c in lose.values():
                changed = changed | c
            rows = rows.withColumn("_changed", changed & stays).checkpoint()
            for i, k in enumerate(mine):
                if k.action == RESTRICT:
                    part = rows.filter(F.col(f"_hit{i}") & stays).agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.lit(k.name).alias("name"), "n")
                    refused = part if refused is None else refused.unionByName(part)
            needed = sorted({c for k in links if k.parent == name for c in k.parent_keys})
            gone[name] = rows.filter("_gone").select(*needed) if needed else rows.filter("_gone").select(F.lit(1).alias("_one"))
            told = rows.agg(F.count_if("_gone").alias("gone"), F.count_if("_changed").alias("changed"), F.count_if(stays).alias("left")).select(F.lit(name).alias("relation"), F.lit(level).alias("level"), "gone", "changed", "left")
            report = told if report is None else report.unionByName(told)
            out[name] = rows.filter(stays).select(*[F.when(~lose[c], F.col(c)).alias(c) if c in lose else F.col(c) for c in tables[name].columns])
    none = spark.createDataFrame([], "name string, n long")
    return Deleted(out, report, none if refused is None else refused)


def _with_descendants(rows: DataFrame, link: Link) -> DataFrame:
    """Rows whose ancestors in the same relation go, go as well; one key."""
    (child,), (parent,) = link.child_keys, link.parent_keys
    edges = rows.filter(F.col(child).isNotNull()).select(F.col(child).alias("src"), F.col(parent).alias("dst"))
    reached = loading.closure(edges, rows.filter("_gone").select(F.col(parent).alias("node"))).select(F.col("node").alias("_node")).distinct()
    return rows.join(reached.withColumn("_down", F.lit(True)), F.col(parent) == F.col("_node"), "left").withColumn("_gone", F.col("_gone") | F.coalesce("_down", F.lit(False))).drop("_node", "_down")
