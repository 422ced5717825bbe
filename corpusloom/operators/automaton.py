"""Finite automata over ordered events, by composing transition tables.

An event is a table with the state that each state goes to. Composing tables is
associative, so the events of a document are reduced part by part, in any
grouping, and the parts again, in a tree: no task needs all events of a
document, however many one has. Going down the same tree, each part is told the
state that it begins in, which gives the state at every event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Events, and parts, that are composed in one row.
FAN = 256


def table(kind: Column, transitions: dict[str, Sequence[int]], other: Sequence[int]) -> Column:
    """The table of an event by its kind: the next state for each state; kinds without one have ``other``."""
    listed = lambda t: F.array(*[F.lit(int(s)) for s in t])
    chain = F.lit(None).cast("array<int>")
    for name, to in transitions.items():
        chain = F.when(kind == name, listed(to)).otherwise(chain)
    return F.coalesce(chain, listed(other))


def _identity(states: int) -> Column:
    return F.array(*[F.lit(s) for s in range(states)])


def _then(first: Column, second: Column) -> Column:
    return F.transform(first, lambda s: F.get(second, s))


def _parts() -> Column:
    return F.array_sort(F.collect_list(F.struct("at", "step"))).alias("parts")


def _levels(events: DataFrame, doc: str, order: str, step: str, states: int, fan: int) -> tuple[list[DataFrame], int]:
    """Each level's parts (doc, at, parts), from ``fan`` events each up to one part of all for each document, and the first place."""
    low, high = events.agg(F.min(order), F.max(order)).first()
    low, span = low or 0, (high or 0) - (low or 0)
    rows = events.select(F.col(doc).alias("doc"), (F.col(order) - F.lit(low)).cast("long").alias("at"), F.col(step).alias("step"))
    out: list[DataFrame] = []
    while True:
        span //= fan
        out.append(rows.groupBy("doc", F.floor(F.col("at") / fan).cast("long").alias("_p")).agg(_parts()).select("doc", F.col("_p").alias("at"), "parts"))
        if not span:
            return out, low
        whole = F.aggregate("parts", _identity(states), lambda acc, x: _then(acc, x["step"]))
        rows = out[-1].select("doc", "at", whole.alias("step"))


def final_states(events: DataFrame, doc: str, order: str, step: str, states: int, start: int = 0, accepted: Sequence[int] | None = None, fan: int = FAN) -> DataFrame:
    """(doc, state, accepted) after all events of each document.

    ``order`` is a whole number, unique in a document; ``step`` a table of
    ``states`` entries. A document ends well in one of ``accepted``, by default
    in any.
    """
    levels, _ = _levels(events, doc, order, step, states, fan)
    state = F.aggregate("parts", F.lit(start), lambda s, x: F.get(x["step"], s))
    fine = F.lit(True) if accepted is None else F.col("state").isin(*accepted)
    return levels[-1].select(F.col("doc").alias(doc), state.alias("state")).withColumn("accepted", fine)


def states_at(events: DataFrame, doc: str, order: str, step: str, states: int, start: int = 0, fan: int = FAN) -> DataFrame:
    """``events`` with ``before`` and ``after``, the states around each; documents and orders aren't null."""
    levels, low = _levels(events, doc, order, step, states, fan)
    known = levels[-1].withColumn("state", F.lit(start))
    for below in [*reversed(levels[:-1]), None]:
        told = known.select("doc", F.inline(_walked(F.col("parts"), F.col("state"))))
        if below is not None:
            known = below.join(told.withColumnRenamed("before", "state"), ["doc", "at"])
    told = told.select(F.col("doc").alias("_doc"), (F.col("at") + F.lit(low)).alias("_at"), "before")
    keyed = events.join(told, (F.col(doc) == F.col("_doc")) & (F.col(order) == F.col("_at")))
    return keyed.withColumn("after", F.get(F.col(step), F.col("before"))).drop("_doc", "_at")


def _walked(parts: Column, state: Column) -> Column:
    """array<struct<at, before>>: the state in which each part begins."""
    first = F.struct(state.alias("s"), F.array().cast("array<struct<at:bigint,before:int>>").alias("out"))

    def one(acc: Column, x: Column) -> Column:
        here = F.struct(x["at"].alias("at"), acc["s"].alias("before"))
        return F.struct(F.get(x["step"], acc["s"]).alias("s"), F.array_append(acc["out"], here).alias("out"))

    return F.aggregate(parts, first, one, lambda acc: acc["out"])
