"""Segmentation of ordered events, as windows.

Rows are (doc, line, kind, ...) with kinds H heading, A unit header, F unit
terminator, T provision header, P provision terminator. All functions need one
exchange by document; their windows share it and its sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(doc: str, line: str) -> Window:
    return Window.partitionBy(doc).orderBy(line)


def before(doc: str, line: str) -> Window:
    return _w(doc, line).rowsBetween(Window.unboundedPreceding, -1)


def islands(events: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Events with ``seg``, the number of unit terminators before them: all between two terminators share it."""
    return events.withColumn("seg", F.coalesce(F.sum((F.col("kind") == "F").cast("int")).over(before(doc, line)), F.lit(0)).cast("long"))


def units(events: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """A row for each terminator: its island's first header with its base, the headers dropped before it and those within the body.

    Islands lie within documents, so the grouping needs no exchange beyond
    that of the window.
    """
    head = F.struct(F.col(line).cast("long").alias("line"), F.col("base").alias("base"))
    end = F.struct(F.col(line).cast("long").alias("line"), F.col("base").alias("base"))
    rows = islands(events, doc, line).groupBy(doc, "seg").agg(F.max(F.when(F.col("kind") == "F", end)).alias("_end"), F.collect_list(F.when(F.col("kind") == "A", head)).alias("_heads"))
    mine = F.array_min(F.transform(F.filter("_heads", lambda h: h["base"] == F.col("_end.base")), lambda h: h["line"]))
    rows = rows.filter("_end is not null").withColumn("head_line", mine)
    n = lambda test: F.size(F.filter("_heads", test)).cast("long")
    dropped = n(lambda h: F.col("head_line").isNull() | (h["line"] < F.col("head_line")))
    within = n(lambda h: F.coalesce(h["line"] > F.col("head_line"), F.lit(False)))
    return rows.select(doc, "seg", "head_line", F.col("_end.line").alias("end_line"), F.col("_end.base").alias("end_base"), dropped.alias("n_dropped"), within.alias("n_within"))


def last_heading(events: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Events with the line of the last heading before them, or null."""
    return events.withColumn("heading_line", F.last(F.when(F.col("kind") == "H", F.col(line)), True).over(before(doc, line)))


def tree_parent(headings: DataFrame, levels: int = 4, doc: str = "doc", line: str = "line") -> DataFrame:
    """Headings with ``parent_line``: the most recent one at a shallower level."""
    last = [F.last(F.when(F.col("level") == k, F.col(line)), True).over(before(doc, line)) for k in range(levels)]
    candidates = [F.when(F.col("level") > k, last[k]) for k in range(levels)]
    return headings.withColumn("parent_line", F.greatest(*candidates))


def tree_path(headings: DataFrame, label: str, levels: int = 4, doc: str = "doc", line: str = "line") -> DataFrame:
    """Headings with ``path``: the labels from the root down to the heading itself.

    The last heading of each level counts only if it is more recent than
    every shallower one.
    """
    upto = _w(doc, line).rowsBetween(Window.unboundedPreceding, 0)
    out = headings
    for k in range(levels):
        out = out.withColumn(f"_p{k}", F.last(F.when(F.col("level") == k, F.struct(F.col(line).alias("l"), F.col(label).alias("t"))), True).over(upto))
    parts: list[Column] = []
    for k in range(levels):
        live = F.col("level") >= k
        for j in range(k):
            live = live & (F.col(f"_p{j}").isNull() | (F.col(f"_p{j}.l") < F.col(f"_p{k}.l")))
        parts.append(F.when(live, F.col(f"_p{k}.t")))
    return out.withColumn("path", F.array_join(F.array_compact(F.array(*parts)), " / ")).drop(*[f"_p{k}" for k in range(levels)])


def next_terminator(events: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Provision headers with the line of their terminator, which must be the next event, else -1."""
    w = _w(doc, line)
    out = events.withColumn("_k", F.lead("kind").over(w)).withColumn("_l", F.lead(line).over(w))
    end = F.when(F.col("_k") == "P", F.col("_l")).otherwise(F.lit(-1)).cast("long")
    return out.filter("kind = 'T'").withColumn("terminator_line", end).withColumn("body_end", F.col("_l")).drop("_k", "_l")


def span_since_terminator(events: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Terminators with the first and last line since the terminator before them."""
    ends = events.filter(F.col("kind").isin("F", "P"))
    previous = F.lag(line).over(_w(doc, line))
    return ends.withColumn("from_line", F.coalesce(previous + 1, F.lit(0)).cast("long")).withColumn("to_line", (F.col(line) - 1).cast("long"))


def body_start(events: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Unit headers with the first line after the unit terminator before them, 0 at the start."""
    last = F.max(F.when(F.col("kind") == "F", F.col(line))).over(before(doc, line))
    return events.withColumn("start_line", F.coalesce(last + 1, F.lit(0)).cast("long")).filter("kind = 'A'")


def label_peek(events: DataFrame, lines: DataFrame, is_label: Column, doc: str = "doc", line: str = "line") -> DataFrame:
    """Headings with the text of the next line where that is no event and looks like a label."""
    w = _w(doc, line)
    heads = events.withColumn("_next", F.lead(line).over(w)).filter("kind = 'H'")
    free = F.col("_next").isNull() | (F.col("_next") > F.col(line) + 1)
    follow = lines.filter(is_label).select(F.col(doc).alias("_d"), (F.col(line) - 1).alias("_at"), F.col("text").alias("display_label"))
    joined = heads.join(follow, (F.col(doc) == F.col("_d")) & (F.col(line) == F.col("_at")) & free, "left")
    return joined.drop("_next", "_d", "_at")


def owned_candidates(events: DataFrame, candidates: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Candidate headers for which the next event or candidate is the terminator of their own base."""
    both = events.select(doc, line, "kind", "base").unionByName(candidates.select(doc, line, F.lit("C").alias("kind"), "base"))
    w = _w(doc, line)
    ahead = both.withColumn("_k", F.lead("kind").over(w)).withColumn("_b", F.lead("base").over(w))
    return ahead.filter("kind = 'C' and _k = 'F' and _b = base").drop("_k", "_b", "kind")


def front_matter(lines: DataFrame, events: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Lines before the first unit header that are no heading or provision; all such lines where there is no header."""
    first = events.groupBy(F.col(doc).alias("_d")).agg(F.min(F.when(F.col("kind") == "A", F.col(line))).alias("_first"))
    used = events.filter(F.col("kind").isin("H", "T")).select(doc, line)
    kept = lines.join(first, F.col(doc) == F.col("_d"), "left").filter(F.col("_first").isNull() | (F.col(line) < F.col("_first"))).drop("_d", "_first")
    return kept.join(used, [doc, line], "left_anti")
