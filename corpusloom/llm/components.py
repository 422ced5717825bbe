"""Connected components and grouped tasks of bounded size, without collecting links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from corpusloom.llm.common import discard, staged

#: Rows up to which a side of a join is broadcast; beyond it Spark's shuffled join does the work.
SMALL = 200_000

#: What a task does with the columns of its rows.
Work = Callable[[dict[str, list]], list[tuple]]

#: Links as run_groups returns them.
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
PARTS = pa.schema([("node", pa.int64()), ("component", pa.int64())])


def small_or_shuffled(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """``df``, thin and staged, marked for broadcast if a count shows that it is small."""
    return counted(df, rows)[0]


def counted(df: DataFrame, rows: int = SMALL) -> tuple[DataFrame, int]:
    """The same with the number of rows, counted no further than just beyond ``rows``."""
    n = df.limit(rows + 1).count()
    return (F.broadcast(df) if n <= rows else df), n


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component) for each node of the edges (a, b); the component is its smallest node.

    Up to SMALL edges, a few megabytes, are joined up in one task. Beyond that,
    large-star and small-star steps in turn, each a grouped minimum and a join
    on the node, until the edges stay as they are. Edges are staged after each
    round; hot nodes are spread by Spark's handling of skewed joins.
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    current = staged(ordered, "edges")
    if counted(current, SMALL)[1] <= SMALL:
        return current.coalesce(1).mapInArrow(_join_up, from_arrow_schema(PARTS))
    mark = _mark(current)
    for _ in range(most_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = staged(small.unionByName(roots.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(edges.sparkSession, current._staged_path)
        current, new = after, _mark(after)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("the components did not settle")
    pairs = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of a bounded number of edges (u, v): each node points to a smaller one of its component, the smallest to itself."""
    to: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while to.setdefault(root, root) != root:
            root = to[root]
        while to[x] != root:
            to[x], x = root, to[x]
        return root

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(u), find(v)
            to[max(a, b)] = min(a, b)
    if to:
        yield pa.record_batch([pa.array(list(to), pa.int64()), pa.array([find(x) for x in to], pa.int64())], schema=PARTS)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def block_pairs(members: DataFrame, size: Column, member: Column, block: int | Column, alone: bool = False) -> DataFrame:
    """Members of groups dealt to tasks of at most about twice ``block`` rows, any two of a group in one at least.

    Adds _b, the row's block, and _i and _j, the task's blocks. A group of up
    to ``block`` rows is one task; a larger one is dealt to blocks by hash,
    with a task for each two of them, and for each by itself if ``alone``.
    """
    blocks = F.greatest(F.ceil(size / F.lit(block)).cast("int"), F.lit(1))
    rows = members.withColumn("_g", blocks).withColumn("_b", F.pmod(F.xxhash64(member, F.lit(11)), F.col("_g")).cast("int"))
    others = F.sequence(F.lit(0), F.col("_g") - 1)
    if not alone:
        others = F.when(F.col("_g") == 1, others).otherwise(F.array_remove(others, F.col("_b")))
    rows = rows.withColumn("_o", F.explode(others))
    return rows.withColumn("_i", F.least("_b", "_o")).withColumn("_j", F.greatest("_b", "_o")).drop("_g", "_o")


def linked(members: DataFrame, keys: list[str], payload: DataFrame, within: Work, across: Work, block: int, sizes: DataFrame) -> DataFrame:
    """(node, component) of what the pairs of similar members connect in each group, without all pairs of large groups.

    ``members`` has the groups' keys, ``rep`` and its weight ``w``; ``payload``,
    staged, a row for each rep; ``sizes`` the weight ``n`` of each group. ``within`` gets
    the rows of a task and returns links that connect what is connected among
    them. A group of more weight than ``block`` is dealt to tasks of about that
    weight, so that each row moves once; then only one row goes on for each
    part that is connected so far, until no more links are found. What is still
    apart is compared with the rest of its group, leaving out the largest
    part's own pairs: ``across`` gets two blocks of rows with ``side`` (0 and
    1) and part ``c``.
    """
    members = members.select(*keys, "rep", "w")
    large, some = counted(staged(sizes.select(*keys, "n").filter(F.col("n") > block), "sizes"))

    def dealt(rows: DataFrame, seed: int) -> DataFrame:
        blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1))
        rows = rows.withColumn("_b", F.pmod(F.xxhash64("rep", F.lit(seed)), blocks).cast("int")).drop("n", "w")
        return run_groups(rows.join(payload, "rep"), [*keys, "_b"], within, LINKS)

    if not some:
        return components(dealt(members.withColumn("n", F.lit(1)), 11))
    parts = staged(components(dealt(members.join(large, keys, "left"), 11)), "parts")
    rows = staged(members.join(large, keys).drop("n"), "large")
    before, together = 0, False
    for attempt in range(1, 100):
        known = rows.join(parts.select(F.col("node").alias("rep"), F.col("component").alias("_part")), "rep", "left").select(*keys, "rep", "w", F.coalesce("_part", "rep").alias("c"))
        leaders = known.groupBy(*keys, "c").agg(F.min("rep").alias("rep"), F.max("w").alias("w"), F.sum("w").alias("size"))
        apart = leaders.groupBy(*keys).agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("parts"), F.max_by("c", F.struct("size", "c")).alias("_most")).filter("parts > 1")
        apart = staged(apart, "apart")
        groups, total, most = apart.agg(F.count(F.lit(1)), F.sum("parts"), F.max("n")).first()
        if not groups:
            return parts
        apart = F.broadcast(apart) if groups <= SMALL else apart
        if together or before and total > before / 2:  # all leaders were compared, or few come together this way
            break
        before, together = total, most <= block
        leaders = staged(leaders.drop("size").join(apart.select(*keys, "n"), keys), "leaders")
        new = staged(dealt(leaders.drop("c"), 11 + attempt), "links")
        if new.isEmpty():
            break
        parts = _contracted(parts, leaders.select(F.col("rep").alias("a"), F.col("c").alias("b")).unionByName(new))
    mixed = known.join(apart.drop("n"), keys)
    weights = mixed.groupBy(*keys).agg(F.sum("w").alias("_all"), F.sum(F.when(F.col("c") != F.col("_most"), F.col("w"))).alias("_few"))
    count = lambda n: F.ceil(F.col(n) / block).cast("int")
    mixed = mixed.join(small_or_shuffled(staged(weights.select(*keys, count("_all").alias("_all"), count("_few").alias("_few")), "weights")), keys)
    at = lambda seed, n: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    few = mixed.filter("c <> _most").select(*keys, "rep", "c", F.lit(0).alias("side"), at(3, "_few").alias("_i"), every("_all").alias("_j"))
    most = mixed.select(*keys, "rep", "c", F.lit(1).alias("side"), at(5, "_all").alias("_j"), every("_few").alias("_i"))
    new = run_groups(few.unionByName(most).join(payload, "rep"), [*keys, "_i", "_j"], across, LINKS)
    found = staged(new.join(parts.select(F.col("node").alias("a"), F.col("component").alias("_a")), "a", "left").join(parts.select(F.col("node").alias("b"), F.col("component").alias("_c")), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_c", "b").alias("b")), "links")
    return parts if found.isEmpty() else _contracted(parts, found)


def _contracted(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (node, component) with some components and nodes joined by links (a, b); only those are gone through."""
    joined = staged(components(links), "joined").select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    moved = parts.join(small_or_shuffled(joined), F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_c", "component").alias("component"))
    known = parts.select(F.col("node").alias("_k"))
    alone = joined.join(known, F.col("_n") == F.col("_k"), "left_anti").select(F.col("_n").alias("node"), F.col("_c").alias("component"))
    return staged(moved.unionByName(alone), "parts")


def run_groups(rows: DataFrame, keys: list[str], work: Work, schema: pa.Schema) -> DataFrame:
    """Apply ``work`` to the columns of each group, many groups in a task without a call for each.

    The rows of a group must fit into memory; see block_pairs.
    """
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        key = None
        out: list[tuple] = []
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            marks = list(zip(*[columns[k] for k in keys], strict=True))
            start = 0
            while start < len(marks):
                end = start + 1
                while end < len(marks) and marks[end] == marks[start]:
                    end += 1
                if marks[start] != key:
                    if held:
                        out += work(held)
                    key, held = marks[start], {n: [] for n in columns}
                for n, values in columns.items():
                    held[n] += values[start:end]
                start = end
            while len(out) >= 8192:
                yield _batch(out[:8192], schema)
                out = out[8192:]
        if held:
            out += work(held)
        if out:
            yield _batch(out, schema)

    return dealt.mapInArrow(run, from_arrow_schema(schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for f, c in zip(schema, zip(*rows, strict=True), strict=True)], schema=schema)
