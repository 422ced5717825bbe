"""Near-duplicate vectors by NN-descent.

Equal vectors are one from the start. Each vector gets a list of its nearest
neighbours. Lists start from small buckets of random hyperplane codes; then each
vector's neighbours, its reverse neighbours and itself are joined and compared
with each other, and lists take what is nearer. Links of the lists give
components. A list full of links may have lost others: its vector gets a second
list, of neighbours in other components only, and the components that those
link are joined, again and again until none of them holds a link. So no link
that was seen is lost to the length of a list. Recall is audited with a set of
queries against all vectors; while it is too low, further buckets and rounds
follow, and after the last attempt all pairs are compared in blocks. Within each
component the last step counts links in blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import prepare, staged
from corpusloom.llm.components import LINKS, block_pairs, components, run_groups, small_or_shuffled

THRESHOLD = 0.95
#: Length of a list, tables of codes to start with, vectors in a bucket, rounds of the descent.
NEIGHBOURS, TABLES, BUCKET, ROUNDS = 16, 10, 256, 2
#: Less similar vectors aren't taken into lists: two links in a row still give 0.8.
FLOOR = 0.6
#: Queries of the audit, the recall it asks for, and how often it may add tables.
QUERIES, RECALL, ATTEMPTS = 256, 0.98, 4
#: Vectors in a block where links are counted, and in components of more than GROWN blocks, so that each vector is copied to few; rows that are compared at a time.
BLOCK, GROWN, LARGE_BLOCK, TILE = 512, 8, 8192, 1024
#: Vectors in a block where all pairs are compared.
EXACT_BLOCK = 2048

_LISTS = pa.schema([("id", pa.int64()), ("found", pa.list_(pa.struct([("s", pa.float64()), ("n", pa.int64())])))])
_COUNTS = pa.schema([("id", pa.int64()), ("links", pa.int64())])


def _unpack(rows: list[bytes], wide: bool) -> np.ndarray:
    """Unit vectors in double precision, of rows of one length. Powers of two keep squares of very large and very small components finite."""
    x = np.frombuffer(b"".join(rows), np.float64 if wide else np.float32).reshape(len(rows), -1).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _by_length(rows: list[bytes]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        out.setdefault(len(r), []).append(i)
    return out


def nearest(ids: list[int], x: np.ndarray, most: int, parts: list[int]) -> list[tuple]:
    """The list of each vector among those given, without those of its own part."""
    out, ids = [], np.array(ids)
    first = np.unique(ids, return_index=True)[1]
    ids, x, c = ids[first], x[first], np.array(parts)[first]
    s = x @ x.T
    s[c[:, None] == c[None, :]] = -1
    for i in np.flatnonzero((s >= FLOOR).any(1)):
        near = np.flatnonzero(s[i] >= FLOOR)
        if len(near) > most:
            near = near[np.argsort(-s[i, near], kind="stable")[:most]]
        out.append((int(ids[i]), [{"s": float(s[i, j]), "n": int(ids[j])} for j in near]))
    return out


def _merge(lists: DataFrame) -> DataFrame:
    """One list for each id from several, the nearest first.

    Some ids are in very many lists; each partition keeps the nearest of an id
    before they meet, so that nothing grows with their number.
    """
    entries = lists.select("id", F.inline("found")).groupBy("id", "n").agg(F.max("s").alias("s"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("s"), F.desc("n")))
    nearest_of = entries.withColumn("_place", place).filter(F.col("_place") <= NEIGHBOURS)
    return nearest_of.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("s", "n")), asc=False).alias("found"))


def _sizes(nodes: DataFrame) -> dict[int, int]:
    """The number of vectors of each length in bytes, of which there are few."""
    return dict(map(tuple, nodes.groupBy(F.octet_length("x")).agg(F.count(F.lit(1))).collect()))


def _from_buckets(nodes: DataFrame, sizes: dict[int, int], tables: range, wide: bool) -> DataFrame:
    bits = {d: max(0, min(40, int(np.ceil(np.log2(max(1, n / (BUCKET / 2))))))) for d, n in sizes.items()}

    @F.pandas_udf("array<long>")
    def codes(x: pd.Series) -> pd.Series:
        rows, out = list(x), [None] * len(x)
        for d, at in _by_length(rows).items():
            v, n = _unpack([rows[i] for i in at], wide), bits[d]
            planes = [np.random.default_rng(1000 + t).normal(size=(v.shape[1], n)) for t in tables]
            weights = 1 << np.arange(n, dtype=np.int64)
            for i, code in zip(at, np.stack([(v @ p > 0) @ weights if n else np.zeros(len(v), np.int64) for p in planes], 1), strict=True):
                out[i] = code
        return pd.Series(out, dtype=object)

    coded = staged(nodes.select("id", F.octet_length("x").alias("d"), F.posexplode(codes("x")).alias("t", "code")), "codes")
    counted = coded.groupBy("t", "d", "code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    salt = F.pmod(F.xxhash64("id", "t"), F.ceil(F.col("n") / BUCKET).cast("long"))
    dealt = coded.join(counted, ["t", "d", "code"]).select("t", "d", "code", salt.alias("salt"), "id")
    rows = dealt.join(nodes, "id")
    return run_groups(rows, ["t", "d", "code", "salt"], lambda g: nearest(g["id"], _unpack(g["x"], wide), NEIGHBOURS, g["c"]), _LISTS)


def _descend(lists: DataFrame, ways: DataFrame, nodes: DataFrame, wide: bool) -> DataFrame:
    """Neighbours of neighbours: for each id its members in ``ways``, some that have it in theirs, and itself are compared."""
    forward = ways.select("id", F.explode("found.n").alias("m"))
    back = forward.groupBy(F.col("m").alias("id"), F.pmod(F.xxhash64("id", "m"), F.lit(NEIGHBOURS)).alias("salt")).agg(F.min(F.struct(F.xxhash64("id"), F.col("id").alias("m"))).alias("one"))
    joined = forward.unionByName(back.select("id", "one.m")).unionByName(ways.select("id", F.col("id").alias("m"))).distinct()
    rows = joined.withColumnRenamed("id", "at").withColumnRenamed("m", "id").join(nodes, "id")
    return _merge(lists.unionByName(run_groups(rows, ["at"], lambda g: nearest(g["id"], _unpack(g["x"], wide), NEIGHBOURS, g["c"]), _LISTS)))


def _links(lists: DataFrame) -> DataFrame:
    return lists.select(F.col("id").alias("a"), F.explode(F.filter("found", lambda e: e["s"] >= THRESHOLD)).alias("e")).select("a", F.col("e.n").alias("b"))


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    return staged(components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)), "parts")


def _beyond_full_lists(lists: DataFrame, parts: DataFrame, nodes: DataFrame, wide: bool, first: int) -> DataFrame:
    """Join components by links that full lists may have lost.

    A link is in neither list only if both are full of nearer ones, so just
    their vectors are looked at. At the end no list of neighbours in other
    components holds a link.
    """
    full = staged(lists.filter(F.get(F.col("found"), F.lit(NEIGHBOURS - 1))["s"] >= THRESHOLD).select("id"), "full")
    while True:
        c = parts.select(F.col("node").alias("id"), F.col("component").alias("c"))
        some = staged(nodes.select("id", "x").join(full, "id").join(c, "id"), "some")
        if some.select("c").distinct().limit(2).count() < 2:
            return parts
        others = staged(_merge(_from_buckets(some, _sizes(some), range(first, first + TABLES), wide)), "others")
        for _ in range(ROUNDS):
            others = staged(_descend(others, lists.unionByName(others), some, wide), "others")
        found = _links(others)
        if found.isEmpty():
            return parts
        parts, first = _joined(parts, found), first + TABLES


def _audit(nodes: DataFrame, parts: DataFrame, wide: bool) -> float:
    """The share of a query's links whose two ends are in one component, averaged over a bounded set of queries.

    Half of the queries are one member each of some components, whatever their size.
    """
    members = parts.groupBy("component").agg(F.min_by("node", F.xxhash64("node")).alias("id"))
    linked = members.orderBy(F.xxhash64("component")).limit(QUERIES // 2).select("id")
    other = nodes.select("id").orderBy(F.xxhash64("id", F.lit(3))).limit(QUERIES // 2)
    asked = nodes.join(F.broadcast(linked.union(other).distinct()), "id").select("id", "x").toPandas()  # at most QUERIES rows
    if not len(asked):
        return 1.0
    queries = {d: (_unpack([asked.x[i] for i in at], wide), asked.id.to_numpy()[at]) for d, at in _by_length(list(asked.x)).items()}

    @F.pandas_udf("array<long>")
    def links(ids: pd.Series, x: pd.Series) -> pd.Series:
        rows, out = list(x), [np.zeros(0, np.int64)] * len(x)
        for d, at in _by_length(rows).items():
            if d in queries:
                q, names = queries[d]
                for i, like in zip(at, _unpack([rows[i] for i in at], wide) @ q.T >= THRESHOLD, strict=True):
                    out[i] = names[like & (names != ids[i])]
        return pd.Series(out, dtype=object)

    true = nodes.select("id", F.explode(links("id", "x")).alias("q"))
    a = parts.select(F.col("node").alias("id"), F.col("component").alias("ca"))
    b = parts.select(F.col("node").alias("q"), F.col("component").alias("cb"))
    each = true.join(a, "id", "left").join(b, "q", "left").groupBy("q").agg(F.avg(F.coalesce(F.col("ca") == F.col("cb"), F.lit(False)).cast("int")).alias("r"))
    got = each.agg(F.avg("r")).first()[0]
    return 1.0 if got is None else got


def _crossing(group: dict[str, list], wide: bool) -> list[tuple]:
    """The pairs of components that a link between two blocks joins."""
    x, block, c = _unpack(group["x"], wide), np.array(group["_b"]), np.array(group["c"])
    a, b = np.flatnonzero(block == group["_i"][0]), np.flatnonzero(block == group["_j"][0])
    at, to = np.nonzero((x[a] @ x[b].T >= THRESHOLD) & (c[a][:, None] != c[b][None, :]))
    return sorted({(int(i), int(j)) for i, j in zip(c[a][at], c[b][to], strict=True)})


def _every_pair(nodes: DataFrame, parts: DataFrame, wide: bool) -> DataFrame:
    """The components with all links between them: all pairs of vectors are compared, in blocks."""
    known = parts.select(F.col("node").alias("id"), "component")
    rows = nodes.select("id", "x").join(known, "id", "left").select("id", "x", F.octet_length("x").alias("d"), F.coalesce("component", "id").alias("c"))
    sizes = F.create_map(*[F.lit(v) for pair in _sizes(nodes).items() for v in pair])
    dealt = block_pairs(rows, F.element_at(sizes, F.col("d")), F.col("id"), EXACT_BLOCK, alone=True)
    return _joined(parts, run_groups(dealt, ["d", "_i", "_j"], lambda g: _crossing(g, wide), LINKS))


def _count_links(group: dict[str, list], wide: bool) -> list[tuple]:
    """Links of the vectors of two blocks, or within one, as many rows at a time as keep the products small."""
    x, block = _unpack(group["x"], wide), np.array(group["_b"])
    ids, w, one = np.array(group["id"]), np.array(group["copies"]), group["_i"][0] == group["_j"][0]
    a, b = np.flatnonzero(block == group["_i"][0]), np.flatnonzero(block == group["_j"][0])
    out, others = [], np.zeros(len(b), np.int64)
    for start in range(0, len(a), TILE):
        rows = a[start : start + TILE]
        s = x[rows] @ x[b].T >= THRESHOLD
        if one:
            s[np.arange(len(rows)), np.arange(start, start + len(rows))] = False
        out += [(int(i), int(n)) for i, n in zip(ids[rows], s @ w[b], strict=True) if n]
        others += w[rows] @ s
    return out if one else out + [(int(i), int(n)) for i, n in zip(ids[b], others, strict=True) if n]


def links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links between vectors of a cosine of 0.95 or more.

    Returns vec_id, n_links, component_id, kept: a row for each row of the
    table. Vectors that are null, empty, zero, or hold null or non-finite
    components and those without id link with nothing and stay; vectors link
    with those of as many components only. Repeated rows are one vector; rows
    with equal ids and different vectors are vectors of their own that share a
    component. Other columns are ignored.
    """
    prepare(vectors.sparkSession)
    wide = "double" in vectors.schema[vector_col].dataType.simpleString()
    source = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    fine = F.coalesce(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))) & F.exists("v", lambda e: e != 0), F.lit(False))

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        return pd.Series([None if e is None else np.asarray(e, np.float64 if wide else np.float32).tobytes() for e in v], dtype=object)

    rows = source.select("vec_id", packed(F.when(fine & F.col("vec_id").isNotNull(), F.col("v"))).alias("x"))
    rows = staged(rows.withColumn("m", F.unhex(F.md5("x"))), "vectors")  # m stands for x in thin rows
    ids = rows.filter("m is not null").select("vec_id", "m").distinct()
    counts = ids.groupBy("m").agg(F.count(F.lit(1)).alias("copies"))
    nodes = rows.filter("m is not null").groupBy("m").agg(F.first("x").alias("x")).join(counts, "m")
    nodes = staged(nodes.withColumn("id", F.monotonically_increasing_id()).withColumn("c", F.col("id")), "nodes")  # ids are as written
    sizes = _sizes(nodes)
    lists, parts = None, None
    for attempt in range(ATTEMPTS):
        tables = range(attempt * TABLES, (attempt + 1) * TABLES)
        started = _from_buckets(nodes.select("id", "x", "c"), sizes, tables, wide)
        lists = staged(_merge(started if lists is None else lists.unionByName(started)), "lists")
        for _ in range(ROUNDS):
            lists = staged(_descend(lists, lists, nodes.select("id", "x", "c"), wide), "lists")
        parts = staged(components(_links(lists)), "parts") if parts is None else _joined(parts, _links(lists))
        parts = _beyond_full_lists(lists, parts, nodes, wide, (attempt + 1) * 100_000)
        if _audit(nodes, parts, wide) >= RECALL:
            break
    else:
        parts = _every_pair(nodes, parts, wide)
    found = parts.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    members = parts.join(found, "component").withColumnRenamed("node", "id")
    block = F.when(F.col("n") > GROWN * BLOCK, LARGE_BLOCK).otherwise(BLOCK)
    dealt = block_pairs(members, F.col("n"), F.col("id"), block, alone=True).drop("n").join(nodes.select("id", "x", "copies"), "id")
    counted = run_groups(dealt, ["component", "_i", "_j"], lambda g: _count_links(g, wide), _COUNTS).groupBy("id").agg(F.sum("links").alias("links"))
    return _named(rows.select("vec_id", "m"), ids, nodes.select("id", "m", "copies"), parts, counted)


def _named(rows: DataFrame, ids: DataFrame, nodes: DataFrame, parts: DataFrame, counted: DataFrame) -> DataFrame:
    """The result for each row, from what is known of the nodes; components are named by their smallest vec_id."""
    ids = staged(ids.join(nodes, "m").select("vec_id", "id"), "ids")
    several = ids.groupBy("vec_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a <> z")
    several = staged(ids.join(small_or_shuffled(staged(several.select("vec_id", "a"), "several")), "vec_id").select("a", F.col("id").alias("b")), "shared")
    whole = parts if several.isEmpty() else _joined(parts, several)
    grouped = ids.join(whole.withColumnRenamed("node", "id"), "id").select("vec_id", "component")
    grouped = grouped.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    alone = ids.groupBy("id").agg(F.min("vec_id").alias("least"))
    known = nodes.join(whole.withColumnRenamed("node", "id"), "id", "left").join(grouped, "component", "left").join(alone, "id").join(counted, "id", "left")
    known = known.select("m", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    fine = rows.filter("m is not null").join(known, "m").select("vec_id", "n_links", "component_id")
    rest = staged(rows.filter("m is null").select("vec_id"), "rest")
    asked = small_or_shuffled(rest.filter("vec_id is not null").distinct())
    told = fine.join(asked, "vec_id", "left_semi").groupBy(F.col("vec_id").alias("_v")).agg(F.min("component_id").alias("component_id"))  # by a row with a vector
    rest = rest.join(told, F.col("vec_id") == F.col("_v"), "left").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    out = fine.unionByName(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
