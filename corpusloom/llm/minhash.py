"""Near-duplicate texts by DartMinHash signatures and exact checks.

A text is a weighted set: its shingles of five words with their counts. Darts
are thrown by hash into the area of each element (weight by rank); those that
land below the element's weight count, and for each of the signature's
coordinates the one with the earliest rank is kept. Two signatures agree in a
coordinate with the probability of their weighted Jaccard similarity.

Texts that agree in a band of coordinates are candidates. Equal texts are one
from the start; buckets with the same members are looked at once. Within a
bucket a forest of pairs with similar signatures is found, in tasks of bounded
size; its components bring the texts together on which the similarity is
computed exactly. Pairs below the threshold are never linked, and pairs that
are connected already need no check: a large group is dealt to blocks, then one
member for each connected part goes on, so that groups of copies cost no square
of their size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.caches import TwoGenerations
from corpusloom.llm.common import fresh, only, prepare, staged
from corpusloom.llm.components import components, counted, linked, small_or_shuffled

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold agrees in no band with a probability of (1 - 0.8^ROWS)^BANDS = 3e-5.
BANDS, ROWS = 26, 5
COORDINATES = BANDS * ROWS
#: Signatures that agree in fewer coordinates are not compared exactly: 3.5 standard deviations below the threshold.
SIMILAR = math.floor(COORDINATES * THRESHOLD - 3.5 * math.sqrt(COORDINATES * THRESHOLD * (1 - THRESHOLD)))
#: Rows of a block, for signatures and for texts; characters that count as one more row.
BLOCK, TEXT_BLOCK, TEXT_CHARS = 1024, 256, 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) on an array of unsigned integers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _hash_words(words: list[str]) -> list[int]:
    import xxhash

    return [xxhash.xxh3_64_intdigest(w) for w in words]


_WORD_HASHES = TwoGenerations(50_000, _hash_words)


def shingles(text: str, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, and the distinct shingles' hashes with their counts; a shorter text is one shingle."""
    words = text.split()
    h = np.array(list(map(_WORD_HASHES.ready(words).__getitem__, words)), dtype=np.uint64)
    n = len(h)
    if not n:
        return h, h, np.zeros(0, np.int64)
    k = min(size, n)
    with np.errstate(over="ignore"):
        s = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            s = (s ^ h[i : n - k + 1 + i]) * np.uint64(0x9FB21C651E98DF25)
            s ^= s >> np.uint64(32)
    elements, counts = np.unique(s, return_counts=True)
    return h, elements, counts


def _unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit integers."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Names and ranks of all darts with a rank up to ``most`` that land below their element's weight.

    Weight is divided into the regions 0-1, 1-2, 2-4, 4-8 ... In a region of an
    element the darts' ranks form a Poisson process with the region's width as
    rate, drawn gap by gap from hashes; each dart has a place in the width.
    """
    names, ranks = [], []
    level, low, width = 0, 0.0, 1.0
    while True:
        inside = weights > low
        if not inside.any():
            break
        seed = mix(elements[inside] ^ np.uint64(level * 0x1F123BB5))
        top, at = weights[inside], np.zeros(inside.sum())
        k, mean = 0, most * width
        while len(seed):
            many = 1 if mean < 0.7 else int(mean + 3 * math.sqrt(mean) + 3)
            name = mix(seed[:, None] + np.arange(k, k + many, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            rank = at[:, None] + np.cumsum(-np.log(_unit(name)) / width, axis=1)
            good = rank <= most
            if level:
                good &= low + width * _unit(mix(name)) <= top[:, None]
            names.append(name[good])
            ranks.append(rank[good])
            on = rank[:, -1] <= most
            seed, top, at, k = seed[on], top[on], rank[on, -1], k + many
        level, low, width = level + 1, low + width, 1.0 if level == 0 else width * 2
    return np.concatenate(names), np.concatenate(ranks)


def signature(elements: np.ndarray, weights: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """For each coordinate the name of the earliest dart that falls to it."""
    most = (coordinates * math.log(coordinates) + 2 * coordinates) / weights.sum()
    while True:
        names, ranks = darts(elements, weights, most)
        late = np.argsort(-ranks, kind="stable")
        where = (mix(names) % np.uint64(coordinates)).astype(np.int64)
        out, hit = np.zeros(coordinates, np.uint64), np.zeros(coordinates, bool)
        out[where[late]] = names[late]  # of several for a coordinate, the last one assigned is the earliest
        hit[where] = True
        if hit.all():
            return out
        most *= 2


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The weighted Jaccard similarity of (elements, counts), elements in order."""
    (x, cx), (y, cy) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    same = y[at] == x
    common = np.minimum(cx[same], cy[at[same]]).sum()
    return common / (cx.sum() + cy.sum() - common)


def _whole(words: np.ndarray) -> tuple[int, int]:
    """A hash of 128 bits of a text's words."""
    import xxhash

    a, b = np.frombuffer(xxhash.xxh3_128_digest(words.tobytes()), np.int64)
    return int(a), int(b)


def signed(documents: DataFrame) -> DataFrame:
    """doc_id, h1 and h2 (a hash of the words), w (the text's weight in a block), sketch (16 bits of each coordinate) and bands; nulls for wordless texts."""

    @F.pandas_udf("h1 long, h2 long, w long, sketch binary, bands array<long>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        import xxhash

        rows = []
        for text in texts:
            words, elements, counts = shingles(text or "")
            if not len(words):
                rows.append((None, None, None, None, None))
                continue
            whole = _whole(words)
            names = signature(elements, counts.astype(float))
            bands = [xxhash.xxh3_64_intdigest(names[ROWS * i : ROWS * (i + 1)].tobytes(), seed=i) - (1 << 63) for i in range(BANDS)]
            rows.append((*whole, 1 + len(text) // TEXT_CHARS, (names & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), bands))
        frame = pd.DataFrame(rows, columns=["h1", "h2", "w", "sketch", "bands"])
        return frame.astype({"h1": "Int64", "h2": "Int64", "w": "Int64"})

    return documents.select("doc_id", sign("text").alias("s")).select("doc_id", "s.*")


def sketch_forest(held: dict[str, list]) -> list[tuple]:
    """Pairs with similar signatures that connect what is connected within a bucket."""
    ids = held["rep"]
    s = np.frombuffer(b"".join(held["sketch"]), np.uint16).reshape(len(ids), COORDINATES)
    return _forest(ids, s, None)


def text_forest(held: dict[str, list]) -> list[tuple]:
    """The same with the similarity of the texts, for pairs with similar signatures."""
    s = np.frombuffer(b"".join(held["sketch"]), np.uint16).reshape(len(held["rep"]), COORDINATES)
    return _forest(held["rep"], s, [shingles(t)[1:] for t in held["text"]])


def _forest(ids: list[int], s: np.ndarray, sets: list | None) -> list[tuple]:
    order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
    loose, edges = order, []
    while len(loose):
        frontier, loose = [loose[0]], loose[1:]
        while frontier and len(loose):
            f = frontier.pop()
            like = (s[loose] == s[f]).sum(1) >= SIMILAR
            if sets is not None:
                for i in np.flatnonzero(like):
                    like[i] = similarity(sets[f], sets[loose[i]]) >= THRESHOLD
            edges += [(ids[f], ids[m]) for m in loose[like]]
            frontier += list(loose[like])
            loose = loose[~like]
    return edges


def _across(held: dict[str, list], sets: list | None) -> list[tuple]:
    """Links between parts of a group, from rows of side 0 to those of side 1; none between parts that a link joins already."""
    ids, c, side = held["rep"], np.array(held["c"], dtype=np.int64), np.array(held["side"])
    s = np.frombuffer(b"".join(held["sketch"]), np.uint16).reshape(len(ids), COORDINATES)
    to = np.flatnonzero(side == 1)
    part, edges = c.copy(), []
    for f in np.flatnonzero(side == 0):
        like = to[((s[to] == s[f]).sum(1) >= SIMILAR) & (part[to] != part[f])]
        for m in like:
            if part[m] != part[f] and (sets is None or similarity(sets[f], sets[m]) >= THRESHOLD):
                edges.append((ids[f], ids[m]))
                part[part == part[m]] = part[f]
    return edges


def sketches_across(held: dict[str, list]) -> list[tuple]:
    return _across(held, None)


def texts_across(held: dict[str, list]) -> list[tuple]:
    return _across(held, [shingles(t)[1:] for t in held["text"]])


def classes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document with its class of near copies: doc_id, class_id, kept.

    class_id is the smallest doc_id that links of a similarity of 0.8 or more
    lead to; kept is true for that document. Texts with equal words are in one
    class; those of fewer than five words are one shingle. Null texts and texts
    without words link with nothing; a null doc_id gives a row with a null
    class, kept; rows with equal doc_id share a class, whatever their texts,
    which all count. Texts are taken as a whole, however long. Other columns
    are ignored.
    """
    return _classes(documents, id_col, text_col)[0]


def _classes(documents: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """classes(), the ids that several rows have, and how many those are."""
    prepare(documents.sparkSession)
    base = staged(signed(only(documents, doc_id=id_col, text=text_col)), "signed")
    again = base.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    again, repeated = counted(staged(again, "again"))
    with_words = base.filter("doc_id is not null and h1 is not null")
    reps = with_words.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("w").alias("w"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    reps = staged(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")  # ids are as written

    in_bands = reps.select("rep", F.explode("bands").alias("band"))
    buckets = in_bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.bit_xor(F.xxhash64("rep")).alias("x"))
    buckets = buckets.filter("n > 1").groupBy("n", "lo", "hi", "x").agg(F.min("band").alias("band")).select("band", "n")
    members = in_bands.join(buckets.select("band"), "band").withColumn("w", F.lit(1))
    clusters = linked(members, ["band"], reps.select("rep", "sketch"), sketch_forest, sketches_across, BLOCK, buckets)

    clusters = clusters.withColumnRenamed("node", "rep")
    wanted = staged(clusters.join(reps.select("rep", "w", "h1", "h2", F.col("first").alias("_id"), "sketch"), "rep"), "wanted")
    payload = staged(_texts(only(documents, doc_id=id_col, text=text_col), wanted, again if repeated else None).join(wanted.select("rep", "sketch"), "rep"), "texts")
    sizes = wanted.groupBy("component").agg(F.sum("w").alias("n"))
    found = linked(wanted, ["component"], payload, text_forest, texts_across, TEXT_BLOCK, sizes)

    named = with_words.select("doc_id", "h1", "h2").join(reps.select("h1", "h2", "rep", "first"), ["h1", "h2"]).select("doc_id", "rep", "first")
    if repeated:  # the texts of one id are in one class
        shared = named.join(again, "doc_id", "left_semi")
        least = shared.groupBy(F.col("doc_id").alias("_d")).agg(F.min("rep").alias("a"))
        shared = shared.join(least, F.col("doc_id") == F.col("_d")).select("a", F.col("rep").alias("b"))
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(shared))
    found = staged(found, "found").withColumnRenamed("node", "rep")
    least = found.join(reps.select("rep", "first"), "rep").groupBy("component").agg(F.min("first").alias("class_id"))
    member = found.join(least, "component").select("rep", "class_id")
    some = named.join(member, "rep", "left").select("doc_id", F.coalesce("class_id", "first").alias("class_id"))
    none = base.filter("doc_id is null or h1 is null").select("doc_id", F.col("doc_id").alias("class_id"))
    if repeated:  # an id without words here may have some in another row
        told = some.join(again, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("_d")).agg(F.min("class_id").alias("_c"))
        none = none.join(told, F.col("doc_id") == F.col("_d"), "left").select("doc_id", F.coalesce("_c", "class_id").alias("class_id"))
    every = some.unionByName(none)
    return every.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True))), again, repeated


def _texts(documents: DataFrame, wanted: DataFrame, again: DataFrame | None) -> DataFrame:
    """(rep, text) for the wanted representatives (rep, _id, h1, h2); of an id with several rows, the text with the right words."""
    known = small_or_shuffled(wanted.select("_id", "rep", "h1", "h2"))
    texts = documents.filter("text is not null").join(known, F.col("doc_id") == F.col("_id"))
    if again is None:
        return texts.select("rep", "text")

    @F.pandas_udf("h1 long, h2 long")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        rows = [_whole(w) if len(w := shingles(t)[0]) else (None, None) for t in texts]
        return pd.DataFrame(rows, columns=["h1", "h2"]).astype("Int64")

    once = texts.join(again, "doc_id", "left_anti").select("rep", "text")
    some = staged(texts.join(again, "doc_id", "left_semi"), "some")  # only these are hashed again
    right = some.withColumn("_h", hashed("text")).filter("_h.h1 = h1 and _h.h2 = h2").groupBy("rep").agg(F.min("text").alias("text"))
    return once.unionByName(right)


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay, one of each class, with their columns.

    Of rows with the kept doc_id only one stays, the first by text; rows without id
    belong to no class and stay.
    """
    key = fresh(documents, "_id")
    found, again, repeated = _classes(documents, "doc_id", "text")
    gone = staged(found.filter("not kept").select(F.col("doc_id").alias(key)), "gone")
    left = documents.join(small_or_shuffled(gone), F.col("doc_id") == F.col(key), "left_anti")
    if not repeated:
        return left
    again = again.withColumnRenamed("doc_id", key)
    once = left.join(again, F.col("doc_id") == F.col(key), "left_anti")
    place = fresh(documents, "_place")
    rows = left.join(again, F.col("doc_id") == F.col(key), "left_semi")
    rows = rows.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())))
    return once.unionByName(rows.filter(F.col(place) == 1).drop(place))
