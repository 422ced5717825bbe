"""Packing documents into sequences of one length, with little padding.

A document longer than a window is cut into whole windows and a rest, so that
what is to be packed is a histogram of piece lengths. On the driver, which
holds no more than one count for each length:

1. shallow combinations of two or three lengths that fill the window exactly
   are enumerated;
2. non-negative least squares finds how often each is repeated so that
   together they use up the histogram;
3. the repeat counts are rounded, never beyond the pieces that there are;
4. what is left is packed greedily, the longest first, each time with the
   longest piece that still fits, whole runs of equal sequences at a time.

The result is a list of templates. Each piece finds its place by its rank
among the pieces of its length; ranks are counted within salted groups, so that
a length that many pieces share is spread over tasks.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm import token_ids
from corpusloom.llm.common import only, prepare, staged, tokenizer_path

WINDOW, END_ID = 2048, 1
#: Groups that the pieces of one length are ranked in.
SALTS = 512
#: Pieces in the tokenizer's cache: fewer than elsewhere, as workers in a pipeline hold the caches of other stages too.
CACHED = 150_000


def combinations(window: int, present: np.ndarray) -> np.ndarray:
    """Pairs and triples of lengths, of those present, that fill the window: rows (a, b, c), a <= b <= c, a = 0 for a pair."""
    lengths = np.flatnonzero(present[:window])
    lengths = lengths[lengths > 0]
    has = np.zeros(window + 1, bool)
    has[lengths] = True
    out = [np.stack([0 * x, x, window - x], 1) for x in [lengths[(2 * lengths <= window) & has[window - lengths]]]]
    for a in lengths:
        b = lengths[(lengths >= a) & (a + 2 * lengths <= window)]
        if not len(b):
            break
        b = b[has[window - a - b]]
        out.append(np.stack([np.full(len(b), a), b, window - a - b], 1))
    return np.concatenate(out).astype(np.int64)


def least_squares(combos: np.ndarray, histogram: np.ndarray, steps: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that minimise ||A x - h||, by accelerated projected gradients.

    A has a column for each combination with how often it uses each length.
    Columns are scaled by an upper bound of their share in the curvature.
    """
    size = len(histogram)
    use = lambda x: np.bincount(combos.ravel(), np.repeat(x, 3), size)
    back = lambda r: r[combos].sum(1)
    target = histogram.astype(float).copy()
    target[0] = 0
    ones = use(np.ones(len(combos)))
    ones[0] = 0
    step = 1 / np.maximum(1, back(ones))  # of |A'A|: its rows' sums
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        r = use(y) - target
        r[0] = 0
        new = np.maximum(0, y - step * back(r))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        if ((y - new) * (new - x)).sum() > 0:  # overshot: restart the momentum
            after = t = 1.0
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Templates (lengths of the pieces, how many sequences) that use up the histogram.

    ``histogram[l]`` is the number of pieces of length l, up to the window.
    """
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    combos = combinations(window, left > 0)
    if len(combos):
        x = least_squares(combos, left)
        for i in np.argsort(-x, kind="stable"):
            want = int(x[i] + 0.5)
            if not want:
                break
            lengths, times = np.unique(combos[i][combos[i] > 0], return_counts=True)
            count = min(want, int((left[lengths] // times).min()))
            if count > 0:
                left[lengths] -= count * times
                out.append((tuple(int(v) for v in combos[i] if v), count))
    return out + greedy(left, window)


def greedy(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest piece first, for as many equal sequences at a time as the counts allow."""
    left, out = left.astype(np.int64).copy(), []
    present = sorted(np.flatnonzero(left).tolist())
    while present:
        space, picked = window, []
        room = left.copy()
        while True:
            fit = next((v for v in reversed(present) if v <= space and room[v] > 0), 0)
            if not fit:
                break
            many = min(int(room[fit]), space // fit)
            picked += [fit] * many
            room[fit] -= many
            space -= many * fit
        lengths, times = np.unique(picked, return_counts=True)
        count = max(1, int((left[lengths] // times).min()))
        left[lengths] -= count * times
        out.append((tuple(picked), count))
        present = [v for v in present if left[v] > 0]
    return out


def places(templates: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Rows by (length, first rank): the pieces of a length with these ranks go to these sequences.

    ``per`` pieces of the length lie in each of the template's sequences, from
    ``sequence`` on, the first at ``offset``.
    """
    rows, used, sequence = [], {}, 0
    for lengths, count in templates:
        offset, ordered = 0, sorted(lengths, reverse=True)
        for length in dict.fromkeys(ordered):
            per = ordered.count(length)
            first = used.get(length, 0)
            rows.append((length, first, per, sequence, offset))
            used[length] = first + per * count
            offset += per * length
        sequence += count
    rows.sort()
    names = ("length", "first", "per", "sequence", "offset")
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(names)}


def cut(documents: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens): each document's whole windows and its rest."""
    kind = "array<struct<start:long,length:long,ids_crc32:long,doc_tokens:long>>"

    @F.arrow_udf(kind)
    def pieces(texts: pa.Array) -> pa.Array:
        tokenizer, rows = token_ids.load(path, CACHED), []
        end = array("I", [END_ID]).tobytes()
        for text in texts.to_pylist():
            ids = tokenizer.ids(text or "") + end
            n = len(ids) // 4
            rows.append([{"start": s, "length": min(window, n - s), "ids_crc32": zlib.crc32(ids[4 * s : 4 * (s + window)]), "doc_tokens": n} for s in range(0, n, window)])
        field = pa.struct([(x, pa.int64()) for x in ("start", "length", "ids_crc32", "doc_tokens")])
        return pa.array(rows, pa.list_(field))

    return documents.select("doc_id", F.explode(pieces("text")).alias("p")).select("doc_id", "p.*")


def pack(documents: DataFrame, path: str | None = None, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents; a row for each piece.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    A null text counts as empty and gives its end id alone; a very long text is
    encoded as a whole, its ids being held by its task, and cut into windows. Rows with equal or
    null ids are packed each; an empty table gives no rows; other columns are
    ignored. Pieces are the same on each run; which of several pieces with equal length
    lies where depends on a hash of doc_id and start.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    spark = documents.sparkSession
    prepare(spark)
    pieces = staged(cut(only(documents, doc_id=id_col, text=text_col), path, window), "pieces")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").agg(F.count(F.lit(1))).collect():  # a row for each length
        histogram[length] = n
    table = places(plan(histogram, window))

    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS))
    salted = pieces.withColumn("_salt", salt)
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(bases, ["length", "_salt"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_rank") + F.col("_base")).alias("_rank"))
    shape = np.int64(1) << 44  # ranks stay below it
    keys = table["length"] * shape + table["first"]

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(keys, length * shape + rank, side="right") - 1
        over = rank - table["first"][at]
        per = table["per"][at]
        return pd.DataFrame({"sequence_id": table["sequence"][at] + over // per, "offset": table["offset"][at] + over % per * length})

    rows = ranked.withColumn("_p", placed("length", "_rank"))
    return rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "_p.sequence_id", "_p.offset")
