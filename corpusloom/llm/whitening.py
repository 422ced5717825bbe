"""Whitening of embeddings with an exact covariance, by digit-slice matrix products.

Vectors are taken as integers. The sums of n vectors give y = n * x - S, n
times what a vector is off the mean, without rounding. The sum of all y y' is
exact too: integers are split into limbs of so few bits that a float64 product
of a block of limb matrices can't round; limb products are put together as big
integers and merged over blocks, tasks and partitions. Only the eigenvectors of
the whole are rounded. Centring comes before multiplying, so that a mean that is
large against the spread costs no digits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import prepare, staged

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Rows of a block and bits of a limb: sums of BLOCK products of two limbs stay below 2 ** 53.
BLOCK, LIMB_BITS = 4096, 20
#: Blocks that are added up as int64, sums below 2 ** 52 each, before they go into big integers.
FOLD = 1024
#: Tasks whose partial sums are merged at a time, and at the end on the driver.
PARTIALS = 64
#: What 64-bit arithmetic is used for: below it nothing overflows; beyond it Python's integers do the same.
SAFE = 1 << 62

_WIDTHS = (np.int16, np.int32, np.int64)


def pack(x: np.ndarray) -> bytes:
    """The integers of a vector, less OFFSET, in the fewest bytes; equal vectors give equal bytes."""
    x = x - OFFSET
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    kind = next(k for k in _WIDTHS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def unpack(rows: list[bytes]) -> np.ndarray:
    """The vectors of a batch, less OFFSET, as int64; all have one length."""
    return np.stack([np.frombuffer(r, f"<i{r[0]}", offset=1) for r in rows]).astype(np.int64)


def integers(vector: list[float]) -> np.ndarray:
    """floor(64 * c) + 1000000 of each entry."""
    scaled = np.floor(SCALE * np.asarray(vector, np.float64))
    if len(scaled) and np.abs(scaled).max() >= SAFE:
        raise OverflowError("an entry of a vector is beyond 64-bit integers")
    return scaled.astype(np.int64) + OFFSET


class Limbs:
    """The exact sum of y y' over blocks of rows of integers."""

    def __init__(self, size: int):
        self.size, self.total = size, np.zeros((size, size), object)
        self.held: dict[int, np.ndarray] = {}
        self.blocks = 0

    def add(self, y: np.ndarray) -> None:
        """At most BLOCK rows, of int64 or of Python's integers."""
        sign = np.where(y < 0, -1, 1)
        rest, limbs = np.abs(y), []
        while rest.any():
            limbs.append(((rest & ((1 << LIMB_BITS) - 1)) * sign).astype(np.float64))
            rest = rest >> LIMB_BITS
        for i, a in enumerate(limbs):
            for j in range(i + 1):
                product = a.T @ limbs[j]
                self._hold(i + j, product if i == j else product + product.T)
        self.blocks += 1
        if self.blocks == FOLD:
            self.fold()

    def _hold(self, place: int, product: np.ndarray) -> None:
        # a sum of two products is below 2 ** 53 as well: blocks have BLOCK rows of limbs below 2 ** LIMB_BITS
        if place not in self.held:
            self.held[place] = np.zeros((self.size, self.size), np.int64)
        self.held[place] += product.astype(np.int64)

    def fold(self) -> None:
        """What is held as int64 goes into the big integers."""
        for place, product in self.held.items():
            self.total += product.astype(object) * (1 << (LIMB_BITS * place))
        self.held, self.blocks = {}, 0

    def whole(self) -> np.ndarray:
        self.fold()
        return self.total


def to_bytes(numbers: np.ndarray) -> bytes:
    """Integers of any size, in one width for all."""
    flat = numbers.ravel().tolist()
    width = max(1, max((int(v).bit_length() for v in flat), default=0) // 8 + 1)
    return width.to_bytes(4, "little") + b"".join(int(v).to_bytes(width, "little", signed=True) for v in flat)


def from_bytes(data: bytes) -> np.ndarray:
    width = int.from_bytes(data[:4], "little")
    return np.array([int.from_bytes(data[i : i + width], "little", signed=True) for i in range(4, len(data), width)], object)


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns: halves of the bits are summed apart."""
    high = x >> 32
    return high.sum(0).astype(object) * (1 << 32) + (x - (high << 32)).sum(0).astype(object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums without rounding, as int64 where it fits."""
    near = np.array([int(s) // n for s in sums], object)
    rest = np.array([int(s) - n * int(r) for s, r in zip(sums, near, strict=True)], object)  # 0 to n - 1
    if max(map(abs, near), default=0) < SAFE // 2:
        y = x - near.astype(np.int64)
        if n * (int(np.abs(y).max(initial=0)) + 1) < SAFE:
            return y * n - rest.astype(np.int64)
    return x.astype(object) * n - np.array([int(s) for s in sums], object)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Vectors in blocks of at most BLOCK rows."""
    held: list[bytes] = []
    for batch in batches:
        held += batch.column("x").to_pylist()
        while len(held) >= BLOCK:
            yield unpack(held[:BLOCK])
            held = held[BLOCK:]
    if held:
        yield unpack(held)


def _reduced(vectors: DataFrame, start: Callable, step: Callable, done: Callable, merged: Callable, schema: str) -> list:
    """Partial results of all partitions, merged in turn until few are left; a partial's size doesn't depend on the rows.

    Partitions are put together first where there are many, so that the
    partial results stay small against the vectors.
    """
    most = max(PARTIALS, vectors.sparkSession.sparkContext.defaultParallelism * 4)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, some = start(), False
        for x in _blocks(batches):
            state, some = step(state, x), True
        if some:
            yield done(state)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.slice(i, 1) if held is None else merged(held, batch.slice(i, 1))
        if held is not None:
            yield held

    name = "partial"
    parts = staged(vectors.coalesce(most).mapInArrow(one, schema), name)
    if parts.limit(PARTIALS + 1).count() > PARTIALS:
        parts = staged(parts.repartition(PARTIALS).mapInArrow(merge, schema), name)
    return parts.coalesce(1).mapInArrow(merge, schema).collect()  # one row


def sums(vectors: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """The number of vectors and the exact sums of their integers."""

    def done(state):
        return pa.record_batch({"n": pa.array([state[0]], pa.int64()), "s": pa.array([to_bytes(state[1])], pa.binary())})

    def merged(a, b):
        return done((a.column("n")[0].as_py() + b.column("n")[0].as_py(), from_bytes(a.column("s")[0].as_py()) + from_bytes(b.column("s")[0].as_py())))

    rows = _reduced(vectors, lambda: (0, np.zeros(size, object)), lambda t, x: (t[0] + len(x), t[1] + _column_sums(x)), done, merged, "n long, s binary")
    if not rows:
        return 0, np.zeros(size, object)
    n = rows[0].n
    return n, from_bytes(bytes(rows[0].s)) + n * OFFSET


def scatter(vectors: DataFrame, size: int, n: int, total: np.ndarray) -> np.ndarray:
    """The exact sum of y y' with y = n * x - S: n ** 3 times the covariance."""
    shifted = total - n * OFFSET

    def step(state: Limbs, x: np.ndarray) -> Limbs:
        state.add(centred(x, n, shifted))
        return state

    def done(state):
        return pa.record_batch({"m": pa.array([to_bytes(state.whole() if isinstance(state, Limbs) else state)], pa.binary())})

    def merged(a, b):
        return done(from_bytes(a.column("m")[0].as_py()) + from_bytes(b.column("m")[0].as_py()))

    rows = _reduced(vectors, lambda: Limbs(size), step, done, merged, "m binary")
    return from_bytes(bytes(rows[0].m)).reshape(size, size)


def covariance(gram: np.ndarray, n: int) -> np.ndarray:
    """Each entry rounded once."""
    return np.array([[int(v) / n**3 for v in row] for row in gram])


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors as columns; those of no variance, to double precision, aren't components."""
    if not v.size:
        return np.zeros(0), np.zeros((0, 0))
    scale = math.ldexp(1.0, -math.frexp(float(np.abs(v).max()))[1]) if v.any() else 1.0  # large entries stay finite when squared
    e, q = np.linalg.eigh(v * scale)
    order = np.argsort(-e, kind="stable")[:most]
    order = order[e[order] > len(v) * np.finfo(float).eps * max(e.max(), 0)]
    return e[order] / scale, q[:, order]


def identity_error(vectors: DataFrame, project: Callable[[np.ndarray], np.ndarray], k: int) -> float:
    """The largest entry of the covariance of whitened vectors less the identity."""
    if not k:
        return 0.0

    def step(state, x):
        w = project(x)
        n, mean = len(w), w.mean(0)
        return _joined(state, (n, mean, (w - mean).T @ (w - mean)))

    def done(state):
        return pa.record_batch({"n": pa.array([state[0]], pa.int64()), "mean": pa.array([state[1].tobytes()], pa.binary()), "m": pa.array([state[2].tobytes()], pa.binary())})

    def back(row):
        return row.column("n")[0].as_py(), np.frombuffer(row.column("mean")[0].as_py()), np.frombuffer(row.column("m")[0].as_py()).reshape(k, k)

    rows = _reduced(vectors, lambda: (0, np.zeros(k), np.zeros((k, k))), step, done, lambda a, b: done(_joined(back(a), back(b))), "n long, mean binary, m binary")
    m = np.frombuffer(bytes(rows[0].m)).reshape(k, k) / rows[0].n
    return float(np.abs(m - np.eye(k)).max())


def _joined(a: tuple, b: tuple) -> tuple:
    """Numbers, means and centred squares of two sets of vectors together."""
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def deviations(y: np.ndarray) -> list[int]:
    """The exact sum of squares of each row, which has to fit a long."""
    largest = int(np.abs(y).max(initial=0))
    if y.dtype != object and largest * largest * y.shape[1] < SAFE:
        return (y * y).sum(1).tolist()
    out = [sum(int(v) ** 2 for v in row) for row in y]
    if max(out) >= 1 << 63:
        raise OverflowError("a deviation is beyond 64-bit integers")
    return out


_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each vector on the first components of all: vec_id, component, n, deviation, whitened, explained, identity_error.

    A row for each vector and component. Vectors that are null or hold null or
    non-finite entries are left out, empty ones have no components. Equal
    vectors count once for the fit and each has its rows, as have rows with
    equal or null ids. Vectors of another length are fitted by themselves.
    Where there are fewer dimensions, or fewer with a variance, there are fewer
    components: one vector alone, or an empty table, gives no rows. Entries
    and deviations that no long can hold raise an error. Other columns are
    ignored. The covariance, a square of the length, is the driver's.
    """
    spark = vectors.sparkSession
    prepare(spark)
    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    fine = source.filter(F.col("v").isNotNull() & F.forall("v", finite) & (F.size("v") > 0))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [integers(v) for v in batch.column("v").to_pylist()]
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "size": pa.array([len(v) for v in x], pa.int32()), "x": pa.array([pack(v) for v in x], pa.binary())})

    rows = staged(fine.mapInArrow(packed, "vec_id long, size int, x binary"), "integers")
    every = staged(rows.select("size", "x").distinct(), "fit")
    sizes = sorted(r.size for r in every.select("size").distinct().collect())  # lengths, of which there are few
    out = None
    for size in sizes:
        part = _whitened(rows.filter(F.col("size") == size).select("vec_id", "x"), every.filter(F.col("size") == size).select("x"), size, most)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], _SCHEMA) if out is None else out


def _whitened(rows: DataFrame, fit: DataFrame, size: int, most: int) -> DataFrame:
    n, total = sums(fit, size)
    v = covariance(scatter(fit, size, n, total), n)
    e, q = components(v, most)
    k, trace = len(e), float(np.trace(v))
    shifted, weights = total - n * OFFSET, q / np.sqrt(e)

    def project(x: np.ndarray) -> np.ndarray:
        return (centred(x, n, shifted).astype(np.float64) / n) @ weights

    error = identity_error(fit, project, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = unpack(batch.column("x").to_pylist())
            y = centred(x, n, shifted)
            w = project(x)
            m = len(x)
            each = lambda values, kind: pa.array(np.repeat(np.array(values), k), kind)
            yield pa.record_batch({
                "vec_id": pa.array([i for i in batch.column("vec_id").to_pylist() for _ in range(k)], pa.int64()), "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), "n": pa.array(np.full(m * k, n), pa.int64()),
                "deviation": each(deviations(y), pa.int64()), "whitened": pa.array(w.ravel(), pa.float64()), "explained": pa.array(np.tile(e / trace, m), pa.float64()), "identity_error": pa.array(np.full(m * k, error), pa.float64()),
            })

    return rows.mapInArrow(run, _SCHEMA)
