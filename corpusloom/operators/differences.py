"""Differences of documents by structure: JSON values, schemas and manifests, place by place.

Two tables of documents meet by one full outer join on their keys; the texts of
a row are scanned once and gone through together, however deep they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import scanner

_CHANGES = pa.list_(pa.struct([(x, pa.string()) for x in ("path", "problem", "was", "now")]))
_TYPE = "array<struct<path:string,problem:string,was:string,now:string>>"
#: Code points of pairs of documents whose differences a Python worker holds at once; a longer pair is held by itself.
HELD = 1 << 20


def _told(v: object) -> tuple[str, str | None]:
    """The kind of a value, and its text; containers have none."""
    if isinstance(v, dict | list):
        return "object" if isinstance(v, dict) else "array", None
    kind = "null" if v is None else "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "number"
    return kind, v if isinstance(v, str) else json.dumps(v)


def _inside(v: object) -> dict[str | int, object]:
    """What a value holds: by name in an object, by place in an array."""
    return v if isinstance(v, dict) else dict(enumerate(v)) if isinstance(v, list) else {}


def changes(was: object, now: object, ordered: bool = False) -> Iterator[tuple[str, str, str | None, str | None]]:
    """(path, problem, was, now) of two values, place by place, with the problems that differences() has."""
    todo = [("$", was, now, False)]
    while todo:
        path, a, b, moved = todo.pop()
        (kind_a, text_a), (kind_b, text_b) = _told(a), _told(b)
        problem = "kind" if kind_a != kind_b else "value" if text_a != text_b else "place" if moved and ordered else None
        if problem:
            yield path, problem, text_a, text_b
        in_a, in_b = _inside(a), _inside(b)
        places = {k: i for i, k in enumerate(in_b)}
        for i, (k, x) in enumerate(in_a.items()):
            if k in places:
                todo.append((path + scanner.step(k), x, in_b[k], i != places[k]))
            else:
                yield path + scanner.step(k), "missing", _told(x)[1], None
        for k, x in in_b.items():
            if k not in in_a:
                yield path + scanner.step(k), "unknown", None, _told(x)[1]


def _scanned(text: str | None) -> list[object]:
    """The value of a JSON text; none for null and for texts that are no JSON."""
    if text is None:
        return []
    try:
        return [scanner.scan(text.encode("utf-8", "surrogatepass"), strict=False)]
    except scanner.Fault:
        return []


def text_changes(was: str | None, now: str | None, ordered: bool = False) -> list[tuple[str, str, str | None, str | None]]:
    """changes() of two JSON texts, of which either may have no value."""
    if was == now:
        return []
    a, b = _scanned(was), _scanned(now)
    if a and b:
        return list(changes(a[0], b[0], ordered))
    return [("$", "missing", _told(v)[1], None) for v in a] + [("$", "unknown", None, _told(v)[1]) for v in b]


def compared(was: Column, now: Column, ordered: bool = False) -> Column:
    """array<struct<path, problem, was, now>> of two JSON texts of a row."""

    @F.arrow_udf(_TYPE)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        names = ("path", "problem", "was", "now")
        for left, right in batches:
            rows, held = [], 0
            for a, b in zip(left, right, strict=True):
                a, b = a.as_py(), b.as_py()
                size = len(a or "") + len(b or "")
                if rows and held + size > HELD:
                    yield pa.array(rows, _CHANGES)
                    rows, held = [], 0
                rows.append([dict(zip(names, c, strict=True)) for c in text_changes(a, b, ordered)])
                held += size
            if rows:
                yield pa.array(rows, _CHANGES)

    return run(was, now)


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], text: str, ordered: bool = False) -> DataFrame:
    """(keys, path, problem, was, now) where documents of the same keys differ.

    Problems: missing and unknown (only the first, only the second has the
    place), kind, value, and with ``ordered`` place, where an object's keys
    are in another order. Below a place that only one has no more is said.
    Keys name one document on each side; a null key has no counterpart.
    """
    a, b = left.select(*keys, F.col(text).alias("_a")), right.select(*keys, F.col(text).alias("_b"))
    return a.join(b, [*keys], "full_outer").select(*keys, F.inline(compared(F.col("_a"), F.col("_b"), ordered)))


def schema_document(schema: T.StructType, keys: Sequence[str] = (), defaults: dict[str, object] | None = None) -> str:
    """A schema as JSON: for each column its type, whether it may be null, its default and its place in the key."""
    columns = {f.name: {"type": f.dataType.simpleString(), "nullable": f.nullable, "default": (defaults or {}).get(f.name), "key": list(keys).index(f.name) + 1 if f.name in keys else 0} for f in schema.fields}
    return json.dumps(columns, ensure_ascii=False)
