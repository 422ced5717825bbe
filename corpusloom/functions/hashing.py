"""Content identities: FNV-1a with 64 bits over UTF-16 code units, and framed sequences of values."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import utf16_length

#: Fixed values of FNV-1a, and the separators and domains of the identities.
OFFSET, PRIME = 0xCBF29CE484222325, 0x100000001B3
#: Texts that go on by themselves.
FEW = 24
FIELD, RECORD = "\x01", "\x02"
AUTHORITY_V1, AUTHORITY_V2, EVIDENCE_V2 = "corpus-authority-v1", "corpus-authority-v2", "corpus-release-evidence-v2"


def fnv1a64(texts: list[str | None]) -> list[str | None]:
    """The hashes of a batch, 16 hexadecimal digits each.

    Texts advance together, a code unit at a time; where few are left, each
    goes on by itself, as one step of all costs more than a step of each.
    """
    units = [None if t is None else np.frombuffer(t.encode("utf-16-le", "surrogatepass"), np.uint16) for t in texts]
    sizes = np.array([0 if u is None else len(u) for u in units], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    state = np.full(len(texts), OFFSET, np.uint64)
    ordered = [units[i] for i in order if units[i] is not None and len(units[i])]
    ends = -sizes[order][: len(ordered)]
    flat = np.concatenate(ordered) if ordered else np.zeros(0, np.uint16)
    starts = np.concatenate([[0], np.cumsum([len(u) for u in ordered])[:-1]]).astype(np.int64) if ordered else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        together = -int(ends[FEW]) if len(ends) > FEW else 0  # code units of the longest text but FEW
        for i in range(together):
            live = int(np.searchsorted(ends, -i, side="left"))  # texts longer than i
            state[:live] = (state[:live] ^ flat[starts[:live] + i]) * np.uint64(PRIME)
    for at, text in enumerate(ordered[:FEW]):
        one = int(state[at])
        for unit in text[together:].tolist():
            one = (one ^ unit) * PRIME & 0xFFFFFFFFFFFFFFFF
        state[at] = one
    out: list[str | None] = [None] * len(texts)
    for at, i in enumerate(order):
        out[i] = None if texts[i] is None else f"{int(state[at]):016x}"
    return out


@F.pandas_udf(T.StringType())
def _text_hash(texts: pd.Series) -> pd.Series:
    return pd.Series(fnv1a64(list(texts)), dtype=object)


def text_hash(text: Column) -> Column:
    """FNV-1a-64 of a text; null stays null, the empty text has the offset basis."""
    return _text_hash(text)


def frame(value: Column, kind: str) -> Column:
    """A value as it goes into an identity: n; for null, i and digits for a number, s with the UTF-16 length for a text."""
    some = F.concat(F.lit("i"), value.cast("long").cast("string"), F.lit(";")) if kind == "number" else F.concat(F.lit("s"), utf16_length(value).cast("string"), F.lit(":"), value, F.lit(";"))
    return F.when(value.isNull(), F.lit("n;")).otherwise(some)


def joined(rows_text: Column, order: Column, separator: str = "") -> Column:
    """Texts of a group in order. Folding a hash over them is the hash of what they give together."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), rows_text.alias("t")))), lambda x: x["t"]), separator)
