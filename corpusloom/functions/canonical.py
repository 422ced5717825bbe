"""Canonical JSON, and a strict reader of JSON bytes."""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import scanner

MAX_SAFE = scanner.MAX_SAFE


def canonical(value: object) -> str:
    """JSON with sorted keys (by UTF-16 code units), no spaces and the fewest escapes; -0 is the string "-0"."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{_quoted(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, str):
        return _quoted(value)
    if value is None or isinstance(value, bool):
        return json.dumps(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("not a finite number")
        if value == 0 and math.copysign(1, value) < 0:
            return '"-0"'
        return _number(value)
    if isinstance(value, int):
        return _number(float(value)) if abs(value) > MAX_SAFE else str(value)
    raise ValueError(f"no JSON value: {type(value).__name__}")


def _quoted(text: str) -> str:
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", json.dumps(text, ensure_ascii=False))


def _number(value: float) -> str:
    """The shortest digits that give the number back, in ECMAScript's notation."""
    if value == int(value) and abs(value) < 1e21:
        return str(int(value))
    digits, _, power = f"{value!r}".replace("E", "e").partition("e")
    if power and -7 < int(power) < 0:
        return f"{value:.{len(digits.replace('-', '').replace('.', '')) - 1 - int(power)}f}"
    if not power:
        return digits
    return f"{digits.removesuffix('.0')}e{'+' if int(power) > 0 else '-'}{abs(int(power))}"


@F.pandas_udf(T.StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else canonical(json.loads(t)))


def canonical_json(text: Column) -> Column:
    """A column of JSON texts in canonical form; null stays null."""
    return _canonical(text)


class Refused(ValueError):
    """A fixed code without any of the content."""


#: Faults of the scanner that this reader doesn't tell apart.
_SYNTAX = ("control", "escape", "trailing", "unfinished")


def strict(data: bytes) -> object:
    """The value of JSON bytes, or Refused.

    No byte order mark, no malformed UTF-8, no repeated keys, no numbers but
    unsigned integers without leading zeros up to 2^53 - 1, no lone surrogates,
    no control characters, no more than 64 levels, nothing after the value. The
    first fault counts.
    """
    try:
        return scanner.scan(data)
    except scanner.Fault as why:
        raise Refused("syntax" if why.code in _SYNTAX else why.code) from None


@F.pandas_udf(T.StringType())
def _refusal(data: pd.Series) -> pd.Series:
    def code(b: bytes) -> str | None:
        try:
            strict(bytes(b))
        except Refused as why:
            return str(why)
        return None

    return data.map(lambda b: None if b is None else code(b))


def refusal(data: Column) -> Column:
    """The code with which strict() refuses the bytes, or null."""
    return _refusal(data)
