"""Text functions with the white space, length and order rules of UTF-16 languages."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The characters that \s means in ECMAScript, as the inside of a class.
WHITE = r"\t\n\x0B\f\r \xA0  -     　﻿"
#: The characters of the Unicode property White_Space.
UNICODE_WHITE = r"\t-\r \x85\xA0  -     　"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def trim(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"\A[{WHITE}]++|[{WHITE}]+\z", "")


def collapse(text: Column) -> Column:
    """Each run of white space as one space, and none at the ends."""
    return trim(F.regexp_replace(text, rf"[{WHITE}]++", " "))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 code units."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def utf16_order(text: Column) -> Column:
    """A key that sorts as UTF-16 code units do, which differs from Spark's order beyond U+D7FF."""
    return F.encode(text, "UTF-16BE")


def ascii_fold(text: Column) -> Column:
    """Lower case of the ASCII letters only."""
    return F.translate(text, UPPER, LOWER)


def substantive(text: Column) -> Column:
    """Whether any code point is neither white space nor a control or format character."""
    return F.coalesce(text.rlike(rf"[^{UNICODE_WHITE}\p{{Cc}}\p{{Cf}}]"), F.lit(False))


def _normalised(form: str):
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize(form, t))

    return run


def normalise(text: Column, form: str = "NFC") -> Column:
    """A Unicode normal form. Texts of ASCII characters stay in the JVM's hands as they are."""
    return F.when(text.rlike(r"\A\p{ASCII}*+\z"), text).otherwise(_normalised(form)(text))


def caption(text: Column) -> Column:
    """NFC with collapsed white space."""
    return collapse(normalise(text))


def caption_key(text: Column) -> Column:
    """NFC, lower case, no white space."""
    return F.regexp_replace(F.lower(normalise(text)), rf"[{WHITE}]++", "")


def descriptive_label(text: Column) -> Column:
    """A line of capitals that can name the heading before it: four characters or more, two words of three or more, no marker word."""
    capitals = text.rlike(r"^[A-ZÁÉÍÓÚÜÑ \-]{4,}$")
    words = F.size(F.filter(F.split(text, r"[ \-]+"), lambda w: F.length(w) >= 3)) >= 2
    return capitals & words & ~text.rlike(r"^(?:LIBRO|T[IÍ]TULO|CAP[IÍ]TULO|SECCI[OÓ]N|ART[IÍ]CULO|TRANSITORIO)\b")


def snippet(lines: Column, most: int = 3, units: int = 120) -> Column:
    """The first lines of an array, for a message: joined by a space, cut after so many UTF-16 code units, and not within a character."""
    begin = F.substring(F.array_join(F.slice(lines, 1, most), " "), 1, units)
    size = lambda c: F.when(c.rlike(r"[\x{10000}-\x{10FFFF}]"), 2).otherwise(1)
    none = F.struct(F.lit(0).alias("n"), F.lit("").alias("t"))

    def more(acc: Column, c: Column) -> Column:
        n = acc["n"] + size(c)
        return F.struct(n.alias("n"), F.when(n <= units, F.concat(acc["t"], c)).otherwise(acc["t"]).alias("t"))

    return F.aggregate(F.split(begin, ""), none, more, lambda acc: acc["t"])
