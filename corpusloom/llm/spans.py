"""Places of pattern matches in a text, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two private-use characters stand around matches; in texts they are replaced first, as no pattern here has them.
OPEN, CLOSE = "", ""


def plain(text: Column) -> Column:
    """The text without the two marks, each code point at its place; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), OPEN + CLOSE, "")


def marked(text: Column, pattern: str, replacement: str = "$0") -> Column:
    """The text with marks around each leftmost, non-overlapping match.

    ``replacement`` may set the marks itself, to keep only a group.
    """
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement if OPEN in replacement else f"{OPEN}{replacement}{CLOSE}"))


#: Parts that are walked at a time, and code points of a segment.
WALK, SEGMENT = 256, 4096
_FOUND = "array<struct<start:int,end:int,match:string>>"


def places(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with array<struct<start, end, match>> of what is marked in each of ``columns``, in code points from 0, end exclusive.

    The parts between marks are walked in runs of bounded length, whose places
    are then moved by what lies before the run, so that the work is in
    proportion to the text however many matches there are.
    """
    keep = lambda made: [F.col(f"`{c}`") if c not in columns else made(F.col(f"`{c}`")).alias(c) for c in rows.columns]
    rows = rows.select(*keep(lambda c: F.when(F.contains(c, F.lit(OPEN)), F.split(c, OPEN))))

    def step(state: Column, part: Column) -> Column:
        inside = F.contains(part, F.lit(CLOSE))
        match, at = F.substring_index(part, CLOSE, 1), state["at"]
        found = F.struct(at.alias("start"), (at + F.length(match)).cast("int").alias("end"), match.alias("match"))
        after = (at + F.length(part) - F.when(inside, 1).otherwise(0)).cast("int")
        return F.struct(after.alias("at"), F.when(inside, F.array_append(state["found"], found)).otherwise(state["found"]).alias("found"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("found"))

    def runs(parts: Column) -> Column:
        many = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / WALK).cast("int"))
        walked = F.transform(many, lambda i: F.aggregate(F.slice(parts, i * WALK + 1, WALK), first, step))
        return F.when(parts.isNotNull(), walked)

    rows = rows.select(*keep(runs))

    def moved(state: Column, run: Column) -> Column:
        base = F.struct(state["at"].alias("base"), run["found"].alias("found"))
        return F.struct((state["at"] + run["at"]).cast("int").alias("at"), F.array_append(state["runs"], base).alias("runs"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<base:int,found:{_FOUND}>>").alias("runs"))
    place = lambda x, base: F.struct((x["start"] + base).cast("int").alias("start"), (x["end"] + base).cast("int").alias("end"), x["match"].alias("match"))
    done = lambda s: F.flatten(F.transform(s["runs"], lambda r: F.transform(r["found"], lambda x: place(x, r["base"]))))
    return rows.select(*keep(lambda c: F.when(c.isNull(), F.array().cast(_FOUND)).otherwise(F.aggregate(c, start, moved, done))))


def segments(text: Column) -> Column:
    """A text in pieces of SEGMENT code points, so that a part of it is found without going through all that is before."""
    return F.when(F.length(text) > SEGMENT, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SEGMENT}}}"), F.lit(0))).otherwise(F.array(text))


def piece(pieces: Column, start: Column, size: Column) -> Column:
    """``size`` code points of a text in segments, from ``start`` (from 0)."""
    first, last = F.floor(start / SEGMENT).cast("int"), F.floor((start + size) / SEGMENT).cast("int")
    return F.substring(F.array_join(F.slice(pieces, first + 1, last - first + 1), ""), start - first * SEGMENT + 1, size)


def overlaps(found: Column, x: Column) -> Column:
    """Whether span ``x`` overlaps one of ``found``, which are in order and don't overlap: a binary search for the first that ends after its start."""

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        right = F.get(found, middle)["end"] <= x["start"]
        done = state["low"] >= state["high"]
        return F.struct(F.when(~done & right, middle + 1).otherwise(state["low"]).alias("low"), F.when(~done & ~right, middle).otherwise(state["high"]).alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(found) + 1)).cast("int"))
    at = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(found).alias("high")), halve, lambda s: s["low"])
    return F.when(F.size(found) == 0, False).otherwise(F.coalesce(F.get(found, at)["start"] < x["end"], F.lit(False)))
