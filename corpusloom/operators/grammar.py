"""Line grammars as data: rules of (kind, level, pattern), tried in order, and the events that they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.numbers import base, header_number
from corpusloom.functions.text import trim
from corpusloom.operators.segmentation import owned_candidates

#: Ordinal words, and the patterns of headers, terminators and headings; (?iu) folds marked letters too.
ORDINAL = (
    "(?:PRIMERO|PRIMER|SEGUNDO|TERCERO|CUARTO|QUINTO|SEXTO|S[EÉ]PTIMO|SETIMO|S[EÉ]TIMO|OCTAVO|OCTAVENO|NOVENO|D[EÉ]CIMO|UNDECIMO|UNDÉCIMO|DUODECIMO|DUODÉCIMO|"
    "DECIMOTERCERO|DECIMOCUARTO|DECIMOQUINTO|DECIMOSEXTO|DECIMOS[EÉ]PTIMO|DECIMOS[EÉ]TIMO|DECIMOOCTAVO|DECIMONOVENO|VIG[EÉ]SIMO|TRIG[EÉ]SIMO|TRIGESIMOPRIMERO|UNICO|ÚNICO|[IVXLCDM]+|[0-9]+)"
)
UNIT = (
    r"(?iu)^[ \t]*(?:\(\*\)[ \t]*)?A[ \t]*R[ \t]*T[IÍ]CULOS?(?:[ \t]+|(?:\.[ \t]*)?)"
    r"([0-9]+(?:(?:[ \t]*(?:bis|ter|qu[aá]ter|quinquies))|(?:[ \t]*[º°]))?)"
    r"(?:[ \t]*\.?[ \t]*[-—][ \t]*|[ \t]*\.[ \t]+|[ \t]*\.(?=[0-9A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]))"
)
TREATY_UNIT = r"(?iu)^[ \t]*A[ \t]*R[ \t]*T[IÍ]CULO[ \t]+([0-9]+(?:[ \t]+(?:bis|ter|qu[aá]ter))?(?:[ \t]*[º°])?)(?![ \t]*[.,;:\-—])(?:[ \t]+|\z)"
TERMINATOR = r"(?iu)^[ \t]*Ficha[ \t]+Art[IÍ]culo[ \t]+([0-9]+)(?:[ \t]+(BIS|TER|QU[AÁ]TER))?[ \t]*\z"
PROVISION_TERMINATOR = r"(?iu)^[ \t]*Ficha[ \t]+Art[IÍ]culo[ \t]+([0-9]+)(?:[ \t]+(BIS|TER|QU[AÁ]TER))?[ \t]+Transitorio[ \t]*\z"
PROVISION = (
    rf"(?iu)^[ \t]*(?:DISPOSICI[OÓ]N(?:ES)?[ \t]+)?TRANSITOR(?:IO|IA|IOS|IAS)[ \t]+(?:AL[ \t]+ART[IÍ]CULO[ \t]+([0-9]+)|({ORDINAL}(?:[ \t]*[º°])?))"
    r"(?:[ \t]*\.?[ \t]*[-—][ \t]*|[ \t]*\.[ \t]+)"
)
HEADINGS = (
    ("libro", 0, rf"(?iu)^[ \t]*LIBRO[ \t]+{ORDINAL}(?:[ \t]*\(\*\))?[ \t]*\z"),
    ("titulo", 1, rf"(?iu)^[ \t]*T[IÍ]TULO[ \t]+{ORDINAL}(?:[ \t]*\(\*\))?[ \t]*\z"),
    ("capitulo", 2, rf"(?iu)^[ \t]*CAP[IÍ]TULO[ \t]+{ORDINAL}[ \t]*\z"),
    ("seccion", 3, rf"(?iu)^[ \t]*SECCI[OÓ]N[ \t]+{ORDINAL}[ \t]*\z"),
)
TREATY_HEADINGS = (("libro", 0, rf"(?iu)^[ \t]*PARTE[ \t]+{ORDINAL}[ \t]*\z"), *HEADINGS)


def classified(lines: DataFrame, treaty: bool = False, fifth_admitted: Column | None = None) -> DataFrame:
    """The lines that are events: (doc, line, kind, heading, level, number, ordinal_raw, base, suffix, attaches_to, text).

    The first rule that holds decides: terminator, unit header, heading,
    provision header. A header with the suffix quinquies is one only where
    ``fifth_admitted`` holds.
    """
    unit = TREATY_UNIT if treaty else UNIT
    text = F.col("text")
    admitted = ~F.regexp_extract(text, unit, 1).rlike("(?i)quinquies") | (F.lit(False) if fifth_admitted is None else fifth_admitted)
    rules = [(text.rlike(TERMINATOR), "F"), (text.rlike(PROVISION_TERMINATOR), "P"), (text.rlike(unit) & admitted, "A")]
    rules += [(text.rlike(p), f"H{level}{name}") for name, level, p in (TREATY_HEADINGS if treaty else HEADINGS)]
    rules.append((text.rlike(PROVISION), "T"))
    chain = F.when(*rules[0])
    for rule in rules[1:]:
        chain = chain.when(*rule)
    found = lines.select("doc", "line", "text", chain.alias("_k")).filter("_k is not null")
    kind = F.substring("_k", 1, 1)
    number = F.when(kind == "A", header_number(F.regexp_extract(text, unit, 1)))
    ended = F.when(kind == "F", F.regexp_extract(text, TERMINATOR, 1)).when(kind == "P", F.regexp_extract(text, PROVISION_TERMINATOR, 1))
    suffix = F.when(kind == "F", F.regexp_replace(F.lower(F.regexp_extract(text, TERMINATOR, 2)), "quater", "quáter"))
    blank = lambda c: F.when(c != "", c)
    return found.select(
        "doc", "line", kind.alias("kind"),
        F.when(kind == "H", F.substring("_k", 3, 20)).alias("heading"), F.when(kind == "H", F.substring("_k", 2, 1).cast("int")).alias("level"),
        F.coalesce(number["number"], F.when(kind == "T", F.regexp_extract(text, PROVISION, 2))).alias("number"), number["ordinal_raw"].alias("ordinal_raw"),
        F.coalesce(base(number["number"]), ended).alias("base"), blank(suffix).alias("suffix"),
        F.when(kind == "T", F.regexp_extract(text, PROVISION, 1)).alias("attaches_to"), "text",
    )


#: Headers that count only where the document is known to need them and the next terminator is their own.
RECOVERED_SUFFIXED = (
    r"(?iu)^[ \t]*A[ \t]*R[ \t]*T[IÍ]CULOS?(?:[ \t]+|(?:\.[ \t]*)?)([0-9]+(?:[ \t]+(?:quinquies|sexies|septies)))"
    r"(?:[ \t]*\.?[ \t]*[-—][ \t]*|[ \t]*\.[ \t]+|[ \t]*\.(?=[0-9A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]))"
)
RECOVERED_OPEN = (
    r"(?iu)^[ \t]*A[ \t]*R[ \t]*T[IÍ]CULOS?(?:[ \t]+|(?:\.[ \t]*)?)([0-9]+(?:[ \t]+(?:bis|ter|qu(?:a\u0301|\u00E1|a)ter|quinquies|sexies|septies))?)"
    r"(?:[ \t\u00A0]*:[ \t\u00A0]*|[ \t\u00A0]+)(?=\p{L}|\p{N})"
)


#: What is left of a line, or of its number, where a suffix and an ordinal sign are glued to each other.
_GLUED_TAIL = r"(?iu)^(?:bis|ter|qu(?:a\u0301|\u00E1|a)ter|quinquies|sexies|septies)(?:[ \t\u00A0]+|[ \t\u00A0]*[º°])"
_SUFFIXED = r"(?iu)[ \t\u00A0](?:bis|ter|qu(?:a\u0301|\u00E1|a)ter|quinquies|sexies|septies)$"


def glued_ordinal(text: Column, pattern: str) -> Column:
    """Whether a header of this shape lost its suffix to its text, or its text begins with the ordinal sign of its suffix: it is no header then."""
    tail, number = trim(F.regexp_replace(text, pattern, "")), trim(F.regexp_extract(text, pattern, 1))
    return tail.rlike(_GLUED_TAIL) | number.rlike(_SUFFIXED) & tail.rlike("^[º°]")


def recovered(lines: DataFrame, events: DataFrame) -> DataFrame:
    """Events with the headers that only looser shapes find, each proved by the terminator of its base that comes next.

    A line that is an event already is no candidate.
    """
    text = F.col("text")
    first, second = text.rlike(RECOVERED_SUFFIXED), text.rlike(RECOVERED_OPEN)
    shape = F.when(first, F.when(~glued_ordinal(text, RECOVERED_SUFFIXED), F.regexp_extract(text, RECOVERED_SUFFIXED, 1))).when(second & ~glued_ordinal(text, RECOVERED_OPEN), F.regexp_extract(text, RECOVERED_OPEN, 1))
    found = lines.select("doc", "line", "text", shape.alias("_n")).filter("_n is not null").join(events.select("doc", "line"), ["doc", "line"], "left_anti")
    number = header_number(F.col("_n"))
    found = found.select("doc", "line", "text", number["number"].alias("number"), number["ordinal_raw"].alias("ordinal_raw"), base(number["number"]).alias("base"))
    own = owned_candidates(events, found).select("doc", "line")
    made = found.join(own, ["doc", "line"], "left_semi").withColumn("kind", F.lit("A"))
    return events.unionByName(made, allowMissingColumns=True)


def adopted(number: Column, end_base: Column, end_suffix: Column) -> Column:
    """The number of a unit whose header lost the suffix that its terminator has."""
    lost = (number == end_base) & end_suffix.isNotNull()
    return F.when(lost, F.concat_ws(" ", number, end_suffix)).otherwise(number)
