"""Captured HTML as an ordered stream of text lines with source events.

The parse is the one step that needs Python: a document's markup is one value.
Everything after it is DataFrame code over (doc, line).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITE, caption_key

#: Elements that end a line, elements that are dropped with all they hold, elements without end.
LINE_TAGS = frozenset("p div h1 h2 h3 h4 h5 h6 li tr section article header footer blockquote pre".split())
DROPPED = frozenset("style script head title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Fixed value: the handler of a source anchor, four plain integers and nothing else.
HANDLER = re.compile(r"handleArticuloClick\(\s*([0-9]+)\s*,\s*([0-9]+)\s*,\s*([0-9]+)\s*,\s*([0-9]+)\s*\)\s*;?\s*")
CAPTION = re.compile(r"Ficha\s+Art[íi]culo\s+[0-9]+(?:\s+(?:BIS|TER|QU[AÁ]TER))?(?:\s+Transitorio)?", re.I)
MARK = "\x1f"


def strip_structure(html: Column) -> Column:
    """Without the tags html, head and body, and those that begin like them."""
    return F.regexp_replace(html, r"(?i)</?(?:html|head|body)[^>]*>", "")


def fragments(html: str) -> list[str]:
    """The html elements of a payload and the text between them that isn't blank, in order."""
    out, end = [], 0
    for m in re.finditer(r"<html[\s>].*?</html>", html, re.I | re.S):
        out += [html[end : m.start()], m[0]]
        end = m.end()
    out.append(html[end:])
    return [x for x in out if x.strip()]


class _Lines(HTMLParser):
    """Writes text with a line feed at each end of a line element, and the events of source anchors at their lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.dropped: list[str] = []
        self.anchor: dict | None = None
        self.events: list[dict] = []
        self.faults: list[str] = []
        self.links: list[dict] = []
        self.open: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        if tag in DROPPED or tag.startswith("o:"):
            self.dropped.append(tag)
            return
        if self.dropped:
            return
        self.parts.append(" ")
        self.open.append(tag)
        if tag == "a":
            self.anchor = {"at": len(self.parts), "attrs": dict(attrs)}

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if self.dropped:
            if tag == self.dropped[-1]:
                self.dropped.pop()
            return
        if tag == "a" and self.anchor:
            self._event()
        if tag in self.open:
            while self.open and self.open.pop() != tag:
                pass
        self.parts.append("\n" if tag in LINE_TAGS else " ")

    def handle_data(self, data):
        if self.dropped:
            return
        if MARK in data:
            self.faults.append("reserved-character")
            data = data.replace(MARK, " ")
        self.parts.append(re.sub(r"[\r\n\f]+", " ", data))

    def _event(self):
        caption = " ".join("".join(self.parts[self.anchor["at"] :]).split())
        attrs, at = self.anchor["attrs"], self.anchor["at"]
        self.anchor = None
        if not CAPTION.fullmatch(caption):
            return
        onclick = (attrs.get("onclick") or "").strip()
        href = (attrs.get("href") or "").strip()
        if href:
            self.links.append({"caption": caption, "href": href})
        if not onclick:
            if not href.lower().startswith("https://"):
                self.faults.append("anchor-without-handler")
            return
        m = HANDLER.fullmatch(onclick)
        if not m or int(m[3]) < 1 or int(m[4]) < 1:
            self.faults.append("malformed-handler")
            return
        # the caption owns its line
        self.parts.insert(at, f"\n{MARK}{len(self.events)}{MARK}")
        base, ficha, version, unit = map(int, m.groups())
        self.events.append({"caption": caption, "base": base, "ficha": ficha, "version": version, "unit": unit, "kind": "P" if caption.upper().endswith("TRANSITORIO") else "F"})


_COLLAPSE = re.compile(r"[ \t\f\v]+")
_MARKED = re.compile(f"{MARK}([0-9]+){MARK}")
_EDGES = "".join(c for c in map(chr, range(0x10000)) if c.isspace() and c not in "\x1c\x1d\x1e\x1f\x85") + "﻿"


def lines_of(html: str) -> tuple[list[tuple[str, dict | None]], list[str], list[dict]]:
    """The lines of a payload with the source event that each carries, the faults found, and the links of captions."""
    out, faults, links, number = [], [], [], 0
    for piece in fragments(html):
        p = _Lines()
        p.feed(re.sub(r"(?i)</?(?:html|body)[^>]*>", "", piece))
        p.close()
        faults += p.faults
        links += p.links
        for raw in "".join(p.parts).split("\n"):
            marks = [int(x) for x in _MARKED.findall(raw)]
            text = _COLLAPSE.sub(" ", _MARKED.sub("", raw)).strip(_EDGES)
            if text:
                out.append((text, p.events[marks[0]] | {"order": number + marks[0]} if marks else None))
        number += len(p.events)
    return out, faults, links


_LINE = pa.struct([("text", pa.string()), ("caption", pa.string()), *[(x, pa.int64()) for x in ("order", "base", "ficha", "version", "unit")], ("kind", pa.string())])
_ARROW = pa.struct([("lines", pa.list_(_LINE)), ("faults", pa.list_(pa.string())), ("links", pa.list_(pa.struct([("caption", pa.string()), ("href", pa.string())])))])


#: Code points of payloads whose lines a Python worker holds at once; a longer payload is held by itself.
HELD = 1 << 20


def parsed_parts(batches: Iterable[pa.Array]) -> Iterator[pa.Array]:
    """What parsed() gives for the payloads of some batches, in order and in parts of at most HELD code points or one payload."""
    for payloads in batches:
        rows, held = [], 0
        for payload in payloads:
            html = payload.as_py() or ""
            if rows and held + len(html) > HELD:
                yield pa.array(rows, _ARROW)
                rows, held = [], 0
            got, faults, links = lines_of(html)
            rows.append({"lines": [{"text": t, **(e or {})} for t, e in got], "faults": faults, "links": links})
            held += len(html)
        if rows:
            yield pa.array(rows, _ARROW)


def parsed(html: Column) -> Column:
    """struct<lines, faults, links> of a payload; null gives no lines."""

    @F.arrow_udf("struct<lines:array<struct<text:string,caption:string,`order`:long,base:long,ficha:long,version:long,unit:long,kind:string>>,faults:array<string>,links:array<struct<caption:string,href:string>>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return parsed_parts(batches)

    return run(html)


def parse(captures: DataFrame, doc: str, html: str) -> DataFrame:
    """(doc, p) with p as parsed() has it; staged, it is the one parse that lines and faults need."""
    return captures.select(F.col(doc).alias("doc"), parsed(F.col(html)).alias("p"))


def lines_in(rows: DataFrame) -> DataFrame:
    """(doc, line, text, event) of what parse() gave; event is null where the line carries none."""
    lines = rows.select("doc", F.posexplode("p.lines").alias("line", "l"))
    event = F.when(F.col("l.unit").isNotNull(), F.struct(*[F.col(f"l.{x}").alias(x) for x in ("order", "caption", "base", "ficha", "version", "unit", "kind")]))
    return lines.select("doc", F.col("line").cast("long").alias("line"), F.col("l.text").alias("text"), event.alias("event"))


def faults_in(rows: DataFrame) -> DataFrame:
    """(doc, fault) of what parse() gave."""
    return rows.select("doc", F.explode("p.faults").alias("fault"))


def line_stream(captures: DataFrame, doc: str, html: str) -> DataFrame:
    """(doc, line, text, event) for each line of each capture; event is null where the line carries none."""
    return lines_in(parse(captures, doc, html))


def faults(captures: DataFrame, doc: str, html: str) -> DataFrame:
    """(doc, fault) for spoofed marks, anchors without handler and malformed handlers."""
    return faults_in(parse(captures, doc, html))


def source_urls(captures: DataFrame, doc: str, html: str) -> DataFrame:
    """(doc, caption_key, href): the first link of each caption, compared in NFC, lower case and without white space."""
    rows = captures.select(F.col(doc).alias("doc"), F.posexplode(parsed(F.col(html))["links"]).alias("at", "l"))
    keyed = rows.select("doc", "at", caption_key(F.col("l.caption")).alias("caption_key"), F.col("l.href").alias("href"))
    return keyed.groupBy("doc", "caption_key").agg(F.min_by("href", "at").alias("href"))


def clean_lines(text: Column) -> Column:
    """The lines of a plain text in order, blanks collapsed, empty ones left out."""
    clean = lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t\f\x0B]++", " "), rf"\A[{WHITE}]++|[{WHITE}]+\z", "")
    return F.filter(F.transform(F.split(text, "\n", -1), clean), lambda x: x != "")


def text_lines(rows: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, line, text): the lines of plain texts, numbered anew; all within a row."""
    return rows.select(F.col(doc).alias("doc"), F.posexplode(clean_lines(F.col(text))).alias("line", "text")).withColumn("line", F.col("line").cast("long"))
