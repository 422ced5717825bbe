"""A JSON scanner that takes a text in pieces and knows where it is: line, column and path.

One pass over the text: each piece is gone through once, a string that goes on
in the next piece included, and only what is open is held. Where a text is
wrong, the fault says in which value and at which place, and never what is
written there.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_SAFE, DEPTH = 9007199254740991, 64
#: Bytes of a document that are decoded and scanned at a time.
PIECE = 1 << 16

_SPACE = re.compile(r"[ \t\n\r]+")
_WORD = re.compile(r'[^ \t\n\r\[\]{}:,"]+')
_INSIDE = re.compile(r'(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+')
_PART = re.compile(r'\\(?:u[0-9A-Fa-f]{0,3})?\Z')
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_COUNT = re.compile(r"0|[1-9][0-9]*")
_LONE = re.compile("[\ud800-\udfff]")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_WORDS = {"true": True, "false": False, "null": None}


class Fault(ValueError):
    """What is wrong with a text, and where; ``place`` counts code points from 0, line and column from 1."""

    def __init__(self, code: str, path: str, line: int, column: int, place: int):
        super().__init__(f"{code} at {path} ({line}:{column})")
        self.code, self.path, self.line, self.column, self.place = code, path, line, column, place


def step(key: str | int) -> str:
    """One step of a path: .name, ["any text"] or [place]."""
    if isinstance(key, int):
        return f"[{key}]"
    return f".{key}" if _NAME.fullmatch(key) else f"[{json.dumps(key, ensure_ascii=False)}]"


class Scanner:
    """Takes the pieces of one JSON text; ``close`` gives its value.

    Codes of faults: repeated-key, number, surrogate, control, escape, depth,
    trailing, syntax, unfinished. With ``strict`` numbers are unsigned integers
    without leading zeros up to 2^53 - 1, and lone surrogates are faults.
    """

    def __init__(self, strict: bool = True, depth: int = DEPTH):
        self.strict, self.depth = strict, depth
        self.text, self.at, self.before = "", 0, 0  # what is open, the place in it, and code points before it
        self.line, self.line_start = 1, 0
        self.stack: list[list] = []  # [container, key]
        self.want, self.value = "value", None
        self.inside: list[str] | None = None  # pieces of an open string

    def path(self) -> str:
        steps = [step(len(c) if isinstance(c, list) else key) for c, key in self.stack if isinstance(c, list) or key is not None]
        return "$" + "".join(steps)

    def fault(self, code: str, at: int | None = None) -> Fault:
        place = self.before + (self.at if at is None else at)
        return Fault(code, self.path(), self.line, place - self.line_start + 1, place)

    def feed(self, text: str) -> None:
        self.before += self.at
        self.text, self.at = self.text[self.at :] + text, 0
        self._run(False)

    def close(self) -> object:
        self._run(True)
        if self.inside is not None or self.want != "end":
            raise self.fault("unfinished")
        return self.value

    def _run(self, last: bool) -> None:
        text, size = self.text, len(self.text)
        while self.at < size:
            if self.inside is not None:
                if not self._string(last):
                    return
                continue
            c = text[self.at]
            if c in " \t\n\r":
                m = _SPACE.match(text, self.at)
                lines = m[0].count("\n")
                if lines:
                    self.line += lines
                    self.line_start = self.before + m.start() + m[0].rindex("\n") + 1
                self.at = m.end()
            elif c == '"':
                if self.want not in ("value", "first", "key", "only"):
                    raise self.fault("trailing" if self.want == "end" else "syntax")
                self.inside = []
                self.opened, self.at = self.at + self.before, self.at + 1
            elif c in "[{":
                self._open([] if c == "[" else {})
            elif c in "]}":
                self._shut(list if c == "]" else dict)
            elif c == ":" and self.want == "colon":
                self.want, self.at = "value", self.at + 1
            elif c == "," and self.want == "next":
                self.want, self.at = "key" if isinstance(self.stack[-1][0], dict) else "value", self.at + 1
                if self.want == "key":
                    self.stack[-1][1] = None
            elif c in ":,":
                raise self.fault("trailing" if self.want == "end" else "syntax")
            else:
                m = _WORD.match(text, self.at)
                if m.end() == size and not last:
                    return  # it may go on
                self._word(m[0])
                self.at = m.end()

    def _string(self, last: bool) -> bool:
        """Go on with a string; False if more is needed."""
        m = _INSIDE.match(self.text, self.at)
        self.inside.append(m[0])
        self.at = m.end()
        if self.at == len(self.text):
            return False
        c = self.text[self.at]
        if c == "\\":
            if not last and _PART.match(self.text, self.at):
                return False
            raise self.fault("escape")
        if c != '"':
            raise self.fault("control")
        self.at += 1
        raw, self.inside = "".join(self.inside), None
        value = json.loads(f'"{raw}"') if "\\" in raw else raw
        is_key = self.want in ("key", "only")
        if is_key:
            frame = self.stack[-1]
            frame[1] = value
            if value in frame[0]:
                raise self.fault("repeated-key", self.opened - self.before)
        if self.strict and _LONE.search(value):
            raise self.fault("surrogate", self.opened - self.before)
        if is_key:
            self.want = "colon"
        else:
            self._put(value)
        return True

    def _word(self, word: str) -> None:
        if self.want not in ("value", "first"):
            raise self.fault("trailing" if self.want == "end" else "syntax")
        if word in _WORDS:
            self._put(_WORDS[word])
        elif self.strict:
            if not _COUNT.fullmatch(word) or len(word) > 16 or int(word) > MAX_SAFE:
                raise self.fault("number" if word[0] in "+-.0123456789" else "syntax")
            self._put(int(word))
        elif not _NUMBER.fullmatch(word):
            raise self.fault("number" if word[0] in "+-.0123456789" else "syntax")
        else:
            self._put(int(word) if word.lstrip("-").isdigit() and len(word) < 19 else float(word))

    def _open(self, container: list | dict) -> None:
        if self.want not in ("value", "first"):
            raise self.fault("trailing" if self.want == "end" else "syntax")
        if len(self.stack) == self.depth:
            raise self.fault("depth")
        self.stack.append([container, None])
        self.want, self.at = "first" if isinstance(container, list) else "only", self.at + 1

    def _shut(self, kind: type) -> None:
        if not self.stack:
            raise self.fault("trailing" if self.want == "end" else "syntax")
        if not isinstance(self.stack[-1][0], kind) or self.want not in ("next", "first" if kind is list else "only"):
            raise self.fault("syntax")
        container = self.stack.pop()[0]
        self.at += 1
        self._put(container)

    def _put(self, value: object) -> None:
        if not self.stack:
            self.value, self.want = value, "end"
            return
        container, key = self.stack[-1]
        if isinstance(container, list):
            container.append(value)
        else:
            container[key] = value
        self.want = "next"


def scan(data: bytes, strict: bool = True, shape: Callable[[object, str], tuple[str, str] | None] | None = None) -> object:
    """The value of JSON bytes, or Fault: besides the scanner's codes bom and utf8, and what ``shape`` finds (code, path) in the value, which has no place."""
    scanner = Scanner(strict)
    if data.startswith(b"\xef\xbb\xbf"):
        raise scanner.fault("bom")
    decoder = codecs.getincrementaldecoder("utf-8")()
    for start in range(0, len(data), PIECE):
        piece = data[start : start + PIECE]
        try:
            text = decoder.decode(piece, start + PIECE >= len(data))
        except UnicodeDecodeError as why:
            scanner.feed(why.object[: why.start].decode("utf-8"))  # faults before it come first
            raise scanner.fault("utf8", len(scanner.text)) from None
        scanner.feed(text)
    value = scanner.close()
    found = shape(value, "$") if shape else None
    if found:
        raise Fault(*found, 0, 0, 0)
    return value


_FOUND = pa.struct([("code", pa.string()), ("path", pa.string()), ("line", pa.int64()), ("column", pa.int64())])


def fault(text: Column, strict: bool = False) -> Column:
    """struct<code, path, line, column> of the first fault of a JSON text or of JSON bytes, null if there is none; null stays null."""

    @F.arrow_udf("struct<code:string,path:string,line:long,column:long>")
    def run(values: pa.Array) -> pa.Array:
        out = []
        for value in values:
            found, data = None, value.as_py()
            if data is not None:
                try:
                    scan(data, strict)
                except Fault as why:
                    found = {"code": why.code, "path": why.path, "line": why.line, "column": why.column}
            out.append(found)
        return pa.array(out, _FOUND)

    return run(text.cast("binary"))
