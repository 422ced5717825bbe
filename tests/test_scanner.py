"""The JSON scanner against the standard library, in pieces of any size, and the places of its faults."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import scanner


def at(data, strict=True):
    try:
        scanner.scan(data, strict)
    except scanner.Fault as why:
        return why.code, why.path, why.line, why.column
    return None


@pytest.mark.parametrize(
    ("data", "want"),
    [
        (b'{"a":1}', None), (b"\xef\xbb\xbf1", ("bom", "$", 1, 1)), (b'{"a":[1,\n "x\xff"]}', ("utf8", "$.a[1]", 2, 4)), (b'{"a":1,"\\u0061":2}', ("repeated-key", "$.a", 1, 8)), (b"[1,\n\n  -1]", ("number", "$[1]", 3, 3)),
        (b'{"a":{"b c":[1.5]}}', ("number", '$.a["b c"][0]', 1, 14)), (b'"\\ud800"', ("surrogate", "$", 1, 1)), (b'["\x01"]', ("control", "$[0]", 1, 3)), (b"1 2", ("trailing", "$", 1, 3)), (b'{"a" 1}', ("syntax", "$.a", 1, 6)),
        (b"[1,]", ("syntax", "$[1]", 1, 4)), (b"", ("unfinished", "$", 1, 1)), (b'"abc', ("unfinished", "$", 1, 5)), (b'{"a":tru}', ("syntax", "$.a", 1, 6)), (b'"\\x"', ("escape", "$", 1, 2)), (b"[01]", ("number", "$[0]", 1, 2)),
        (b'{"k":1}\r\n}', ("trailing", "$", 2, 1)), (b"[" * 65, ("depth", "$" + "[0]" * 64, 1, 65)), ('["é🙂", x]'.encode(), ("syntax", "$[1]", 1, 8)), (b"\xc3", ("utf8", "$", 1, 1)), (b"1" * 400, ("number", "$", 1, 1)),
    ],
)
def test_places_of_faults(data, want):
    assert at(data) == want


def value(r, d=0):
    k = r.randrange(7 if d < 4 else 5)
    if k == 5:
        return {f"{i}{r.choice(['', '\"', 'é'])}": value(r, d + 1) for i in range(r.randrange(4))}
    if k == 6:
        return [value(r, d + 1) for _ in range(r.randrange(4))]
    return [r.randrange(10**6), None, True, 'é"\\\n x' * r.randrange(3), r.choice(["a", "b c", ""])][k]


def test_any_pieces_give_the_value():
    r = random.Random(1)
    for _ in range(2000):
        v = value(r)
        text = json.dumps(v, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1]))
        s, i = scanner.Scanner(), 0
        while i < len(text):
            n = r.randrange(1, 6)
            s.feed(text[i : i + n])
            i += n
        assert s.close() == v


def test_damaged_texts_are_refused_as_by_the_library():
    r = random.Random(2)
    for _ in range(3000):
        b = json.dumps(value(r), ensure_ascii=False).encode()
        j = r.randrange(len(b))
        b = b[:j] + bytes([r.randrange(256)]) + b[j + 1 :]
        try:
            json.loads(b.decode())
            fine = True
        except ValueError:
            fine = False
        found = at(b, strict=False)
        assert found is None if fine and (not found or found[0] != "repeated-key") else found, b


def test_long_strings_are_gone_through_once(monkeypatch):
    text = '["' + "a\\n" * 400_000 + '"]'
    seen = []

    class Counting:
        def match(self, text, at, rule=scanner._INSIDE):
            m = rule.match(text, at)
            seen.append(m.end() - at)
            return m

    monkeypatch.setattr(scanner, "_INSIDE", Counting())
    assert scanner.scan(text.encode()) == ["a\n" * 400_000]
    assert sum(seen) <= len(text)


def test_faults_of_a_column(spark):
    df = spark.createDataFrame([(1, '{"a":\n[1.5, x]}'), (2, "[-2e3]"), (3, None)], "id int, t string")
    got = {r.id: r.f and tuple(r.f) for r in df.select("id", scanner.fault(F.col("t")).alias("f")).collect()}
    assert got == {1: ("syntax", "$.a[1]", 2, 7), 2: None, 3: None}
