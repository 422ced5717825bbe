"""Golden rows of functions and grammars, and windows against a loop."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import canonical, hashing, numbers
from corpusloom.functions import text as X
from corpusloom.operators import extraction, grammar, loading, markup, segmentation, validators


def test_fnv():
    assert hashing.fnv1a64(["", "abcé", None]) == ["cbf29ce484222325", "fc181283ee07e846", None]
    state = hashing.OFFSET
    for unit in "x🙂".encode("utf-16-le")[::1] and [0x78, 0xD83D, 0xDE42]:
        state = ((state ^ unit) * hashing.PRIME) % 2**64
    assert hashing.fnv1a64(["a" * 50, "x🙂", ""])[1] == f"{state:016x}"


@pytest.mark.parametrize(
    ("raw", "want"),
    [("12 bis", "12 bis"), ("10 QUATER", "10 quáter"), ("10 quáter", "10 quáter"), ("１２", "12"), ("5° bis", "5 bis"), ("7 º", "7"), (" 3\xa0ter ", "3 ter"), ("12BIS", "12bis"), ("", ""), ("8 octies", "8 octies"), (None, None)],
)
def test_cited_numbers(raw, want):
    assert numbers.cited(raw) == want


def test_glued_tails_and_citations(spark):
    goes_on = ["bis", " BISx", " Bis2", ".5", ",5", "-2", "..2", "/b", ":00", ".º", "º", "α", "漢", "①", "ⓧ", "\u200bbis", " terx", " tercerox", " qua\u0301terx", "．５", "‥5", " TER°", " Quáter\u0301", "+1"]
    ends = ["", " ", ". Otro", ", y", " de la ley", " tercero", " terminación", " bisagras", " terapia", " ter", " bISx", ".", "; 5", "- 2", " octiesx", "．", " quater"]
    df = spark.createDataFrame([(t,) for t in [*goes_on, *ends, None]], "t string")
    assert {r.t for r in df.filter(numbers.is_glued(F.col("t"))).collect()} == set(goes_on)
    text = spark.createDataFrame([("artículos 12, 5° bis, 28 termina y ７ QUÁTER o 9 bisagras",)], "t string")
    assert text.select(numbers.citations(F.col("t"))).first()[0] == ["12", "5° bis", "28", "７ QUÁTER", "9"]


def kinds(spark, lines, **options):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc long, line long, text string")
    return {r.line: (r.kind, r.number, r.base, r.level) for r in grammar.classified(df, **options).collect()}


def test_grammar(spark):
    got = kinds(spark, ["ARTÍCULO 1.- Uno", "Artículo 2º. Dos", "ARTICULO 3 bis- x", "(*) A R TÍCULO 4. y", "artículo 5 de la ley", "Ficha Artículo 94  BIS", "Ficha Artículo 2 Transitorio", "TÍTULO PRIMERO", "CAPITULO XIV", "LIBRO II (*)", "SECCIÓN 3", "TRANSITORIO I.- x", "Transitorio al artículo 148. Por", "DISPOSICIONES TRANSITORIAS", "ARTÍCULO 376 quinquies.- x", "ARTICULO 6.texto", "Ficha Artículo 7 \n"])
    assert got == {
        0: ("A", "1", "1", None), 1: ("A", "2", "2", None), 2: ("A", "3 bis", "3", None), 3: ("A", "4", "4", None), 5: ("F", None, "94", None), 6: ("P", None, "2", None),
        7: ("H", None, None, 1), 8: ("H", None, None, 2), 9: ("H", None, None, 0), 10: ("H", None, None, 3), 11: ("T", "I", None, None), 12: ("T", "", None, None), 15: ("A", "6", "6", None),
    }
    assert 0 in kinds(spark, ["ARTÍCULO 376 quinquies.- x"], fifth_admitted=F.lit(True))
    assert kinds(spark, ["Artículo 1", "Artículo 2.", "ARTÍCULO 3 Texto", "PARTE I"], treaty=True) == {0: ("A", "1", "1", None), 2: ("A", "3", "3", None), 3: ("H", None, None, 0)}


def test_markup_lines_and_faults():
    html = "<p>uno <span>dos</span><br>tres&nbsp;</p><style>x</style><o:p>y</o:p><a onclick='handleArticuloClick(1,0,2,3)'>Ficha  Artículo 1</a> cola"
    got, faults, _ = markup.lines_of(html)
    assert [t for t, _ in got] == ["uno dos", "tres", "Ficha Artículo 1 cola"] and got[2][1]["unit"] == 3 and not faults
    assert markup.lines_of("<a onclick='handleArticuloClick(1,0,2,3,4)'>Ficha Artículo 1</a>")[1] == ["malformed-handler"]
    assert markup.lines_of("<a>Ficha Artículo 1</a>")[1] == ["anchor-without-handler"] and markup.lines_of("<a href='https://x'>Ficha Artículo 1</a>")[1] == []
    assert markup.lines_of("a\x1fb")[1] == ["reserved-character"]
    assert markup.fragments("a<html>b</html> <HTML x>c</HTML>d") == ["a", "<html>b</html>", "<HTML x>c</HTML>", "d"]


def test_a_parse_holds_few_payloads_at_once(spark):
    pages = ["<p>a<br>b</p>" * 100, None, "", "x" * (markup.HELD + 1), *["<p>é</p>" + "e" * (markup.HELD // 3 - 8)] * 8]
    parts = list(markup.parsed_parts([pa.array(pages, pa.string()), pa.array(["<p>c</p>"]), pa.array([], pa.string())]))
    sizes = [len(p) for p in parts]
    assert sizes == [3, 1, 3, 3, 2, 1]
    lines = [[line["text"] for line in row["lines"]] for p in parts for row in p.to_pylist()]
    assert lines == [[t for t, _ in markup.lines_of(p or "")[0]] for p in pages] + [["c"]]
    got = markup.line_stream(spark.createDataFrame(list(enumerate(pages)), "i long, t string").coalesce(1), "i", "t").groupBy("doc").count().collect()
    assert {r.doc: r["count"] for r in got} == {i: len(x) for i, x in enumerate(lines[:-1]) if x}


@pytest.mark.parametrize(
    ("data", "code"),
    [(b'{"a":1}', None), (b"\xef\xbb\xbf1", "bom"), (b"\xff", "utf8"), (b'{"a":1,"\\u0061":2}', "repeated-key"), (b"-1", "number"), (b"1.5", "number"), (b"01", "number"), (b"1e3", "number"), (b"9007199254740992", "number"), (b'"\\ud800"', "surrogate"), (b'"\x01"', "syntax"), (b"[" * 65 + b"]" * 65, "depth"), (b"1 2", "syntax"), (b'"a\\"[-1"', None)],
)
def test_strict_json(data, code):
    try:
        canonical.strict(data)
        assert code is None
    except canonical.Refused as why:
        assert str(why) == code


def test_canonical_json():
    assert canonical.canonical({"b": [1, 2.5, -0.0, None, True], "a": "é\n\ud800", "😀": 1e21, "￿": 1e-7}) == '{"a":"é\\n\\ud800","b":[1,2.5,"-0",null,true],"😀":1e+21,"￿":1e-7}'
    with pytest.raises(ValueError, match="finite"):
        canonical.canonical(float("nan"))


def test_text_functions(spark):
    df = spark.createDataFrame([(" a \xa0 b\ufeff",), ("\xa0 ",), ("🙂é",), ("E\u0301 x",)], "t string")
    got = df.select(X.collapse(F.col("t")), X.substantive(F.col("t")), X.utf16_length(F.col("t")), X.caption_key(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("a b", True, 7, "ab"), ("", False, 2, ""), ("🙂é", True, 3, "🙂é"), ("E\u0301 x", True, 4, "\xe9x")]


def test_source_urls(spark):
    html = "<a href='https://a'>Ficha Artículo 1</a><a href='https://b'>FICHA  ARTÍCULO 1</a><a href='https://c' onclick='handleArticuloClick(2,0,1,9)'>Ficha Artículo 2</a>"
    got = markup.source_urls(spark.createDataFrame([(1, html)], "doc long, html string"), "doc", "html").collect()
    assert {r.caption_key: r.href for r in got} == {"fichaartículo1": "https://a", "fichaartículo2": "https://c"}


def test_reviewed_policy(spark):
    schema = "doc long, source_unit_id long, caption string, base long, ficha long, `order` long, source_lines array<string>"
    unbound = spark.createDataFrame([(1, 5, "c", 1, 0, 3, ["x"]), (1, 6, "d", 2, 0, 4, []), (2, 7, "e", 1, 0, 0, ["y"])], schema)
    policy = spark.createDataFrame([(1, 5, "c", 1, 0, 3, ["x"], "known-gap", "source-text-unavailable"), (1, 6, "d", 2, 0, 4, [], "reviewed-exclusion", "source-elimination-notice"), (2, 7, "e", 1, 0, 0, ["z"], "known-gap", "x")], schema + ", kind string, reason string")
    fine, faults = extraction.matched_policy(unbound, policy)
    assert sorted(r.source_unit_id for r in fine.collect()) == [5, 6] and [(r.doc, r.place) for r in faults.collect()] == [(2, 1)]
    assert [r.source_unit_id for r in extraction.policy_faults(policy).collect()] == [7]


def test_recovered_headers_need_their_own_terminator(spark):
    lines = ["ARTÍCULO 1.- x", "Ficha Artículo 1", "Artículo 175 septies.- y", "texto", "Ficha Artículo 175", "Artículo 9 de otra ley", "Ficha Artículo 10"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc long, line long, text string")
    got = grammar.recovered(df, grammar.classified(df)).filter("kind = 'A'").orderBy("line").select("line", "number").collect()
    assert [tuple(r) for r in got] == [(0, "1"), (2, "175 septies")]


def test_catalog_faults(spark):
    from corpusloom.sources import captures

    path = {"gzipPath": "g", "sidecarPath": "s", "rawSha256": "0" * 64, "gzipSha256": "0" * 64, "uncompressedBytes": 1}
    row = {"kind": "emitted-article", "sourceUnitId": 5, "domOrder": 0, "caption": "Ficha Artículo 1", "unitLabel": "1", "reason": None}
    counts = {"emittedArticles": 1, "emittedTransitories": 0, "knownGaps": 0, "reviewedExclusions": 0, "total": 1}
    one = {"slug": "a", "authorityId": 2, "versionId": 1, "profileMembership": {"app": True, "mcp": False}, "template": None, "capture": path, "expectations": {"frontMatter": "absent", "classifications": counts, "sourceUnitCoordinates": 1, "ledger": [row]}}
    two = one | {"slug": "B!", "authorityId": 1, "profileMembership": {"app": False, "mcp": False}, "expectations": one["expectations"] | {"classifications": counts | {"total": 3}, "sourceUnitCoordinates": 7, "ledger": [row, row]}}
    rows = spark.createDataFrame([one, two], captures._AUTHORITY)
    assert {(r.slug, r.fault) for r in validators.authority_faults(rows, captures.ledger(rows)).collect()} == {("B!", f) for f in ("emittedArticles", "total", "ids", "coordinates", "membership", "slug")}
    assert {(r.slug, r.fault) for r in validators.catalog_faults(rows.coalesce(1)).collect()} == {("B!", "authorityId"), ("a", "gzipPath"), ("B!", "gzipPath"), ("a", "sidecarPath"), ("B!", "sidecarPath")}


def loop(events):
    """The units of one document as a loop over its events finds them."""
    out, i = {}, 0
    for end, (kind, base) in enumerate(events):
        if kind == "F":
            heads = [j for j in range(i, end) if events[j][0] == "A"]
            mine = next((j for j in heads if events[j][1] == base), None)
            out[end] = (mine, sum(mine is None or j < mine for j in heads), sum(mine is not None and j > mine for j in heads))
            i = end + 1
    return out


def test_windows_equal_the_loop(spark):
    r = random.Random(3)
    documents = {d: [(r.choice("HAFTP"), r.randrange(3)) for _ in range(r.randrange(1, 14))] for d in range(400)}
    rows = [(d, i, k, b) for d, es in documents.items() for i, (k, b) in enumerate(es)]
    got = segmentation.units(spark.createDataFrame(rows, "doc long, line long, kind string, base int")).collect()
    found = {d: {} for d in documents}
    for u in got:
        found[u.doc][u.end_line] = (u.head_line, u.n_dropped, u.n_within)
    assert found == {d: loop(es) for d, es in documents.items()}


def test_backfill_and_differences(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, "x")], "id int, Name string")
    assert loading.backfill(df, [("id", "long", None), ("more", "string", "")]).first() == (1, "")
    want = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("extra", T.StringType())])
    assert loading.schema_differences(df, want, "r") == [("r", "id", "type"), ("r", "name", "case"), ("r", "extra", "missing")]


def test_set_null_and_cascade(spark):
    gone = spark.createDataFrame([(1,)], "k int")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "fk int, v string")
    assert sorted((r.fk or 0, r.v) for r in loading.set_null(gone, "k", rows, "fk").collect()) == [(0, "a"), (0, "c"), (2, "b")]
    assert sorted(r.v for r in loading.cascade(gone, "k", rows, "fk").collect()) == ["b", "c"]


def test_long_texts_are_hashed_alike_alone_and_together():
    r = random.Random(3)
    texts = ["".join(r.choice("abé🙂") for _ in range(r.randrange(0, 90))) for _ in range(120)] + ["x" * 5000]
    assert hashing.fnv1a64(texts) == [hashing.fnv1a64([t])[0] for t in texts]
