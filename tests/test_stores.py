"""Strict sources, files, automata, indexes of segments and the commit log."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as X
from corpusloom.operators import automaton, extraction, full_text, segments, validators
from corpusloom.operators.gates import Refused
from corpusloom.sinks import commits, files
from corpusloom.sources import captures, strict

SHAPE = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.ArrayType(T.StructType([T.StructField("c", T.StringType(), False), T.StructField("d", T.BooleanType(), True)]), False), False), T.StructField("m", T.MapType(T.StringType(), T.LongType(), False), True)])


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ({"a": 1, "b": [], "m": {"x": 1}}, None), ({"a": 1, "b": [{"c": "x"}, {"c": "y", "d": None}]}, None), ({"b": [], "a": 1}, ("keys", "$")), ({"a": 1}, ("keys", "$")), ({"a": 1, "b": [], "z": 1}, ("keys", "$")),
        ({"a": True, "b": []}, ("kind", "$.a")), ({"a": None, "b": []}, ("kind", "$.a")), ({"a": 1, "b": [{"c": "x"}, {"c": 2}]}, ("kind", "$.b[1].c")), ({"a": 1, "b": [None]}, ("kind", "$.b[0]")), ({"a": 1, "b": [], "m": {"k y": "1"}}, ("kind", '$.m["k y"]')), ([], ("kind", "$")),
    ],
)
def test_shapes(value, want):
    assert strict.misshapen(value, SHAPE, "$", False) == want


def test_strict_reader(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    told = {"deep/z.json": b'{"a":2,"b":[]}', "a.json": b'{"a":1,"b":[{"c":"\xc3\xa9"}]}', "b.json": b"", "c.json": b'{"b":[],"a":1}', ".hidden.json": b"x", "_x.json": b"x", "note.txt": b"x"}
    for name, data in told.items():
        (tmp_path / "in" / name).write_bytes(data)
    for path in (f"file://{tmp_path}/in", f"{tmp_path}/in"):
        rows = strict.read(spark, path, SHAPE, part_bytes=20)
        got = {r.path.split("/in/")[1]: (r.code, r["at"], r.line, r["column"], r.bytes) for r in rows.collect()}
        assert got == {"a.json": (None, None, None, None, 24), "b.json": ("unfinished", "$", 1, 1, 0), "c.json": ("keys", "$", None, None, 14), "deep/z.json": (None, None, None, None, 14)}
        assert rows.rdd.getNumPartitions() >= 2
        assert sorted((r.a, [x.c for x in r.b]) for r in strict.values(rows, SHAPE).collect()) == [(1, ["é"]), (2, [])]
    (tmp_path / "none").mkdir()
    assert strict.read(spark, f"file://{tmp_path}/none").count() == 0


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a.bin", b"\x00\xff"), ("b.bin", None)], "name string, data binary")
    assert {r.name: r.bytes for r in files.write_files(df, f"file://{tmp_path}/out").collect()} == {"a.bin": 2, "b.bin": 0}
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.bin", "b.bin"] and (tmp_path / "out" / "a.bin").read_bytes() == b"\x00\xff"
    files.copied(spark, f"file://{tmp_path}/out/a.bin", f"file://{tmp_path}/out/b.bin")
    assert (tmp_path / "out" / "b.bin").read_bytes() == b"\x00\xff"
    made = files.one_entry_a_line({"generatedBy": "x", "n": 1}, "entries", [{"path": "é"}, {"path": "b"}])
    assert json.loads(made) == {"generatedBy": "x", "n": 1, "entries": [{"path": "é"}, {"path": "b"}]} and made.split("\n")[3:6] == ['  "entries": [', '    {"path": "é"},', '    {"path": "b"}']
    assert json.loads(files.one_entry_a_line({}, "entries", [])) == {"entries": []} and files.pretty({"a": [1]}) == '{\n  "a": [\n    1\n  ]\n}\n'


def test_listed_and_present_files(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "file string")
    present = spark.createDataFrame([("a",), ("b",), ("d",)], "name string")
    assert {(r.name, r.violation) for r in captures.listing_faults(listed, "file", present).collect()} == {("b", "repeated_event"), ("c", "lost"), ("d", "unknown")}
    assert [r.file for r in captures.missing_files(listed, "file", present).collect()] == ["c"]
    registry = spark.createDataFrame([("a", 1, 2), ("b", 1, 2)], "slug string, id long, version_id long")
    meta = spark.createDataFrame([("a", 1, 3), ("z", 1, 2)], "slug string, id long, version_id long")
    assert {tuple(r) for r in captures.metadata_faults(registry, meta).collect()} == {("a", "version"), ("z", "unknown")}


def test_days_snippets_and_human_texts(spark):
    df = spark.createDataFrame([("29/02/2024",), ("29/02/2023",), ("1/02/2023",), ("31/12/1999 ",), (None,)], "t string")
    assert [str(r[0]) for r in df.select(validators.day(F.col("t"))).collect()] == ["2024-02-29", "None", "None", "None", "None"]
    lines = spark.createDataFrame([(["ab", "🙂c", "d", "e"],)], "l array<string>")
    assert lines.select(X.snippet(F.col("l"), 3, 4), X.snippet(F.col("l"), 3, 5), X.snippet(F.col("l")), X.snippet(F.col("l"), 0)).first() == ("ab ", "ab 🙂", "ab 🙂c d", "")
    texts = ["a", "", " a", "é", "\xe9", "a​", "x" * 512, "🙂" * 257, None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").filter(validators.human(F.col("t")))
    assert {r.i for r in got.collect()} == {0, 4, 6}
    order = spark.createDataFrame([("￿",), ("🙂",), ("a",)], "t string").orderBy(X.utf16_order(F.col("t"))).collect()
    assert [r.t for r in order] == ["a", "🙂", "￿"]


def test_automaton_equals_a_loop(spark):
    r = random.Random(4)
    tables = {k: [r.randrange(5) for _ in range(5)] for k in "abc"}
    rows = [(d, i * r.choice([1, 7]) + o, r.choice("abcx")) for d, n, o in ((1, 1, 0), (2, 300, -150), (3, 40, 10**6), (4, 2, -3)) for i in range(n)]
    rows = list({(d, o): (d, o, k) for d, o, k in rows}.values())
    df = spark.createDataFrame(rows, "doc long, o long, k string").withColumn("step", automaton.table(F.col("k"), tables, [4, 3, 2, 1, 0]))
    want, ends = {}, {}
    for d, o, k in sorted(rows):
        s = ends.get(d, 2)
        ends[d] = tables.get(k, [4, 3, 2, 1, 0])[s]
        want[d, o] = (s, ends[d])
    for fan in (2, 5, 4096):
        got = automaton.states_at(df, "doc", "o", "step", 5, start=2, fan=fan)
        assert {(x.doc, x.o): (x.before, x.after) for x in got.collect()} == want
        final = automaton.final_states(df, "doc", "o", "step", 5, start=2, accepted=[0, 1], fan=fan)
        assert {x.doc: (x.state, x.accepted) for x in final.collect()} == {d: (s, s in (0, 1)) for d, s in ends.items()}
    none = df.limit(0)
    assert automaton.final_states(none, "doc", "o", "step", 5).count() == automaton.states_at(none, "doc", "o", "step", 5).count() == 0


def test_a_reviewed_policy_is_waited_for_in_order(spark):
    fields = "source_unit_id long, caption string, base long, ficha long, `order` long, source_lines array<string>"
    rows = [(5, "c", 1, 0, 3, ["x"]), (6, "d", 2, 0, 4, []), (8, "e", 2, 0, 9, ["y", "z"])]
    policy = spark.createDataFrame([(i, *p, "reviewed-exclusion", f"r{i}") for i, p in enumerate(rows)], f"place int, {fields}, kind string, reason string")
    moved = [rows[0], rows[1], (8, "e", 2, 0, 9, ["y"])]
    docs = {1: rows, 2: rows[:2], 3: moved, 4: [rows[1], rows[2]], 5: [*rows, (9, "f", 1, 0, 12, [])], 6: [(99, "q", 1, 0, 1, [])], 7: [rows[1]], 8: []}
    unbound = spark.createDataFrame([(d, *e) for d, es in docs.items() for e in es], f"doc long, {fields}")
    contexts = spark.createDataFrame([(d, 1 if d < 6 or d == 8 else 2, "t") for d in docs], "doc long, version long, template string")
    classes, faults = extraction.in_sequence(unbound, policy, contexts, {"version": 1, "template": "t"})
    assert {(c.doc, c.source_unit_id, c.reason) for c in classes.collect()} == {(1, 5, "r0"), (1, 6, "r1"), (1, 8, "r2")}
    assert {tuple(f) for f in faults.collect()} == {(2, "unfinished", 2), (3, "drift", 2), (4, "drift", 0), (5, "drift", 3), (7, "foreign-context", None), (8, "unfinished", 0)}


def test_commit_log(spark, tmp_path):
    log = commits.Log(spark, f"file://{tmp_path}/log")
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k long")
    assert log.state().version == 0 and log.versions() == []
    with pytest.raises(Refused, match="relation-missing"):
        log.read("t")
    log.append("t", rows(30, 10, 20), "id", "k")
    log.delete("t", F.col("k") >= 20)
    log.append("t", rows(5, 40), "id", "k")
    assert sorted(map(tuple, log.read("t").collect())) == [(5, 4), (10, 1), (40, 5)]  # the ids 2 and 3 are not given again
    assert sorted(map(tuple, log.read("t", log.state(1)).collect())) == [(10, 1), (20, 2), (30, 3)]
    with pytest.raises(Refused, match="schema"):
        log.append("t", rows(1))
    log.migrate("t", [("id", "long", None), ("k", "string", None), ("more", "long", 7)])
    assert sorted(map(tuple, log.read("t").collect())) == [(1, "10", 7), (4, "5", 7), (5, "40", 7)] and log.state().high["t"] == 5
    assert len(log.residue(2)) == 1 and log.vacuum(2) == 1 and log.residue(2) == [] and len(log.read("t", log.state(3)).collect()) == 3
    log.delete("t", F.lit(True))
    assert log.read("t").count() == 0 and log.read("t").columns == ["id", "k", "more"]
    with pytest.raises(Refused, match="version-missing"):
        log.state(99)


def test_two_writers(spark, tmp_path):
    """Both see the same version; one is retried, and neither loses its rows or shares an id."""
    root = f"file://{tmp_path}/log"
    commits.Log(spark, root).append("t", spark.createDataFrame([(0,)], "k long"), "id", "k")
    tries, meet = [], threading.Barrier(2, timeout=60)

    class Meeting(commits.Log):
        def _create(self, version, text):
            tries.append(version)
            if tries.count(2) <= 2 and version == 2:
                meet.wait()
            return super()._create(version, text)

    def write(k):
        Meeting(spark, root).append("t", spark.createDataFrame([(k,), (k + 1,)], "k long"), "id", "k")

    writers = [threading.Thread(target=write, args=(k,)) for k in (10, 20)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    got = sorted(map(tuple, commits.Log(spark, root).read("t").collect()))
    assert sorted(tries) == [2, 2, 3] and [k for k, _ in got] == [0, 10, 11, 20, 21] and sorted(i for _, i in got) == [1, 2, 3, 4, 5]
    log = commits.Log(spark, root)
    assert log._create(3, "{}") is False and log.state().version == 3
    with pytest.raises(Refused, match="conflict"):
        Losing(spark, root).append("t", spark.createDataFrame([(9, 9)], "k long, id long"))


class Losing(commits.Log):
    """A writer that another always comes before."""

    def _create(self, version, text):
        return False


def test_segments_equal_a_rebuild(spark, tmp_path):
    r = random.Random(6)
    index = segments.Index(commits.Log(spark, f"file://{tmp_path}/index"), "k", "t", most=3)
    texts: dict[int, str] = {}
    for turn in range(6):
        new = {r.randrange(12): " ".join(r.choices(["uno", "Dós", "tres", "x1"], k=r.randrange(0, 6))) for _ in range(4)}
        gone = set(r.sample(range(12), 3))
        frame = spark.createDataFrame(list(new.items()), "k long, t string")
        index.change(added=frame if turn != 2 else None, removed=spark.createDataFrame([(k,) for k in gone], "k long") if turn else None)
        texts = {k: t for k, t in texts.items() if k not in gone or not turn} | (new if turn != 2 else {})
        whole = full_text.index(spark.createDataFrame(list(texts.items()), "k long, t string"), "k", "t")
        assert sorted(map(tuple, index.postings().select("token", "k", "n", "first").collect())) == sorted(map(tuple, whole.select("token", "k", "n", "first").collect()))
        assert sorted(map(tuple, index.containing_all(["UNO", "dos"]).collect())) == sorted(map(tuple, full_text.containing_all(whole, "k", ["uno", "dos"]).collect()))
    state = index.merge()
    assert len(state.folders["postings"]) == 1
    raw = index.log.read("postings")
    assert raw.groupBy("token", "k").count().filter("count > 1").isEmpty() and raw.count() == whole.count()
    with pytest.raises(ValueError, match="nothing"):
        index.change()


def test_a_number_with_a_capital_accent_is_canonical(spark):
    html = "<html><p>ARTÍCULO 10 QUÁTER.- texto</p></html><a onclick='handleArticuloClick(10,0,9,70)'>Ficha Artículo 10 QUÁTER</a><html><p>ARTÍCULO 11 QUÁTER.- otro</p></html><a onclick='handleArticuloClick(11,0,9,71)'>Ficha Artículo 11</a>"
    captures.ensure_checkpoints(spark)
    found = extraction.extract(spark.createDataFrame([(1, html)], "doc long, html string"))
    assert [r.number for r in found.articles.orderBy("doc_order").collect()] == ["10 quáter", "11 quáter"]


def test_preflight_names_residue_and_lost_parents(spark, tmp_path):
    from corpusloom.operators.links import Link

    log = commits.Log(spark, f"file://{tmp_path}/log")
    log.append("parent", spark.createDataFrame([(1,), (2,)], "k long"))
    log.append("child", spark.createDataFrame([(1,), (3,), (None,)], "p long"))
    some = [Link("child_parent", "child", ("p",), "parent", ("k",)), Link("other", "x", ("p",), "parent", ("k",))]
    assert {tuple(r) for r in log.preflight(some).collect()} == {("link", "child_parent", 1)}
    lost = log.stage(spark.createDataFrame([(9,)], "k long"), "parent")
    assert {tuple(r) for r in log.preflight(some).collect()} == {("residue", lost, 1), ("link", "child_parent", 1)}
    log.delete("child", F.col("p") == 3)
    log.vacuum()
    assert log.preflight(some).isEmpty()
