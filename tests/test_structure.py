"""Links and deletes, signatures, clustered scans, differences of documents, the manifest's profile, and a build with sources and policy."""

import copy
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import cli
from corpusloom.functions import ed25519
from corpusloom.operators import differences, gates, links, manifest
from corpusloom.operators.links import CASCADE, RESTRICT, SET_NULL, Link
from corpusloom.sinks import clustered, publish
from corpusloom.sources import captures


def link(name, child, parent, action=CASCADE, keys=("p",), parents=("k",)):
    return Link(name, child, keys, parent, parents, action)


def test_levels_and_cycles():
    some = [link("ab", "b", "a"), link("bc", "c", "b"), link("ac", "c", "a"), link("bb", "b", "b")]
    assert links.levels(some, ["c", "b", "a", "z"]) == [["a", "z"], ["b"], ["c"]]
    with pytest.raises(links.Cycle, match="a -> c -> a"):
        links.levels([*some, link("ca", "a", "c")], ["a", "b", "c"])
    with pytest.raises(ValueError, match="xq"):
        links.levels([link("xq", "x", "q")], ["x"])


def test_deletes_follow_the_links(spark):
    captures.ensure_checkpoints(spark)
    t = {
        "a": spark.createDataFrame([(1,), (2,)], "k int"),
        "tree": spark.createDataFrame([(1, 1, None), (2, 1, 1), (3, 2, 2), (4, 2, 3), (5, 2, None), (6, None, 5)], "k int, p int, up int"),
        "leaf": spark.createDataFrame([("x", 4), ("y", 5), ("z", None)], "v string, p int"),
        "note": spark.createDataFrame([("n", 3, 1), ("m", 5, 2)], "v string, p int, q int"),
    }
    some = [link("a_tree", "tree", "a"), Link("up", "tree", ("up",), "tree", ("k",)), link("leaf_tree", "leaf", "tree", SET_NULL), link("note_tree", "note", "tree", RESTRICT)]
    done = links.delete(t, some, "a", F.col("k") == 1)
    rows = lambda name: {tuple(r) for r in done.tables[name].collect()}
    assert rows("tree") == {(5, 2, None), (6, None, 5)} and rows("leaf") == {("x", None), ("y", 5), ("z", None)} and rows("note") == {("n", 3, 1), ("m", 5, 2)}
    assert {tuple(r) for r in done.refused.collect()} == {("note_tree", 1)}
    assert {tuple(r) for r in done.report.collect()} == {("a", 0, 1, 0, 1), ("tree", 1, 4, 0, 2), ("leaf", 2, 0, 1, 2 + 1), ("note", 2, 0, 0, 2)}
    fine = links.delete(t, [*some, Link("note_a", "note", ("q",), "a", ("k",))], "a", F.col("k") == 1)
    assert fine.refused.isEmpty() and [r.v for r in fine.tables["note"].collect()] == ["m"]  # what goes itself forbids nothing
    none = links.delete(t, some, "a", F.col("k") > 9)
    assert none.refused.isEmpty() and none.tables["tree"].count() == 6
    assert {tuple(r) for r in links.violations(t, [link("leaf_a", "leaf", "a"), link("note_a", "note", "a")]).collect()} == {("leaf_a", 2), ("note_a", 2)}


def test_links_are_reviewed(spark):
    known = [link("x", "b", "a"), link("y", "c", "b"), link("w", "c", "a")]
    found = [link("x", "b", "a", RESTRICT), link("y", "c", "b"), link("z", "c", "b")]
    assert {tuple(r) for r in links.review(spark, found, known).collect()} == {("x", "action"), ("z", "unexpected"), ("w", "missing")}


@pytest.mark.parametrize(
    ("seed", "key", "message", "signature"),
    [
        ("9d61b19deffd5a60ba844af492ec2cc44449c5697b326919703bac031cae7f60", "d75a980182b10ab7d54bfed3c964073a0ee172f3daa62325af021a68f707511a", "", "e5564300c360ac729086e2cc806e828a84877f1eb8e5d974d873e065224901555fb8821590a33bacc61e39701cf9b46bd25bf5f0595bbe24655141438e7a100b"),
        ("4ccd089b28ff96da9db6c346ec114e0f5b8a319f35aba624da8cf6ed4fb8a6fb", "3d4017c3e843895a92b70aa74d1b7ebc9c982ccf2ec4968cc0cd55f12af4660c", "72", "92a009a9f0d4cab8720e820b5f642540a2b27b5416503f8fb3762223ebdb69da085ac1e43e15996e458f3613d0f11d8c387b2eaeb4302aeeb00d291612bb0c00"),
        ("c5aa8df43f9f837bedb7442f31dcb7b166d38535076f094b85ce3a2e0b4458f7", "fc51cd8e6218a1a38da47ed00230f0580816ed13ba3303ac5deb911548908025", "af82", "6291d657deec24024827e69c3abe01a30ce548a284743a445e3680d7db5ac3ac18ff9b538d16f290ae67f760984dc6594a7c15e9716ed28dc027beceea1ec40a"),
    ],
)
def test_published_signatures(seed, key, message, signature):
    seed, key, message, signature = map(bytes.fromhex, (seed, key, message, signature))
    assert ed25519.public_key(seed) == key and ed25519.sign(seed, message) == signature and ed25519.verify(key, message, signature)
    assert not ed25519.verify(key, message + b"x", signature)
    for i in (0, 31, 32, 63):
        assert not ed25519.verify(key, message, signature[:i] + bytes([signature[i] ^ 1]) + signature[i + 1 :])
    high = (int.from_bytes(signature[32:], "little") + ed25519.L).to_bytes(32, "little")
    assert not ed25519.verify(key, message, signature[:32] + high) and not ed25519.verify(b"\xff" * 32, message, signature) and not ed25519.verify(key, message, b"")
    with pytest.raises(ValueError, match="32"):
        ed25519.sign(b"short", b"")


def test_signed_channel(spark, tmp_path):
    folder, seed = f"file://{tmp_path}", bytes(range(32))
    (tmp_path / "data.bin").write_bytes(b"abc")
    made = publish.channel(spark, folder, 4, "r4", "k1", seed)
    keys = {"k1": ed25519.public_key(seed)}
    assert publish.verified_channel(spark, folder, keys, than=3) == made and made["files"]["data.bin"]["bytes"] == 3
    for mark in tmp_path.glob(".*.crc"):  # the checksums of the local file system, which would refuse changed files by themselves
        mark.unlink()
    refused = lambda code: pytest.raises(gates.Refused, match=f"^{code}$")
    with refused("channel-version"):
        publish.verified_channel(spark, folder, keys, than=4)
    with refused("key-unknown"):
        publish.verified_channel(spark, folder, {})
    with refused("signature"):
        publish.verified_channel(spark, folder, {"k1": ed25519.public_key(bytes(32))})
    (tmp_path / "data.bin").write_bytes(b"abd")
    with refused("files"):
        publish.verified_channel(spark, folder, keys)
    text = (tmp_path / "channel.json").read_text()
    (tmp_path / "channel.json").write_text(text.replace("r4", "r5"))
    with refused("signature"):
        publish.verified_channel(spark, folder, keys)
    (tmp_path / "channel.json").write_text(text.replace(",", ", "))
    with refused("channel-json"):
        publish.verified_channel(spark, folder, keys)
    (tmp_path / "channel.json").unlink()
    with refused("channel-missing"):
        publish.verified_channel(spark, folder, keys)


def metrics(df):
    """Files and rows that the scan of an executed plan read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, found = [plan], {}
    while todo:
        node = todo.pop()
        told = node.metrics()
        if "Scan" in node.nodeName():
            for name in ("numFiles", "numOutputRows"):
                if told.contains(name):
                    found[name] = told.apply(name).value()
        todo += [node.children().apply(i) for i in range(node.children().length())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
    return found


def test_a_key_reads_its_files_only_and_in_order(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id % 40 as k", "(id * 7919) % 4000 as o", "repeat('x', 50) as v").repartition(5)
    n = clustered.write(rows, f"file://{tmp_path}/t", "k", ["o"], 20)
    assert n >= 15
    one = clustered.scan(spark, f"file://{tmp_path}/t", "k", 7)
    got = one.collect()
    assert [r.o for r in got] == sorted(r.o for r in rows.filter("k = 7").collect())
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "PushedFilters" in plan
    assert metrics(clustered.scan(spark, f"file://{tmp_path}/t", "k", 7))["numFiles"] <= 2  # of n
    assert clustered.scan(spark, f"file://{tmp_path}/t", "k", 5, 9).count() == 500 and clustered.scan(spark, f"file://{tmp_path}/t", "k", 99).count() == 0
    with pytest.raises(gates.Refused, match="null-key"):
        clustered.write(rows.withColumn("k", F.lit(None).cast("long")), f"file://{tmp_path}/u", "k", ["o"], 2)


def test_ranges_do_no_work_on_text_row_by_row(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 10 as k", "id as o")
    folder = f"file://{tmp_path}/odd name%20/t"
    n = clustered.write(rows, folder, "k", ["o"], 5)
    data = spark.read.parquet(f"{folder}/data")
    ranges = clustered.ranges_of(data, "k")
    assert "regexp" not in ranges._jdf.queryExecution().optimizedPlan().toString()
    assert ranges.count() == n and ranges.agg(F.sum("rows")).first()[0] == 1000
    assert {r.file for r in ranges.collect()} == {r.f for r in data.select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("f")).distinct().collect()}
    assert clustered.scan(spark, folder, "k", 3, 4).count() == 200


def compared(spark, a, b, **options):
    table = lambda v: spark.createDataFrame([(1, v if isinstance(v, str) or v is None else json.dumps(v))], "doc int, t string")
    return {tuple(r)[1:] for r in differences.differences(table(a), table(b), ["doc"], "t", **options).collect()}


def test_differences_name_each_place(spark):
    a = {"x": 1, "y": {"z": [1, {"q": None}], "w": "a"}, "k y": True}
    assert compared(spark, a, a, ordered=True) == set()
    b = {"y": {"w": "b", "z": [1, {"q": 0}, 5]}, "x": "1", "new": {"deep": [1]}}
    assert compared(spark, a, b) == {("$.x", "kind", "1", "1"), ("$.y.w", "value", "a", "b"), ("$.y.z[1].q", "kind", "null", "0"), ("$.y.z[2]", "unknown", None, "5"), ('$["k y"]', "missing", "true", None), ("$.new", "unknown", None, None)}
    assert compared(spark, {"a": 1, "b": 2}, {"b": 2, "a": 1}, ordered=True) == {("$.a", "place", "1", "1"), ("$.b", "place", "2", "2")}
    assert compared(spark, a, "{") == {("$", "missing", None, None)} and compared(spark, None, None) == set()
    kind = lambda *f: T.StructType([T.StructField(*x) for x in f])
    want = differences.schema_document(kind(("id", T.LongType(), False), ("v", T.StringType())), ["id"], {"v": ""})
    have = differences.schema_document(kind(("id", T.IntegerType(), False), ("v", T.StringType(), False), ("w", T.StringType())), ["v"], {"v": None})
    assert {(p, q) for p, q, *_ in compared(spark, want, have)} == {("$.id.type", "value"), ("$.id.key", "value"), ("$.v.nullable", "value"), ("$.v.default", "kind"), ("$.v.key", "value"), ("$.w", "unknown")}


def test_differences_join_documents_once(spark):
    a = spark.createDataFrame([(1, '{"x":{"y":[1]}}'), (2, '{"x":[0,{"q":1}]}'), (3, "1"), (4, "{"), (5, "[1]"), (None, '{"z":1}')], "doc int, t string")
    b = spark.createDataFrame([(1, '{"x":{"y":[1]}}'), (2, '{"x":{"0":0},"w":{"v":1}}'), (4, "{"), (5, "[1.0]"), (6, '"s"')], "doc int, t string")
    df = differences.differences(a, b, ["doc"], "t", ordered=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("ArrowEvalPython") == 1
    assert {tuple(r) for r in df.collect()} == {
        (2, "$.x", "kind", None, None), (2, "$.x[0]", "missing", "0", None), (2, "$.x[1]", "missing", None, None), (2, '$.x["0"]', "unknown", None, "0"), (2, "$.w", "unknown", None, None),
        (3, "$", "missing", "1", None), (5, "$[0]", "value", "1", "1.0"), (6, "$", "unknown", None, "s"), (None, "$", "missing", None, None),
    }


def good_manifest():
    row = lambda i: {"slug": f"s{i}", "docId": i, "versionId": i + 1, "name": f"n{i}", "articleCount": 2, "transitoryCount": 1, "gapCount": i, "frontMatter": "present" if i else "absent", "sourceUnitCoordinates": 3, "contentHash": "0" * 16, "contentIdentity": "1" * 16, "adoptedContentIdentity": "a" * 16}
    m = {"formatVersion": 3, "schemaVersion": 2, "fixtureSet": "f", "builtAt": "2026-01-01T00:00:00.000Z", "releaseGenerationId": "b" * 16, "identityAlgorithms": {"adopted": "corpus-authority-v2", "releaseEvidence": "corpus-release-evidence-v2"}}
    m |= {"totals": {"authorities": 2, "articles": 4, "transitories": 2, "gaps": 1, "frontMatterPresent": 1, "frontMatterAbsent": 1, "sourceUnitCoordinates": 6}, "normas": [row(0), row(1)], "releaseEvidenceIdentity": {"algorithm": "corpus-release-evidence-v2", "value": "b" * 16}}
    return m, [{k: n[k] for k in ("slug", "docId", "versionId", "name", "articleCount")} for n in m["normas"]]


def test_each_fault_of_a_manifest_is_named_by_its_path(spark):
    m, profile = good_manifest()
    said = lambda m: {(r.path, r.problem) for r in manifest.faults(spark, m, profile, "f").collect()}
    assert said(m) == set()
    bad = copy.deepcopy(m)
    bad |= {"fixtureSet": "g", "builtAt": "yesterday"}
    bad["identityAlgorithms"]["adopted"] = "other"
    bad["totals"]["frontMatterPresent"] = 2
    bad["totals"]["gaps"] = 9
    bad["normas"][0]["versionId"] = 8
    bad["normas"][0]["gapCount"] = "1"
    bad["normas"][1]["contentHash"] = "XYZ"
    bad["normas"][1]["more"] = 1
    bad["releaseEvidenceIdentity"]["value"] = "c" * 16
    assert said(bad) == {
        ("$.fixtureSet", "value"), ("$.builtAt", "kind"), ("$.identityAlgorithms.adopted", "value"), ("$.totals.frontMatterPresent", "value"), ("$.totals.gaps", "value"), ("$.normas[0].versionId", "value"), ("$.normas[0].gapCount", "kind"), ("$.normas[1].contentHash", "kind"),
        ("$.normas[1].more", "unknown"), ("$.releaseEvidenceIdentity.value", "value"),
    }
    short = copy.deepcopy(m)
    short["normas"].pop()
    assert ("$.normas[1]", "missing") in said(short)
    turned = {k: m[k] for k in reversed(m)}
    assert ("$.formatVersion", "place") in said(turned) and said({}) >= {("$.normas", "missing"), ("$.totals", "missing")}


def authority(slug, ident, rows):
    path = f"corpus-sources/v1/{slug}/{ident}-9"
    sha = "0" * 64
    capture = {"gzipPath": f"{path}.raw.json.gz", "sidecarPath": f"{path}.capture.json", "rawSha256": sha, "gzipSha256": sha, "uncompressedBytes": 1}
    entries = [{"kind": "emitted-article", "sourceUnitId": u, "domOrder": i, "caption": f"Ficha Artículo {i + 1}", "unitLabel": str(i + 1)} for i, u in enumerate(rows)]
    counts = {"emittedArticles": len(rows), "emittedTransitories": 0, "knownGaps": 0, "reviewedExclusions": 0, "total": len(rows)}
    known = {"slug": slug, "authorityId": ident, "versionId": 9, "profileMembership": {"app": True, "mcp": True}, "template": {"id": "t", "fingerprint": "f", "allowsZeroFicha": True}, "capture": capture, "expectations": {"frontMatter": "absent", "classifications": counts, "sourceUnitCoordinates": len(rows), "ledger": entries}}
    n = len(rows)
    seen = {"fichaAnchors": n, "parsedHandlers": n, "articleKind": n, "transitoryKind": 0, "zeroFicha": n, "authorityFicha": 0, "versionMatched": n, "distinctSourceUnitIds": n}
    side = {"formatVersion": 1, "slug": slug, "requestedHandle": {"authorityId": ident, "versionId": 9}, "template": {"id": "t", "fingerprint": "f"}, "request": {"method": "GET", "endpoint": "e"}, "response": {"status": 200, "contentType": {"mediaType": "text/html"}, "capturedAt": "x"}, "captureTool": {"name": "c", "version": "1"}, "artifacts": capture, "observedHandlers": seen}
    return known, side


def test_a_build_with_sources_and_policy(spark, tmp_path):
    (tmp_path / "in").mkdir()
    anchor = lambda n, unit: f"<a onclick='handleArticuloClick({n},0,9,{unit})'>Ficha Artículo {n}</a>"
    html = f"<html><p>ARTÍCULO 1.- uno</p></html>{anchor(1, 70)}<html><p>Derogado por ley</p></html>{anchor(2, 71)}"
    (tmp_path / "in" / "a.json").write_text(json.dumps({"html": html}))
    said = ['extractor returned 1 articles but the source contains 3 "ARTICULO N" occurrence(s) — possible off-template or many dropped']
    registry = [{"slug": "a", "fixture": "a.json", "id": 2, "version_id": 9, "treaty": False, "articles": 1, "warnings": said, "number": "1", "name": "x", "tipo": 1, "date": "d", "source_url": "u", "imported_at": "i"}]
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    known, side = authority("a", 2, [70, 71])
    where = tmp_path / "src" / known["capture"]["sidecarPath"]
    where.parent.mkdir(parents=True)
    where.write_text(json.dumps(side))
    (tmp_path / "src" / cli.CATALOG).write_text(json.dumps({"formatVersion": 1, "totals": {"authorities": 1}, "authorities": [known]}))
    entry = {"place": 0, "source_unit_id": 71, "caption": "Ficha Artículo 2", "base": 2, "ficha": 0, "order": 1, "source_lines": ["Derogado por ley"], "kind": "reviewed-exclusion", "reason": "source-elimination-notice"}
    policy = tmp_path / "policy.json"
    policy.write_text(json.dumps({"context": {"authorityId": 2, "versionId": 9}, "entries": [entry]}))
    build = lambda: cli.build(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", str(tmp_path / "registry.json"), f"file://{tmp_path}/src", str(policy))
    made = build()
    assert made["totals"]["gaps"] == 0 and made["totals"]["articles"] == 1 and made["normas"][0]["sourceUnitCoordinates"] == 1
    refuse = lambda code: pytest.raises(gates.Refused, match=f"^{code}$")
    policy.write_text(json.dumps({"context": {"authorityId": 2, "versionId": 9}, "entries": [entry | {"source_lines": ["otro"]}]}))
    with refuse("policy"):
        build()
    policy.write_text(json.dumps({"context": {"authorityId": 3, "versionId": 9}, "entries": [entry]}))
    with refuse("policy"):  # an id of the policy in a foreign context
        build()
    where.write_text(json.dumps(side | {"observedHandlers": side["observedHandlers"] | {"zeroFicha": 1}}))
    with refuse("sidecar"):
        build()
    where.write_text(json.dumps(side | {"template": {"id": "t", "fingerprint": "g"}}))
    with refuse("coverage"):
        build()
    where.write_text(json.dumps(side)[:-1])
    with refuse("source-json"):
        build()


def test_arguments_for_sources_and_policy():
    got = cli.parse(["--sources", "s", "--policy=p"], "/w", "/r")
    assert got["sources"] == "/w/s" and got["policy"] == "/w/p"


def test_contexts_decide_what_a_build_admits(spark, tmp_path):
    """The same lines in three authorities: only those that the registry admits have the odd headers."""
    (tmp_path / "in").mkdir()
    anchor = lambda n, v, unit: f"<a onclick='handleArticuloClick({n},0,{v},{unit})'>Ficha Artículo {n}</a>"
    registry = []
    for i, admits in ((1, None), (2, ["fifth"]), (3, ["loose"])):
        odd = f"<html><p>ARTÍCULO 4 quinquies.- cinco</p></html>{anchor(4, i, i * 10 + 4)}<html><p>Artículo 5 septies : siete</p></html>{anchor(5, i, i * 10 + 5)}<html><p>Artículo 6 quinquies º no</p></html>{anchor(6, i, i * 10 + 6)}"
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"html": f"<html><p>ARTÍCULO 1.- uno</p></html>{anchor(1, i, i * 10 + 1)}{odd}"}))
        made = {1: 1, 2: 2, 3: 3}[i]
        said = [f'extractor returned {made} articles but the source contains 8 "ARTICULO N" occurrence(s) — possible off-template or many dropped']
        registry.append({"slug": f"s{i}", "fixture": f"{i}.json", "id": i, "version_id": i, "treaty": False, "articles": made, "warnings": said, "admits": admits, "number": "1", "name": "x", "tipo": 1, "date": "d", "source_url": "u", "imported_at": "i"})
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    made = cli.build(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", str(tmp_path / "registry.json"))
    assert [n["articleCount"] for n in made["normas"]] == [1, 2, 3] and [n["gapCount"] for n in made["normas"]] == [3, 2, 1]
    _, tables = publish.current(spark, f"file://{tmp_path}/out")
    assert {(r.norma_id, r.number, r.body) for r in tables["article"].collect()} == {(1, "1", "uno"), (2, "1", "uno"), (3, "1", "uno"), (2, "4 quinquies", "cinco"), (3, "4 quinquies", "cinco"), (3, "5 septies", "siete")}
