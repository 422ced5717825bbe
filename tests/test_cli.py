"""The command line, and a build of two authorities."""

import hashlib
import json

import pytest

from corpusloom import cli
from tests.test_release import HTML


@pytest.mark.parametrize(
    ("argv", "cwd", "key"),
    [(["--x"], "/w", "ERR_UNKNOWN_FLAG"), (["y"], "/w", "ERR_UNKNOWN_FLAG"), (["--outDir"], "/w", "ERR_UNKNOWN_FLAG"), (["--outDir="], "/w", "ERR_UNKNOWN_FLAG"), (["--outDir", "/r/x"], "/w", "ERR_OUTDIR_IN_APP"), (["--fixturesDir", "/f"], "/r", "ERR_FIXTURES_NOT_PINNED")],
)
def test_refusals(argv, cwd, key):
    with pytest.raises(cli.Refusal) as why:
        cli.parse(argv, cwd, "/r")
    assert why.value.key == key


def test_folders():
    assert cli.parse(["--outDir=o"], "/w", "/r") == {"fixtures": "/w/fixtures", "out": "/w/o", "registry": "/w/fixtures/registry.json"}
    assert cli.parse([], "/r/sub", "/r")["out"] == "/r/app/public/corpus"


def by_hand(folder, registry, made, ledgers):
    """The identity of a release from its registry, captures, ledgers and measures."""
    sha = lambda data: hashlib.sha256(data).hexdigest()
    captured = {r["slug"]: sha((folder / "in" / r["fixture"]).read_bytes()) for r in registry}
    catalog = sha("".join("\0".join([r["slug"], str(r["id"]), str(r["version_id"]), str(r["articles"]), "treaty" if r["treaty"] else "word"]) + "\1" for r in registry).encode())
    fixtures = sha("".join(f"{r['slug']}\0{captured[r['slug']]}\1" for r in registry).encode())
    values = ["catalog", catalog, "fixtures", fixtures]
    for slug in sorted(captured):
        values += ["sidecar", slug, captured[slug]]
    for slug in sorted(ledgers):
        values += ["ledger", slug, len(ledgers[slug]), *[x for row in ledgers[slug] for x in ("e", *row)]]
    for n in made["normas"]:
        values += ["measure", n["slug"], n["articleCount"], n["transitoryCount"], n["gapCount"], n["frontMatter"], n["sourceUnitCoordinates"], n["adoptedContentIdentity"]]
    framed = "".join("n;" if v is None else f"i{v};" if isinstance(v, int) else f"s{len(v)}:{v};" for v in values)
    state = 0xCBF29CE484222325
    for c in "corpus-release-evidence-v2;" + framed:
        state = (state ^ ord(c)) * 0x100000001B3 % 2**64
    return f"{state:016x}"


def test_build(spark, tmp_path):
    (tmp_path / "in").mkdir()
    clean = HTML.replace("<p>ARTÍCULO 3.- perdido</p>", "")
    treaty = "<html><p>Artículo 1</p><p>Los Estados</p></html><a onclick='handleArticuloClick(1,0,9,70)'>Ficha Artículo 1</a>"
    (tmp_path / "in" / "a.json").write_text(json.dumps({"html": clean}))
    (tmp_path / "in" / "b.json").write_text(json.dumps({"TextoNorma": treaty}))
    one = {"number": "1", "name": "x", "tipo": 1, "date": "01/01/2000", "source_url": "u", "imported_at": "1970-01-01T00:00:00.000Z"}
    said = ['article 2: 1 in-body "Artículo N" cross-reference(s) were folded into the body', 'article 4: header dropped the "bis" suffix present in its Ficha (Ficha Artículo 4 BIS); adopted "4 bis"', 'extractor returned 3 articles but the source contains 9 "ARTICULO N" occurrence(s) — possible off-template or many dropped']
    registry = [{"slug": "b", "fixture": "b.json", "id": 2, "version_id": 9, "treaty": True, "articles": 1, "warnings": [], **one}, {"slug": "a", "fixture": "a.json", "id": 1, "version_id": 5, "treaty": False, "articles": 3, "warnings": said, **one}]
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    made = cli.build(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", str(tmp_path / "registry.json"))
    assert made["totals"]["articles"] == 4 and made["totals"]["gaps"] == 1
    assert made["releaseGenerationId"] == by_hand(tmp_path, registry, made, {"a": [(11, "emitted-article", None), (12, "emitted-article", None), (14, "emitted-article", None), (15, "known-gap", "source-text-unavailable"), (16, "emitted-transitory", None)], "b": [(70, "emitted-article", None)]})
    assert [n["slug"] for n in made["normas"]] == ["b", "a"]  # as registered
    registry[1]["articles"] = 4
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    with pytest.raises(Exception, match="article-count"):
        cli.build(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", str(tmp_path / "registry.json"))
    registry[1]["articles"] = 3
    registry[0]["version_id"] = 10
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    with pytest.raises(Exception, match="source-context"):
        cli.build(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", str(tmp_path / "registry.json"))
    registry[0]["version_id"] = 9
    (tmp_path / "in" / "b.json").write_text(json.dumps({"TextoNorma": treaty + "<a onclick='handleArticuloClick(1,0,9)'>Ficha Artículo 1</a>"}))
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    with pytest.raises(Exception, match="source-mark"):
        cli.build(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", str(tmp_path / "registry.json"))
    (tmp_path / "in" / "b.json").write_text(json.dumps({"TextoNorma": treaty}))
    registry[1]["warnings"] = said[1:]
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    with pytest.raises(Exception, match="warning"):
        cli.build(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", str(tmp_path / "registry.json"))
