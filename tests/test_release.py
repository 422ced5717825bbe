"""Captures to a checked release, on a document with every kind of unit."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import extraction, gates, identity, manifest
from corpusloom.sinks import publish
from corpusloom.sources.captures import ensure_checkpoints


def piece(text):
    return f"<html><body>{text}</body></html>"


def anchor(number, unit, more="", version=5):
    return f"<div><a onclick='handleArticuloClick({number}, 0, {version}, {unit});'>Ficha  Artículo {number}{more}</a></div>"


HTML = (
    piece("<p>Ley de prueba</p><p>Considerando algo</p><p>TÍTULO PRIMERO</p><p>DISPOSICIONES GENERALES</p><p>ARTÍCULO <span>1</span>.- Uno <b>dos</b><br>sigue</p>") + anchor(1, 11)
    + piece("<style>x</style><p>CAPÍTULO II</p><p>ARTICULO 2º.- Texto</p><p>ARTÍCULO 9.- cita</p>") + anchor(2, 12)
    + piece("<p>ARTÍCULO 3.- perdido</p><p>ARTÍCULO 4.- cuatro</p>") + anchor(4, 14, " BIS")
    + piece("<p>Texto no disponible</p>") + anchor(5, 15)
    + piece("<p>TRANSITORIO I.- Mientras tanto</p><p>rige</p>") + anchor(1, 16, " Transitorio")
)


@pytest.fixture(scope="module")
def found(spark):
    ensure_checkpoints(spark)
    return extraction.extract(spark.createDataFrame([(1, HTML), (2, ""), (3, None)], "doc long, html string"))


@pytest.fixture(scope="module")
def tables(spark, found, tmp_path_factory):
    registry = spark.createDataFrame([(1, 5, "1", "Ley", 1, "01/02/2003", "https://x", "1970-01-01T00:00:00.000Z"), (2, 6, "2", "Otra", 1, "01/02/2003", "https://y", "1970-01-01T00:00:00.000Z")], "id long, version_id long, number string, name string, tipo long, date string, source_url string, imported_at string")
    made = manifest.relations(found, registry)
    folder = str(tmp_path_factory.mktemp("relations"))
    publish.export(made, folder)
    return publish.load(spark, folder, made)


def test_units(found):
    rows = found.articles.orderBy("doc_order").select("number", "ordinal_raw", "body", "source_unit_id", "n_within").collect()
    assert [tuple(r) for r in rows] == [("1", "", "Uno dos sigue", 11, 0), ("2", "2º", "Texto ARTÍCULO 9.- cita", 12, 1), ("4 bis", "", "cuatro", 14, 0)]
    assert [tuple(r) for r in found.provisions.select("number", "body", "source_unit_id").collect()] == [("I", "Mientras tanto rige", 16)]
    assert [tuple(r) for r in found.dropped.select("number").collect()] == [("3",)]
    assert [tuple(r) for r in found.hierarchy.orderBy("line").select("kind", "display_label", "parent_line").collect()] == [("titulo", "DISPOSICIONES GENERALES", None), ("capitulo", None, 2)]
    assert found.front_matter.first()["body"] == "Ley de prueba Considerando algo"


def test_ledger_has_each_source_unit_once(found):
    rows = found.ledger.orderBy("order").select("source_unit_id", "kind", "reason").collect()
    assert [tuple(r) for r in rows] == [(11, "emitted-article", None), (12, "emitted-article", None), (14, "emitted-article", None), (15, "known-gap", "source-text-unavailable"), (16, "emitted-transitory", None)]
    assert gates.union(gates.ledger_gaps(found.gaps, found.ledger)).isEmpty()


def test_warnings_against_a_budget(spark, found):
    said = sorted(r.warning for r in found.warnings.collect())
    assert any("folded into the body" in w for w in said) and any('adopted "4 bis"' in w for w in said)
    left = gates.union(gates.publishable(found.warnings, found.warnings, found.dropped.limit(0)))
    assert left.isEmpty()
    none = found.warnings.limit(0)
    assert gates.union(gates.publishable(found.warnings, none, found.dropped)).count() == len(said) + 1


def make(back):
    measures = manifest.measure(back).withColumn("slug", F.concat(F.lit("n"), F.col("norma_id").cast("string"))).withColumn("ordinal", F.col("norma_id"))
    spark = measures.sparkSession
    ledgers = back["source_gap"].select(F.concat(F.lit("n"), F.col("norma_id").cast("string")).alias("slug"), F.col("doc_order").alias("ordinal"), "source_unit_id", F.lit("known-gap").alias("kind"), "reason")
    sidecars = spark.createDataFrame([("n1", "ab")], "slug string, digest string")
    evidence = identity.evidence("c", "f", sidecars, ledgers, measures.withColumn("n_articles", F.col("n_articles"))).first()[0]
    return manifest.build(measures, evidence, "fixtures-v1")


def test_publish_and_read_again(spark, tables, tmp_path):
    root = f"file://{tmp_path}"
    made = publish.publish(spark, tables, make, root)
    assert made["totals"] == {"authorities": 2, "articles": 3, "transitories": 1, "gaps": 1, "frontMatterPresent": 1, "frontMatterAbsent": 1, "sourceUnitCoordinates": 5}
    again, back = publish.current(spark, root)
    assert again == made and back["article"].count() == 3
    assert publish.publish(spark, tables, make, root)["releaseGenerationId"] == made["releaseGenerationId"]
    version = publish.read_text(spark, f"{root}/CURRENT")
    sheet = publish.channel(spark, f"{root}/versions/{version}", 3, "corpus-3")
    assert sheet["files"].keys() == {"corpus-manifest.json"}


def test_each_gate_names_what_it_stops(tables):
    made = make(tables)
    art = tables["article"]
    broken = tables | {
        "article": art.withColumn("body", F.when(F.col("number") == "1", "  ").otherwise(F.col("body"))).withColumn("source_unit_id", F.lit(11).cast("long")).withColumn("doc_order", F.col("doc_order") + 1),
        "hierarchy_node": tables["hierarchy_node"].withColumn("parent_id", F.lit(None).cast("long")),
        "norma_front_matter": tables["norma_front_matter"].withColumn("present", F.lit(0)),
    }
    found = manifest.check(made, broken).select("code").distinct().collect()
    assert {"blank-article", "source-id-shared", "content-hash", "order-article", "heading-parent", "front-matter-state", "measure"} <= {r.code for r in found}
    with pytest.raises(gates.Refused, match="schema-generation"):
        manifest.check(made, tables | {"article": art.drop("source_unit_id")})


def test_unreadable_releases(spark, tmp_path):
    with pytest.raises(gates.Refused, match="manifest-missing"):
        publish.current(spark, f"file://{tmp_path}/none")
