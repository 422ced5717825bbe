"""Measures of authorities, the manifest of a release and its check."""

from __future__ import annotations

import itertools
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import hashing
from corpusloom.operators import differences, gates, identity

#: The manifest's keys in their order, its versions and the shapes of times and identities.
EPOCH = "1970-01-01T00:00:00.000Z"
MEASURES = ["n_articles", "n_transitories", "n_gaps", "front_matter", "n_coordinates", "content_hash", "content_identity", "adopted_identity"]
BUILT, IDENTITY, STATES = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T", r"\A[0-9a-f]{16}\Z", ("present", "absent")
TOTALS = ("authorities", "articles", "transitories", "gaps", "frontMatterPresent", "frontMatterAbsent", "sourceUnitCoordinates")
NORMA = ("slug", "docId", "versionId", "name", "articleCount", "transitoryCount", "gapCount", "frontMatter", "sourceUnitCoordinates", "contentHash", "contentIdentity", "adoptedContentIdentity")
ROOT = ("formatVersion", "schemaVersion", "fixtureSet", "builtAt", "releaseGenerationId", "identityAlgorithms", "totals", "normas", "releaseEvidenceIdentity")


def relations(found, registry: DataFrame) -> dict[str, DataFrame]:
    """Relations at rest from what was extracted and a registry (id, version_id, number, name, tipo, date, source_url, imported_at)."""
    key = lambda df: df.withColumnRenamed("doc", "norma_id")
    from corpusloom.operators import loading

    nodes = loading.surrogate_ids(key(found.hierarchy), "norma_id", "doc_order", "norma_id")  # counted over all authorities, in their order
    place = nodes.select("norma_id", F.col("line").alias("_l"), F.col("id").alias("_id"))
    parents = place.withColumnRenamed("_l", "parent_line").withColumnRenamed("_id", "parent_id")
    tree = nodes.join(parents, ["norma_id", "parent_line"], "left").select("id", "norma_id", "kind", "label", "display_label", "doc_order", F.col("line").alias("extract_order"), "parent_id")
    at = place.withColumnRenamed("_l", "heading_line").withColumnRenamed("_id", "hierarchy_node_id")
    arts = key(found.articles).join(at, ["norma_id", "heading_line"], "left").select("norma_id", "number", "ordinal_raw", "body", "ficha_ref", "hierarchy_node_id", "doc_order", "extract_order", "source_unit_id")
    provs = key(found.provisions).join(at, ["norma_id", "heading_line"], "left").select("norma_id", "number", F.lit("").alias("ordinal_raw"), "attaches_to", "body", "label", "hierarchy_node_id", "doc_order", "extract_order", "source_unit_id")
    hashes = identity.content_hashes(arts)
    norma = registry.join(hashes, F.col("id") == F.col("norma_id"), "left").select("id", "version_id", "number", "name", "tipo", "date", "source_url", F.coalesce("content_hash", F.lit(f"{hashing.OFFSET:016x}")).alias("content_hash"), "imported_at")
    front = key(found.front_matter).select("norma_id", F.lit(1).alias("present"), "body")
    return {"norma": norma, "hierarchy_node": tree, "article": arts, "transitory_provision": provs, "source_gap": key(found.gaps), "norma_front_matter": front}


def measure(t: dict[str, DataFrame]) -> DataFrame:
    """A row for each authority with its counts and identities: one grouped scan for each relation."""
    count = lambda name, alias: t[name].groupBy("norma_id").agg(F.count(F.lit(1)).alias(alias), *([F.count("source_unit_id").alias(f"_{alias}")] if name != "source_gap" else []))
    rows = t["norma"].select(F.col("id").alias("norma_id"), "version_id", "name", "content_hash")
    for name, alias in (("article", "n_articles"), ("transitory_provision", "n_transitories"), ("source_gap", "n_gaps")):
        rows = rows.join(count(name, alias), "norma_id", "left")
    front = t["norma_front_matter"].select("norma_id", F.lit("present").alias("front_matter"))
    rows = rows.join(front, "norma_id", "left")
    v1 = identity.identities(identity.stream_v1(t["norma"], t["hierarchy_node"], t["article"], t["transitory_provision"]), hashing.AUTHORITY_V1, "content_identity")
    v2 = identity.identities(identity.stream_v2(t["norma"], t["hierarchy_node"], t["article"], t["transitory_provision"], t["norma_front_matter"], t["source_gap"]), hashing.AUTHORITY_V2, "adopted_identity")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    rows = rows.join(v1, "norma_id", "left").join(v2, "norma_id", "left")
    coordinates = zero("_n_articles") + zero("_n_transitories") + zero("n_gaps")
    return rows.select("norma_id", "version_id", "name", zero("n_articles").alias("n_articles"), zero("n_transitories").alias("n_transitories"), zero("n_gaps").alias("n_gaps"), F.coalesce("front_matter", F.lit("absent")).alias("front_matter"), coordinates.alias("n_coordinates"), "content_hash", "content_identity", "adopted_identity")


def build(measures: DataFrame, evidence: str, fixture_set: str, built_at: str = EPOCH) -> dict:
    """The manifest from the measures in profile order (with slug and ordinal); one row for each authority is collected."""
    rows = [r.asDict() for r in measures.orderBy("ordinal").collect()]
    total = lambda f: sum(map(f, rows))
    return {
        "formatVersion": 3, "schemaVersion": 2, "fixtureSet": fixture_set, "builtAt": built_at, "releaseGenerationId": evidence,
        "identityAlgorithms": {"adopted": hashing.AUTHORITY_V2, "releaseEvidence": hashing.EVIDENCE_V2},
        "totals": {
            "authorities": len(rows), "articles": total(lambda r: r["n_articles"]), "transitories": total(lambda r: r["n_transitories"]), "gaps": total(lambda r: r["n_gaps"]),
            "frontMatterPresent": total(lambda r: r["front_matter"] == "present"), "frontMatterAbsent": total(lambda r: r["front_matter"] == "absent"), "sourceUnitCoordinates": total(lambda r: r["n_coordinates"]),
        },
        "normas": [
            {"slug": r["slug"], "docId": r["norma_id"], "versionId": r["version_id"], "name": r["name"], "articleCount": r["n_articles"], "transitoryCount": r["n_transitories"], "gapCount": r["n_gaps"], "frontMatter": r["front_matter"],
             "sourceUnitCoordinates": r["n_coordinates"], "contentHash": r["content_hash"], "contentIdentity": r["content_identity"], "adoptedContentIdentity": r["adopted_identity"]}
            for r in rows
        ],
        "releaseEvidenceIdentity": {"algorithm": hashing.EVIDENCE_V2, "value": evidence},
    }


def expected(manifest: dict, profile: list[dict], fixture_set: str) -> dict:
    """What a manifest has to be, given the authorities of its profile in order (slug, docId, versionId, name, articleCount).

    What only the release itself can say is taken from the manifest where it
    has the right shape, and is null where it hasn't.
    """
    told = lambda d, k, fine: d.get(k) if isinstance(d, dict) and fine(d.get(k)) else None
    text = lambda shape: lambda v: isinstance(v, str) and re.search(shape, v) is not None
    count = lambda v: type(v) is int and 0 <= v <= gates.MAX_SAFE
    listed = manifest.get("normas")
    given = [n if isinstance(n, dict) else {} for n in listed] if isinstance(listed, list) else []
    kinds = {"transitoryCount": count, "gapCount": count, "frontMatter": STATES.__contains__, "sourceUnitCoordinates": count, "contentHash": text(IDENTITY), "contentIdentity": text(IDENTITY), "adoptedContentIdentity": text(IDENTITY)}
    rows = []
    for want, got in itertools.zip_longest(profile, given[: len(profile)], fillvalue={}):
        rows.append({k: want[k] if k in want else told(got, k, kinds[k]) for k in NORMA})
    total = lambda k: sum(n[k] or 0 for n in rows)
    present = sum(n["frontMatter"] == "present" for n in rows)
    totals = (len(rows), total("articleCount"), total("transitoryCount"), total("gapCount"), present, len(rows) - present, total("sourceUnitCoordinates"))
    ident = told(manifest, "releaseGenerationId", text(IDENTITY))
    return dict(zip(ROOT, (
        3, 2, fixture_set, told(manifest, "builtAt", text(BUILT)), ident, {"adopted": hashing.AUTHORITY_V2, "releaseEvidence": hashing.EVIDENCE_V2}, dict(zip(TOTALS, totals, strict=True)), rows,
        {"algorithm": hashing.EVIDENCE_V2, "value": ident},
    ), strict=True))


def faults(spark: SparkSession, manifest: dict, profile: list[dict], fixture_set: str) -> DataFrame:
    """(path, problem, was, now) of the places at which a manifest isn't what its profile asks for; an object's keys have to be in their order."""
    table = lambda d: spark.createDataFrame([(0, json.dumps(d, ensure_ascii=False))], "one int, text string")
    return differences.differences(table(expected(manifest, profile, fixture_set)), table(manifest), ["one"], "text", ordered=True).drop("one")


def check(manifest: dict, t: dict[str, DataFrame], profile: list[dict] | None = None, fixture_set: str | None = None) -> DataFrame:
    """All violations of a release by its manifest: usable, totals, measures, and the gates on the relations; with a profile also every place at which the manifest differs from it."""
    spark = t["norma"].sparkSession
    if tuple(manifest) != ROOT or (manifest["formatVersion"], manifest["schemaVersion"]) != (3, 2) or manifest["releaseGenerationId"] != manifest["releaseEvidenceIdentity"]["value"]:
        raise gates.Refused("manifest-unusable")
    if gates.generation(t) != 2:
        raise gates.Refused("schema-generation")
    normas = manifest["normas"]
    sums = {"articles": "articleCount", "transitories": "transitoryCount", "gaps": "gapCount", "sourceUnitCoordinates": "sourceUnitCoordinates"}
    if any(manifest["totals"][k] != sum(n[f] for n in normas) for k, f in sums.items()) or len({n["slug"] for n in normas}) < len(normas) or len({n["docId"] for n in normas}) < len(normas):
        raise gates.Refused("manifest-totals")
    names = dict(zip(["docId", "versionId", "name", "articleCount", "transitoryCount", "gapCount", "frontMatter", "sourceUnitCoordinates", "contentHash", "contentIdentity", "adoptedContentIdentity"], ["norma_id", "version_id", "name", *MEASURES], strict=True))
    kinds = "norma_id long, version_id long, name string, n_articles long, n_transitories long, n_gaps long, front_matter string, n_coordinates long, content_hash string, content_identity string, adopted_identity string"
    measured = spark.createDataFrame([tuple(n[k] for k in names) for n in normas], kinds)
    found = [gates.release(t), *gates.counts(measure(t), measured, ["version_id", "name", *MEASURES])]
    if profile is not None:
        where = faults(spark, manifest, profile, fixture_set or manifest["fixtureSet"])
        found.append(gates.violation(where.withColumn("norma_id", F.lit(None).cast("long")), "manifest-profile", detail=F.concat_ws(" ", "path", "problem")))
    return gates.union(found)


def text(manifest: dict) -> str:
    """The manifest as it is written: two spaces of indent and a line feed at the end."""
    return json.dumps(manifest, indent=2, ensure_ascii=False) + "\n"
