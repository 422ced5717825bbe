"""Build a release from a folder of captures: python -m corpusloom.cli --fixturesDir F --outDir O --registry R [--sources S] [--policy P]."""

from __future__ import annotations

import json
import os
import sys

REFUSED = 2
FLAGS = ("--fixturesDir", "--outDir", "--registry", "--sources", "--policy")


class Refusal(Exception):
    def __init__(self, key: str, message: str):
        super().__init__(f"REFUSAL: {key}: {message}")
        self.key = key


def parse(argv: list[str], cwd: str, repo: str) -> dict[str, str]:
    """Folders from arguments (--flag value or --flag=value), or Refusal; the output may not lie in the repository if it is named."""
    got: dict[str, str] = {}
    rest = list(argv)
    while rest:
        flag, given, value = rest.pop(0).partition("=")
        if flag not in FLAGS:
            raise Refusal("ERR_UNKNOWN_FLAG", f"{flag!r} is none of {', '.join(FLAGS)}")
        value = value if given else rest.pop(0) if rest else ""
        if not value or value.startswith("-"):
            raise Refusal("ERR_UNKNOWN_FLAG", f"{flag} needs a value")
        got[flag] = value if "://" in value else os.path.normpath(os.path.join(cwd, value))
    inside = lambda p: p == repo or p.startswith(repo + os.sep)
    here = inside(os.path.normpath(cwd))
    if "--outDir" in got and inside(got["--outDir"]):
        raise Refusal("ERR_OUTDIR_IN_APP", "the output would lie in the repository")
    pinned = os.path.join(repo, "fixtures", "full")
    out = {"fixtures": got.get("--fixturesDir", pinned if here else os.path.join(cwd, "fixtures")), "out": got.get("--outDir", os.path.join(repo, "app", "public", "corpus") if here else os.path.join(cwd, "corpus-out"))}
    if inside(out["out"]) and out["fixtures"] != pinned:
        raise Refusal("ERR_FIXTURES_NOT_PINNED", "an output in the repository needs its own captures")
    more = {name: got[flag] for flag, name in (("--sources", "sources"), ("--policy", "policy")) if flag in got}
    return out | {"registry": got.get("--registry", os.path.join(out["fixtures"], "registry.json"))} | more


FIXTURE_SET = "fixtures-v1"
#: Names of the two grammars in the catalog's digest.
WORD, TREATY = "word", "treaty"
#: What the registry may admit for an authority: headers with the fifth suffix, headers of looser shapes.
FIFTH, LOOSE = "fifth", "loose"
REGISTRY = "array<struct<slug:string,fixture:string,id:long,version_id:long,number:string,name:string,tipo:long,date:string,source_url:string,imported_at:string,treaty:boolean,rules:string,allows_zero_ficha:boolean,articles:long,warnings:array<string>,admits:array<string>>>"


def authorities(spark, registry: str):
    """The registry's rows with their place in it; ``rules`` is filled in."""
    from pyspark.sql import functions as F

    text = spark.read.text(registry, wholetext=True).select(F.from_json("value", REGISTRY, {"mode": "FAILFAST"}).alias("r"))
    rows = text.select(F.posexplode("r").alias("ordinal", "a")).select("ordinal", "a.*")
    return rows.withColumn("rules", F.coalesce("rules", F.when(F.col("treaty"), TREATY).otherwise(WORD)))


def source_faults(rows, found) -> list:
    """What is wrong with the source events of captures (doc, html, version_id, allows_zero_ficha): marks, handlers, contexts, and ledgers that leave one out."""
    from pyspark.sql import functions as F

    from corpusloom.operators import extraction, gates, validators

    source = found.lines.filter("event is not null").select("doc", "line", "event.*")
    known = rows.select(F.col("doc").alias("_d"), "version_id", F.coalesce("allows_zero_ficha", F.lit(True)).alias("_zero"))
    fault = validators.context_fault(F.col("version"), F.col("ficha"), F.col("doc"), F.col("version_id"), F.col("_zero"))
    contexts = source.join(known, F.col("doc") == F.col("_d")).withColumn("_f", fault).filter("_f is not null")
    return [
        gates.violation(found.faults, "source-mark", "doc", detail=F.col("fault")),
        gates.violation(contexts, "source-context", "doc", ordinal="line", detail=F.col("_f")),
        gates.violation(extraction.incomplete(source, found.ledger), "source-ledger", "doc", ordinal="position"),
    ]


def counts_as_registered(found, listed) -> object:
    """Authorities with another number of articles than the registry expects."""
    from pyspark.sql import functions as F

    from corpusloom.operators import gates

    made = found.articles.groupBy(F.col("doc").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    rows = listed.join(made, F.col("id") == F.col("_d"), "left").filter("articles is not null and coalesce(_n, 0) <> articles")
    return gates.violation(rows, "article-count", "id", detail=F.coalesce("_n", F.lit(0)))


def digests(rows):
    """(catalog, fixtures): SHA-256 over the registry's expectations and over the captures' digests, in its order."""
    from pyspark.sql import functions as F

    from corpusloom.functions import hashing

    fold = lambda *parts: F.sha2(hashing.joined(F.concat(F.concat_ws("\x00", *[F.col(p).cast("string") for p in parts]), F.lit("\x01")), F.col("ordinal")), 256)
    return tuple(rows.agg(fold("slug", "id", "version_id", "articles", "rules"), fold("slug", "sha256")).first())


#: Reviewed classes of source units that no unit takes, with the context that they are for.
POLICY = "struct<context:struct<authorityId:long,versionId:long>,entries:array<struct<place:int,source_unit_id:long,caption:string,base:long,ficha:long,`order`:long,source_lines:array<string>,kind:string,reason:string>>>"


def reviewed_sources(spark, sources: str) -> tuple:
    """(sidecars, faults) of a folder with reviewed-input-catalog.json and sidecars, all read strictly."""
    from pyspark.sql import functions as F

    from corpusloom.operators import gates, validators
    from corpusloom.sources import captures

    known, refused = captures.catalog(spark, f"{sources}/{CATALOG}")
    docs, bad = captures.sidecars(spark, sources)
    docs = docs.withColumn("path", F.regexp_extract("path", r"(corpus-sources/v1/[^/]+/[^/]+)$", 1))
    docs = docs.join(known.select(F.col("capture.sidecarPath").alias("path"), "ordinal"), "path", "left")
    told = lambda rows, code, *says: gates.violation(rows.withColumn("_none", F.lit(None).cast("long")), code, "_none", detail=F.concat_ws(" ", *says))
    return docs, [
        told(refused.unionByName(bad), "source-json", "path", "code", "at"), told(captures.sidecar_faults(docs), "sidecar", "slug", "fault"), told(captures.coverage_faults(known, docs), "coverage", "path", "fault"),
        told(validators.catalog_faults(known).unionByName(validators.authority_faults(known, captures.ledger(known))), "catalog", "slug", "fault"),
    ]


CATALOG = "reviewed-input-catalog.json"


def policy_of(spark, path: str, found, listed) -> tuple:
    """(classes, faults) of the source events without unit by a reviewed policy, waited for one after the other."""
    from pyspark.sql import functions as F

    from corpusloom.operators import extraction, gates

    read = spark.read.text(path, wholetext=True).select(F.from_json("value", POLICY, {"mode": "FAILFAST"}).alias("p"))
    context, entries = read.select("p.context").first()[0], read.select(F.inline("p.entries"))
    loose = found.ledger.filter(F.col("kind") == extraction.GAP).select("doc", "source_unit_id")
    source = found.lines.filter("event is not null").select("doc", "line", "event.*").withColumnRenamed("unit", "source_unit_id").join(loose, ["doc", "source_unit_id"])
    contexts = listed.select(F.col("id").alias("doc"), F.col("id").alias("authorityId"), F.col("version_id").alias("versionId"))
    classes, faults = extraction.in_sequence(extraction.with_source_lines(found.lines, source), entries, contexts, context.asDict())
    return classes, [gates.violation(extraction.policy_faults(entries).withColumn("doc", F.lit(None).cast("long")), "policy-pair", "doc", detail=F.col("reason")), gates.violation(faults, "policy", "doc", ordinal="place", detail=F.col("fault"))]


def build(spark, fixtures: str, out: str, registry: str, sources: str | None = None, policy: str | None = None) -> dict:
    """Read, extract, check and publish; the registry is a JSON array of authorities with the name of their capture.

    All authorities go through at once, each by the rules of its context.
    ``sources`` is a folder with a catalog and sidecars, whose faults stop the
    build; ``policy`` a file of reviewed classes of source units.
    """
    from pyspark.sql import functions as F

    from corpusloom.operators import extraction, gates, identity, manifest, rules
    from corpusloom.session import ship
    from corpusloom.sinks import publish
    from corpusloom.sources import captures

    ship(spark)
    captures.ensure_checkpoints(spark)
    listed = authorities(spark, registry)
    files = captures.captures(spark, fixtures).withColumn("_name", F.element_at(F.split("path", "/"), -1))
    rows = listed.join(files, F.col("fixture") == F.col("_name"), "left")
    if not rows.filter(F.col("_name").isNull() | F.col("problem").isNotNull()).isEmpty():
        raise gates.Refused("input")
    docs = None
    if sources:
        docs, found_faults = reviewed_sources(spark, sources)
        for part in found_faults:  # files that can't be read first
            gates.require_none(part)
    admitted = {what: [(r.id, r.version_id) for r in listed.filter(F.array_contains("admits", what)).select("id", "version_id").collect()] for what in (FIFTH, LOOSE)}  # a row for each authority
    table = rules.standard(spark, admitted[FIFTH], admitted[LOOSE])
    contexts = listed.select(F.col("id").alias("doc"), F.col("rules").alias("template"), F.col("id").alias("authority"), F.col("version_id").alias("version"))
    captured = rows.withColumn("doc", F.col("id"))
    extracted = lambda classes=None: extraction.extract(captured.select("doc", "html"), policy=classes, classify=lambda lines: rules.events(lines, contexts, table))
    found = extracted()
    if policy:
        classes, policy_faults = policy_of(spark, policy, found, listed)
        gates.require_none(gates.union(policy_faults))
        found = extracted(classes.checkpoint())
    approved = listed.select(F.col("id").alias("doc"), F.explode("warnings").alias("warning"))
    gates.require_none(gates.union(source_faults(captured, found)))
    gates.require_none(gates.union([*gates.publishable(found.warnings, approved, found.dropped), *gates.ledger_gaps(found.gaps, found.ledger), counts_as_registered(found, listed)]))
    tables = manifest.relations(found, listed.select("id", "version_id", "number", "name", "tipo", "date", "source_url", "imported_at"))
    ledgers = found.ledger.join(listed.select(F.col("id").alias("doc"), "slug"), "doc").select("slug", F.col("order").alias("ordinal"), "source_unit_id", "kind", "reason")

    def describe(back):
        measures = manifest.measure(back).join(listed.select(F.col("id").alias("norma_id"), "slug", "ordinal"), "norma_id")
        sidecars = (rows if docs is None else docs).select("slug", F.col("sha256").alias("digest"))
        evidence = identity.evidence(*digests(rows), sidecars, ledgers, measures)
        return manifest.build(measures, evidence.first()[0], FIXTURE_SET)

    keys = {"slug": "slug", "docId": "id", "versionId": "version_id", "name": "name", "articleCount": "articles"}
    profile = [{k: r[c] for k, c in keys.items() if c != "articles" or r[c] is not None} for r in listed.orderBy("ordinal").collect()]  # a row for each authority
    for row in profile:
        row.setdefault("articleCount", None)
    complete = all(r["articleCount"] is not None for r in profile)
    return publish.publish(spark, tables, describe, out, profile if complete else None, FIXTURE_SET)


def main(argv: list[str]) -> int:
    from corpusloom.operators.gates import Refused

    try:
        paths = parse(argv, os.getcwd(), os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    except Refusal as why:
        print(why, file=sys.stderr)
        return REFUSED
    from pyspark.sql import SparkSession

    from corpusloom.session import SETTINGS

    spark = SparkSession.builder.config(map=SETTINGS).appName("corpusloom").getOrCreate()
    try:
        made = build(spark, **paths)
    except Refused as why:
        print(f"REFUSAL: {why.code}", file=sys.stderr)
        return REFUSED
    print(json.dumps(made["totals"]))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
