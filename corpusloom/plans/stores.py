"""Queries of strict sources, automata, indexes of segments and the commit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import scanner
from corpusloom.operators import automaton, segments, validators
from corpusloom.plans.texts import _FOLD, _TOKENS
from corpusloom.session import ship, table
from corpusloom.sinks import commits, files
from corpusloom.sources import captures, strict


def _case(key: Column, values: dict[int, Column], other: Column) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return other if out is None else out.otherwise(other)


def _bytes(text: Column | str) -> Column:
    return F.encode(F.lit(text) if isinstance(text, str) else text, "UTF-8")


#: Bytes that the strict reader refuses, by a number, and why and where.
BROKEN: dict[int, tuple[tuple[str, ...], tuple[str, str, int, int]]] = {
    0: (("EFBBBF", "7B7D"), ("bom", "$", 1, 1)), 1: (("7B226B223A22", "FF", "227D"), ("utf8", "$.k", 1, 7)), 2: (("7B226B223A312C226B223A327D",), ("repeated-key", "$.k", 1, 8)), 3: (("7B226B223A0A202D317D",), ("number", "$.k", 2, 2)),
    4: (("5B225C7564383030225D",), ("surrogate", "$[0]", 1, 2)), 5: (("5B226101225D",), ("control", "$[0]", 1, 4)), 6: (("5B" * 65,), ("depth", "$" + "[0]" * 64, 1, 65)), 7: (("7B7D2078",), ("trailing", "$", 1, 4)),
    8: (("7B226B22",), ("unfinished", "$.k", 1, 5)),
}
KINDS = 12


def strict_sources(spark: SparkSession, d: str) -> DataFrame:
    """A file for each supplier, some broken, read strictly: the refusal of each, or what it says."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    fine = _bytes(F.to_json(F.struct(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))))
    data = _case(F.col("s_suppkey") % KINDS, {k: F.unhex(F.lit("".join(parts))) for k, (parts, _) in BROKEN.items()}, fine)
    folder = captures.shared_folder(spark, "strict")
    files.write_files(s.select(F.format_string("%09d.json", "s_suppkey").alias("name"), data.alias("data")), folder).count()
    rows = strict.read(spark, folder)
    key = F.regexp_extract("path", r"([0-9]+)\.json$", 1).cast("long")
    return rows.select(key.alias("s_suppkey"), "code", "at", "line", "column", F.get_json_object("json", "$.name").alias("name"), "sha256")


def json_fault_places(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "props")
    p, number = F.col("props"), F.col("event_id").cast("string")
    text = _case(F.col("event_id") % 6, {
        1: F.replace(p, F.lit("}"), F.lit("")), 2: F.concat(F.lit('{"a":\n['), p, F.lit(", x]}")), 3: F.concat(p, F.lit("1")), 4: F.concat(F.lit("["), p, F.lit(" "), p, F.lit("]")),
        5: F.concat(F.lit('{"e":'), number, F.lit(',"e":2}')),
    }, p)
    return e.select("event_id", scanner.fault(text).alias("f")).select("event_id", "f.code", "f.path", "f.line", "f.column")


def _nations(spark: SparkSession, d: str) -> DataFrame:
    """Authorities with a ledger, and the sidecars that go with them but for planted faults: (k, authority, sidecar)."""
    k = F.col("n_nationkey").cast("long")
    n = table(spark, d, "nation").select(k.alias("k"), F.regexp_replace(F.lower("n_name"), "[ _]", "-").alias("slug"), F.col("n_regionkey").cast("long").alias("version"))
    path = lambda ending: F.concat(F.lit("corpus-sources/v1/"), "slug", F.lit("/"), (F.col("k") + 1).cast("string"), F.lit("-"), F.col("version").cast("string"), F.lit(ending))
    entry = lambda i: F.struct(
        F.when(i == 0, "emitted-article").when(i == 1, "known-gap").otherwise("reviewed-exclusion").alias("kind"), (F.col("k") * 100 + i + 1).cast("long").alias("sourceUnitId"), i.cast("long").alias("domOrder"),
        F.concat(F.lit("Ficha Artículo "), (i + 1).cast("string"), F.when(i == 1, " Transitorio").otherwise("")).alias("caption"), F.when(i == 0, F.lit("1")).alias("unitLabel"),
        F.when(i == 1, "transitorio-inside-article-body").when(i == 2, "source-elimination-notice").alias("reason"),
    )
    n = n.withColumn("size", (F.col("k") % 3 + 1).cast("long"))
    sha = F.sha2("slug", 256)
    template = F.struct(F.lit("t").alias("id"), F.concat(F.lit("sha256:"), sha).alias("fingerprint"), (F.col("k") % 2 == 0).alias("allowsZeroFicha"))
    capture = F.struct(path(".raw.json.gz").alias("gzipPath"), path(".capture.json").alias("sidecarPath"), sha.alias("rawSha256"), sha.alias("gzipSha256"), F.col("k").alias("uncompressedBytes"))
    zero = lambda v: F.lit(v).cast("long")
    classes = F.struct(zero(1).alias("emittedArticles"), zero(0).alias("emittedTransitories"), F.when(F.col("size") > 1, 1).otherwise(0).cast("long").alias("knownGaps"), F.when(F.col("size") > 2, 1).otherwise(0).cast("long").alias("reviewedExclusions"), F.col("size").alias("total"))
    expected = F.struct(F.lit("absent").alias("frontMatter"), classes.alias("classifications"), F.least("size", F.lit(2)).cast("long").alias("sourceUnitCoordinates"), F.transform(F.sequence(F.lit(0), (F.col("size") - 1).cast("int")), entry).alias("ledger"))
    authority = F.struct("slug", (F.col("k") + 1).alias("authorityId"), F.col("version").alias("versionId"), F.struct(F.lit(True).alias("app"), F.lit(False).alias("mcp")).alias("profileMembership"), template.alias("template"), capture.alias("capture"), expected.alias("expectations"))
    fault = F.col("k") % 8
    handle = F.struct((F.col("k") + 1).alias("authorityId"), (F.col("version") + F.when(fault == 2, 1).otherwise(0)).cast("long").alias("versionId"))
    second = F.when(F.col("size") > 1, 1).otherwise(0).cast("long")
    seen = F.col("size") + F.when(fault == 1, 1).otherwise(0)
    handlers = F.struct(seen.alias("fichaAnchors"), seen.alias("parsedHandlers"), (seen - second + F.when(fault == 6, second).otherwise(0)).alias("articleKind"), (second - F.when(fault == 6, second).otherwise(0)).alias("transitoryKind"), F.when(fault == 5, seen).otherwise(0).cast("long").alias("zeroFicha"),
                        F.when(fault == 5, 0).otherwise(seen).cast("long").alias("authorityFicha"), seen.alias("versionMatched"), seen.alias("distinctSourceUnitIds"))
    artifacts = F.struct(F.col("authority.capture.gzipPath"), F.col("authority.capture.sidecarPath"), F.when(fault == 4, F.sha2(F.lit("x"), 256)).otherwise(sha).alias("rawSha256"), sha.alias("gzipSha256"), F.col("k").alias("uncompressedBytes"))
    response = F.struct(zero(200).alias("status"), F.struct(F.lit("text/html").alias("mediaType")).alias("contentType"), F.lit("2026-01-01T00:00:00.000Z").alias("capturedAt"))
    sidecar = F.struct(zero(1).alias("formatVersion"), "slug", handle.alias("requestedHandle"), F.struct(F.col("authority.template.id"), F.when(fault == 3, "sha256:").otherwise(F.col("authority.template.fingerprint")).alias("fingerprint")).alias("template"),
                       F.struct(F.lit("GET").alias("method"), F.lit("u").alias("endpoint")).alias("request"), response.alias("response"), F.struct(F.lit("c").alias("name"), F.lit("1").alias("version")).alias("captureTool"), artifacts.alias("artifacts"), handlers.alias("observedHandlers"))
    return n.withColumn("authority", authority).withColumn("sidecar", sidecar).select("k", "authority", "sidecar")


def sidecar_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Faults of sidecars against their catalog, both written as files and read strictly; every eighth sidecar isn't there, another has keys in the wrong order."""
    ship(spark)
    n = _nations(spark, d)
    folder = captures.shared_folder(spark, "sidecars")
    text = F.when(F.col("k") == 12, F.to_json(F.struct("sidecar.slug", "sidecar.formatVersion"))).otherwise(F.to_json("sidecar"))
    files.write_files(n.filter("k % 8 <> 7").select(F.concat(F.lpad(F.col("k").cast("string"), 6, "0"), F.lit(".capture.json")).alias("name"), _bytes(text).alias("data")), f"{folder}/in").count()
    listed = F.transform(F.array_sort(F.collect_list(F.struct("k", "authority"))), lambda x: x["authority"])
    totals = F.create_map(F.lit("authorities"), F.count(F.lit(1)))
    whole = n.agg(totals.alias("totals"), listed.alias("authorities")).select(F.to_json(F.struct(F.lit(1).cast("long").alias("formatVersion"), "totals", "authorities")).alias("t"))
    files.write_files(whole.select(F.lit("catalog.json").alias("name"), _bytes(F.col("t")).alias("data")), f"{folder}/catalog").count()
    known, refused = captures.catalog(spark, f"{folder}/catalog")
    docs, bad = captures.sidecars(spark, f"{folder}/in")
    at = F.regexp_extract("path", r"([0-9]+)\.capture\.json$", 1).cast("int")
    docs = docs.withColumn("ordinal", at).withColumn("path", F.col("artifacts.sidecarPath"))
    refusals = refused.unionByName(bad).select(F.col("code").alias("fault"), F.regexp_extract("path", r"([^/]+)$", 1).alias("path"))
    own = captures.sidecar_faults(docs).select(F.concat(F.lit("own-"), "fault").alias("fault"), F.col("slug").alias("path"))
    whole = validators.catalog_faults(known).unionByName(validators.authority_faults(known, captures.ledger(known))).select("fault", F.col("slug").alias("path"))
    return captures.coverage_faults(known, docs).select("fault", "path").unionByName(refusals).unionByName(own).unionByName(whole)


#: A protocol over events: the next state from each of new, known, looking, bought, failed.
PROTOCOL = {"signup": (1, 1, 2, 3, 4), "click": (0, 2, 2, 2, 4), "view": (0, 2, 2, 3, 4), "purchase": (4, 3, 3, 3, 4)}
ERROR, STATES, ACCEPTED = (0, 1, 1, 1, 4), 5, (1, 3)


def _protocol(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return e.withColumn("step", automaton.table(F.col("event_type"), PROTOCOL, ERROR))


def automaton_final(spark: SparkSession, d: str) -> DataFrame:
    return automaton.final_states(_protocol(spark, d), "user_id", "event_id", "step", STATES, accepted=ACCEPTED)


def automaton_states(spark: SparkSession, d: str) -> DataFrame:
    return automaton.states_at(_protocol(spark, d), "user_id", "event_id", "step", STATES).select("user_id", "event_id", "before", "after")


def index_segments(spark: SparkSession, d: str) -> DataFrame:
    """The postings after texts were added, removed, added again with more text, and merged."""
    ship(spark)
    items = table(spark, d, "benchmark").select("item_id", "text")
    index = segments.Index(commits.Log(spark, captures.shared_folder(spark, "index")), "item_id", "text", most=3)
    index.change(added=items)
    index.change(removed=items.filter("item_id % 3 = 0").select("item_id"))
    index.change(added=items.filter("item_id % 6 = 0").withColumn("text", F.concat(F.lit("again "), "text")), removed=items.filter("item_id % 7 = 1").select("item_id"))
    index.change(removed=items.filter("item_id % 5 = 4").select("item_id"))  # the fourth segment, which merges
    index.change(added=items.filter("item_id % 5 = 4"))
    return index.postings()


def allocated_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids after rows with the highest ones were deleted: none is given twice."""
    ship(spark)
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    log = commits.Log(spark, captures.shared_folder(spark, "relations"))
    log.append("customer", rows.filter("c_nationkey < 15"), "id", "c_custkey")
    log.delete("customer", F.col("id") > log.state().high["customer"] - 20)
    log.append("customer", rows.filter("c_nationkey >= 15"), "id", "c_custkey")
    log.migrate("customer", [("c_custkey", "long", None), ("id", "long", None), ("note", "string", "none")])
    return log.read("customer")


def _told(column: int, kind: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v[column]}'" if isinstance(v[column], str) else f"WHEN {k} THEN {v[column]}" for k, (_, v) in BROKEN.items())
    return f"CAST(CASE s_suppkey % {KINDS} {cases} END AS {kind})"


_HEX = " ".join(f"WHEN {k} THEN '{''.join(parts)}'" for k, (parts, _) in BROKEN.items())
_KIND = "CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END"
_TABLES = "[" + ", ".join(str(t[s]) for t in (*PROTOCOL.values(), ERROR) for s in range(STATES)) + "]"
_FOLDED = f"list_reduce(list_prepend(0, {{l}}), lambda s, k: {_TABLES}[k * {STATES} + s + 1])"
_SLUG = "replace(replace(lower(n_name), ' ', '-'), '_', '-')"
_SIDE = f"'corpus-sources/v1/' || {_SLUG} || '/' || (n_nationkey + 1) || '-' || n_regionkey || '.capture.json'"
QUERIES = {
    "strict_sources": (
        strict_sources,
        f"SELECT s_suppkey, {_told(0, 'VARCHAR')} AS code, {_told(1, 'VARCHAR')} AS at, {_told(2, 'BIGINT')} AS line, {_told(3, 'BIGINT')} AS \"column\", CASE WHEN s_suppkey % {KINDS} > 8 THEN s_name END AS name, "
        f"sha256(CASE WHEN s_suppkey % {KINDS} > 8 THEN encode('{{\"key\":' || s_suppkey || ',\"name\":\"' || s_name || '\"}}') ELSE unhex(CASE s_suppkey % {KINDS} {_HEX} END) END) AS sha256 FROM supplier",
    ),
    "json_fault_places": (
        json_fault_places,
        "SELECT event_id, CASE m WHEN 1 THEN 'unfinished' WHEN 2 THEN 'syntax' WHEN 3 THEN 'trailing' WHEN 4 THEN 'syntax' WHEN 5 THEN 'repeated-key' END AS code, "
        "CASE m WHEN 1 THEN '$.k' WHEN 2 THEN '$.a[1]' WHEN 3 THEN '$' WHEN 4 THEN '$[1]' WHEN 5 THEN '$.e' END AS path, CAST(CASE m WHEN 0 THEN NULL WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS line, "
        "CAST(CASE m WHEN 1 THEN n WHEN 2 THEN n + 4 WHEN 3 THEN n + 1 WHEN 4 THEN n + 3 WHEN 5 THEN length(CAST(event_id AS VARCHAR)) + 7 END AS BIGINT) AS \"column\" FROM (SELECT event_id, event_id % 6 AS m, length(props) AS n FROM events) x",
    ),
    "sidecar_coverage": (
        sidecar_coverage,
        f"WITH n AS (SELECT n_nationkey AS k, n_nationkey % 8 AS m, {_SLUG} AS slug, {_SIDE} AS path, n_nationkey % 3 + 1 AS size FROM nation) "
        "SELECT 'missing' AS fault, path FROM n WHERE m = 7 OR k = 12 UNION ALL SELECT 'keys', '000012.capture.json' UNION ALL SELECT 'total', path FROM n WHERE m = 1 UNION ALL SELECT 'kinds', path FROM n WHERE m = 1 "
        "UNION ALL SELECT 'handle', path FROM n WHERE m = 2 UNION ALL SELECT 'own-path', slug FROM n WHERE m = 2 UNION ALL SELECT 'template', path FROM n WHERE m = 3 UNION ALL SELECT 'artifacts', path FROM n WHERE m = 4 AND k <> 12 "
        "UNION ALL SELECT 'zero-ficha', path FROM n WHERE m = 5 AND k % 2 = 1 UNION ALL SELECT 'kinds', path FROM n WHERE m = 6 AND size > 1",
    ),
    "automaton_final": (
        automaton_final,
        f"SELECT user_id, state, state IN (1, 3) AS accepted FROM (SELECT user_id, {_FOLDED.format(l='list(k ORDER BY event_id)')} AS state FROM (SELECT user_id, event_id, {_KIND} AS k FROM events) e GROUP BY user_id) x",
    ),
    "automaton_states": (
        automaton_states,
        f"SELECT user_id, event_id, {_FOLDED.format(l='coalesce(earlier, [])')} AS before, {_FOLDED.format(l='list_append(coalesce(earlier, []), k)')} AS after FROM (SELECT user_id, event_id, k, "
        f"list(k) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM (SELECT user_id, event_id, {_KIND} AS k FROM events) e) x",
    ),
    "index_segments": (
        index_segments,
        "WITH b AS (SELECT item_id, CASE WHEN item_id % 6 = 0 AND item_id % 5 <> 4 THEN 'again ' || text ELSE text END AS text FROM benchmark WHERE item_id % 5 = 4 OR item_id % 6 = 0 OR (item_id % 3 <> 0 AND item_id % 7 <> 1)) "
        f"SELECT token, item_id, count(*) AS n, CAST(min(position) AS BIGINT) AS first FROM ({_TOKENS.format(k='item_id', f=_FOLD, t='b')}) x GROUP BY token, item_id",
    ),
    "allocated_ids": (
        allocated_ids,
        "WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS id FROM customer WHERE c_nationkey < 15), m AS (SELECT count(*) AS n FROM a) SELECT c_custkey, CAST(id AS BIGINT) AS id, 'none' AS note FROM a, m WHERE id <= n - 20 "
        "UNION ALL SELECT c_custkey, CAST(n + row_number() OVER (ORDER BY c_custkey) AS BIGINT), 'none' FROM customer, m WHERE c_nationkey >= 15",
    ),
}
