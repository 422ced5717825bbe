"""Queries of validators, inventories, extraction and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import extraction, validators
from corpusloom.plans.texts import synthetic_captures
from corpusloom.session import table
from corpusloom.sources.captures import ensure_checkpoints
from corpusloom.streaming import ingest


def ledger_rows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type", "user_id")
    kinds = F.create_map(*[F.lit(x) for x in ("signup", "emitted-article", "click", "emitted-transitory", "view", "known-gap", "purchase", "reviewed-exclusion", "error", "other")])
    kind = kinds[F.col("event_type")]
    ending = F.when((kind == "emitted-transitory") | (F.col("event_id") % 10 == 3), " Transitorio").otherwise("")
    return e.select(
        F.col("user_id").cast("string").alias("slug"), F.col("event_id").alias("domOrder"), kind.alias("kind"), (F.col("event_id") % 6).alias("sourceUnitId"),
        F.concat(F.lit("Ficha Artículo "), F.col("event_id").cast("string"), ending).alias("caption"),
        F.when(kind.startswith("emitted"), F.concat(F.when(F.col("event_id") % 7 == 0, "0").otherwise(""), (F.col("event_id") + 1).cast("string"))).alias("unitLabel"),
        F.when(kind == "known-gap", "source-text-unavailable").when(kind == "reviewed-exclusion", F.when(F.col("event_id") % 4 == 0, "no-reason").otherwise("source-elimination-notice")).alias("reason"),
    )


def ledger_faults(spark: SparkSession, d: str) -> DataFrame:
    rows = ledger_rows(spark, d)
    return rows.select("domOrder", F.coalesce(validators.ledger_fault(F.col("domOrder")), F.lit("")).alias("fault"))


def timestamps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id")
    n = F.col("event_id")
    stamp = F.format_string("%04d-%02d-%02dT%02d:%02d:%02d.%03dZ", n % 3 + 1999, n % 14, n % 33, n % 26, n % 61, n % 62, n % 1000)
    return e.select("event_id", validators.timestamp(stamp).alias("valid"))


def safe_integers(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    text = F.when(n % 3 == 0, n.cast("string")).when(n % 3 == 1, F.concat(F.lit("9007199254740"), F.lpad((n % 1000).cast("string"), 3, "0"))).otherwise(F.concat(F.lit("-"), n.cast("string")))
    return table(spark, d, "events").select("event_id", validators.integer_text(text).alias("value"))


def key_order(spark: SparkSession, d: str) -> DataFrame:
    json = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")))).otherwise(F.to_json(F.struct(F.lit(2).alias("b"), F.lit(1).alias("a"))))
    return table(spark, d, "events").select("event_id", validators.exact_keys(json, ["a", "b"]).alias("exact"))


def slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", validators.slug(F.translate(F.lower(F.concat_ws("-", "c_mktsegment", F.substring("c_name", 10, 9))), "#", "")).alias("ok"), validators.slug(F.col("c_name")).alias("raw_ok"))


def event_context(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id")
    fault = validators.context_fault(F.col("event_id") % 5, F.col("user_id") % 3, F.lit(2), F.lit(1), F.col("event_id") % 2 == 0)
    return e.select("event_id", F.coalesce(fault, F.lit("")).alias("fault"))


def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "nation").select(F.explode(F.array(
        F.concat(F.lit("c/v1/"), F.lower("n_name"), F.lit(".capture.json")), F.concat(F.lit("c/v1/"), F.lower("n_name"), F.lit(".raw.json.gz")), F.concat(F.lit("c/v1/Dictamen-"), F.col("n_nationkey").cast("string")), F.concat(F.lit("c/v1/x"), F.col("n_nationkey").cast("string")),
    )).alias("path")).unionByName(spark.createDataFrame([("c/v1/catalog.json",)], "path string"))
    known = table(spark, d, "nation").filter("n_regionkey <> 3").select(F.struct(F.concat(F.lit("c/v1/"), F.lower("n_name"), F.lit(".capture.json")).alias("sidecarPath"), F.concat(F.lit("c/v1/"), F.lower("n_name"), F.lit(".raw.json.gz")).alias("gzipPath")).alias("capture"))
    return validators.inventory(files, known, "c/v1/catalog.json")


def import_edges(spark: SparkSession, d: str) -> DataFrame:
    text = F.format_string("import { a } from './m%d.js';\nimport x from \"node:fs\";\nexport * from '@scope/p%d/sub';\nconst y = 1;", "n_regionkey", "n_nationkey")
    return validators.imports(table(spark, d, "nation").select(F.col("n_name").alias("path"), text.alias("text")))


def _extracted(spark: SparkSession, d: str) -> extraction.Extracted:
    ensure_checkpoints(spark)
    return extraction.extract(synthetic_captures(spark, d))


def extract_articles(spark: SparkSession, d: str) -> DataFrame:
    return _extracted(spark, d).articles.select("doc", "number", "source_unit_id", F.col("doc_order").cast("long").alias("doc_order"), F.length(F.regexp_replace("body", r"\s+", "")).cast("long").alias("body_chars"))


def extract_ledger(spark: SparkSession, d: str) -> DataFrame:
    return _extracted(spark, d).ledger.select("doc", "order", "source_unit_id", "kind", "unit_label", "reason")


def extract_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    return _extracted(spark, d).hierarchy.select("doc", "kind", "label", F.col("doc_order").cast("long").alias("doc_order"))


def windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("ts", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    return ingest.event_counts(events).withColumn("total", F.col("total").cast("double"))


_KIND = "CASE event_type WHEN 'signup' THEN 'emitted-article' WHEN 'click' THEN 'emitted-transitory' WHEN 'view' THEN 'known-gap' WHEN 'purchase' THEN 'reviewed-exclusion' ELSE 'other' END"
QUERIES = {
    "ledger_faults": (
        ledger_faults,
        f"SELECT event_id AS \"domOrder\", CASE WHEN k = 'other' THEN 'kind' WHEN event_id % 6 = 0 THEN 'sourceUnitId' WHEN k = 'reviewed-exclusion' AND event_id % 4 = 0 THEN 'reason' "
        f"WHEN k <> 'emitted-transitory' AND event_id % 10 = 3 THEN 'ending' WHEN k = 'emitted-article' AND event_id % 7 = 0 THEN 'unitLabel' ELSE '' END AS fault FROM (SELECT event_id, {_KIND} AS k FROM events) x",
    ),
    "timestamps": (
        timestamps,
        "SELECT event_id, m BETWEEN 1 AND 12 AND dd >= 1 AND h <= 23 AND mi <= 59 AND s <= 59 AND dd <= CASE WHEN m = 2 THEN CASE WHEN y = 2000 THEN 29 ELSE 28 END WHEN m IN (4, 6, 9, 11) THEN 30 ELSE 31 END AS valid "
        "FROM (SELECT event_id, event_id % 3 + 1999 AS y, event_id % 14 AS m, event_id % 33 AS dd, event_id % 26 AS h, event_id % 61 AS mi, event_id % 62 AS s FROM events) x",
    ),
    "safe_integers": (
        safe_integers,
        "SELECT event_id, CASE WHEN event_id % 3 = 0 AND event_id > 0 THEN event_id WHEN event_id % 3 = 1 AND event_id % 1000 <= 991 THEN 9007199254740000 + event_id % 1000 END AS value FROM events",
    ),
    "key_order": (key_order, "SELECT event_id, event_id % 2 = 0 AS exact FROM events"),
    "slugs": (slugs, "SELECT c_custkey, regexp_full_match(replace(lower(c_mktsegment) || '-' || substr(c_name, 10, 9), '#', ''), '[a-z0-9]+(-[a-z0-9]+)*') AS ok, false AS raw_ok FROM customer"),
    "event_context": (
        event_context,
        "SELECT event_id, CASE WHEN event_id % 5 <> 1 THEN 'version' WHEN user_id % 3 = 0 AND event_id % 2 <> 0 THEN 'zero-ficha' WHEN user_id % 3 = 1 THEN 'ficha' ELSE '' END AS fault FROM events",
    ),
    "file_inventory": (
        file_inventory,
        "SELECT 'c/v1/' || lower(n_name) || '.capture.json' AS path, CASE WHEN n_regionkey = 3 THEN 'deny' ELSE 'public' END AS verdict, CASE WHEN n_regionkey = 3 THEN 'unmatched-rule' ELSE 'reviewed-capture' END AS reason FROM nation "
        "UNION ALL SELECT 'c/v1/' || lower(n_name) || '.raw.json.gz', 'quarantined', 'raw-capture-quarantine' FROM nation UNION ALL SELECT 'c/v1/Dictamen-' || n_nationkey, 'deny', 'deny-private-ruling-basename' FROM nation "
        "UNION ALL SELECT 'c/v1/x' || n_nationkey, 'deny', 'unmatched-rule' FROM nation UNION ALL SELECT 'c/v1/catalog.json', 'public', 'reviewed-catalog'",
    ),
    "import_edges": (
        import_edges,
        "SELECT n_name AS src, './m' || n_regionkey || '.js' AS specifier, 'relative' AS kind FROM nation UNION ALL SELECT n_name, 'node:fs', 'builtin' FROM nation UNION ALL SELECT n_name, '@scope/p' || n_nationkey, 'package' FROM nation",
    ),
    "extract_articles": (
        extract_articles,
        "SELECT conv_id AS doc, CAST(turn + 1 AS VARCHAR) AS number, conv_id * 1000 + turn + 1 AS source_unit_id, turn AS doc_order, CAST(length(regexp_replace(regexp_replace(text, '[<>&\\n]', ' ', 'g'), '\\s+', '', 'g')) AS BIGINT) AS body_chars FROM conversations",
    ),
    "extract_ledger": (
        extract_ledger,
        "SELECT conv_id AS doc, turn AS \"order\", conv_id * 1000 + turn + 1 AS source_unit_id, 'emitted-article' AS kind, CAST(turn + 1 AS VARCHAR) AS unit_label, CAST(NULL AS VARCHAR) AS reason FROM conversations",
    ),
    "extract_hierarchy": (extract_hierarchy, "SELECT conv_id AS doc, 'capitulo' AS kind, 'CAPÍTULO ' || (turn // 4 + 1) AS label, turn // 4 AS doc_order FROM conversations WHERE turn % 4 = 0"),
    "windowed_counts": (
        windowed_counts,
        "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2",
    ),
}
