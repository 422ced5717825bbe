"""Queries of captures as files, markup, scalars, schemas and measures, over values made of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import loading, manifest, markup, validators
from corpusloom.plans.release import _HARD, hard_captures
from corpusloom.session import ship, table
from corpusloom.sinks import files
from corpusloom.sources import captures


def capture_payloads(spark: SparkSession, d: str) -> DataFrame:
    """A file for each supplier, of every kind of payload, as the reader of captures takes it."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    name = F.col("s_name")
    quoted = lambda v: F.to_json(F.struct(v.alias("v")))
    inner = lambda v: F.substring(quoted(v), 6, 100000)
    kind = F.col("s_suppkey") % 7
    text = (
        F.when(kind == 0, F.concat(F.lit('{"html":'), inner(F.concat(F.lit("<p>"), name, F.lit("</p>\n"))))).when(kind == 1, F.concat(F.lit('{"TextoNorma":'), inner(name))).when(kind == 2, F.concat(F.lit('{"html":"","TextoNorma":'), inner(name)))
        .when(kind == 3, F.lit('{"html":null,"TextoNorma":"x"}')).when(kind == 4, F.lit('{"TextoNorma":""}')).when(kind == 5, F.lit('{"other":1}')).otherwise(F.lit('{"html":'))
    )
    folder = captures.shared_folder(spark, "captures")
    ship(spark)
    files.write_files(s.select(F.format_string("%09d.json", "s_suppkey").alias("name"), F.encode(text, "UTF-8").alias("data")), folder).count()
    rows = captures.captures(spark, folder)
    return rows.select(F.regexp_extract("path", r"([0-9]+)\.json$", 1).cast("long").alias("s_suppkey"), "html", "problem", "bytes")


def listed_files(spark: SparkSession, d: str) -> DataFrame:
    """Files that are listed and those that are there, against each other; the folder's own outputs aside."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.format_string("f%d.bin", "s_suppkey").alias("name"))
    folder = captures.shared_folder(spark, "listed")
    ship(spark)
    files.write_files(s.filter("k % 5 <> 1").select("name", F.encode("name", "UTF-8").alias("data")).unionByName(spark.createDataFrame([("own.json", b"x")], "name string, data binary")), folder).count()
    listed = s.filter("k % 7 <> 2").select("name").unionByName(s.filter("k % 11 = 3").select("name"))
    return captures.listing_faults(listed, "name", captures.files(spark, folder, without=("own.json",)))


def markup_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of fragments with every kind of element, and of the text between them."""
    c = table(spark, d, "conversations").select("conv_id", "turn")
    whole = F.format_string(
        "<html><head><title>no</title></head><body><style>p{}</style><p>a%d  <b>b</b>\t<i>c%d</i><br>d&nbsp;</p><!-- no --><div>e&amp;f<span> g</span></div><script>no()</script><ul><li>h</li><li></li></ul><o:p>no</o:p></body></html> tail %d\n<HTML x='1'><h2>é &#233;</h2></HTML>",
        "conv_id", "turn", "turn",
    )
    return markup.line_stream(c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc"), whole.alias("html")), "doc", "html").select("doc", "line", "text")


def caption_keys(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id")
    raw = F.concat(F.lit(" FICHA\xa0 Arti\u0301culo\t"), F.col("event_id").cast("string"), F.when(F.col("user_id") % 2 == 0, " BIS ").otherwise(""))
    return e.select("event_id", X.caption(raw).alias("caption"), X.caption_key(raw).alias("caption_key"))


def scalar_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Digests, sums, human texts, days and kinds, right and wrong ones."""
    n = F.col("event_id")
    sha = F.sha2(n.cast("string"), 256)
    pick = lambda *values: F.element_at(F.array(*values), (n % len(values) + 1).cast("int"))
    human = pick(F.col("event_type"), F.concat(F.lit(" "), "event_type"), F.lit(""), F.lit("é"), F.repeat(F.lit("x"), 513), F.lit("a​b"), F.repeat(F.lit("é"), 512))
    big = F.lit(validators.MAX_SAFE) - n % 3
    return table(spark, d, "events").select(
        "event_id", validators.shaped(pick(sha, F.upper(sha), F.substring(sha, 1, 63)), validators.SHA256).alias("sha"), validators.shaped(pick(F.concat(F.lit("sha256:"), sha), sha), validators.FINGERPRINT).alias("fingerprint"),
        validators.shaped(pick(F.substring(sha, 1, 16), sha), validators.FNV).alias("fnv"), validators.shaped(pick(F.upper(sha), sha, F.lit("g")), validators.SEED).alias("seed"), validators.human(human).alias("human"),
        validators.sum_within(big, F.lit(1), F.lit(1)).alias("total"), validators.one_of(F.col("event_type"), ("click", "view")).alias("kind"),
        validators.day(F.format_string("%02d/%02d/%04d", n % 32, n % 14, n % 5 + 1999)).cast("string").alias("day"), validators.constant(F.col("event_type"), "error").alias("constant"),
    )


#: What the table of customers is audited for: column, type, may be null.
SPEC = (("c_custkey", "bigint", False), ("c_name", "string", False), ("c_nationkey", "bigint", False), ("c_acctbal", "double", True), ("C_MKTSEGMENT", "string", True), ("c_phone", "string", True))


def schema_audit(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 10 != 0, F.col("c_name"))).withColumn("more", F.lit(1))
    return loading.audited(rows, "customer", SPEC, ("c_mktsegment", "c_nationkey"))


def release_measures(spark: SparkSession, d: str) -> DataFrame:
    """What a release says of each of its authorities."""
    from corpusloom.operators import extraction

    captures.ensure_checkpoints(spark)
    found = extraction.extract(hard_captures(spark, d))
    registry = table(spark, d, "conversations").select(F.col("conv_id").alias("id")).distinct().select("id", (F.col("id") + 1).alias("version_id"), F.lit("1").alias("number"), F.lit("n").alias("name"), F.lit(1).cast("long").alias("tipo"), F.lit("d").alias("date"), F.lit("u").alias("source_url"), F.lit("i").alias("imported_at"))
    return manifest.measure(manifest.relations(found, registry)).select("norma_id", "version_id", "name", "n_articles", "n_transitories", "n_gaps", "front_matter", "n_coordinates")


_N = "SELECT event_id AS n, event_type AS t, sha256(CAST(event_id AS VARCHAR)) AS s FROM events"
_DAY = "day BETWEEN 1 AND CASE WHEN m = 2 THEN CASE WHEN y = 2000 THEN 29 ELSE 28 END WHEN m IN (4, 6, 9, 11) THEN 30 ELSE 31 END AND m BETWEEN 1 AND 12"
QUERIES = {
    "capture_payloads": (
        capture_payloads,
        "SELECT s_suppkey, CASE k WHEN 0 THEN '<p>' || s_name || '</p>' || chr(10) WHEN 1 THEN s_name WHEN 2 THEN '' WHEN 3 THEN 'null' END AS html, CASE WHEN k IN (4, 5) THEN 'payload' WHEN k = 6 THEN 'json' END AS problem, "
        "CAST(CASE k WHEN 0 THEN length(s_name) + 20 WHEN 1 THEN length(s_name) + 17 WHEN 2 THEN length(s_name) + 27 WHEN 3 THEN 30 WHEN 4 THEN 17 WHEN 5 THEN 11 ELSE 8 END AS BIGINT) AS bytes FROM (SELECT *, s_suppkey % 7 AS k FROM supplier) x",
    ),
    "listed_files": (
        listed_files,
        "SELECT 'f' || s_suppkey || '.bin' AS name, CASE WHEN s_suppkey % 5 = 1 THEN 'lost' WHEN s_suppkey % 7 = 2 AND s_suppkey % 11 <> 3 THEN 'unknown' ELSE 'repeated_event' END AS violation FROM supplier "
        "WHERE (s_suppkey % 5 = 1 AND (s_suppkey % 7 <> 2 OR s_suppkey % 11 = 3)) OR (s_suppkey % 5 <> 1 AND ((s_suppkey % 7 = 2 AND s_suppkey % 11 <> 3) OR (s_suppkey % 7 <> 2 AND s_suppkey % 11 = 3)))",
    ),
    "markup_lines": (
        markup_lines,
        "SELECT conv_id * 1000 + turn AS doc, CAST(line AS BIGINT) AS line, CASE line WHEN 0 THEN 'a' || conv_id || ' b c' || turn WHEN 1 THEN 'd' WHEN 2 THEN 'e&f g' WHEN 3 THEN 'h' WHEN 4 THEN 'tail ' || turn ELSE 'é é' END AS text FROM conversations, range(6) r(line)",
    ),
    "caption_keys": (
        caption_keys,
        "SELECT event_id, 'FICHA Artículo ' || event_id || CASE WHEN user_id % 2 = 0 THEN ' BIS' ELSE '' END AS caption, 'fichaartículo' || event_id || CASE WHEN user_id % 2 = 0 THEN 'bis' ELSE '' END AS caption_key FROM events",
    ),
    "scalar_shapes": (
        scalar_shapes,
        f"SELECT n AS event_id, n % 3 = 0 AS sha, n % 2 = 0 AS fingerprint, n % 2 = 0 AS fnv, n % 3 < 2 AS seed, n % 7 IN (0, 6) AS human, CASE WHEN n % 3 = 2 THEN CAST(9007199254740991 AS BIGINT) END AS total, t IN ('click', 'view') AS kind, "
        f"CASE WHEN {_DAY} THEN CAST(make_date(y, CASE WHEN {_DAY} THEN m ELSE 1 END, CASE WHEN {_DAY} THEN day ELSE 1 END) AS VARCHAR) END AS day, t = 'error' AS constant FROM (SELECT *, n % 32 AS day, n % 14 AS m, n % 5 + 1999 AS y FROM ({_N}) x) y",
    ),
    "schema_audit": (
        schema_audit,
        "SELECT 'customer' AS relation, 'c_name' AS \"column\", 'null' AS problem, count(*) AS n FROM customer WHERE c_custkey % 10 = 0 HAVING count(*) > 0 UNION ALL SELECT 'customer', 'c_nationkey', 'type', 0 UNION ALL SELECT 'customer', 'C_MKTSEGMENT', 'case', 0 UNION ALL SELECT 'customer', 'c_phone', 'missing', 0 "
        "UNION ALL SELECT 'customer', 'more', 'unknown', 0 UNION ALL SELECT 'customer', 'c_mktsegment,c_nationkey', 'key', count(*) FROM (SELECT 1 FROM customer GROUP BY c_mktsegment, c_nationkey HAVING count(*) > 1) x HAVING count(*) > 0",
    ),
    "release_measures": (
        release_measures,
        f"{_HARD} SELECT doc AS norma_id, doc + 1 AS version_id, 'n' AS name, count(CASE WHEN kind < 3 THEN 1 END) + 1 AS n_articles, count(CASE WHEN kind = 4 THEN 1 END) AS n_transitories, count(CASE WHEN kind IN (3, 5) THEN 1 END) AS n_gaps, 'present' AS front_matter, count(*) + 1 AS n_coordinates FROM t GROUP BY doc",
    ),
}
