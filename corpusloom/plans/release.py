"""Queries of deletes over links, rules in contexts, structural differences, clustered scans, and of all that an extraction can find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import hashing
from corpusloom.operators import differences, extraction, gates, identity, links, manifest, rules
from corpusloom.plans.texts import FNV_SQL
from corpusloom.session import ship, table
from corpusloom.sinks import clustered
from corpusloom.sources import captures

#: The links of the given relations, and what each does when its parent goes.
LINKS = (
    links.Link("nation_region", "nation", ("n_regionkey",), "region", ("r_regionkey",)), links.Link("customer_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    links.Link("supplier_nation", "supplier", ("s_nationkey",), "nation", ("n_nationkey",), links.SET_NULL), links.Link("orders_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)),
    links.Link("lineitem_orders", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)), links.Link("lineitem_supplier", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",), links.RESTRICT),
)


def _deleted(spark: SparkSession, d: str) -> links.Deleted:
    captures.ensure_checkpoints(spark)
    tables = {n: table(spark, d, n) for n in ("region", "nation", "customer", "supplier", "orders", "lineitem")}
    return links.delete(tables, LINKS, "region", F.col("r_regionkey") == 2)


def cascade_levels(spark: SparkSession, d: str) -> DataFrame:
    return _deleted(spark, d).tables["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")


def cascade_report(spark: SparkSession, d: str) -> DataFrame:
    return _deleted(spark, d).report


def restricted_delete(spark: SparkSession, d: str) -> DataFrame:
    """The links that forbid to delete suppliers, and how many rows of each do."""
    captures.ensure_checkpoints(spark)
    tables = {n: table(spark, d, n) for n in ("supplier", "lineitem", "orders")}
    some = [k for k in LINKS if {k.child, k.parent} <= tables.keys()]
    return links.delete(tables, some, "supplier", F.col("s_acctbal") < 0).refused


#: Lines, and the kind that they are of under the word grammar, with the fifth suffix admitted, with looser shapes, and as a treaty.
LINES = (
    ("ARTÍCULO 1.- x", "A", "A", "A", None), ("Artículo 2", None, None, None, "A"), ("ARTÍCULO 3 quinquies.- x", None, "A", "C", "A"), ("CAPÍTULO IV", "H", "H", "H", "H"), ("PARTE II", None, None, None, "H"), ("Ficha Artículo 4", "F", "F", "F", "F"),
    ("Ficha Artículo 5 Transitorio", "P", "P", "P", "P"), ("TRANSITORIO I.- x", "T", "T", "T", "T"), ("Artículo 175 septies.- y", None, None, "C", "A"), ("Artículo 339 Se impondrá", None, None, "C", "A"), ("Artículo 175 quinquies º texto", None, None, None, "A"),
    ("texto", None, None, None, None), ("ARTÍCULO 6 TER.- x", "A", "A", "A", "A"),
)
CONTEXTS = ((rules.WORD, 1, 10), (rules.WORD, 2, 20), (rules.WORD, 3, 30), (rules.TREATY, 2, 20))


def rules_in_context(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("line"))
    texts = F.broadcast(spark.createDataFrame([(i, t[0]) for i, t in enumerate(LINES)], "_i long, text string"))
    lines = e.join(texts, F.col("line") % len(LINES) == F.col("_i")).drop("_i")
    which = F.broadcast(spark.createDataFrame([(i, *c) for i, c in enumerate(CONTEXTS)], "_c long, template string, authority long, version long"))
    contexts = e.select("doc").distinct().join(which, F.col("doc") % len(CONTEXTS) == F.col("_c")).drop("_c")
    return rules.classified(lines, contexts, rules.standard(spark, [(2, 20)], [(3, 30)])).select("doc", "line", "kind")


def json_differences(spark: SparkSession, d: str) -> DataFrame:
    """Documents made of events against changed ones: every change by its path."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    whole = F.to_json(F.struct(F.col("user_id").alias("user"), F.struct(F.col("event_type").alias("type"), F.array("event_id", F.lit(7)).alias("list")).alias("in")))
    other = F.to_json(F.struct(
        F.when(F.col("event_id") % 5 == 1, F.col("user_id") + 1).otherwise(F.col("user_id")).alias("user"),
        F.struct(F.when(F.col("event_id") % 5 != 2, F.col("event_type")).alias("type"), F.when(F.col("event_id") % 5 == 3, F.array("event_id")).when(F.col("event_id") % 5 != 4, F.array("event_id", F.lit(7))).alias("list"), F.when(F.col("event_id") % 10 == 4, "new").alias("a b")).alias("in"),
    ))
    return differences.differences(e.select("event_id", whole.alias("t")), e.select("event_id", other.alias("t")), ["event_id"], "t", ordered=True)


def pruned_scan(spark: SparkSession, d: str) -> DataFrame:
    """A range of keys from a relation that was laid out by key."""
    folder = captures.shared_folder(spark, "clustered")
    clustered.write(table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"), folder, "l_suppkey", ["l_orderkey", "l_linenumber"], 16)
    return clustered.scan(spark, folder, "l_suppkey", 4, 6)


def hard_captures(spark: SparkSession, d: str) -> DataFrame:
    """(doc, html): conversations as captures with every kind of unit, by the number of document and turn."""
    c = table(spark, d, "conversations").select("conv_id", "turn")
    n, unit = F.col("turn") + 1, F.col("conv_id") * 1000 + F.col("turn") + 1
    kind = (F.col("conv_id") + F.col("turn")) % 6
    body = F.format_string("cuerpo %d de %d", n, "conv_id")
    head = lambda number, more: F.concat(F.lit("<p>ARTÍCULO "), number.cast("string"), F.lit(more), F.lit(".- "))
    text = (
        F.when(kind == 0, F.concat(head(n, " º"), body, F.lit("</p>"))).when(kind == 1, F.concat(head(n + 500, ""), F.lit("perdido</p>"), head(n, ""), body, F.lit("</p>"))).when(kind == 2, F.concat(head(n, ""), body, F.lit("<br>sigue</p>")))
        .when(kind == 3, F.lit("<p>Texto no disponible</p>")).when(kind == 4, F.concat(F.lit("<p>TRANSITORIO II.- "), body, F.lit("</p>"))).otherwise(F.lit("<p>nada</p>"))
    )
    ending = F.when(kind == 2, " BIS").when(kind == 4, " Transitorio").otherwise("")
    page = lambda text, number, unit, ending: F.concat(F.lit("<html><body>"), text, F.format_string("</body></html><div><a onclick='handleArticuloClick(%d, 0, %d, %d)'>Ficha Artículo %d%s</a></div>", number, F.col("conv_id") + 1, unit, number, ending))
    parts = c.groupBy("conv_id").agg(hashing.joined(page(text, n, unit, ending), F.col("turn")).alias("rest"))
    first = page(F.concat(F.lit("<p>Preámbulo "), F.col("conv_id").cast("string"), F.lit("</p><p>ARTÍCULO 900.- inicio</p>")), F.lit(900), F.col("conv_id") * 1000 + 900, F.lit(""))
    return parts.select(F.col("conv_id").alias("doc"), F.concat(first, "rest").alias("html"))


def _hard(spark: SparkSession, d: str) -> extraction.Extracted:
    captures.ensure_checkpoints(spark)
    return extraction.extract(hard_captures(spark, d))


def hard_articles(spark: SparkSession, d: str) -> DataFrame:
    return _hard(spark, d).articles.select("doc", "number", "ordinal_raw", "body", "source_unit_id")


def extract_provisions(spark: SparkSession, d: str) -> DataFrame:
    return _hard(spark, d).provisions.select("doc", "number", "attaches_to", "body", "label", "source_unit_id", F.col("doc_order").cast("long").alias("doc_order"))


def extract_gaps(spark: SparkSession, d: str) -> DataFrame:
    return _hard(spark, d).gaps.select("doc", "source_unit_id", "reason", "caption", F.col("doc_order").cast("long").alias("doc_order"))


def extract_dropped(spark: SparkSession, d: str) -> DataFrame:
    return _hard(spark, d).dropped.select("doc", "number")


def extract_warnings(spark: SparkSession, d: str) -> DataFrame:
    return _hard(spark, d).warnings


def hard_ledger(spark: SparkSession, d: str) -> DataFrame:
    return _hard(spark, d).ledger.select("doc", "order", "source_unit_id", "kind", "unit_label", "reason")


def extract_front_matter(spark: SparkSession, d: str) -> DataFrame:
    return _hard(spark, d).front_matter.select("doc", "body", "n_lines")


def gate_violations(spark: SparkSession, d: str) -> DataFrame:
    """What the gates say of a release with a fault of its own for each of several groups of documents."""
    found = _hard(spark, d)
    lit = lambda v: F.lit(v)
    registry = table(spark, d, "conversations").select(F.col("conv_id").alias("id")).distinct().select("id", (F.col("id") + 1).alias("version_id"), lit("1").alias("number"), lit("n").alias("name"), lit(1).cast("long").alias("tipo"), lit("01/01/2000").alias("date"), lit("u").alias("source_url"), lit(manifest.EPOCH).alias("imported_at"))
    t = manifest.relations(found, registry)
    group = F.col("norma_id") % 7
    first = F.col("number") == "900"
    art = t["article"].withColumn("body", F.when((group == 1) & first, "  ").otherwise(F.col("body"))).withColumn("source_unit_id", F.when((group == 3) & first, None).otherwise(F.col("source_unit_id"))).withColumn("number", F.when((group == 5) & first, "900 x").otherwise(F.col("number")))
    prov = t["transitory_provision"].withColumn("body", F.when(group == 4, "​").otherwise(F.col("body")))
    front = t["norma_front_matter"].withColumn("present", F.when(group == 2, 0).otherwise(F.col("present")))
    return gates.release(t | {"article": art, "transitory_provision": prov, "norma_front_matter": front}).select("code", "norma_id", "ordinal", "detail")


def authority_identities(spark: SparkSession, d: str) -> DataFrame:
    """Both identities of authorities made of nations: headings of suppliers, articles of customers, provisions, gaps and front matter."""
    ship(spark)
    text = lambda v: F.lit(v)
    no = F.lit(None).cast("long")
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_regionkey").cast("long").alias("version_id"), text("7").alias("number"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, 3).cast("long").alias("tipo"), text("d").alias("date"), text("ü").alias("source_url"), text("h").alias("content_hash"), text("t").alias("imported_at"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("long").alias("norma_id"), text("libro").alias("kind"), F.col("s_name").alias("label"), F.when(F.col("s_suppkey") % 3 == 0, "más").alias("display_label"), F.col("s_suppkey").alias("doc_order"), (F.col("s_suppkey") * 2).alias("extract_order"), no.alias("parent_id"))
    c = table(spark, d, "customer").filter("c_custkey % 5 = 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("norma_id"), F.col("c_mktsegment").alias("body"))
    article = c.select("norma_id", F.col("k").cast("string").alias("number"), text("").alias("ordinal_raw"), "body", F.concat(text("Ficha "), F.col("k").cast("string")).alias("ficha_ref"), no.alias("hierarchy_node_id"), F.col("k").alias("doc_order"), (F.col("k") + 1).alias("extract_order"), (F.col("k") * 9).alias("source_unit_id"))
    prov = c.filter("k % 10 = 0").select("norma_id", F.col("k").cast("string").alias("number"), text("º").alias("ordinal_raw"), F.lit(None).cast("string").alias("attaches_to"), "body", text("l").alias("label"), no.alias("hierarchy_node_id"), F.col("k").alias("doc_order"), F.col("k").alias("extract_order"), no.alias("source_unit_id"))
    gap = c.filter("k % 15 = 0").select("norma_id", F.col("k").alias("source_unit_id"), text("r").alias("reason"), F.when(F.col("k") % 2 == 0, "c").alias("caption"), F.col("k").alias("doc_order"))
    front = n.filter("id % 3 <> 0").select(F.col("id").alias("norma_id"), F.when(F.col("id") % 3 == 1, 1).otherwise(0).alias("present"), F.when(F.col("id") % 3 == 1, "é").otherwise("").alias("body"))
    v1 = identity.identities(identity.stream_v1(n, s, article, prov), hashing.AUTHORITY_V1, "v1")
    v2 = identity.identities(identity.stream_v2(n, s, article, prov, front, gap), hashing.AUTHORITY_V2, "v2")
    return v1.join(v2, "norma_id")


_GONE = "(SELECT n_nationkey FROM nation WHERE n_regionkey = 2)"
_C = f"c_nationkey IN {_GONE}"
_O = f"o_custkey IN (SELECT c_custkey FROM customer WHERE {_C})"
_L = f"l_orderkey IN (SELECT o_orderkey FROM orders WHERE {_O})"


def _row(name: str, level: int, gone: str, changed: str = "false") -> str:
    return f"SELECT '{name}' AS relation, {level} AS level, count(CASE WHEN {gone} THEN 1 END) AS gone, count(CASE WHEN {changed} THEN 1 END) AS changed, count(CASE WHEN {gone} THEN NULL ELSE 1 END) AS \"left\" FROM {name}"


_KINDS = ", ".join(f"({i}, {c}, {'NULL' if t[c + 1] is None else repr(t[c + 1])})" for i, t in enumerate(LINES) for c in range(4))
_HARD = (
    "WITH t AS (SELECT conv_id AS doc, turn, turn + 1 AS n, (conv_id + turn) % 6 AS kind, conv_id * 1000 + turn + 1 AS unit, 'cuerpo ' || (turn + 1) || ' de ' || conv_id AS body FROM conversations), d AS (SELECT DISTINCT doc FROM t), "
    "made AS (SELECT doc, count(CASE WHEN kind < 3 THEN 1 END) + 1 AS made, count(*) + 2 + count(CASE WHEN kind < 3 THEN 1 END) + count(CASE WHEN kind = 1 THEN 1 END) AS seen, count(CASE WHEN kind = 1 THEN 1 END) AS lost FROM t GROUP BY doc)"
)
_REASON = "CASE kind WHEN 3 THEN 'source-text-unavailable' WHEN 5 THEN 'unconsumed-article-terminator' END"
_F = lambda c: f"CASE WHEN {c} IS NULL THEN 'n;' ELSE 's' || length({c}) || ':' || {c} || ';' END"
_I = lambda c: f"CASE WHEN {c} IS NULL THEN 'n;' ELSE 'i' || ({c}) || ';' END"
_W = lambda w: f"'s{len(w)}:{w};'"


def _section(name: str, source: str, order: str, row: list[str]) -> str:
    """SQL of a section of the stream of an authority n."""
    frames = " || ".join(row)
    return f"{_W(name)} || 'i' || (SELECT count(*) FROM {source}) || ';' || coalesce((SELECT string_agg({frames}, '' ORDER BY {order}) FROM {source}), '')"


_CUST = "customer WHERE c_custkey % 5 = 0 AND c_nationkey = n_nationkey"
_K = "CAST(c_custkey AS VARCHAR)"
_V1 = " || ".join([
    _W("norma"), _I("n_nationkey"), _I("n_regionkey"), "'s1:7;'", _F("n_name"), "CASE WHEN n_nationkey % 2 = 0 THEN 'i3;' ELSE 'n;' END", "'s1:d;s1:ü;s1:h;s1:t;'",
    _section("hierarchy-count", "supplier WHERE s_nationkey = n_nationkey", "s_suppkey", [_W("hierarchy"), "'s5:libro;'", _F("s_name"), "CASE WHEN s_suppkey % 3 = 0 THEN 's3:más;' ELSE 'n;' END", _I("s_suppkey"), _I("s_suppkey * 2"), "'n;'"]),
    _section("article-count", _CUST, "c_custkey", [_W("article"), _F(_K), "'s0:;'", _F("c_mktsegment"), _F(f"('Ficha ' || {_K})"), "'n;'", _I("c_custkey"), _I("c_custkey + 1")]),
    _section("transitory-count", _CUST + " AND c_custkey % 10 = 0", "c_custkey", [_W("transitory"), _F(_K), "'s1:º;'", "'n;'", _F("c_mktsegment"), "'s1:l;'", "'n;'", _I("c_custkey"), _I("c_custkey")]),
])
_V2 = " || ".join([
    _V1, "'s2:fm;' || CASE n_nationkey % 3 WHEN 0 THEN 's6:absent;' WHEN 1 THEN 's7:present;s1:é;' ELSE 's5:empty;s0:;' END",
    _section("acoords", _CUST, "c_custkey", [_W("ac"), _F(_K), _I("c_custkey * 9")]), _section("tcoords", _CUST + " AND c_custkey % 10 = 0", "c_custkey", [_W("tc"), _F(_K), "'n;n;'"]),
    _section("gaps", _CUST + " AND c_custkey % 15 = 0", "c_custkey", [_W("g"), _I("c_custkey"), "'s1:r;'", "CASE WHEN c_custkey % 2 = 0 THEN 's1:c;' ELSE 's0:;' END", _I("c_custkey")]),
])

QUERIES = {
    "cascade_levels": (cascade_levels, f"SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE NOT {_L}"),
    "cascade_report": (cascade_report, " UNION ALL ".join([_row("region", 0, "r_regionkey = 2"), _row("nation", 1, "n_regionkey = 2"), _row("customer", 2, _C), _row("supplier", 2, "false", f"s_nationkey IN {_GONE}"), _row("orders", 3, _O), _row("lineitem", 4, _L)])),
    "restricted_delete": (restricted_delete, "SELECT 'lineitem_supplier' AS name, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) HAVING count(*) > 0"),
    "rules_in_context": (rules_in_context, f"SELECT user_id AS doc, event_id AS line, kind FROM events JOIN (VALUES {_KINDS}) t(i, c, kind) ON event_id % {len(LINES)} = i AND user_id % {len(CONTEXTS)} = c WHERE kind IS NOT NULL"),
    "json_differences": (
        json_differences,
        "SELECT event_id, '$.user' AS path, 'value' AS problem, CAST(user_id AS VARCHAR) AS was, CAST(user_id + 1 AS VARCHAR) AS now FROM events WHERE event_id % 5 = 1 UNION ALL SELECT event_id, '$.in.type', 'missing', event_type, NULL FROM events WHERE event_id % 5 = 2 "
        "UNION ALL SELECT event_id, '$.in.list', 'place', NULL, NULL FROM events WHERE event_id % 5 = 2 UNION ALL SELECT event_id, '$.in.list[1]', 'missing', '7', NULL FROM events WHERE event_id % 5 = 3 UNION ALL SELECT event_id, '$.in.list', 'missing', NULL, NULL FROM events WHERE event_id % 5 = 4 "
        "UNION ALL SELECT event_id, '$.in[\"a b\"]', 'unknown', NULL, 'new' FROM events WHERE event_id % 10 = 4",
    ),
    "pruned_scan": (pruned_scan, "SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey BETWEEN 4 AND 6"),
    "hard_articles": (
        hard_articles,
        f"{_HARD} SELECT doc, CASE kind WHEN 2 THEN n || ' bis' ELSE CAST(n AS VARCHAR) END AS number, CASE kind WHEN 0 THEN n || ' º' ELSE '' END AS ordinal_raw, CASE kind WHEN 2 THEN body || ' sigue' ELSE body END AS body, unit AS source_unit_id FROM t WHERE kind < 3 "
        "UNION ALL SELECT doc, '900', '', 'inicio', doc * 1000 + 900 FROM d",
    ),
    "extract_provisions": (
        extract_provisions,
        f"{_HARD} SELECT doc, 'II' AS number, '' AS attaches_to, body, 'TRANSITORIO II.- ' || body AS label, unit AS source_unit_id, row_number() OVER (PARTITION BY doc ORDER BY turn) - 1 AS doc_order FROM t WHERE kind = 4",
    ),
    "extract_gaps": (extract_gaps, f"{_HARD} SELECT doc, unit AS source_unit_id, {_REASON} AS reason, 'Ficha Artículo ' || n AS caption, row_number() OVER (PARTITION BY doc ORDER BY turn) - 1 AS doc_order FROM t WHERE kind IN (3, 5)"),
    "extract_dropped": (extract_dropped, f"{_HARD} SELECT doc, CAST(n + 500 AS VARCHAR) AS number FROM t WHERE kind = 1"),
    "extract_warnings": (
        extract_warnings,
        f"{_HARD} SELECT doc, 'article ' || n || ': header dropped the \"bis\" suffix present in its Ficha (Ficha Artículo ' || n || ' BIS); adopted \"' || n || ' bis\"' AS warning FROM t WHERE kind = 2 "
        "UNION ALL SELECT doc, lost || ' article header(s) had no Ficha terminator and were moved to `dropped`' FROM made WHERE lost > 0 "
        "UNION ALL SELECT doc, 'extractor returned ' || made || ' articles but the source contains ' || seen || ' \"ARTICULO N\" occurrence(s) — possible off-template or many dropped' FROM made WHERE made < seen * 0.5",
    ),
    "hard_ledger": (
        hard_ledger,
        f"{_HARD} SELECT doc, turn + 1 AS \"order\", unit AS source_unit_id, CASE WHEN kind < 3 THEN 'emitted-article' WHEN kind = 4 THEN 'emitted-transitory' ELSE 'known-gap' END AS kind, "
        f"CASE WHEN kind = 2 THEN n || ' bis' WHEN kind < 2 THEN CAST(n AS VARCHAR) WHEN kind = 4 THEN 'II' END AS unit_label, {_REASON} AS reason FROM t UNION ALL SELECT doc, 0, doc * 1000 + 900, 'emitted-article', '900', NULL FROM d",
    ),
    "extract_front_matter": (extract_front_matter, f"{_HARD} SELECT doc, 'Preámbulo ' || doc AS body, CAST(1 AS BIGINT) AS n_lines FROM d"),
    "gate_violations": (
        gate_violations,
        f"{_HARD}, v AS (SELECT 'blank-article' AS code, doc AS norma_id, CAST(0 AS BIGINT) AS ordinal, '' AS detail FROM d WHERE doc % 7 = 1 UNION ALL SELECT 'content-hash', doc, NULL, '' FROM d WHERE doc % 7 IN (1, 5) "
        "UNION ALL SELECT 'front-matter-state', doc, NULL, '' FROM d WHERE doc % 7 = 2 UNION ALL SELECT 'coordinate-missing', doc, 0, '' FROM d WHERE doc % 7 = 3 UNION ALL SELECT 'number', doc, 0, '900 x' FROM d WHERE doc % 7 = 5 "
        "UNION ALL SELECT 'blank-transitory', doc, row_number() OVER (PARTITION BY doc ORDER BY turn) - 1, '' FROM t WHERE kind = 4 AND doc % 7 = 4 "
        "UNION ALL SELECT 'transitory-key', doc, NULL, 'II' FROM t WHERE kind = 4 GROUP BY doc HAVING count(*) > 1) SELECT * FROM v",
    ),
    "authority_identities": (
        authority_identities,
        f"SELECT norma_id, {FNV_SQL.format(t='a')} AS v1, {FNV_SQL.format(t='b')} AS v2 FROM (SELECT CAST(n_nationkey AS BIGINT) AS norma_id, 'corpus-authority-v1;' || {_V1} AS a, 'corpus-authority-v2;' || {_V2} AS b FROM nation) x",
    ),
}
