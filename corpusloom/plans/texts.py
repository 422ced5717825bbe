"""Queries over texts: lines, grammars, hashes, identities, numbers, indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import canonical, hashing, numbers
from corpusloom.functions import text as X
from corpusloom.operators import aggregates, full_text, grammar, loading, markup
from corpusloom.session import ship, table


def line_stream(spark: SparkSession, d: str) -> DataFrame:
    return markup.text_lines(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


def ordered_join(spark: SparkSession, d: str) -> DataFrame:
    lines = markup.clean_lines(F.col("text"))
    return table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.array_join(lines, " ").alias("text")).filter("text <> ''")


def html_tag_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.sha2(markup.strip_structure(F.col("html")), 256).alias("stripped_sha"))


def html_to_lines(spark: SparkSession, d: str) -> DataFrame:
    return markup.line_stream(table(spark, d, "pages").select("page_id", "html"), "page_id", "html").select("doc", "line", "text")


def html_anchors(spark: SparkSession, d: str) -> DataFrame:
    return synthetic_lines(spark, d).filter("event is not null").select("doc", "line", "event.*")


def synthetic_captures(spark: SparkSession, d: str) -> DataFrame:
    """(doc, html): conversations written as captures, each turn an article with its source anchor."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    n = F.col("turn") + 1
    caption = F.concat(F.lit("Ficha Artículo "), n.cast("string"))
    handler = F.format_string("handleArticuloClick(%d, 0, %d, %d)", n, F.col("conv_id") + 1, F.col("conv_id") * 1000 + n)
    body = F.regexp_replace("text", r"[<>&\n]", " ")
    head = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("<p>CAPÍTULO "), (F.floor(F.col("turn") / 4) + 1).cast("string"), F.lit("</p>"))).otherwise("")
    piece = F.concat(F.lit("<html><body>"), head, F.lit("<p>ARTÍCULO <span>"), n.cast("string"), F.lit("</span>.- "), body, F.lit("</p></body></html><div><a class='enlaceFicha' onclick='"), handler, F.lit("'>"), caption, F.lit("</a></div>"))
    return c.groupBy(F.col("conv_id").alias("doc")).agg(hashing.joined(piece, F.col("turn")).alias("html"))


def synthetic_lines(spark: SparkSession, d: str) -> DataFrame:
    return markup.line_stream(synthetic_captures(spark, d), "doc", "html")


def line_grammar(spark: SparkSession, d: str) -> DataFrame:
    return grammar.classified(synthetic_lines(spark, d).select("doc", "line", "text")).select("doc", "line", "kind", "heading", "level", "number", "base")


def text_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", hashing.text_hash(F.col("text")).alias("fnv"))


def text_hash_short(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select("item_id", hashing.text_hash(F.col("text")).alias("fnv"))


def ordered_identity(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").groupBy("conv_id").agg(hashing.joined(F.concat_ws(hashing.FIELD, "role", "text"), F.col("turn"), hashing.RECORD).alias("t"))
    return c.select("conv_id", hashing.text_hash(F.col("t")).alias("identity"))


def typed_frames(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    framed = F.concat(hashing.frame(F.col("turn"), "number"), hashing.frame(F.col("role"), "text"), hashing.frame(F.when(F.col("turn") % 2 == 0, F.col("text")), "text"))
    joined = c.groupBy("conv_id").agg(hashing.joined(framed, F.col("turn")).alias("t"))
    whole = F.concat(F.lit(f"{hashing.AUTHORITY_V2};"), "t")
    return joined.select("conv_id", whole.alias("frames"), hashing.text_hash(whole).alias("identity"))


def sha_manifest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"))


def catalog_digest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").select("n_regionkey", "n_nationkey", F.concat(F.concat_ws("\x00", F.col("n_name"), F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")), F.lit("\x01")).alias("t"))
    return rows.groupBy("n_regionkey").agg(F.sha2(hashing.joined(F.col("t"), F.col("n_nationkey")), 256).alias("digest"))


def substantive_filter(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.regexp_replace("text", "[A-Za-z]+", ""), "\n", -1)).alias("at", "t"))
    return lines.groupBy("doc_id").agg(F.count_if(X.substantive(F.col("t"))).alias("substantive"), F.count(F.lit(1)).alias("lines"))


def label_lines(spark: SparkSession, d: str) -> DataFrame:
    capitals = F.translate(F.regexp_replace("text", r"[.,!]", ""), SMALL, CAPITAL)
    return markup.text_lines(table(spark, d, "documents").select("doc_id", capitals.alias("text")), "doc_id", "text").filter(X.descriptive_label(F.col("text"))).select("doc", "line")


SMALL, CAPITAL = "abcdefghijklmnopqrstuvwxyzáéíóúüñ", "ABCDEFGHIJKLMNOPQRSTUVWXYZÁÉÍÓÚÜÑ"
#: Ways to write a number #, and what it is then: number, ordinal_raw, cited, canonical, in_catalog, base.
NUMBERS = (
    ("#", "#", "", "#", True, True, "#"), ("# bis", "# bis", "", "# bis", True, True, "#"), ("#BIS", "# bis", "", "#bis", False, False, "#BIS"), ("# º", "#", "# º", "#", True, True, "#"), (" # TER ", "# ter", "", "# ter", True, True, "#"),
    ("# quater", "# quáter", "", "# quáter", True, True, "#"), ("#  quáter", "# quáter", "", "# quáter", True, True, "#"), ("# qua\u0301ter", "# quáter", "", "# quáter", True, True, "#"), ("# QUÁTER", "# quáter", "", "# quáter", True, True, "#"),
    ("# QUA\u0301TER", "# quáter", "", "# quáter", True, True, "#"), ("#° bis", "#° bis", "", "# bis", True, True, "#°"), ("bis #", "bis #", "", "bis #", False, False, "bis"), ("# bisagra", "# bisagra", "", "# bisagra", False, False, "#"),
    ("00#", "00#", "", "00#", True, False, "00#"), ("# quinquies", "# quinquies", "", "# quinquies", True, True, "#"), ("# Septies", "# septies", "", "# septies", True, True, "#"), ("# octies", "# octies", "", "# octies", False, False, "#"),
)
#: What may follow a number, and whether it goes on with it.
TAILS = (
    ("", False), (" de la ley", False), ("bis", True), (" BISx", True), (".5", True), (", y", False), (". Otro", False), ("º", True), (" tercero", False), (" ter", False), (" terx", True), (" bisagras", False), ("．５", True), ("-A", True),
    (" Bis2", True), ("/b", True), (" terminación", False),
)


def _picked(spark: SparkSession, d: str, options: tuple, names: str) -> DataFrame:
    """The events with one of a few fixed values each, by their number."""
    some = F.broadcast(spark.createDataFrame([(i, *v) for i, v in enumerate(options)], f"_i long, {names}"))
    return table(spark, d, "events").select("event_id", "event_type").join(some, F.col("event_id") % len(options) == F.col("_i"))


def number_normalize(spark: SparkSession, d: str) -> DataFrame:
    raw = F.replace("written", F.lit("#"), (F.col("event_id") % 700 + 1).cast("string"))
    rows = _picked(spark, d, tuple((n[0],) for n in NUMBERS), "written string").select("event_id", raw.alias("raw"))
    h, c = numbers.header_number(F.col("raw")), numbers.cited_number(F.col("raw"))
    return rows.select("event_id", h["number"].alias("number"), h["ordinal_raw"].alias("ordinal_raw"), c.alias("cited"), numbers.is_canonical(c).alias("canonical"), numbers.is_catalog(c).alias("in_catalog"), numbers.base(F.col("raw")).alias("base"))


def glue_detect(spark: SparkSession, d: str) -> DataFrame:
    rows = _picked(spark, d, tuple((t[0],) for t in TAILS), "tail string")
    return rows.select("event_id", numbers.is_glued(F.concat_ws(" ", "tail", "event_type")).alias("glued"))


def article_numbers(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat_ws(" ", (F.col("event_id") % 300).cast("string"), F.when(F.col("event_type") == "click", "BIS").when(F.col("event_type") == "view", "QUÁTER").when(F.col("event_type") == "purchase", "QUA\u0301TER").when(F.col("event_type") == "error", "º"))
    h = numbers.header_number(raw)
    return table(spark, d, "events").select("event_id", h["number"].alias("number"), h["ordinal_raw"].alias("ordinal_raw"))


def classify_first_match(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages").select("page_id", "url")
    name = F.regexp_extract("url", r"([^/]*)$", 1)
    rules = [(name.rlike("(?i)utm_|ref="), "deny"), (name.rlike("#"), "quarantined"), (F.col("url").startswith("https://"), "public")]
    return loading.classify_first(rows, rules, "unknown").select("page_id", "verdict")


def closure(spark: SparkSession, d: str) -> DataFrame:
    from corpusloom.sources.captures import ensure_checkpoints

    ensure_checkpoints(spark)
    k = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    edges = k.select(F.col("s_suppkey").alias("src"), ((F.col("s_suppkey") * 3 + F.col("s_nationkey")) % 100).alias("dst"))
    return loading.closure(edges, spark.createDataFrame([(1,), (7,)], "node long")).select("node")


def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"), F.get_json_object("props", "$.k").cast("int").alias("k"))).alias("j"))
    return e.select("event_id", canonical.canonical_json(F.col("j")).alias("json"))


def strict_json(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"k":1,"k":'), (F.col("event_id") % 9).cast("string"), F.lit("}"))).when(F.col("event_id") % 7 == 0, F.concat(F.lit("[-"), (F.col("event_id") % 9).cast("string"), F.lit("]"))).otherwise(F.col("props")).alias("j"))
    return e.select("event_id", F.coalesce(canonical.refusal(F.encode("j", "UTF-8")), F.lit("")).alias("refusal"))


def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    return full_text.index(table(spark, d, "benchmark").select("item_id", "text"), "item_id", "text")


def search_all_tokens(spark: SparkSession, d: str) -> DataFrame:
    asked = ["the", "OF", "ing"]
    return full_text.containing_all(full_text.index(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", asked), "doc_id", asked)


def index_ghosts(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark").select("item_id", "text")
    return full_text.ghosts(full_text.index(items, "item_id", "text"), "item_id", items.filter("item_id % 3 <> 0"))


def common_tokens(spark: SparkSession, d: str) -> DataFrame:
    return full_text.vocabulary(table(spark, d, "documents").select("text"), "text", 25)


def occurrence_ratio(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "text", "n_chars")
    return aggregates.pattern_ratio(rows, "text", r"(?iu)\bthe\b", (F.col("n_chars") / 40).cast("long")).select("doc_id", "occurrences", "extracted")


def utf16_lengths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.utf16_length(F.col("text")).cast("long").alias("units"), F.sha2(X.ascii_fold(F.col("text")), 256).alias("folded"))


def derived_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", F.format_string("corpus-sources/v1/%s/%d-%d.raw.json.gz", F.lower("n_name"), "n_nationkey", "n_regionkey").alias("path"))


FNV_SQL = (
    "lpad(lower(to_hex(CAST(list_reduce(list_prepend(CAST(14695981039346656037 AS UHUGEINT), list_transform(string_split({t}, ''), lambda c: CAST(unicode(c) AS UHUGEINT))), "
    "lambda h, u: (xor(h, u) * 1099511628211) % 18446744073709551616) AS UBIGINT))), 16, '0')"
)
_LINES = (
    "l AS (SELECT doc_id AS doc, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS raw FROM documents), "
    "c AS (SELECT doc, pos, trim(regexp_replace(raw, '[ \\t\\f\\x0B]+', ' ', 'g')) AS text FROM l), "
    "n AS (SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY pos) - 1 AS BIGINT) AS line, text FROM c WHERE text <> '')"
)
_FRAMES = (
    "SELECT conv_id, 'corpus-authority-v2;' || string_agg('i' || turn || ';s' || length(role) || ':' || role || ';' || CASE WHEN turn % 2 = 0 THEN 's' || length(text) || ':' || text || ';' ELSE 'n;' END, '' ORDER BY turn) AS frames "
    "FROM conversations GROUP BY conv_id"
)
_FOLD = "translate(lower(text), 'áàâäãåéèêëíìîïóòôöõúùûüñçýÿ', 'aaaaaaeeeeiiiiooooouuuuncyy')"
_TOKENS = "SELECT {k}, unnest(regexp_extract_all({f}, '[\\p{{L}}\\p{{N}}]+')) AS token, unnest(range(len(regexp_extract_all({f}, '[\\p{{L}}\\p{{N}}]+')))) AS position FROM {t}"

_text = lambda v: str(v).lower() if isinstance(v, bool) else "'" + v + "'"
_NUMBER = lambda c: f"replace({c}, '#', CAST(event_id % 700 + 1 AS VARCHAR))"
_NUMBERS_SQL = (
    f"SELECT event_id, {', '.join(f'{_NUMBER(c)} AS {c}' for c in ('number', 'ordinal_raw', 'cited', 'base'))}, canonical, in_catalog FROM events JOIN (VALUES "
    + ", ".join(f"({i}, {', '.join(map(_text, n[1:]))})" for i, n in enumerate(NUMBERS)) + f") t(i, number, ordinal_raw, cited, canonical, in_catalog, base) ON event_id % {len(NUMBERS)} = i"
)
_TAILS_SQL = f"SELECT event_id, event_id % {len(TAILS)} IN ({', '.join(str(i) for i, t in enumerate(TAILS) if t[1])}) AS glued FROM events"

QUERIES = {
    "line_stream": (line_stream, f"WITH {_LINES} SELECT doc, line, text FROM n"),
    "ordered_join": (ordered_join, f"WITH {_LINES} SELECT doc, string_agg(text, ' ' ORDER BY line) AS text FROM n GROUP BY doc"),
    "html_tag_strip": (html_tag_strip, "SELECT page_id, sha256(regexp_replace(html, '(?i)</?(?:html|head|body)[^>]*>', '', 'g')) AS stripped_sha FROM pages"),
    "html_to_lines": (html_to_lines, None),
    "html_anchors": (
        html_anchors,
        "SELECT conv_id AS doc, CAST(turn * 2 + floor(turn / 4) + 2 AS BIGINT) AS line, turn AS \"order\", 'Ficha Artículo ' || (turn + 1) AS caption, turn + 1 AS base, CAST(0 AS BIGINT) AS ficha, conv_id + 1 AS version, conv_id * 1000 + turn + 1 AS unit, 'F' AS kind FROM conversations",
    ),
    "line_grammar": (
        line_grammar,
        "SELECT conv_id AS doc, CAST(turn * 2 + floor(turn / 4) + 2 AS BIGINT) AS line, 'F' AS kind, NULL AS heading, CAST(NULL AS INTEGER) AS level, NULL AS number, CAST(turn + 1 AS VARCHAR) AS base FROM conversations "
        "UNION ALL SELECT conv_id, CAST(turn * 2 + floor(turn / 4) + 1 AS BIGINT), 'A', NULL, NULL, CAST(turn + 1 AS VARCHAR), CAST(turn + 1 AS VARCHAR) FROM conversations "
        "UNION ALL SELECT conv_id, CAST(turn * 2 + floor(turn / 4) AS BIGINT), 'H', 'capitulo', 2, NULL, NULL FROM conversations WHERE turn % 4 = 0",
    ),
    "text_hash": (text_hash, f"SELECT doc_id, {FNV_SQL.format(t='text')} AS fnv FROM documents"),
    "text_hash_short": (text_hash_short, f"SELECT item_id, {FNV_SQL.format(t='text')} AS fnv FROM benchmark"),
    "ordered_identity": (ordered_identity, f"SELECT conv_id, {FNV_SQL.format(t='t')} AS identity FROM (SELECT conv_id, string_agg(role || chr(1) || text, chr(2) ORDER BY turn) AS t FROM conversations GROUP BY conv_id) x"),
    "typed_frames": (typed_frames, f"SELECT conv_id, frames, {FNV_SQL.format(t='frames')} AS identity FROM ({_FRAMES}) x"),
    "sha_manifest": (sha_manifest, "SELECT doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS bytes FROM documents"),
    "catalog_digest": (catalog_digest, "SELECT n_regionkey, sha256(string_agg(n_name || chr(0) || n_nationkey || chr(0) || n_regionkey || chr(1), '' ORDER BY n_nationkey)) AS digest FROM nation GROUP BY n_regionkey"),
    "substantive_filter": (
        substantive_filter,
        "SELECT doc_id, count(CASE WHEN regexp_matches(t, '[^\\t-\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\p{Cc}\\p{Cf}]') THEN 1 END) AS substantive, count(*) AS lines "
        "FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '[A-Za-z]+', '', 'g'), chr(10))) AS t FROM documents) x GROUP BY doc_id",
    ),
    "label_lines": (
        label_lines,
        "WITH " + _LINES.replace("FROM documents", f"FROM (SELECT doc_id, translate(regexp_replace(text, '[.,!]', '', 'g'), '{SMALL}', '{CAPITAL}') AS text FROM documents) d") + " SELECT doc, line FROM n WHERE regexp_matches(text, '^[A-ZÁÉÍÓÚÜÑ \\-]{4,}$') "
        "AND len(list_filter(regexp_split_to_array(text, '[ \\-]+'), lambda w: length(w) >= 3)) >= 2 AND NOT regexp_matches(text, '^(LIBRO|T[IÍ]TULO|CAP[IÍ]TULO|SECCI[OÓ]N|ART[IÍ]CULO|TRANSITORIO)( |-|$)')",
    ),
    "number_normalize": (number_normalize, _NUMBERS_SQL),
    "glue_detect": (glue_detect, _TAILS_SQL),
    "article_numbers": (
        article_numbers,
        "SELECT event_id, CASE event_type WHEN 'click' THEN (event_id % 300) || ' bis' WHEN 'view' THEN (event_id % 300) || ' quáter' WHEN 'purchase' THEN (event_id % 300) || ' quáter' ELSE CAST(event_id % 300 AS VARCHAR) END AS number, "
        "CASE WHEN event_type = 'error' THEN (event_id % 300) || ' º' ELSE '' END AS ordinal_raw FROM events",
    ),
    "classify_first_match": (
        classify_first_match,
        "SELECT page_id, CASE WHEN regexp_matches(regexp_extract(url, '([^/]*)$', 1), '(?i)utm_|ref=') THEN 'deny' WHEN regexp_matches(regexp_extract(url, '([^/]*)$', 1), '#') THEN 'quarantined' WHEN starts_with(url, 'https://') THEN 'public' ELSE 'unknown' END AS verdict FROM pages",
    ),
    "closure": (
        closure,
        "WITH RECURSIVE e AS (SELECT s_suppkey AS src, (s_suppkey * 3 + s_nationkey) % 100 AS dst FROM supplier), r AS (SELECT CAST(1 AS BIGINT) AS node UNION SELECT 7 UNION SELECT e.dst FROM r JOIN e ON e.src = r.node) SELECT DISTINCT node FROM r",
    ),
    "canonical_json": (canonical_json, "SELECT event_id, '{\"k\":' || json_extract_string(props, '$.k') || ',\"type\":\"' || event_type || '\",\"user\":' || user_id || '}' AS json FROM events"),
    "strict_json": (strict_json, "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'repeated-key' WHEN event_id % 7 = 0 THEN 'number' ELSE '' END AS refusal FROM events"),
    "inverted_index": (inverted_index, f"SELECT token, item_id, count(*) AS n, CAST(min(position) AS BIGINT) AS first FROM ({_TOKENS.format(k='item_id', f=_FOLD, t='benchmark')}) x GROUP BY token, item_id"),
    "search_all_tokens": (
        search_all_tokens,
        f"SELECT doc_id, count(*) AS hits FROM ({_TOKENS.format(k='doc_id', f=_FOLD, t='documents')}) x WHERE token IN ('the', 'of', 'ing') GROUP BY doc_id HAVING count(DISTINCT token) = 3",
    ),
    "index_ghosts": (index_ghosts, "SELECT item_id FROM benchmark WHERE item_id % 3 = 0 AND regexp_matches(text, '[\\p{L}\\p{N}]')"),
    "common_tokens": (
        common_tokens,
        f"SELECT token, texts, occurrences, CAST(row_number() OVER (ORDER BY texts DESC, token) AS BIGINT) AS place FROM (SELECT token, count(DISTINCT doc_id) AS texts, count(*) AS occurrences FROM ({_TOKENS.format(k='doc_id', f=_FOLD, t='documents')}) x GROUP BY token) y ORDER BY texts DESC, token LIMIT 25",
    ),
    "occurrence_ratio": (
        occurrence_ratio,
        "SELECT doc_id, occurrences, extracted FROM (SELECT doc_id, CAST(len(regexp_extract_all(text, '(?i)(?:^|[^\\p{L}\\p{N}_])the\\b')) AS BIGINT) AS occurrences, CAST(floor(n_chars / 40) AS BIGINT) AS extracted FROM documents) x WHERE occurrences > extracted",
    ),
    "utf16_lengths": (utf16_lengths, "SELECT doc_id, CAST(length(text) + len(regexp_extract_all(text, '[\\x{10000}-\\x{10FFFF}]')) AS BIGINT) AS units, sha256(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS folded FROM documents"),
    "derived_paths": (derived_paths, "SELECT n_nationkey, 'corpus-sources/v1/' || lower(n_name) || '/' || n_nationkey || '-' || n_regionkey || '.raw.json.gz' AS path FROM nation"),
}
