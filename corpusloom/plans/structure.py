"""Window queries over the event stream: each user is a document, events in time order are its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import segmentation as S
from corpusloom.session import table

KINDS = {"signup": "H", "click": "A", "purchase": "F", "view": "T", "error": "P"}


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, line, kind, level, base, label) from the events."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "props")
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[F.col("event_type")]
    k = F.get_json_object("props", "$.k").cast("int")
    line = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return e.select(F.col("user_id").alias("doc"), line.cast("long").alias("line"), kind.alias("kind"), (k % 4).alias("level"), (k % 3).alias("base"), F.concat(F.lit("k"), k.cast("string")).alias("label"))


STREAM_SQL = """WITH ev AS (
  SELECT user_id AS doc, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS line,
    CASE event_type WHEN 'signup' THEN 'H' WHEN 'click' THEN 'A' WHEN 'purchase' THEN 'F' WHEN 'view' THEN 'T' WHEN 'error' THEN 'P' END AS kind,
    CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS level, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS base,
    'k' || json_extract_string(props, '$.k') AS label
  FROM events)"""
BEFORE = "OVER (PARTITION BY doc ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
UPTO = "OVER (PARTITION BY doc ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def segment_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.units(stream(spark, sf_dir))


def heading_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.last_heading(stream(spark, sf_dir)).filter("kind in ('A', 'T')").select("doc", "line", "heading_line")


def tree_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tree_parent(stream(spark, sf_dir).filter("kind = 'H'")).select("doc", "line", "level", "parent_line")


def tree_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tree_path(stream(spark, sf_dir).filter("kind = 'H'"), "label").select("doc", "line", "path")


def next_terminator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.next_terminator(stream(spark, sf_dir)).select("doc", "line", "terminator_line", "body_end")


def span_since_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.span_since_terminator(stream(spark, sf_dir)).select("doc", "line", "from_line", "to_line")


def recovered_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.body_start(stream(spark, sf_dir)).select("doc", "line", "start_line")


def label_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = stream(spark, sf_dir)
    lines = every.select("doc", "line", F.col("label").alias("text"))
    return S.label_peek(every.filter("kind in ('H', 'A', 'F')"), lines, F.col("text").rlike("^k[0-9]$|^k[1-4][0-9]$")).select("doc", "line", "display_label")


def owned_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = stream(spark, sf_dir)
    return S.owned_candidates(every.filter("kind in ('A', 'F', 'H')"), every.filter("kind = 'T'")).select("doc", "line", "base")


def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = stream(spark, sf_dir)
    return S.front_matter(every.select("doc", "line", "label"), every).select("doc", "line", "label")


def contained_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.operators.integrity import contained_in

    every = stream(spark, sf_dir)
    spans = S.units(every).filter("head_line is not null")
    return contained_in(every.filter("kind = 'P'"), spans, "doc", "line", "head_line", "end_line")


UNITS_SQL = f"""{STREAM_SQL}, seg AS (SELECT *, coalesce(sum(CASE WHEN kind = 'F' THEN 1 ELSE 0 END) {BEFORE}, 0) AS seg FROM ev),
  ends AS (SELECT doc, seg, line AS end_line, base AS end_base FROM seg WHERE kind = 'F'),
  per AS (SELECT e.doc, e.seg, min(CASE WHEN a.base = e.end_base THEN a.line END) AS head_line FROM ends e LEFT JOIN seg a ON a.doc = e.doc AND a.seg = e.seg AND a.kind = 'A' GROUP BY e.doc, e.seg),
  units AS (SELECT e.doc, CAST(e.seg AS BIGINT) AS seg, p.head_line, e.end_line, e.end_base,
    CAST(count(CASE WHEN a.line IS NOT NULL AND (p.head_line IS NULL OR a.line < p.head_line) THEN 1 END) AS BIGINT) AS n_dropped,
    CAST(count(CASE WHEN a.line > p.head_line THEN 1 END) AS BIGINT) AS n_within
  FROM ends e JOIN per p ON p.doc = e.doc AND p.seg = e.seg LEFT JOIN seg a ON a.doc = e.doc AND a.seg = e.seg AND a.kind = 'A'
  GROUP BY e.doc, e.seg, p.head_line, e.end_line, e.end_base)"""
_LAST = [f"max(CASE WHEN level = {k} THEN line END) {BEFORE}" for k in range(4)]
_PATH = ", ".join(f"max(CASE WHEN level = {k} THEN line END) {UPTO} AS l{k}" for k in range(4))


def _part(k: int) -> str:
    fresh = "".join(f" AND (h.l{j} IS NULL OR h.l{j} < h.l{k})" for j in range(k))
    return f"CASE WHEN h.level >= {k}{fresh} THEN (SELECT x.label FROM heads x WHERE x.doc = h.doc AND x.line = h.l{k}) END"


QUERIES = {
    "segment_islands": (segment_islands, f"{UNITS_SQL} SELECT * FROM units"),
    "heading_asof": (heading_asof, f"{STREAM_SQL}, x AS (SELECT *, max(CASE WHEN kind = 'H' THEN line END) {BEFORE} AS heading_line FROM ev) SELECT doc, line, heading_line FROM x WHERE kind IN ('A', 'T')"),
    "tree_parent": (
        tree_parent,
        f"{STREAM_SQL}, h AS (SELECT * FROM ev WHERE kind = 'H'), x AS (SELECT *, {', '.join(f'{s} AS l{k}' for k, s in enumerate(_LAST))} FROM h) "
        "SELECT doc, line, level, greatest(CASE WHEN level > 0 THEN l0 END, CASE WHEN level > 1 THEN l1 END, CASE WHEN level > 2 THEN l2 END) AS parent_line FROM x",
    ),
    "tree_path": (
        tree_path,
        f"{STREAM_SQL}, heads AS (SELECT * FROM ev WHERE kind = 'H'), h AS (SELECT *, {_PATH} FROM heads), p AS (SELECT h.doc, h.line, {', '.join(f'{_part(k)} AS t{k}' for k in range(4))} FROM h) "
        "SELECT doc, line, concat_ws(' / ', t0, t1, t2, t3) AS path FROM p",
    ),
    "next_terminator": (
        next_terminator,
        f"{STREAM_SQL}, x AS (SELECT *, lead(kind) OVER (PARTITION BY doc ORDER BY line) AS nk, lead(line) OVER (PARTITION BY doc ORDER BY line) AS nl FROM ev) "
        "SELECT doc, line, CAST(CASE WHEN nk = 'P' THEN nl ELSE -1 END AS BIGINT) AS terminator_line, nl AS body_end FROM x WHERE kind = 'T'",
    ),
    "span_since_prev": (
        span_since_prev,
        f"{STREAM_SQL}, x AS (SELECT *, lag(line) OVER (PARTITION BY doc ORDER BY line) AS pl FROM ev WHERE kind IN ('F', 'P')) "
        "SELECT doc, line, CAST(coalesce(pl + 1, 0) AS BIGINT) AS from_line, CAST(line - 1 AS BIGINT) AS to_line FROM x",
    ),
    "recovered_start": (
        recovered_start,
        f"{STREAM_SQL}, x AS (SELECT *, max(CASE WHEN kind = 'F' THEN line END) {BEFORE} AS pl FROM ev) SELECT doc, line, CAST(coalesce(pl + 1, 0) AS BIGINT) AS start_line FROM x WHERE kind = 'A'",
    ),
    "label_peek": (
        label_peek,
        f"{STREAM_SQL}, e AS (SELECT *, lead(line) OVER (PARTITION BY doc ORDER BY line) AS nl FROM ev WHERE kind IN ('H', 'A', 'F')) "
        "SELECT e.doc, e.line, l.label AS display_label FROM e LEFT JOIN ev l ON l.doc = e.doc AND l.line = e.line + 1 AND (e.nl IS NULL OR e.nl > e.line + 1) AND regexp_matches(l.label, '^k[0-9]$|^k[1-4][0-9]$') WHERE e.kind = 'H'",
    ),
    "owned_candidates": (
        owned_candidates,
        f"{STREAM_SQL}, b AS (SELECT doc, line, base, CASE WHEN kind = 'T' THEN 'C' ELSE kind END AS kind FROM ev WHERE kind <> 'P'), "
        "x AS (SELECT *, lead(kind) OVER (PARTITION BY doc ORDER BY line) AS nk, lead(base) OVER (PARTITION BY doc ORDER BY line) AS nb FROM b) SELECT doc, line, base FROM x WHERE kind = 'C' AND nk = 'F' AND nb = base",
    ),
    "front_matter": (
        front_matter,
        f"{STREAM_SQL}, f AS (SELECT doc, min(CASE WHEN kind = 'A' THEN line END) AS first FROM ev GROUP BY doc) SELECT ev.doc, ev.line, ev.label FROM ev JOIN f ON f.doc = ev.doc WHERE (first IS NULL OR line < first) AND kind NOT IN ('H', 'T')",
    ),
    "contained_provisions": (
        contained_provisions,
        f"{UNITS_SQL} SELECT p.doc, p.line, u.head_line, u.end_line FROM ev p JOIN units u ON u.doc = p.doc AND p.line > u.head_line AND p.line < u.end_line WHERE p.kind = 'P'",
    ),
}
