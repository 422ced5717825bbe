"""Content identities of authorities, from relations keyed by norma_id.

Each field becomes a frame with its place (section, row, field); the frames of
an authority, joined in order, are hashed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import hashing


def _frames(values: Sequence[tuple[str, object]]) -> Column:
    """One text of the frames of literals ("word", "x"), texts ("text", column) and numbers ("number", column)."""
    parts = [F.lit(f"s{len(v)}:{v};") if kind == "word" else hashing.frame(v if isinstance(v, Column) else F.col(v), kind) for kind, v in values]
    return F.concat(*parts)


def _section(rows: DataFrame, section: int, order: str, name: str | None, row: Sequence[tuple[str, object]], owners: DataFrame) -> DataFrame:
    """(norma_id, section, text): the count of the rows under ``name`` and their frames in order, for each owner, also one without rows."""
    got = rows.groupBy("norma_id").agg(F.count(F.lit(1)).alias("n"), hashing.joined(_frames(row), F.col(order)).alias("t"))
    every = owners.join(got, "norma_id", "left")
    n = F.coalesce("n", F.lit(0)).cast("string")
    head = F.concat(F.lit(f"s{len(name)}:{name};i"), n, F.lit(";")) if name else F.lit("")
    return every.select("norma_id", F.lit(section).alias("section"), F.concat(head, F.coalesce("t", F.lit(""))).alias("text"))


def _positions(nodes: DataFrame) -> DataFrame:
    at = F.row_number().over(Window.partitionBy("norma_id").orderBy("doc_order")) - 1
    return nodes.select(F.col("id").alias("_node"), at.alias("_place"))


def _placed(rows: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    return rows.join(_positions(nodes), F.col(key) == F.col("_node"), "left")


def stream_v1(norma: DataFrame, nodes: DataFrame, articles: DataFrame, provisions: DataFrame) -> DataFrame:
    """(norma_id, section, text) of an authority, its headings, articles and transitory provisions; ids of nodes become places."""
    owners = norma.select(F.col("id").alias("norma_id"))
    first = norma.select(F.col("id").alias("norma_id"), F.lit(0).alias("section"), _frames([
        ("word", "norma"), ("number", "id"), ("number", "version_id"), ("text", "number"), ("text", "name"), ("number", "tipo"), ("text", "date"), ("text", "source_url"), ("text", "content_hash"), ("text", "imported_at"),
    ]).alias("text"))
    tree = _placed(nodes, nodes, "parent_id")
    heads = _section(tree, 1, "doc_order", "hierarchy-count", [("word", "hierarchy"), ("text", "kind"), ("text", "label"), ("text", "display_label"), ("number", "doc_order"), ("number", "extract_order"), ("number", "_place")], owners)
    arts = _section(_placed(articles, nodes, "hierarchy_node_id"), 2, "doc_order", "article-count", [("word", "article"), ("text", "number"), ("text", "ordinal_raw"), ("text", "body"), ("text", "ficha_ref"), ("number", "_place"), ("number", "doc_order"), ("number", "extract_order")], owners)
    provs = _section(_placed(provisions, nodes, "hierarchy_node_id"), 3, "doc_order", "transitory-count", [("word", "transitory"), ("text", "number"), ("text", "ordinal_raw"), ("text", "attaches_to"), ("text", "body"), ("text", "label"), ("number", "_place"), ("number", "doc_order"), ("number", "extract_order")], owners)
    return first.unionByName(heads).unionByName(arts).unionByName(provs)


def stream_v2(norma: DataFrame, nodes: DataFrame, articles: DataFrame, provisions: DataFrame, front: DataFrame, gaps: DataFrame) -> DataFrame:
    """The first stream, and front matter, coordinates and gaps."""
    owners = norma.select(F.col("id").alias("norma_id"))
    matter = owners.join(front.select("norma_id", "present", "body"), "norma_id", "left")
    state = F.when(F.col("present").isNull(), F.lit("s6:absent;")).otherwise(F.concat(F.when(F.col("present") == 1, "s7:present;").otherwise("s5:empty;"), hashing.frame(F.col("body"), "text")))
    fm = matter.select("norma_id", F.lit(4).alias("section"), F.concat(F.lit("s2:fm;"), state).alias("text"))
    ac = _section(articles, 5, "doc_order", "acoords", [("word", "ac"), ("text", "number"), ("number", "source_unit_id")], owners)
    tc = _section(provisions, 6, "doc_order", "tcoords", [("word", "tc"), ("text", "number"), ("text", "attaches_to"), ("number", "source_unit_id")], owners)
    ordered = gaps.withColumn("_o", F.row_number().over(Window.partitionBy("norma_id").orderBy("doc_order", "source_unit_id")))
    gp = _section(ordered, 7, "_o", "gaps", [("word", "g"), ("number", "source_unit_id"), ("text", "reason"), ("text", F.coalesce("caption", F.lit(""))), ("number", "doc_order")], owners)
    return stream_v1(norma, nodes, articles, provisions).unionByName(fm).unionByName(ac).unionByName(tc).unionByName(gp)


def identities(stream: DataFrame, domain: str, name: str) -> DataFrame:
    """(norma_id, identity) of a stream under a domain."""
    text = stream.groupBy("norma_id").agg(hashing.joined(F.col("text"), F.col("section")).alias("_t"))
    return text.select("norma_id", hashing.text_hash(F.concat(F.lit(f"{domain};"), "_t")).alias(name))


def content_hashes(articles: DataFrame) -> DataFrame:
    """(norma_id, content_hash): the hash of number and body of the articles in order."""
    text = articles.groupBy("norma_id").agg(hashing.joined(F.concat_ws(hashing.FIELD, "number", "body"), F.col("doc_order"), hashing.RECORD).alias("_t"))
    return text.select("norma_id", hashing.text_hash(F.col("_t")).alias("content_hash"))


def evidence(catalog_digest: str, fixture_digest: str, sidecars: DataFrame, ledgers: DataFrame, measures: DataFrame) -> DataFrame:
    """One row with the identity of a release: digests, sidecars (slug, digest), ledgers (slug, ordinal, source_unit_id, kind, reason) and measures in profile order (ordinal, slug, ...)."""
    word = lambda w: f"s{len(w)}:{w};"
    head = measures.sparkSession.createDataFrame([(0, "", word("catalog") + word(catalog_digest) + word("fixtures") + word(fixture_digest))], "a int, b string, t string")
    side = sidecars.select(F.lit(1).alias("a"), F.col("slug").alias("b"), _frames([("word", "sidecar"), ("text", "slug"), ("text", "digest")]).alias("t"))
    rows = ledgers.groupBy("slug").agg(F.count(F.lit(1)).alias("n"), hashing.joined(_frames([("word", "e"), ("number", "source_unit_id"), ("text", "kind"), ("text", "reason")]), F.col("ordinal")).alias("e"))
    led = measures.select("slug").join(rows, "slug", "left").select(F.lit(2).alias("a"), F.col("slug").alias("b"), F.concat(_frames([("word", "ledger"), ("text", "slug"), ("number", F.coalesce("n", F.lit(0)))]), F.coalesce("e", F.lit(""))).alias("t"))
    meas = measures.select(F.lit(3).alias("a"), F.format_string("%012d", "ordinal").alias("b"), _frames([("word", "measure"), ("text", "slug"), *[("number", c) for c in ("n_articles", "n_transitories", "n_gaps")], ("text", "front_matter"), ("number", "n_coordinates"), ("text", "adopted_identity")]).alias("t"))
    every = head.unionByName(side).unionByName(led).unionByName(meas)
    text = every.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", "b", "t"))), lambda x: x["t"]), "").alias("_t"))
    return text.select(hashing.text_hash(F.concat(F.lit(f"{hashing.EVIDENCE_V2};"), "_t")).alias("identity"))
