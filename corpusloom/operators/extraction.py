"""Captures to relations: lines, events, units, provisions, headings, gaps, ledger and warnings.

All documents go through at once with ``doc`` as key; the parse is the only
Python. Everything else is windows and joins over (doc, line).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import descriptive_label, trim
from corpusloom.operators import aggregates, automaton, grammar, markup, segmentation
from corpusloom.operators.integrity import contained_in, positional_differences

#: What the gaps and the ledger's rows are called.
EMITTED_ARTICLE, EMITTED_PROVISION, GAP, EXCLUSION = "emitted-article", "emitted-transitory", "known-gap", "reviewed-exclusion"
APPROVED = ((GAP, "source-text-unavailable"), (EXCLUSION, "source-elimination-notice"), (EXCLUSION, "source-renumber-redirect-notice"))


@dataclass
class Extracted:
    """The relations of all documents."""

    lines: DataFrame
    hierarchy: DataFrame
    articles: DataFrame
    provisions: DataFrame
    dropped: DataFrame
    front_matter: DataFrame
    gaps: DataFrame
    ledger: DataFrame
    warnings: DataFrame
    faults: DataFrame


def _body(heads: DataFrame, lines: DataFrame, start: str, end: str) -> DataFrame:
    """``heads`` with ``body``: the rest of the header's line and the lines after it up to ``end``, joined by spaces.

    Lines find their header by an as-of window, so that no range join is made.
    """
    h = heads.select("doc", F.col(start).alias("line"), F.lit(None).cast("string").alias("text"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    l = lines.select("doc", "line", "text", F.lit(None).cast("long").alias("_s"), F.lit(None).cast("long").alias("_e"))  # noqa: E741
    w = Window.partitionBy("doc").orderBy("line", F.col("_s").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    owned = h.unionByName(l).withColumn("_from", F.last("_s", True).over(w)).withColumn("_to", F.last("_e", True).over(w))
    owned = owned.filter("text is not null and line > _from and line < _to")
    bodies = aggregates.ordered_text(owned.withColumnRenamed("_from", start), ["doc", start], "line", "text").withColumnRenamed("text", "_rest")
    joined = heads.join(bodies, ["doc", start], "left")
    return joined.withColumn("body", F.trim(F.concat_ws(" ", F.when(F.col("tail") != "", F.col("tail")), "_rest"))).drop("_rest", "tail")


def extract(captures: DataFrame, treaty: bool = False, policy: DataFrame | None = None, fifth_admitted: Column | None = None, recover: bool = False, classify: Callable[[DataFrame], DataFrame] | None = None) -> Extracted:
    """Relations from captures (doc, html).

    With ``recover`` headers of looser shapes count too, where their own
    terminator follows. ``classify`` gives the events of lines instead, as
    rules.events() does for documents of several contexts at once.

    ``policy`` has reviewed classes of source units that no unit takes: (doc,
    source_unit_id, kind, reason), kinds and reasons as in APPROVED.
    """
    parsed = markup.parse(captures, "doc", "html").checkpoint()
    lines = markup.lines_in(parsed)
    if classify is None:
        events = grammar.classified(lines, treaty, fifth_admitted)
        events = (grammar.recovered(lines, events) if recover else events).checkpoint()
    else:
        events = classify(lines.select("doc", "line", "text")).checkpoint()
    source = lines.filter("event is not null").select("doc", "line", "event.*")

    heads = segmentation.tree_parent(events.filter("kind = 'H'")).select("doc", "line", "heading", "level", "text", "parent_line")
    order = F.row_number().over(Window.partitionBy("doc").orderBy("line")) - 1
    follow = lines.filter(descriptive_label(F.col("text"))).select(F.col("doc").alias("_d"), (F.col("line") - 1).alias("_l"), F.col("text").alias("display_label"))
    free = events.select(F.col("doc").alias("_d"), (F.col("line") - 1).alias("_l"))
    follow = follow.join(free, ["_d", "_l"], "left_anti")
    hierarchy = heads.join(follow, (F.col("doc") == F.col("_d")) & (F.col("line") == F.col("_l")), "left")
    hierarchy = hierarchy.select("doc", "line", F.col("heading").alias("kind"), "level", F.col("text").alias("label"), "display_label", "parent_line", order.alias("doc_order"))
    place = segmentation.last_heading(events).select("doc", "line", "heading_line")

    unit = grammar.TREATY_UNIT if treaty else grammar.UNIT
    units = segmentation.units(events)
    found = units.filter("head_line is not null")
    first = events.filter("kind = 'A'").select("doc", F.col("line").alias("head_line"), "number", "ordinal_raw", F.col("tail") if classify else trim(F.regexp_replace("text", unit, "")).alias("tail"))
    if recover:
        for shape in (grammar.RECOVERED_SUFFIXED, grammar.RECOVERED_OPEN):
            first = first.withColumn("tail", trim(F.regexp_replace("tail", shape, "")))
    last = events.filter("kind = 'F'").select("doc", F.col("line").alias("end_line"), F.col("base").alias("_eb"), "suffix", F.col("text").alias("ficha_ref"))
    made = found.join(first, ["doc", "head_line"]).join(last, ["doc", "end_line"])
    made = _body(made, lines, "head_line", "end_line")
    number = grammar.adopted(F.col("number"), F.col("_eb"), F.col("suffix"))
    ids = source.filter("kind = 'F'").select("doc", F.col("line").alias("end_line"), F.col("unit").alias("source_unit_id"))
    articles = made.join(ids, ["doc", "end_line"], "left").join(place.withColumnRenamed("line", "head_line"), ["doc", "head_line"], "left")
    articles = articles.select(
        "doc", number.alias("number"), F.when(number == F.col("number"), F.coalesce("ordinal_raw", F.lit(""))).otherwise("").alias("ordinal_raw"), "body", "ficha_ref", "heading_line", "source_unit_id",
        F.col("head_line").alias("extract_order"), "end_line", "n_within", F.col("number").alias("_header"), "suffix",
        (F.row_number().over(Window.partitionBy("doc").orderBy("head_line")) - 1).alias("doc_order"),
    )

    stops = segmentation.next_terminator(events).select("doc", "line", "number", "attaches_to", "terminator_line", "body_end", F.col("text").alias("label"), trim(F.regexp_replace("text", grammar.PROVISION, "")).alias("tail"))
    size = lines.groupBy("doc").agg((F.max("line") + 1).alias("_n"))
    stops = stops.join(size, "doc").withColumn("body_end", F.coalesce("body_end", "_n")).drop("_n").withColumnRenamed("line", "start")
    inside = found.select("doc", "head_line", "end_line")
    told = contained_in(stops.select("doc", "start"), inside, "doc", "start", "head_line", "end_line").select("doc", "start")
    outside = stops.join(told, ["doc", "start"], "left_anti")
    whole = _body(outside, lines, "start", "body_end").join(place.withColumnRenamed("line", "start"), ["doc", "start"], "left")
    pids = source.filter("kind = 'P'").select("doc", F.col("line").alias("terminator_line"), F.col("unit").alias("source_unit_id"))
    provisions = whole.filter("body <> ''").join(pids, ["doc", "terminator_line"], "left").select(
        "doc", F.coalesce("number", F.lit("")).alias("number"), F.coalesce("attaches_to", F.lit("")).alias("attaches_to"), "body", "label", "heading_line", "source_unit_id", F.col("start").alias("extract_order"), "terminator_line",
        (F.row_number().over(Window.partitionBy("doc").orderBy("start")) - 1).alias("doc_order"),
    )

    seg = segmentation.islands(events).filter("kind = 'A'").select("doc", "seg", "line", "number")
    dropped = seg.join(units.select("doc", "seg", "head_line", "end_line"), ["doc", "seg"], "left").filter("head_line is null or line < head_line").select("doc", "line", "number")

    labels = hierarchy.filter("display_label is not null").select("doc", F.lit("H").alias("kind"), (F.col("line") + 1).alias("line"))
    front = segmentation.front_matter(lines.select("doc", "line", "text"), events.select("doc", "line", "kind").unionByName(labels))
    told_lines = contained_in(front.select("doc", "line"), whole.select("doc", F.col("extract_order" if "extract_order" in whole.columns else "start").alias("s"), F.col("body_end").alias("e")), "doc", "line", "s", "e").select("doc", "line")
    front = front.join(told_lines, ["doc", "line"], "left_anti")
    sort = F.array_sort(F.collect_list(F.struct("line", "text")))
    front_matter = front.groupBy("doc").agg(F.array_join(F.transform(sort, lambda x: x["text"]), " ").alias("body"), F.count(F.lit(1)).alias("n_lines"))

    gaps, ledger = reconcile(source, articles, provisions, lines, events, inside, policy)
    return Extracted(lines, hierarchy, articles, provisions, dropped, front_matter, gaps, ledger, warnings(lines, hierarchy, articles, provisions, dropped, front_matter, whole), markup.faults_in(parsed))


def reconcile(source: DataFrame, articles: DataFrame, provisions: DataFrame, lines: DataFrame, events: DataFrame, spans: DataFrame, policy: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(gaps, ledger): a ledger row for each source event: the unit it ends, else its reviewed class, else a gap with its reason."""
    bound = articles.select("doc", "source_unit_id", F.lit(EMITTED_ARTICLE).alias("_kind"), F.col("number").alias("_label")).unionByName(
        provisions.select("doc", "source_unit_id", F.lit(EMITTED_PROVISION), F.trim(F.concat_ws(" ", "number", "attaches_to"))).toDF("doc", "source_unit_id", "_kind", "_label")
    )
    rows = source.select("doc", "line", "order", "caption", F.col("unit").alias("source_unit_id"), F.col("kind").alias("_k")).join(bound.filter("source_unit_id is not null"), ["doc", "source_unit_id"], "left")
    if policy is None:
        rows = rows.withColumn("_pk", F.lit(None).cast("string")).withColumn("_pr", F.lit(None).cast("string"))
    else:
        rows = rows.join(policy.select("doc", "source_unit_id", F.col("kind").alias("_pk"), F.col("reason").alias("_pr")), ["doc", "source_unit_id"], "left")
    within = contained_in(source.filter("kind = 'P'").select("doc", "line"), spans, "doc", "line", "head_line", "end_line").select("doc", "line", F.lit(True).alias("_in"))
    ends = events.filter(F.col("kind").isin("F", "P")).select("doc", "line")
    marks = lines.select("doc", "line", F.col("text").rlike("(?i)Texto no disponible").alias("_t"), F.lit(0).alias("_end")).unionByName(ends.select("doc", "line", F.lit(False).alias("_t"), F.lit(1).alias("_end")))
    w = Window.partitionBy("doc").orderBy("line", "_end")
    island = marks.withColumn("_s", F.coalesce(F.sum("_end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    said = island.groupBy("doc", "_s").agg(F.max("_t").alias("_said"), F.max(F.when(F.col("_end") == 1, F.col("line"))).alias("line")).filter("line is not null").select("doc", "line", "_said")
    rows = rows.join(within, ["doc", "line"], "left").join(said, ["doc", "line"], "left")
    reason = F.when(F.col("_k") == "P", F.when(F.col("_in"), "transitorio-inside-article-body").otherwise("transitorio-terminator-without-standalone-unit"))
    reason = reason.when(F.col("_said"), "source-text-unavailable").otherwise("unconsumed-article-terminator")
    kind = F.coalesce("_kind", "_pk", F.lit(GAP))
    ledger = rows.select("doc", "order", "source_unit_id", "caption", kind.alias("kind"), F.col("_label").alias("unit_label"), F.when(F.col("_kind").isNull(), F.coalesce(F.col("_pr"), reason)).alias("reason"))
    gaps = ledger.filter(F.col("kind") == GAP).select("doc", "source_unit_id", "reason", "caption", (F.row_number().over(Window.partitionBy("doc").orderBy("order")) - 1).alias("doc_order"))
    return gaps, ledger


def matched_policy(unbound: DataFrame, policy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, faults) of source events without unit against a reviewed policy, in order.

    Both are numbered by their order in the document; at each place all of
    caption, base, ficha, order, source unit and source lines must agree. Places that only one
    side has, or where they differ, are faults; there are no classes then for
    the document.
    """
    fields = ["source_unit_id", "caption", "base", "ficha", "order", "source_lines"]
    w = Window.partitionBy("doc").orderBy("order")
    a = unbound.select("doc", F.row_number().over(w).alias("place"), F.struct(*fields).alias("_a"))
    b = policy.select("doc", F.row_number().over(w).alias("place"), F.struct(*fields).alias("_b"), "kind", "reason")
    both = a.join(b, ["doc", "place"], "full_outer")
    faults = both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("doc", "place")
    fine = both.filter(F.col("_a").eqNullSafe(F.col("_b"))).join(faults.select("doc").distinct(), "doc", "left_anti")
    return fine.select("doc", F.col("_a.source_unit_id").alias("source_unit_id"), "kind", "reason"), faults


#: What a sequence of events is compared in with a reviewed policy.
FIELDS = ("source_unit_id", "caption", "base", "ficha", "order", "source_lines")


def in_sequence(unbound: DataFrame, policy: DataFrame, contexts: DataFrame, reviewed: dict[str, object]) -> tuple[DataFrame, DataFrame]:
    """(classes, faults) of source events without unit, by an automaton that waits for the rows of a reviewed policy one after the other.

    ``policy`` has ``place`` from 0 and is small: its length is the number of
    states. ``contexts`` (doc, ...) says what each document is; only documents
    of the ``reviewed`` context are classified. There an event that isn't the
    one waited for, and an end before the last row, are faults (drift,
    unfinished, with the place reached). Elsewhere an event with an id of the
    policy is one (foreign-context), and all else has no class.
    """
    rows = policy.orderBy("place").collect()  # a reviewed policy, of tens of rows
    n = len(rows)
    fits = F.lit(True)
    for name, value in reviewed.items():
        fits = fits & F.col(name).eqNullSafe(F.lit(value))
    known = contexts.select("doc", fits.alias("_reviewed"))
    told = unbound.select("doc", *FIELDS).join(known, "doc", "left").withColumn("_reviewed", F.coalesce("_reviewed", F.lit(False)))
    keyed = policy.select("place", F.struct(*FIELDS).alias("_policy"), "kind", "reason", F.col("source_unit_id").alias("_target"))
    small = F.broadcast(keyed)
    foreign = told.filter("not _reviewed").join(small.select("_target"), F.col("source_unit_id") == F.col("_target"), "left_semi")
    mine = told.filter("_reviewed").join(small, F.struct(*FIELDS) == F.col("_policy"), "left")
    lost = n + 1  # once here, always here
    step = F.transform(F.sequence(F.lit(0), F.lit(lost)), lambda s: F.when((s == F.col("place")) & (s < n), s + 1).otherwise(lost))
    walked = automaton.states_at(mine.withColumn("_step", step), "doc", "order", "_step", n + 2)
    classes = walked.filter(F.col("after") != lost).select("doc", "source_unit_id", "kind", "reason")
    drift = walked.filter((F.col("after") == lost) & (F.col("before") != lost)).select("doc", F.lit("drift").alias("fault"), F.col("before").alias("place"))
    ends = known.filter("_reviewed").select("doc").join(walked.groupBy("doc").agg(F.max_by("after", "order").alias("state")), "doc", "left")
    short = ends.filter(F.coalesce("state", F.lit(0)) < n).select("doc", F.lit("unfinished").alias("fault"), F.coalesce("state", F.lit(0)).alias("place"))
    faults = drift.unionByName(short).unionByName(foreign.select("doc", F.lit("foreign-context").alias("fault"), F.lit(None).cast("int").alias("place")))
    return classes.join(faults.select("doc").distinct(), "doc", "left_anti"), faults


def with_source_lines(lines: DataFrame, source: DataFrame) -> DataFrame:
    """Source events (doc, line, ...) with ``source_lines``, the texts since the event before them in the document."""
    ends = lines.select("doc", "line", "text", F.col("event").isNotNull().cast("int").alias("_end"))
    w = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    part = ends.withColumn("_part", F.coalesce(F.sum("_end").over(w), F.lit(0)))
    texts = F.array_sort(F.collect_list(F.when(F.col("_end") == 0, F.struct("line", "text"))))
    told = part.groupBy("doc", "_part").agg(F.max(F.when(F.col("_end") == 1, F.col("line"))).alias("line"), F.transform(texts, lambda x: x["text"]).alias("source_lines")).filter("line is not null")
    return source.join(told.select("doc", "line", "source_lines"), ["doc", "line"])


def incomplete(source: DataFrame, ledger: DataFrame) -> DataFrame:
    """Places at which the ledger isn't the source's events in order, each once."""
    return positional_differences(source.select("doc", "order", F.col("unit").alias("source_unit_id"), "caption"), ledger, ["doc"], ["order"], ["source_unit_id", "caption"])


def policy_faults(policy: DataFrame) -> DataFrame:
    """Policy rows with a kind and reason that isn't an approved pair."""
    return policy.filter(~F.struct("kind", "reason").isin(*[F.struct(F.lit(k), F.lit(r)) for k, r in APPROVED]))


def warnings(lines: DataFrame, hierarchy: DataFrame, articles: DataFrame, provisions: DataFrame, dropped: DataFrame, front: DataFrame, provision_heads: DataFrame) -> DataFrame:
    """(doc, warning), texts as they are compared with the approved ones."""
    say = lambda df, text: df.select("doc", text.alias("warning"))
    out = say(articles.filter("n_within > 0"), F.format_string('article %s: %d in-body "Artículo N" cross-reference(s) were folded into the body', "_header", "n_within"))
    adopted = articles.filter("number <> _header")
    out = out.unionByName(say(adopted, F.format_string('article %s: header dropped the "%s" suffix present in its Ficha (%s); adopted "%s"', "_header", "suffix", "ficha_ref", "number")))
    empty = provision_heads.filter("body = ''")
    out = out.unionByName(say(empty, F.format_string("transitorio %s: header found with no provision text — not recorded", F.coalesce("number", F.lit("")))))
    lost = dropped.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    out = out.unionByName(say(lost, F.format_string("%d article header(s) had no Ficha terminator and were moved to `dropped`", "n")))
    seen = lines.groupBy("doc").agg(F.sum(F.regexp_count("text", F.lit(r"(?iu)\bART[IÍ]CULO\s+[0-9]+"))).alias("seen"), F.count(F.lit(1)).alias("n_lines"))
    made = articles.groupBy("doc").agg(F.count(F.lit(1)).alias("made"))
    ratio = seen.join(made, "doc", "left").select("doc", "seen", "n_lines", F.coalesce("made", F.lit(0)).alias("made"))
    none = F.format_string('extractor returned 0 articles but the source contains %d "ARTICULO N" occurrence(s) — off-template payload', "seen")
    few = F.format_string('extractor returned %d articles but the source contains %d "ARTICULO N" occurrence(s) — possible off-template or many dropped', "made", "seen")
    out = out.unionByName(say(ratio.filter("made = 0"), none)).unionByName(say(ratio.filter("made > 0 and made < seen * 0.5"), few))
    large = front.withColumnRenamed("n_lines", "f").join(seen, "doc").filter("f > n_lines * 0.5")
    out = out.unionByName(say(large, F.format_string("frontMatter is %d of %d non-empty lines (%d%%) — suspiciously large", "f", "n_lines", F.floor(F.col("f") / F.col("n_lines") * 100 + 0.5).cast("int"))))
    books = hierarchy.filter("kind = 'libro'").groupBy("doc").agg(F.count(F.lit(1)).alias("b")).join(ratio.filter("made = 0"), "doc")
    return out.unionByName(say(books, F.format_string("extractor saw %d LIBRO heading(s) but extracted 0 articles — top-level structure present but body parsing failed", "b")))
