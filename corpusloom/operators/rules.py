"""Line rules as a table: each with a rank, the contexts that it holds in, and a pattern; the first that holds decides.

Which rules a document has is found by a join of its context with the table;
the patterns themselves, some tens, are put into one expression, so that lines
are classified where they are and only documents are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.numbers import base, header_number
from corpusloom.functions.text import trim
from corpusloom.operators import grammar, segmentation

#: (rank, kind, heading, level, pattern, bail, template, authority, version); a null context holds everywhere, ``bail`` turns away glued ordinals.
SCHEMA = "rank int, kind string, heading string, level int, pattern string, bail boolean, template string, authority long, version long"
WORD, TREATY = "word", "treaty"


def standard(spark: SparkSession, fifth: Sequence[tuple[int, int]] = (), loose: Sequence[tuple[int, int]] = ()) -> DataFrame:
    """The rules of both grammars; headers with the fifth suffix, and of looser shapes, only for some authorities and versions."""
    fifth_only = grammar.UNIT.replace("bis|ter|qu[aá]ter|quinquies", "quinquies")
    plain = grammar.UNIT.replace("|quinquies", "")
    everywhere = (None, None)
    rows: list[tuple] = [("F", None, None, grammar.TERMINATOR, False, None, *everywhere), ("P", None, None, grammar.PROVISION_TERMINATOR, False, None, *everywhere)]
    rows += [("A", None, None, plain, False, WORD, *everywhere), ("A", None, None, grammar.TREATY_UNIT, False, TREATY, *everywhere)]
    rows += [("A", None, None, fifth_only, False, WORD, *context) for context in fifth]
    for template, headings in ((WORD, grammar.HEADINGS), (TREATY, grammar.TREATY_HEADINGS)):
        rows += [("H", name, level, pattern, False, template, *everywhere) for name, level, pattern in headings]
    rows.append(("T", None, None, grammar.PROVISION, False, None, *everywhere))
    rows += [("C", None, None, pattern, True, WORD, *context) for context in loose for pattern in (grammar.RECOVERED_SUFFIXED, grammar.RECOVERED_OPEN)]
    return spark.createDataFrame([(rank, *row) for rank, row in enumerate(rows, 1)], SCHEMA)


def of_documents(contexts: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc, ranks) of the rules that hold in each document's context (doc, template, authority, version)."""
    c = contexts.select("doc", F.col("template").alias("_t"), F.col("authority").alias("_a"), F.col("version").alias("_v"))
    fits = lambda mine, theirs: F.col(mine).isNull() | F.col(mine).eqNullSafe(F.col(theirs))
    on = fits("template", "_t") & fits("authority", "_a") & fits("version", "_v")
    joined = c.join(F.broadcast(rules.select("rank", "template", "authority", "version")), on)  # some tens of rules
    return joined.groupBy("doc").agg(F.sort_array(F.collect_set("rank")).alias("ranks"))


def classified(lines: DataFrame, contexts: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc, line, rank, kind, heading, level, number, tail, text) of the lines (doc, line, text) for which a rule of their document holds; documents without context have none.

    ``number`` is the rule's first group, ``tail`` the line without what the
    rule matches. Kind C is a header that only counts if its own terminator
    follows.
    """
    known = sorted(rules.collect(), key=lambda r: r["rank"])
    if len({r["rank"] for r in known}) < len(known):
        raise ValueError("two rules of one rank")
    text, chain, number, tail = F.col("text"), F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(known):
        here = F.col("rank") == rule["rank"]
        holds = F.array_contains("ranks", F.lit(rule["rank"])) & text.rlike(rule["pattern"])
        if rule["bail"]:
            holds = holds & ~grammar.glued_ordinal(text, rule["pattern"])
        chain = F.when(holds, rule["rank"]).otherwise(chain)
        if rule["kind"] in ("A", "C", "F", "P"):
            number = F.when(here, F.regexp_extract(text, rule["pattern"], 1)).otherwise(number)
        if rule["kind"] in ("A", "C"):
            tail = F.when(here, trim(F.regexp_replace(text, rule["pattern"], ""))).otherwise(tail)
    told = lines.join(of_documents(contexts, rules), "doc").withColumn("rank", chain).filter("rank is not null")
    named: dict[str, Column] = {n: _chosen(known, n) for n in ("kind", "heading", "level")}
    return told.select("doc", "line", "rank", *[c.alias(n) for n, c in named.items()], number.alias("number"), tail.alias("tail"), "text")


def events(lines: DataFrame, contexts: DataFrame, rules: DataFrame) -> DataFrame:
    """The events of documents of any context, in the columns of grammar.classified() and with ``tail``; candidates are in if the terminator of their own base is the next event or candidate."""
    told = classified(lines, contexts, rules)
    head = F.col("kind").isin("A", "C")
    made = F.when(head, header_number(F.col("number")))
    suffix = F.when(F.col("kind") == "F", F.regexp_replace(F.lower(F.regexp_extract("text", grammar.TERMINATOR, 2)), "quater", "quáter"))
    rows = told.select(
        "doc", "line", "kind", "heading", "level", F.when(head, made["number"]).when(F.col("kind") == "T", F.regexp_extract("text", grammar.PROVISION, 2)).alias("number"), made["ordinal_raw"].alias("ordinal_raw"),
        F.when(head, base(made["number"])).when(F.col("kind").isin("F", "P"), F.col("number")).alias("base"), F.when(suffix != "", suffix).alias("suffix"), F.when(F.col("kind") == "T", F.regexp_extract("text", grammar.PROVISION, 1)).alias("attaches_to"), "tail", "text",
    )
    sure, maybe = rows.filter("kind <> 'C'"), rows.filter("kind = 'C'")
    own = segmentation.owned_candidates(sure, maybe).select("doc", "line")
    return sure.unionByName(maybe.join(own, ["doc", "line"], "left_semi").withColumn("kind", F.lit("A")))


def _chosen(rules: list, field: str) -> Column:
    out = F.lit(None)
    for rule in rules:
        if rule[field] is not None:
            out = F.when(F.col("rank") == rule["rank"], F.lit(rule[field])).otherwise(out)
    return out
