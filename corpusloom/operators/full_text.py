"""An inverted index over texts, and queries on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Latin letters with marks, and the letters that they fold to.
MARKED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
FOLDED = "aaaaaaeeeeiiiiooooouuuuncyy"


def fold(text: Column) -> Column:
    """Lower case without marks on Latin letters."""
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), MARKED, FOLDED)


def words(text: str) -> Column:
    """The folded words of a text, in order."""
    return F.regexp_extract_all(fold(F.col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def folded(some: list[str]) -> list[str]:
    """Distinct words as the index has them."""
    return sorted({w.lower().translate(str.maketrans(MARKED, FOLDED)) for w in some})


def index(rows: DataFrame, key: str, text: str, only: list[str] | None = None) -> DataFrame:
    """(token, key, n, first): an entry for each token and text, so that no token's list grows in one row.

    ``key`` is a row's own, so that nearly all counting is done before the
    exchange. With ``only`` other words don't leave their row.
    """
    at = F.posexplode(words(text)).alias("at", "token")
    if only is not None:
        placed = F.transform(words(text), lambda w, i: F.struct(i.alias("at"), w.alias("token")))
        at = F.inline(F.filter(placed, lambda x: x["token"].isin(folded(only))))
    found = rows.select(F.col(key).alias("key"), at)
    counted = found.groupBy("token", "key").agg(F.count(F.lit(1)).alias("n"), F.min("at").cast("long").alias("first"))
    return counted.select("token", F.col("key").alias(key), "n", "first")


def containing_all(postings: DataFrame, key: str, some: list[str]) -> DataFrame:
    """Keys of texts that have every word, with the number of their occurrences."""
    wanted = folded(some)
    hits = postings.filter(F.col("token").isin(wanted))
    return hits.groupBy(key).agg(F.count(F.lit(1)).alias("_k"), F.sum("n").alias("hits")).filter(F.col("_k") == len(wanted)).drop("_k")


def ghosts(postings: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """Keys in the index that have no row."""
    return postings.select(key).distinct().join(rows.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")


def vocabulary(rows: DataFrame, text: str, most: int) -> DataFrame:
    """The tokens of most texts, with the number of texts and of occurrences: one pass, one exchange of counts by token."""
    found = words(text)
    each = F.transform(found, lambda w: F.struct(w.alias("token"), F.lit(0).alias("texts"), F.lit(1).alias("here")))
    once = F.transform(F.array_distinct(found), lambda w: F.struct(w.alias("token"), F.lit(1).alias("texts"), F.lit(0).alias("here")))
    counted = rows.select(F.inline(F.concat(each, once))).groupBy("token").agg(F.sum("texts").alias("texts"), F.sum("here").alias("occurrences"))
    w = Window.orderBy(F.desc("texts"), "token")
    return counted.orderBy(F.desc("texts"), "token").limit(most).withColumn("place", F.row_number().over(w).cast("long"))
