"""Quality rules whose cutoffs keep the risk of false rejection under control.

Each text gets counts (words, symbols, repeated lines and words ...) and from
them a few statistics that are high for junk. Each statistic has a scale; a
text's badness is the largest of its statistics in units of their scales, and a
cutoff c stands for all rules at once: a text goes if any statistic is above c
times its scale. For each stratum cutoffs are tested on labelled holdout rows in a fixed order, from
lenient to strict, up to the first whose exact (Clopper-Pearson) upper bound on
the share of good texts rejected exceeds the allowed risk. A fixed order needs
no correction over cutoffs, and all before the first failure hold at once, so
that among them the one may be taken that rejects the most bad rows and the
fewest good ones; over strata the confidence is divided (Bonferroni). So with
probability 1 - delta no stratum loses more than ``risk`` of its good texts to
the rules. Where there are too few labelled rows to show that, nothing is
rejected beyond the base rule.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, only, prepare, staged
from corpusloom.llm.components import small_or_shuffled

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Statistics that the rules compare with cutoffs, each in 0..1, and their scales: what is plainly too much.
SCALES = {"symbol_share": 0.10, "upper_share": 0.30, "line_repeat_share": 0.50, "word_repeat_share": 0.50, "top_word_share": 0.25, "mark_share": 0.40}
STATISTICS = tuple(SCALES)
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: Cutoffs tried are LENIENT to STRICT multiples of STEP, in units of the scales.
STEP, LENIENT, STRICT = 0.05, 40, 5


def count_text(text: str) -> tuple:
    """The counts and statistics of one text."""
    raw = text.encode()
    words = raw.split()  # bytes are split at the six ASCII characters of white space
    n = len(words)
    if not n:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0, *[0.0] * len(STATISTICS))
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeated_lines = len(lines) - len(set(lines))
    repeated = repeat_words(words)
    kinds = Counter(words)
    upper = sum(1 for w in words if w.isupper() and len(w) > 1)
    ends = sum(1 for w in words if w[-1:] in b"!|*#$%&<>")
    return (
        n, chars, symbols, repeated_lines, repeated,
        symbols / chars, upper / n, repeated_lines / len(lines), repeated / n, max(kinds.values()) / n if n >= 20 else 0.0, ends / n,
    )


def repeat_words(words: list) -> int:
    """Words that lie in a window of three which occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total, end = 0, 0  # words before ``end`` are counted already
    for i, window in enumerate(windows):
        if seen[window] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def measure(text: str | Column) -> Column:
    """A struct of the counts and the statistics of a text column; null counts as empty."""

    @F.pandas_udf(COUNTS + "".join(f", {s} double" for s in STATISTICS))
    def counted(texts: pd.Series) -> pd.DataFrame:
        names = [x.split()[0] for x in COUNTS.split(", ")] + list(STATISTICS)
        return pd.DataFrame([count_text(t or "") for t in texts], columns=names)

    return counted(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def binomial_upper(rejected: int, total: int, delta: float) -> float:
    """The exact upper confidence bound (Clopper-Pearson) for a share, at level 1 - delta."""
    if rejected >= total:
        return 1.0
    low, high = rejected / total, 1.0
    for _ in range(60):
        p = (low + high) / 2
        if _binomial_cdf(rejected, total, p) > delta:
            low = p
        else:
            high = p
    return high


def _binomial_cdf(k: int, n: int, p: float) -> float:
    if p <= 0 or p >= 1:
        return float(p <= 0)
    top = math.lgamma(n + 1)
    logs = [top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    most = max(logs)
    return math.exp(most) * math.fsum(math.exp(x - most) for x in logs)


def choose(good: list[int], bad: list[int], risk: float, level: float) -> tuple[int, float] | None:
    """(cutoff, upper bound on the share of good texts it rejects), from the labelled rows in each of the LENIENT + 2 bins; None if nothing can be shown.

    Rows in bins above the cutoff are rejected. Of the cutoffs that hold, the
    one with the most bad rows rejected less good ones is taken, the most
    lenient of equals; without bad rows the strictest.
    """
    total, found = sum(good), []
    for cut in range(LENIENT, STRICT - 1, -1):
        above = sum(good[cut + 1 :])
        bound = binomial_upper(above, total, level) if total and above <= risk * total else 1.0
        if bound > risk:
            break
        found.append((sum(bad[cut + 1 :]) - above if sum(bad) else -cut, cut, bound))
    return max(found)[1:] if found else None


def _bin(m: Column) -> Column:
    """The badness of a text in steps, rounded up."""
    worst = F.greatest(*[m[s] / F.lit(scale * STEP) for s, scale in SCALES.items()])
    return F.least(F.greatest(F.ceil(worst - F.lit(1e-9)).cast("int"), F.lit(0)), F.lit(LENIENT + 1))


_NO_STRATUM = "\x00"


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(stratum, cut, n_good, bound): a row for each stratum of ``measured`` (doc_id, stratum, m) that has a cutoff.

    Rows with a label by ``labels`` (doc_id, quality) count, but those that
    fail the base rule; a doc_id with both labels is good. The strata's
    histograms are made and judged where they lie.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_good"))
    rows = measured.filter(~base_failed(F.col("m"))).join(known, F.col("doc_id") == F.col("_id"))
    counted = rows.groupBy(F.coalesce("stratum", F.lit(_NO_STRATUM)).alias("stratum"), _bin(F.col("m")).alias("bin")).agg(F.count_if(F.col("_good") == 1).alias("good"), F.count_if(F.col("_good") == 0).alias("bad"))
    strata = staged(counted.groupBy("stratum").agg(F.collect_list(F.struct("bin", "good", "bad")).alias("bins"), F.sum("good").alias("n_good")), "strata")  # few bins each
    level = delta / max(1, strata.count())

    @F.pandas_udf("cut int, bound double")
    def chosen(bins: pd.Series) -> pd.DataFrame:
        out = []
        for listed in bins:
            good, bad = [0] * (LENIENT + 2), [0] * (LENIENT + 2)
            for x in listed:
                good[x["bin"]], bad[x["bin"]] = x["good"], x["bad"]
            out.append(choose(good, bad, risk, level) or (None, None))
        return pd.DataFrame(out, columns=["cut", "bound"]).astype({"cut": "Int32", "bound": "float64"})

    return staged(strata.select("stratum", "n_good", chosen("bins").alias("c")).filter("c.cut is not null").select("stratum", "c.cut", "n_good", "c.bound"), "cutoffs")


def _kept(rows: DataFrame, m: str, stratum: str, found: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: false if the base rule or the cutoff of the stratum rejects."""
    cut, where = fresh(rows, "_cut"), fresh(rows, "_where")
    cuts = small_or_shuffled(found.select(F.col("stratum").alias(where), F.col("cut").alias(cut)))
    joined = rows.join(cuts, F.coalesce(F.col(stratum).cast("string"), F.lit(_NO_STRATUM)) == F.col(where), "left")
    fine = ~base_failed(F.col(m)) & (F.col(cut).isNull() | (_bin(F.col(m)) <= F.col(cut)))
    return joined.withColumn(name, fine).drop(cut, where)


def judge(documents: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts and verdict for each row of ``documents``.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept. Null texts count as empty, and so fail
    the base rule; null strata share one; labels for unknown or null ids
    are ignored, a doc_id's repeated labels count once, as good if they
    differ; each row of a repeated doc_id counts; without labels no rule
    rejects anything beyond the base. Texts are read as a whole, however long. Other columns
    are ignored.
    """
    prepare(documents.sparkSession)
    rows = only(documents, doc_id=id_col, text=text_col, stratum=stratum_col)
    rows = staged(rows.select("doc_id", F.col("stratum").cast("string").alias("stratum"), measure("text").alias("m")), "measured")
    judged = _kept(rows, "m", "stratum", cutoffs(rows, labels.select("doc_id", "quality"), risk, delta), "kept")
    m = F.col("m")
    names = [x.split()[0] for x in COUNTS.split(", ")]
    return judged.select("doc_id", *[m[x].alias(x) for x in names], base_failed(m).alias("base_failed"), "kept")


def accepted(documents: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with their columns; what is said of judge() holds here too.

    Each text is measured once: rows are staged with their measures.
    """
    prepare(documents.sparkSession)
    name, keep = fresh(documents, "_m"), fresh(documents, "_keep")
    rows = staged(documents.withColumn(name, measure(F.col("text"))), "measured")
    thin = rows.select("doc_id", F.col("lang").cast("string").alias("stratum"), F.col(name).alias("m"))
    judged = _kept(rows, name, "lang", cutoffs(thin, labels.select("doc_id", "quality"), risk, delta), keep)
    return judged.filter(F.col(keep)).select(*[F.col(f"`{c}`") for c in documents.columns])
