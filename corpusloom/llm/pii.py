"""Personal data in texts, by weak supervision and with DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card numbers and telephone
numbers; wider patterns propose further spans. Labelers vote on each candidate
(yes, no or nothing): the base pattern, the form, a gazetteer, the context and the borders.
Only counts of vote patterns go to the driver, at most one for each combination. There
expectation-maximisation estimates how reliable each labeler is, and a logistic
span classifier is trained on the resulting probabilities; its weights go back
into a DataFrame expression. Base spans are kept whatever the vote.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import spans
from corpusloom.llm.common import only, staged

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")
LABELERS = ("base", "form", "gazetteer", "context", "border")

# The base patterns; possessive where backtracking can't lead to a match, so that long runs need no stack, and
# begun only at the start of a run or at the end of the last match, so that they take linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What wider spans look like: addresses written out, IPv6, card numbers that fail the check, numbers without country code.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?i:at|arroba)[\])]\x20?[A-Za-z0-9-]++(?:(?:\x20?[\[(](?i:dot|punto|point|punkt)[\])]\x20?|\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
FORM = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,18}$",
    "ip": r"^(?:(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}|[0-9A-Fa-f:]{15,39})$",
    "card": r"^[0-9]{13,19}$|^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$",
    "phone": r"^\+?[0-9(][0-9]{0,3}[\x20().-]+[0-9][\x20().0-9-]+$",
}
#: Gazetteers: endings of domains, private and public first bytes, issuers of cards, calling codes.
GAZETTEER = {
    "email": r"(?i)\.(?:com|net|org|edu|gov|info|io|de|fr|es|uk|eu|ch|at|be|mx|ar|it|nl|us|ca)$",
    "ip": r"^(?:10|127|172|192|[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6(?:011|5|2))",
    "phone": r"^\+(?:1|2[07]|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])[^0-9]|^\(?[2-9][0-9]{2}\)?[\x20.-][2-9]",
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|contacto|correo|courriel|kontakt|write|address)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|adresse|servidor|serveur|login|from)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|carte|karte|tarjeta|credit|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|mobile|call|fax|handy|telefon|teléfono|téléphone)\b",
}
OTHER_CONTEXT = r"(?i)\b(?:version|section|chapter|isbn|order|invoice|serial|ticket|build|release|figure|table)\b"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), luhn(digits)).otherwise(False)


def _validity(kind: str):
    return lambda x: _valid(kind, x["match"])


def _votes(kind: str, base: Column, match: Column, left: Column, right: Column) -> Column:
    """One character for each labeler: y, n or - (no vote)."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    varied = F.size(F.array_distinct(F.split(digits, ""))) >= 4
    context = F.when(left.rlike(CONTEXT[kind]), "y").when(left.rlike(OTHER_CONTEXT), "n").otherwise("-")
    glued = left.rlike(r"[A-Za-z0-9_]$") | right.rlike(r"^[A-Za-z0-9_]")
    return F.concat(
        F.when(base, "y").otherwise("-"),
        F.when(match.rlike(FORM[kind]), "y").otherwise("n") if kind == "email" else F.when(match.rlike(FORM[kind]) & varied, "y").otherwise("n"),
        F.when(match.rlike(GAZETTEER[kind]), "y").otherwise("-"),
        context,
        F.when(glued, "n").otherwise("y"),
    )


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id and an array of candidates (start, end, kind, base, votes), from doc_id and text."""
    rows = documents.select("doc_id", spans.plain(F.col("text")).alias("text"))
    # a look at a few characters spares most texts the patterns
    digit = F.col("text").rlike("[0-9]")
    possible = {"email": F.contains("text", F.lit("@")), "ip": digit, "card": digit, "phone": digit & F.contains("text", F.lit("+"))}
    wide = {"email": F.col("text").rlike(r"[\[(](?i:at|arroba)[\])]"), "ip": digit & F.contains("text", F.lit(":")), "card": digit, "phone": digit}
    rows = rows.select(
        "doc_id", "text",
        *[F.when(possible[k], spans.marked(F.col("text"), BASE[k])).otherwise("").alias(f"b_{k}") for k in KINDS],
        *[F.when(wide[k], spans.marked(F.col("text"), WIDE[k])).otherwise("").alias(f"w_{k}") for k in KINDS],
    )
    rows = spans.places(rows, rows.columns[2:])
    rows = rows.select("doc_id", "text", *[F.filter(f"b_{k}", _validity(k)).alias(f"b_{k}") for k in KINDS], *[f"w_{k}" for k in KINDS])
    apart = lambda x: ~reduce(Column.__or__, [spans.overlaps(F.col(f"b_{k}"), x) for k in KINDS])
    any_found = sum((F.size(f"{s}_{k}") for s in "bw" for k in KINDS), F.lit(0)) > 0
    rows = rows.select("doc_id", F.when(any_found, spans.segments(F.col("text"))).alias("text"), *[f"b_{k}" for k in KINDS], *[F.filter(f"w_{k}", apart).alias(f"w_{k}") for k in KINDS])

    def about(kind: str, base: bool) -> Column:
        def one(x: Column) -> Column:
            start = F.greatest(x["start"] - 40, F.lit(0))
            left = spans.piece(F.col("text"), start, x["start"] - start)
            right = spans.piece(F.col("text"), x["end"], F.lit(4))
            return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), F.lit(base).alias("base"), _votes(kind, F.lit(base), x["match"], left, right).alias("votes"))

        return F.transform(f"{'b' if base else 'w'}_{kind}", one)

    return rows.select("doc_id", F.array_sort(F.concat(*[about(k, True) for k in KINDS], *[about(k, False) for k in KINDS])).alias("found"))


def estimate(patterns: list[tuple[int, str, int]], rounds: int = 50) -> dict[tuple[int, str], float]:
    """The probability that a candidate is personal data, by (kind, votes), by expectation-maximisation.

    For each labeler and class the probabilities of its three answers are
    estimated, over all kinds together; the share of true spans by kind. A few
    pseudo-counts say that a labeler is right more often than not.
    """
    if not patterns:
        return {}
    kind = np.array([p[0] for p in patterns])
    vote = np.array([["yn-".index(c) for c in p[1]] for p in patterns])
    n = np.array([p[2] for p in patterns], dtype=float)
    balance = (vote == 0).sum(1) - (vote == 1).sum(1)
    true = 1 / (1 + np.exp(-(balance - 0.5)))
    before = np.array([[[6.0, 2.0, 4.0]] * vote.shape[1], [[2.0, 6.0, 4.0]] * vote.shape[1]])
    for _ in range(rounds):
        log = np.zeros((2, len(n)))
        for label, weight in ((0, true * n), (1, (1 - true) * n)):
            share = np.array([(weight[kind == k].sum() + 1) / (n[kind == k].sum() + 2) for k in range(len(KINDS))])
            log[label] = np.log(share[kind])
            for j in range(vote.shape[1]):
                tally = np.bincount(vote[:, j], weight, 3) + before[label, j]
                log[label] += np.log(tally / tally.sum())[vote[:, j]]
        true = 1 / (1 + np.exp(np.clip(log[1] - log[0], -60, 60)))
    return {(int(k), p[1]): float(t) for k, p, t in zip(kind, patterns, true, strict=True)}


def train(patterns: list[tuple[int, str, int]], steps: int = 400) -> list[float]:
    """Weights of the span classifier: bias, a weight for each kind, then yes and no of each labeler."""
    size = 1 + len(KINDS) + 2 * len(LABELERS)
    if not patterns:
        return [0.0] * size
    likely = estimate(patterns)
    x = np.array([_features(k, v) for k, v, _ in patterns], dtype=float)
    y = np.array([likely[k, v] for k, v, _ in patterns])
    n = np.sqrt(np.array([c for _, _, c in patterns], dtype=float))  # rare patterns count too
    n /= n.sum()
    w = np.zeros(size)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w -= 2.0 * (x.T @ (n * (p - y)) + 1e-3 * w)
    return [float(v) for v in w]


def _features(kind: int, votes: str) -> list[int]:
    return [1, *[int(kind == k) for k in range(len(KINDS))], *[int(v == a) for v in votes for a in "yn"]]


def _margin(x: Column, weights: list[float]) -> Column:
    total = F.lit(weights[0]) + F.element_at(F.array(*map(F.lit, weights[1 : 1 + len(KINDS)])), x["kind"] + 1)
    for j in range(len(LABELERS)):
        yes, no = weights[1 + len(KINDS) + 2 * j : 3 + len(KINDS) + 2 * j]
        v = F.substring(x["votes"], j + 1, 1)
        total = total + F.when(v == "y", yes).when(v == "n", no).otherwise(0.0)
    return total


def _listed(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(documents: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data in each whole text.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256
    and spans. Null texts count as empty and have no spans; very long texts are
    gone through in runs of bounded length; repeated rows and null ids give a
    row each; an empty table gives no rows. Spans of one kind don't overlap,
    those of different kinds may; of spans that start at the same place the
    kinds follow each other as they are listed. Other columns are ignored.
    """
    rows = staged(candidates(only(documents, doc_id=id_col, text=text_col)), "pii")
    counted = rows.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes").agg(F.count(F.lit(1)).alias("n"))
    patterns = sorted((int(k), v, int(n)) for k, v, n in counted.collect())  # at most 4 x 3^5 rows
    weights = train(patterns)
    bar = math.log(threshold / (1 - threshold))
    base = F.filter("found", lambda x: x["base"])
    kept = F.filter("found", lambda x: x["base"] | (_margin(x, weights) >= bar))
    numbers = F.transform(base, lambda x: x["kind"])
    counts = [(F.size(numbers) - F.size(F.array_remove(numbers, F.lit(k)))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(kept).alias("spans"))
