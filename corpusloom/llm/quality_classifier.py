"""A quality classifier from positive and unlabelled texts.

Trusted positives and unlabelled web text are told apart by small networks
that minimise the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)]),

whose second term estimates the risk on negatives without any negative label.
No negative label is used anywhere. The class prior is the smallest share, over
cutoffs of a network fitted on other folds, of unlabelled rows to positives
above the cutoff. The logistic curve that makes a probability of the networks'
output minimises the unbiased log-loss of the same two samples.

Positives are a bounded sample. Unlabelled text is all of it: its features are
staged, and enter the fit as cells of a random-hyperplane code with their
counts and means, the prior and the curve as histograms of all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, only, prepare, staged

#: Positive rows that the networks are fitted on, at most.
SAMPLE = 12_000
#: Bits of the cells' code, networks, folds of the prior's estimate, and bins of an output's histogram.
CODE_BITS, NETWORKS, PRIOR_FOLDS, BINS = 12, 3, 4, 4000
#: Weight of the squared parameters in the fit.
DECAY = 1e-2
FOLDS, HELD_OUT = 4, 2
N_FEATURES = 22
_SPACE = " \t\n\x0b\x0c\r"
_NO_LETTER = re.compile(r"[\W\d_]+")


def features(text: str) -> list[float]:
    """Shape of a text, in numbers that don't depend on its language."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * N_FEATURES
    lower = text.lower()
    counts = Counter(words)
    sizes = [len(w) for w in words]
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    signs = _NO_LETTER.sub("", text)  # letters, and the few signs that \w has besides
    letters = max(1, len(signs) - sum(signs.count(c) for c in set(signs) if not c.isalpha()))
    spread = [lower.count(c) / chars for c in "aeiourstn"]
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    return [
        math.log1p(n), math.log1p(chars), chars / n,
        sum(1 for w in words if w.isupper() and len(w) > 1) / n,
        sum(1 for w in words if w[0].isupper()) / n,
        sum(map(text.count, "#*$%&|<>")) / chars * 10, text.count("!") / n, text.count("|") / n, text.count(".") / n, text.count(",") / n,
        sum(map(text.count, "0123456789")) / chars * 10,
        len(counts) / n, len(counts) / math.sqrt(n), max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, pairs,
        1 - len(set(lines)) / max(1, len(lines)), len(lines) / n * 10,
        sum(1 for s in sizes if s <= 3) / n, sum(1 for s in sizes if s > 12) / n,
        letters / chars, -sum(p * math.log(p) for p in spread if p),
    ]


def feature_column(text: str | Column) -> Column:
    @F.pandas_udf("array<double>")
    def numbers(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t or "") for t in texts])

    return numbers(text)


class Network:
    """One hidden layer; the inputs are standardised."""

    def __init__(self, mean, scale, w1, b1, w2, b2):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def limit(self) -> float:
        """What no margin exceeds."""
        return float(np.abs(self.w2).sum() + np.abs(self.b2).sum())


class Model:
    """The mean margin of several networks, and a logistic curve on it."""

    def __init__(self, networks: list[Network], slope: float = 1.0, offset: float = 0.0):
        self.networks, self.slope, self.offset = networks, slope, offset

    def margin(self, x: np.ndarray) -> np.ndarray:
        return sum(n.margin(x) for n in self.networks) / len(self.networks)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -40, 40)))


#: Shares of positives above the cutoffs that the prior is looked for at.
GRID = np.arange(0.05, 1.0001, 0.01)


def estimate_prior(curves: list[np.ndarray], positives: int, unlabelled: int, default: float = 0.5) -> float:
    """The share of positives in unlabelled text.

    ``curves`` has for each fold the share of unlabelled rows above a cutoff in
    that of positives, for the cutoffs of GRID. No region can hold fewer
    unlabelled rows than its part of the positives among them, so that each
    ratio bounds the prior from above; the one with the lowest bound counting
    its sampling error is taken. ``default`` without folds.
    """
    if not curves:
        return default
    ratio = np.mean(curves, 0)
    error = 0.7 / math.sqrt(max(1, positives)) + 0.7 / math.sqrt(max(1, unlabelled))
    return float(min(1.0, ratio[np.argmin(ratio + error / GRID)]))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, hidden: int = 24, seed: int = 7, weights: np.ndarray | None = None) -> Network:
    """Minimise the non-negative PU risk with the sigmoid loss, by Adam on batches; unlabelled rows may have weights."""
    rng = np.random.default_rng(seed)
    share = np.full(len(unlabelled), 1 / len(unlabelled)) if weights is None else weights / weights.sum()
    mean = (positives.mean(0) + share @ unlabelled) / 2
    scale = np.sqrt((((positives - mean) ** 2).mean(0) + share @ (unlabelled - mean) ** 2) / 2) + 1e-6
    upto = np.cumsum(share)
    d = positives.shape[1]
    params = [rng.normal(0, 1 / math.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    pos, unl = (np.clip((x - mean) / scale, -8, 8) for x in (positives, unlabelled))
    for step in range(1, steps + 1):
        p, u = pos[rng.integers(0, len(pos), 512)], unl[np.minimum(np.searchsorted(upto, rng.random(1024)), len(unl) - 1)]
        x = np.concatenate([p, u])
        h = np.tanh(x @ params[0] + params[1])
        loss = 1 / (1 + np.exp(np.clip(h @ params[2] + params[3], -40, 40)))  # of the label +1; of -1: 1 - loss
        slope = -loss * (1 - loss)
        weight_p, weight_u = np.full(len(p), 1 / len(p)), np.full(len(u), 1 / len(u))
        negative = ((1 - loss[len(p) :]) * weight_u).sum() - prior * ((1 - loss[: len(p)]) * weight_p).sum()
        if negative >= 0:
            grad = np.concatenate([prior * slope[: len(p)] * weight_p * 2, -slope[len(p) :] * weight_u])
        else:  # the estimate of the risk on negatives is below zero: step back from it
            grad = np.concatenate([-prior * slope[: len(p)] * weight_p, slope[len(p) :] * weight_u])
        back = grad[:, None] * params[2] * (1 - h * h)
        for i, g in enumerate([x.T @ back, back.sum(0), h.T @ grad, grad.sum(keepdims=True)]):
            g = g + DECAY * params[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, *params)


def curve(positives: np.ndarray, margins: np.ndarray, counts: np.ndarray, prior: float, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins of positives and of unlabelled rows (with counts).

    Minimises E_unl[log(1 + exp(z))] - prior * E_pos[z], the log-loss without
    labels of negatives, by Newton's method; the ridge bounds the slope.
    """
    share = counts / counts.sum()
    middle = float(np.median(positives))
    spread = math.sqrt(max(1e-18, float(share @ (margins - share @ margins) ** 2)))
    p, u = (positives - middle) / spread, (margins - middle) / spread
    a, b = 1.0, 0.0
    for _ in range(200):
        q = 1 / (1 + np.exp(-np.clip(a * u + b, -40, 40)))
        w = share * (q * (1 - q) + 1e-12)
        g = np.array([share @ (q * u) - prior * p.mean() + ridge * a, share @ q - prior])
        hess = np.array([[w @ (u * u) + ridge, w @ u], [w @ u, w.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 1.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
    return max(a, 1e-3) / spread, b - max(a, 1e-3) * middle / spread


def _learns(doc_id: Column) -> Column:
    """Rows outside the held-out fold."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) != HELD_OUT, F.lit(True))


def _cells(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fold, mean features, rows) of the cells of all rows (x, fold): at most PRIOR_FOLDS * 2^CODE_BITS."""
    x = [F.col("x")[i] for i in range(N_FEATURES)]
    got = rows.agg(*[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    mean, scale = np.array(got[:N_FEATURES], float), np.array(got[N_FEATURES:], float) + 1e-6
    r = np.random.default_rng(0)
    planes, off = r.normal(size=(N_FEATURES, CODE_BITS)), r.normal(size=CODE_BITS)

    @F.pandas_udf("int")
    def code(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="int32")
        z = np.clip((np.stack(x.to_numpy()) - mean) / scale, -8, 8)
        return pd.Series((z @ planes + off > 0) @ (1 << np.arange(CODE_BITS)))

    cells = rows.withColumn("code", code("x")).groupBy("fold", "code").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)])
    table = cells.toPandas().sort_values(["fold", "code"])
    return table.fold.to_numpy(), table[[f"m{i}" for i in range(N_FEATURES)]].to_numpy(float), table.n.to_numpy(float)


def train(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on rows (doc_id, x) and labels (doc_id, quality) outside the held-out fold.

    At most ``sample`` positive rows are taken, in the order of a hash of
    doc_id; a doc_id that has another label too is none, and one with several
    rows counts once. All rows count as unlabelled. None if there is no positive label.
    """
    rows = rows.filter(_learns(F.col("doc_id"))).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(PRIOR_FOLDS)).cast("int"))
    known = labels.filter("doc_id is not null").filter(_learns(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("_q")).filter("_q = 1")
    known = known.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(sample).select(F.col("doc_id").alias("_id"))  # bounded: broadcast
    found = rows.join(F.broadcast(known), F.col("doc_id") == F.col("_id")).groupBy("_id").agg(F.min("x").alias("x"), F.first("fold").alias("fold"))
    got = found.toPandas().sort_values("_id")
    if not len(got):
        return None
    positives, theirs = np.stack(got.x.to_numpy()).astype(float), got.fold.to_numpy()
    fold, x, n = _cells(rows)
    networks, cuts = {}, {}
    for k in range(PRIOR_FOLDS):
        a, b = theirs != k, fold != k
        if a.any() and b.any() and not a.all() and not b.all():
            networks[k] = fit(positives[a], x[b], 0.5, steps=600, weights=n[b])
            cuts[k] = np.sort(networks[k].margin(positives[~a]))[::-1]
            cuts[k] = cuts[k][np.minimum(len(cuts[k]) - 1, np.ceil(GRID * len(cuts[k]) - 1e-9).astype(int) - 1)]

    @F.pandas_udf("int")
    def above(x: pd.Series, fold: pd.Series) -> pd.Series:
        out = np.full(len(x), -1)
        for k, network in networks.items():
            if (at := (fold == k).to_numpy()).any():
                out[at] = np.searchsorted(-cuts[k], -network.margin(np.stack(x[at].to_numpy())), side="left")
        return pd.Series(out)

    counted = rows.groupBy("fold", above("x", "fold").alias("at")).agg(F.count(F.lit(1)).alias("n")).collect() if networks else []
    curves = []
    for k in networks:
        table = np.zeros(len(GRID) + 1)
        for f, at, many in counted:
            if f == k:
                table[at] += many
        held = networks[k].margin(positives[theirs == k])
        share = np.array([(held >= c).mean() for c in cuts[k]])
        curves.append(np.cumsum(table)[:-1] / table.sum() / share)
    prior = estimate_prior(curves, len(positives), int(n.sum()))
    model = Model([fit(positives, x, prior, seed=7 + i, weights=n) for i in range(NETWORKS)])
    top = max(network.limit() for network in model.networks)

    @F.pandas_udf("int")
    def binned(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="int32")
        return pd.Series(np.clip((model.margin(np.stack(x.to_numpy())) + top) / (2 * top) * BINS, 0, BINS - 1).astype(int))

    table = rows.groupBy(binned("x").alias("at")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    margins = (table["at"].to_numpy() + 0.5) / BINS * 2 * top - top
    model.slope, model.offset = curve(model.margin(positives), margins, table["n"].to_numpy(float), prior)
    return model


def score_column(x: str | Column, model: Model | None) -> Column:
    """The score from a column of features."""

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        if model is None or not len(x):
            return pd.Series([0.5] * len(x), dtype="float64")
        return pd.Series(model.score(np.stack(x.to_numpy())))

    return scored(x)


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score each whole text: doc_id, held_out, score, predicted.

    Null texts count as empty; empty ones get a score like any other. Without
    a positive label every score is 0.5. Rows without id aren't held out.
    Repeated rows are scored each; labels of unknown ids are ignored; a text
    is read as a whole, however long; other columns are ignored.
    """
    prepare(documents.sparkSession)
    rows = only(documents, doc_id=id_col, text=text_col)
    rows = staged(rows.select("doc_id", feature_column("text").alias("x")), "features")
    model = train(rows, labels.select("doc_id", "quality"))
    scored = rows.select("doc_id", (~_learns(F.col("doc_id"))).alias("held_out"), score_column("x", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` whose score is at least ``threshold``, with their columns.

    Nulls, empty, long and repeated texts are taken as classify() takes them;
    each text is read once, as rows are staged with their features.
    """
    prepare(documents.sparkSession)
    name = fresh(documents, "_x")
    rows = staged(documents.withColumn(name, feature_column(F.col("text"))), "features")
    model = train(rows.select("doc_id", F.col(name).alias("x")), labels.select("doc_id", "quality"))
    return rows.filter(score_column(F.col(name), model) >= threshold).select(*[F.col(f"`{c}`") for c in documents.columns])
