"""Secrets in texts: patterns propose candidates, a random forest removes the false ones.

All work on texts is done with DataFrame functions. The forest is trained on
the driver from labelled findings, a bounded table, and becomes one expression.
Where none are given, findings are planted in passages of the documents
themselves: tokens of many makes, true and false ones, whose places and labels
are known from the planting and not from the patterns here, so that what the
patterns miss counts against them. A part is held out to measure on. Words that
many documents have make up the dictionary.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import spans
from corpusloom.llm.common import fresh

#: What secrets are called in four languages, and what stands between a name and its secret.
NAMES = (
    r"p(?:ass(?:[_-]?(?:word|phrase)|wd|wort)|wd)|secreto?|token|a(?:(?:pi|ccess)[_\x20-]?key|uth[_-]?key)|bearer|m(?:ot\x20de\x20passe|dp)|jeton|kennwort|geheimnis|zugangsschl[uüÜ]ssel|"
    r"c(?:lient[_-]?secret|redentials?|l(?:ave|[eéÉ]\x20(?:secr[eèÈ]te|api))|ontrase[nñÑ]a)"
)
BETWEEN = r"[\"']?(?:\x20?[:=]\x20?|\x20(?:is|est|ist|lautet|es)\x20|(?<=(?i:bearer))\x20)[\"']?"
#: Kinds of candidates: by the name in front, as a key block, in a URL, by their form, or any long token of mixed characters.
NAMED = rf"(?i:(?:{NAMES}){BETWEEN})"
BLOCK = r"-----BEGIN\x20[A-Z\x20]{0,24}PRIVATE\x20KEY-----[A-Za-z0-9+/=\s]++-----END\x20[A-Z\x20]{0,24}PRIVATE\x20KEY-----"
LONG = r"(?:\G|(?<![A-Za-z0-9+/_=-]))(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}+"
LOGIN = r":(?<=[A-Za-z0-9]:)//[^\s:/@\"'<>]{1,64}:"
PATTERN = rf"({NAMED})([A-Za-z0-9+/_=.@!$%^&*~-]{{8,}}+)|({LOGIN})([^\s:/@\"'<>]{{4,128}}+)(?=@)|({BLOCK})|({LONG})"
REPLACEMENT = f"$1$3{spans.OPEN}$2$4$5$6{spans.CLOSE}"

#: Placeholders and parts of addresses; what they cover of a candidate makes it less of a secret.
WORDS = (
    "password changeme example sample placeholder dummy secret token test your here user admin default value passwort contrasena motdepasse "
    "index image images file files static assets docs page pages html content article download github http https www com org net"
).split()

KEYWORD = rf"(?i)(?:{NAMES}|auth|aws|private)[^\n]{{0,24}}$"
BENIGN = r"(?i)(?:commit|sha1|sha256|md5|checksum|hash|digest|revision|uuid|guid|etag|integrity|isbn|serial|version|file|page)[^\n]{0,16}$"
KNOWN = r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-|^AIza[0-9A-Za-z_-]{35}$|^sk_live_|^eyJ[A-Za-z0-9_-]{10}|^-----BEGIN"
FEATURES = ("length", "transitions", "digits", "upper", "distinct", "covered", "words", "path", "keyword", "benign", "known", "hexadecimal", "named", "login", "signs")
#: Words of the dictionary and documents that each has to be in; passages that findings are planted in, their length, findings of each make, and every which is held out.
DICTIONARY, SEEN, PASSAGES, PASSAGE_CHARS, PLANTED, HELD = 2000, 5, 400, 400, 40, 4


def dictionary(documents: DataFrame, text_col: str = "text") -> list[str]:
    """The words of four letters and more that most documents have, counted over all texts; of equally frequent ones the first."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{text_col}`")), F.lit(r"[a-zà-öø-ÿ]{4,}+"), F.lit(0)))
    counted = documents.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SEEN)
    salted = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(16))).orderBy(F.desc("n"), "word")  # the most frequent of each sixteenth, so that few rows come to the driver
    most = counted.filter(F.length("word") <= 30).withColumn("_place", F.row_number().over(salted)).filter(F.col("_place") <= DICTIONARY)
    return [r.word for r in most.orderBy(F.desc("n"), "word").limit(DICTIONARY).collect()]


def feature_columns(match: Column, left: Column, right: Column, known: list[str]) -> list[Column]:
    """Numbers about a candidate, its place in a path and the words before it, in the order of FEATURES."""
    n = F.length(match).cast("double")
    kinds = F.translate(match, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "a" * 26 + "B" * 26 + "0" * 10)
    runs = F.regexp_replace(kinds, r"(.)\1*+", "$1")
    m = F.length(kinds).cast("double")
    flag = lambda c: c.cast("double")
    covered = m - F.length(F.regexp_replace(F.lower(match), "|".join(sorted(WORDS, key=len, reverse=True)), ""))
    letters = F.regexp_extract_all(F.lower(match), F.lit(r"[a-zà-öø-ÿ]{4,}+"), F.lit(0))
    words = F.aggregate(F.filter(letters, lambda w: w.isin(known)) if known else F.slice(letters, 1, 0), F.lit(0), lambda total, w: total + F.length(w))
    return [
        F.least(n, F.lit(100.0)),
        F.length(runs) / m,
        F.length(F.regexp_replace(kinds, "[^0]", "")) / m,
        F.length(F.regexp_replace(kinds, "[^B]", "")) / m,
        F.size(F.array_distinct(F.split(match, ""))).cast("double"),
        covered / m,
        words / m,
        flag(left.rlike(r"(?:https?://|www\.|/|\\)[^\s]*$") | right.rlike(r"^[/\\?]|^\.[A-Za-z]{2,4}\b") | match.rlike(r"[A-Za-z]/[A-Za-z][^/]*/")),
        flag(left.rlike(KEYWORD)), flag(left.rlike(BENIGN)), flag(match.rlike(KNOWN)),
        flag(match.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$")), flag(left.rlike(NAMED + "$")), flag(left.rlike(LOGIN + "$") & right.rlike("^@")),
        F.length(F.regexp_replace(kinds, "[aB0]", "")) / m,
    ]


def candidates(rows: DataFrame, text: Column, name: str, known: list[str]) -> DataFrame:
    """``rows`` with ``name``, array<struct<start, end, f>>: the candidates of a text and their features."""
    pieces = fresh(rows, "_pieces")
    plain = fresh(rows, "_text")
    rows = rows.withColumn(plain, spans.plain(text))
    rows = spans.places(rows.withColumn(name, spans.marked(F.col(plain), PATTERN, REPLACEMENT)), [name])
    rows = rows.withColumn(pieces, F.when(F.size(name) > 0, spans.segments(F.col(plain)))).drop(plain)

    def one(x: Column) -> Column:
        start = F.greatest(x["start"] - 80, F.lit(0))
        left = spans.piece(F.col(pieces), start, x["start"] - start)
        right = spans.piece(F.col(pieces), x["end"], F.lit(8))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.array(*feature_columns(x["match"], left, right, known)).alias("f"))

    return rows.withColumn(name, F.transform(name, one)).drop(pieces)


def passages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Beginnings of some documents, by a hash of id and beginning, for findings to stand in; a bounded sample, of which few rows more are looked at."""
    begin = F.substring(f"`{text_col}`", 1, PASSAGE_CHARS)
    rows = documents.select(begin.alias("t"), F.xxhash64(F.col(f"`{id_col}`"), begin, F.lit(7)).alias("h")).filter("t <> ''")
    share = min(1.0, 4 * PASSAGES / max(1, documents.count()))
    some = rows.filter(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    return [r.t for r in some.orderBy("h", "t").limit(PASSAGES).collect()]


#: Names that planted findings have, apart from those that the patterns know, and what comes after them.
_CALLED = ("password", "Password", "passwd", "mot de passe", "mdp", "Passwort", "Kennwort", "contraseña", "Contraseña", "clave", "secret", "token", "api_key", "API key", "access_key", "client_secret", "clé secrète", "pin code", "login key")
_SAYS = ("=", ": ", " = ", ":", '="', " is ", " est ", " ist ", " es ")
_BEFORE_HASH = ("commit ", "sha1 ", "checksum: ", "md5 ", "revision ", "integrity hash ", "etag ")


def planted(texts: list[str], seed: int = 5, count: int = PLANTED) -> list[tuple[int, str, int, int, str, int]]:
    """Labelled findings (number, text, start, end, make, 1 for a secret), ``count`` of each make, each in a passage of a document."""
    rng = random.Random(seed)
    lower, digits, signs = "abcdefghijklmnopqrstuvwxyz", "0123456789", "!$%&*_-"
    every, hexa = lower + lower.upper() + digits, digits + "abcdef"
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    natural = [w for t in texts for w in t.split() if w.isalpha() and len(w) >= 4] or [pick(lower, n) for n in range(4, 14) for _ in range(9)]
    plain = lambda n: "".join(rng.choice(natural) for _ in range(9))[:n].lower()
    word = lambda: rng.choice(natural).lower()
    name = lambda: rng.choice(_CALLED) + rng.choice(_SAYS)
    human = lambda: (rng.choice(natural).capitalize()[:7].replace("o", "0").replace("e", "3") + pick(digits, rng.randint(1, 4)) + pick(signs, 1) + pick(every, rng.randint(2, 6)))
    makes = {
        "cloud key": lambda: ("", "AKIA" + pick(lower.upper() + digits, 16), "", 1), "code host": lambda: ("", "ghp_" + pick(every, 36), "", 1), "named hex": lambda: (name(), pick(hexa, rng.choice([16, 18, 20, 32, 40, 64])), "", 1),
        "named": lambda: (name(), pick(every + "+/_-", rng.randint(10, 48)), "", 1), "human": lambda: (name(), human(), "", 1), "login": lambda: (f"{rng.choice(['mongodb', 'postgres', 'https', 'amqp'])}://{word()}:", rng.choice([human(), pick(every, rng.randint(8, 24))]), "@db.host/x", 1),
        "aws": lambda: (rng.choice(["aws secret ", "aws ", "private key: "]), pick(every + "+/", 40), "", 1), "web token": lambda: ("", "eyJ" + pick(every, 30) + "." + pick(every, 40), "", 1),
        "hash": lambda: (rng.choice(_BEFORE_HASH), pick(hexa, rng.choice([32, 40, 64])), "", 0), "uuid": lambda: (rng.choice(["uuid ", "guid: ", "", "id="]), "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)), "", 0),
        "address": lambda: (rng.choice(["https://www.example.org/", "src/main/", "see /usr/share/"]), "-".join([word(), word(), word()]) + "-" + pick(digits, 2), rng.choice(["/", ".html", ""]), 0),
        "slug": lambda: ("", rng.choice("-_").join(word() for _ in range(rng.randint(3, 5))) + pick(digits, rng.randint(1, 4)), "", 0), "glued words": lambda: ("", plain(rng.randint(16, 40)) + pick(digits, rng.randint(1, 3)), "", 0),
        "placeholder": lambda: (name(), rng.choice(["changeme", "example-", "your-", "test", "placeholder", "<your-", "dummy"]) + rng.choice(["password", "token-here", "secret123", "value1234"]), "", 0),
        "prose": lambda: (name(), max((word() for _ in range(6)), key=len) + rng.choice(["", ".", word()]), "", 0), "number": lambda: ("", pick(digits, 12) + rng.choice("-_") + pick(lower, rng.randint(4, 10)), "", 0),
        "login words": lambda: (f"https://{word()}:", rng.choice(["password", "changeme", "secret"]), "@host.org", 0), "file": lambda: (rng.choice(["file ", "image ", ""]), f"{word()}_{pick(digits, 8)}_{word()}-v{pick(digits, 2)}", rng.choice([".pdf", ".png", ""]), 0),
    }
    out = []
    for k in range(count):
        for make, write in makes.items():
            before, token, after, label = write()
            around = rng.choice(texts) if texts else ""
            cut = around.rfind(" ", 0, rng.randint(0, len(around))) + 1 if around else 0
            begin = around[:cut] + before
            out.append((len(out), f"{begin}{token}{after} {around[cut:]}", len(begin), len(begin) + len(token), make, label))
    return out


@dataclass
class Findings:
    """Candidates of planted findings with their labels, and those held out; ``missed`` secrets are no candidates at all."""

    x: np.ndarray
    y: np.ndarray
    held_x: np.ndarray
    held_y: np.ndarray
    missed: int


def findings(spark: SparkSession, texts: list[str], known: list[str], seed: int = 5, count: int = PLANTED) -> Findings:
    """The features of what is found at the places of planted findings: a candidate counts if it has half of the token and little else."""
    table = spark.createDataFrame(planted(texts, seed, count), "number long, text string, start int, end int, make string, label int")
    rows = candidates(table, F.col("text"), "found", known)
    both = lambda x: F.greatest(F.least(x["end"], F.col("end")) - F.greatest(x["start"], F.col("start")), F.lit(0))
    here = F.filter("found", lambda x: (both(x) * 2 >= F.col("end") - F.col("start")) & (x["end"] - x["start"] <= 2 * (F.col("end") - F.col("start"))))
    got = rows.select("number", "label", F.get(here, F.lit(0))["f"].alias("f")).orderBy("number").collect()
    width = len(FEATURES)
    part = lambda held: [r for r in got if r.f is not None and (r.number // 18 % HELD == 0) == held]
    array = lambda rows: np.array([r.f for r in rows], float).reshape(len(rows), width)
    learned, held = part(False), part(True)
    missed = sum(r.f is None and r.label == 1 and r.number // 18 % HELD == 0 for r in got)
    label = lambda rows: np.array([r.label for r in rows], float)
    return Findings(array(learned), label(learned), array(held), label(held), missed)


class Forest:
    """Classification trees on bootstrap samples, each split on a few features taken at random."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 20, depth: int = 5, seed: int = 3):
        self.rng, self.depth = np.random.default_rng(seed), depth
        self.tries = max(2, int(round(x.shape[1] ** 0.5)) + 1)
        self.trees = []
        for _ in range(trees):
            rows = self.rng.integers(0, len(y), len(y))
            self.trees.append(self._grow(x[rows], y[rows], 0))

    def _grow(self, x, y, level):
        share = float(y.mean())
        if level == self.depth or len(y) < 8 or share in (0.0, 1.0):
            return round(share, 4)
        best = (share * (1 - share) - 1e-6, None, None)
        for j in self.rng.choice(x.shape[1], self.tries, replace=False):
            values = np.unique(x[:, j])
            for cut in np.unique(np.quantile(values, np.linspace(0, 1, 18)[1:-1])) if len(values) > 2 else values[1:]:
                low = x[:, j] < cut
                k = low.sum()
                if 0 < k < len(y):
                    p, q = y[low].mean(), y[~low].mean()
                    gini = (k * p * (1 - p) + (len(y) - k) * q * (1 - q)) / len(y)
                    if gini < best[0]:
                        best = (gini, j, float(cut))
        if best[1] is None:
            return round(share, 4)
        low = x[:, best[1]] < best[2]
        return int(best[1]), best[2], self._grow(x[low], y[low], level + 1), self._grow(x[~low], y[~low], level + 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        def walk(tree, row):
            while isinstance(tree, tuple):
                tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
            return tree

        return np.array([sum(walk(t, row) for t in self.trees) / len(self.trees) for row in x])

    def column(self, f: Column) -> Column:
        """The score from an array of features."""

        def branch(tree) -> Column:
            return F.when(f[tree[0]] < tree[1], branch(tree[2])).otherwise(branch(tree[3])) if isinstance(tree, tuple) else F.lit(tree)

        total = branch(self.trees[0])
        for tree in self.trees[1:]:
            total = total + branch(tree)
        return total / len(self.trees)


@dataclass
class Scanner:
    """A forest and the dictionary that its features need."""

    forest: Forest
    known: list[str]


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: Findings | None = None) -> Scanner:
    """The forest from labelled findings, by default planted in passages of ``documents``, with the dictionary of all their texts."""
    known = dictionary(documents, text_col)
    if labelled is None:
        labelled = findings(documents.sparkSession, passages(documents, id_col, text_col), known)
    return Scanner(Forest(labelled.x, labelled.y), known)


def measured(documents: DataFrame, threshold: float = 0.5, seeds: tuple[int, ...] = (5,), id_col: str = "doc_id", text_col: str = "text") -> dict[str, float]:
    """Precision and recall on the held-out part of planted findings; secrets that no pattern proposes count as missed."""
    known, texts = dictionary(documents, text_col), passages(documents, id_col, text_col)
    right = wrong = lost = 0
    for seed in seeds:
        f = findings(documents.sparkSession, texts, known, seed)
        said = Forest(f.x, f.y).score(f.held_x) >= threshold
        right, wrong, lost = right + int((said & (f.held_y == 1)).sum()), wrong + int((said & (f.held_y == 0)).sum()), lost + f.missed + int((~said & (f.held_y == 1)).sum())
    return {"precision": right / max(1, right + wrong), "recall": right / max(1, right + lost), "secrets": right + lost}


def _judged(documents: DataFrame, text: Column, scanner: Scanner, name: str) -> DataFrame:
    """``documents`` with ``name``, the candidates of a text with their scores."""
    rows = candidates(documents, text, name, scanner.known)
    return rows.withColumn(name, F.transform(name, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), scanner.forest.column(x["f"]).alias("score"))))


def scan(documents: DataFrame, scanner: Scanner | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in each whole text: doc_id, n_candidates, n_secrets, spans.

    ``spans`` has start:end of each secret by start, comma-joined, in code
    points, end exclusive. Null texts count as empty and have none; very long
    texts are walked in runs and segments of bounded length; repeated rows and
    null ids give a row each; an empty table gives no rows, and where there are
    no texts the findings are planted in none; other columns are ignored.
    """
    scanner = scanner or train(documents, id_col, text_col)
    rows = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = _judged(rows, F.col("text"), scanner, "found").select("doc_id", "found")
    secrets = F.filter("found", lambda x: x["score"] >= threshold)
    listed = F.array_join(F.transform(secrets, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return rows.select("doc_id", F.size("found").cast("long").alias("n_candidates"), F.size(secrets).cast("long").alias("n_secrets"), listed.alias("spans"))


def redacted(documents: DataFrame, scanner: Scanner | None = None, threshold: float = 0.5, mask: str = "[SECRET]", id_col: str = "doc_id") -> DataFrame:
    """``documents`` with each secret in ``text`` replaced by ``mask`` and n_chars set anew; other texts stay as they are.

    Null and empty texts stay; every row stays, repeated ones and those with a
    null id as well; a very long text is put together from its segments; an
    empty table stays empty; all columns stay, whatever they are called.
    """
    scanner = scanner or train(documents, id_col)
    names = documents.columns
    found, pieces = fresh(documents, "_found"), fresh(documents, "_pieces")
    rows = _judged(documents, F.col("text"), scanner, found)
    rows = rows.withColumn(found, F.filter(found, lambda x: x["score"] >= threshold)).withColumn(pieces, F.when(F.size(found) > 0, spans.segments(F.col("text"))))
    before = lambda i: F.when(i == 0, 0).otherwise(F.get(found, i - 1)["end"])
    kept = F.transform(found, lambda x, i: F.concat(spans.piece(F.col(pieces), before(i), x["start"] - before(i)), F.lit(mask)))
    last = before(F.size(found))
    new = F.concat(F.array_join(kept, ""), spans.piece(F.col(pieces), last, F.length("text") - last))
    rows = rows.withColumn("text", F.when(F.size(found) > 0, new).otherwise(F.col("text")))
    if "n_chars" in names:
        kind = documents.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.size(found) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*names)
