"""An inverted index of immutable segments.

Texts are added and removed by further segments, and none is changed: a
segment has the postings of the texts that it adds and the keys of all that it
speaks of, those that it only removes included. For each key the newest segment
that speaks of it counts, so that a text may be replaced, removed and added
again. Merging makes one segment of several, with one posting for each token
and key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import full_text

#: Segments beyond which adding merges.
MOST = 8


def segment(number: int, rows: DataFrame | None, removed: DataFrame | None, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(postings, keys) of a segment: the index of ``rows``, and the keys that it adds or removes; a key that is removed and added is added."""
    spark = (rows if rows is not None else removed).sparkSession
    at = F.lit(number).cast("long").alias("segment")
    if rows is None:
        kind = removed.schema[key].dataType
        postings = spark.createDataFrame([], f"token string, `{key}` {kind.simpleString()}, n long, first long, segment long")
        keys = removed.select(key).distinct().select(key, at, F.lit(False).alias("present"))
        return postings, keys
    postings = full_text.index(rows, key, text).select("token", key, "n", "first", at)
    keys = rows.select(key, F.lit(True).alias("present"))
    if removed is not None:
        keys = keys.unionByName(removed.select(key, F.lit(False).alias("present")))
    return postings, keys.groupBy(key).agg(F.max("present").alias("present")).select(key, at, "present")


def current(postings: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(token, key, n, first, segment) of the postings that count: those of the newest segment that speaks of their key."""
    newest = keys.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct("segment", "present"), "segment").alias("_s"))
    live = newest.filter("_s.present").select("_k", F.col("_s.segment").alias("_n"))
    return postings.join(live, (F.col(key) == F.col("_k")) & (F.col("segment") == F.col("_n"))).select("token", key, "n", "first", "segment")


class Index:
    """An index kept by a commit log: relations postings and keys, a data folder for each segment."""

    def __init__(self, log, key: str, text: str, most: int = MOST):
        self.log, self.key, self.text, self.most = log, key, text, most

    def change(self, added: DataFrame | None = None, removed: DataFrame | None = None):
        """Add texts, which replace those of the same key, and remove others (by key), in one version."""
        if added is None and removed is None:
            raise ValueError("nothing to add or to remove")

        def make(state):
            number = state.high.get("segment", 0) + 1
            postings, keys = segment(number, added, removed, self.key, self.text)
            state = self._with(state, postings, keys, number, f"segment {number}")
            return self.merged(state) if len(state.folders["keys"]) > self.most else state

        return self.log.commit(make)

    def _with(self, state, postings: DataFrame, keys: DataFrame, number: int, note: str, alone: bool = False):
        from corpusloom.sinks import commits

        folders, schemas = dict(state.folders), dict(state.schemas)
        for name, rows in (("postings", postings), ("keys", keys)):
            folders[name] = [*([] if alone else folders.get(name, [])), self.log.stage(rows.repartition("token") if name == "postings" and alone else rows, name)]
            schemas[name] = commits._nullable(rows.schema)
        return commits.State(0, folders, schemas, state.high | {"segment": number}, note)

    def merged(self, state):
        """The state with all segments in one; keys that are only removed are forgotten."""
        number = state.high["segment"] + 1
        keys = self.log.read("keys", state)
        at = F.lit(number).cast("long").alias("segment")
        left = keys.groupBy(self.key).agg(F.max_by("present", "segment").alias("present")).filter("present").select(self.key, at, "present")
        live = current(self.log.read("postings", state), keys, self.key).drop("segment").select("token", self.key, "n", "first", at)
        return self._with(state, live, left, number, "merge", alone=True)

    def merge(self):
        return self.log.commit(self.merged)

    def postings(self, state=None) -> DataFrame:
        """(token, key, n, first) as of a state."""
        state = self.log.state() if state is None else state
        return current(self.log.read("postings", state), self.log.read("keys", state), self.key).drop("segment")

    def containing_all(self, words: list[str], state=None) -> DataFrame:
        """Keys of texts that have every word; only the postings of these words are read."""
        state = self.log.state() if state is None else state
        wanted = self.log.read("postings", state).filter(F.col("token").isin(full_text.folded(words)))
        return full_text.containing_all(current(wanted, self.log.read("keys", state), self.key), self.key, words)
