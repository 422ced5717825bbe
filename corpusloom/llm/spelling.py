"""Spelling variants: words one edit apart, by a positional q-gram inverted index with a count filter.

Words are dealt to cells so that any two that are one edit apart meet in one:
an edit leaves the first or the second half of a word as it is, so a cell has
the words of a length, and of one more, that share the first half or the last.
A cell of too many words is dealt anew by halves of what its words don't
share yet, until it is small. So no pair is lost, no group grows without bound
and no pairs are made but within small cells.

In a cell each word asks an inverted index of pairs of letters with their
places. One edit changes few of a word's pairs, so that a near word is in at
least ``least`` of its lists, and in one of any few of them: the shortest lists
are merged with a heap, what they hold is counted in the others, and what
reaches the bound is verified. Only lists of a length and a place that one edit
allows are looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import discard, only, prepare, staged
from corpusloom.llm.components import run_groups, small_or_shuffled

#: Code points of a word and occurrences that it needs, how much more frequent its form is, and every how many hashes lose a letter.
LETTERS, OCCURRENCES, TIMES, DAMAGE = 5, 3, 2, 97
#: Words of a cell; distinct words that a task counts at a time; bytes of a text that are split at a time.
CELL, COUNTED, SEGMENT = 4096, 400_000, 1 << 20
#: Letters of a gram.
Q = 2

#: Latin-1 bytes to lower case of A-Z, and what is no letter to a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_NEAR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def runs(text: str) -> Iterator[list[bytes]]:
    """The runs of letters of a text, in lower case and Latin-1, a segment at a time."""
    start, size = 0, len(text)
    while start < size:
        piece = text[start : start + SEGMENT].encode("latin-1", "replace").translate(_TABLE)
        end = start + SEGMENT
        if end < size:
            cut = piece.rfind(b" ")
            while cut < 0 and end < size:  # a run that goes on beyond the segment
                piece += text[end : end + SEGMENT].encode("latin-1", "replace").translate(_TABLE)
                end += SEGMENT
                cut = piece.rfind(b" ")
            if end < size:
                piece = piece[: cut + 1]
                end = start + cut + 1
        yield piece.split()
        start = end


def counted(doc_id: int | None, text: str, damage: int = DAMAGE) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of a text, some words damaged as a hash of document and word says; a word may come more than once."""
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for some in runs(text):
        for run, n in Counter(some).items():
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            yield run, n


def vocabulary(documents: DataFrame, letters: int = LETTERS, least: int = OCCURRENCES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of enough letters and occurrences; tasks count first, so that few rows are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array([w.decode("latin-1") for w in held], pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for word, n in counted(doc_id, text.as_py() or ""):
                    if len(word) >= letters:
                        held[word] = held.get(word, 0) + n
                if len(held) >= COUNTED:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    partial = only(documents, doc_id=id_col, text=text_col).mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def grams(word: str) -> list[str]:
    """The pairs of letters of a word, its ends marked; a gram's place is its index."""
    marked = f"\x02{word}\x03"
    return [marked[i : i + Q] for i in range(len(word) + 1)]


def one_edit(a: str, b: str) -> bool:
    """Whether two different words, the second as long or one letter longer, are one edit apart."""
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or len(a) == len(b) and a[i + 1 :] == b[i + 1 :]


def _candidates(lists: list[tuple[list[int], ...]], least: int) -> Iterator[tuple[int, int]]:
    """(word, lists found in) of the words in one at least of the shortest lists: whatever is in ``least`` of all is among these."""
    shortest = sorted(lists, key=lambda x: sum(map(len, x)))[: len(lists) - least + 1]
    some = [postings for x in shortest for postings in x if postings]
    if len(some) == 1:
        return ((j, 1) for j in some[0])
    return ((j, sum(1 for _ in same)) for j, same in groupby(heapq.merge(*some)))


def near_pairs(words: list[str], length: int) -> Iterator[tuple[int, int]]:
    """Places of the words one edit apart, one of each pair of ``length`` letters and the other as long or one letter longer."""
    every = [grams(w) for w in words]
    same: list[dict[str, list[int]]] = [{} for _ in range(length + 1)]
    longer: list[dict[str, list[int]]] = [{} for _ in range(length + 2)]
    for j, g in enumerate(every):
        if len(words[j]) > length:
            for place, gram in zip(longer, g, strict=True):
                place.setdefault(gram, []).append(j)
    none: list[int] = []
    for i, g in enumerate(every):
        if len(words[i]) > length:
            continue
        least = length + 1 - Q  # pairs that words of this length share at the same place
        lists = [(place.get(gram, none),) for place, gram in zip(same, g, strict=True)]
        for j, _ in _candidates(lists, least):
            if sum(map(str.__eq__, g, every[j])) >= least and words[i] != words[j] and one_edit(words[i], words[j]):
                yield i, j
        least = length + 2 - Q  # that a word of one letter more shares at the same place or the next
        wide = [(longer[p].get(gram, none), longer[p + 1].get(gram, none)) for p, gram in enumerate(g)]
        for j, _ in _candidates(wide, least):
            h = every[j]
            if sum(gram == h[p] or gram == h[p + 1] for p, gram in enumerate(g)) >= least and one_edit(words[i], words[j]):
                yield i, j
        for place, gram in zip(same, g, strict=True):
            place.setdefault(gram, []).append(i)


def _cell(c: Column, head: Column, tail: Column) -> list[Column]:
    """A row's cell: lengths of the words and of the ends that they share, and these ends."""
    ends = F.concat(F.substring("word", F.lit(1), head), F.substring("word", F.length("word") - tail + 1, tail))
    return [c.alias("c"), head.alias("head"), tail.alias("tail"), ends.alias("ends")]


def cells(vocabulary: DataFrame, most: int = CELL) -> DataFrame:
    """(c, head, tail, ends, word, n): words of c letters and one more by the first ``head`` and last ``tail`` letters that they share.

    Two words one edit apart share a cell. Cells of more than ``most`` words
    are halved: an edit within what isn't shared yet leaves the first or the
    second half of that.
    """
    size = F.length("word")
    rows = vocabulary.select("word", "n", F.explode(F.filter(F.array(size - 1, size), lambda c: c >= LETTERS)).alias("c"))
    rows = rows.select("word", "n", "c", F.explode(F.array(F.floor(F.col("c") / 2).cast("int"), F.lit(-1))).alias("_h"))
    half = F.floor(F.col("c") / 2).cast("int")
    head, tail = F.when(F.col("_h") >= 0, half).otherwise(0), F.when(F.col("_h") >= 0, 0).otherwise(F.col("c") - half)
    rows = staged(rows.select(*_cell(F.col("c"), head, tail), "word", "n"), "cells")
    key, done = ["c", "head", "tail", "ends"], None
    for _ in range(32):  # what isn't shared is halved each time
        free = F.col("c") - F.col("head") - F.col("tail")
        large = staged(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_m")).filter((F.col("_m") > most) & (free > 1)).select(*key), "large")
        if large.isEmpty():
            break
        large = small_or_shuffled(large)
        small = rows.join(large, key, "left_anti")
        done = small if done is None else done.unionByName(small)
        first = F.floor((F.col("c") - F.col("head") - F.col("tail")) / 2).cast("int")
        split = rows.join(large, key, "left_semi").withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
        rest = F.col("c") - F.col("head") - F.col("tail") - first
        head = F.col("head") + F.when(F.col("_side") == 0, first).otherwise(0)
        tail = F.col("tail") + F.when(F.col("_side") == 1, rest).otherwise(0)
        rows = staged(split.select(*_cell(F.col("c"), head, tail), "word", "n"), "cells")
    return rows if done is None else done.unionByName(rows)


def near_words(vocabulary: DataFrame, most: int = CELL) -> DataFrame:
    """(word, near, near_n): each word with each of its near words, once."""

    def work(group: dict[str, list]) -> list[tuple]:
        words, ns = group["word"], group["n"]
        if len(words) < 2:
            return []
        out = []
        for i, j in near_pairs(words, group["c"][0]):
            out += [(words[i], words[j], ns[j]), (words[j], words[i], ns[i])]
        return out

    return run_groups(cells(vocabulary, most), ["c", "head", "tail", "ends"], work, _NEAR).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word with a form: the last form reached. Each round doubles the steps; forms are more frequent, so there are no circles."""
    spark = forms.sparkSession
    known = staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(64):
        ahead = known.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        after = staged(known.join(small_or_shuffled(ahead), F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")), "roots")
        moved = not after.filter("_moved").isEmpty()
        discard(spark, known._staged_path)
        known = after.select("word", "root")
        known._staged_path = after._staged_path
        if not moved:
            return known
    raise RuntimeError("the roots did not settle")


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = CELL) -> DataFrame:
    """Words with the more frequent form that they are a variant of: word, form, root, n, n_near, form_n.

    A row for each word of at least five letters and three occurrences in all
    texts. Null texts have none, and so have empty ones and an empty table; a null id counts as no characters in the hash;
    rows with equal ids are texts of their own; a text is read as a whole, a
    segment at a time; of near words of the same number of occurrences the
    first in code-point order is the form. Other columns are ignored.
    """
    prepare(documents.sparkSession)
    words = staged(vocabulary(documents, id_col=id_col, text_col=text_col), "words")
    near = near_words(words, most)
    first = F.min_by("near", F.struct(-F.col("near_n"), F.col("near")))
    found = near.groupBy(F.col("word").alias("_w")).agg(F.count(F.lit(1)).alias("n_near"), first.alias("_form"), F.max("near_n").alias("_n"))
    whole = words.join(found, F.col("word") == F.col("_w"), "left")
    is_form = F.col("_n") >= TIMES * F.col("n")
    whole = staged(whole.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("_form")).alias("form"), F.when(is_form, F.col("_n")).alias("form_n")), "variants")
    last = roots(whole.filter("form is not null")).select(F.col("word").alias("_w"), F.col("root").alias("_root"))
    out = whole.join(last, F.col("word") == F.col("_w"), "left")
    return out.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
