"""Byte-pair encoding and decoding as bounded-lookahead streaming transducers.

The encoder reads a text in segments, splits them into pretokens and feeds the
symbols of each to a transducer. No merge reaches over a token's end, so the
tokens of a text up to such an end are the tokens of that part alone: for each
place read so far the transducer keeps the last token of what lies before it.
What follows can only go on from places from which a token could reach beyond
the symbols read, and those are no farther back than a token is long. Tokens on
which all these places agree are stable and are emitted. A merge list has a
sufficient lookahead, a number of symbols that always suffices to make tokens
stable, so that the memory does not grow with the pretoken; in words a few do.

The decoder is a state machine that takes ids one at a time and emits text as
soon as it is complete.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.caches import TwoGenerations
from corpusloom.llm.common import only, prepare, tokenizer_path

#: White space as the tokenizers' patterns take \s, and their two split patterns.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
WORD_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"
BYTE_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"

#: Code points of a text that are split and encoded at a time, and words in the cache.
SEGMENT, CACHED_WORDS = 1 << 16, 400_000
#: Symbols of a pretoken that are read before stable tokens are looked for, and pairs of tokens that are remembered.
WINDOW, CACHED_PAIRS = 12, 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable in Latin-1, else the next from 256 on."""
    plain = {b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class MergeList:
    """Ranks of the pairs to merge, ids of the symbols, and the sufficient lookahead."""

    def __init__(self, merges: list[tuple[str, str]], vocab: dict[str, int], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.ranks = {pair: rank for rank, pair in reversed(list(enumerate(merges)))}
        self.lookahead = self._lookahead(merges)
        self.tokens = {left + right for left, right in merges}
        units = [self._units(t) for t in self.tokens]
        self.longest = max(map(len, units), default=1)
        self.starts = {u[:i] for u in units for i in range(1, len(u))}
        self.pairs: dict[tuple[str | None, str], bool] = {}

    def _units(self, token: str) -> str:
        """The token with one character for each base symbol, the suffixed last one included."""
        if self.suffix and token.endswith(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(0xF0000 + ord(token[-1])) if token else ""
        return token

    def _lookahead(self, merges: list[tuple[str, str]]) -> int:
        """The farthest that what follows can reach back, in base symbols.

        A merge can only be undone by one of a lower rank that overlaps it on
        the right, which can only be undone by one of a still lower rank, and
        so on. Going through the merges by rank, ``reach`` has for each prefix
        of the merged strings seen so far how far such a chain goes to the
        right from its start; a merge continues the longest chain that starts
        inside it.
        """
        reach: dict[str, int] = {}
        longest = 1
        for left, right in merges:
            text = self._units(left) + self._units(right)
            far = max([len(text), *(i + reach[text[i:]] for i in range(1, len(text)) if text[i:] in reach)])
            for i in range(1, len(text) + 1):
                if reach.get(text[:i], 0) < far:
                    reach[text[:i]] = far
            longest = max(longest, far)
        return longest

    def symbols(self, token: str) -> list[str]:
        """The base symbols of a token."""
        if self.suffix and token.endswith(self.suffix):
            token = token[: -len(self.suffix)]
            return [*token[:-1], token[-1] + self.suffix]
        return list(token)

    def follows(self, before: str | None, token: str) -> bool:
        """Whether ``token`` stays a token after ``before``, or at the beginning."""
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            both = [token] if before is None else [before, token]
            known = self.pairs[before, token] = self.merge([s for t in both for s in self.symbols(t)]) == both
        return known

    def merge(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, lowest rank first and leftmost first within a rank."""
        if len(symbols) < 2:
            return symbols
        return self._merge_short(symbols) if len(symbols) <= 48 else self._merge_long(symbols)

    def _merge_short(self, symbols: list[str]) -> list[str]:
        get, none = self.ranks.get, 1 << 60
        pairs = [get(p, none) for p in zip(symbols, symbols[1:])]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((symbols[i - 1], symbols[i]), none)
            if i < len(pairs):
                pairs[i] = get((symbols[i], symbols[i + 1]), none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        parts: list[str | None] = list(symbols)
        get = self.ranks.get
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue  # one of the two was merged with another symbol meanwhile
            parts[i], parts[j] = left + right, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return [p for p in parts if p is not None]


class Transducer:
    """Takes the symbols of one pretoken in any pieces and emits its tokens once they are stable.

    From ``window`` symbols on it looks for stable tokens; it holds no more
    than those, a token's length and what the sufficient lookahead asks for.
    """

    def __init__(self, merges: MergeList, window: int = WINDOW):
        self.merges, self.window = merges, max(2, window)
        self.most = self.window + merges.longest + merges.lookahead  # symbols that may be held
        self._begin()

    def _begin(self) -> None:
        self.held, self.start, self.before, self.waiting, self.look = "", [0], None, None, self.window
        self.open: list[int] = []  # places from which a token may go on

    def _last(self, place: int) -> str | None:
        """The last token of what lies before a place."""
        return self.held[self.start[place] : place] if place else self.before

    def _take(self, symbol: str) -> None:
        self.held += symbol
        end, held, merges = len(self.start), self.held, self.merges
        found, going = None, []
        for place in (*self.open, end - 1):
            token = held[place:]
            if found is None and (place == end - 1 or token in merges.tokens) and merges.follows(self._last(place), token):
                found = place
            if token in merges.starts:
                going.append(place)
        if found is None:
            raise ValueError("not a symbol of this merge list")
        self.start.append(found)
        self.open = going

    def _tokens(self, end: int) -> list[str]:
        out = []
        while end:
            out.append(self.held[self.start[end] : end])
            end = self.start[end]
        return out[::-1]

    def _stable(self) -> list[str]:
        open_places = {len(self.held), *self.open}
        while len(open_places) > 1:  # back to where all agree
            last = max(open_places)
            open_places.remove(last)
            open_places.add(self.start[last])
        (agreed,) = open_places
        out = self._tokens(agreed)
        if out:
            self.before, self.held = out[-1], self.held[agreed:]
            self.start = [0, *[max(0, s - agreed) for s in self.start[agreed + 1 :]]]
            self.open = [p - agreed for p in self.open]
        if len(self.held) > self.most:
            raise RuntimeError("the lookahead of the merge list isn't sufficient")
        return out

    def push(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens that are stable after ``symbols``."""
        for symbol in symbols:
            if self.waiting is not None:  # the last symbol may get the suffix
                self._take(self.waiting)
                if len(self.held) >= self.look:
                    yield from self._stable()
                    self.look = len(self.held) + self.window // 2
            self.waiting = symbol

    def finish(self) -> list[str]:
        """The remaining tokens at the end of the pretoken."""
        if self.waiting is None:
            return []
        self._take(self.waiting + self.merges.suffix)
        end, out = len(self.start) - 1, []
        while end:
            begin = self.start[end]
            out.append(self.held[begin:] if end == len(self.start) - 1 else self.held[begin:end])
            end = begin
        self._begin()
        return out[::-1]


class Decoder:
    """Takes ids one at a time and emits text as soon as it is complete.

    Tokenizers without a byte-level decoder give their tokens joined by one
    space. With one, the bytes of the tokens go through an incremental UTF-8
    machine: an unfinished sequence is held back until the next id completes
    or breaks it; broken ones become U+FFFD.
    """

    def __init__(self, pieces: list[bytes], spaced: bool):
        import codecs

        self.pieces, self.spaced, self.first = pieces, spaced, True
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        pieces = self.pieces
        if self.spaced:
            data = b" ".join([pieces[i] for i in ids])
            if data and not self.first:
                data = b" " + data
            self.first = self.first and not data
        else:
            data = b"".join([pieces[i] for i in ids])
        return self.machine.decode(data)

    def finish(self) -> str:
        text = self.machine.decode(b"", True)
        self.machine.reset()
        self.first = True
        return text


class Tokenizer:
    """A public BPE tokenizer file: its normaliser, its split pattern, the two transducers."""

    def __init__(self, path: str):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        model, decoder = spec["model"], spec.get("decoder")
        self.suffix = model["end_of_word_suffix"] or ""
        self.words = bool(self.suffix)
        self.split = regex.compile(WORD_SPLIT if self.words else BYTE_SPLIT)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = MergeList(merges, self.vocab, self.suffix)
        self.transducer = Transducer(self.merges)
        self.symbols = byte_symbols()
        self.table = str.maketrans({chr(b): s for b, s in enumerate(self.symbols)})
        self.spaced = decoder is None
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        back = {s: b for b, s in enumerate(self.symbols)}
        raw = lambda t: t.encode() if self.spaced or t in self.special else bytes(back[c] for c in t)
        self.pieces = [raw(names.get(i, "")) for i in range(max(names) + 1)]
        self.cache = TwoGenerations(CACHED_WORDS, lambda words: [self.encode_word(w) for w in words])

    def normalise(self, text: str) -> str:
        """NFC, then lower case by code point, for tokenizers of whole words."""
        if not self.words:
            return text
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # str.lower() has a final form, which depends on what is around
                text = text.replace("Σ", "σ")
        return text.lower()

    def encode_word(self, word: str) -> bytes:
        """One pretoken's ids as little-endian 32-bit integers."""
        symbols = word.encode().decode("latin-1").translate(self.table)
        tokens = [*self.transducer.push(symbols), *self.transducer.finish()] if len(symbols) > self.transducer.window else self._whole(symbols)
        vocab = self.vocab
        return array("I", [vocab[t] for t in tokens]).tobytes()

    def _whole(self, symbols: str) -> list[str]:
        """A pretoken that the window holds: the transducer would only finish."""
        return self.merges.merge([*symbols[:-1], symbols[-1] + self.suffix])

    def segments(self, text: str) -> Iterator[str]:
        """Pieces of a text that may be encoded one by one: each but the first starts with white space after none."""
        start = 0
        while len(text) - start > SEGMENT:
            end = start + SEGMENT
            while end < len(text) and not (text[end] in " \n" and not text[end - 1].isspace() and text[end - 1] not in "\x1c\x1d\x1e\x1f"):
                end += 1
            yield text[start:end]
            start = end
        yield text[start:]

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text, a segment at a time, as little-endian 32-bit integers."""
        for segment in self.segments(text):
            parts = self.special_pattern.split(segment) if "<|" in segment else (segment,)
            for part in parts:
                if part in self.special:
                    yield array("I", [self.special[part]]).tobytes()
                elif part:
                    words = self.split.findall(self.normalise(part))
                    yield b"".join(map(self.cache.ready(words).__getitem__, words))

    def decoder(self) -> Decoder:
        return Decoder(self.pieces, self.spaced)


_LOADED: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def round_trip(documents: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text and decode its ids again.

    Returns doc_id, n_tokens, ids_sha256 and decoded_sha256. A null text counts
    as an empty one, with 0 tokens; a very long one is encoded a segment at a
    time, and a segment goes on to the next white space, however far that is; rows with equal or null ids each give a
    row; other columns are ignored.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    prepare(documents.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def trip(texts: pd.Series) -> pd.DataFrame:
        tokenizer, rows = load(path), []
        for text in texts:
            n, ids_hash, text_hash, decoder = 0, hashlib.sha256(), hashlib.sha256(), tokenizer.decoder()
            for ids in tokenizer.encode(text or ""):
                n += len(ids) // 4
                ids_hash.update(ids)
                text_hash.update(decoder.push(array("I", ids)).encode())
            text_hash.update(decoder.finish().encode())
            rows.append((n, ids_hash.hexdigest(), text_hash.hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = only(documents, doc_id=id_col, text=text_col).select("doc_id", trip("text").alias("trip"))
    return rows.select("doc_id", "trip.*")
