"""Token ids by the tokenizers library, with a cache over pieces between white space."""

from __future__ import annotations

import os
import re
from array import array

from corpusloom.llm.bpe import byte_symbols
from corpusloom.llm.caches import TwoGenerations

#: Pieces in the cache, and code points of a text that are split at a time.
CACHED_PIECES, SEGMENT = 600_000, 1 << 18
#: White space other than space and line feed, or characters on which Python and the library differ.
_ODD = re.compile(r"[^\S \n]|[\x1c-\x1f]")
_PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Texts of Latin letters without combining marks, and without anything like a special token, are cut after words too.
_OTHER = re.compile(r"[^\n -~\xa1-\u024f]|<\|")
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_WORDS = re.compile(rf"[ \n]*[^{_LETTERS} \n]*[{_LETTERS}]+|[ \n]*[^{_LETTERS} \n]+|[ \n]+")
_LOWER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f"
_LOWER_WORDS = re.compile(rf"[^{_LOWER} \n]*[{_LOWER}]+|[^{_LOWER} \n]+")


class CachedTokenizer:
    """Ids of whole texts, equal to those of the library's encode(text, add_special_tokens=False).

    No token of these tokenizers goes on over white space that follows
    something else, nor from a letter to what is none, so that a text may be
    cut at each such place and the pieces, most of which occur again and
    again, encoded once. For a tokenizer that lowers its input and drops white
    space the pieces are taken in lower case and without it. Texts beyond
    Latin letters are cut at white space only, those with rare kinds of white
    space go to the library as a whole.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.cache = TwoGenerations(cached, self._make)
        self.table = str.maketrans({chr(b): c for b, c in enumerate(byte_symbols())})
        probe = lambda text: self.library.encode(text, add_special_tokens=False).ids
        self.lowers = probe("Aa Bb\n") == probe("aa") + probe("bb")

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _make(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces: a Latin word, with a space or none before it, is one pretoken and goes straight to the library's model."""
        merge, table, out, other = self.library.model.tokenize, self.table, [], []
        for i, piece in enumerate(pieces):
            word = piece.lower() if self.lowers else piece.removeprefix(" ")
            if word.isalpha() and not _OTHER.search(word) and piece.endswith(word):
                out.append(array("I", [t.id for t in merge(piece.encode().decode("latin-1").translate(table))]).tobytes())
            else:
                out.append(b"")
                other.append(i)
        if other:
            for i, ids in zip(other, self._encode([pieces[i] for i in other]), strict=True):
                out[i] = ids
        return out

    def ids(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        latin = not _OTHER.search(text)
        if not latin and _ODD.search(text):
            return self._encode([text])[0]
        if len(text) <= SEGMENT:
            return self._pieces(text, latin)
        out, start = [], 0
        while start < len(text):
            end = min(len(text), start + SEGMENT)
            while end < len(text) and not (text[end] in " \n" and text[end - 1] not in " \n"):
                end += 1
            out.append(self._pieces(text[start:end], latin))
            start = end
        return b"".join(out)

    def _pieces(self, text: str, latin: bool) -> bytes:
        if not latin:
            pieces = _PIECES.findall(text)
        elif self.lowers:
            pieces = _LOWER_WORDS.findall(text.lower())
        else:
            pieces = _WORDS.findall(text)
        return b"".join(self.cache.values(pieces))


_LOADED: dict[str, CachedTokenizer] = {}


def load(path: str, cached: int = CACHED_PIECES) -> CachedTokenizer:
    """The worker's tokenizer for a file; ``cached`` pieces at least stay in the cache of the first that asks for it."""
    if path not in _LOADED:
        _LOADED[path] = CachedTokenizer(path, cached)
    return _LOADED[path]
