"""Token ids of whole texts by the tokenizers library, remembered per word.

A text is cut at ASCII white space. No rule of the vocabulary file reaches across white
space (normaliser, splitting pattern and merges all stop there), so the ids of a text are
the ids of its words in a row. Words recur, so each task keeps a bounded table of them.
A word of plain Latin letters, digits and ASCII signs is split by the file's own pattern
and merged by the library's model; any other goes through the library's whole ``encode``.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np

VOCABULARY = "word_bpe_49k.json"

#: Words without control characters, combining marks or other scripts: NFC leaves them alone.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
#: Fixed value: the splitting pattern of the vocabulary file, its classes narrowed to PLAIN, in lower case.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-z0-9à-öø-ÿß]+").findall
#: The same for many words at once, a line each: a line end is a piece of its own, and in no other.
LINE_PIECES = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^\na-z0-9à-öø-ÿß]+").findall
#: Words a table keeps: as many as fit a dict of 1 << 21 slots without its next doubling.
TABLE_WORDS = (1 << 22) // 3
_SPACES = re.compile("[ \t-\r]+").split
_ODD_SPACES = re.compile("[\x1c-\x1f]").search


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def words_of(text: str) -> list[str]:
    """Maximal runs without white space. str.split also cuts at the separators x1c-x1f, which are ids of their own."""
    return [w for w in _SPACES(text) if w] if _ODD_SPACES(text) else text.split()


@lru_cache(maxsize=2)
def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTable(dict):
    """word -> little-endian 32-bit ids. Full tables start anew, long words are not kept.

    The pieces of a word stand in the same table: a piece by itself is a word whose only piece it is.
    """

    def __init__(self, path: str, limit: int = TABLE_WORDS, longest: int = 64):
        super().__init__()
        self.tokenizer, self.limit, self.longest = load(path), limit, longest
        self.model = self.tokenizer.model

    def keep(self, word: str, ids: bytes) -> None:
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids

    def piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join(map(byte_letters().__getitem__, piece.encode()))
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        plain = word.isprintable() if word.isascii() else PLAIN(word)  # the same for ASCII, quicker
        if len(word) > self.longest or "<|" in word or not plain:
            out = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        else:
            lower = word.lower()
            pieces = [lower] if lower.isalpha() else PIECES(lower)  # letters alone are one piece
            if pieces == [word]:
                out = self.piece(word)
            else:
                out = b"".join([self.get(p) or self.kept_piece(p) for p in pieces])
        if len(word) <= self.longest:
            self.keep(word, out)
        return out

    def kept_piece(self, piece: str) -> bytes:
        self.keep(piece, out := self.piece(piece))
        return out

    def ids(self, text: str | None) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers; null counts as empty."""
        return b"".join(map(self.__getitem__, words_of(text))) if text else b""


@lru_cache(maxsize=1)
def word_table(path: str, limit: int = TABLE_WORDS) -> WordTable:
    """The one table of this Python worker: Spark reuses workers, so later tasks find what earlier ones learned."""
    return WordTable(path, limit)
