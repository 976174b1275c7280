"""BPE encoding and decoding with a contiguous rank array per word.

A word's letters start as one part each. Two contiguous arrays hold the parts between its
boundaries and the rank of every adjacent pair of parts. The smallest rank is found by a
scan, the boundary between its two parts is deleted (both arrays close the gap), and the
ranks left and right of it are looked up anew, until no pair has a rank. Words are short,
so scanning a contiguous array beats a heap. Words of a batch stand as rows of one matrix
and take each step together in numpy. Words over ``SHORT`` letters use the same rule with a
heap over linked boundaries.

Only the vocabulary file's normaliser and splitter are the tokenizers library's; merging
and decoding are done here. Words recur, so each task remembers a bounded number of them.
New words of plain letters are cut at once, in one text with a line for each, and their
ids put together at once, in one string of bytes with a mark after each.

Defined results: a null or empty text has no ids and decodes to ''. Rows keep their
doc_id, null or repeated, one output row each. Other input columns are ignored. Texts of
any length are taken whole.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.llm.common import ROWS_PER_SLICE, map_batches, map_rows
from cinder.llm.tokenizer import LINE_PIECES, PLAIN, byte_letters, load, words_of

SHORT = 32
#: Words that take their steps together.
TOGETHER = 4096
#: Words of texts that are looked up at once.
BATCH_WORDS = 1 << 16
#: Stands for the end of a line among ids. The highest byte of an id is below 0x80, so no ids hold it.
MARK = b"\xff" * 4


class RankArrayCodec(dict):
    """word -> its ids as little-endian 32-bit integers. Full tables start anew, long words are not kept.

    The pieces of plain words stand in the same table: a piece by itself is a word whose only piece it is.
    """

    def __init__(self, path: str, limit: int = 1 << 19, longest: int = 64):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        added = "(" + "|".join(map(re.escape, self.added or ["\n"])) + ")"  # words hold no line end
        self.added_split, self.special = re.compile(added).split, re.compile(added, re.IGNORECASE).search
        self.tokens = {i: t for t, i in {**self.vocab, **self.added}.items()}
        self.token_column = pa.array([self.tokens.get(i) for i in range(1 + max(self.tokens))], pa.string())
        self.none = len(self.ranks)
        at = {t: i for t, i in self.vocab.items()}
        pairs = sorted((at[a] * len(self.tokens) + at[b], k) for (a, b), k in self.ranks.items() if a in at and b in at and a + b in at)
        self.pair_keys, self.pair_ranks = (np.array(c, np.int64) for c in zip(*pairs))
        self.merged = np.array([at.get(a + b, -1) for a, b in self.ranks], np.int32)
        letters = [t for t in self.vocab if len(t) == 1 and t + self.end in self.vocab]
        self.alphabet = frozenset(letters)
        self.inner_ids, self.last_ids = (np.zeros(1 + max(map(ord, letters)), np.int32) for _ in range(2))
        for t in letters:
            self.inner_ids[ord(t)], self.last_ids[ord(t)] = self.vocab[t], self.vocab[t + self.end]
        library = load(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.letters = "".join(byte_letters()[b] for b in range(256))
        self.pieces: dict[str, bytes] = {}  # of words that are not plain, in the byte alphabet
        self.limit, self.longest = limit, longest

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece (letters already in the byte alphabet) of any length."""
        text = piece + self.end
        bounds = self._merge_long(text, [*range(len(piece)), len(text)])
        parts = (text[a:b] for a, b in zip(bounds, bounds[1:]))
        return [self.vocab[p] for p in parts if p in self.vocab]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of part ids, ``none`` without one."""
        key = left.astype(np.int64) * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.none).astype(np.int32)

    def merge_rows(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces of up to SHORT letters."""
        parts, count = self._merge_rows(pieces)
        return [ids[:n] for ids, n in zip(parts.tolist(), count.tolist())]

    def _merge_rows(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One matrix row of part ids for each piece and their count: one merge a row and step."""
        width = max(map(len, pieces))
        letters = np.frombuffer("".join([p.ljust(width, "\0") for p in pieces]).encode("utf-32-le"), "<u4").reshape(-1, width)
        count = np.array([len(p) for p in pieces])
        row = np.arange(len(pieces))
        parts = self.inner_ids[letters]
        parts[row, count - 1] = self.last_ids[letters[row, count - 1]]
        if width == 1:
            return parts, count
        column = np.arange(width - 1)
        p, n = parts, count  # of the rows that still merge
        r = np.where(column < (n - 1)[:, None], self.rank_of(p[:, :-1], p[:, 1:]), self.none)
        while len(row):
            k = np.arange(len(row))
            least = r.argmin(1)
            rank = r[k, least]
            going = rank < self.none
            if not going.all():
                done = ~going
                parts[row[done]], count[row[done]] = p[done], n[done]
                row, p, r, n, least, rank = row[going], p[going], r[going], n[going], least[going], rank[going]
                k = k[:len(row)]
            p[k, least] = self.merged[rank]
            # close the gap: the boundary right of the merged part goes, and the rank that stood on it
            at = least[:, None]
            p[:, :-1] = np.where(column > at, p[:, 1:], p[:, :-1])
            r[:, :-1] = np.where(column[:-1] >= at, r[:, 1:], r[:, :-1])
            r[:, -1] = self.none
            n = n - 1
            before, after = np.flatnonzero(least > 0), np.flatnonzero(least < n - 1)
            b, a = least[before], least[after]
            r[before, b - 1] = self.rank_of(p[before, b - 1], p[before, b])
            r[after, a] = self.rank_of(p[after, a], p[after, a + 1])
        return parts, count

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of new pieces, short ones together by length."""
        short = sorted((p for p in pieces if len(p) <= SHORT and self.alphabet.issuperset(p)), key=len)
        found = {p: np.array(self.merge(p), "<i4").tobytes() for p in pieces.difference(short)}
        for at in range(0, len(short), TOGETHER):
            some = short[at:at + TOGETHER]
            parts, count = self._merge_rows(some)
            size, packed = 4 * parts.shape[1], parts.astype("<i4", copy=False).tobytes()
            found.update((p, packed[k:k + 4 * n]) for p, k, n in zip(some, range(0, len(packed), size), count.tolist()))
        return found

    def _merge_long(self, text: str, bounds: list[int]) -> list[int]:
        after, before = dict(zip(bounds, bounds[1:])), dict(zip(bounds[1:], bounds))
        heap: list[tuple[int, int, int, int]] = []

        def push(mid: int) -> None:
            if mid in before and mid in after:
                a, b = before[mid], after[mid]
                r = self.ranks.get((text[a:mid], text[mid:b]))
                if r is not None:
                    heapq.heappush(heap, (r, a, mid, b))

        for mid in bounds[1:-1]:
            push(mid)
        while heap:
            _, a, mid, b = heapq.heappop(heap)
            if after.get(a) == mid and after.get(mid) == b:  # else one of the parts has grown since
                after[a], before[b] = b, a
                del after[mid], before[mid]
                push(a)
                push(b)
        out = [bounds[0]]
        while out[-1] in after:
            out.append(after[out[-1]])
        return out

    def _learn_plain(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new plain words and of the pieces that are new with them, by the file's rules narrowed to PLAIN."""
        pieces = LINE_PIECES("\n".join(words).lower())
        known = dict.fromkeys(pieces)
        known.update(zip(known, map(self.get, known)))
        known["\n"] = MARK
        new = [p for p, ids in known.items() if ids is None]
        letters = [p if p.isascii() else codecs.charmap_decode(p.encode(), "strict", self.letters)[0] for p in new]
        learned = self.learn(set(letters))
        found = {p: learned[x] for p, x in zip(new, letters)}
        known.update(found)
        found.update(zip(words, b"".join(map(known.__getitem__, pieces)).split(MARK)))
        return found

    def _learn_other(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words that hold added tokens or need the normaliser; their short pieces are remembered."""
        if len(self.pieces) > self.limit:
            self.pieces.clear()
        cut = {}
        for word in words:
            cut[word] = [x for part in self.added_split(word) if part
                         for x in ([struct.pack("<i", self.added[part])] if part in self.added else [p for p, _ in self.split(self.normalise(part))])]
        known = self.learn({x for xs in cut.values() for x in xs if x.__class__ is str and x not in self.pieces})
        found = {word: b"".join([x if x.__class__ is bytes else self.pieces[x] if x in self.pieces else known[x] for x in xs])
                 for word, xs in cut.items()}
        self.pieces.update((p, ids) for p, ids in known.items() if len(p) <= self.longest)
        return found

    def _learn_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words; they and their short pieces are remembered."""
        plain = [w for w in words if (w.isprintable() if w.isascii() else PLAIN(w)) and not self.special(w)]
        found = self._learn_plain(plain) if plain else {}
        if len(plain) < len(words):
            found.update(self._learn_other(list(words.difference(plain))))
        self.update(found if max(map(len, found)) <= self.longest else {w: ids for w, ids in found.items() if len(w) <= self.longest})
        return found

    def encode_all(self, texts) -> list[np.ndarray]:
        """Ids of whole texts; null counts as empty."""
        cut = [words_of(t) if t else [] for t in texts]
        out, at = [], 0
        while at < len(cut):  # some texts at a time, so that what is new stays small
            size, end = 0, at
            while end < len(cut) and (end == at or size < BATCH_WORDS):
                size, end = size + len(cut[end]), end + 1
            if len(self) > self.limit:
                self.clear()
            known = dict.fromkeys(chain.from_iterable(cut[at:end]))
            known.update(zip(known, map(self.get, known)))
            new = {w for w, ids in known.items() if ids is None}
            if new:
                known.update(self._learn_words(new))
            out += [np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4") for words in cut[at:end]]
            at = end
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """The file names no decoder, so tokens are joined by a space; unknown ids are left out."""
        try:
            return " ".join(map(self.tokens.__getitem__, ids))
        except KeyError:
            return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of known ids."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.token_column.take(ids.values)), " ")


@lru_cache(maxsize=2)
def codec_of(vocabulary: str) -> RankArrayCodec:
    """The codec of this Python worker; Spark reuses workers for later tasks."""
    return RankArrayCodec(vocabulary)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids."""
    def make():
        codec = codec_of(vocabulary)
        return lambda keys, texts: list(zip(keys, codec.encode_all(texts)))
    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, ids array<int>", make)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text from doc_id, ids (null ids: empty)."""
    def make():
        codec = codec_of(vocabulary)
        return lambda keys, ids: [(k, codec.decode(i or [])) for k, i in zip(keys, ids)]
    return map_rows(encoded.select("doc_id", "ids"), "doc_id bigint, text string", make)


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids, decoded: both directions in one pass over the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_SLICE):
                keys, texts = batch.slice(at, ROWS_PER_SLICE).columns
                codec = codec_of(vocabulary)
                coded = codec.encode_all(texts.to_pylist())
                ends = np.cumsum([0, *map(len, coded)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(coded)))
                yield pa.RecordBatch.from_arrays([keys.cast(pa.int64()), ids, codec.decode_all(ids)], ["doc_id", "ids", "decoded"])
    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``round_trip`` rows."""
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.expr("sha2(array_join(cast(ids as array<string>), ' '), 256)").alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
