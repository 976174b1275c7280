"""Order-preserving packing: dynamic programming over window cuts.

Documents stay in their order; a task's documents, each with its end id, are one stream of ids
that is cut into windows of at most ``capacity``. A window of n ids costs its padding:
``capacity - n``, or nothing if n is a power of two, since such sequences are not padded. A cut
costs nothing at a document's end, ``SENTENCE`` ids at a sentence's end inside one and
``INSIDE`` within a sentence; the last kind is offered every ``capacity / 32`` ids of sentences
longer than four such steps, so any text can be cut. The dynamic programme finds the cuts of
the least total cost. The best start of a window that ends at j is the least (cost + place)
among the cuts at most ``capacity`` before j, kept by a monotone queue, or a cut a power of two
before j. Of equal costs the longer window wins.

The stream is solved in stretches of ``STRETCH`` ids: all windows of a stretch but its last,
open one are final, the rest goes on into the next stretch. So a task holds one batch of
texts, one stretch and its longest document, whatever its input. Only the last window of a
task ends because the input does. Texts are tokenised, cut and digested in one pass over the
scan's own splits, nothing is shuffled, and a task that runs again returns the same rows.

Defined results: a null or empty text holds only the end id. Rows keep their doc_id, null or
repeated, and are placed one by one. Other input columns are ignored. An empty table gives no
rows. An id stands in exactly one piece.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cinder.llm.common import ROWS_PER_SLICE, map_batches, rows_to_batch
from cinder.llm.tokenizer import WordTable, word_table, words_of

SENTENCE = 16
INSIDE = 64
STRETCH = 1 << 20
#: Sentence ends, each with the space behind it; line breaks end sentences too.
ENDS = (". ", "! ", "? ", '." ', '!" ', '?" ', ".) ", ".» ", ".” ")
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def sentences(text: str) -> list[str]:
    """The text cut after sentence ends and line breaks; only white space is lost."""
    for end in ENDS:
        if end in text:
            text = text.replace(end, end[:-1] + "\n")
    return text.split("\n")


def best_cuts(places: np.ndarray, penalties: np.ndarray, capacity: int, open_end: bool) -> tuple[list[int], int]:
    """Indices of the chosen cuts after the first, and their cost.

    ``places`` rise from 0 in steps of at most ``capacity``. The last place is the last cut,
    or, with an ``open_end``, any cut at most ``capacity`` before it.
    """
    n = len(places)
    ends, starts = [], []
    size = 1
    while size <= capacity:
        at = np.searchsorted(places, places - size)
        hit = np.flatnonzero(places[at] == places - size)  # places[0] = 0 is never a place less a size
        ends.append(hit)
        starts.append(at[hit])
        size *= 2
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    ends, starts, hit = [*ends[order].tolist(), n], starts[order].tolist(), 0
    place, penalty = places.tolist(), penalties.tolist()
    cost, ahead, back = [0] * n, [0] * n, [0] * n  # ahead: cost plus place
    queue, head = [0], 0
    for j in range(1, n):
        p = place[j]
        while place[queue[head]] < p - capacity:
            head += 1
        i = queue[head]
        best = ahead[i] + capacity - p
        while ends[hit] == j:
            k = starts[hit]
            hit += 1
            if cost[k] < best or cost[k] == best and k < i:
                best, i = cost[k], k
        back[j], best = i, best + penalty[j]
        cost[j] = best
        ahead[j] = best = best + p
        while len(queue) > head and ahead[queue[-1]] > best:
            queue.pop()
        queue.append(j)
    j = n - 1
    if open_end:
        j = min(range(int(np.searchsorted(places, places[-1] - capacity)), n), key=lambda i: (cost[i], -i))
    total, cuts = cost[j], []
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1], total


class Stream:
    """Documents in order; windows come out as rows of SCHEMA as soon as they are final."""

    def __init__(self, capacity: int, first_id: int, sentence: int = SENTENCE, inside: int = INSIDE, stretch: int = STRETCH):
        self.capacity, self.next_id, self.sentence, self.inside = capacity, first_id, sentence, inside
        self.stretch, self.step = max(stretch, 4 * capacity), max(1, capacity // 32)
        self.docs: list[tuple[int | None, bytes]] = []
        self.counts: list[list[int]] = []  # ids by sentence of each document, the end id with the last
        self.sent, self.held = 0, 0  # ids of the first document that are placed already; ids not placed yet

    def add(self, key: int | None, ids: list[bytes]) -> None:
        """One document: the ids of its sentences, the end id in the last."""
        whole = b"".join(ids)
        self.docs.append((key, whole))
        self.counts.append([len(b) // 4 for b in ids])
        self.held += len(whole) // 4

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cuts from the first id that is not placed on, and their penalties."""
        counts = np.array([n for doc in self.counts for n in doc], np.int64)
        ends = np.cumsum(counts) - self.sent
        penalties = np.full(len(ends), self.sentence)
        penalties[np.cumsum([len(doc) for doc in self.counts]) - 1] = 0
        inner = [np.arange(ends[k] - counts[k] + self.step, ends[k], self.step) for k in np.flatnonzero(counts > 4 * self.step).tolist()]
        places = np.concatenate([np.zeros(1, np.int64), ends, *inner])
        penalties = np.concatenate([np.zeros(1, np.int64), penalties, np.full(sum(map(len, inner)), self.inside)])
        order = np.argsort(places, kind="stable")
        order = order[np.searchsorted(places, 0, sorter=order):]
        return places[order], penalties[order]

    def windows(self, last: bool) -> Iterator[tuple]:
        """Rows of the final windows; with ``last`` of all."""
        if not self.docs or not last and self.held < self.stretch:
            return
        places, penalties = self.marks()
        cuts, _ = best_cuts(places, penalties, self.capacity, not last)
        doc, inside, at = 0, self.sent, 0
        for cut in places[cuts].tolist():
            offset = 0
            while at < cut:
                key, ids = self.docs[doc]
                total = len(ids) // 4
                n = min(cut - at, total - inside)
                yield key, inside, n, zlib.crc32(memoryview(ids)[4 * inside:4 * (inside + n)]), total, self.next_id, offset
                offset, at, inside = offset + n, at + n, inside + n
                if inside == total:
                    doc, inside = doc + 1, 0
            self.next_id += 1
        self.docs, self.counts, self.sent, self.held = self.docs[doc:], self.counts[doc:], inside, self.held - at


def sentence_ids(text: str | None, table: WordTable, end: bytes) -> list[bytes]:
    """Ids by sentence, the end id with the last that has any."""
    ids = [b for s in sentences(text) if (b := b"".join(map(table.__getitem__, words_of(s))))] if text else []
    return [*ids[:-1], ids[-1] + end] if ids else [end]


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 2048, sentence: int = SENTENCE,
         inside: int = INSIDE, stretch: int = STRETCH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a piece."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end = word_table(vocabulary), struct.pack("<I", end_id)
        stream = Stream(capacity, TaskContext.get().partitionId() << 40, sentence, inside, stretch)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_SLICE):
                rows = []
                for key, text in zip(*(c.to_pylist() for c in batch.slice(at, ROWS_PER_SLICE).columns)):
                    stream.add(key, sentence_ids(text, table, end))
                    rows += stream.windows(last=False)
                yield rows_to_batch(rows, arrow)
        yield rows_to_batch(list(stream.windows(last=True)), arrow)
    return map_batches(docs.select("doc_id", "text"), run, SCHEMA)
