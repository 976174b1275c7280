"""Best-fit packing with certified partitions.

Documents are cut into pieces of at most ``capacity`` ids; full pieces are sequences by
themselves. The others are dealt evenly to partitions of bounded size, each packed by
best-fit decreasing. Dual-feasible functions give a lower bound on a partition's bins; a
partition that meets it is certified and never touched again. The other partitions give up
the bins that have gaps, their pieces are dealt anew together and packed again; a new
packing counts only if it needs fewer bins. This is repeated while bins are saved.

Defined results: a null or empty text holds only the end id. Rows keep their doc_id, null
or repeated; each row's pieces are placed on their own. Other input columns are ignored.
An empty table gives no rows. Identical rows are dealt by position, so no partition grows
with their number.
"""

from __future__ import annotations

import itertools
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.llm.common import forget_hashes, map_rows
from cinder.llm.tokenizer import TABLE_WORDS, word_table
from cinder.operators.staging import stage

#: Pieces packed by one task.
GROUP_PIECES = 1 << 16
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, uid bigint"
PLACED = f"{PIECE}, grp bigint, bin bigint, fill bigint, offset bigint, bound bigint, bins bigint"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, words: int = TABLE_WORDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, uid: every document's ids and the end id, cut at ``capacity``.

    ``words`` bounds what a Python worker remembers, not what it returns.
    """
    def make():
        forget_hashes()
        table, end, row = word_table(vocabulary, words), struct.pack("<I", end_id), [0]

        def run(keys, texts):
            task = TaskContext.get().partitionId() << 36
            for k, t in zip(keys, texts):
                ids = memoryview(table.ids(t) + end)
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    yield k, i, at // 4, len(part) // 4, zlib.crc32(part), task + row[0]
                    row[0] += 1
        return run
    return map_rows(docs.select("doc_id", "text"), PIECE, make)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins needed at least, by two families of dual-feasible functions on the counts by length."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    upto, mass = np.cumsum(count), np.cumsum(count * size)
    best = -(-int(mass[-1]) // capacity)
    cut = np.arange(1, capacity // 2 + 1)  # lengths over capacity - cut count as whole bins, those under cut as nothing
    whole = upto[-1] - upto[capacity - cut]
    middle = mass[capacity - cut] - mass[cut - 1]
    best = max(best, int((whole - (-middle // capacity)).max()))
    for k in range(1, 65):  # (k+1) x / capacity rounded down, over k, unless it is whole
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. ``room`` has a bit for every amount of space that some bin has left."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room, open_bins, used = 0, [[] for _ in range(capacity + 1)], 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = room >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                room ^= 1 << left
        else:
            b, left, used = used, capacity, used + 1
        bins[i], offsets[i] = b, capacity - left
        left -= n
        if left:
            if not open_bins[left]:
                room |= 1 << left
            open_bins[left].append(b)
    return bins, offsets


def _pack(items: DataFrame, groups: int, salt: int, capacity: int) -> DataFrame:
    dealt = items.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        return pdf.assign(bin=bins, fill=fill[bins], offset=offsets, bound=lower_bound(lengths, capacity), bins=len(fill))
    return dealt.groupBy("grp").applyInPandas(run, PLACED)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = 2048, group_pieces: int = GROUP_PIECES,
         rounds: int | None = None, words: int = TABLE_WORDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``rounds`` bounds the rounds; without it they end when none saves a bin."""
    cut = stage(pieces(docs, vocabulary, end_id, capacity, words), "pieces")
    result = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = (cut.filter(F.col("length") == capacity)
            .select("doc_id", "piece", "start", "length", "ids_crc32", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    name = lambda first: ((F.lit(first) + F.col("grp")) * F.lit(1 << 32) + F.col("bin")).alias("sequence_id")
    items = cut.filter(F.col("length") < capacity)
    n = items.count()
    groups, first = max(1, -(-n // group_pieces)), 1 << 24  # groups are numbered on through the rounds
    placed = stage(_pack(items, groups, 0, capacity), "packed")
    done = [full]
    for r in itertools.count(1):
        # Certified partitions are final; of the others, full bins are.
        final = (F.col("bins") == F.col("bound")) | (F.col("fill") == capacity)
        gaps = placed.filter(~final)
        n, before = gaps.agg(F.count("*"), F.count_distinct("grp", "bin")).first()
        used, groups = groups, max(1, -(-n // group_pieces))
        again = n and (rounds is None or r < rounds) and gaps.select("grp").distinct().count() > 1
        new = stage(_pack(gaps.select(*[c.split()[0] for c in PIECE.split(", ")]), groups, r, capacity), "packed") if again else None
        after = new.agg(F.count_distinct("grp", "bin")).first()[0] if again else before
        if after >= before:
            done.append(placed.select("doc_id", "piece", "start", "length", "ids_crc32", name(first), "offset"))
            break
        done.append(placed.filter(final).select("doc_id", "piece", "start", "length", "ids_crc32", name(first), "offset"))
        placed, first = new, first + used
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*result)
