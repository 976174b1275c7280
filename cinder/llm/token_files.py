"""Token ids in files: frequency-ranked, byte-aligned, with separate control bytes.

Frequent ids get small ranks. A rank takes 1 to 4 bytes; its byte count less one is a
two-bit code, four codes to a control byte, and all control bytes of a block stand before
all its data bytes. Reading looks the four lengths of a control byte up in a 256-row numpy
table, sums them to positions, gathers the bytes and maps ranks back to ids.

Block format (little-endian): ``CTB1``, u32 documents, u64 ids, then per document i64
doc_id, u8 null flag, u32 ids; then control bytes, then data bytes. Blocks hold whole
documents, about ``BLOCK_IDS`` ids each. They are written by Spark's own committer as rows
``(part, at, n_ids, block)`` of Parquet files (at: the ids before it in its part), so any store works and a lost executor's files are
written again; ``ranks`` beside them holds id by rank. Blocks in order of (part, at) have
the documents in ascending doc_id order (nulls first; equal ids by their text).

Defined results: a null or empty text holds only the end id. Repeated rows stay; those of one
id, however many, are dealt to several parts by their text. Other
input columns are ignored. An empty table gives no blocks and no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cinder.llm.common import ROWS_PER_SLICE, map_batches, map_rows, rows_to_batch
from cinder.llm.tokenizer import load, word_table

BLOCK_IDS = 1 << 18
MAGIC = b"CTB1"
#: Byte counts of the four codes in each control byte.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    padded[:len(ranks)] = code
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], dtype=np.uint8)
    keep = np.arange(4, dtype=np.uint8)[None, :] <= code[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """n ranks from control bytes and data bytes, by table lookup."""
    lengths = LENGTHS[control].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    data = np.concatenate([data, np.zeros(3, np.uint8)])
    out = data[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = lengths > k
        if longer.any():
            out[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def build_block(keys: list[int | None], ids: list[np.ndarray], rank_of: np.ndarray) -> bytes:
    joined = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    control, data = pack_ranks(rank_of[joined])
    return b"".join([MAGIC, struct.pack("<IQ", len(keys), len(joined)),
                     np.array([k or 0 for k in keys], "<i8").tobytes(),
                     np.array([k is None for k in keys], "u1").tobytes(),
                     np.array([len(i) for i in ids], "<u4").tobytes(), control, data])


def read_block(block: bytes, by_rank: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, their id counts, and all ids of the block."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    n, total = struct.unpack_from("<IQ", block, 4)
    take = lambda kind, count, at: np.frombuffer(block, kind, count, at)
    keys, null, counts = take("<i8", n, 16), take("u1", n, 16 + 8 * n), take("<u4", n, 16 + 9 * n)
    at, controls = 16 + 13 * n, -(-total // 4)
    ranks = unpack_ranks(take("u1", controls, at), take("u1", len(block) - at - controls, at + controls), total)
    return [None if z else int(k) for k, z in zip(keys, null)], counts, by_rank[ranks]


TOKENS = "part int, at bigint, doc_id bigint, width int, ids binary, counts binary"


def sorted_ids(docs: DataFrame, vocabulary: str, end_id: int, path: str) -> DataFrame:
    """Tokenise in ascending doc_id order; rows (part, at, doc_id, width, ids) in the shared folder; at: ids before it in its part.

    Each task ends with a row of its own: ``counts`` of every id in its rows, as 64-bit integers.
    """
    ordered = (docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text"))
    arrow = to_arrow_schema(StructType.fromDDL(TOKENS))
    size = vocabulary_size(vocabulary, end_id)
    width = 2 if size <= 1 << 16 else 4

    def run(batches):
        table, end, part = word_table(vocabulary), struct.pack("<I", end_id), TaskContext.get().partitionId()
        counts, at = np.zeros(size, np.int64), 0
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_PER_SLICE):
                rows, held = [], []
                for key, text in zip(*(c.to_pylist() for c in batch.slice(first, ROWS_PER_SLICE).columns)):
                    ids = table.ids(text) + end
                    held.append(ids)
                    rows.append((part, at, key, width, np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids, None))
                    at += len(ids) // 4
                counts += np.bincount(np.frombuffer(b"".join(held), "<u4"), minlength=size)
                yield rows_to_batch(rows, arrow)
        yield rows_to_batch([(part, at, None, width, b"", counts.astype("<i8").tobytes())], arrow)
    map_batches(ordered, run, TOKENS).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(TOKENS).parquet(path)


def vocabulary_size(vocabulary: str, end_id: int) -> int:
    return max(load(vocabulary).get_vocab_size(), end_id + 1)


def id_ranks(tokens: DataFrame) -> list[int]:
    """Ids by falling count over all documents (ties: smaller id first); no more than the vocabulary has reach the driver."""
    def sums(batches):
        counts = 0
        for batch in batches:
            for held in batch.column(0):
                counts = counts + np.frombuffer(held.as_buffer(), "<i8")
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at] if len(at) else [], pa.int64())], names=["id", "n"])
    counted = map_batches(tokens.filter("counts is not null").select("counts"), sums, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return [r.id for r in counted.orderBy(F.desc("n"), "id").collect()]


def write_token_files(docs: DataFrame, path: str, work: str, vocabulary: str, end_id: int) -> None:
    """Write ``path``/blocks and ``path``/ranks. ``work`` is a new folder all executors share."""
    spark = docs.sparkSession
    tokens = sorted_ids(docs, vocabulary, end_id, work)
    order = id_ranks(tokens)
    ids = tokens.filter("counts is null").drop("counts")
    spark.createDataFrame(list(enumerate(order)), "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    ranks = np.zeros(vocabulary_size(vocabulary, end_id), np.uint32)
    ranks[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(ranks.tobytes())

    def blocks(batches):
        rank_of = np.frombuffer(shared.value, np.uint32)
        names = ["part", "at", "n_ids", "block"]
        keys, held, count, first = [], [], 0, None

        def out():
            block = build_block(keys, held, rank_of)
            return pa.RecordBatch.from_arrays([pa.array([first[0]], pa.int32()), pa.array([first[1]], pa.int64()),
                                               pa.array([count], pa.int64()), pa.array([block], pa.binary())], names=names)
        for batch in batches:
            part, at, key, width, data = (batch.column(i) for i in range(5))
            for p, s, k, w, b in zip(part.to_pylist(), at.to_pylist(), key.to_pylist(), width.to_pylist(), data):
                if held and (p != first[0] or count >= BLOCK_IDS):
                    yield out()
                    keys, held, count, first = [], [], 0, None
                first = first or (p, s)
                keys.append(k)
                held.append(np.frombuffer(b.as_buffer(), f"<u{w}").astype(np.uint32))
                count += len(held[-1])
        if held:
            yield out()
    # A staged file may be read in several splits; blocks then start anew, (part, at) still orders them.
    (map_batches(ids, blocks, "part int, at bigint, n_ids bigint, block binary")
        .write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids per document, from the files alone."""
    by_rank = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    shared = spark.sparkContext.broadcast(by_rank.tobytes())
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row per part file, not per document: parts are partitions of the write.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    placed = blocks.join(F.broadcast(parts), "part").select((F.col("at") + F.col("part_start")).alias("start"), "block")

    def make():
        table = np.frombuffer(shared.value, np.uint32)

        def run(first, held):
            for at, block in zip(first, held):
                keys, counts, ids = read_block(block, table)
                ends = np.cumsum(counts, dtype=np.int64)
                for k, n, e in zip(keys, counts.tolist(), ends.tolist()):
                    yield k, at + e - n, ids[e - n:e].astype("<u4").tobytes()
        return run
    return map_rows(placed, "doc_id bigint, start bigint, ids binary", make, rows=4)


def digests(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32."""
    return read.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
