"""Phrase collocations by weighted acyclic automata.

A window is the up to ``LONGEST`` words of a piece from one word on; every word starts one, so
a phrase occurs as often as windows begin with it. Each task takes shards of ``SHARD_WORDS``
words, sorts a shard's windows and builds count transducers from them: acyclic automata whose
paths are the distinct windows, with the number of occurrences on the last arc. States with
the same arcs are merged, level by level from the end. A transducer covers one prefix range,
an interval of windows in word order whose bounds come from a sample of documents and only
balance the work; a frequent prefix is cut by further words into several ranges.

The transducers of a range are united and their weights summed. A phrase's count is the weight
of the paths that begin with it, neighbours in the order of the range; one that reaches over a
range's border comes out of each of its ranges in part, and the parts are added. Phrases of at
least ``min_count`` occurrences stay. The parts of a candidate are looked up by composing, per
range, the automaton of all parts asked for with the transducer of the counted phrases. Parts
are asked for once each, so no range meets more requests than it holds phrases.

A word in many windows, a text copied many times or a language with most rows costs each shard
one path, and its ranges are as large as others. Sizes: a task holds one batch and one shard
or the transducers of one range (about ``RANGE_WORDS`` windows); the driver some 32 sampled
windows a range and one bound, words cut to ``BOUND_BYTES``, for each. Larger executors take
larger shards and ranges, which also makes transducers of more shared paths.

Defined results: a null or empty text has no words, a null lang counts as ``und``. Ids are not
used; repeated rows count again. Other input columns are ignored. An empty table, or one
without a phrase of ``min_count`` occurrences, gives no rows.
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinder.llm.common import map_batches, rows_to_batch
from cinder.operators.staging import stage

LONGEST = 4
SHARD_WORDS = 1 << 21
RANGE_WORDS = 1 << 21
BOUND_BYTES = 16
#: Documents and windows a range of the sample that bounds are taken from.
SAMPLED_DOCS, SAMPLED_WINDOWS = 4096, 32
#: A-Z become small, piece ends a line feed, a tab a space.
LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
COUNTED = "lang string, size int, phrase string, f bigint"

Windows = tuple[np.ndarray, np.ndarray, np.ndarray]  # first two words, last two words (32 bits each), weight; in order


# ---------------------------------------------------------------- automata

def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner of each element of groups of these sizes, and its place in its group."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]


def merge_states(starts: np.ndarray, *arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """States given by the starts of their arcs: the merged state of each, and sizes and arcs of the merged ones.

    States with the same arcs are found by hash and compared arc by arc; a chance match stays a state of its own.
    """
    sizes = np.diff(np.append(starts, len(arcs[0])))
    owner, place = spread(sizes)
    h = place.astype(np.uint64)
    for column in arcs:
        h = (h ^ column.astype(np.uint64)) * _MIX
        h = (h ^ (h >> np.uint64(31))) * _MIX2
    _, first, which = np.unique(np.add.reduceat(h, starts), return_index=True, return_inverse=True)
    like = first[which]
    twin = starts[like][owner] + np.minimum(place, sizes[like][owner] - 1)
    same = np.logical_and.reduce([column == column[twin] for column in arcs])
    same = np.logical_and.reduceat(same, starts) & (sizes == sizes[like])
    kept, state = np.unique(np.where(same, like, np.arange(len(starts))), return_inverse=True)
    owner, place = spread(sizes[kept])
    at = starts[kept][owner] + place
    return state, sizes[kept], [column[at] for column in arcs]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values starts in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def build(words: list[bytes], windows: Windows) -> bytes:
    """The transducer of sorted distinct windows over word numbers (1 is ``words[0]``, 0 the end of a piece)."""
    high, low, weight = windows
    third = low >> np.uint64(32)
    used = np.unique(np.concatenate([high >> np.uint64(32), high & np.uint64(0xFFFFFFFF), third, low & np.uint64(0xFFFFFFFF), np.zeros(1, np.uint64)]))
    number = lambda a: np.searchsorted(used, a)
    starts = changes(high, third)
    state, sizes4, (w4, weight) = merge_states(starts, number(low & np.uint64(0xFFFFFFFF)), weight)
    high, third = high[starts], third[starts]
    starts = changes(high)
    state, sizes3, (w3, to4) = merge_states(starts, number(third), state)
    high = high[starts]
    parts = [b" ".join([words[k - 1] for k in used[1:].tolist()])]
    for column in (number(high >> np.uint64(32)), number(high & np.uint64(0xFFFFFFFF)), state, sizes3, w3, to4, sizes4, w4, weight):
        kind = next(t for t in ("<u1", "<u2", "<u4", "<u8") if column.max() < 1 << 8 * int(t[2]))
        parts.append(kind.encode() + column.astype(kind).tobytes())
    raw = b"".join(struct.pack("<Q", len(p)) + p for p in parts)
    return struct.pack("<Q", len(raw)) + pa.Codec("zstd").compress(raw, asbytes=True)


def paths(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A transducer's words, its paths as rows of four word numbers (0: end of a piece) and their weights, in order."""
    raw = pa.Codec("zstd").decompress(blob[8:], decompressed_size=struct.unpack_from("<Q", blob)[0], asbytes=True)
    at, parts = 0, []
    while at < len(raw):
        n, = struct.unpack_from("<Q", raw, at)
        parts.append(raw[at + 8:at + 8 + n])
        at += 8 + n
    w1, w2, to3, sizes3, w3, to4, sizes4, w4, weight = (np.frombuffer(p, p[:3].decode(), offset=3).astype(np.int64) for p in parts[1:])
    pair, place = spread(sizes3[to3])
    arc3 = (np.cumsum(sizes3) - sizes3)[to3][pair] + place
    triple, place = spread(sizes4[to4[arc3]])
    arc4 = (np.cumsum(sizes4) - sizes4)[to4[arc3]][triple] + place
    pair = pair[triple]
    return parts[0].split(b" ") if parts[0] else [], np.stack([w1[pair], w2[pair], w3[arc3[triple]], w4[arc4]]), weight[arc4]


def in_order(high: np.ndarray, low: np.ndarray, weight: np.ndarray) -> Windows:
    """Windows sorted, equal ones added up."""
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    starts = changes(high, low)
    return high[starts], low[starts], np.add.reduceat(weight[order], starts)


def numbered(blobs: list[bytes]) -> tuple[list[bytes], list[Windows]]:
    """All words of several transducers, in order, and the windows of each over their common numbers."""
    read = [paths(b) for b in blobs]
    words = sorted(set().union(*(w for w, *_ in read)))
    number, out = {w: k + 1 for k, w in enumerate(words)}, []
    for known, labels, weight in read:
        w1, w2, w3, w4 = np.fromiter((0, *map(number.__getitem__, known)), np.uint64, len(known) + 1)[labels]
        out.append((w1 << np.uint64(32) | w2, w3 << np.uint64(32) | w4, weight))
    return words, out


def unite(blobs: list[bytes]) -> tuple[list[bytes], Windows]:
    """All words of several transducers, in order, and the union of their windows with weights summed."""
    words, windows = numbered(blobs)
    return words, in_order(*map(np.concatenate, zip(*windows)))


def compose(asked: bytes, counted: bytes) -> tuple[list[str], np.ndarray]:
    """The paths of ``asked`` that ``counted`` has too, as texts, with their weights in ``counted``."""
    words, (first, second) = numbered([counted, asked])
    high, low = np.concatenate([first[0], second[0]]), np.concatenate([first[1], second[1]])
    order = np.lexsort((low, high))  # stable: of equal paths the one of ``counted`` comes first
    both = order[:-1][(high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])]
    return phrase_texts(words, high[both], low[both]), first[2][both]


def phrase_texts(words: list[bytes], high: np.ndarray, low: np.ndarray) -> list[str]:
    """Space-joined words of windows or of phrases padded by zeros."""
    labels = [(a >> np.uint64(32), a & np.uint64(0xFFFFFFFF)) for a in (high, low)]
    columns = [c.tolist() for pair in labels for c in pair]
    return [b" ".join([words[k - 1] for k in row if k]).decode() for row in zip(*columns)]


def phrases(words: list[bytes], windows: Windows, min_count: int) -> list[tuple[int, str, int]]:
    """(size, phrase, f) of the beginnings of a range's windows, and (0, '', number of windows).

    Phrases of under ``min_count`` are left out but for the first and last of each size, which may go on in a neighbouring range.
    """
    high, low, weight = windows
    small, top = np.uint64(0xFFFFFFFF), np.uint64(32)
    out = [(0, "", int(weight.sum()))]
    for size, (h, l) in enumerate([(high >> top << top, low * 0), (high, low * 0), (high, low >> top << top), (high, low)], 1):
        real = (h & small if size == 2 else l >> top if size == 3 else l & small if size == 4 else h) > 0
        if not real.any():
            break
        # Windows that end before this size come first among those with their beginning; they are no phrase of it.
        starts = changes(h, l)
        f = np.add.reduceat(weight, starts)
        keep = f >= min_count
        keep[[0, -1]] = True
        at = starts[keep & real[starts]]
        out += zip([size] * len(at), phrase_texts(words, h[at], l[at]), f[keep & real[starts]].tolist())
    return out


# ---------------------------------------------------------------- shards

class Numbers(dict):
    """word -> number in order of appearance; a line feed, which ends a piece, is 0, an empty word -1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self) - 1
        return out


class Shard:
    """Words of documents of one language, pieces ended by 0."""

    def __init__(self):
        self.known, self.parts, self.words = Numbers(), [], 0

    def add(self, documents: list[str]) -> None:
        tokens = b"\n".join([d.encode().translate(LETTERS) for d in documents]).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.known.__getitem__, tokens), np.int32, len(tokens))
        self.parts += [ids[ids >= 0], np.zeros(1, np.int32)]
        self.words += int((ids > 0).sum())

    def windows(self) -> tuple[list[bytes], Windows]:
        """The words in order and the sorted distinct windows."""
        words = sorted(w for w, k in self.known.items() if k > 0)
        rank = np.zeros(len(words) + 1, np.uint64)
        rank[[self.known[w] for w in words]] = np.arange(1, len(words) + 1)
        ids = rank[np.concatenate([*self.parts, np.zeros(LONGEST, np.int32)])]
        n = len(ids) - LONGEST + 1
        w1, w2, w3, w4 = (ids[k:n + k].copy() for k in range(LONGEST))
        w3[w2 == 0] = 0
        w4[w3 == 0] = 0
        real = w1 > 0
        high, low = (w1 << np.uint64(32) | w2)[real], (w3 << np.uint64(32) | w4)[real]
        return words, in_order(high, low, np.ones(len(high), np.int64))


def key_of(words: list[bytes], high: int, low: int) -> tuple[bytes, ...]:
    return tuple(words[k - 1] if k else b"" for k in (high >> 32, high & 0xFFFFFFFF, low >> 32, low & 0xFFFFFFFF))


def cut(words: list[bytes], windows: Windows, bounds: list[tuple[bytes, ...]]) -> Iterator[tuple[int, Windows]]:
    """(range, its windows) of sorted windows; range k holds those from bound k - 1 on and before bound k."""
    high, low, weight = windows
    n, at = len(high), 0
    k = 0
    while at < n:
        here = key_of(words, int(high[at]), int(low[at]))
        k = bisect.bisect_right(bounds, here, lo=k)  # ranges without a window are skipped
        end = n if k == len(bounds) else bisect.bisect_left(range(n), bounds[k], lo=at, key=lambda i: key_of(words, int(high[i]), int(low[i])))
        yield k, (high[at:end], low[at:end], weight[at:end])
        at = end


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def languages(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter(F.col("text").isNotNull())


def shard_transducers(docs: DataFrame, bounds: dict[str, list[tuple[bytes, ...]]], shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, range, transducer: every shard's windows, a row for each range they fall in."""
    schema = "lang string, range int, transducer binary"
    arrow, shared = arrow_schema(schema), docs.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = {}

        def out():
            for lang in list(shards):
                shard = shards.pop(lang)
                if shard.words:
                    words, windows = shard.windows()
                    for k, part in cut(words, windows, shared.value.get(lang, [])):
                        yield rows_to_batch([(lang, k, build(words, part))], arrow)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    by_lang.setdefault(lang, []).append(text)
                for lang, documents in by_lang.items():
                    shards.setdefault(lang, Shard()).add(documents)
                if sum(s.words for s in shards.values()) >= shard_words:
                    yield from out()
        yield from out()
    return map_batches(languages(docs), run, schema)


def range_bounds(docs: DataFrame, range_words: int = RANGE_WORDS) -> dict[str, list[tuple[bytes, ...]]]:
    """By language the rising bounds of its prefix ranges. They decide where work is done, never a result."""
    texts = languages(docs)
    n, length = texts.agg(F.count("*"), F.sum(F.length("text"))).first()
    if not n:
        return {}
    ranges = max(1, -(-length // (6 * range_words)))  # about six characters a word
    sampled = texts.sample(min(1.0, max(SAMPLED_DOCS, SAMPLED_WINDOWS * ranges) / n), seed=13)
    rate = min(1.0, SAMPLED_WINDOWS * ranges / max(1, min(SAMPLED_DOCS, n) * length / n / 6))

    def run(batches):
        draw = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            rows = []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                shard = Shard()
                shard.add([text])
                words, (high, low, _) = shard.windows()
                for i in np.flatnonzero(draw.random(len(high)) < rate).tolist():
                    rows.append((lang, [w[:BOUND_BYTES] for w in key_of(words, int(high[i]), int(low[i]))]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.binary()))],
                                             names=["lang", "words"])
    keys = map_batches(sampled, run, "lang string, words array<binary>").collect()
    step = max(1, len(keys) // ranges)
    by_lang: dict[str, list[tuple[bytes, ...]]] = {}
    for lang, words in keys:
        by_lang.setdefault(lang, []).append(tuple(map(bytes, words)))
    return {lang: sorted(set(sorted(held)[step::step])) for lang, held in by_lang.items()}


# ---------------------------------------------------------------- counts and parts

def counts(docs: DataFrame, bounds: dict[str, list[tuple[bytes, ...]]], min_count: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, size, phrase, f: phrases of 1 to LONGEST words with at least ``min_count`` occurrences; size 0: all words of a language."""
    arrow = arrow_schema(COUNTED)

    def run(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        rows = phrases(*unite(table.column("transducer").to_pylist()), min_count)
        return pa.Table.from_batches([rows_to_batch([(lang, *r) for r in rows], arrow)])
    parts = shard_transducers(docs, bounds, shard_words).groupBy("lang", "range").applyInArrow(run, COUNTED)
    return parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).filter((F.col("f") >= min_count) | (F.col("size") == 0))


def automaton(texts: list[str], weights: list[int]) -> bytes:
    """The transducer of distinct phrases."""
    split = [t.encode().split(b" ") for t in texts]
    words = sorted({w for s in split for w in s})
    number = {w: k + 1 for k, w in enumerate(words)}
    labels = np.array([[number[w] for w in s] + [0] * (LONGEST - len(s)) for s in split], np.uint64).T
    return build(words, in_order(labels[0] << np.uint64(32) | labels[1], labels[2] << np.uint64(32) | labels[3], np.array(weights, np.int64)))


def look_up(asked: DataFrame, counted: DataFrame, bounds: dict[str, list[tuple[bytes, ...]]]) -> DataFrame:
    """lang, phrase, f of the distinct ``asked`` (lang, phrase) that are ``counted``, composed range by range."""
    shared = asked.sparkSession.sparkContext.broadcast(bounds)

    def ranged(batches):
        for batch in batches:
            held = [shared.value.get(lang, []) for lang in batch.column(0).to_pylist()]
            keys = [tuple((s := p.encode().split(b" ")) + [b""] * (LONGEST - len(s))) for p in batch.column(1).to_pylist()]
            at = pa.array([bisect.bisect_right(b, k) for b, k in zip(held, keys)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, at], names=["lang", "phrase", "f", "range"])

    arrow = arrow_schema("lang string, phrase string, f bigint")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            found, weights = compose(*(automaton(t.column("phrase").to_pylist(), t.column("f").to_pylist()) for t in (left, right)))
            rows = list(zip([left.column("lang")[0].as_py()] * len(found), found, weights.tolist()))
        return pa.Table.from_batches([rows_to_batch(rows, arrow)])
    both = [map_batches(d.select("lang", "phrase", f), ranged, "lang string, phrase string, f bigint, range int").groupBy("lang", "range")
            for d, f in ((asked, F.lit(1).cast("long").alias("f")), (counted, "f"))]
    return both[0].cogroup(both[1]).applyInArrow(run, "lang string, phrase string, f bigint")


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, scale: int = 2_000_000, covered_percent: int = 80,
                 shard_words: int = SHARD_WORDS, range_words: int = RANGE_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to LONGEST words.

    score = floor(scale * a / (l + r)) at the lowest-scoring cut, first cut of equal ones. A phrase goes if a longer
    one that contains it has at least ``covered_percent`` of its occurrences.
    """
    bounds = range_bounds(docs, range_words)
    counted = stage(counts(docs, bounds, min_count, shard_words), "phrases")
    candidates = counted.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), "size")
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "w", "size")
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("rest"))
    asked = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).distinct()
    parts = stage(look_up(asked, counted.filter("size > 0"), bounds), "parts")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .withColumn("score", F.expr(f"CAST(floor(CAST(a AS DECIMAL(20,0)) * {scale}BD div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))) AS BIGINT)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    longer = (candidates.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * exact("longer") < covered_percent * exact("a")))
    words = counted.filter("size = 0").select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", F.col("x.l").alias("l"), F.col("x.r").alias("r"), "n", F.col("x.score").alias("score"))
