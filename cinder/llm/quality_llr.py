"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Words and neighbouring word pairs are hashed to ``BUCKETS`` buckets. One pass over all
documents gives the raw corpus's multinomial; the trusted target's comes from documents
labelled good (at most ``TRUSTED`` of them, by hash order of their ids; the bound is a
parameter). A document's score is the mean over its n-grams of log p(target) - log p(raw),
so its length does not matter. Documents under ``THRESHOLD`` are rejected, the same for
every document and input size.

Defined results: a null, empty or blank text has no words, all counts 0, score 0 and fails
the base rule (under 50 words). Null or repeated doc_ids keep their rows. Other input
columns are ignored. Without good labels every score is 0 and only the base rule decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.llm.common import WordHash, map_batches, map_rows, word_hash

BUCKETS = 1 << 17
TRUSTED = 20_000
THRESHOLD = -0.2
SMOOTHING = 0.5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(text: str | None, known: WordHash) -> np.ndarray:
    """One 64-bit hash per word; words are runs without ASCII white space (bytes.split cuts at the same six)."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def ngram_buckets(words: np.ndarray) -> np.ndarray:
    half = BUCKETS // 2
    shift = np.uint64(64 - half.bit_length() + 1)
    single = (words * _MIX) >> shift
    pairs = ((words[:-1] * _MIX + words[1:]) * _MIX2) >> shift
    return np.concatenate([single, pairs + np.uint64(half)]).astype(np.int64)


def repeated_words(words: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice, the first occurrence included."""
    if len(words) < 4:
        return 0
    windows = (words[:-2] * _MIX + words[1:-1]) * _MIX2 + words[2:]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[which] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> set[int]:
    """Ids of at most ``bound`` documents labelled good, smallest hashes first."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return {r.doc_id for r in good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()}


def bucket_counts(docs: DataFrame, trusted: set[int]) -> np.ndarray:
    """Counts by bucket over all documents: row 0 raw corpus, row 1 trusted target. Two numbers a bucket reach the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(trusted)

    def run(batches):
        known, counts = word_hash(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            found = [ngram_buckets(word_hashes(text.as_py(), known)) for text in batch.column(1)]
            counts[0] += np.bincount(np.concatenate(found), minlength=BUCKETS)
            good = [f for key, f in zip(batch.column(0).to_pylist(), found) if key in shared.value]
            if good:
                counts[1] += np.bincount(np.concatenate(good), minlength=BUCKETS)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[0][at]), pa.array(counts[1][at])],
                                         names=["bucket", "raw", "target"])
    sums = (map_batches(docs.select("doc_id", "text"), run, "bucket int, raw bigint, target bigint")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    counts = np.zeros((2, BUCKETS), np.int64)
    at = sums.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = sums.column("raw").to_numpy(), sums.column("target").to_numpy()
    return counts


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """log p(target) - log p(raw) by bucket; singles and pairs are two multinomials of their own."""
    out = np.zeros(BUCKETS)
    for part in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):
        raw, target = counts[0, part], counts[1, part]
        if target.sum():
            p = [(c + SMOOTHING) / (c.sum() + SMOOTHING * len(c)) for c in (raw, target)]
            out[part] = np.log(p[1]) - np.log(p[0])
    return out


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, trusted: int = TRUSTED) -> DataFrame:
    """doc_id, the base counts, base_failed, score, kept: one row per row of ``docs``."""
    ratios = log_ratios(bucket_counts(docs, trusted_ids(labels, trusted)))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    return map_rows(docs.select("doc_id", "text"),
                    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                    "n_repeat_words bigint, base_failed boolean, score double, kept boolean", lambda: scorer(shared, threshold))


def scorer(shared, threshold: float):
    known, ratios = word_hash(), shared.value

    def run(keys, texts):
        for key, text in zip(keys, texts):
            yield key, *judge(text, known, ratios, threshold)
    return run


def judge(text: str | None, known: WordHash, ratios: np.ndarray, threshold: float) -> tuple:
    text = text or ""
    words = word_hashes(text, known)
    n, again = len(words), repeated_words(words)
    failed = n < 50 or 100 * again > 50 * n
    value = float(ratios[ngram_buckets(words)].mean()) if n else 0.0
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), duplicate_lines(text), again,
            failed, value, not failed and value >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, trusted: int = TRUSTED) -> DataFrame:
    """The rows of ``docs`` that are kept, in all their columns: the verdict is taken in the pass that reads them."""
    ratios = log_ratios(bucket_counts(docs, trusted_ids(labels, trusted)))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        known = word_hash()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([judge(t.as_py(), known, shared.value, threshold)[-1] for t in texts], pa.bool_()))
    return map_batches(docs, run, docs.schema)
