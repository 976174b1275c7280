"""Language identification by the nearest centroid of TF-IDF n-gram vectors.

A text's letters, lower-cased, give byte n-grams of two and three, hashed to ``DIMS``
dimensions (everything that is no letter counts as one space). Weights are 1 + log(count)
times the inverse document frequency over all training documents, scaled to length 1. Each
language has up to ``CLUSTERS`` centroids, found by spherical k-means on at most
``SAMPLE`` training documents of all languages together, evenly, by hash order of their
ids (the bound is a parameter). The nearest centroid by cosine names the language.

A document is rejected if its cosine, or its margin over the cosine of its own characters in
another order (by a fixed seed), is under a bound of its language and length. Characters by
themselves give random letters, base64 and hex digits the cosine they have; only a known
order gives more. The bounds are the ``REJECT`` quantiles of the language's sample at that length
(powers of two of the n-grams; with both neighbours, then of all languages, if under ``ENOUGH`` rows),
each half of the sample measured with the centroids of the other. The two bounds
together cost 1 to 2 % of clean rows (1.7 % of sf0.1). Shorter texts than any of the sample are only held against ``SLACK`` times the
least bound on the cosine; longer ones against the bounds of the longest.

Training rows: non-null text, lang and doc_id, crc32 of the id as text not divisible by 5.
Prediction reads the text only.

Defined results: ``und`` with score 0 and rejected for a null text, one without a letter,
or when nothing was learned. Null or repeated doc_ids keep their rows (a null id counts as
held out). Ties between centroids go to the first language by name. Other input columns
are ignored. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinder.llm.common import map_batches, map_rows

DIMS = 4096
CLUSTERS = 4
SAMPLE = 4000
SALTS = 1024
ROUNDS = 12
SLACK = 0.3
REJECT = 0.005
ENOUGH = 50
BANDS = 48
UNKNOWN = "und"
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def mixed(text: str) -> str:
    """The text's characters in another order, the same for the same text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.random.Generator(np.random.PCG64(7)).permutation(points).tobytes().decode("utf-32-le", "surrogatepass")


def counts_of(text: str | None) -> np.ndarray | None:
    """n-gram counts by dimension, None without a letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    raw = (" " + text.lower() + " ").encode("utf-8", "surrogatepass").translate(_LETTERS)
    b = np.frombuffer(raw, np.uint8)
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])].astype(np.uint32)
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + b[2:] * np.uint32(0x27D4EB2F)
    grams = np.concatenate([two ^ (two >> np.uint32(15)), three ^ (three >> np.uint32(13))]) * np.uint32(0x2C1B3C6D)
    return np.bincount(grams >> np.uint32(32 - DIMS.bit_length() + 1), minlength=DIMS)


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.zeros(DIMS, np.float32)
    at = np.flatnonzero(counts)
    v[at] = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((v * v).sum())
    return v / norm if norm else v


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang")
    return rows.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each dimension occurs, and their number; DIMS + 1 numbers reach the driver."""
    def run(batches):
        seen = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = counts_of(text.as_py())
                if counts is not None:
                    seen[:DIMS] += counts > 0
                    seen[DIMS] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1, dtype=np.int32)), pa.array(seen)], names=["dim", "n"])
    total = np.zeros(DIMS + 1, np.int64)
    for r in map_batches(rows.select("text"), run, "dim int, n bigint").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        total[r.dim] = r.n
    return total[:DIMS], int(total[DIMS])


def _packed(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return at.astype("<u2").tobytes() + counts[at].astype("<u4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    n, counts = len(raw) // 6, np.zeros(DIMS, np.int64)
    counts[np.frombuffer(raw, "<u2", n)] = np.frombuffer(raw, "<u4", n, 2 * n)
    return counts


def sample_counts(rows: DataFrame, bound: int) -> dict[str, list[tuple[bytes, bytes]]]:
    """lang -> packed counts of its sampled documents and of their mixed characters, at most ``bound`` documents in all."""
    langs = [r.lang for r in rows.select("lang").distinct().orderBy("lang").limit(bound).collect()]
    each = max(1, bound // max(1, len(langs)))
    ids = rows.select("doc_id", "lang").distinct()
    # First by language and salt, then by language: no task sees more than SALTS * each rows of a language, however many there are.
    ids = ids.withColumn("h", F.xxhash64("doc_id")).withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*by).orderBy("h", "doc_id")
        ids = ids.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each)
    chosen = {(r.doc_id, r.lang) for r in ids.limit(bound).collect()}
    wanted = rows.filter(F.col("doc_id").isin([k for k, _ in chosen])) if len(chosen) <= 64 else rows.join(
        F.broadcast(rows.sparkSession.createDataFrame([(k,) for k, _ in chosen], "doc_id bigint").distinct()), "doc_id", "left_semi")

    def run(batches):
        done = set()
        for batch in batches:
            for key, text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, lang) in chosen and (key, lang) not in done:
                    done.add((key, lang))
                    counts = counts_of(text)
                    if counts is not None:
                        other = counts_of(mixed(text))
                        out = [pa.array([key]), pa.array([lang]), pa.array([_packed(counts)], pa.binary()), pa.array([_packed(other)], pa.binary())]
                        yield pa.RecordBatch.from_arrays(out, names=["doc_id", "lang", "counts", "other"])
    # An id that stands on several rows counts once, by its smallest counts.
    found = (map_batches(wanted.select("doc_id", "text", "lang"), run, "doc_id bigint, lang string, counts binary, other binary")
             .groupBy("doc_id", "lang").agg(F.min(F.struct("counts", "other")).alias("x")).select("doc_id", "lang", "x.*").orderBy("lang", "doc_id").collect())
    out: dict[str, list] = {}
    for r in found:
        out.setdefault(r.lang, []).append((bytes(r.counts), bytes(r.other)))
    return out


def centroids(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: the first centre is the mean, each further one the vector furthest from the others."""
    centres = [vectors.mean(0)]
    for _ in range(1, min(k, len(vectors))):
        centres.append(vectors[np.argmin(np.max(vectors @ np.stack(centres).T, axis=1))])
    found = np.stack(centres)
    for _ in range(ROUNDS):
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        nearest = np.argmax(vectors @ found.T, axis=1)
        found = np.stack([vectors[nearest == j].sum(0) if (nearest == j).any() else found[j] for j in range(len(found))])
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> dict:
    rows = training_rows(docs)
    seen, n = document_frequencies(rows)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    chosen = sorted(sample_counts(rows, sample).items())

    def vectors(packed: list[bytes]) -> np.ndarray:
        return np.stack([vector(_unpacked(c), idf) for c in packed])
    langs, centres = [], []
    for lang, docs_of in chosen:
        found = centroids(vectors([c for c, _ in docs_of]), clusters)
        langs += [lang] * len(found)
        centres.append(found)
    return {"idf": idf, "langs": langs, "bounds": bounds(chosen, vectors, clusters),
            "centres": np.concatenate(centres).astype(np.float32) if centres else None}


def band(counts: np.ndarray) -> int:
    return min(BANDS - 1, int(counts.sum()).bit_length())


def bounds(chosen: list[tuple[str, list]], vectors, clusters: int) -> dict[str, np.ndarray]:
    """lang -> least cosine and least margin by band. A language of one sampled document is measured with its own centroid."""
    measured: dict[str, list[np.ndarray]] = {lang: [] for lang, _ in chosen}
    for half in (0, 1):
        centres = [centroids(vectors([c for c, _ in docs_of[half::2] or docs_of]), clusters) for _, docs_of in chosen]
        centres = np.concatenate(centres).T if centres else None
        for lang, docs_of in chosen:
            rest = docs_of[1 - half::2]
            if rest:
                near, other = ((vectors([x[k] for x in rest]) @ centres).max(1) for k in (0, 1))
                measured[lang].append(np.stack([[band(_unpacked(c)) for c, _ in rest], near, near - other], 1))
    rows = {lang: np.concatenate(found) for lang, found in measured.items()}
    everything = np.concatenate(list(rows.values())) if rows else None
    out = {}
    for lang, own in rows.items():
        table, last = np.full((BANDS, 2), -np.inf), None
        for b in range(BANDS):
            near = next((x for x in (r[np.abs(r[:, 0] - b) <= k] for r in (own, everything) for k in (0, 1)) if len(x) >= ENOUGH), None)
            if near is not None:
                last = np.quantile(near[:, 1:], REJECT, axis=0)
            if last is not None:
                table[b] = last
        known = table[np.isfinite(table[:, 0]), 0]
        table[~np.isfinite(table[:, 0]), 0] = SLACK * float(known.min() if len(known) else np.quantile(own[:, 1], 0.01))
        out[lang] = table
    return out


def classify(text: str | None, model: dict) -> tuple[str, float, bool]:
    """Language, cosine to its nearest centroid, rejected."""
    counts = counts_of(text)
    if counts is None or model["centres"] is None:
        return UNKNOWN, 0.0, True
    near = model["centres"] @ vector(counts, model["idf"])
    best = int(np.argmax(near))
    score = min(1.0, max(0.0, float(near[best])))
    lang = model["langs"][best]
    cosine, margin = model["bounds"][lang][band(counts)]
    rejected = score < cosine
    if not rejected and np.isfinite(margin):
        rejected = score - float((model["centres"] @ vector(counts_of(mixed(text)), model["idf"])).max()) < margin
    return lang, score, bool(rejected)


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda keys, held, texts: [(k, h, *classify(t, shared.value)) for k, h, t in zip(keys, held, texts)]
    return map_rows(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"),
                    "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean", make)


def keep_known(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` whose language is known and not rejected, in all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([not classify(t.as_py(), shared.value)[2] for t in texts], pa.bool_()))
    return map_batches(docs, run, docs.schema)
