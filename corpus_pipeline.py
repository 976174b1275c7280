"""The corpus pipeline: quality rules, language ID, near-duplicates, personal data, packing.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs. The first four
return the columns of ``docs`` (their rows decided on, or their text redacted), the last
one the packed pieces. ``run`` applies them all to ``documents``.

SQL cannot express the models of these stages, so ``ORACLE_SQL`` is None; the tests hold
every stage against a brute-force version on small tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinder.llm import langid_centroid, minhash_bottomk, packing_certified, pii_weak, quality_llr
from cinder.llm.common import prepare, read_table
from cinder.llm.tokenizer import vocabulary_path
from cinder.operators.staging import new_folder, releasing, stage

ORACLE_SQL = None
#: Words whose ids a Python worker of the last stage remembers, some 20 MB: by then the executor holds what four stages left.
REMEMBERED = 1 << 17


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules or the likelihood ratio reject go. Null, empty and short texts are rejected."""
    return quality_llr.keep_good(docs, read_table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a letter, or too far from every learned language, go."""
    return langid_centroid.keep_known(docs, langid_centroid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: the one with the smallest doc_id, and of rows that repeat
    that id the one with the smallest hash. Rows with a null doc_id cannot be named in a group; they stay."""
    verdicts = stage(minhash_bottomk.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id"), "kept")
    out = docs.join(verdicts, "doc_id", "left_semi").select(*docs.columns)
    again = verdicts.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not again.isEmpty():
        first = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
        repeated = out.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(first).select("row.*")
        out = out.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(repeated.select(*docs.columns))
    return out.unionByName(docs.filter(F.col("doc_id").isNull()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in text is replaced by its kind; n_chars follows. Every row stays; null and empty texts stay as they are."""
    return pii_weak.redact(docs, pii_weak.fit(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's ids and an end id, packed in sequences of at most 2048. A null or empty text is its end id alone."""
    return packing_certified.pack(docs, vocabulary_path(), end_id=0, capacity=2048, words=REMEMBERED)


def _stage(function):
    @functools.wraps(function)
    def run_stage(spark, docs, sf_dir):
        prepare(spark)
        return function(spark, docs, sf_dir)
    return function.__name__, run_stage


STAGES = [_stage(f) for f in (quality_rules, language_id, near_dedup, personal_data, best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written in the shared folder and read again."""
    folder = new_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        with releasing(spark):
            step(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
