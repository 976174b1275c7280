"""Word count (PRJ-3/4, FLT-11, STR-1, AGG-1, SRT-1).

Plan: scan -> Generate(explode) -> Filter -> HashAggregate(partial) ->
Exchange(word) -> HashAggregate(final). The partial aggregate collapses every
hot word to one row per task before the shuffle, so a word that holds a third
of all tokens costs one row per map task, not a third of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.functions.text import words


def tokens(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """One ``word`` row per token; empty tokens (leading/trailing separators) dropped."""
    return lines.select(F.explode(words(F.col(text_col))).alias("word")).where(F.col("word") != "")


def word_count(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """(word STRING, n BIGINT), case kept, ASCII word characters."""
    return tokens(lines, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_sorted(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Same rows ordered by word (range-partitioned sort; byte order of the UTF-8 text)."""
    return word_count(lines, text_col).orderBy("word")
