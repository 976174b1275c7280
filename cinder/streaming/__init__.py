"""Streaming form of the word count.

The reference has no streaming code; this only shows that the batch operators
are plain DataFrame plans and therefore run unchanged on a streaming source
(text files arriving in a folder). Aggregation state is the word counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinder.operators.words import word_count


def word_count_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(folder)
    return word_count(lines)
