"""SRC-1 / SRC-8: text files as one row per line."""

from __future__ import annotations

import functools
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One ``value`` row per line. Splitting follows the file system's blocks;
    we never force a single partition."""
    return spark.read.text(list(paths))


#: Larger than any file: one file is one task, which ends after its first line.
_WHOLE_FILE = str(1 << 60)


def first_line(spark: SparkSession, *paths: str) -> DataFrame:
    """Header peek: (file, value) with the first line of every file that has one, reading one line of each.

    Every file is a scan of its own, unsplit, under a limit of one row, which stops its task after that
    row; all are tasks of one stage. The plan grows with the number of files, not with their bytes.
    """
    peek = spark.newSession()  # the same catalog and executors, settings of its own
    peek.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    peek.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    files = peek.read.text(list(paths)).inputFiles() if paths else []
    names = [re.sub(r"([*?{}\[\]\\])", r"\\\1", unquote(f)) for f in sorted(files)]  # as paths, which may hold patterns
    heads = [peek.read.text(n).select(F.col("_metadata.file_path").alias("file"), "value").limit(1) for n in names]
    return functools.reduce(DataFrame.unionAll, heads) if heads else spark.createDataFrame([], "file string, value string")
