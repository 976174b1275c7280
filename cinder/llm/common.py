"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows handed to a per-text function at once; bounds what a task holds besides its input batch.
ROWS_PER_SLICE = 512


#: Rows in an Arrow batch between Spark and Python. Texts are long: Spark's 10,000 of them make hundreds of MB a task.
ROWS_PER_BATCH = 1024
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What the Python stages need of a session; every one of them calls this.

    Python workers import this package from where the driver did, whatever folder they start in; where the driver's
    folders do not reach (a master that is not local) the package is shipped to them. Arrow batches are kept small.
    """
    import cinder

    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(cinder.__file__)))
    known = context.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    if not context.master.startswith("local") and context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        folder = tempfile.mkdtemp(prefix="cinder-package-")  # the driver's own: Spark serves the file from there
        context.addPyFile(shutil.make_archive(f"{folder}/cinder", "zip", root, "cinder"))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ROWS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow``, prepared."""
    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[..., Iterable[tuple]]],
             rows: int = ROWS_PER_SLICE) -> DataFrame:
    """Per-row Python work in Arrow batches.

    ``make()`` runs once per task and returns ``f(*column lists) -> tuples``, called
    with slices of at most ``rows`` rows. ``schema`` is the DDL of the tuples.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for batch in batches:
            f = f or make()
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield rows_to_batch(f(*(c.to_pylist() for c in part.columns)), arrow)

    return map_batches(df, run, schema)


def rows_to_batch(rows: Iterable[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)


class WordHash(dict):
    """word bytes -> 64-bit hash, remembered for at most ``limit`` words."""

    def __init__(self, limit: int = 1 << 18):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def word_hash() -> WordHash:
    """The table of this Python worker; Spark reuses workers for later tasks."""
    return WordHash()


def forget_hashes() -> None:
    """Free the table of ``word_hash`` and unused Arrow memory: workers outlive the stages that filled them."""
    word_hash.cache_clear()
    pa.default_memory_pool().release_unused()
