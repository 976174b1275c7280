"""Cut lineage by writing a table into the shared checkpoint folder.

``stage(df)`` writes ``df`` as Parquet into a new folder under the session's
checkpoint directory (``spark.checkpoint.dir`` on a cluster) and returns a
scan of it. Compared with ``DataFrame.checkpoint()`` the staged rows are
columnar and compressed, the read-back scan has real size statistics for join
planning, and later tasks that fail re-read the same files. ``release`` deletes
staged folders as soon as they are not needed, ``releasing`` those of a block of
code at its end; the rest is deleted when the application's Python process ends.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from cinder.session import delete_at_end, ensure_checkpoint_dir, file_system


#: Paths staged within each open ``releasing`` block.
_OPEN: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used, deleted with the application."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cinder-{label}-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    path = new_folder(df.sparkSession, label)
    for held in _OPEN:
        held.append(path)
    df.write.mode("errorifexists").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._cinder_path = path
    return out


def release(*staged: DataFrame) -> None:
    """Delete the folders of staged tables; no plan over them may run afterwards."""
    for df in staged:
        fs, path = file_system(df.sparkSession, df._cinder_path)
        fs.delete(path, True)


@contextlib.contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Delete at its end what the block staged; what it returns must be written by then."""
    _OPEN.append(paths := [])
    try:
        yield
    finally:
        _OPEN.remove(paths)
        for path in paths:
            fs, hadoop_path = file_system(spark, path)
            fs.delete(hadoop_path, True)
