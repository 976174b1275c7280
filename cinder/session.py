"""Session helpers: a local session for tests/bench and the settings we rely on."""

from __future__ import annotations

import atexit
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library assumes. On a cluster the caller sets these (plus
# executor sizing). AQE only merges partitions, so a large job should start from
# enough: spark.sql.adaptive.coalescePartitions.initialPartitionNum (or
# spark.sql.shuffle.partitions) at about input bytes / 200 MB, and
# spark.sql.files.maxPartitionBytes at 128-256 MB.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cinder",
                  extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CINDER_DRIVER_MEMORY", "8g"))
        .config("spark.log.structuredLogging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if the session has none.

    On a cluster ``spark.checkpoint.dir`` names a folder that all executors share, and is
    used as is; without it this raises, since a machine-local folder would lose rows.
    Only a single-process session (``local``, tests and the bench) gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="cinder-ckpt-")
        delete_at_end(spark, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def file_system(spark: SparkSession, path: str):
    """Spark's file system for a path, and the path as that system takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder when the application's JVM ends (it need not exist yet)."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        fs.mkdirs(hadoop_path.getParent())
    _AT_END.setdefault(spark.sparkContext.applicationId, []).append(path)
    if len(_AT_END[spark.sparkContext.applicationId]) == 1:
        atexit.register(_delete_all, spark, spark.sparkContext.applicationId)


_AT_END: dict[str, list[str]] = {}


def _delete_all(spark: SparkSession, app: str) -> None:
    for path in _AT_END.pop(app, []):
        try:
            fs, hadoop_path = file_system(spark, path)
            fs.delete(hadoop_path, True)
        except Exception:  # noqa: BLE001 - the JVM has gone already; nothing is left to ask
            return
