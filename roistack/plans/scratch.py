"""Scratch tables in the folder that the driver and all executors share, removed when the driver's Python ends."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting to remove the shuffle files of an execution at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_folders: dict[str, str] = {}


def _drop(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session is already gone at exit
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local one only where that is unset, as in tests on one machine."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        _folders[app] = f"{root.rstrip('/')}/rois-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_drop, spark, _folders[app])
    return f"{_folders[app]}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: cuts lineage, survives lost executors.

    The shuffles behind the table are of no use once it is written, and are removed then.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)
