"""Intermediate tables in the folder all executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session without that
setting falls back to a temporary folder, because there driver and executors are the same machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallystar.session import is_local

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = root = tempfile.mkdtemp(prefix="tallystar-")
        _remove_at_exit(spark, root)
    return _LOCAL_ROOTS[context.applicationId]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the application ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(folder)
    file_system.deleteOnExit(folder)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return it as a scan of the written table.

    Everything that reads the result shares one computation, and a lost executor costs a re-read instead of
    a recomputation of the whole lineage.
    """
    path = f"{fresh_dir(df.sparkSession, name)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
