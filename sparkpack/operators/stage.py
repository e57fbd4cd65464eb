"""Stage tables: results several later steps read are written once, to the folder the cluster shares.

Parquet keeps column pruning for the readers, and a lost executor only re-reads files.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str | None:
    """The configured checkpoint folder; a temporary folder of our own only in local mode."""
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return None
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sparkpack-")
    return _local_dirs[app]


def clear_stage(spark: SparkSession) -> int:
    """Delete every stage table, sink and state this application wrote; results still lazy on them must be written before."""
    n = 0
    for path in _written.pop(spark.sparkContext.applicationId, []):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        n += at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return n


def new_path(spark: SparkSession, kind: str) -> str:
    base = shared_dir(spark)
    if base is None:
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    path = f"{base}/{kind}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write a stage table and read it back. A cluster must name a shared folder, or this raises."""
    spark = df.sparkSession
    path = new_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
