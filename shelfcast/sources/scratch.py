"""Written intermediate tables.

A table written to the shared folder cuts the lineage and survives lost executors. The folder is the
one the cluster names in `spark.checkpoint.dir`; only a local session without it gets one of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: dict[str, str] = {}


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="shelfcast-")
    return _local_base[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{_base(spark)}/{name}-{uuid.uuid4().hex}"


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back, for results used by several branches of a plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
