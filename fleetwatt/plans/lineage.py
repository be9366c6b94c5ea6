"""Tables written between the steps of a job, in storage every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names. On a single machine without one, a folder of our own, which
    is deleted at the end; on a cluster no executor could read another one's, so that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="fleetwatt-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return _OWN[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back, so that later passes do not recompute df.

    The table outlives executors and cuts the lineage. It stays in the shared
    folder, under its label, until that is cleared.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
