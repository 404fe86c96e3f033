"""Tables and files that a job writes for itself, in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; in a local session without one, a temporary folder.

    Raises on a cluster whose sessions name no shared folder: a machine-local folder would
    not be seen by the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="spark-larkspur-")
    return _local[context.applicationId]


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/larkspur-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written and read back: what is used several times is computed once and survives lost executors."""
    path = f"{new_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
