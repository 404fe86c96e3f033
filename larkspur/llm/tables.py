"""Reading tables and keeping intermediate results in the folder the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from larkspur.sources.scratch import shared_dir


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, so that a task's memory does not follow the length of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def _written(df: DataFrame, name: str, folder: str | None) -> DataFrame:
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark)}/larkspur-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage and survives lost executors."""
    return _written(df, name, _scratch.get())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is materialized inside is removed at the end; the given function writes what is to stay."""
    outer = _scratch.get()
    folder = f"{outer or shared_dir(spark)}/larkspur-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield lambda df, name: _written(df, name, outer)
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
