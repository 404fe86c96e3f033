"""A table of the newest row per key, kept by bucketed copy-on-write.

Rows are dealt to buckets by their key's hash.  A merge reads and writes the buckets of its batch's keys
and leaves the others' files as they are; then a manifest names, for every bucket, the version that
wrote it.  Readers take the newest manifest, which appears in one step, so they never see half a merge.
Folders that no kept manifest names are removed, the manifests of the last versions being kept for readers
that have begun.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.silver import latest

#: Manifests that are kept: readers of the versions before the newest one can end.
KEPT = 2
#: Name of the folders' partition column; no column of the rows has it.
BUCKET = "upsert_bucket"


def _fs(spark: SparkSession, path: str):
    """The file system of a path and the path, in the cluster's own terms."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Versions that stand whole in a folder, ascending: those with the mark of a committed job."""
    fs, at = _fs(spark, folder)
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    found = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
    return [v for v in found if fs.exists(_fs(spark, f"{folder}/v{v}/_SUCCESS")[1])]


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """Which version wrote each bucket; one small row per bucket."""
    return {r.bucket: r.version for r in spark.read.parquet(f"{path}/manifests/v{version}").collect()}


def versions(spark: SparkSession, path: str) -> list[int]:
    return _numbers(spark, f"{path}/manifests")


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, path: str, manifest: dict[int, int], buckets: list[int] | None = None) -> DataFrame | None:
    wanted = [f"{path}/data/v{v}/{BUCKET}={b}" for b, v in manifest.items() if buckets is None or b in buckets]
    return spark.read.parquet(*wanted) if wanted else None


def current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The table as of a version, the newest if none is named; None before the first merge."""
    known = versions(spark, path)
    if version is not None and version not in known:
        raise ValueError(f"version {version} is not kept; there are {known}")
    return _rows(spark, path, _manifest(spark, path, known[-1] if version is None else version)) if known else None


def merge(batch: DataFrame, path: str, version: int, key: str, stamp: str, *order: str, buckets: int = 64, keep: int = KEPT) -> None:
    """Makes `version` from the newest one and a batch, of which the newest rows per key win (`silver.latest`).

    Versions ascend.  A version that stands already is left as it is, so a batch can be run again; what a
    lost run left of it is written over.  `buckets` stays the same for a table.  An empty batch makes a
    version that names the files of the one before.
    """
    spark = batch.sparkSession
    known = versions(spark, path)
    if known and known[-1] >= version:
        return
    now = _manifest(spark, path, known[-1]) if known else {}
    dealt = latest(batch, key, stamp, *order).withColumn(BUCKET, bucket_of(F.col(key), buckets))
    touched = {r[BUCKET] for r in dealt.select(BUCKET).distinct().collect()}  # `buckets` at most
    if touched:
        old = _rows(spark, path, now, sorted(touched))
        rows = dealt.drop(BUCKET) if old is None else old.unionByName(dealt.drop(BUCKET), allowMissingColumns=True)
        rows = latest(rows, key, stamp, *order).withColumn(BUCKET, bucket_of(F.col(key), buckets))
        rows.repartition(len(touched), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/data/v{version}")
    named = sorted((now | dict.fromkeys(touched, version)).items())
    spark.createDataFrame(named, "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifests/v{version}")
    clean(spark, path, keep)


def clean(spark: SparkSession, path: str, keep: int = KEPT) -> None:
    """Removes all manifests but the last `keep`, and the buckets that these do not name."""
    known = versions(spark, path)
    gone, kept = known[:-keep], known[-keep:]
    named = {(v, b) for k in kept for b, v in _manifest(spark, path, k).items()}
    fs, data = _fs(spark, f"{path}/data")
    for v in gone:
        fs.delete(_fs(spark, f"{path}/manifests/v{v}")[1], True)
    if not fs.exists(data):
        return
    for folder in fs.listStatus(data):
        v = int(folder.getPath().getName()[1:])
        if v > known[-1]:  # a merge that is not done
            continue
        inside = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith(BUCKET)]
        unnamed = [p for p in inside if (v, int(p.getName().split("=")[1])) not in named]
        for p in unnamed if len(unnamed) < len(inside) else [folder.getPath()]:
            fs.delete(p, True)
