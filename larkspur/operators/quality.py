"""Data-quality checks: each returns its findings as rows, none if the data are right."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or combinations) that occur more than once, with their count; nulls are no values."""
    there = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    return df.where(there).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def unique_combination(df: DataFrame, *columns: str) -> DataFrame:
    """As `unique`, nulls counting as equal values."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """(column, n_null) of each column that has nulls; one pass for all columns."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns))
    return counts.select(F.inline(rows)).where("n_null > 0")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n"))


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null keys without a parent, with their rows."""
    lost = child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
    return lost.groupBy(key).agg(F.count("*").alias("n"))


def null_together(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a).isNull() != F.col(b).isNull())


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def sums_to(df: DataFrame, column: str, total: float = 100.0, tolerance: float = 0.5) -> DataFrame:
    return df.agg(F.sum(column).alias("total")).where(F.abs(F.col("total") - total) > tolerance)


def schema_drift(df: DataFrame | None, declared: StructType, table: str) -> list[tuple[str, str, str]]:
    """(table, column, what) for each missing, extra or wrongly typed column; None: the table is unreadable."""
    if df is None:
        return [(table, "", "the table is missing or cannot be read")]
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    found = [(table, c, f"missing, declared {kind}") for c, kind in want.items() if c not in have]
    found += [(table, c, f"{have[c]}, declared {kind}") for c, kind in want.items() if c in have and have[c] != kind]
    return found + [(table, c, f"not declared, is {kind}") for c, kind in have.items() if c not in want]


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], tolerance: float = 0.0011) -> DataFrame:
    """(keys, column, left, right) where two computations differ by more than the tolerance; null
    equals null, and a key on one side only is a finding."""
    left = a.select(*keys, F.lit(True).alias("__l"), *(F.col(c).cast("double").alias(f"l_{c}") for c in columns))
    right = b.select(*keys, F.lit(True).alias("__r"), *(F.col(c).cast("double").alias(f"r_{c}") for c in columns))

    def row(c: str) -> Column:
        same = F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")) <= tolerance
        both = F.col(f"l_{c}").isNull() & F.col(f"r_{c}").isNull() & F.col("__l").isNotNull() & F.col("__r").isNotNull()
        wrong = ~F.coalesce(same, F.lit(False)) & ~both
        return F.struct(F.lit(c).alias("column"), F.col(f"l_{c}").alias("left"), F.col(f"r_{c}").alias("right"), wrong.alias("wrong"))

    joined = left.join(right, keys, "full_outer")
    return joined.select(*keys, F.inline(F.array(*map(row, columns)))).where("wrong").drop("wrong")


def key_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two loaders has, and on which side."""
    x, y = a.select(key), b.select(key)
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def is_stale(source: DataFrame, derived: DataFrame) -> bool:
    """Whether the newest source file is younger than the newest derived one."""
    newest = lambda df: df.select(F.max("_metadata.file_modification_time")).first()[0]
    s, t = newest(source), newest(derived)
    return s is not None and (t is None or s > t)


_FINDING = "table string, column string, what string"


def warehouse_drift(spark: SparkSession, root: str, declared: dict[str, StructType]) -> DataFrame:
    """(table, column, what): how the Parquet tables under a folder differ from their declared schemas.

    Footers of all files of a table are read by Spark and merged, so a column that only some files have
    counts as there, and files of one column with two types are a finding.  Missing and unreadable tables are
    findings too; a table without any is not in the result.
    """
    found: list[tuple[str, str, str]] = []
    for name, want in declared.items():
        try:
            df = spark.read.option("mergeSchema", True).parquet(f"{root}/{name}")
        except AnalysisException:  # no such folder, or no Parquet in it
            found += schema_drift(None, want, name)
            continue
        except (PySparkException, Py4JJavaError):  # files that are broken or do not go together
            found.append((name, "", "its files cannot be read together"))
            continue
        found += schema_drift(df, want, name)
    return spark.createDataFrame(found, _FINDING)


def file_times(spark: SparkSession, root: str) -> DataFrame:
    """(table, files, newest): the data files of each table under a folder, by their paths and times alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    table = F.regexp_extract(F.col("path"), "/([^/]+)/(?:[^/=]+=[^/]*/)*[^/]+$", 1)
    return files.groupBy(table.alias("table")).agg(F.count("*").alias("files"), F.max("modificationTime").alias("newest"))


def stale_tables(spark: SparkSession, root: str, sources: dict[str, list[str]]) -> DataFrame:
    """(table, source): tables that are older than one they derive from, or have no files while that one has.

    sources: the tables that each table derives from.
    """
    times = file_times(spark, root)
    pairs = spark.createDataFrame([(t, s) for t, of in sources.items() for s in of], "table string, source string")
    of_source = times.select(F.col("table").alias("source"), F.col("newest").alias("since"))
    rows = pairs.join(times.select("table", "newest"), "table", "left").join(of_source, "source")
    return rows.where("newest is null or since > newest").select("table", "source")
