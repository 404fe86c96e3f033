"""Reading raw records of mixed shape, and the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from larkspur.operators.silver import ITEM_SCHEMA

#: Which field makes a record of a kind; listings carry the group's URL too, so their field comes first.
KINDS = (("listing", "perfume_url"), ("group", "brand_url"), ("item", "url"))


def kind_of(listing: Column, group: Column, item: Column) -> Column:
    """Kind of a record by the first of these fields that is not empty; null for none."""
    full = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return F.when(full(listing), "listing").when(full(group), "group").when(full(item), "item")


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str | StructType = ITEM_SCHEMA, files: str = "*.jsonl") -> DataFrame:
    """Records of JSON lines under a declared schema: kind, file, the fields, _corrupt_record.

    `files` is the pattern of the names of the files to read, in the folder and those in it.  Blank lines vanish; malformed lines stay with their text in _corrupt_record and no kind.
    """
    base = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*base.fields]).add("_corrupt_record", StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "recursiveFileLookup": "true", "pathGlobFilter": files}
    rows = spark.read.schema(full).options(**options).json(path)
    kind = kind_of(*(F.col(f) if f in base.fieldNames() else F.lit(None) for _, f in KINDS))
    return rows.select(F.when(F.col("_corrupt_record").isNull(), kind).alias("kind"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), *full.fieldNames())


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.where("_corrupt_record is null")


def of_kind(rows: DataFrame, kind: str, folder: str | None = None, others: tuple[str, ...] = ("items", "brands", "brand_perfumes")) -> DataFrame:
    """Records of one kind from its own folder, flat files and unknown folders, but not from the other
    kinds' folders."""
    out = rows.where(F.col("kind") == kind)
    for other in others if folder else ():
        if other != folder:
            out = out.where(~F.contains("file", F.lit(f"/{other}/")))
    return out


def scan_report(rows: DataFrame) -> DataFrame:
    """(kind, n): what a scan holds by kind, malformed lines and unknown shapes included."""
    what = F.when(F.col("_corrupt_record").isNotNull(), "malformed").otherwise(F.coalesce("kind", F.lit("unknown")))
    return rows.groupBy(what.alias("kind")).agg(F.count("*").alias("n"))


def observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """A scan's rows, and what they hold by kind, counted on the way as the next step reads them: the counts are
    there once that step has run."""
    seen = Observation()
    broken = F.col("_corrupt_record").isNotNull()
    kinds = [F.count_if(~broken & (F.col("kind") == kind)).alias(kind) for kind, _ in KINDS]
    rest = [F.count_if(broken).alias("malformed"), F.count_if(~broken & F.col("kind").isNull()).alias("unknown")]
    return rows.observe(seen, *kinds, *rest), seen


def observed_report(spark: SparkSession, seen: Observation) -> DataFrame:
    """`scan_report` from what was counted: one row for each kind that was there."""
    return spark.createDataFrame([(k, n) for k, n in seen.get.items() if n], "kind string, n long")


def split_by_kind(rows: DataFrame, path: str) -> None:
    well_formed(rows).where("kind is not null").drop("file", "modified", "_corrupt_record").write.mode("overwrite").partitionBy("kind").json(path)


def mixed_files(rows: DataFrame) -> DataFrame:
    """Files whose records are not of one kind."""
    return rows.groupBy("file").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).where(F.size("kinds") != 1)


# Sinks


def write_tables(tables: dict[str, DataFrame], schemas: dict[str, str], path: str) -> None:
    """Each table cast to its declared columns and written over."""
    for name, df in tables.items():
        df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schemas[name]).fields)).write.mode("overwrite").parquet(f"{path}/{name}")


def register(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """Temp views over the tables that exist; returns the names of those."""
    done = []
    for name in names:
        try:
            spark.read.parquet(f"{path}/{name}").createOrReplaceTempView(name)
        except Exception as e:  # noqa: BLE001  a table that is not there yet is left out
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        else:
            done.append(name)
    return done


def staged(spark: SparkSession, names: list[str], prefix: str = "stg_") -> None:
    """Passthrough views, so that a source changes in one place."""
    for name in names:
        spark.table(name).createOrReplaceTempView(prefix + name)


def write_gold(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_csv(df: DataFrame, path: str, columns: list[str], bom: bool = True, files: int | None = 1) -> None:
    """A report as CSV with a fixed column order; missing columns are empty, others ignored.  It has `files`
    files, one as a report has; None for one a task, which large results need.  Each has the header."""
    out = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))
    if bom and columns:
        out = out.withColumnRenamed(columns[0], "\ufeff" + columns[0])
    out = out if files is None else out.coalesce(1) if files == 1 else out.repartition(files)
    out.write.mode("overwrite").option("header", True).csv(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def flat_list(entries: Column, name: str = "name", a: str = "width", b: str = "opacity") -> Column:
    """Nested entries as text: `name:a|b` joined by "; "."""
    s = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.array_join(F.transform(entries, lambda e: F.concat(s(e[name]), F.lit(":"), s(e[a]), F.lit("|"), s(e[b]))), "; ")


def write_embeddings(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str, expected: str | None = None) -> DataFrame:
    """A stored embedding table; raises if it is empty, mixed or of another model."""
    from larkspur.operators.dense import one_model

    df = spark.read.parquet(path)
    one_model(df, expected)
    return df


def _one_each(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The first row of each key by `order`."""
    by = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__n", F.row_number().over(by)).where("__n = 1").drop("__n")


def load_serving(items: DataFrame, vectors: DataFrame, terms: DataFrame, path: str, dimensions: int, order: str | None = None) -> None:
    """Both serving tables written over; raises if an item lacks a vector or one has the wrong length.

    Of several vectors of an item the last one stays, of several equal terms the first one, by the column
    `order` of both tables (when they were loaded, say).  Without one, rows that differ are ordered by their
    vector or weight, so that the result does not depend on how the tables are stored.
    """
    lost = items.select("item").join(vectors.select("item"), "item", "left_anti").count()
    wrong = vectors.where(F.size("embedding") != dimensions).count()
    if lost or wrong:
        raise ValueError(f"{lost} items without a vector, {wrong} vectors not of {dimensions} numbers")
    last, first = F.col(order or "embedding").desc_nulls_last(), F.col(order or "weight").asc_nulls_last()
    _one_each(vectors, ["item"], last).write.mode("overwrite").parquet(f"{path}/vectors")
    _one_each(terms, ["item", "block", "label"], first).write.mode("overwrite").parquet(f"{path}/terms")
