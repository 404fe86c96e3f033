"""A star schema over typed tables: dimensions with unknown members, facts without null keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.exprs import UNKNOWN_KEY, lookup, rounded, surrogate_key

AXIS_ORDER = {"winter": 1, "spring": 2, "summer": 3, "fall": 4, "day": 5, "night": 6}


def natural_group_key(key: str, name: str):
    """The group's key, else one made of its name."""
    return F.coalesce(F.col(key), F.when(F.col(name).isNotNull(), F.concat(F.lit("name:"), F.col(name))))


def global_rating(items: DataFrame, prior: float = 500.0) -> DataFrame:
    rated = F.col("rating").isNotNull() & (F.col("rating") > 0)
    v = F.when(rated, F.coalesce("votes", F.lit(0)))
    return items.agg((F.sum(F.col("rating") * v) / F.nullif(F.sum(v), F.lit(0))).alias("overall")).withColumn("prior_votes", F.lit(prior))


def dim_group(directory: DataFrame, *inferred: DataFrame) -> DataFrame:
    """Groups of the directory, those that only other tables mention (name: the least), and the
    unknown member.  Every frame has group_key and group_name."""
    known = directory.groupBy("group_key").agg(F.min("group_name").alias("group_name")).withColumn("in_directory", F.lit(True))
    rest = None
    for df in inferred:
        rows = df.select("group_key", "group_name").where("group_key is not null")
        rest = rows if rest is None else rest.unionByName(rows)
    out = known
    if rest is not None:
        found = rest.join(known.select("group_key"), "group_key", "left_anti").groupBy("group_key").agg(F.min("group_name").alias("group_name"))
        out = out.unionByName(found.withColumn("in_directory", F.lit(False)))
    rows = out.select(surrogate_key(F.col("group_key")).alias("group_sk"), "group_key", "group_name", "in_directory")
    none = directory.sparkSession.range(1).select(F.lit(UNKNOWN_KEY), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(False))
    return rows.union(none)


def dim_item(detailed: DataFrame, listings: DataFrame) -> DataFrame:
    """Detailed items with their listing's collection, and items that are listed only."""
    listed = listings.groupBy("item_key").agg(F.min("collection").alias("collection"), F.min("name").alias("listed_name"))
    d = detailed.join(listed, "item_key", "left").select("item_key", "name", "collection", F.lit(True).alias("is_detailed"))
    only = listed.join(detailed.select("item_key"), "item_key", "left_anti").select("item_key", F.col("listed_name").alias("name"), "collection", F.lit(False).alias("is_detailed"))
    return d.unionByName(only).select(surrogate_key(F.col("item_key")).alias("item_sk"), "item_key", "name", "collection", "is_detailed")


def dim_value(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per distinct non-null value, under its surrogate key."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias(name)).distinct().select(surrogate_key(F.col(name)).alias("sk"), name)


def dim_occasion(axes: DataFrame) -> DataFrame:
    kind = F.when(F.col("axis").isin("day", "night"), "daynight").when(F.col("axis").isin(*AXIS_ORDER), "season").otherwise("other")
    rows = axes.where("axis is not null").select("axis").distinct()
    return rows.select(surrogate_key(F.col("axis")).alias("sk"), "axis", kind.alias("kind"), F.coalesce(lookup(F.col("axis"), AXIS_ORDER), F.lit(99)).alias("sort_order"))


def dim_date(df: DataFrame, stamp: str) -> DataFrame:
    """Every day from the first to the last stamp."""
    ends = df.agg(F.min(F.to_date(stamp)).alias("a"), F.max(F.to_date(stamp)).alias("b")).where("a is not null")
    d = F.col("date")
    return ends.select(F.explode(F.sequence("a", "b")).alias("date")).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"), "date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("iso_week"), (F.weekday(d) + 1).alias("iso_weekday"), (F.weekday(d) >= 5).alias("is_weekend"),
    )


def fact(df: DataFrame, keys: dict[str, str], *measures: str) -> DataFrame:
    """A fact's surrogate keys ({fact column: natural key column}) and its measures."""
    return df.select(*(surrogate_key(F.col(c)).alias(name) for name, c in keys.items()), *measures)


def snapshots(df: DataFrame, key: str, stamp: str, measures: dict[str, int]) -> DataFrame:
    """Changes of each measure (rounded to its digits) against the key's snapshot before, null for the
    first one, and whether a snapshot is the key's latest."""
    by = Window.partitionBy(key).orderBy(stamp)
    deltas = {f"{m}_delta": rounded(F.col(m) - F.lag(m).over(by), n) for m, n in measures.items()}
    newest = F.row_number().over(Window.partitionBy(key).orderBy(F.col(stamp).desc())) == 1
    return df.withColumns(deltas | {"is_latest": newest})
