"""Normalising, deduplicating, typing and flattening raw records into typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larkspur.functions.exprs import gender_label, to_double, to_int, url_key

from .places import with_place

SEASON_AXES = ("winter", "spring", "summer", "fall")
DAY_AXES = ("day", "night")
LAYERS = ("top", "middle", "base", "general")

ITEM_SCHEMA = (
    "url string, des_url string, perfume_id string, name string, brand string, gender string, fragrance_family string, longevity string, sillage string, "
    "description string, image string, scraped_at string, year string, rating string, rating_count string, "
    "accords array<struct<name:string,width:double,opacity:double,color:string>>, top_notes array<string>, middle_notes array<string>, base_notes array<string>, "
    "general_notes array<string>, perfumers array<string>, when_to_wear array<struct<name:string,percent:double,votes:bigint,votes_label:string>>, "
    "brand_url string, brand_name string, alphabet string, popular_rank string, perfume_url string, perfume_name string, collection string, collection_anchor string, comments string"
)


def latest(df: DataFrame, key: Column | str, stamp: str, *order: Column | str) -> DataFrame:
    """The newest row per key; equal stamps fall to the largest of `order`.

    Stamps are compared by their own type, numbers as numbers; null ones are the oldest, beside empty
    texts where the stamp is a text.

    Rows with a null or empty key go.  The window's group limit keeps one row per key and task
    before the shuffle, so a key with many versions is not gathered whole.
    """
    k = F.col(key) if isinstance(key, str) else key
    of = F.coalesce(F.col(stamp), F.lit("")) if isinstance(df.schema[stamp].dataType, StringType) else F.col(stamp)
    by = [of.desc_nulls_last(), *((F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order)]
    rows = df.withColumn("__key", k.cast("string")).where("__key <> ''")
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("__key").orderBy(*by))).where("__n = 1").drop("__key", "__n")


def first_on_tie(df: DataFrame, key: str, stamp: str, *order: Column | str) -> DataFrame:
    """As `latest`, but of equal rows the first by `order` stays."""
    by = [F.col(stamp).desc_nulls_last(), *order]
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*by))).where("__n = 1").drop("__n")


def history(df: DataFrame, key: str, stamp: str, *order: str) -> DataFrame:
    """One row per key and stamp, the last by `order`; rows without either go."""
    rows = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "") & F.col(stamp).isNotNull())
    by = [F.col(o).desc_nulls_last() for o in order]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key, stamp).orderBy(*by))).where("__n = 1").drop("__n")


def flat_attributes(df: DataFrame, key: str = "item", column: str = "accords") -> DataFrame:
    """(key, name, width, opacity, rank): rank is the place in the record, nameless ones go."""
    rows = df.select(key, F.posexplode(column).alias("rank", "a"))
    return rows.where("a.name is not null and a.name <> ''").select(key, F.col("a.name").alias("name"), "a.width", "a.opacity", "rank")


def flat_tags(df: DataFrame, key: str = "item", layers: dict[str, str] | None = None) -> DataFrame:
    """(key, layer, tag, position) from one array column per layer."""
    layers = layers or {x: f"{x}_notes" for x in LAYERS}
    empty = F.array().cast("array<string>")

    def rows(layer: str, column: str) -> Column:
        row = lambda t, i: F.struct(F.lit(layer).alias("layer"), t.alias("tag"), i.alias("position"))
        return F.transform(F.coalesce(F.col(column), empty), row)

    return df.select(key, F.inline(F.concat(*(rows(x, c) for x, c in layers.items())))).where("tag is not null and tag <> ''")


def axis_kind(axis: Column) -> Column:
    return F.when(axis.isin(*SEASON_AXES), "season").when(axis.isin(*DAY_AXES), "daynight").otherwise("other")


def flat_axes(df: DataFrame, key: str = "item", column: str = "when_to_wear") -> DataFrame:
    rows = df.select(key, F.explode(column).alias("w"))
    axis = F.lower(F.trim("w.name"))
    return rows.select(key, axis.alias("axis"), axis_kind(axis).alias("kind"), "w.percent", "w.votes").where("axis <> ''")


def group_rows(raw: DataFrame) -> DataFrame:
    return raw.select(url_key(F.col("brand_url")).alias("brand_key"), "brand_url", "brand_name", "alphabet", to_int(F.col("popular_rank")).alias("popular_rank"), "scraped_at")


def listing_rows(raw: DataFrame) -> DataFrame:
    return raw.select(
        url_key(F.col("perfume_url")).alias("perfume_key"), "perfume_url", url_key(F.col("brand_url")).alias("brand_key"), "brand_name", "perfume_name", "collection",
        to_int(F.col("year")).alias("year"), gender_label(F.col("gender")).alias("gender"), F.col("comments").try_cast("bigint").alias("comments"),
    )


def item_rows(raw: DataFrame, groups: DataFrame, listings: DataFrame) -> DataFrame:
    """Typed item rows with their group's key: the listing's, else that of the exact group name."""
    own = raw.withColumn("perfume_key", url_key(F.col("url")))
    keyed = resolve_group(own, "perfume_key", "brand", listings.select("perfume_key", "brand_key"), groups.select("brand_name", "brand_key"))
    return keyed.select(
        "perfume_key", "url", "perfume_id", "name", "brand", "brand_key", gender_label(F.col("gender")).alias("gender"), to_int(F.col("year")).alias("year"), "fragrance_family",
        to_double(F.col("rating")).alias("rating"), F.col("rating_count").try_cast("bigint").alias("rating_count"), "longevity", "sillage", "description", "image",
        url_key(F.col("des_url")).alias("des_key"), "scraped_at",
    )


def resolve_group(items: DataFrame, key: str, name: str, listings: DataFrame, groups: DataFrame, group_key: str = "brand_key", group_name: str = "brand_name") -> DataFrame:
    """Adds the group's key by trust: what the item's listing says, else the group of that exact name."""
    a = listings.groupBy(key).agg(F.min(F.nullif(F.col(group_key), F.lit(""))).alias("__by_item"))
    b = groups.groupBy(F.col(group_name).alias(name)).agg(F.min(group_key).alias("__by_name"))
    return items.join(a, key, "left").join(b, name, "left").withColumn(group_key, F.coalesce("__by_item", "__by_name")).drop("__by_item", "__by_name")


def analysis_rows(df: DataFrame) -> DataFrame:
    """Records with maps: attribute to strength, axis to percent (the last of repeated names counts,
    missing numbers are zero), and all tags in layer order."""
    none = F.array().cast("array<string>")
    tags = F.filter(F.concat(*(F.coalesce(F.col(f"{x}_notes"), none) for x in LAYERS)), lambda t: t.isNotNull() & (t != ""))
    return df.withColumns({"attributes": _last_wins("accords", "width"), "axes": _last_wins("when_to_wear", "percent"), "tags": tags})


def _last_wins(column: str, value: str) -> Column:
    """Map of an array's names to their values, the last entry of a name counting."""
    pairs = F.transform(F.filter(column, lambda x: x["name"].isNotNull()), lambda x: F.struct(x["name"].alias("k"), F.coalesce(x[value], F.lit(0.0)).alias("v")))
    names = lambda a: F.transform(a, lambda x: x["k"])
    kept = F.filter(pairs, lambda x, i: F.coalesce(~F.array_contains(names(F.slice(pairs, i + 2, F.size(pairs))), x["k"]), F.lit(True)))
    return F.coalesce(F.map_from_entries(kept), F.create_map().cast("map<string,double>"))


def merged_directory(df: DataFrame, key: str, priority: str, columns: list[str]) -> DataFrame:
    """One row per key with each column's first non-null value in order of priority."""
    firsts = [F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(priority))).alias(c) for c in columns]
    return df.where(F.col(key) != "").groupBy(key).agg(*firsts)


def in_directory_order(df: DataFrame, letter: str, name: str) -> DataFrame:
    """By letter, those without one last, then by name in any case."""
    return df.orderBy(*_directory_order(letter, name))


def _directory_order(letter: str, name: str) -> list[Column]:
    return [F.col(letter).asc_nulls_last(), F.lower(F.coalesce(F.col(name), F.lit(""))).asc()]


def directory_places(df: DataFrame, letter: str, name: str, *ties: str) -> DataFrame:
    """The directory with each row's place in its order, equal names by `ties`."""
    return with_place(df, [*_directory_order(letter, name), *ties])


def name_keys(groups: DataFrame, listings: DataFrame, name: str, key: str, order: str) -> DataFrame:
    """lower(trim(name)) to key: the first by order among groups, listings' names as fallback."""
    n = F.lower(F.trim(name)).alias("name")
    rows = groups.select(n, F.col(key).alias("key"), F.struct(F.lit(0), F.col(order).cast("string"), F.col(key).cast("string")).alias("o"))
    rows = rows.unionByName(listings.select(n, F.col(key).alias("key"), F.struct(F.lit(1), F.col(order).cast("string"), F.col(key).cast("string")).alias("o")))
    return rows.where("name <> '' and key is not null").groupBy("name").agg(F.min_by("key", "o").alias("key"))


def fill_name(df: DataFrame, directory: DataFrame, key: str, name: str) -> DataFrame:
    known = directory.groupBy(key).agg(F.min(name).alias("__name"))
    return df.join(known, key, "left").withColumn(name, F.coalesce(F.nullif(F.col(name), F.lit("")), "__name")).drop("__name")


def enriched(wanted: DataFrame, records: DataFrame, key: str, dest: str, position: str, override: str | None = None) -> DataFrame:
    """Wanted (key, destination) pairs with the record of their key, in list order, each pair once;
    `override` is a record column that the destination replaces."""
    by = Window.partitionBy(key, dest).orderBy(position)
    once = wanted.withColumn("__n", F.row_number().over(by)).where("__n = 1").drop("__n")
    out = once.join(records, key, "inner")
    return (out.withColumn(override, F.coalesce(F.col(dest), F.col(override))) if override else out).orderBy(position)


def unmatched(wanted: DataFrame, records: DataFrame, key: str) -> DataFrame:
    return wanted.join(records.select(key), key, "left_anti").select(key).distinct()


def not_yet_done(wanted: DataFrame, done: DataFrame, column: str, done_column: str | None = None) -> DataFrame:
    """Resume filter: rows whose normalised key the output does not have."""
    have = done.select(url_key(F.col(done_column or column)).alias("__k")).distinct()
    return wanted.withColumn("__k", url_key(F.col(column))).join(have, "__k", "left_anti").drop("__k")


def usable(items: DataFrame, attributes: DataFrame, tags: DataFrame, key: str = "item") -> DataFrame:
    """Items with at least one attribute or tag."""
    return items.join(attributes.select(key).union(tags.select(key)).distinct(), key, "left_semi")
