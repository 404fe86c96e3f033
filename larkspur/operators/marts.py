"""Vote-weighted marts over items, attributes, tags and occasions.

Items carry `item`, `grp` (group), `rating`, `votes`; attributes `item`, `attribute`, `strength`;
axes `item`, `axis`, `pct`.  Aggregates combine in each task before their shuffle; the one-row
common mean is the only thing cross-joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.exprs import PRIOR_VOTES, divergence_bin, ratio, rounded, shrunk

from .places import with_place

SEASONS = ("winter", "spring", "summer", "fall")
Z_FLOOR = 3.0


def _votes() -> Column:
    return F.coalesce("votes", F.lit(0))


def _rated() -> Column:
    return F.col("rating").isNotNull() & (F.col("rating") > 0)


def common_mean(items: DataFrame, digits: int | None = None) -> DataFrame:
    """One row `common`: vote-weighted mean of the rated items, the plain mean if nobody voted."""
    w = ratio(F.sum(F.when(_rated(), F.col("rating") * _votes())), F.sum(F.when(_rated(), _votes())))
    mean = F.coalesce(w, F.avg(F.when(_rated(), F.col("rating"))))
    return items.agg((rounded(mean, digits) if digits else mean).alias("common"))


def _measures() -> list[Column]:
    return [
        F.count("*").alias("n_items"),
        F.sum(_votes()).alias("n_votes"),
        F.avg("rating").alias("mean"),
        F.sum(F.when(_rated(), F.col("rating") * _votes())).alias("weight"),
        F.sum(F.when(_rated(), _votes())).alias("rated_votes"),
        F.sum(F.when(_rated(), 1).otherwise(0)).alias("n_rated"),
    ]


def _score(prior: float, strict: bool) -> Column:
    """Shrunk rating; `strict` leaves a group without rated items null instead of the common mean."""
    s = rounded(shrunk(ratio(F.col("weight"), F.col("rated_votes")), F.col("rated_votes"), F.col("common"), prior), 3)
    return F.when(F.col("n_rated") > 0, s) if strict else s


def by_group(items: DataFrame, share_of_all: bool = False, prior: float = PRIOR_VOTES) -> DataFrame:
    """Size, attention share, mean and shrunk rating of each group.

    Shares are of the votes in groups, or of all votes with `share_of_all`, which also rounds the
    common mean first and leaves groups without ratings null (the second computation path).
    """
    groups = items.where(F.col("grp").isNotNull()).groupBy("grp").agg(*_measures())
    common = common_mean(items if share_of_all else items.where(F.col("grp").isNotNull()), 3 if share_of_all else None)
    total = items.agg(F.sum(_votes()).alias("total")) if share_of_all else groups.agg(F.sum("n_votes").alias("total"))
    rows = groups.crossJoin(F.broadcast(common)).crossJoin(F.broadcast(total))
    return rows.select(
        "grp",
        "n_items",
        "n_votes",
        rounded(ratio(100.0 * F.col("n_votes"), F.col("total")), 2).alias("share_pct"),
        rounded(F.col("mean"), 3).alias("rating_avg"),
        _score(prior, share_of_all).alias("rating_weighted"),
    )


def by_attribute(items: DataFrame, attributes: DataFrame, missing_as_zero: bool = False, prior: float = PRIOR_VOTES) -> DataFrame:
    """Coverage, mean strength and shrunk rating of each attribute."""
    strength = F.coalesce("strength", F.lit(0.0)) if missing_as_zero else F.col("strength")
    once = attributes.groupBy("attribute", "item").agg(F.avg(strength).alias("strength"))
    groups = once.join(items.select("item", "rating", "votes"), "item").groupBy("attribute").agg(*_measures(), F.avg("strength").alias("strength"))
    ones = common_mean(items, 3 if missing_as_zero else None).crossJoin(items.agg(F.count("*").alias("all_items")))
    return groups.crossJoin(F.broadcast(ones)).select(
        "attribute",
        "n_items",
        rounded(ratio(100.0 * F.col("n_items"), F.col("all_items")), 2).alias("coverage_pct"),
        rounded(F.col("strength"), 3).alias("avg_strength"),
        _score(prior, missing_as_zero).alias("rating_weighted"),
        "n_votes",
    )


def by_label(items: DataFrame, column: str, prior: float = PRIOR_VOTES) -> DataFrame:
    """Count, share, shrunk rating and votes per value of a column of the items."""
    groups = items.where(F.col(column).isNotNull()).groupBy(column).agg(*_measures())
    ones = common_mean(items, 3).crossJoin(items.agg(F.count("*").alias("all_items")))
    return groups.crossJoin(F.broadcast(ones)).select(
        column, "n_items", rounded(100.0 * F.col("n_items") / F.col("all_items"), 2).alias("share_pct"), _score(prior, True).alias("rating_weighted"), "n_votes"
    )


def top_axis(axes: DataFrame, order: tuple[str, ...] = SEASONS) -> DataFrame:
    """Each item's strongest axis; of equal ones the first in `order`."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("axis"))
    return axes.where(F.col("axis").isin(*order) & F.col("pct").isNotNull()).groupBy("item").agg(F.max_by("axis", F.struct("pct", -place)).alias("top_axis"))


def by_season(items: DataFrame, axes: DataFrame, prior: float = PRIOR_VOTES) -> DataFrame:
    """by_label over each voted item's strongest season."""
    return by_label(items.join(top_axis(axes), "item"), "top_axis", prior).drop("n_votes")


def attribute_axis(attributes: DataFrame, axes: DataFrame, floor: float = Z_FLOOR) -> DataFrame:
    """Mean percentage per attribute and axis, and how far it stands from its axis's mean."""
    names = attributes.select("item", "attribute").distinct()
    cells = names.join(axes.where("pct is not null"), "item").groupBy("attribute", "axis").agg(F.avg("pct").alias("mean"), F.count_distinct("item").alias("n_items"))
    base = cells.groupBy("axis").agg(F.avg("mean").alias("axis_mean"), F.stddev_pop("mean").alias("axis_sd"))
    off = F.col("mean") - F.col("axis_mean")
    return cells.join(F.broadcast(base), "axis").select(  # one row per axis
        "attribute",
        "axis",
        "n_items",
        rounded(F.col("mean"), 1).alias("pct_vote"),
        rounded(off, 1).alias("delta_vs_axis"),
        rounded(off / F.greatest("axis_sd", F.lit(floor)), 2).alias("z_score"),
    )


def coverage(catalogue: DataFrame, items: DataFrame) -> DataFrame:
    """Per group: catalogue size, items with detail and their share.  A group that the catalogue
    does not have keeps an unknown (null) size and share, which is not a share of zero."""
    sizes = catalogue.where("grp is not null").groupBy("grp").agg(F.count("*").alias("catalogue_items"))
    done = items.where("grp is not null").groupBy("grp").agg(F.count("*").alias("detailed"), F.sum(_votes()).alias("n_votes"))
    n = F.coalesce("detailed", F.lit(0))
    return sizes.join(done, "grp", "full_outer").select(
        "grp", "catalogue_items", n.alias("detailed"), rounded(100.0 * n / F.col("catalogue_items"), 1).alias("coverage_pct"), F.coalesce("n_votes", F.lit(0)).alias("n_votes")
    )


def coverage_by_key(groups: DataFrame, listings: DataFrame, items: DataFrame) -> DataFrame:
    """`coverage` by the catalogue's own keys: a group's size is that of the listing under its key, which its
    name leads to; without a key or with an empty listing it is unknown.

    groups: name, key; listings: key, grp (the group's name in the listing); items: grp, votes.
    """
    sizes = listings.where("key is not null").groupBy("key").agg(F.count("*").alias("total"), F.min("grp").alias("grp"))
    done = items.where("grp is not null").groupBy("grp").agg(F.count("*").alias("detailed"), F.sum(_votes()).alias("n_votes"))
    names = done.select("grp").union(sizes.select("grp").where("grp is not null")).distinct()
    keys = groups.where("name is not null").groupBy(F.col("name").alias("grp")).agg(F.min("key").alias("key"))
    n = F.coalesce("detailed", F.lit(0))
    rows = names.join(keys, "grp", "left").join(sizes.select("key", "total"), "key", "left").join(done, "grp", "left")
    share = rounded(100.0 * n / F.col("total"), 1)
    return rows.select("grp", F.col("total").alias("catalogue_items"), n.alias("detailed"), share.alias("coverage_pct"), F.coalesce("n_votes", F.lit(0)).alias("n_votes"))


#: Tags of a set that are paired in one row; larger sets are paired in blocks of so many.
PAIRED = 256


def tag_pairs(tags: DataFrame, least: int = 2, item: str = "item", tag: str = "tag") -> DataFrame:
    """P(b | a) of tags that `least` items or more have; rows for a and b both ways.

    Items' distinct tags are gathered once per item, items with the same tags become one set with their
    number, and the tags of a set are paired inside it: the work follows the tags of the distinct sets, not the
    items per tag.  Sets of more than PAIRED tags are paired block by block, and the pairs of blocks dealt over
    the tasks.
    """
    once = tags.select(F.col(item).alias("item"), F.col(tag).alias("tag")).where("tag is not null").distinct()
    n = once.groupBy("tag").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    kept = once.join(n.select("tag"), "tag").groupBy("item").agg(F.sort_array(F.collect_list("tag")).alias("all"))
    sets = kept.groupBy("all").agg(F.count("*").alias("items"))
    small = sets.where(F.size("all") <= PAIRED).select(F.col("all").alias("left"), F.col("all").alias("right"), "items")
    large = sets.where(F.size("all") > PAIRED).withColumn("blocks", F.ceil(F.size("all") / PAIRED).cast("int"))
    block = lambda i: F.slice("all", F.col(i) * PAIRED + 1, F.lit(PAIRED))
    each = F.sequence(F.lit(0), F.col("blocks") - 1)
    large = large.select("all", "items", "blocks", F.explode(each).alias("i")).select("all", "items", "i", F.explode(each).alias("j"))
    large = large.select(block("i").alias("left"), block("j").alias("right"), "items", F.xxhash64("all").alias("set"), "i", "j")
    large = large.repartition("set", "i", "j").select("left", "right", "items")
    pairs = small.unionByName(large).select(F.explode("left").alias("tag_a"), "right", "items")
    pairs = pairs.select("tag_a", F.explode("right").alias("tag_b"), "items").where("tag_a <> tag_b")
    together = pairs.groupBy("tag_a", "tag_b").agg(F.sum("items").alias("together"))
    return together.join(n.toDF("tag_a", "items_with_a"), "tag_a").select(
        "tag_a", "tag_b", "items_with_a", "together", rounded(100.0 * F.col("together") / F.col("items_with_a"), 1).alias("pct_b_given_a")
    )


def most_used(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k commonest values with their counts, equal counts by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def tag_matrix(tags: DataFrame, k: int = 16) -> DataFrame:
    """tag_pairs among the k commonest tags, with the empty diagonal."""
    top = F.broadcast(most_used(tags.select("item", "tag").distinct(), "tag", k).select("tag"))
    pairs = tag_pairs(tags.join(top, "tag"), 1).select("tag_a", "tag_b", "pct_b_given_a")
    own = top.select(F.col("tag").alias("tag_a"), F.col("tag").alias("tag_b"), F.lit(None).cast("double").alias("pct_b_given_a"))
    return pairs.unionByName(own)


def attribute_grid(attributes: DataFrame, axes: DataFrame, k: int = 14, order: tuple[str, ...] = SEASONS) -> DataFrame:
    """The k commonest attributes by axis: mean percentage and divergence bin, one column each per axis."""
    top = F.broadcast(most_used(attributes.select("item", "attribute").distinct(), "attribute", k).select("attribute"))
    cells = attribute_axis(attributes.join(top, "attribute"), axes)
    grid = cells.groupBy("attribute").pivot("axis", list(order)).agg(F.first("pct_vote").alias("pct"), F.first(divergence_bin(F.col("z_score"))).alias("bin"))
    return grid


def positioning(items: DataFrame, k: int = 40) -> DataFrame:
    """The k groups with most votes."""
    rows = by_group(items).where("n_votes > 0").select("grp", "n_votes", "rating_weighted", "n_items")
    return rows.orderBy(F.desc("n_votes"), "grp").limit(k)


def ordinal_share(attributes: DataFrame, levels: DataFrame, order: list[str], k: int = 10) -> DataFrame:
    """Percent of each level among the items of the k commonest attributes whose level is known."""
    top = F.broadcast(most_used(attributes.select("item", "attribute").distinct(), "attribute", k).select("attribute"))
    rows = attributes.select("item", "attribute").distinct().join(top, "attribute").join(levels, "item").where(F.col("level").isin(order))
    grid = rows.groupBy("attribute").pivot("level", order).count().na.fill(0)
    total = sum((F.col(x) for x in order), F.lit(0))
    return grid.select("attribute", *(rounded(100.0 * F.col(x) / total, 1).alias(x) for x in order), total.cast("long").alias("n_known"))


def per_year(items: DataFrame, label: str, values: list[str], start: int, default: str) -> DataFrame:
    """Items per year from `start` on, a column per label; null labels count as the default."""
    rows = items.where(F.col("year") >= start).withColumn("label", F.coalesce(F.col(label), F.lit(default)))
    return rows.groupBy("year").pivot("label", values).count().na.fill(0)


def excluded_years(items: DataFrame, start: int) -> DataFrame:
    return items.agg(F.count_if(F.col("year").isNull()).alias("no_year"), F.count_if(F.col("year") < start).alias("before"))


def overview(items: DataFrame, axes: DataFrame) -> DataFrame:
    """Seven counts in one row."""
    with_axis = axes.select("item").distinct().withColumn("has_axis", F.lit(True))
    return items.join(with_axis, "item", "left").agg(
        F.count("*").alias("n_items"),
        F.count_distinct("grp").alias("n_groups"),
        F.count_if(_rated()).alias("n_rated"),
        F.sum(_votes()).alias("n_votes"),
        F.count_if(F.coalesce("has_axis", F.lit(False))).alias("with_axis"),
        F.count_if(F.col("level").isNotNull()).alias("with_level"),
        F.count_if(F.col("owners").isNotNull()).alias("with_owners"),
    )


def headline(items: DataFrame, attributes: DataFrame, tags: DataFrame, catalogue: DataFrame) -> DataFrame:
    a = items.agg(F.count("*").alias("n_items"), F.count_distinct("grp").alias("n_groups"), F.sum(_votes()).alias("n_votes"))
    b = attributes.agg(F.count_distinct("attribute").alias("n_attributes"))
    c = tags.agg(F.count_distinct("tag").alias("n_tags"))
    d = catalogue.agg(F.count("*").alias("n_catalogue"))
    one = a.crossJoin(b).crossJoin(c).crossJoin(d)  # one row each
    return one.withColumn("coverage_pct", rounded(ratio(100.0 * F.col("n_items"), F.col("n_catalogue")), 1)).drop("n_catalogue")


#: Metric plug-ins: a name and a function of a catalogue's tables, a dict of DataFrames.
METRICS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "group": lambda t: by_group(t["items"], share_of_all=True),
    "attribute": lambda t: by_attribute(t["items"], t["attributes"], missing_as_zero=True),
    "gender": lambda t: by_label(t["items"], "gender"),
    "season": lambda t: by_season(t["items"], t["axes"]),
}
_MAIN = {"group": "n_votes", "attribute": "n_items", "gender": "n_items", "season": "n_items"}


def run_metrics(tables: dict[str, DataFrame], names: list[str] | None = None) -> dict[str, DataFrame]:
    """All metrics, or those named, by descending main measure; an unknown name is an error."""
    unknown = set(names or ()) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}; there are {sorted(METRICS)}")
    return {n: in_order(METRICS[n](tables), _MAIN.get(n)) for n in names or METRICS}


def in_order(df: DataFrame, main: str | None) -> DataFrame:
    """Descending by the main measure, null as zero, then by the first column."""
    return df.orderBy(*_order(df, main)) if main else df


def _order(df: DataFrame, main: str) -> list[Column]:
    return [F.coalesce(F.col(main), F.lit(0)).desc(), F.col(df.columns[0]).asc()]


def placed(df: DataFrame, main: str) -> DataFrame:
    """A metric with each row's place in its order, which a stored table does not keep otherwise."""
    return with_place(df, _order(df, main))


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One JSON text: the overview and the number of rows of each metric."""
    counts = None
    for name, df in run_metrics(tables).items():
        row = df.agg(F.lit(name).alias("metric"), F.count("*").alias("rows"))
        counts = row if counts is None else counts.unionByName(row)
    folded = counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "rows")))).alias("rows"))
    view = overview(tables["items"], tables["axes"])
    return view.select(F.struct(*view.columns).alias("overview")).crossJoin(folded).select(F.to_json(F.struct("overview", "rows")).alias("value"))
