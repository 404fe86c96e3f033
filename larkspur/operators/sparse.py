"""Explainable sparse similarity on a long table of terms: (item, block, label, weight).

Cosine similarity is an equi-join on (block, label), which serves as the inverted index; terms that
too few items have are dropped and the others' weight is bounded by the IDF, which also bounds how
much the commonest terms count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.exprs import lookup

ATTRIBUTE, TAG, OCCASION, STRENGTH, FAMILY = "acc", "note", "occ", "str", "fam"
# Block weights, layer weights and the two ordinal scales.
BLOCK_WEIGHTS = {ATTRIBUTE: 1.0, TAG: 1.0, OCCASION: 0.6, STRENGTH: 0.3, FAMILY: 0.4}
LAYER_WEIGHTS = {"base": 1.0, "middle": 0.7, "general": 0.7, "top": 0.5}
LONGEVITY = {"very weak": 0.0, "weak": 0.25, "moderate": 0.5, "long lasting": 0.75, "eternal": 1.0}
SILLAGE = {"intimate": 0.0, "moderate": 1 / 3, "strong": 2 / 3, "enormous": 1.0}
SELECTIVE = (ATTRIBUTE, TAG, FAMILY)
AXES = ("winter", "spring", "summer", "fall", "day", "night")
MAX_IDF, MIN_DF = 4.0, 2


def _label(c: str):
    return F.lower(F.trim(c))


def idf(attributes: DataFrame, tags: DataFrame, min_df: int = MIN_DF, max_idf: float = MAX_IDF) -> DataFrame:
    """(block, label, df, idf) of terms that `min_df` items have; N counts the items with any term."""
    rows = attributes.select("item", F.lit(ATTRIBUTE).alias("block"), _label("attribute").alias("label")).union(tags.select("item", F.lit(TAG), _label("tag")))
    rows = rows.where("label <> ''").distinct()
    n = rows.agg(F.count_distinct("item").alias("n_items"))
    df = rows.groupBy("block", "label").agg(F.count("*").alias("df")).where(F.col("df") >= min_df)
    return df.crossJoin(F.broadcast(n)).select("block", "label", "df", F.least(F.log(F.col("n_items") / F.col("df")) + 1, F.lit(max_idf)).alias("idf"))


def blocks(attributes: DataFrame, tags: DataFrame, axes: DataFrame, levels: DataFrame, families: DataFrame, weights: DataFrame) -> DataFrame:
    """Raw weights of all five blocks; attribute and tag terms without an IDF are left out.

    levels: item, longevity, sillage; families: item, family.
    """
    a = attributes.select("item", F.lit(ATTRIBUTE).alias("block"), _label("attribute").alias("label"), (F.coalesce("strength", F.lit(0.0)) / 100).alias("raw"))
    t = tags.select("item", F.lit(TAG).alias("block"), _label("tag").alias("label"), F.coalesce(lookup(F.col("layer"), LAYER_WEIGHTS), F.lit(0.7)).alias("raw"))
    terms = a.union(t).groupBy("item", "block", "label").agg(F.max("raw").alias("raw")).join(weights, ["block", "label"])
    terms = terms.select("item", "block", "label", (F.col("raw") * F.col("idf")).alias("weight"))
    occasion = axes.where(F.col("axis").isin(*AXES)).select("item", F.lit(OCCASION), "axis", F.coalesce("pct", F.lit(0.0)) / 100)
    scale = lambda c, s: levels.select("item", F.lit(STRENGTH), F.lit(c), lookup(F.lower(F.trim(c)), s).alias("w")).where("w is not null")
    family = families.where("family is not null").select("item", F.lit(FAMILY), _label("family"), F.lit(1.0))
    return terms.union(occasion).union(scale("longevity", LONGEVITY)).union(scale("sillage", SILLAGE)).union(family)


def combined(terms: DataFrame, key: str = "item", weights: dict[str, float] | None = None) -> DataFrame:
    """Each block to unit length, times its block's weight, then the whole to unit length."""
    w = lookup(F.col("block"), weights or BLOCK_WEIGHTS)
    block = F.sqrt(F.sum(F.col("weight") ** 2).over(Window.partitionBy(key, "block")))
    rows = terms.withColumn("weight", F.col("weight") / F.nullif(block, F.lit(0.0)) * w).where("weight is not null")
    return unit(rows, key)


def unit(terms: DataFrame, key: str = "item") -> DataFrame:
    whole = F.sqrt(F.sum(F.col("weight") ** 2).over(Window.partitionBy(key)))
    return terms.withColumn("weight", F.col("weight") / F.nullif(whole, F.lit(0.0))).where("weight is not null")


def only_blocks(terms: DataFrame, keep: tuple[str, ...] = SELECTIVE, key: str = "item") -> DataFrame:
    return unit(terms.where(F.col("block").isin(*keep)), key)


def contributions(queries: DataFrame, terms: DataFrame) -> DataFrame:
    """(query, item, block, label, product) on shared terms; queries: query, block, label, weight."""
    q = queries.select("query", "block", "label", F.col("weight").alias("qw"))
    return q.join(terms, ["block", "label"]).select("query", "item", "block", "label", (F.col("qw") * F.col("weight")).alias("product"))


def page_contributions(page: DataFrame, queries: DataFrame, terms: DataFrame) -> DataFrame:
    """`contributions` of the results of a page (query, item) alone."""
    q = page.join(queries.select("query", "block", "label", F.col("weight").alias("qw")), "query")
    return q.join(terms, ["item", "block", "label"]).select("query", "item", "block", "label", (F.col("qw") * F.col("weight")).alias("product"))


def cosine(queries: DataFrame, terms: DataFrame) -> DataFrame:
    return contributions(queries, terms).groupBy("query", "item").agg(F.sum("product").alias("score"))


def explained(parts: DataFrame, k: int = 5) -> DataFrame:
    """The k terms that add most to each score."""
    by = Window.partitionBy("query", "item").orderBy(F.desc(F.round("product", 9)), "block", "label")
    return parts.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def centroids(terms: DataFrame, groups: DataFrame, least: int = 1) -> DataFrame:
    """Mean of the unit smell vectors of each group's items, to unit length; groups: item, grp."""
    smell = only_blocks(terms)
    sizes = smell.select("item").distinct().join(groups, "item").groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    sums = smell.join(groups, "item").groupBy("grp", "block", "label").agg(F.sum("weight").alias("weight"))
    means = sums.join(sizes, "grp").select("grp", "block", "label", (F.col("weight") / F.col("n")).alias("weight"))
    return unit(means, "grp")


def similar_groups(profiles: DataFrame, k: int | None = None, asked: DataFrame | None = None) -> DataFrame:
    """(query, item, score, rank): the k groups nearest to each group that share a term with it, by cosine;
    a group is not like itself.  `asked` (query: a group's name) bounds the queries.

    Pass profiles that are stored: they are read twice.
    """
    q = profiles.withColumnRenamed("grp", "query")
    if asked is not None:
        q = q.join(asked.select("query").distinct(), "query", "left_semi")
    rows = cosine(q, profiles.withColumnRenamed("grp", "item")).where("query <> item and score > 0")
    by = Window.partitionBy("query").orderBy(F.desc(F.round("score", 9)), "item")
    rows = rows.withColumn("rank", F.row_number().over(by))
    return rows if k is None else rows.where(F.col("rank") <= k)


def named_groups(asked: DataFrame, groups: DataFrame) -> DataFrame:
    """(text, grp): the group that each asked text names, in any case: the one of that name, else the first
    by name that contains it; null without one.  asked: text; groups: grp."""
    names = groups.select("grp", F.lower("grp").alias("label")).distinct()
    a = asked.select("text", F.lower(F.trim("text")).alias("part")).distinct()
    hit = a.join(containing(a.select("part").where("part <> ''").distinct(), names), "part")
    best = hit.groupBy("text").agg(F.min_by("grp", F.struct(F.when(F.col("label") == F.col("part"), 0).otherwise(1), "grp")).alias("grp"))
    return asked.select("text").distinct().join(best, "text", "left")


#: Parts of words are looked up by a gram of so many letters.
GRAM = 3
#: Most results that a look-up in the dense store gives.
DENSE_LOOKUP = 10


def _grams(text: str, n: int = GRAM):
    """The distinct grams of a column; none of a text that is shorter."""
    places = F.sequence(F.lit(1), F.length(text) - (n - 1))
    each = F.transform(places, lambda i: F.substring(F.col(text), i, F.lit(n)))
    return F.when(F.length(text) >= n, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))


def containing(parts: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `labels` (label, ...) with each row of `parts` (part) that the label contains; empty parts are in none.

    A part of GRAM letters or more is looked up under the rarest of its grams.  Only grams that some part is
    looked up by are taken from the labels: a label gives one row for each such gram it holds, so a gram that
    is in most labels makes rows only if a part has no rarer one.  Shorter parts are looked up under themselves, among the
    labels' grams of their own length.  What meets is then compared.
    """
    p = parts.where("part <> ''")
    long = p.where(F.length("part") >= GRAM)
    # grams of the parts, how many labels have each, and each part's rarest
    wanted = long.select("part", F.explode(_grams("part")).alias("__gram"))
    asked = wanted.select("__gram").distinct()
    in_labels = labels.select("label").distinct().select(F.explode(_grams("label")).alias("__gram"))
    uses = in_labels.join(asked, "__gram", "left_semi").groupBy("__gram").agg(F.count("*").alias("__df"))
    rarest = wanted.join(uses, "__gram", "left").groupBy("part").agg(F.min_by("__gram", F.struct(F.coalesce("__df", F.lit(0)), "__gram")).alias("__gram"))
    keyed = long.join(rarest, "part").withColumn("__n", F.lit(GRAM))
    keyed = keyed.unionByName(p.where(F.length("part") < GRAM).withColumns({"__gram": F.col("part"), "__n": F.length("part")}))
    keys = keyed.select("__n", "__gram").distinct()
    # labels give rows for the keys that they hold: the filter comes before anything else is shuffled
    own = None
    for n in range(1, GRAM + 1):
        of = labels.withColumn("__gram", F.explode(_grams("label", n))).withColumn("__n", F.lit(n))
        of = of.join(keys.where(F.col("__n") == n), ["__n", "__gram"], "left_semi")
        own = of if own is None else own.unionByName(of)
    return own.join(keyed, ["__n", "__gram"]).where(F.contains("label", "part")).drop("__gram", "__n")


def query_vector(wanted: DataFrame, weights: DataFrame, known_only: bool = False) -> DataFrame:
    """Unit vectors of query terms (query, block, label): IDF for attributes and tags (1 for unknown
    ones unless `known_only`), 1 for axes."""
    rows = wanted.join(weights.select("block", "label", "idf"), ["block", "label"], "left")
    if known_only:
        rows = rows.where(F.col("idf").isNotNull() | ~F.col("block").isin(ATTRIBUTE, TAG))
    return combined(rows.select("query", "block", "label", F.coalesce("idf", F.lit(1.0)).alias("weight")), "query")


def _rest(terms: DataFrame, key: str) -> DataFrame:
    """(key, a map of its weights in the blocks that select nothing): at most nine entries each."""
    rows = terms.where(~F.col("block").isin(*SELECTIVE))
    entry = F.struct(F.concat_ws(":", "block", "label"), "weight")
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias(f"{key[0]}_rest"))


def ranked(queries: DataFrame, terms: DataFrame, items: DataFrame, k: int = 10, min_votes: int = 0, exclude_own: bool = False, other_group: DataFrame | None = None) -> DataFrame:
    """The k best items per query by score, then votes, then key; only positive scores.

    Candidates share a selective term with the query; axes and strengths, which nearly all items have,
    are no join keys but a small map per item, multiplied in for candidates alone.  A query without
    selective terms is scored against every item that shares one of its others.  `items` has item, votes, grp (filters on other
    columns are filters of `items`); `other_group`: query, grp that results must not have.
    """
    chosen = F.col("block").isin(*SELECTIVE)
    selective = queries.where(chosen)
    part = cosine(selective, terms.where(chosen)).withColumnRenamed("score", "part")
    rest = F.coalesce(F.col("i_rest"), F.create_map().cast("map<string,double>"))
    other = F.aggregate(F.map_entries(F.coalesce("q_rest", F.create_map().cast("map<string,double>"))), F.lit(0.0), lambda a, e: a + e["value"] * F.coalesce(F.try_element_at(rest, e["key"]), F.lit(0.0)))
    narrow = part.join(_rest(queries, "query"), "query", "left").join(_rest(terms, "item"), "item", "left")
    narrow = narrow.select("query", "item", (F.col("part") + other).alias("score"))
    wide = queries.join(selective.select("query").distinct(), "query", "left_anti")
    scores = narrow.union(cosine(wide, terms))
    rows = scores.where("score > 0").join(items, "item").where(F.coalesce("votes", F.lit(0)) >= min_votes)
    if exclude_own:
        rows = rows.where("query <> item")
    if other_group is not None:
        rows = rows.join(other_group.withColumnRenamed("grp", "own"), "query").where("not (grp <=> own)").drop("own")
    by = Window.partitionBy("query").orderBy(F.desc(F.round("score", 9)), F.desc(F.coalesce("votes", F.lit(0))), "item")
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def term_sum(wanted: DataFrame, terms: DataFrame, k: int = 10) -> DataFrame:
    """Sum of the stored weights over the asked terms; equal sums by key."""
    s = wanted.select("query", "block", "label").join(terms, ["block", "label"]).groupBy("query", "item").agg(F.sum("weight").alias("score"))
    by = Window.partitionBy("query").orderBy(F.desc(F.round("score", 9)), "item")
    return s.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def resolved(words: DataFrame, weights: DataFrame, exact_first: bool = True) -> DataFrame:
    """(word, block, label): the vocabulary label that each asked word (word, block) stands for: the
    exact one, else of those that contain it the commonest, then shortest; null label: missing."""
    w = words.withColumn("asked", F.lower(F.trim("word")))
    hit = containing(w.where("asked <> ''").select(F.col("asked").alias("part")).distinct(), weights.select("block", "label", "df"))
    order = [F.when(F.col("label") == F.col("asked"), 0).otherwise(1)] if exact_first else []
    order += [F.desc("df"), F.length("label"), "label"]
    rows = w.join(hit.withColumnRenamed("part", "asked"), ["asked", "block"])
    best = rows.withColumn("n", F.row_number().over(Window.partitionBy("word", "block").orderBy(*order))).where("n = 1")
    return w.select("word", "block").join(best.select("word", "block", "label"), ["word", "block"], "left")


def vocabulary(weights: DataFrame, block: str) -> DataFrame:
    if block not in BLOCK_WEIGHTS:
        raise ValueError(f"unknown block {block!r}; there are {sorted(BLOCK_WEIGHTS)}")
    return weights.where(F.col("block") == block).select("label").distinct().orderBy("label")


def lookup_items(asked: DataFrame, items: DataFrame, k: int = 8) -> DataFrame:
    """Items per asked text: the item of that key, else those whose name contains it in any case, by votes.

    asked: text; items: key, name, votes.  Null, empty and blank texts find nothing.  The dense store looks up with
    k = DENSE_LOOKUP.
    """
    a = asked.select("text", F.lower(F.trim("text")).alias("low")).where("low <> ''").distinct()
    exact = items.join(a, items["key"].cast("string") == a["low"]).select("text", "key", "name", "votes")
    rest = a.join(exact.select("text").distinct(), "text", "left_anti")
    own = items.select("key", "name", "votes", F.lower("name").alias("label"))
    like = containing(rest.select(F.col("low").alias("part")).distinct(), own)
    like = like.join(rest.withColumnRenamed("low", "part"), "part").select("text", "key", "name", "votes")
    by = Window.partitionBy("text").orderBy(F.desc(F.coalesce("votes", F.lit(0))), "key")
    return exact.union(like).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


# The labels of derived occasions and the levels that give them.
def derived_occasions(items: DataFrame) -> DataFrame:
    """Labels that follow from strength and season (longevity, sillage, summer, winter); not part of a vector."""
    lon, sil = lookup(F.lower(F.trim("longevity")), LONGEVITY), lookup(F.lower(F.trim("sillage")), SILLAGE)
    labels = F.array_compact(
        F.array(
            F.when((sil <= 1 / 3) & (lon >= 0.5), "công sở"),
            F.when((sil >= 2 / 3) & (lon >= 0.75), "tiệc tối"),
            F.when(F.col("summer") >= 80, "ngày nóng"),
            F.when(F.col("winter") >= 80, "ngày lạnh"),
        )
    )
    return items.withColumn("labels", labels)
