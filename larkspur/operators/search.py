"""Batch search: many queries as rows of a table, answered by joins.

queries: query, text, like (item key), tags, attributes (arrays), axes (array), gender, limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sparse import ATTRIBUTE, TAG, containing, resolved

TOKEN = "[0-9a-zA-ZÀ-ỹ]+"
# Phrases that name an axis, and words that carry no meaning in a search.
AXIS_PHRASES = {
    "mùa đông": "winter",
    "mùa xuân": "spring",
    "mùa hè": "summer",
    "mùa thu": "fall",
    "ban ngày": "day",
    "buổi tối": "night",
    "ban đêm": "night",
    "buổi sáng": "day",
    "mua dong": "winter",
    "mua he": "summer",
    "buoi toi": "night",
    "ban ngay": "day",
}
#: Of the phrases, those that a search's own text is read by: the ones in full spelling.
SEARCH_PHRASES = {p: a for p, a in AXIS_PHRASES.items() if not p.isascii()}
AXES = ("winter", "spring", "summer", "fall", "day", "night")
STOP_WORDS = (
    "nước", "hoa", "mùi", "chai", "cho", "của", "và", "với", "có", "nào", "gì", "một", "những", "các", "thì", "là", "đi", "dùng", "hợp", "phù",
    "tìm", "muốn", "cần", "thơm", "loại", "kiểu", "hơi", "rất", "khá",
)
MAX_SEARCH, MAX_CHAT, SHOWN_CAP = 50, 20, 50


def _some(c: str) -> Column:
    return F.size(F.coalesce(F.col(c), F.array().cast("array<string>"))) > 0


def route(queries: DataFrame) -> DataFrame:
    """Adds route: like (an item is given), terms, text, axes or empty, in this order of precedence."""
    r = F.when(F.coalesce("like", F.lit("")) != "", "like").when(_some("tags") | _some("attributes"), "terms").when(F.trim(F.coalesce("text", F.lit(""))) != "", "text").when(_some("axes"), "axes")
    return queries.withColumn("route", F.coalesce(r, F.lit("empty")))


def read_text(
    queries: DataFrame, phrases: dict[str, str] | None = None, stop_words: tuple[str, ...] | list[str] | None = None, axes: tuple[str, ...] = AXES
) -> DataFrame:
    """Adds read_axes and tokens.

    Axes are those that the text names by their own word, then those of its phrases, each once.  Tokens
    are the distinct words of two letters or more that are no axis and no stop word.
    """
    low = F.lower(F.coalesce("text", F.lit("")))
    words = F.filter(F.regexp_extract_all(low, F.lit(f"({TOKEN})"), 1), lambda w: F.length(w) > 1)
    table = SEARCH_PHRASES if phrases is None else phrases
    said = F.filter(words, lambda w: w.isin(*axes))
    meant = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(p)), F.lit(a)) for p, a in table.items())))
    left_out = [*axes, *(STOP_WORDS if stop_words is None else stop_words)]
    tokens = F.array_except(words, F.array(*map(F.lit, left_out)))
    return queries.withColumns({"read_axes": F.array_distinct(F.concat(said, meant)), "tokens": tokens})


def effective_axes(queries: DataFrame) -> DataFrame:
    """Declared axes win over those read from the text."""
    return queries.withColumn("use_axes", F.when(_some("axes"), F.col("axes")).otherwise(F.col("read_axes")))


def matched_terms(queries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(query, matched, unknown): tokens that are labels of the vocabulary, and the others.

    The vocabulary joins by equality on exploded tokens, so neither side is broadcast for it.
    """
    words = queries.select("query", F.explode_outer("tokens").alias("token"))
    v = vocabulary.select(F.col("label").alias("token")).distinct().withColumn("known", F.lit(True))
    rows = words.join(v, "token", "left")
    pick = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("token"))))
    return rows.groupBy("query").agg(pick(F.col("known")).alias("matched"), pick(F.col("token").isNotNull() & F.col("known").isNull()).alias("unknown"))


def resolved_terms(queries: DataFrame, weights: DataFrame) -> DataFrame:
    """(query, matched, unknown): what the tokens stand for in the vocabulary (block, label, df): a tag,
    exact or the commonest that contains the token, else an attribute likewise; the other tokens."""
    words = queries.select("query", F.explode_outer("tokens").alias("word"))
    once = words.where("word is not null").select("word").distinct()
    of = lambda block: resolved(once.withColumn("block", F.lit(block)), weights).select("word", F.col("label").alias(block))
    labels = of(TAG).join(of(ATTRIBUTE), "word").select("word", F.coalesce(TAG, ATTRIBUTE).alias("label"))
    rows = words.join(labels, "word", "left")
    pick = lambda value: F.array_sort(F.collect_set(value))
    unknown = F.when(F.col("label").isNull(), F.col("word"))
    return rows.groupBy("query").agg(pick("label").alias("matched"), pick(unknown).alias("unknown"))


def report(resolved: DataFrame) -> DataFrame:
    """Per query, what its words became and which stay unknown; resolved: query, word, label."""
    return resolved.groupBy("query").agg(
        F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("label").isNotNull() & (F.col("label") != F.col("word")), F.struct("word", "label"))))).alias("resolved"),
        F.array_sort(F.collect_set(F.when(F.col("label").isNull(), F.col("word")))).alias("unknown"),
    )


def reasons(results: DataFrame, query_terms: DataFrame, terms: DataFrame, k: int = 3) -> DataFrame:
    """The k strongest shared terms of every result, for a whole page of results in one join."""
    rows = results.select("query", "item").join(query_terms.select("query", "block", "label"), "query").join(terms, ["item", "block", "label"])
    by = Window.partitionBy("query", "item").orderBy(F.desc(F.round("weight", 9)), "block", "label")
    return rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k).select("query", "item", "block", "label", "weight", "place")


def filled_reasons(results: DataFrame, found: DataFrame, terms: DataFrame, k: int = 3, blocks: tuple[str, ...] = ("acc", "note", "fam")) -> DataFrame:
    """Reasons filled up to k with the item's own strongest smell terms, no label twice."""
    own = results.select("query", "item").join(terms.where(F.col("block").isin(*blocks)), "item").select("query", "item", "block", "label", "weight", F.lit(1).alias("source"))
    both = found.select("query", "item", "block", "label", "weight", F.lit(0).alias("source")).union(own)
    order = ["source", F.desc(F.round("weight", 9)), "block", "label"]
    once = both.withColumn("n", F.row_number().over(Window.partitionBy("query", "item", "label").orderBy(*order))).where("n = 1")
    rows = once.withColumn("place", F.row_number().over(Window.partitionBy("query", "item").orderBy(*order))).where(F.col("place") <= k)
    return rows.select("query", "item", "block", "label", "place")


def mentioned_labels(queries: DataFrame, labels: DataFrame, k: int = 24) -> DataFrame:
    """Labels that contain a token of the query, commonest first.  Labels (label, df) are matched per
    distinct token, not per query."""
    tokens = queries.select("query", F.explode("tokens").alias("token"))
    hit = containing(tokens.select(F.col("token").alias("part")).distinct(), labels)
    rows = tokens.join(hit, F.col("token") == F.col("part")).select("query", "label", "df").distinct()
    by = Window.partitionBy("query").orderBy(F.desc("df"), "label")
    return rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)


def seeds(asked: DataFrame, k: int = 5) -> DataFrame:
    """Per asked text, the seed item and the others it could mean; asked: text, key, rank."""
    return asked.where(F.col("rank") <= k).groupBy("text").agg(F.min_by("key", "rank").alias("seed"), F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") > 1, F.struct("rank", "key")))), lambda x: x["key"]).alias("others"))


def widened_limit(limit: Column, shown: Column) -> Column:
    return F.least(2 * limit + shown, F.lit(SHOWN_CAP))


def without_shown(results: DataFrame, shown: DataFrame, limits: DataFrame) -> DataFrame:
    """The first `limit` results that were not shown before, from the widened list (rank up to twice the
    limit and the number shown); limits: query, limit; shown: query, item.  Queries with nothing left
    come back with a null item and exhausted set."""
    n = shown.groupBy("query").agg(F.count("*").alias("n_shown"))
    q = limits.join(n, "query", "left").withColumn("wide", widened_limit(F.col("limit"), F.coalesce("n_shown", F.lit(0))))
    rows = results.join(q, "query").where(F.col("rank") <= F.col("wide")).join(shown.select("query", "item"), ["query", "item"], "left_anti")
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("rank", "item"))).where(F.col("place") <= F.col("limit"))
    return limits.select("query").join(rows.select("query", "item", "place"), "query", "left").withColumn("exhausted", F.col("item").isNull())


def filtered(items: DataFrame, gender: str | None = None, min_votes: int = 0) -> DataFrame:
    rows = items.where(F.coalesce("votes", F.lit(0)) >= min_votes)
    return rows.where(F.lower("gender") == gender.lower()) if gender else rows


def clamped(limit: Column, most: int = MAX_SEARCH) -> Column:
    return F.greatest(F.lit(1), F.least(F.coalesce(limit, F.lit(10)), F.lit(most)))


def chat_query(intents: DataFrame, limit: str = "limit") -> DataFrame:
    """Which way a conversation's search goes: with tags or attributes by these, without its text; else by
    its text.  A season alone is a weak signal and stays a filter of either.  The limit is a chat's."""
    smell = _some("tags") | _some("attributes")
    none = F.array().cast("array<string>")
    kept = lambda c: F.when(smell, F.coalesce(F.col(c), none)).otherwise(none)
    text = F.when(~smell, F.col("text"))
    return intents.withColumns({"tags": kept("tags"), "attributes": kept("attributes"), "text": text, limit: clamped(F.col(limit), MAX_CHAT)})
