"""Ranked sparse search over an impact-ordered inverted index, exact by upper bounds.

Posting blocks hold the entries of one label from the heaviest down, with the block's largest weight.
They come from a range partition of all entries, so a label of half the items is cut into many
blocks in many partitions, and every join below meets one block, never a whole label.

A search first scores the heads of its terms' postings, which gives each query a score that k
items surely reach.  From then on a block is read only if its largest weight, with the best that all
other terms could add, reaches that score; what it cannot reach is in no result.  Candidates are
scored whole from the items' own terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.sources.scratch import stored

#: Entries of a slice of the ordered postings (a power of two), and of a label's head that a search scores first.
BLOCK_BITS, HEAD = 12, 64
#: Scores are ranked by nine digits, so bounds give way by this much.
SLACK = 1e-8


@dataclass(frozen=True)
class Index:
    """blocks: block, label, no, top, entries (item, weight); labels: block, label, top, head; vectors: item,
    terms (a map of its weights)."""

    blocks: DataFrame
    labels: DataFrame
    vectors: DataFrame


def _term(block: Column, label: Column) -> Column:
    return F.concat_ws(":", block, label)


def _vector(rows: DataFrame, key: str) -> DataFrame:
    entry = F.struct(_term(F.col("block"), F.col("label")), "weight")
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias(f"{key}_terms"))


def index(terms: DataFrame, block_bits: int = BLOCK_BITS, head: int = HEAD) -> Index:
    """Stores the index of `terms` (item, block, label, weight; one row a term, weights not negative).

    Pass terms that are stored: they are read three times.
    """
    terms = terms.select("item", "block", "label", "weight").where("weight > 0")
    order = ["block", "label", F.desc("weight"), "item"]
    rows = terms.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id counts rows in a sorted partition: its high bits number slices of at most 2 ** block_bits rows
    rows = rows.withColumn("no", F.shiftright(F.monotonically_increasing_id(), block_bits))
    entries = F.reverse(F.array_sort(F.collect_list(F.struct("weight", "item"))))
    blocks = rows.groupBy("block", "label", "no").agg(F.max("weight").alias("top"), entries.alias("entries"))
    blocks = stored(blocks, "postings")
    first = F.min_by(F.slice("entries", 1, head), "no").alias("head")
    labels = stored(blocks.groupBy("block", "label").agg(F.max("top").alias("top"), first), "labels")
    return Index(blocks, labels, stored(_vector(terms, "item"), "vectors"))


def _dot(a: str, b: str) -> Column:
    """Product of two maps, over the entries of the first."""
    each = F.transform(F.map_entries(a), lambda e: e["value"] * F.coalesce(F.try_element_at(F.col(b), e["key"]), F.lit(0.0)))
    return F.aggregate(each, F.lit(0.0), lambda x, y: x + y)


@dataclass(frozen=True)
class _Search:
    """What all steps of a search need: the queries' vectors, the index and the items that count."""

    asked: DataFrame
    index: Index
    items: DataFrame
    exclude_own: bool
    other_group: DataFrame | None

    def scored(self, pairs: DataFrame) -> DataFrame:
        """(query, item, score, votes) of those of the distinct pairs that count and score above zero."""
        rows = pairs.where("query <> item") if self.exclude_own else pairs
        rows = rows.join(self.items, "item")
        if self.other_group is not None:
            rows = rows.join(self.other_group.withColumnRenamed("grp", "own"), "query").where("not (grp <=> own)")
        rows = rows.join(self.index.vectors, "item").join(self.asked, "query")
        return rows.select("query", "item", "votes", _dot("query_terms", "item_terms").alias("score")).where("score > 0")


def _place() -> Column:
    return F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("score", 9)), F.desc(F.coalesce("votes", F.lit(0))), "item"))


def ranked(queries: DataFrame, index: Index, items: DataFrame, selective: tuple[str, ...], k: int = 10, min_votes: int = 0, exclude_own: bool = False, other_group: DataFrame | None = None) -> DataFrame:
    """(query, item, score, votes, rank): the k best items per query by score, votes and key, scores above zero only.

    queries: query, block, label, weight (not negative); items: item, votes, grp.  Candidates share a term
    of a `selective` block with the query; a query without such terms takes all items that share any.
    other_group: query, grp that results must not have.  Exact: equal to scoring every candidate.
    """
    queries = queries.select("query", "block", "label", "weight").where("weight > 0")
    items = items.where(F.coalesce("votes", F.lit(0)) >= min_votes).select("item", "votes", "grp")
    asked = stored(_vector(queries, "query"), "asked")
    search = _Search(asked, index, items, exclude_own, other_group)

    # a term's bound is the most it adds to any score; those of a query are few rows
    terms = queries.join(index.labels, ["block", "label"]).withColumn("bound", F.col("weight") * F.col("top"))
    narrow = F.col("block").isin(*selective)
    of_query = Window.partitionBy("query")
    terms = terms.withColumn("total", F.sum("bound").over(of_query))
    # a query whose selective terms are all unknown has some: it finds nothing by its others
    wide = queries.groupBy("query").agg((~F.max(narrow)).alias("wide"))
    terms = terms.join(wide, "query").where(narrow | F.col("wide"))
    terms = stored(terms.select("query", "block", "label", "weight", "bound", "total", "head"), "bounds")

    heads = terms.select("query", F.explode("head.item").alias("item")).distinct()
    seen = stored(search.scored(heads), "heads")
    sure = seen.withColumn("place", _place()).where(F.col("place") == k).select("query", F.round("score", 9).alias("least"))

    # terms that even together cannot reach the sure score find nothing new: the lightest ones, as long as they do not
    lightest = Window.partitionBy("query").orderBy("bound", "block", "label").rowsBetween(Window.unboundedPreceding, 0)
    terms = terms.join(sure, "query", "left").withColumn("least", F.coalesce("least", F.lit(0.0)) - SLACK)
    terms = terms.withColumns({"own": F.sum("bound").over(lightest), "finding": F.sum("bound").over(of_query)})
    terms = terms.where("own + total - finding >= least")
    others = F.col("total") - F.col("bound")
    reach = lambda w: F.col("weight") * w + others >= F.col("least")
    wanted = terms.drop("top", "head").join(index.blocks.select("block", "label", "no", "top"), ["block", "label"]).where(reach(F.col("top")))
    found = wanted.select("query", "block", "label", "no", "weight", "total", "bound", "least").join(index.blocks.drop("top"), ["block", "label", "no"])
    found = found.select("query", "weight", "total", "bound", "least", F.explode("entries").alias("entry")).where(reach(F.col("entry.weight")))
    found = found.select("query", F.col("entry.item").alias("item")).distinct().join(heads, ["query", "item"], "left_anti")
    rows = seen.unionByName(search.scored(found))
    return rows.withColumn("rank", _place()).where(F.col("rank") <= k)
