"""Ranked sparse search in tiles, exact: tiles of queries and of items meet in pairs, a matrix product a block.

Items lie in the order of their selective terms, so the blocks of a tile hold items that share most of them.
The largest weights of a block bound what it can score: a query whose k-th best score so far lies above the
bound passes it by.  A first look at some of the items gives every query a score that k items surely reach;
the second one goes over all blocks of all items.  Tasks keep k results a query, so pairs of queries and items
are neither written nor shuffled, however many items a label has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.sources.scratch import stored

#: Rows of a tile of queries or of items, and of a block of items.
TILE, BLOCK = 4096, 256
#: Most cells of a tile of queries (queries times their distinct terms), and tiles of queries that a task keeps.
CELLS, KEPT = 1 << 20, 16
#: About so many items are looked at first.
FIRST = 1 << 16
#: Scores are ranked by nine digits, as whole numbers.
NINE = 1e9
_NONE = np.iinfo(np.int64).min

_PARTS = ("key", "grp", "extra", "size", "term", "weight")
_PACKED = ", ".join(f"{{0}}_{p} array<{'double' if p == 'weight' else 'int' if p == 'size' else 'long'}>" for p in _PARTS)
_FOUND = "query long, item long, score double, nine long, votes long"


def _vectors(terms: DataFrame, key: str, selective: tuple[str, ...]) -> DataFrame:
    """(key, terms): numbers and weights of each key's terms; a number's lowest bit says whether its block selects."""
    number = F.xxhash64("block", "label").bitwiseAND(F.lit(-2)) + F.col("block").isin(*selective).cast("long")
    entry = F.struct(number.alias("term"), F.col("weight").cast("double").alias("weight"))
    return terms.where(F.col("weight").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(entry).alias("terms"))


def _packed(rows: DataFrame, side: str, parts: int | None = None, cells: int | None = None) -> DataFrame:
    """Tiles, a row each, of rows (key, grp, extra, terms) in the order of their selective terms; `parts`: of how
    many partitions."""
    order = [F.array_sort(F.filter(F.transform("terms", lambda t: t["term"]), lambda t: t.bitwiseAND(F.lit(1)) == 1)), F.col("key")]
    rows = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    names = [f"{side}_{p}" for p in _PARTS]

    def tiles(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        term, weight = b.column("terms").flatten().flatten()
        if cells and b.num_rows > 1 and b.num_rows * len(term.unique()) > cells:
            half = b.num_rows // 2
            yield from tiles(b.slice(0, half))
            yield from tiles(b.slice(half))
            return
        size = b.column("terms").value_lengths()
        flat = (b.column("key"), b.column("grp"), b.column("extra"), size, term, weight)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in flat], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, TILE):
                yield from tiles(b.slice(at, TILE))

    return rows.select("key", "grp", "extra", "terms").mapInArrow(run, _PACKED.format(side))


class _Queries:
    """A tile of queries in a task: a matrix of its terms' weights, and the k best items of each so far."""

    def __init__(self, key: np.ndarray, grp: np.ndarray, least: np.ndarray, size: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int):
        self.key, self.grp, self.least, n = key, grp, least.copy(), len(key)
        self.least_votes = np.full(n, _NONE)
        self.terms, at = np.unique(term, return_inverse=True)
        of = np.repeat(np.arange(n), size)
        self.weights = np.zeros((len(self.terms), n))
        np.add.at(self.weights, (at, of), weight)
        chosen = (self.terms & 1).astype(bool)
        self.finds = np.zeros(self.weights.shape, np.float32)
        self.finds[at, of] = chosen[at]
        # what terms that select nothing add at most; a query of such terms alone takes all that it scores above zero
        self.rest = np.sqrt((self.weights[~chosen] ** 2).sum(0))
        self.rest[~self.finds.any(0)] = -1.0
        self.nine, self.votes, self.item = np.full((n, k), -1), np.full((n, k), _NONE), np.zeros((n, k), np.int64)
        self.score = np.zeros((n, k))

    def add(self, of: np.ndarray, nine: np.ndarray, votes: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        """Takes in results of queries `of`; each keeps its k best by score, votes and key."""
        k = self.nine.shape[1]
        own, at = np.unique(of, return_inverse=True)
        at = np.concatenate([np.repeat(np.arange(len(own)), k), at])
        columns = [np.concatenate([getattr(self, c)[own].ravel(), new]) for c, new in (("nine", nine), ("votes", votes), ("item", item), ("score", score))]
        order = np.lexsort((columns[2], -columns[1], -columns[0], at))
        at = at[order]
        best = order[np.arange(len(at)) - np.searchsorted(at, np.arange(len(own)))[at] < k].reshape(len(own), k)
        self.nine[own], self.votes[own], self.item[own], self.score[own] = (c[best] for c in columns)
        last, votes = self.nine[own, -1], self.votes[own, -1]
        more = last >= self.least[own]
        self.least[own[more]], self.least_votes[own[more]] = last[more], votes[more]

    def found(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.nine >= 0)
        columns = (self.key[row], self.item[row, place], self.score[row, place], self.nine[row, place], self.votes[row, place])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in _FOUND.split(", ")])


def _meet(q: _Queries, key: np.ndarray, grp: np.ndarray, votes: np.ndarray, size: np.ndarray, term: np.ndarray, weight: np.ndarray, exclude_own: bool, other_group: bool, block: int) -> None:
    """Scores a tile of items, block by block, for the queries that a block's largest weights can still serve."""
    k = q.nine.shape[1]
    at = np.minimum(np.searchsorted(q.terms, term), len(q.terms) - 1)
    shared = q.terms[at] == term
    ends = np.concatenate([[0], np.cumsum(size)])
    of = np.repeat(np.arange(len(key)), size)
    rest = np.sqrt(np.bincount(of, np.where(term & 1, 0.0, weight**2), len(key)))
    for lo in range(0, len(key), block):
        hi = min(lo + block, len(key))
        own = slice(ends[lo], ends[hi])
        mine = shared[own]
        columns, place = np.unique(at[own][mine], return_inverse=True)
        if not len(columns):
            continue
        row = of[own][mine] - lo
        items = np.zeros((hi - lo, len(columns)))
        np.add.at(items, (row, place), weight[own][mine])
        least = (q.least - 1) / NINE
        bound = items.max(0) @ q.weights[columns]
        able = np.flatnonzero((bound >= least) & (bound > 0))
        if not len(able):
            continue
        least = least[able]
        score = items @ q.weights[columns][:, able]
        good = (score >= least) & (score > 0)
        # scores that terms which select nothing could reach alone need a selective term in common
        unsure = np.flatnonzero(least <= q.rest[able] * rest[lo:hi].max())
        if len(unsure):
            has = np.zeros(items.shape, np.float32)
            has[row, place] = 1
            good[:, unsure] &= has @ q.finds[columns][:, able[unsure]] > 0
        i, j = np.nonzero(good)
        keep = np.ones(len(i), bool)
        if exclude_own:
            keep &= key[lo:hi][i] != q.key[able][j]
        if other_group:
            keep &= grp[lo:hi][i] != q.grp[able][j]
        i, j = i[keep], j[keep]
        if len(i) > 4 * k * len(able) and hi - lo > k:  # a query's k best of the block, and what equals the last
            best = np.full(score.shape, -np.inf)
            best[i, j] = score[i, j]
            last = np.partition(best, hi - lo - k, axis=0)[hi - lo - k]
            keep = score[i, j] >= last[j] - 2 / NINE
            i, j = i[keep], j[keep]
        value, to = score[i, j], able[j]
        nine, has_votes = np.rint(value * NINE).astype(np.int64), votes[lo:hi][i]
        keep = (nine > q.least[to]) | ((nine == q.least[to]) & (has_votes >= q.least_votes[to]))
        if keep.any():
            q.add(to[keep], nine[keep], has_votes[keep], key[lo:hi][i][keep], value[keep])


def _search(queries: DataFrame, items: DataFrame, k: int, exclude_own: bool, other_group: bool, spread: int | None = None) -> DataFrame:
    """The k best of each query in each task: query, item, score, nine (the score in nine digits), votes;
    `spread`: over how many partitions the items are dealt."""

    def column(b: pa.RecordBatch, n: int, row: int) -> np.ndarray:
        return b.column(n).slice(row, 1).flatten().to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, _Queries] = {}
        for b in batches:
            for row in range(b.num_rows):
                key = column(b, 0, row)
                if key[0] not in kept:
                    if len(kept) >= KEPT:
                        yield from (q.found() for q in kept.values())
                        kept.clear()
                    kept[key[0]] = _Queries(key, *(column(b, n, row) for n in range(1, len(_PARTS))), k)
                _meet(kept[key[0]], *(column(b, n, row) for n in range(len(_PARTS), 2 * len(_PARTS))), exclude_own, other_group, BLOCK)
        yield from (q.found() for q in kept.values())

    parts = max(1, -(-queries.count() // TILE))  # whole tiles of queries, whatever the number of partitions
    return _packed(queries, "q", parts, CELLS).crossJoin(_packed(items, "i", spread)).mapInArrow(run, _FOUND)


def ranked(queries: DataFrame, terms: DataFrame, items: DataFrame, selective: tuple[str, ...], k: int = 10, min_votes: int = 0, exclude_own: bool = False, other_group: DataFrame | None = None) -> DataFrame:
    """(query, item, score, votes, rank): the k best items per query by score, votes and key, scores above zero only.

    As `sparse.ranked`, for many queries: each item is in one tile and meets all queries.  queries: query, block,
    label, weight; terms: item, block, label, weight; weights are not negative, keys are long and not null.  items: item, votes,
    grp; votes of items without any are 0 here.  other_group: query, grp that results must not have.
    """
    votes = F.coalesce("votes", F.lit(0)).cast("long")
    group = F.xxhash64("grp")
    who = items.where(votes >= min_votes).select("item", group.alias("grp"), votes.alias("extra"))
    vectors = _vectors(terms, "item", selective).join(who, "item").withColumnRenamed("item", "key")
    vectors = stored(vectors.select(F.col("key").cast("long").alias("key"), "grp", "extra", "terms"), "vectors")
    asked = _vectors(queries, "query", selective)
    if other_group is not None:
        asked = asked.join(other_group.select("query", group.alias("grp")), "query")
    else:
        asked = asked.withColumn("grp", F.lit(0).cast("long"))
    asked = stored(asked.select(F.col("query").cast("long").alias("key"), "grp", F.lit(-1).cast("long").alias("extra"), "terms"), "asked")

    how = (k, exclude_own, other_group is not None)
    best = Window.partitionBy("query").orderBy(F.desc("nine"), F.desc("votes"), "item")
    n = vectors.count()
    if n > 4 * FIRST:
        some = vectors.where(F.pmod(F.xxhash64("key"), F.lit(n // FIRST)) == 0)
        # without known scores every task writes k rows a query, so these tasks are as few as the tiles
        sure = _search(asked, some, *how, max(1, FIRST // TILE)).withColumn("place", F.row_number().over(best)).where(F.col("place") == k)
        sure = sure.select(F.col("query").alias("key"), F.col("nine").alias("sure"))
        sure = stored(sure, "sure")
        asked = asked.join(sure, "key", "left").select("key", "grp", F.coalesce("sure", "extra").alias("extra"), "terms")
    rows = _search(asked, vectors, *how).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return rows.select("query", "item", "score", "votes", "rank")
