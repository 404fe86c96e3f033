"""A coarse partition index for dense search: inverted lists of vectors around centroids, some of them probed.

The exact way is `dense.nearest`.  Here the centroids are fitted on a sample of bounded size, every row
stands in the list of its nearest centroid, and a query meets the lists whose centroids are nearest to
it.  Lists are dealt in blocks, and a join meets one block, so a list of copies is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.sources.scratch import stored

from . import dense

#: Most lists; rows of the sample that a list gets for the fit; rounds of the fit.  The sample has at most
#: LISTS * PER_LIST rows, taken by hash over all rows, and stays a table: the driver holds centroids alone.
LISTS, PER_LIST, ROUNDS = 4096, 64, 6
#: Lists that a query meets by default, at most.
MOST_PROBES = 256


@dataclass(frozen=True)
class Index:
    """centroids: (lists, width) unit vectors; lists: list, block, and the rows' columns; sizes: list, blocks."""

    centroids: np.ndarray
    rows: DataFrame
    sizes: DataFrame


def _units(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors of `width` places to unit length; missing places, null and zero vectors are zero."""
    rows = pa.StructArray.from_arrays([column], ["embedding"])
    found = dense._matrix(rows)[:, :width]
    out = np.zeros((len(column), width))
    out[:, : found.shape[1]] = found
    return out


def _order(units: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centroids of each row, nearest first; equal ones by number."""
    return np.argsort(-np.round(units @ centroids.T, 12), axis=1, kind="stable")[:, :n]


def _sums(centroids: np.ndarray):
    """Per task and list: how many rows are nearest to it, and the sum of their unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape)
        for b in batches:
            units = _units(b.column(0), centroids.shape[1])
            at = _order(units, centroids, 1)[:, 0]
            count += np.bincount(at, minlength=len(count))
            np.add.at(total, at, units)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.float64()))], ["list", "n", "sums"])

    return run


def fit(vectors: DataFrame, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of `vectors` (embedding) by rounds of k-means on unit vectors; starts are the rows of least hash."""
    start = vectors.orderBy(F.xxhash64("embedding"), "embedding").limit(lists).select("embedding").toArrow()["embedding"]
    start = start.combine_chunks()
    width = int(np.diff(start.offsets.to_numpy()).max(initial=0))
    centroids = np.unique(_units(start, max(width, 1)), axis=0)
    for _ in range(rounds):
        found = vectors.select("embedding").mapInArrow(_sums(centroids), "list long, n long, sums array<double>")
        places = [F.sum(F.get("sums", F.lit(i)))for i in range(centroids.shape[1])]
        moved = centroids.copy()
        for r in found.groupBy("list").agg(F.array(*places).alias("sums")).collect():
            size = np.linalg.norm(r.sums)
            if size > 0:
                moved[r.list] = np.array(r.sums) / size
        centroids = moved
    return centroids


def _with_lists(centroids: np.ndarray, n: int):
    """Rows with their n nearest lists as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = _order(_units(b.column("embedding"), centroids.shape[1]), centroids, n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(near), pa.list_(pa.int64()))], [*b.schema.names, "lists"])

    return run


def _assigned(rows: DataFrame, centroids: np.ndarray, n: int) -> DataFrame:
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_with_lists(centroids, n), f"{kinds}, lists array<long>")


def index(items: DataFrame, lists: int | None = None, per_list: int = PER_LIST) -> Index:
    """The stored index of `items` (item, embedding[, grp]): every row is in one list.

    There are as many lists as the square root of the rows, LISTS at most; rows without a usable vector are in
    the first.  The sample of the fit is the rows of least hash, lists * per_list of them.
    """
    items = items.select(*[c for c in ("item", "embedding", "grp") if c in items.columns])
    usable = items.where(F.exists("embedding", lambda x: x.cast("double") != 0))
    n = usable.count()
    lists = lists or max(1, min(LISTS, int(n**0.5)))
    if not n:
        centroids = np.zeros((1, 1))
    else:
        sample = usable.select("embedding").orderBy(F.xxhash64("item", "embedding")).limit(lists * per_list)
        centroids = fit(stored(sample, "sample"), lists)
    rows = _assigned(items, centroids, 1).withColumn("list", F.get("lists", F.lit(0))).drop("lists")
    rows = stored(rows, "listed")
    sizes = rows.groupBy("list").agg(F.ceil(F.count("*") / dense.ITEM_BLOCK).cast("long").alias("blocks"))
    sizes = stored(sizes, "sizes")  # one row a list, LISTS at most
    columns = [c for c in rows.columns if c != "list"]
    block = F.pmod(F.xxhash64(*columns), F.col("blocks"))
    packed = rows.join(F.broadcast(sizes), "list").groupBy("list", block.alias("block"))
    packed = packed.agg(F.collect_list(F.struct(*columns)).alias("i"))
    return Index(centroids, stored(packed, "lists"), sizes)


def nearest(queries: DataFrame, index: Index, k: int = 10, probes: int | None = None, exclude_own: bool = True, other_group: bool = False) -> DataFrame:
    """`dense.nearest` over the `probes` lists nearest to each query: query, item, score, rank.

    Results are the best of those lists; with as many probes as lists they are exact.  Vectors in clear
    clusters need few probes; those without any need most lists, so the default is three quarters of the
    lists, MOST_PROBES at most.  Measure with `recall`.  queries: query, embedding[, grp].
    """
    probes = probes or min(MOST_PROBES, -(-3 * len(index.centroids) // 4))
    columns = ["query", "embedding", *(["grp"] if other_group else [])]
    asked = _assigned(queries.select(*columns), index.centroids, probes)
    asked = asked.select(*columns, F.explode("lists").alias("list")).join(F.broadcast(index.sizes), "list")
    # the queries of a list in packed blocks, each dealt to every block of the list
    part = F.pmod(F.xxhash64(*columns), F.ceil(F.count("*").over(Window.partitionBy("list")) / dense.QUERY_BLOCK).cast("long"))
    asked = asked.withColumn("part", part).groupBy("list", "part", "blocks").agg(F.collect_list(F.struct(*columns)).alias("q"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = asked.join(index.rows, ["list", "block"]).select("q", "i")
    rows = pairs.mapInArrow(dense._best(k, exclude_own, other_group), dense.result_types(queries, index.rows.schema["i"].dataType.elementType["item"].dataType))
    by = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: n_expected, n_found, recall of the exact results (query, item) among the found ones."""
    rows = exact.select("query", "item").join(found.select("query", "item", F.lit(1).alias("hit")), ["query", "item"], "left")
    rows = rows.agg(F.count("*").alias("n_expected"), F.count("hit").alias("n_found"))
    return rows.withColumn("recall", F.col("n_found") / F.nullif("n_expected", F.lit(0)))
