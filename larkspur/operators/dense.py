"""Dense embeddings: documents, a hashing embedder, nearest neighbours and group centroids."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

# The words of the document sentence.
SEASON_WORDS = {"winter": "mùa đông", "spring": "mùa xuân", "summer": "mùa hè", "fall": "mùa thu", "day": "ban ngày", "night": "buổi tối"}
TOKEN = "[0-9a-zA-ZÀ-ỹ]+"
DIMENSIONS = 64
#: Rows of a block of queries and of items in a neighbour search.
QUERY_BLOCK, ITEM_BLOCK = 1024, 4096


class Embedder(Protocol):
    """A model for `embedded`: its id, vector length, and vectors of documents and of queries."""

    model_id: str
    dimensions: int

    def documents(self, texts: list[str]) -> list[list[float]]: ...

    def queries(self, texts: list[str]) -> list[list[float]]: ...


def document(name: Column, group: Column, attributes: Column, tags: Column, axes: Column, gender: Column) -> Column:
    """One sentence per item: its strongest six attributes (a map), first ten tags, axes voted for by
    half or more (a map), gender; empty for an item without attributes and tags."""
    strongest = lambda m, least: F.transform(F.reverse(F.array_sort(F.filter(F.transform(F.map_entries(m), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))), lambda e: (e["v"] != 0) & (e["v"] >= least)))), lambda e: e["k"])
    top, notes = F.slice(strongest(attributes, 0.0), 1, 6), F.slice(tags, 1, 10)
    words = F.map_from_entries(F.transform(F.map_entries(axes), lambda e: F.struct(F.create_map(*(F.lit(x) for kv in SEASON_WORDS.items() for x in kv))[e["key"]], e["value"])))
    fit = strongest(words, 50.0)
    part = lambda head, a: F.when(F.size(a) > 0, F.concat(F.lit(head), F.array_join(a, ", "), F.lit(".")))
    who = F.concat(F.coalesce(name, F.lit("(không tên)")), F.coalesce(F.concat(F.lit(" của "), group), F.lit("")), F.lit("."))
    text = F.concat_ws(" ", who, part("Mùi chủ đạo: ", top), part("Note: ", notes), part("Phù hợp ", fit), F.concat(gender, F.lit(".")))
    return F.when((F.size(top) <= 0) & (F.size(notes) <= 0), "").otherwise(text)


def documents(rows: DataFrame, key: str) -> DataFrame:
    """(key, document) of usable rows; rows: name, grp, attributes, tags, axes, gender."""
    doc = document(*(F.col(c) for c in ("name", "grp", "attributes", "tags", "axes", "gender")))
    return rows.select(key, doc.alias("document")).where(F.col(key).isNotNull() & (F.col("document") != ""))


#: Tokens whose places a task remembers.
KEPT_TOKENS = 200_000


def _code(token: str, dimensions: int) -> int:
    """Place and sign of a token in one number, from its md5."""
    h = hashlib.md5(token.encode()).hexdigest()
    return int(h[:8], 16) % dimensions * 2 + int(h[8:10], 16) % 2


def hashed(df: DataFrame, key: str, text: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """(key, embedding): unit bag-of-words vectors, to which each token adds +1 or -1 at a place; zero for a
    text without tokens.  Every row gives one, repeated and null keys too; nothing is shuffled.

    Tasks hash each token once and look it up after that, which is several times faster than hashing
    each occurrence with column functions.
    """
    rows = df.select(F.col(key), F.col(text).alias("__text"))
    schema = StructType([rows.schema[key], StructField("embedding", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in batches:
            out = np.zeros((b.num_rows, dimensions))
            for r, said in enumerate(b.column(1).to_pylist()):
                codes = []
                for token in re.findall(TOKEN, (said or "").lower()):
                    code = known.get(token)
                    if code is None:
                        if len(known) >= KEPT_TOKENS:
                            known.clear()
                        code = known[token] = _code(token, dimensions)
                    codes.append(code)
                counts = np.bincount(np.array(codes, np.int64), minlength=2 * dimensions)
                out[r] = counts[::2] - counts[1::2]
            norm = np.sqrt((out * out).sum(1, keepdims=True))
            out /= np.where(norm > 0, norm, 1)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * dimensions)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))], schema.names)

    return rows.mapInArrow(run, schema)


def embedded(docs: DataFrame, key: str, text: str, model: Embedder, batch: int = 128) -> DataFrame:
    """Vectors by a model that each task loads once: key, model_id, dimensions, embedding, document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                out = part.assign(model_id=model.model_id, dimensions=model.dimensions, embedding=model.documents(part["document"].fillna("").tolist()))
                yield out[["key", "model_id", "dimensions", "embedding", "document"]]

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("document"))
    return rows.mapInPandas(run, "key string, model_id string, dimensions int, embedding array<double>, document string").withColumnRenamed("key", key)


def prefixed(text: Column, model_id: str, query: bool = False) -> Column:
    """Text as a model family wants it: the e5 family tells queries and passages apart."""
    return F.concat(F.lit("query: " if query else "passage: "), text) if "e5" in model_id.lower() else text


def one_model(df: DataFrame, expected: str | None = None) -> str:
    """The table's only model id; raises if it is empty, mixed or not the expected one."""
    found = sorted(r[0] for r in df.groupBy("model_id").count().orderBy("model_id").limit(10).collect())
    if not found:
        raise ValueError("the embedding table is empty")
    if len(found) > 1:
        raise ValueError(f"several models in one table: {found}")
    if expected and found[0] != expected:
        raise ValueError(f"embedded with {found[0]}, not {expected}")
    return found[0]


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of about `size` rows, each one row with an array of structs.  Hashes of whole rows deal them, so
    that a repeated key makes no large block."""
    blocks = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64(*rows.columns), F.lit(blocks))
    return rows.groupBy(block.alias("__block")).agg(F.collect_list(F.struct(*rows.columns)).alias(name)).drop("__block")


def _matrix(rows: pa.StructArray) -> np.ndarray:
    """The rows' vectors to unit length; a null, empty or zero one stays zero."""
    vectors = rows.field("embedding")
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(rows), max(1, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    norm = np.sqrt((out * out).sum(1))
    return out / np.where(norm > 0, norm, 1)[:, None]


def _codes(left: pa.Array, right: pa.Array, nulls: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where the values are; `nulls` are those of nulls on either side."""
    both = pa.chunked_array([left, right]).combine_chunks()
    codes = both.dictionary_encode().indices
    at = len(left)
    return tuple(pc.fill_null(part, null).to_numpy() for part, null in ((codes[:at], nulls[0]), (codes[at:], nulls[1])))


def _best(k: int, exclude_own: bool, other_group: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pair(q: pa.StructArray, i: pa.StructArray) -> pa.RecordBatch:
        a, b = _matrix(q), _matrix(i)
        width = min(a.shape[1], b.shape[1])
        score = a[:, :width] @ b[:, :width].T
        score = np.copysign(np.floor(np.abs(score) * 1e6 + 0.5) / 1e6, score) + 0.0
        if exclude_own:
            x, y = _codes(q.field("query"), i.field("item"), (-1, -2))
            score[x[:, None] == y] = -np.inf
        if other_group:
            x, y = _codes(q.field("grp"), i.field("grp"), (-1, -1))
            score[x[:, None] == y] = -np.inf
        place = np.empty(len(i), np.int64)
        place[pc.sort_indices(i.field("item"), null_placement="at_start").to_numpy()] = np.arange(len(i))
        of, item = [], []
        for row, values in enumerate(score):
            least = np.partition(values, -k)[-k] if len(values) > k else -np.inf
            found = np.flatnonzero((values >= least) & (values > -np.inf))
            found = found[np.lexsort((place[found], -values[found]))[:k]]
            of.append(np.full(len(found), row))
            item.append(found)
        of, item = np.concatenate(of), np.concatenate(item)
        return pa.RecordBatch.from_arrays([q.field("query").take(pa.array(of)), i.field("item").take(pa.array(item)), pa.array(score[of, item])], ["query", "item", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                yield pair(b.column(0).slice(r, 1).flatten(), b.column(1).slice(r, 1).flatten())

    return run


def result_types(queries: DataFrame, item: DataType) -> StructType:
    return StructType([StructField("query", queries.schema["query"].dataType), StructField("item", item), StructField("score", DoubleType())])


def nearest(queries: DataFrame, items: DataFrame, k: int = 10, exclude_own: bool = True, other_group: bool = False) -> DataFrame:
    """The exact k nearest items of each query (query, embedding[, grp]) among items (item, embedding[, grp]):
    query, item, score (cosine to six digits), rank; of equal scores the smaller item comes first.

    The stated queries go against all rows in pairs of blocks, each pair one matrix product that keeps k
    rows a query; no block is sent to all tasks, and a pair holds no more than its two blocks.
    """
    group = ["grp"] if other_group else []
    q = _packed(queries.select("query", "embedding", *group), QUERY_BLOCK, "q")
    i = _packed(items.select("item", "embedding", *group), ITEM_BLOCK, "i")
    rows = q.crossJoin(i).mapInArrow(_best(k, exclude_own, other_group), result_types(queries, items.schema["item"].dataType))
    by = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def having_axis(results: DataFrame, axes: DataFrame, wanted: list[str], least: float = 50.0) -> DataFrame:
    """Results whose item has any of the axes at `least` percent or more."""
    return results.join(axes.where(F.col("axis").isin(wanted) & (F.col("pct") >= least)).select("item"), "item", "left_semi")


def with_signal(results: DataFrame, matched: DataFrame, least: float = 0.01) -> DataFrame:
    """Results of queries whose best score reaches the floor or that a label matched (matched: query)."""
    best = F.max("score").over(Window.partitionBy("query"))
    m = matched.select("query").distinct().withColumn("hit", F.lit(True))
    return results.withColumn("best", best).join(m, "query", "left").where((F.col("best") >= least) | F.coalesce("hit", F.lit(False))).drop("best", "hit")


def group_centroids(items: DataFrame, least: int = 1) -> DataFrame:
    """Mean vector of each group with `least` items or more.  Sums combine per task and place."""
    e = items.select("grp", F.posexplode("embedding").alias("place", "v")).groupBy("grp", "place").agg(F.avg(F.col("v").cast("double")).alias("v"), F.count("*").alias("n"))
    rows = e.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("a"), F.max("n").alias("n")).where(F.col("n") >= least)
    return rows.select("grp", "n", F.transform("a", lambda x: x["v"]).alias("embedding"))


def near_groups(centroids: DataFrame, k: int = 5) -> DataFrame:
    q = centroids.select(F.col("grp").alias("query"), "embedding")
    return nearest(q, centroids.select(F.col("grp").alias("item"), "embedding"), k)


def hit_rate(results: DataFrame, documents: DataFrame, keywords: DataFrame) -> DataFrame:
    """Share of queries whose best document holds one of the query's keywords (query, keywords)."""
    best = results.where("rank = 1").join(documents, "item").join(keywords, "query")
    hit = F.exists("keywords", lambda w: F.contains(F.lower("document"), F.lower(w)))
    return best.agg(F.count("*").alias("n_queries"), F.count_if(hit).alias("hits"), (F.count_if(hit) / F.count("*")).alias("hit_at_1"))
