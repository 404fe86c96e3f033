"""One interface over the sparse and the dense scorer: tables in, a table of ranked results out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dense, search, sparse


@dataclass(frozen=True)
class Retriever:
    """items: item, grp, votes, gender; terms: item, block, label, weight; idf: block, label, df, idf;
    vectors (for the dense scorer): item, grp, embedding, model_id."""

    items: DataFrame
    terms: DataFrame
    idf: DataFrame
    vectors: DataFrame | None = None

    def size(self) -> int:
        return self.items.count()

    def vocabulary(self, block: str) -> DataFrame:
        return sparse.vocabulary(self.idf, block)

    def similar_groups(self, least: int = 1) -> DataFrame:
        return sparse.similar_groups(sparse.centroids(self.terms, self.items.select("item", "grp"), least))

    def search(self, queries: DataFrame, k: int = 10, gender: str | None = None, min_votes: int = 0) -> DataFrame:
        """(query, item, score, rank).  queries with term rows (query, block, label) go to the sparse
        scorer, with an embedding (query, embedding) to the dense one."""
        items = search.filtered(self.items, gender, min_votes)
        if "embedding" not in queries.columns:
            vectors = sparse.query_vector(queries, self.idf, known_only=True)
            return sparse.ranked(vectors, self.terms, items, k).select("query", "item", "score", "rank")
        if self.vectors is None:
            raise ValueError("no vectors to search")
        dense.one_model(self.vectors)
        near = dense.nearest(queries, self.vectors.join(items.select("item"), "item", "left_semi"), k, exclude_own=False)
        return near.where(F.col("score") > 0).select("query", "item", "score", "rank")
