"""Indexed searches against the plain ones: same results, blocks of bounded size, measured recall."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import dense, postings, sparse, vector_index

K = 5


def sparse_case(spark, seed, n=120):
    """Items with a label that half of them have, rare ones, ties, equal items and queries of every kind."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        labels = {f"t{rng.randint(0, 25)}" for _ in range(rng.randint(0, 6))} | ({"hot"} if i % 2 else set())
        rows += [(i, "note", t, rng.choice([0.1, 0.2, 0.5, rng.random()])) for t in labels]
        rows += [(i, "occ", a, rng.choice([0.3, rng.random()])) for a in ("winter", "summer") if rng.random() < 0.9]
    rows += [(n + k, b, t, w) for k in range(12) for _, b, t, w in rows[:5]]
    terms = spark.createDataFrame(rows, "item long, block string, label string, weight double")
    terms = terms.groupBy("item", "block", "label").agg(F.max("weight").alias("weight"))
    asked = [(q, b, t, w) for q in range(12) for i, b, t, w in rows if i == q * 3]
    asked += [(100, "note", "hot", 1.0), (101, "occ", "winter", 1.0), (102, "note", "unknown", 0.7), (102, "occ", "winter", 0.7), (103, "note", "unknown", 1.0)]
    queries = spark.createDataFrame(asked, "query long, block string, label string, weight double").dropDuplicates(["query", "block", "label"])
    items = spark.createDataFrame([(i, rng.choice([None, 1, 5, 5, 9]), f"g{i % 7}") for i in range(n + 12)], "item long, votes int, grp string")
    return terms.cache(), queries.cache(), items.cache()


@pytest.mark.parametrize("bits,head", [(12, 64), (2, 1), (0, 3)])
@pytest.mark.parametrize("kw", [{}, {"min_votes": 5, "exclude_own": True}, {"other_group": True}])
def test_ranked_by_postings(spark, bits, head, kw):
    terms, queries, items = sparse_case(spark, bits)
    kw = dict(kw)
    if kw.pop("other_group", False):
        kw["other_group"] = items.select(F.col("item").alias("query"), "grp")
    found = postings.index(terms, bits, head)
    assert found.blocks.agg(F.max(F.size("entries"))).first()[0] <= 1 << bits
    assert found.blocks.select(F.sum(F.size("entries"))).first()[0] == terms.count()
    got = postings.ranked(queries, found, items, sparse.SELECTIVE, K, **kw)
    want = sparse.ranked(queries, terms, items, K, **kw)
    key = lambda r: (r.query, r["rank"], r.item, round(r.score, 9))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert want.count() > 40


def test_blocks_that_cannot_reach_are_left_out(spark):
    """With clear winners among the heads, the long tail of a label is not read."""
    rows = [(i, "note", "hot", 1.0 if i < 20 else 0.01) for i in range(3000)] + [(i, "note", f"own{i}", 0.5) for i in range(3000)]
    terms = spark.createDataFrame(rows, "item long, block string, label string, weight double").cache()
    items = terms.select("item", F.lit(1).alias("votes"), F.lit("g").alias("grp")).distinct()
    queries = spark.createDataFrame([(0, "note", "hot", 0.9), (0, "note", "own2999", 0.1)], "query long, block string, label string, weight double")
    found = postings.index(terms, 4, 16)
    # an item that would win is put into the blocks that the bounds rule out: it must not show
    trap = F.transform("entries", lambda e: F.struct(e["weight"].alias("weight"), F.lit(-1).cast("long").alias("item")))
    blocks = found.blocks.withColumn("entries", F.when(F.col("top") < 0.02, trap).otherwise(F.col("entries")))
    best = spark.createDataFrame([(-1, {"note:hot": 9.0})], "item long, item_terms map<string,double>")
    items = items.union(items.limit(1).withColumn("item", F.lit(-1).cast("long")))
    trapped = postings.Index(blocks, found.labels, found.vectors.unionByName(best))
    got = postings.ranked(queries, trapped, items, ("note",), K)
    assert sorted((r["rank"], r.item) for r in got.collect()) == [(k + 1, k) for k in range(K)]


def test_empty_postings(spark):
    terms, queries, items = sparse_case(spark, 1, 10)
    assert postings.ranked(queries, postings.index(terms.limit(0)), items, sparse.SELECTIVE).count() == 0
    assert postings.ranked(queries.limit(0), postings.index(terms), items, sparse.SELECTIVE).count() == 0


def vectors(spark, n=600, width=12, hot=200):
    """Clusters, many copies of one vector, null, empty, short and zero vectors, repeated keys."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(15, width))
    rows = [(int(i), (centres[i % 15] + 0.3 * rng.normal(size=width)).tolist(), int(i % 4)) for i in range(n)]
    rows += [(n + k, centres[0].tolist(), 1) for k in range(hot)]
    rows += [(9001, None, 1), (9002, [], 1), (9003, [0.0] * width, None), (9004, [1.0, 2.0], 2), (5, centres[1].tolist(), 2)]
    return spark.createDataFrame(rows, "item long, embedding array<double>, grp int").cache()


def test_vector_index(spark, monkeypatch):
    monkeypatch.setattr(dense, "ITEM_BLOCK", 64)
    items = vectors(spark)
    queries = items.where("item % 50 = 0 or item > 9000").select(F.col("item").alias("query"), "embedding", "grp")
    found = vector_index.index(items)
    assert found.rows.select(F.sum(F.size("i"))).first()[0] == items.count()
    assert found.rows.agg(F.max(F.size("i"))).first()[0] < 110  # 200 copies in one list are dealt in blocks
    for kw in ({}, {"exclude_own": False}, {"other_group": True}):
        exact = dense.nearest(queries, items, K, **kw).cache()
        whole = vector_index.nearest(queries, found, K, probes=len(found.centroids), **kw)
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, exact.collect()))
        part = vector_index.nearest(queries, found, K, probes=6, **kw)
        assert vector_index.recall(part, exact).first().recall >= 0.9
    one = vector_index.nearest(queries.where("query = 50"), found, K, probes=1)
    assert one.count() == K


def test_vector_index_of_nothing(spark):
    items = vectors(spark)
    empty = vector_index.index(items.limit(0))
    q = items.where("item = 50").select(F.col("item").alias("query"), "embedding")
    assert vector_index.nearest(q, empty).count() == 0
    unusable = vector_index.index(items.where("item in (9001, 9002, 9003)"))
    assert vector_index.nearest(q, unusable).count() == 3
    assert vector_index.recall(q.select("query", F.lit(1).alias("item")).limit(0), q.select("query", F.lit(1).alias("item")).limit(0)).first().recall is None
