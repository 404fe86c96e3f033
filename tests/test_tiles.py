"""The tiled search against the plain one, and what its queries shuffle where labels are common."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_indexes import K, sparse_case
from test_queries import norm

from larkspur.operators import sparse, tiles
from larkspur.plans.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("sizes", [{}, {"TILE": 16, "BLOCK": 4, "FIRST": 8}, {"TILE": 7, "BLOCK": 3, "CELLS": 20, "KEPT": 1}])
@pytest.mark.parametrize("kw", [{}, {"min_votes": 5, "exclude_own": True}, {"other_group": True}])
def test_ranked_by_tiles(spark, monkeypatch, sizes, kw):
    """Small tiles and blocks, a first look, tiles cut for their terms and tasks that keep one tile change nothing."""
    for name, size in sizes.items():
        monkeypatch.setattr(tiles, name, size)
    terms, queries, items = sparse_case(spark, 5)
    # terms without weight count as shared terms, too
    terms = terms.union(terms.where("item % 9 = 0").select("item", F.lit("note"), F.lit("weightless"), F.lit(0.0)).distinct()).cache()
    queries = queries.union(spark.createDataFrame([(101, "note", "weightless", 0.5), (4, "note", "weightless", 0.0)], queries.schema)).cache()
    kw = dict(kw)
    if kw.pop("other_group", False):
        kw["other_group"] = items.select(F.col("item").alias("query"), "grp").where("query <> 2")
    got = tiles.ranked(queries, terms, items, sparse.SELECTIVE, K, **kw)
    want = sparse.ranked(queries, terms, items, K, **kw)
    key = lambda r: (r.query, r["rank"], r.item, round(r.score, 9))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert want.count() > 40


def test_tiles_of_nothing(spark):
    terms, queries, items = sparse_case(spark, 1, 10)
    assert tiles.ranked(queries, terms.limit(0), items, sparse.SELECTIVE).count() == 0
    assert tiles.ranked(queries.limit(0), terms, items, sparse.SELECTIVE).count() == 0
    assert tiles.ranked(queries, terms, items.limit(0), sparse.SELECTIVE).count() == 0


def test_tasks_keep_k_of_a_query(spark, monkeypatch):
    """Copies of one item tie for every place: the votes and keys choose, and no task writes more than k of a query."""
    monkeypatch.setattr(tiles, "TILE", 64)
    monkeypatch.setattr(tiles, "BLOCK", 32)
    copies = spark.range(2000).select(F.col("id").alias("item"), F.lit("note").alias("block"), F.lit("same").alias("label"), F.lit(1.0).alias("weight"))
    items = copies.select("item", F.when(F.col("item") % 300 == 299, 9).otherwise(5).alias("votes"), F.lit("g").alias("grp"))
    queries = copies.where("item % 50 = 0").withColumnRenamed("item", "query")
    written = []
    search = tiles._search
    monkeypatch.setattr(tiles, "_search", lambda *a: written.append(search(*a)) or written[-1])
    rows = tiles.ranked(queries, copies, items, ("note",), 10, exclude_own=True).collect()
    for q in range(0, 2000, 50):
        want = ([i for i in range(2000) if i % 300 == 299] + [i for i in range(2000) if i % 300 != 299 and i != q])[:10]
        assert [r.item for r in sorted(rows, key=lambda r: r["rank"]) if r.query == q] == want
    tasks = written[0].rdd.getNumPartitions()
    assert written[0].count() <= 10 * 40 * tasks


def hot(path, n=6000):
    """Tables of n items of few labels, each label in a third of them, and five lines an item."""
    con = duckdb.connect()
    name, brand, kind = ("['a', 'b', 'c'][CAST(hash(i, {}) % 3 AS INT) + 1]".format(s) for s in (1, 2, 3))
    con.execute(f"COPY (SELECT i AS p_partkey, {name} || ' x' || {brand} AS p_name, 'Brand#' || {brand} AS p_brand, upper({kind}) AS p_type, CAST(hash(i, 4) % 50 + 1 AS INT) AS p_size FROM range({n}) t(i)) TO '{path}/part.parquet'")
    con.execute(f"COPY (SELECT i AS l_partkey, CAST(hash(i, j) % 50 + 1 AS DOUBLE) AS l_quantity, TIMESTAMP '1995-01-01' + INTERVAL (CAST(hash(j, i, 1) % 700 AS INT)) DAY AS l_shipdate FROM range({n}) t(i), range(5 + i % 3) u(j)) TO '{path}/lineitem.parquet'")
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    return con


def shuffled(spark):
    """Rows that all stages so far wrote to shuffles."""
    sc = spark.sparkContext
    empty = sc._jvm.java.util.ArrayList
    found = sc._jsc.sc().statusStore().stageList(empty(), False, False, sc._gateway.new_array(sc._jvm.double, 0), empty())
    return sum(found.apply(i).shuffleWriteRecords() for i in range(found.size()))


@pytest.mark.parametrize("name", ["explained_scores", "similar_items", "similar_items_other_group"])
def test_pairs_of_common_labels_are_not_shuffled(spark, tmp_path, name):
    """120 queries share labels with nearly all of 6,000 items: what is shuffled follows the items, not the pairs."""
    con = hot(tmp_path)
    before = shuffled(spark)
    df = QUERIES[name](spark, str(tmp_path))
    got = df.collect()
    rows = shuffled(spark) - before
    sql = con.sql(ORACLES[name])
    cols = sorted(df.columns)
    want = [[norm(r[sql.columns.index(c)]) for c in cols] for r in sql.fetchall()]
    assert sorted(map(repr, ([norm(r[c]) for c in cols] for r in got))) == sorted(map(repr, want))
    assert len(got) >= 1200 and 0 < rows < 330_000
