"""Small tables with the cases that decide an operator's rules."""

import os
from pathlib import Path
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larkspur.functions import exprs
from larkspur.operators import dense, dialog, marts, pages, quality, queue, search, silver, sparse, star
from larkspur.sources import bronze, csv_links


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=repr)


def test_url_key(spark):
    df = spark.createDataFrame([(" HTTP://A.b/C-1.html//#x ",), (None,), ("",)], "u string")
    assert rows(df.select(exprs.url_key(F.col("u")))) == [("",), ("",), ("http://a.b/c-1.html",)]


def test_gender_and_typing(spark):
    df = spark.createDataFrame([("Women  and men ",), ("weird ",), (" ",), (None,)], "g string")
    assert rows(df.select(exprs.gender_label(F.col("g")))) == [("Unisex",), ("weird",), (None,), (None,)]
    t = spark.createDataFrame([("2015.0",), (" 42 ",), ("x",), (None,)], "v string").select(exprs.to_int(F.col("v")))
    assert rows(t) == [(42,), (None,), (None,), (None,)]


def test_latest_and_history(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("a", "2", 3), ("b", None, 1), ("", "9", 1), (None, "9", 1)], "k string, s string, o int")
    assert rows(silver.latest(df, "k", "s", "o")) == [("a", "2", 3), ("b", None, 1)]
    assert rows(silver.first_on_tie(df.where("k = 'a'"), "k", "s", "o")) == [("a", "2", 2)]
    assert rows(silver.history(df, "k", "s", "o")) == [("a", "1", 1), ("a", "2", 3)]


def test_analysis_rows_last_name_wins(spark):
    schema = "k string, accords array<struct<name:string,width:double>>, when_to_wear array<struct<name:string,percent:double>>, top_notes array<string>, middle_notes array<string>, base_notes array<string>, general_notes array<string>"
    df = spark.createDataFrame([("a", [("x", 1.0), ("x", 2.0), ("y", None)], None, ["t", ""], None, ["b"], None)], schema)
    r = silver.analysis_rows(df).first()
    assert r.attributes == {"x": 2.0, "y": 0.0} and r.tags == ["t", "b"] and r.axes == {}


def test_shrunk_mean_and_group_paths(spark):
    items = spark.createDataFrame([(1, "a", 4.1, 9000), (2, "a", 4.9, 30), (3, "b", None, None), (4, None, 3.0, 70)], "item long, grp string, rating double, votes long")
    plain = {r.grp: r for r in marts.by_group(items).collect()}
    other = {r.grp: r for r in marts.by_group(items, share_of_all=True).collect()}
    assert plain["a"].share_pct == 100.0 and other["a"].share_pct == round(100 * 9030 / 9100, 2)
    assert plain["b"].rating_weighted is not None and other["b"].rating_weighted is None


def test_coverage_unknown_is_not_zero(spark):
    cat = spark.createDataFrame([("a",), ("a",)], "grp string")
    done = spark.createDataFrame([("b", 5)], "grp string, votes long")
    assert rows(marts.coverage(cat, done)) == [("a", 2, 0, 0.0, 0), ("b", None, 1, None, 5)]


def test_metric_registry(spark):
    with pytest.raises(ValueError, match="unknown metrics"):
        marts.run_metrics({}, ["nope"])


def test_blockwise_norm_anchor(spark):
    """Forty equal tags, opposite occasions: 1 / (1 + 0.36)."""
    terms = [(i, "note", f"n{k}", 1.0) for i in (1, 2) for k in range(40)]
    terms += [(1, "occ", "winter", 0.9), (1, "occ", "night", 0.9), (2, "occ", "summer", 0.9), (2, "occ", "day", 0.9)]
    v = sparse.combined(spark.createDataFrame(terms, "item long, block string, label string, weight double"))
    s = sparse.cosine(v.where("item = 1").withColumnRenamed("item", "query"), v.where("item = 2")).first().score
    assert abs(s - 1 / 1.36) < 1e-9


def test_query_without_selective_terms_still_ranks(spark):
    terms = spark.createDataFrame([(1, "occ", "winter", 1.0), (2, "note", "rose", 1.0)], "item long, block string, label string, weight double")
    items = spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "item long, votes long, grp string")
    q = spark.createDataFrame([(7, "occ", "winter", 1.0)], "query long, block string, label string, weight double")
    assert rows(sparse.ranked(q, terms, items), "query", "item") == [(7, 1)]


def test_dense(spark):
    df = spark.createDataFrame([(1, "m"), (2, "n")], "k int, model_id string")
    with pytest.raises(ValueError, match="several"):
        dense.one_model(df)
    with pytest.raises(ValueError, match="empty"):
        dense.one_model(df.where("k > 5"))
    with pytest.raises(ValueError, match="not x"):
        dense.one_model(df.where("k = 1"), "x")
    e = dense.hashed(spark.createDataFrame([(1, "rose rose"), (2, ""), (3, None)], "k int, t string"), "k", "t")
    assert {r.k: round(sum(x * x for x in r.embedding), 6) for r in e.collect()} == {1: 1.0, 2: 0.0, 3: 0.0}


def test_conversation_rules(spark):
    turns = [
        (1, 0, "user", "tìm mùa đông cho nam", None), (1, 1, "assistant", "", ["k1", "k2", "k3"]), (1, 2, "user", "chai thứ 2 thế nào", None),
        (1, 3, "user", "chai thứ 9", None), (1, 4, "user", "thêm mùa hè", None), (1, 5, "user", "chai cuối", None), (1, 6, "user", "cái đó có gì", None),
    ]
    t = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string, shown array<string>")
    got = {r.turn: (r.action, r.target) for r in dialog.classified(t).collect()}
    assert got[0] == ("new", None) and got[2] == ("about", "k2") and got[3] == ("new", None) and got[4] == ("refine", None)
    assert got[5] == ("about", "k3") and got[6] == ("about", "k1") and got[1] == (None, None)
    s = dialog.slots(t).where("turn = 0").first()
    assert s.axes == ["winter"] and s.gender == "Nam"


def test_slot_merge(spark):
    t = spark.createDataFrame(
        [(1, 0, "new", ["a"], [], ["winter"], "Nam", "x" * 200, 5), (1, 1, "about", ["zz"], [], [], None, "no", 0), (1, 2, "refine", ["a", "b"], [], ["summer"], None, "y" * 200, 9), (1, 3, "new", ["c"], [], [], None, "q", 1)],
        "conv_id int, turn int, action string, tags array<string>, attributes array<string>, axes array<string>, gender string, text string, min_votes int",
    )
    m = {r.turn: r for r in dialog.merged(t).collect()}
    assert sorted(m) == [0, 2, 3] and m[2].tags == ["a", "b"] and m[2].axes == ["summer"] and m[2].gender == "Nam" and len(m[2].text) == 300 and m[2].min_votes == 5
    assert m[3].tags == ["c"] and m[3].gender is None


def test_queue_rules(spark):
    ev = spark.createDataFrame([("a", 1, False, "e1"), ("a", 2, True, None), ("a", 3, False, "e2"), ("a", 4, False, "e3"), ("b", 1, True, None)], "k string, t int, ok boolean, error string")
    f = queue.folded(ev, "k", ["t"])
    assert rows(f) == [("a", "failed", 2, "e3"), ("b", "done", 0, None)]
    h = spark.createDataFrame([(0,), (1,), (2,), (7,)], "n int").select("n", queue.cool_hours(F.col("n")))
    assert rows(h) == [(0, None), (1, 6), (2, 24), (7, 72)]
    q = spark.createDataFrame([("a", 1, "pending", 4), ("b", 2, "done", 10), ("c", 3, "done", 1)], "grp string, o int, listing string, pending int")
    assert rows(queue.budget_slice(q, [F.col("o")], 8, 5), "grp", "granted") == [("a", 5), ("b", 3)]


def test_search_shown(spark):
    res = spark.createDataFrame([(1, i, i) for i in range(1, 7)], "query int, item int, rank int")
    shown = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "query int, item int")
    lim = spark.createDataFrame([(1, 2), (2, 3)], "query int, limit int")
    got = rows(search.without_shown(res, shown, lim), "query", "item", "exhausted")
    assert got == [(1, 3, False), (1, 4, False), (2, None, True)]


DETAIL_PAGE = """<html><head><title>Chris 1947 for women 2003</title><meta property="og:image" content="i.png"></head><body><h1>Chris 1947 Maison for women</h1>
<span itemprop="brand">Maison</span><p itemprop="description">Chris 1947 is a Floral Woody Musk fragrance. It was launched in 2003.</p><span itemprop="ratingValue">4.10</span><span itemprop="ratingCount" content="9,000"></span>
<div><h6>main accords</h6><div style="width: 87.215%; background: rgb(173, 119, 39); opacity: 0.5">woody</div></div>
<h4>Top Notes</h4><div class="pyramid-level-container"><a href="/notes/Pink-Rose-12.html"></a></div><h4>Heart Notes</h4><div><a href="/notes/Musk-4.html">Musk</a><a href="/notes/">all</a></div>
<div index="0"><span>Winter</span><div style="width: 0.5"></div><span class="tabular-nums">6.3k</span></div>
<div><h5>LONGEVITY</h5><div class="flex"><span>weak</span><span>10</span><div style="width:10%"></div></div><div class="flex"><span>eternal</span><span>1.2k</span><div style="width:90%"></div></div></div>
<a href="/noses/Jane.html">Jane</a><a href="/noses/">Perfumers</a></body></html>"""


def test_detail_page(spark):
    p = spark.createDataFrame([(1, "u", DETAIL_PAGE), (2, "u", None)], "page_id long, url string, html string")
    r = pages.typed_records(pages.detail_records(p)).where("page_id = 1").first()
    assert (r.name, r.brand, r.year, r.family, r.rating, r.rating_count, r.image) == ("Chris 1947", "Maison", 2003, "Floral Woody Musk", 4.1, 9000, "i.png")
    assert [tuple(a) for a in r.attributes] == [("woody", 87.22, 50.0, "#ad7727")]
    assert [tuple(t) for t in r.tags] == [("top", "Pink Rose"), ("middle", "Musk")]
    assert [tuple(v) for v in r.votes] == [("winter", 50.0, 6300)] and r.longevity == "eternal" and r.sillage is None and r.people == ["Jane"]


def test_failed_page_stays(spark):
    p = spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string")

    def parse(html):
        if html == "b":
            raise KeyError("no")
        return {"n": 1}

    assert rows(pages.detail_records(p, parse, "n bigint, _error string"), "page_id", "n", "_error") == [(1, 1, None), (2, None, "KeyError: 'no'")]


def test_resolve_links(spark):
    df = spark.createDataFrame([("/a#x",), ("b.html",), ("//h/c",), ("https://q/z",)], "h string").select(pages.resolve(F.lit("https://s.t/d/e?f=1"), F.col("h")))
    assert rows(df) == [("https://h/c",), ("https://q/z",), ("https://s.t/a",), ("https://s.t/d/b.html",)]


def test_bronze(spark, tmp_path):
    (tmp_path / "items").mkdir()
    (tmp_path / "items" / "a.jsonl").write_text('{"url": "u1", "name": "x", "year": 2015}\n\n{bad\n{"brand_url": "b", "perfume_url": "p"}\n')
    (tmp_path / "flat.jsonl").write_text('{"brand_url": "b2"}\n{"other": 1}\n')
    df = bronze.read_jsonl(spark, str(tmp_path)).cache()
    assert rows(bronze.scan_report(df)) == [("group", 1), ("item", 1), ("listing", 1), ("malformed", 1), ("unknown", 1)]
    assert bronze.mixed_files(bronze.well_formed(df).where("kind is not null")).count() == 1
    assert bronze.of_kind(df, "listing", "brand_perfumes").count() == 0
    bronze.split_by_kind(df, str(tmp_path / "split"))
    assert {p.name for p in (tmp_path / "split").glob("kind=*")} == {"kind=item", "kind=group", "kind=listing"}


def test_csv_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿name;link\n\nx;https://a.com/1#f\n\"y;z\";https://a.com/2\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("https://a.com/3|https://b.com/9\n", encoding="utf-8")
    r = csv_links.rows_of(csv_links.read_lines(spark, str(tmp_path))).cache()
    assert rows(r.where("is_header"), "cells") == [(["name", "link"],)]
    assert rows(csv_links.url_columns(r), "column") == [(0,), (1,)]
    p = csv_links.pairs_by_host(r, "a.com")
    assert rows(p, "source", "destination") == [("https://a.com/1", None), ("https://a.com/2", None), ("https://a.com/3", "https://b.com/9")]
    assert csv_links.skipped(r, p).first().skipped == 0
    with pytest.raises(ValueError):
        csv_links.url_columns(r, named="nope")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    bronze.write_tables({"t": df}, {"t": "y string, x bigint"}, str(tmp_path / "s"))
    assert bronze.register(spark, str(tmp_path / "s"), ["t", "missing"]) == ["t"]
    bronze.staged(spark, ["t"])
    assert spark.table("stg_t").dtypes == [("y", "string"), ("x", "bigint")]
    bronze.write_csv(df, str(tmp_path / "c"), ["y", "z", "x"])
    text = next((tmp_path / "c").glob("*.csv")).read_text(encoding="utf-8")
    assert text.splitlines()[0] == "﻿y,z,x"
    bronze.append_jsonl(df, str(tmp_path / "j"))
    bronze.append_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    v = spark.createDataFrame([(1, "m", [0.5, 0.5])], "item int, model_id string, embedding array<double>")
    bronze.write_embeddings(v, str(tmp_path / "e"))
    assert bronze.read_embeddings(spark, str(tmp_path / "e"), "m").count() == 1
    t = spark.createDataFrame([(1, "acc", "x", 1.0)] * 2, "item int, block string, label string, weight double")
    bronze.load_serving(v, v, t, str(tmp_path / "g"), 2)
    assert spark.read.parquet(str(tmp_path / "g" / "terms")).count() == 1
    with pytest.raises(ValueError):
        bronze.load_serving(v, v, t, str(tmp_path / "g"), 3)


def test_schema_drift_and_freshness(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, z string")
    found = quality.schema_drift(df, StructType.fromDDL("x bigint, y string"), "t")
    assert found == [("t", "y", "missing, declared string"), ("t", "x", "int, declared bigint"), ("t", "z", "not declared, is string")]
    assert quality.schema_drift(None, StructType(), "t")[0][2].startswith("the table is missing")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df.write.parquet(a)
    df.write.parquet(b)
    for folder, at in ((a, 1_700_000_000), (b, 1_700_000_900)):
        for f in Path(folder).iterdir():
            os.utime(f, (at, at))
    old, new = spark.read.parquet(a), spark.read.parquet(b)
    assert quality.is_stale(new, old) and not quality.is_stale(old, new) and not quality.is_stale(old, old)
    assert quality.is_stale(old, new.where("x > 5"))  # nothing derived yet


def test_unknown_members(spark):
    df = star.fact(spark.createDataFrame([(None, 1), ("a", 2)], "k string, m int"), {"sk": "k"}, "m")
    assert ("-1", 1) in rows(df)


def test_stream_equals_batch(spark, tmp_path):
    from conftest import SF

    from larkspur.plans.page_queries import stream_failures, stream_sessions
    from larkspur.plans.search_queries import folded_outcomes, idle_sessions

    stream = {r.key: r.fail_count for r in stream_failures(spark, SF).collect()}
    assert stream == {r.key: r.fail_count for r in folded_outcomes(spark, SF).collect()}
    s = {(r.user_id, r.start // 1_000_000): r.n for r in stream_sessions(spark, SF).collect()}
    b = {(r.user_id, r.start // 1_000_000): r.n for r in idle_sessions(spark, SF).collect()}
    assert s and s == b


def test_streams_are_whole(spark, tmp_path):
    from larkspur.plans.page_queries import bursts, stream_bursts, stream_sessions
    from larkspur.plans.search_queries import idle_sessions

    # four hits within 24 h but in no window of 6 h steps, a run at the very end, gaps of exactly 6 h
    hours = [5.9, 12, 20, 29.8, 100, 106, 112.001, 300, 300, 300, 300.5, 301]
    spark.sql("SELECT inline(array(%s))" % ", ".join(f"struct({k} AS event_id, {u} AS user_id, timestamp_seconds({round(h * 3600)} + 1700006400) AS ts)" for u in (1, 2) for k, h in enumerate(hours, 100 * u))).selectExpr("cast(event_id as long) event_id", "cast(user_id as long) user_id", "cast(ts as timestamp_ntz) ts").write.parquet(f"{tmp_path}/events.parquet")
    for d in (str(tmp_path), "/root/testdata/sf0.001"):
        got = stream_bursts(spark, d)
        assert rows(got.select("user_id", "event_id", "hits")) == rows(bursts(spark, d))
        s = sorted((r.user_id, r.start // 1_000_000, r.n) for r in stream_sessions(spark, d).collect())
        assert s == sorted((r.user_id, r.start // 1_000_000, r.n) for r in idle_sessions(spark, d).collect())


def test_retriever_contract(spark):
    from larkspur.operators.retrieval import Retriever

    items = spark.createDataFrame([(1, "a", 50, "Nam"), (2, "a", 3, "Nữ"), (3, "b", 9, "Nam")], "item long, grp string, votes long, gender string")
    raw = spark.createDataFrame([(1, "note", "rose", 1.0), (2, "note", "rose", 1.0), (3, "note", "musk", 1.0), (1, "note", "musk", 0.2)], "item long, block string, label string, weight double")
    idf = spark.createDataFrame([("note", "rose", 2, 1.4), ("note", "musk", 2, 1.4)], "block string, label string, df long, idf double")
    vectors = spark.createDataFrame([(1, "a", "m", [1.0, 0.0]), (2, "a", "m", [0.9, 0.1]), (3, "b", "m", [0.0, 1.0])], "item long, grp string, model_id string, embedding array<double>")
    r = Retriever(items, sparse.combined(raw), idf, vectors)
    asked = spark.createDataFrame([(7, "note", "rose"), (7, "note", "unheard of")], "query long, block string, label string")
    assert [x.item for x in r.search(asked).orderBy("rank").collect()] == [2, 1]
    assert [x.item for x in r.search(asked, gender="nam").collect()] == [1] and r.search(asked, min_votes=60).count() == 0
    dense_q = spark.createDataFrame([(7, [1.0, 0.0])], "query long, embedding array<double>")
    assert [x.item for x in r.search(dense_q, 2).orderBy("rank").collect()] == [1, 2]
    assert r.size() == 3 and rows(r.vocabulary("note")) == [("musk",), ("rose",)] and r.similar_groups().count() == 2
    with pytest.raises(ValueError):
        r.vocabulary("nope")
    with pytest.raises(ValueError):
        Retriever(items, raw, idf).search(dense_q)


def test_links_resolve_as_browsers_do(spark):
    bases = ("http://h.com/a/b/c.html?q=1#f", "http://h.com", "http://h.com/", "https://h.com/a/b/")
    hrefs = ("?p=2", "#x", "", "../q", "./q", "../../../z", "q/r?x=../y", "/abs/../k", "//o.com/x#y", "http://z.com/a", "..", ".", "../", "a/./b", "mailto:x@y")
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string").select("b", "h", pages.resolve(F.col("b"), F.col("h")).alias("r"))
    assert all(r.r == urljoin(r.b, r.h).split("#")[0] for r in df.collect())
    html = "<a href=/k?a=1&amp;b=2>A &amp; B</a><a class=c href=\"q&amp;r\">t</a><a data-href=\"no\" href='z'>u</a>"
    p = spark.createDataFrame([(1, "http://h/x/", html)], "page_id int, url string, html string")
    assert rows(pages.all_links(p), "link", "text") == [("http://h/k?a=1&b=2", "A & B"), ("http://h/x/q&r", "t"), ("http://h/x/z", "u")]


def test_bins_of_a_scale(spark):
    values = [(3.9, 2), (0.0, 0), (10.0, 4), (11.0, 4), (-1.0, 0), (1.25, 0), (3.75, 2), (None, None)]
    df = spark.createDataFrame(values, "v double, want int").select("want", exprs.sequential_bin(F.col("v"), F.lit(0.0), F.lit(10.0), 5).alias("got"))
    assert all(r.want == r.got for r in df.collect())
    assert spark.range(1).select(exprs.sequential_bin(F.lit(1.0), F.lit(2.0), F.lit(2.0), 5)).first()[0] == 0


def test_stamps_by_their_type(spark):
    df = spark.createDataFrame([("a", 9, 1), ("a", 10, 2), ("a", None, 3)], "k string, s int, o int")
    assert rows(silver.latest(df, "k", "s", "o")) == [("a", 10, 2)]
    text = df.withColumn("s", F.col("s").cast("string"))
    assert rows(silver.latest(text, "k", "s", "o")) == [("a", "9", 1)]
    blank = spark.createDataFrame([("a", "", 1), ("a", None, 2)], "k string, s string, o int")
    assert rows(silver.latest(blank, "k", "s", "o"), "o") == [(2,)]


def test_hashed_rows_stay(spark):
    df = spark.createDataFrame([(1, "rose"), (1, "oud"), (None, "rose"), (2, None)], "k int, t string")
    got = dense.hashed(df, "k", "t").collect()
    assert len(got) == 4 and [r.k for r in got].count(1) == 2 and sum(r.k is None for r in got) == 1
    assert {tuple(r.embedding) for r in got if r.k == 1} != {tuple([0.0] * 64)} and all(len(r.embedding) == 64 for r in got)


def test_pairs_by_source_and_by_name(spark, tmp_path):
    text = "No;Source;Goal\n1;https://a.h/x#1;d1\n2;/x;d2\n3;https://a.h/x;d3\n4;none;d4\n5;https://a.h/z; \n"
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text("https://sub.a.h/q,https://other.net/p#keep\nno links,here\n")
    lines = csv_links.rows_of(csv_links.read_lines(spark, str(tmp_path / "a.csv")))
    assert rows(csv_links.pairs_by_column(lines, "source", "GOAL", "https://a.h/y/"), "source", "destination") == [("https://a.h/x", "d1"), ("https://a.h/z", None)]
    assert csv_links.pairs_by_column(lines, 1, 2, "https://a.h/y/", unique=False).count() == 4
    for bad in (dict(source="nope"), dict(source="source", destination="nope")):
        with pytest.raises(ValueError, match="nope"):
            csv_links.pairs_by_column(lines, **bad)
    other = csv_links.rows_of(csv_links.read_lines(spark, str(tmp_path / "b.csv")))
    with pytest.raises(ValueError):
        csv_links.pairs_by_column(other, "source")
    assert rows(csv_links.pairs_by_host(other, "a.h"), "source", "destination") == [("https://sub.a.h/q", "https://other.net/p#keep")]


def test_large_files_keep_their_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("first;x\n" + "".join(f"{k};https://a.h/{k}\n" for k in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = csv_links.read_lines(spark, str(tmp_path / "a.txt"))
        assert lines.rdd.getNumPartitions() > 4
        read = csv_links.rows_of(lines)
        assert rows(read.where("is_header"), "cells") == [(["first", "x"],)]
        assert [r.text.split(";")[0] for r in lines.orderBy("line").limit(3).collect()] == ["first", "0", "1"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_search_text(spark):
    q = spark.createDataFrame([(1, "Tìm mùi gỗ oud cho mùa đông a winter night"), (2, None)], "query int, text string")
    got = {r.query: r for r in search.read_text(q).collect()}
    assert got[1].read_axes == ["winter", "night"] and sorted(got[1].tokens) == ["gỗ", "mùa", "oud", "đông"] and got[2].tokens == []
    weights = spark.createDataFrame([("note", "oud wood", 9), ("note", "oud", 2), ("acc", "gỗ trầm", 5), ("note", "x", 1)], "block string, label string, df long")
    r = {x.query: x for x in search.resolved_terms(search.read_text(q), weights).collect()}
    assert r[1].matched == ["gỗ trầm", "oud"] and r[1].unknown == ["mùa", "đông"] and r[2].matched == r[2].unknown == []


def test_containing_is_a_plain_search(spark):
    words = ["a", "ab", "abc", "rose", "ose", "os", "é", "ééa", "zz", "rose rose"]
    labels = ["rose", "rosewood", "abcabc", "xé", "ééab", "a", "", "rose rose b"]
    got = rows(sparse.containing(spark.createDataFrame([(w,) for w in words], "part string"), spark.createDataFrame([(x,) for x in labels], "label string")), "part", "label")
    assert got == sorted(((w, x) for w in words for x in labels if w in x), key=repr)


def test_pointers(spark):
    said = [("chai thứ 2", "b"), ("chai thứ 9", None), ("chai đầu tiên", "a"), ("cái cuối", "c"), ("chai thứ hai", "b"), ("chai đó có gì", "a"), ("bao nhiêu", None), ("chai thứ 9 đó, chai đó", "a"), ("số năm", None)]
    df = spark.createDataFrame([(t, ["a", "b", "c"], w) for t, w in said], "text string, shown array<string>, want string")
    assert all(r.got == r.want for r in df.withColumn("got", dialog.pointed(df)).collect())
    assert df.limit(1).withColumn("shown", F.array().cast("array<string>")).select(dialog.pointed(df)).first()[0] is None


def test_history_shows_the_list(spark):
    t = spark.createDataFrame([(1, 0, "user", "hi", None), (1, 1, "assistant", "two", ["x", "y"]), (1, 2, "user", None, None)], "conv_id int, turn int, role string, text string, shown array<string>")
    assert {r.turn: r.history for r in dialog.with_history(t).collect()}[2] == "Khách: hi\nBạn: two\n  (đã hiện cho khách: 1. x; 2. y)"


def test_answers(spark):
    schema = "query int, rank int, name string, grp string, rating double, votes long, reasons array<struct<block:string,label:string>>"
    r = spark.createDataFrame([(1, 1, "Oud", "G", 4.256, 12345, [("note", "rose"), ("occ", "night")]), (1, 2, "B", "G", None, None, None), (1, 3, "C", None, None, None, None), (1, 4, "D", None, 1.0, 1, None), (2, 1, None, None, 3.0, 7, None)], schema)
    got = {x.query: x.answer for x in dialog.answers(r, spark.createDataFrame([(1,), (2,), (3,)], "query int")).collect()}
    assert got[1] == (
        "Mình nghĩ Oud của G là sát ý bạn nhất — note rose, hợp buổi tối. Chai này có 12.345 lượt đánh giá, trung bình 4.26/5 — khá nhiều người đã dùng. "
        "Cùng hướng đó còn có B và C, bạn xem thử bên cạnh. Bạn thích mùi ngọt ấm hay khô nhẹ hơn?"
    )
    assert got[2].startswith("Mình nghĩ chai này là sát ý bạn nhất. Mới có 7 lượt đánh giá nên điểm 3.00/5") and got[3].startswith("Mình chưa tìm được")


def test_directory_order_and_json(spark):
    df = spark.createDataFrame([("b", "Zed"), (None, "a"), ("b", "alpha"), ("a", None)], "letter string, name string")
    assert [tuple(r) for r in silver.in_directory_order(df, "letter", "name").collect()] == [("a", None), ("b", "alpha"), ("b", "Zed"), (None, "a")]
    texts = [('x {"a": {"b": 1}} y', '{"a": {"b": 1}}'), ("no", None), ("{broken", None), ("{a} {", None), ("", None)]
    j = spark.createDataFrame(texts, "t string, want string").withColumn("got", dialog.json_object(F.col("t")))
    assert all(r.got == r.want for r in j.collect())
