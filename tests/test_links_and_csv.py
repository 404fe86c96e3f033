"""Links of odd markup, and CSV records that run over lines, against csv.reader and DuckDB."""

import csv
import io
import random

import duckdb
import pytest

from larkspur.operators import pages
from larkspur.sources import csv_links


def links(html, **how):
    return [(href, text) for href, text, _, _ in pages.links_of(html, **how)]


def test_odd_markup():
    assert links('<a href="/x&#x2F;y&amp;z=&#49;">t&eacute;&nbsp;u</a>') == [("/x/y&z=1", "té u")]
    assert links("<a href=/1>one<a href='/2'>two</a>") == [("/1", "one"), ("/2", "two")]
    assert links('<a title="a>b" href="/1">x</a>') == [("/1", "x")]
    assert links("<A HREF=/1><b>x</b>y</A> z") == [("/1", "x y")]
    assert links('<a name="n">x</a><a href>y</a><a href="">z</a>') == [("", "z")]
    assert links('<!-- <a href="/1">x</a> --><script>"<a href=/2>"</script><a href="/3">z') == [("/3", "z")]
    assert links('<a href="/1" href="/2">x') == [("/1", "x")]
    assert links("") == links(None) == links("<") == links("<a") == []
    assert links("<a href='/1'>" * 3000)[-1] == ("/1", "") and len(links("<a href='/1'>" * 3000)) == 3000


def test_sections_of_links():
    html = "<a href=/0>p</a><h2 id=A>A</h2><a href=/1>one<span id='B'>B</span><h3>no id</h3><a href=/2>two"
    assert pages.links_of(html) == [("/0", "p", 0, None), ("/1", "one", 1, "A"), ("/2", "two", 2, "B")]
    assert [x[2] for x in pages.links_of(html, ("h3",), False)] == [0, 0, 1]


def test_links_of_rows(spark):
    rows = [(1, "http://h/a/b", '<a href="c?q=1&#35;f">x</a><a href="../d">y'), (1, "http://h/a/b", None), (None, None, "<a href=http://g/>z</a>"), (2, "http://h", "<p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(repr, (tuple(r) for r in pages.all_links(df).select("page_id", "position", "link", "text").collect())))
    assert got == sorted(map(repr, [(1, 0, "http://h/a/c?q=1", "x"), (1, 1, "http://h/d", "y"), (None, 0, "http://g/", "z")]))
    extra = pages.section_links(df.limit(0), "^/", ["A"])
    assert extra.count() == 0 and "extra" in extra.columns


def cells_of(spark, path):
    rows = csv_links.rows_of(csv_links.read_records(spark, str(path))).orderBy("file", "line").collect()
    return [list(r.cells) for r in rows]


def read_by_csv(text, delimiter=","):
    rows = csv.reader(io.StringIO(text), delimiter=delimiter)
    return [[c.strip() for c in r] for r in rows if any(c.strip() for c in r)]


def test_quoted_line_breaks(spark, tmp_path):
    text = 'name;url\n"two\nlines";https://a.b/1\n;\n\n"a;""b""\n\n;c";https://a.b/2\n5" pipe;https://a.b/3\n"x" y;z\n'
    path = tmp_path / "a.csv"
    path.write_text(text, encoding="utf-8-sig")
    assert cells_of(spark, path)[:4] == [["name", "url"], ["two\nlines", "https://a.b/1"], ['a;"b"\n\n;c', "https://a.b/2"], ['5" pipe', "https://a.b/3"]]
    db = duckdb.sql(f"SELECT * FROM read_csv('{path}', delim=';', quote='\"', escape='\"', header=true, all_varchar=true, strict_mode=false, null_padding=true, parallel=false)").fetchall()
    assert [list(r) for r in db if any(r)][:2] == cells_of(spark, path)[1:3]


@pytest.mark.parametrize("seed", range(6))
def test_records_against_csv_reader(spark, tmp_path, seed):
    """Files of cells of every kind, cut into many blocks: a record may begin in one and end in another."""
    rng = random.Random(seed)
    delimiter = ",;\t|"[seed % 4]
    cells = ["", "plain", "two words", f"a{delimiter}b", 'q"uote', "line\nbreak", "\n\n", '"', '""x', f"{delimiter}\n{delimiter}", "https://a.b/c"]
    out = io.StringIO()
    writer = csv.writer(out, delimiter=delimiter, lineterminator="\n")
    writer.writerow(["first", "second", "third"])
    for _ in range(120):
        writer.writerow([rng.choice(cells) for _ in range(3)])
    path = tmp_path / "a.csv"
    path.write_text(out.getvalue(), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert csv_links.raw_lines(spark, str(path)).select("line.block").distinct().count() > 4
        got = cells_of(spark, path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == read_by_csv(out.getvalue(), delimiter)


def test_quote_that_stays_open(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_links, "RECORD_LINES", 20)
    path = tmp_path / "a.csv"
    path.write_text('a,b\n"open,1\n' + "x,y\n" * 50)
    with pytest.raises(Exception, match="stays open"):
        cells_of(spark, path)


def test_ends_quoted():
    of = lambda t: (csv_links.ends_quoted(t, ",", False), csv_links.ends_quoted(t, ",", True))
    assert of("a,b") == (False, True) and of('"a') == (True, False) and of('a"') == (False, False)
    assert of('x"y",z') == (False, False) and of('"a""') == (True, False) and of('","') == (False, True)
    assert of("") == (False, True) and of('"') == (True, False) and of('a,"') == (True, False)
    assert csv_links.ends_quoted('a,"' * 100_000, ",", False) in (True, False)


def test_empty_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n \n")
    assert cells_of(spark, tmp_path) == []


def test_serving_tables_keep_stated_rows(spark, tmp_path):
    """Of several vectors the last stays, of several terms the first, by a stated column."""
    from larkspur.sources import bronze

    items = spark.createDataFrame([(1,), (2,)], "item long")
    vectors = spark.createDataFrame([(1, [1.0, 2.0], 5), (1, [9.0, 9.0], 3), (2, [0.0, 1.0], 1)], "item long, embedding array<double>, at int").repartition(3)
    terms = spark.createDataFrame([(1, "note", "a", 0.5, 2), (1, "note", "a", 0.1, 7), (2, "note", "a", 0.3, 1)], "item long, block string, label string, weight double, at int").repartition(3)
    for order, vector, weight in (("at", [1.0, 2.0], 0.5), (None, [9.0, 9.0], 0.1)):
        bronze.load_serving(items, vectors, terms, str(tmp_path / "s"), 2, order)
        got = {r.item: r.embedding for r in spark.read.parquet(str(tmp_path / "s/vectors")).collect()}
        assert got == {1: vector, 2: [0.0, 1.0]}
        assert {r.item: r.weight for r in spark.read.parquet(str(tmp_path / "s/terms")).collect()} == {1: weight, 2: 0.3}


@pytest.mark.parametrize("files,want", [(1, 1), (3, 3), (None, 4)])
def test_report_files(spark, tmp_path, files, want):
    import glob

    from larkspur.sources import bronze

    df = spark.range(40).withColumnRenamed("id", "k").repartition(4)
    bronze.write_csv(df, str(tmp_path / "r"), ["k", "none"], files=files)
    assert len(glob.glob(str(tmp_path / "r/*.csv"))) == want
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 40
