"""Page extraction, sources and streaming over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import pages, silver
from larkspur.sources import bronze, csv_links
from larkspur.sources.scratch import new_folder
from larkspur.streaming import jobs, upserts

from . import bind
from .registry import query


def _pages(spark, d):
    return bind.t(spark, d, "pages")


_L = r"""l AS (SELECT page_id, url, pos - 1 AS position, h AS href, x AS inner_html FROM (
SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS h, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2)) AS x,
generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1), 1) AS pos FROM pages)),
k AS (SELECT *, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || href AS link, trim(regexp_replace(regexp_replace(inner_html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM l WHERE starts_with(href, '/'))"""


@query("WITH " + _L + " SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY position) AS place FROM (SELECT page_id, link, min(position) AS position FROM k WHERE regexp_matches(href, '^/[a-zA-Z]') GROUP BY 1, 2)")
def page_links(spark, d):
    return pages.links(_pages(spark, d), "^/[a-zA-Z]").withColumn("place", F.col("place").cast("long"))


@query("WITH " + _L + " SELECT page_id, link, coalesce(nullif(any_value(text), ''), '') AS name FROM k WHERE regexp_matches(href, '^/([^/]+)$') GROUP BY 1, 2")
def page_named_links(spark, d):
    return pages.named_links(_pages(spark, d), "^/([^/]+)$").select("page_id", "link", "name")


@query("WITH " + _L + " SELECT page_id, link, name, row_number() OVER (PARTITION BY page_id ORDER BY p) AS rank FROM (SELECT page_id, link, any_value(text) AS name, min(position) AS p FROM k WHERE regexp_matches(href, '^/([^/]+)$') GROUP BY 1, 2)")
def page_ranked_links(spark, d):
    return pages.ranked_links(_pages(spark, d), "^/([^/]+)$").select("page_id", "link", "name", F.col("rank").cast("long").alias("rank"))


@query("WITH " + _L + ", s AS (SELECT page_id, upper(text) AS letter, arg_min(link, position) AS page FROM k WHERE regexp_matches(text, '^[A-Za-z]$') GROUP BY 1, 2) SELECT page_id, letter, page FROM s")
def page_section_index(spark, d):
    return pages.section_index(_pages(spark, d)).select("page_id", "letter", "page")


@query("WITH " + _L + ", s AS (SELECT page_id, upper(text) AS letter, arg_min(link, position) AS page FROM k WHERE regexp_matches(text, '^[A-Za-z]$') GROUP BY 1, 2) SELECT page, string_agg(DISTINCT letter, '' ORDER BY letter) AS letters FROM s GROUP BY 1")
def pages_of_index(spark, d):
    return pages.pages_of_index(pages.section_index(_pages(spark, d))).select("page", F.array_join("letters", "").alias("letters"))


@query("SELECT page_id, CAST(len(string_split_regex(html, '<h1')) AS BIGINT) AS n_sections FROM pages")
def page_sections(spark, d):
    rows = pages.sections(_pages(spark, d), anchor=r"(?is)<(h1)")
    return rows.groupBy("page_id").agg(F.count("*").alias("n_sections"))


@query(r"""WITH x AS (SELECT page_id, url, unnest(string_split(html, '<li')) AS part, generate_subscripts(string_split(html, '<li'), 1) - 1 AS section FROM pages),
k AS (SELECT page_id, section, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, unnest(regexp_extract_all('<li' || part, '(?is)<a\b[^>]*?\bhref\s*=\s*"(/[^"]*)"[^>]*>(.*?)</a>', 1)) AS href FROM x)
SELECT page_id, section, root || replace(href, '&amp;', '&') AS link FROM k WHERE regexp_matches(replace(href, '&amp;', '&'), '^/([^/]+)$')""")
def page_section_links(spark, d):
    """Links by the list entry that they stand in, the page's part before the first entry being 0."""
    rows = pages.section_links(_pages(spark, d), "^/([^/]+)$", marks=("li",), with_id=False)
    return rows.select("page_id", "section", "link")


@query("WITH " + _L + """ SELECT page_id, link, place FROM (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY position) AS place
FROM (SELECT page_id, link, min(position) AS position FROM k WHERE regexp_matches(href, '^/[a-zA-Z]') GROUP BY 1, 2)) WHERE place <= 2""")
def page_links_limited(spark, d):
    """The limit of links a page, as a crawl takes it."""
    return pages.links(_pages(spark, d), "^/[a-zA-Z]", limit=2).withColumn("place", F.col("place").cast("long"))


def _directory(spark, d):
    """A page a nation with its customers under a heading a segment: numeric references, a > inside an
    attribute, anchors that are not closed, and a link that stands twice."""
    k = F.col("c_custkey").cast("string")
    ref = F.concat(F.lit("&#"), (F.ascii(F.substring(k, 1, 1))).cast("string"), F.lit(";"), F.substring(k, 2, 20))
    shut = F.when(F.col("c_custkey") % 2 == 0, "</a>").otherwise("")
    link = F.concat(F.lit("<li><a title='a>b' href=\"/c&#x2F;"), ref, F.lit("?x=1&amp;y=2#top\">"), F.regexp_replace("c_name", "#", "&#x23;"), shut)
    of = bind.t(spark, d, "customer").select("c_nationkey", "c_mktsegment", "c_custkey", link.alias("link"))
    part = of.groupBy("c_nationkey", "c_mktsegment").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "link"))), lambda x: x["link"]), "\n").alias("links"))
    part = part.select("c_nationkey", "c_mktsegment", F.concat(F.lit("<h2 id='"), F.substring("c_mktsegment", 1, 1), F.lit("'>"), F.col("c_mktsegment"), F.lit("</h2>"), F.col("links"), F.lit("<a href='/c/top'>top<b>most</b></a>")).alias("html"))
    html = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_mktsegment", "html"))), lambda x: x["html"]), "")
    return part.groupBy(F.col("c_nationkey").alias("page_id")).agg(html.alias("html")).withColumn("url", F.lit("https://a.example.com/index.html"))


@query("""SELECT page_id, anchor, link, name, anchor NOT IN ('A', 'B') AS extra FROM (
SELECT c_nationkey AS page_id, substr(c_mktsegment, 1, 1) AS anchor, 'https://a.example.com/c/' || c_custkey || '?x=1&y=2' AS link, c_name AS name FROM customer
UNION SELECT c_nationkey, substr(c_mktsegment, 1, 1), 'https://a.example.com/c/top', 'top most' FROM customer)""")
def page_extra_links(spark, d):
    """Links by section, and whether the section is one that was expected."""
    return pages.section_links(_directory(spark, d), "^/c/(.+)$", ["a", "B"]).select("page_id", "anchor", "link", "name", "extra")


@query("""SELECT p_partkey AS item, CASE p_size % 5 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN p_name WHEN 2 THEN split_part(p_name, ' ', 1) WHEN 3 THEN p_name || ' form' ELSE p_name END AS name FROM part""")
def clean_names(spark, d):
    """Titles with the gender phrases, with and without the group's name, a group that is null or not at the end."""
    p = bind.t(spark, d, "part").withColumn("w", F.split("p_name", " "))
    k, last = F.col("p_size") % 5, F.try_element_at("w", F.lit(-1))
    tail = F.array(*map(F.lit, (" for Women and Men 2012", " FOR men", " for women  eau", " form", "")))
    group = F.when(k == 0, last).when(k == 1, F.lit(None)).when(k == 2, last).when(k == 3, last).otherwise(F.lit(""))
    return p.select(F.col("p_partkey").alias("item"), pages.clean_name(F.concat("p_name", F.get(tail, k)), group).alias("name"))


@query("""SELECT o_orderkey AS item, CASE o_orderkey % 6 WHEN 0 THEN year(o_orderdate) WHEN 1 THEN 2003 WHEN 2 THEN year(o_orderdate) WHEN 3 THEN 2001 WHEN 4 THEN 2010 END::INT AS year FROM orders""")
def launch_years(spark, d):
    """A launch sentence, a title's last year, a description's last year, a link's first, released before others, none."""
    o = bind.t(spark, d, "orders")
    k, y = F.col("o_orderkey") % 6, F.year("o_orderdate").cast("string")
    text = F.when(k == 0, F.concat(F.lit("Chris 1947 was launched in spring "), y, F.lit(". Since 2020 new."))).when(k == 2, F.concat(F.lit("Of 1990 or "), y))
    text = text.when(k == 4, "Released by X in 2010, launched again in 2012.")
    title = F.when(k == 1, "Chris 1947 2003").when(k == 5, "Chris 3003")
    return o.select(F.col("o_orderkey").alias("item"), pages.year_of(text, title, F.when(k == 3, "/2001/2002").otherwise("no year")).alias("year"))


@query("""SELECT p_partkey AS item, ['Floral Woody Musk', 'Woody', NULL, 'Citrus', 'Oriental Spicy', NULL, 'Aromatic Fougere'][CAST(p_size % 7 AS INT) + 1] AS family FROM part""")
def stated_families(spark, d):
    """Frames with known families in any case and spacing, the longest one, unknown ones and none."""
    said = ("X is a floral  woody musk fragrance for all", "Y is a Woody fragrance", "Z is a strange fragrance", "It is a CITRUS fragrance. It is a Woody fragrance.",
            "W is an Oriental Spicy fragrance", "a Woody perfume", "V is an aromatic fougere fragrance")
    text = F.get(F.array(*map(F.lit, said)), F.col("p_size") % 7)
    return bind.t(spark, d, "part").select(F.col("p_partkey").alias("item"), pages.family_of(text).alias("family"))


@query("""SELECT p_partkey AS item, CASE p_size % 4 WHEN 0 THEN 'Nữ' WHEN 1 THEN 'Nam' WHEN 2 THEN 'Unisex' END AS gender,
CASE WHEN p_size % 3 = 0 THEN 1000 + p_size WHEN p_size % 3 = 1 THEN p_size END::INT AS comments, CASE WHEN p_size % 5 > 1 THEN 1950 + p_size END::INT AS year FROM part""")
def listing_fields(spark, d):
    p, n = bind.t(spark, d, "part"), F.col("p_size")
    classes = F.when(n % 4 == 0, "a tw-listview-item-female").when(n % 4 == 1, "tw-listview-item tw-listview-item-male b").when(n % 4 == 2, "tw-listview-item-unisex").otherwise("other")
    comments = F.when(n % 3 == 0, F.format_number(n + 1000, 0)).when(n % 3 == 1, F.concat(F.lit(" "), n.cast("string"))).otherwise("many")
    year = F.when(n % 5 == 0, "0000").when(n % 5 == 1, "soon").otherwise((n + 1950).cast("string"))
    rows = p.select(F.col("p_partkey").alias("item"), classes.alias("classes"), comments.alias("comments"), year.alias("year"))
    return pages.listing_fields(rows).drop("classes")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 100 <= 1 THEN round(l_discount * 100, 2) * 100 ELSE round(l_discount * 100, 2) END AS pct FROM lineitem")
def css_ratios(spark, d):
    style = F.concat(F.lit("opacity:1; width: "), F.round(F.col("l_discount") * 100, 2).cast("string"), F.lit(";"))
    return bind.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", pages.ratio_of(style, "width").alias("pct"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey WHEN 1 THEN 6300 WHEN 2 THEN 1200000 END AS n FROM orders")
def abbreviated_counts(spark, d):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.format_number("o_orderkey", 0)).when(k == 1, "6.3k").when(k == 2, "1.2M").otherwise("many")
    return bind.t(spark, d, "orders").select("o_orderkey", pages.count_of(text).alias("n"))


@query("SELECT l_orderkey AS key, arg_max(l_shipmode_, (l_quantity, -(l_linenumber * 10000000 + l_partkey))) AS label FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode_ FROM lineitem) GROUP BY 1")
def top_labels(spark, d):
    v = bind.t(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.concat("l_returnflag", "l_linestatus").alias("label"), F.col("l_quantity").alias("votes"), (F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")).alias("position"))
    return pages.top_label(v, "key")


_CARRY = """c AS (SELECT user_id AS page_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position, CASE WHEN event_type IN ('signup', 'error') THEN event_type || '' END AS header, CASE WHEN event_type NOT IN ('signup', 'error') THEN floor(value) END AS item FROM events),
f AS (SELECT page_id, item, nullif(last_value(header IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY position), 'error') AS section, position FROM c)"""


def _tokens(spark, d):
    from pyspark.sql import Window

    head = F.col("event_type").isin("signup", "error")
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return bind.t(spark, d, "events").select(F.col("user_id").alias("page_id"), at.alias("position"), F.when(head, F.col("event_type")).alias("header"), F.when(~head, F.floor("value")).cast("double").alias("item"))


@query("WITH " + _CARRY + " SELECT page_id, item, section, CAST(min(position) AS INT) AS position FROM f WHERE item IS NOT NULL GROUP BY 1, 2, 3")
def carried_sections(spark, d):
    return pages.carried_sections(_tokens(spark, d), "error")


@query("SELECT DISTINCT user_id AS page_id, 'signup' AS section FROM events WHERE event_type = 'signup'")
def section_list(spark, d):
    return pages.section_list(_tokens(spark, d), "error")


@query("""SELECT x.section, coalesce(n, 0) AS n, n IS NULL AS missing, coalesce(f, 0) AS failed FROM (SELECT unnest(['signup', 'view', 'refund']) AS section) x
LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ON event_type = section LEFT JOIN (SELECT event_type AS e, count(*) AS f FROM events WHERE value > 50 AND event_type = 'signup' GROUP BY 1) ON e = section""")
def section_completeness(spark, d):
    found = bind.t(spark, d, "events").select(F.col("event_type").alias("section"), "value")
    return pages.completeness(found, ["signup", "view", "refund"], found.where("value > 50 and section = 'signup'"))


@query()
def detail_pages(spark, d):
    """Every page to one typed record; failures stay with their page."""
    rows = pages.typed_records(pages.detail_records(_pages(spark, d)))
    return rows.select("page_id", "name", "year", "family", "_error")


# Sources: records and lists that Spark writes from the tables and reads back


def _scratch(spark: SparkSession, df: DataFrame, name: str, kind: str) -> str:
    path = f"{new_folder(spark)}/{name}"
    getattr(df.write, kind)(path)
    return path


def _raw(spark, d):
    p = bind.t(spark, d, "part")
    k = F.col("p_partkey") % 4
    key = F.concat(F.lit("https://shop.example.com/i/"), F.col("p_partkey").cast("string"))
    body = F.when(k == 0, F.to_json(F.struct(key.alias("url"), F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("year"))))
    size, brand = F.col("p_size").cast("string"), F.col("p_brand").alias("brand_name")
    group = F.struct(key.alias("brand_url"), brand, F.substring("p_brand", 7, 1).alias("alphabet"), size.alias("popular_rank"), F.lit("2024-01-02T03:04:05").alias("scraped_at"))
    year = F.when(F.col("p_size") % 2 == 0, F.col("p_size") + 1970).otherwise(F.lit(None)).cast("string")
    listing = F.struct(key.alias("brand_url"), key.alias("perfume_url"), F.col("p_name").alias("perfume_name"), brand, F.col("p_type").alias("collection"), year.alias("year"), F.lit("male").alias("gender"), F.col("p_size").cast("long").alias("comments"))
    body = body.when(k == 1, F.to_json(group)).when(k == 2, F.to_json(listing))
    return p.select("p_partkey", body.otherwise(F.when(F.col("p_partkey") % 8 == 3, '{"note": 1}').otherwise('{"url": "broken')).alias("value"))


def _bronze(spark, d):
    return bronze.read_jsonl(spark, _scratch(spark, _raw(spark, d).select("value"), "raw", "text"), files="part-*")


@query("""SELECT CASE p_partkey % 4 WHEN 0 THEN 'item' WHEN 1 THEN 'group' WHEN 2 THEN 'listing' ELSE CASE WHEN p_partkey % 8 = 3 THEN 'unknown' ELSE 'malformed' END END AS kind, count(*) AS n FROM part GROUP BY 1""")
def bronze_scan_report(spark, d):
    return bronze.scan_report(_bronze(spark, d))


@query("""SELECT CASE p_partkey % 4 WHEN 0 THEN 'item' WHEN 1 THEN 'group' WHEN 2 THEN 'listing' ELSE CASE WHEN p_partkey % 8 = 3 THEN 'unknown' ELSE 'malformed' END END AS kind, count(*) AS n FROM part GROUP BY 1""")
def bronze_observed_report(spark, d):
    """The same counts, taken while the records are split by kind."""
    rows, seen = bronze.observed(_bronze(spark, d))
    bronze.split_by_kind(rows, f"{new_folder(spark)}/split")
    return bronze.observed_report(spark, seen)


@query("SELECT 'https://shop.example.com/i/' || p_partkey AS url, p_name AS name, CAST(p_size AS INT) AS year FROM part WHERE p_partkey % 4 = 0")
def bronze_items(spark, d):
    rows = bronze.of_kind(bronze.well_formed(_bronze(spark, d)), "item")
    return rows.select("url", "name", F.col("year").try_cast("int").alias("year"))


@query("""SELECT u AS perfume_key, u AS perfume_url, u AS brand_key, p_brand AS brand_name, p_name AS perfume_name, p_type AS collection, CAST(CASE WHEN p_size % 2 = 0 THEN p_size + 1970 END AS INT) AS year,
'Nam' AS gender, CAST(p_size AS BIGINT) AS comments FROM (SELECT *, 'https://shop.example.com/i/' || p_partkey AS u FROM part WHERE p_partkey % 4 = 2)""")
def bronze_listings(spark, d):
    return silver.listing_rows(bronze.of_kind(_bronze(spark, d), "listing"))


@query("""SELECT 'https://shop.example.com/i/' || p_partkey AS brand_key, 'https://shop.example.com/i/' || p_partkey AS brand_url, p_brand AS brand_name, substr(p_brand, 7, 1) AS alphabet,
CAST(p_size AS INT) AS popular_rank, '2024-01-02T03:04:05' AS scraped_at FROM part WHERE p_partkey % 4 = 1""")
def bronze_groups(spark, d):
    return silver.group_rows(bronze.of_kind(_bronze(spark, d), "group"))


def _csv(spark, d):
    o = bind.t(spark, d, "customer")
    text = F.concat_ws(";", F.col("c_custkey").cast("string"), F.concat(F.lit("https://a.example.com/c/"), F.col("c_custkey").cast("string"), F.lit("#x")), F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit(';q"')), F.concat(F.lit("https://b.example.net/"), (F.col("c_custkey") % 9).cast("string")))
    return csv_links.rows_of(csv_links.read_records(spark, _scratch(spark, o.select(text.alias("value")), "list.csv", "text")))


@query("SELECT 'https://a.example.com/c/' || (c_custkey % 500) AS source, arg_min('https://b.example.net/' || (c_custkey % 9) || '#y', c_custkey) AS destination FROM customer GROUP BY 1")
def csv_pairs_by_host(spark, d):
    """Sources repeat with other destinations: the first row of each counts, its destination as it stands."""
    c, k = bind.t(spark, d, "customer"), F.col("c_custkey")
    first = F.concat(F.lit("https://b.example.net/"), (k % 9).cast("string"), F.lit("#y"))
    text = F.concat_ws(",", F.concat(F.lit("x "), first), F.concat(F.lit("https://a.example.com/c/"), (k % 500).cast("string"), F.lit("#x")))
    path = _scratch(spark, c.repartition(1).sortWithinPartitions(k).select(text.alias("value")), "list.csv", "text")
    return csv_links.pairs_by_host(csv_links.rows_of(csv_links.read_records(spark, path)), "a.example.com").select("source", "destination")


def _headed(spark, d):
    """Files with a header, written by Spark's CSV writer: number, relative URL, segment, destination."""
    c, k = bind.t(spark, d, "customer"), F.col("c_custkey")
    rows = c.select(k.alias("No"), F.concat(F.lit("/c/"), (k % 700).cast("string"), F.lit("#f")).alias("Link"), F.col("c_mktsegment").alias("kind"), F.concat(F.lit("d"), (k % 700 % 9).cast("string")).alias("Goal"))
    path = f"{new_folder(spark)}/headed"
    rows.write.option("header", True).option("sep", "|").csv(path)
    return csv_links.rows_of(csv_links.read_records(spark, path))


@query("SELECT DISTINCT 'https://a.example.com/c/' || (c_custkey % 700) AS source, 'd' || (c_custkey % 700 % 9) AS destination FROM customer")
def csv_pairs_by_name(spark, d):
    """Columns by header, in any case; an unknown one is an error."""
    rows = _headed(spark, d)
    try:
        csv_links.pairs_by_column(rows, "no such column")
    except ValueError:
        return csv_links.pairs_by_column(rows, "LINK", "goal", "https://a.example.com/x").select("source", "destination")
    raise AssertionError("an unknown column passed")


@query("SELECT 1 AS col, count(*) AS n, count(*) FILTER (c_custkey < 0) AS skipped FROM customer")
def csv_url_columns(spark, d):
    """The column with a known header, and the rows below the headers."""
    rows = _headed(spark, d)
    col = csv_links.url_columns(rows).select("column").distinct()
    n = rows.where("not is_header").agg(F.count("*").alias("n"), F.count_if(F.get("cells", 1).isNull()).alias("skipped"))
    return col.crossJoin(n).select(F.col("column").alias("col"), "n", "skipped")  # one row each


@query("SELECT DISTINCT 'https://a.example.com/c/' || c_custkey AS source, 'https://b.example.net/' || (c_custkey % 9) AS destination FROM customer")
def csv_pairs_by_column(spark, d):
    return csv_links.pairs_by_column(_csv(spark, d), 1, 3, "https://a.example.com/").select("source", "destination")


@query("SELECT count(*) AS cells, count(*) FILTER (c_mktsegment <> '') AS quoted FROM customer")
def csv_quoted_cells(spark, d):
    rows = _csv(spark, d)
    return rows.agg(F.sum(F.when(F.size("cells") == 4, 1).otherwise(0)).cast("long").alias("cells"), F.count_if(F.endswith(F.get("cells", 2), F.lit(";q"))).alias("quoted"))


@query("""SELECT c_custkey AS k, chr(34) || c_mktsegment || chr(34) || CASE c_custkey % 3 WHEN 0 THEN chr(10) WHEN 1 THEN ',' ELSE chr(10) || chr(10) || 'x,' END || 'z' AS note,
'https://b.example.net/' || c_custkey AS url FROM customer""")
def csv_line_breaks(spark, d):
    """Cells with line breaks, blank lines, delimiters and quotes in them, and rows of empty cells between."""
    k = F.col("c_custkey")
    inner = F.when(k % 3 == 0, "\n").when(k % 3 == 1, ",").otherwise("\n\nx,")
    note = F.concat(F.lit('"""'), F.col("c_mktsegment"), F.lit('""'), inner, F.lit('z"'))
    line = F.concat(k.cast("string"), F.lit(","), note, F.lit(",https://b.example.net/"), k.cast("string"), F.when(k % 5 == 0, '\n,"  ",\n').otherwise(""))
    rows = csv_links.rows_of(csv_links.read_records(spark, _scratch(spark, bind.t(spark, d, "customer").select(line.alias("value")), "breaks.csv", "text")))
    cell = lambda i: F.get("cells", i)
    return rows.where("not is_header").select(cell(0).cast("long").alias("k"), cell(1).alias("note"), cell(2).alias("url"))


@query("SELECT 'https://c.example.org/' || o_orderkey AS url FROM orders WHERE o_orderkey % 3 <> 0")
def text_url_list(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, "# note").otherwise(F.concat(F.lit(" https://c.example.org/"), k.cast("string")))
    lines = csv_links.read_lines(spark, _scratch(spark, bind.t(spark, d, "orders").select(text.alias("value")), "urls.txt", "text"))
    return csv_links.url_list(lines).select("url")


@query("SELECT p_partkey AS item, p_type || ':' || CAST(p_size AS VARCHAR) || '|' || '1' || '; ' || p_brand || ':' || '|' || '0' AS flat FROM part")
def flat_csv_lists(spark, d):
    e = lambda n, w, o: F.struct(n.alias("name"), w.alias("width"), F.lit(o).alias("opacity"))
    arr = F.array(e(F.col("p_type"), F.col("p_size"), 1), e(F.col("p_brand"), F.lit(None).cast("int"), 0))
    return bind.t(spark, d, "part").select(F.col("p_partkey").alias("item"), bronze.flat_list(arr).alias("flat"))


# Streaming forms, run to the end of what is there


def _streamed(spark, d, make, mode="append", ends=False) -> DataFrame:
    """`ends`: a second run closes the windows that are open after the last event."""
    base = new_folder(spark)
    events = jobs.event_stream(spark, f"{d}/events.parquet*")
    stream = make(jobs.with_end(events, f"{base}/end") if ends else events)
    if ends:
        jobs.to_table(stream, f"{base}/out", f"{base}/state").awaitTermination()
        jobs.end(events, f"{base}/end")
    if mode == "append":
        jobs.to_table(stream, f"{base}/out", f"{base}/state").awaitTermination()
    else:
        stream.writeStream.option("checkpointLocation", f"{base}/state").outputMode("update").trigger(availableNow=True).foreachBatch(lambda b, i: b.write.mode("append").parquet(f"{base}/out")).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query("SELECT DISTINCT user_id, ts FROM events")
def stream_history(spark, d):
    return _streamed(spark, d, lambda s: jobs.history(s.select("user_id", "ts"), "user_id", "ts")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT user_id AS key, ts AS stamp, value, round((value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) * 1e6) / 1e6 AS delta FROM events")
def stream_deltas(spark, d):
    """Rows that come in any order: written as the watermark passes them, the last ones at the stream's end."""
    rows = _streamed(spark, d, lambda s: jobs.deltas(s, "user_id", "ts", "value", "event_id"), ends=True)
    return rows.select("key", F.col("stamp").cast("timestamp_ntz").alias("stamp"), "value", F.round("delta", 6).alias("delta"))


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_latest(spark, d):
    base = new_folder(spark)
    jobs.upsert_latest(jobs.event_stream(spark, f"{d}/events.parquet*").select("user_id", "event_id", "ts"), f"{base}/out", f"{base}/state", "user_id", "ts", "event_id").awaitTermination()
    return upserts.current(spark, f"{base}/out").select("user_id", "event_id")


@query("""SELECT a.user_id, a.event_id, (SELECT count(*) FROM events b WHERE b.user_id = a.user_id AND epoch(b.ts)::BIGINT BETWEEN epoch(a.ts)::BIGINT - 86399 AND epoch(a.ts)::BIGINT) AS hits FROM events a
WHERE (SELECT count(*) FROM events b WHERE b.user_id = a.user_id AND epoch(b.ts)::BIGINT BETWEEN epoch(a.ts)::BIGINT - 86399 AND epoch(a.ts)::BIGINT) >= 4""")
def bursts(spark, d):
    e = bind.t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return jobs.batch_bursts(e, "user_id", "ts", 4, 86_400).select("user_id", "event_id", "hits")


@query("""SELECT a.user_id, a.event_id, count(*) AS hits FROM events a JOIN events b ON b.user_id = a.user_id AND epoch(b.ts)::BIGINT BETWEEN epoch(a.ts)::BIGINT - 86399 AND epoch(a.ts)::BIGINT
GROUP BY 1, 2 HAVING count(*) >= 4""")
def stream_bursts(spark, d):
    return _streamed(spark, d, lambda s: jobs.bursts(s, "user_id", "event_id", "ts", 4, 86_400), ends=True)


@query("""WITH g AS (SELECT user_id, ts, event_id, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 6 * 3600000000, true) AS fresh FROM events),
s AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, epoch_us(min(ts)) AS start, count(*) AS n FROM s GROUP BY user_id, session""")
def stream_sessions(spark, d):
    return _streamed(spark, d, lambda s: jobs.idle_sessions(s, "user_id", "ts"), ends=True).withColumn("start", F.unix_micros("start"))


@query("""WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE event_type IN ('error', 'purchase')),
f AS (SELECT user_id AS key, count(*) FILTER (k > coalesce(ok, 0)) AS fail_count FROM e LEFT JOIN (SELECT user_id, max(k) AS ok FROM e WHERE event_type = 'purchase' GROUP BY 1) USING (user_id) GROUP BY 1)
SELECT key, fail_count, CASE WHEN fail_count = 0 THEN NULL WHEN fail_count = 1 THEN 6 WHEN fail_count = 2 THEN 24 ELSE 72 END::BIGINT AS hours FROM f""")
def stream_failures(spark, d):
    """A key's state after its last outcome is its folded outcome."""
    own = lambda s: s.where("event_type in ('error', 'purchase') or user_id is null").withColumn("ok", F.col("event_type") == "purchase")
    rows = _streamed(spark, d, lambda s: jobs.failures(own(s), "user_id", "ts", "event_id"), ends=True)
    return silver.latest(rows, "key", "stamp", "row").select("key", "fail_count", "hours")
