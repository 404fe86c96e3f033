"""Cleaning, star schema and data-quality queries over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.exprs import surrogate_key, to_double, to_int, url_key
from larkspur.operators import quality, silver, star

from . import bind
from .bind import ATTRIBUTES, AXES, ITEMS, TAGS, with_
from .registry import query


def _events(spark, d):
    return bind.t(spark, d, "events").select("event_id", F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("stamp"), "event_type", "value", "props")


@query("SELECT page_id, lower(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '/+$', '')) AS url_key FROM pages")
def page_url_key(spark, d):
    return bind.t(spark, d, "pages").select("page_id", url_key(F.col("url")).alias("url_key"))


@query("SELECT doc_id, coalesce(CASE lower(lang) WHEN 'en' THEN 'Nam' WHEN 'fr' THEN 'Nữ' END, lang) AS label FROM documents")
def label_lookup(spark, d):
    from larkspur.functions.exprs import lookup

    return bind.t(spark, d, "documents").select("doc_id", F.coalesce(lookup(F.lower("lang"), {"en": "Nam", "fr": "Nữ"}), F.col("lang")).alias("label"))


@query("""SELECT p_partkey AS item, CASE p_size % 7 WHEN 0 THEN 'Nữ' WHEN 1 THEN 'Nam' WHEN 2 THEN 'Unisex' WHEN 3 THEN 'Unisex' WHEN 4 THEN 'Nữ' WHEN 5 THEN 'Gent' END AS label FROM part""")
def gender_labels(spark, d):
    """Spellings that the map has, in any case and spacing; unknown ones stay, blanks are null."""
    from larkspur.functions.exprs import gender_label

    spelled = F.array(*map(F.lit, (" Women", "MALE", "women  and men", "Unisex ", "nu", " Gent ", "  ")))
    return bind.t(spark, d, "part").select(F.col("p_partkey").alias("item"), gender_label(F.get(spelled, F.col("p_size") % 7)).alias("label"))


@query("SELECT user_id AS key, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, d):
    return silver.latest(_events(spark, d), "key", "stamp", "event_id").select("key", "event_id", "value")


@query("SELECT user_id AS key, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def latest_first_on_tie(spark, d):
    return silver.first_on_tie(_events(spark, d), "key", "stamp", "event_id").select("key", "event_id", "value")


@query("SELECT user_id AS key, CAST(date_trunc('day', ts) AS DATE) AS day, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id DESC) = 1")
def history_per_stamp(spark, d):
    rows = _events(spark, d).withColumn("day", F.to_date("stamp"))
    return silver.history(rows, "key", "day", "event_id").select("key", "day", "event_id")


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k, TRY_CAST(event_type AS DOUBLE) AS x FROM events")
def safe_typing(spark, d):
    k = F.get_json_object("props", "$.k")
    return _events(spark, d).select("event_id", to_int(k).alias("k"), to_double(F.col("event_type")).alias("x"))


@query("SELECT p_partkey AS item, u.name, u.rank - 1 AS rank FROM part, unnest(string_split(p_name, ' ')) WITH ORDINALITY u(name, rank) WHERE u.name <> ''")
def flat_attributes(spark, d):
    arr = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("name"), F.lit(1.0).alias("width"), F.lit(1.0).alias("opacity")))
    p = bind.t(spark, d, "part").select(F.col("p_partkey").alias("item"), arr.alias("accords"))
    return silver.flat_attributes(p).select("item", "name", F.col("rank").cast("long").alias("rank"))


@query("""SELECT p_partkey AS item, 'top' AS layer, split_part(p_name, ' ', 1) AS tag, 0 AS position FROM part
UNION ALL SELECT p_partkey, 'base', split_part(p_name, ' ', 2), 0 FROM part UNION ALL SELECT p_partkey, 'base', p_brand, 1 FROM part""")
def flat_tags(spark, d):
    w = F.split("p_name", " ")
    p = bind.t(spark, d, "part").select(F.col("p_partkey").alias("item"), F.slice(w, 1, 1).alias("top_notes"), F.lit(None).cast("array<string>").alias("middle_notes"), F.array(F.get(w, 1), F.col("p_brand")).alias("base_notes"))
    return silver.flat_tags(p, layers={"top": "top_notes", "middle": "middle_notes", "base": "base_notes"})


@query(with_(AXES) + "SELECT item, axis, 'season' AS kind, pct AS percent, axis_votes AS votes FROM axes")
def flat_axes(spark, d):
    a = bind.axes(spark, d).groupBy("item").agg(F.collect_list(F.struct(F.concat(F.lit(" "), F.initcap("axis")).alias("name"), F.col("pct").alias("percent"), F.col("axis_votes").alias("votes"))).alias("when_to_wear"))
    return silver.flat_axes(a)


@query("""SELECT s_suppkey AS key, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 'n' || s_nationkey END, n_name) AS grp FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def group_key_resolution(spark, d):
    s = bind.t(spark, d, "supplier").join(bind.t(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("key"), F.col("n_name").alias("name"), "s_nationkey")
    listings = s.select(F.when(F.col("key") % 3 == 0, F.col("key")).otherwise(-F.col("key")).alias("key"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("grp"))
    groups = bind.t(spark, d, "nation").select(F.col("n_name").alias("grp_name"), F.col("n_name").alias("grp"))
    return silver.resolve_group(s, "key", "name", listings, groups, "grp", "grp_name").select("key", "grp")


@query("SELECT source AS key, arg_min(lang, doc_id) AS lang, arg_min(n_chars, doc_id) FILTER (n_chars > 500) AS n FROM documents GROUP BY 1")
def merged_directory(spark, d):
    rows = bind.t(spark, d, "documents").select(F.col("source").alias("key"), "doc_id", "lang", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("n"))
    return silver.merged_directory(rows, "key", "doc_id", ["lang", "n"])


@query("""SELECT lower(trim(n_name)) AS name, CAST(n_nationkey AS BIGINT) AS key FROM nation UNION ALL SELECT lower(trim(s_name)), min(s_suppkey) FROM supplier GROUP BY 1""")
def name_to_key(spark, d):
    g = bind.t(spark, d, "nation").select(F.col("n_name").alias("nm"), F.col("n_nationkey").cast("long").alias("k"), F.col("n_nationkey").alias("o"))
    s = bind.t(spark, d, "supplier").select(F.col("s_name").alias("nm"), F.col("s_suppkey").alias("k"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("o"))
    return silver.name_keys(g, s, "nm", "k", "o")


@query("SELECT c_custkey AS custkey, CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE c_mktsegment END AS name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def fill_missing_name(spark, d):
    c = bind.t(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nk"), F.when(F.col("c_custkey") % 2 != 0, F.col("c_mktsegment")).alias("name"))
    return silver.fill_name(c, bind.t(spark, d, "nation").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("name")), "nk", "name").select("custkey", "name")


@query("""SELECT o_orderkey AS position, o_custkey AS key, c_mktsegment AS segment FROM orders JOIN customer ON c_custkey = o_custkey
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1""")
def enriched_pairs(spark, d):
    o = bind.t(spark, d, "orders").select(F.col("o_orderkey").alias("position"), F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("dest"))
    c = bind.t(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return silver.enriched(o, c, "key", "dest", "position").select("position", "key", "segment")


@query("SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def unmatched_keys(spark, d):
    o = bind.t(spark, d, "orders").select(F.col("o_custkey").alias("key"))
    return silver.unmatched(o, bind.t(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key")), "key")


@query("SELECT page_id FROM pages WHERE lower(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '/+$', '')) NOT IN (SELECT lower(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '/+$', '')) FROM pages WHERE page_id % 3 = 0)")
def resume_filter(spark, d):
    p = bind.t(spark, d, "pages")
    done = p.where("page_id % 3 = 0").select(F.upper("url").alias("url"))
    return silver.not_yet_done(p, done, "url").select("page_id")


@query(with_(ITEMS, ATTRIBUTES, TAGS) + "SELECT item FROM items WHERE item IN (SELECT CASE WHEN strength > 60 THEN item ELSE -1 END FROM attributes) OR item IN (SELECT CASE WHEN tag < 'Brand#15' THEN item ELSE -1 END FROM tags)")
def usable_items(spark, d):
    """Attributes and tags of other items than those of the table are passed over."""
    other = lambda known: F.when(known, F.col("item")).otherwise(-1)
    a = bind.attributes(spark, d).withColumn("item", other(F.col("strength") > 60))
    t = bind.tags(spark, d).withColumn("item", other(F.col("tag") < "Brand#15"))
    return silver.usable(bind.items(spark, d).select("item"), a, t)


# Star schema


@query("SELECT md5(CAST(o_custkey AS VARCHAR)) AS customer_sk, CASE WHEN o_orderstatus = 'F' THEN '-1' ELSE md5(o_orderstatus) END AS status_sk, o_orderkey FROM orders")
def fact_orders(spark, d):
    o = bind.t(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")))
    return star.fact(o, {"customer_sk": "o_custkey", "status_sk": "status"}, "o_orderkey")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END, 'name:' || c_mktsegment) AS natural_key FROM customer")
def fallback_natural_key(spark, d):
    c = bind.t(spark, d, "customer").withColumn("k", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("string")))
    return c.select("c_custkey", star.natural_group_key("k", "c_mktsegment").alias("natural_key"))


@query(with_(ITEMS) + "SELECT round(sum(rating * coalesce(votes, 0)) / sum(coalesce(votes, 0)) * 1000000) / 1000000 AS overall, 500.0::DOUBLE AS prior_votes FROM items WHERE rating > 0")
def stg_global_rating(spark, d):
    from larkspur.functions.exprs import rounded

    return star.global_rating(bind.items(spark, d)).withColumn("overall", rounded(F.col("overall"), 6))


@query("""WITH dir AS (SELECT p_brand AS k, min(p_brand || ' Inc') AS n FROM part WHERE p_size < 10 AND p_brand < 'Brand#35' GROUP BY 1),
rest AS (SELECT k, min(n) AS n FROM (SELECT p_brand AS k, p_brand || ' Ltd' AS n FROM part UNION ALL SELECT p_type, p_name FROM part) WHERE k NOT IN (SELECT k FROM dir) GROUP BY 1)
SELECT md5(k) AS group_sk, k AS group_key, n AS group_name, true AS in_directory FROM dir UNION ALL SELECT md5(k), k, n, false FROM rest UNION ALL SELECT '-1', NULL, NULL, false""")
def dim_group(spark, d):
    p = bind.t(spark, d, "part")
    named = lambda df, k, n: df.select(F.col(k).alias("group_key"), n.alias("group_name"))
    directory = named(p.where("p_size < 10 and p_brand < 'Brand#35'"), "p_brand", F.concat("p_brand", F.lit(" Inc")))
    return star.dim_group(directory, named(p, "p_brand", F.concat("p_brand", F.lit(" Ltd"))), named(p, "p_type", F.col("p_name")))


@query("""WITH l AS (SELECT CASE WHEN p_partkey % 5 = 0 THEN p_partkey + 1000000000 ELSE p_partkey END AS k, p_type AS c, p_name AS n FROM part),
de AS (SELECT CASE WHEN p_size % 2 = 0 THEN p_partkey ELSE -p_partkey END AS k, p_name AS name FROM part)
SELECT md5(CAST(de.k AS VARCHAR)) AS item_sk, de.k AS item_key, name, l.c AS collection, true AS is_detailed FROM de LEFT JOIN l ON l.k = de.k
UNION ALL SELECT md5(CAST(k AS VARCHAR)), k, n, c, false FROM l WHERE k NOT IN (SELECT k FROM de)""")
def dim_item(spark, d):
    """Items by other keys in the details and in the listings, so that both have some of their own."""
    k = F.col("p_partkey")
    p = bind.t(spark, d, "part").select(k, "p_size", F.col("p_name").alias("name"), F.col("p_type").alias("collection"))
    details = p.select(F.when(F.col("p_size") % 2 == 0, k).otherwise(-k).alias("item_key"), "name")
    return star.dim_item(details, p.select(F.when(k % 5 == 0, k + 1_000_000_000).otherwise(k).alias("item_key"), "name", "collection"))


@query(with_(ATTRIBUTES) + "SELECT md5(attribute) AS sk, attribute FROM (SELECT DISTINCT attribute FROM attributes)")
def dim_attribute(spark, d):
    return star.dim_value(bind.attributes(spark, d), "attribute", "attribute")


@query(with_(TAGS) + "SELECT md5(tag) AS sk, tag FROM (SELECT DISTINCT tag FROM tags)")
def dim_tag(spark, d):
    return star.dim_value(bind.tags(spark, d), "tag", "tag")


@query(with_(AXES) + "SELECT md5(axis) AS sk, axis, 'season' AS kind, CAST(list_position(['winter', 'spring', 'summer', 'fall'], axis) AS INT) AS sort_order FROM (SELECT DISTINCT axis FROM axes)")
def dim_occasion(spark, d):
    return star.dim_occasion(bind.axes(spark, d))


@query("""SELECT CAST(strftime(x, '%Y%m%d') AS INT) AS date_sk, CAST(x AS DATE) AS date, CAST(year(x) AS INT) AS year, CAST(quarter(x) AS INT) AS quarter, CAST(month(x) AS INT) AS month, monthname(x) AS month_name,
CAST(weekofyear(x) AS INT) AS iso_week, CAST(isodow(x) AS INT) AS iso_weekday, isodow(x) >= 6 AS is_weekend
FROM generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY) s(x)""")
def dim_date(spark, d):
    return star.dim_date(bind.t(spark, d, "orders"), "o_orderdate")


@query(with_(ITEMS) + "SELECT md5(CAST(item AS VARCHAR)) AS item_sk, coalesce(md5(grp), '-1') AS group_sk, rating, votes FROM items")
def fct_item_rating(spark, d):
    return star.fact(bind.items(spark, d), {"item_sk": "item", "group_sk": "grp"}, "rating", "votes")


@query("""SELECT md5(CAST(user_id AS VARCHAR)) AS key_sk, event_id, value, round((value - lag(value) OVER w) * 100) / 100 AS value_delta,
row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AS is_latest FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def fct_snapshot(spark, d):
    e = _events(spark, d).withColumn("at", F.struct("stamp", "event_id"))
    return star.snapshots(e, "key", "at", {"value": 2}).select(surrogate_key(F.col("key")).alias("key_sk"), "event_id", "value", "value_delta", "is_latest")


@query(with_(ATTRIBUTES) + "SELECT md5(CAST(item AS VARCHAR)) AS item_sk, md5(attribute) AS attribute_sk, strength FROM attributes")
def fct_item_attribute(spark, d):
    return star.fact(bind.attributes(spark, d), {"item_sk": "item", "attribute_sk": "attribute"}, "strength")


@query(with_(TAGS) + "SELECT md5(CAST(item AS VARCHAR)) AS item_sk, md5(tag) AS tag_sk, layer FROM tags")
def fct_item_tag(spark, d):
    return star.fact(bind.tags(spark, d), {"item_sk": "item", "tag_sk": "tag"}, "layer")


@query(with_(AXES) + "SELECT md5(CAST(item AS VARCHAR)) AS item_sk, md5(axis) AS occasion_sk, pct, axis_votes FROM axes")
def fct_item_occasion(spark, d):
    return star.fact(bind.axes(spark, d), {"item_sk": "item", "occasion_sk": "axis"}, "pct", "axis_votes")


@query("SELECT md5(CAST(p_partkey AS VARCHAR)) AS item_sk, md5(p_brand) AS group_sk FROM part")
def fct_listing(spark, d):
    return star.fact(bind.t(spark, d, "part"), {"item_sk": "p_partkey", "group_sk": "p_brand"})


# Data quality: findings


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, d):
    return quality.unique(bind.t(spark, d, "part"), "p_name")


@query(with_(ITEMS) + "SELECT 'gender' AS \"column\", count(*) FILTER (gender IS NULL) AS n_null FROM items UNION ALL SELECT 'owners', count(*) FROM items")
def dq_not_null(spark, d):
    return quality.not_null(bind.items(spark, d), "item", "gender", "owners")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1")
def dq_accepted_values(spark, d):
    return quality.accepted_values(bind.t(spark, d, "events"), "event_type", ["view", "click"])


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY 1")
def dq_relationships(spark, d):
    return quality.relationships(bind.t(spark, d, "lineitem").select("l_orderkey"), "l_orderkey", bind.t(spark, d, "orders").where("o_orderstatus = 'O'"), "o_orderkey")


@query("SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(spark, d):
    return quality.unique_combination(bind.t(spark, d, "lineitem"), "l_suppkey", "l_returnflag")


@query(with_(ITEMS) + "SELECT item FROM items WHERE (votes IS NULL) <> (gender IS NULL)")
def dq_null_together(spark, d):
    return quality.null_together(bind.items(spark, d), "votes", "gender").select("item")


@query("SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR c_acctbal > 5000")
def dq_range(spark, d):
    return quality.in_range(bind.t(spark, d, "customer"), "c_acctbal", 0, 5000).select("c_custkey")


@query("SELECT round(sum(p_size) * 10) / 10 AS total FROM part WHERE abs((SELECT sum(p_size) FROM part) - 100) > 0.5")
def dq_shares(spark, d):
    return quality.sums_to(bind.t(spark, d, "part").select(F.col("p_size").cast("double").alias("p_size")), "p_size")


@query("""SELECT o_custkey AS key, 'n' AS "column", CAST(count(*) AS DOUBLE) AS "left", CAST(nullif(count(*) FILTER (o_orderstatus <> 'P'), 0) AS DOUBLE) AS "right" FROM orders GROUP BY 1 HAVING count(*) <> count(*) FILTER (o_orderstatus <> 'P')""")
def dq_reconcile(spark, d):
    o = bind.t(spark, d, "orders").withColumnRenamed("o_custkey", "key")
    n = lambda df: df.groupBy("key").agg(F.count("*").alias("n"))
    return quality.reconcile(n(o), n(o.where("o_orderstatus <> 'P'")), ["key"], ["n"])


@query("SELECT c_custkey AS key, 'left' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def dq_key_difference(spark, d):
    c = bind.t(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return quality.key_difference(c, bind.t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key")).distinct(), "key")
