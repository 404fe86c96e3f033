"""Marts, metrics and report data over the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.exprs import rounded, sequential_bin
from larkspur.operators import marts, quality
from larkspur.operators.places import with_place

from . import bind
from .bind import ATTRIBUTES, AXES, DETAILED, ITEMS, TAGS, with_
from .registry import query

COMMON = "common AS (SELECT sum(rating * coalesce(votes, 0)) FILTER (rating > 0) / nullif(sum(coalesce(votes, 0)) FILTER (rating > 0), 0) AS common FROM items)"
COMMON3 = "common AS (SELECT round(sum(rating * coalesce(votes, 0)) FILTER (rating > 0) / nullif(sum(coalesce(votes, 0)) FILTER (rating > 0), 0) * 1000) / 1000 AS common FROM items)"
_SCORE = "round(CASE WHEN coalesce(rv, 0) = 0 THEN common ELSE rv / (rv + 500.0::DOUBLE) * (w / rv) + (1 - rv / (rv + 500.0::DOUBLE)) * common END * 1000) / 1000"
_SUMS = "count(*) AS n_items, sum(coalesce(votes, 0)) AS n_votes, avg(rating) AS mean, sum(rating * coalesce(votes, 0)) FILTER (rating > 0) AS w, sum(coalesce(votes, 0)) FILTER (rating > 0) AS rv, count(*) FILTER (rating > 0) AS nr"
_STRICT = f"CASE WHEN nr > 0 THEN {_SCORE} END"


@query(with_(ITEMS, COMMON, f"g AS (SELECT grp, {_SUMS} FROM items GROUP BY grp)") + f"""
SELECT grp, n_items, CAST(n_votes AS BIGINT) AS n_votes, round(100.0::DOUBLE * n_votes / sum(n_votes) OVER () * 100) / 100 AS share_pct,
       round(mean * 1000) / 1000 AS rating_avg, {_SCORE} AS rating_weighted FROM g, common""")
def mart_group(spark, d):
    return marts.by_group(bind.items(spark, d))


@query(with_(ITEMS, COMMON3, f"g AS (SELECT grp, {_SUMS} FROM items GROUP BY grp)") + f"""
SELECT grp, n_items, CAST(n_votes AS BIGINT) AS n_votes, round(100.0::DOUBLE * n_votes / (SELECT sum(votes) FROM items) * 100) / 100 AS share_pct,
       round(mean * 1000) / 1000 AS rating_avg, {_STRICT} AS rating_weighted FROM g, common""")
def metric_group(spark, d):
    return marts.by_group(bind.items(spark, d), share_of_all=True)


_ATTR = "a AS (SELECT attribute, item, avg(strength) AS strength FROM attributes GROUP BY 1, 2), g AS (SELECT attribute, {} , avg(strength) AS s FROM a JOIN items USING (item) GROUP BY 1)".format(_SUMS)
_ATTR_OUT = "SELECT attribute, n_items, round(100.0::DOUBLE * n_items / (SELECT count(*) FROM items) * 100) / 100 AS coverage_pct, round(s * 1000) / 1000 AS avg_strength, {} AS rating_weighted, CAST(n_votes AS BIGINT) AS n_votes FROM g, common"


@query(with_(ITEMS, ATTRIBUTES, COMMON, _ATTR) + _ATTR_OUT.format(_SCORE))
def mart_attribute(spark, d):
    return marts.by_attribute(bind.items(spark, d), bind.attributes(spark, d))


@query(with_(ITEMS, ATTRIBUTES, COMMON3, _ATTR) + _ATTR_OUT.format(_STRICT))
def metric_attribute(spark, d):
    return marts.by_attribute(bind.items(spark, d), bind.attributes(spark, d), missing_as_zero=True)


@query(with_(ITEMS, COMMON3, f"g AS (SELECT gender, {_SUMS} FROM items WHERE gender IS NOT NULL GROUP BY 1)") + """
SELECT gender, n_items, row_number() OVER (ORDER BY coalesce(n_items, 0) DESC, gender) AS place FROM g""")
def metric_places(spark, d):
    """The order of a metric as data: descending by its main measure, equal ones by name."""
    return marts.placed(marts.by_label(bind.items(spark, d), "gender"), "n_items").select("gender", "n_items", "place")


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS place FROM lineitem")
def row_places(spark, d):
    """Places of all rows of a large table, whose leading order has many equal rows."""
    rows = bind.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return with_place(rows, [F.desc("l_quantity"), "l_orderkey", "l_linenumber"]).drop("l_quantity")


@query(with_(ITEMS, COMMON3, f"g AS (SELECT gender, {_SUMS} FROM items WHERE gender IS NOT NULL GROUP BY 1)") + f"""
SELECT gender, n_items, round(100.0::DOUBLE * n_items / (SELECT count(*) FROM items) * 100) / 100 AS share_pct, {_STRICT} AS rating_weighted, CAST(n_votes AS BIGINT) AS n_votes FROM g, common""")
def metric_gender(spark, d):
    return marts.by_label(bind.items(spark, d), "gender")


_TOP = "top AS (SELECT item, arg_max(axis, (pct, -list_position(['winter', 'spring', 'summer', 'fall'], axis))) AS top_axis FROM axes GROUP BY item)"


@query(with_(AXES, _TOP) + "SELECT item, top_axis FROM top")
def top_season(spark, d):
    return marts.top_axis(bind.axes(spark, d))


@query(with_(ITEMS, AXES, _TOP, "voted AS (SELECT * FROM items JOIN top USING (item))", COMMON3.replace("FROM items", "FROM voted"), f"g AS (SELECT top_axis, {_SUMS} FROM voted GROUP BY 1)") + f"""
SELECT top_axis, n_items, round(100.0::DOUBLE * n_items / (SELECT count(*) FROM voted) * 100) / 100 AS share_pct, {_STRICT} AS rating_weighted FROM g, common""")
def metric_season(spark, d):
    return marts.by_season(bind.items(spark, d), bind.axes(spark, d))


CELLS = """c AS (SELECT attribute, axis, avg(pct) AS mean, count(DISTINCT item) AS n_items FROM (SELECT DISTINCT item, attribute FROM attributes) JOIN axes USING (item) GROUP BY 1, 2),
z AS (SELECT axis, avg(mean) AS am, stddev_pop(mean) AS sd FROM c GROUP BY 1),
grid AS (SELECT attribute, axis, n_items, round(mean * 10) / 10 AS pct_vote, round((mean - am) * 10) / 10 AS delta_vs_axis, round((mean - am) / greatest(sd, 3.0) * 100) / 100 AS z_score FROM c JOIN z USING (axis))"""


@query(with_(ATTRIBUTES, AXES, CELLS) + "SELECT * FROM grid")
def mart_attribute_axis(spark, d):
    return marts.attribute_axis(bind.attributes(spark, d), bind.axes(spark, d))


_COVER = """SELECT coalesce(a.grp, b.grp) AS grp, a.n AS catalogue_items, coalesce(b.n, 0) AS detailed,
       CASE WHEN a.n IS NOT NULL THEN round(100.0::DOUBLE * coalesce(b.n, 0) / a.n * 10) / 10 END AS coverage_pct, CAST(coalesce(b.v, 0) AS BIGINT) AS n_votes
FROM (SELECT CASE p_brand WHEN 'Brand#11' THEN 'listed' ELSE p_brand END AS grp, count(*) AS n FROM part GROUP BY 1) a
FULL JOIN (SELECT CASE grp WHEN 'Brand#22' THEN 'detailed' ELSE grp END AS grp, count(*) AS n, sum(coalesce(votes, 0)) AS v FROM detailed GROUP BY 1) b ON a.grp = b.grp"""


@query(with_(ITEMS, DETAILED) + _COVER)
def mart_coverage(spark, d):
    """One group is named otherwise in the catalogue and one in the details, so each stands on one side alone."""
    named = lambda c, old, new: F.when(F.col(c) == old, new).otherwise(F.col(c)).alias("grp")
    catalogue = bind.t(spark, d, "part").select(named("p_brand", "Brand#11", "listed"))
    return marts.coverage(catalogue, bind.detailed(spark, d).withColumn("grp", named("grp", "Brand#22", "detailed")))


@query("""WITH n AS (SELECT DISTINCT l_orderkey AS item, p_brand AS tag FROM lineitem JOIN part ON p_partkey = l_partkey),
f AS (SELECT tag, count(*) AS n FROM n GROUP BY 1 HAVING count(*) >= 2)
SELECT a.tag AS tag_a, b.tag AS tag_b, any_value(f.n) AS items_with_a, count(*) AS together, round(100.0::DOUBLE * count(*) / any_value(f.n) * 10) / 10 AS pct_b_given_a
FROM n a JOIN n b ON a.item = b.item AND a.tag <> b.tag JOIN f ON f.tag = a.tag JOIN f g ON g.tag = b.tag GROUP BY 1, 2""")
def mart_tag_pairs(spark, d):
    rows = bind.t(spark, d, "lineitem").join(bind.t(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return marts.tag_pairs(rows.select(F.col("l_orderkey").alias("item"), F.col("p_brand").alias("tag")))


@query(with_(TAGS, """once AS (SELECT DISTINCT item, tag FROM tags), top AS (SELECT tag, count(*) AS n FROM once GROUP BY 1 ORDER BY n DESC, tag LIMIT 16),
k AS (SELECT item, tag FROM once JOIN top USING (tag))""") + """
SELECT a.tag AS tag_a, b.tag AS tag_b, round(100.0::DOUBLE * count(*) / any_value(top.n) * 10) / 10 AS pct_b_given_a
FROM k a JOIN k b ON a.item = b.item AND a.tag <> b.tag JOIN top ON top.tag = a.tag GROUP BY 1, 2
UNION ALL SELECT tag, tag, NULL FROM top""")
def tag_matrix(spark, d):
    return marts.tag_matrix(bind.tags(spark, d))


@query(with_(ATTRIBUTES.replace("attributes AS", "every AS"), "top AS (SELECT attribute FROM (SELECT DISTINCT item, attribute FROM every) GROUP BY 1 ORDER BY count(*) DESC, attribute LIMIT 14), attributes AS (SELECT * FROM every JOIN top USING (attribute))", AXES, CELLS) + """
SELECT attribute, """ + ", ".join(f"max(pct_vote) FILTER (axis = '{a}') AS {a}_pct, max(CASE WHEN z_score <= -1 THEN -2 WHEN z_score <= -0.33 THEN -1 WHEN z_score < 0.33 THEN 0 WHEN z_score < 1 THEN 1 ELSE 2 END) FILTER (axis = '{a}') AS {a}_bin" for a in marts.SEASONS) + " FROM grid GROUP BY 1")
def attribute_grid(spark, d):
    return marts.attribute_grid(bind.attributes(spark, d), bind.axes(spark, d))


@query(with_(ITEMS, COMMON, f"g AS (SELECT grp, {_SUMS} FROM items GROUP BY grp)") + f"SELECT grp, CAST(n_votes AS BIGINT) AS n_votes, {_SCORE} AS rating_weighted, n_items FROM g, common WHERE n_votes > 0 ORDER BY n_votes DESC, grp LIMIT 40")
def group_positioning(spark, d):
    return marts.positioning(bind.items(spark, d))


@query(with_(ITEMS, ATTRIBUTES, "top AS (SELECT attribute FROM (SELECT DISTINCT item, attribute FROM attributes) GROUP BY 1 ORDER BY count(*) DESC, attribute LIMIT 10), r AS (SELECT attribute, level FROM (SELECT DISTINCT item, attribute FROM attributes) JOIN top USING (attribute) JOIN items USING (item) WHERE level IS NOT NULL)")
       + "SELECT attribute, " + ", ".join(f"round(100.0::DOUBLE * count(*) FILTER (level = '{x}') / count(*) * 10) / 10 AS \"{x}\"" for x in bind.LEVELS) + ", count(*) AS n_known FROM r GROUP BY 1")
def level_distribution(spark, d):
    return marts.ordinal_share(bind.attributes(spark, d), bind.items(spark, d).select("item", "level"), bind.LEVELS)


@query(with_(ITEMS) + "SELECT year, count(*) FILTER (gender = 'Nam') AS \"Nam\", count(*) FILTER (gender = 'Nữ') AS \"Nữ\", count(*) FILTER (gender IS NULL) AS \"Unisex\" FROM items WHERE year >= 1995 GROUP BY 1")
def items_per_year(spark, d):
    return marts.per_year(bind.items(spark, d), "gender", ["Nam", "Nữ", "Unisex"], 1995, "Unisex")


@query(with_(ITEMS) + "SELECT count(*) FILTER (year IS NULL) AS no_year, count(*) FILTER (year < 1998) AS before FROM items")
def excluded_years(spark, d):
    return marts.excluded_years(bind.items(spark, d), 1998)


@query(with_(ITEMS, AXES) + "SELECT count(*) AS n_items, count(DISTINCT grp) AS n_groups, count(*) FILTER (rating > 0) AS n_rated, CAST(sum(coalesce(votes, 0)) AS BIGINT) AS n_votes, count(*) FILTER (item IN (SELECT item FROM axes)) AS with_axis, count(level) AS with_level, count(owners) AS with_owners FROM items")
def overview(spark, d):
    return marts.overview(bind.items(spark, d), bind.axes(spark, d))


@query(with_(ITEMS, DETAILED, ATTRIBUTES, TAGS) + """SELECT (SELECT count(*) FROM detailed) AS n_items, (SELECT count(DISTINCT grp) FROM detailed) AS n_groups, CAST((SELECT sum(coalesce(votes, 0)) FROM detailed) AS BIGINT) AS n_votes,
(SELECT count(DISTINCT attribute) FROM attributes) AS n_attributes, (SELECT count(DISTINCT tag) FROM tags) AS n_tags, round(100.0::DOUBLE * (SELECT count(*) FROM detailed) / (SELECT count(*) FROM part) * 10) / 10 AS coverage_pct""")
def headline_tiles(spark, d):
    return marts.headline(bind.detailed(spark, d), bind.attributes(spark, d), bind.tags(spark, d), bind.t(spark, d, "part"))


@query("""SELECT p_partkey AS item, CAST(least(greatest(round_even((p_retailprice - lo)::DOUBLE / (hi - lo)::DOUBLE * 4, 0), 0), 4) AS INT) AS step
FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)""")
def price_steps(spark, d):
    p = bind.t(spark, d, "part")
    ends = p.agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    return p.crossJoin(F.broadcast(ends)).select(F.col("p_partkey").alias("item"), sequential_bin(F.col("p_retailprice"), F.col("lo"), F.col("hi"), 5).alias("step"))


@query(with_(ITEMS, COMMON3.replace("common AS", "common3 AS").replace("AS common FROM", "AS common FROM")) + "SELECT common FROM common3")
def common_mean(spark, d):
    return marts.common_mean(bind.items(spark, d), 3)


@query(with_(ITEMS, "g AS (SELECT grp, count(*) AS n FROM items WHERE grp IS NOT NULL GROUP BY 1)") + """SELECT grp, 'n_items' AS finding, n::DOUBLE AS "left", n + 1.0::DOUBLE AS "right" FROM g WHERE grp LIKE '%1'
UNION ALL SELECT grp, 'n_items', n::DOUBLE, NULL FROM g WHERE grp LIKE '%2' UNION ALL SELECT grp, 'n_votes', v::DOUBLE, NULL FROM g JOIN (SELECT grp, sum(coalesce(votes, 0)) AS v FROM items GROUP BY 1) USING (grp) WHERE grp LIKE '%2'""")
def reconcile_two_paths(spark, d):
    """Window and join formulations of the group mart, the second one with an error and a gap to be found."""
    i = bind.items(spark, d)
    a = marts.by_group(i).select("grp", "n_items", "n_votes")
    b = marts.by_group(i, share_of_all=True).where("grp not like '%2'").select("grp", F.when(F.col("grp").endswith("1"), F.col("n_items") + 1).otherwise(F.col("n_items")).alias("n_items"), "n_votes")
    return quality.reconcile(a, b, ["grp"], ["n_items", "n_votes"]).withColumnRenamed("column", "finding")


@query(with_(ITEMS, DETAILED, """k AS (SELECT DISTINCT p_brand AS name, CASE WHEN p_brand LIKE '%4' THEN NULL ELSE 'g/' || p_brand END AS key FROM part),
l AS (SELECT 'g/' || p_brand AS key, CASE WHEN p_brand LIKE '%3' THEN p_brand || ' old' ELSE p_brand END AS grp FROM part), sz AS (SELECT key, count(*) AS total FROM l GROUP BY 1),
dn AS (SELECT CASE WHEN grp > 'Brand#2' THEN grp ELSE grp || ' new' END AS grp, count(*) AS n, CAST(sum(coalesce(votes, 0)) AS BIGINT) AS v FROM detailed GROUP BY 1)""") + """
SELECT grp, total AS catalogue_items, coalesce(n, 0) AS detailed, round(100.0::DOUBLE * coalesce(n, 0) / total * 10) / 10 AS coverage_pct, coalesce(v, 0) AS n_votes
FROM (SELECT grp FROM dn UNION SELECT grp FROM l) LEFT JOIN k ON name = grp LEFT JOIN sz USING (key) LEFT JOIN dn USING (grp)""")
def mart_coverage_by_key(spark, d):
    p = bind.t(spark, d, "part").select("p_brand", F.concat(F.lit("g/"), "p_brand").alias("key"))
    groups = p.select(F.col("p_brand").alias("name"), F.when(~F.col("p_brand").endswith("4"), F.col("key")).alias("key")).distinct()
    listings = p.select("key", F.when(F.col("p_brand").endswith("3"), F.concat("p_brand", F.lit(" old"))).otherwise(F.col("p_brand")).alias("grp"))
    grp = F.when(F.col("grp") > "Brand#2", F.col("grp")).otherwise(F.concat("grp", F.lit(" new")))
    return marts.coverage_by_key(groups, listings, bind.detailed(spark, d).withColumn("grp", grp))


def _tables(spark, d):
    return {"items": bind.items(spark, d), "attributes": bind.attributes(spark, d), "axes": bind.axes(spark, d)}


@query(with_(ITEMS, ATTRIBUTES, AXES) + """SELECT to_json({'overview': {'n_items': count(*), 'n_groups': count(DISTINCT grp), 'n_rated': count(*) FILTER (rating > 0), 'n_votes': CAST(sum(coalesce(votes, 0)) AS BIGINT),
'with_axis': count(*) FILTER (item IN (SELECT item FROM axes)), 'with_level': count(level), 'with_owners': count(owners)}, 'rows': {'attribute': (SELECT count(DISTINCT attribute) FROM attributes),
'gender': count(DISTINCT gender), 'group': count(DISTINCT grp), 'season': (SELECT count(DISTINCT axis) FROM axes)}})::VARCHAR AS value FROM items""")
def metric_registry(spark, d):
    """Rows per metric of the registry, as one JSON text beside the overview."""
    return marts.summary(_tables(spark, d))


@query(with_(ITEMS) + "SELECT item, round(rating * 20 * 10) / 10 AS percent FROM items WHERE rating IS NOT NULL")
def rating_percent(spark, d):
    return bind.items(spark, d).where("rating is not null").select("item", rounded(F.col("rating") * 20, 1).alias("percent"))
