"""The tables of a data directory as the operators' inputs, in Spark and as SQL.

part is the catalogue of items, lineitem their votes and occasions, words of p_name their tags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.exprs import season

LEVELS = ["very weak", "weak", "moderate", "long lasting", "eternal"]


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def items(spark: SparkSession, d: str) -> DataFrame:
    votes = t(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("votes"), (F.round(F.avg("l_quantity") * 10, 0) / 100).alias("rating"), F.max(F.year("l_shipdate")).alias("year")
    )
    level = F.element_at(F.array(*map(F.lit, LEVELS)), (F.floor((F.col("p_size") - 1) / 10) + 1).cast("int"))
    gender = F.when(F.col("p_size") % 3 == 0, "Nam").when(F.col("p_size") % 3 == 1, "Nữ")
    rows = t(spark, d, "part").join(votes, F.col("p_partkey") == F.col("l_partkey"), "left")
    return rows.select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("name"), F.col("p_brand").alias("grp"), "votes", "rating", "year", gender.alias("gender"), level.alias("level"), F.lit(None).cast("long").alias("owners")
    )


ITEMS = """items AS (
    SELECT p_partkey AS item, p_name AS name, p_brand AS grp, votes, rating, year,
           CASE p_size % 3 WHEN 0 THEN 'Nam' WHEN 1 THEN 'Nữ' END AS gender,
           ['very weak', 'weak', 'moderate', 'long lasting', 'eternal'][CAST(floor((p_size - 1) / 10.0) AS INT) + 1] AS level,
           CAST(NULL AS BIGINT) AS owners
    FROM part LEFT JOIN (
        SELECT l_partkey, count(*) AS votes, round(avg(l_quantity) * 10) / 100 AS rating, CAST(max(year(l_shipdate)) AS INT) AS year
        FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey)"""


def attributes(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part").withColumn("w", F.split("p_name", " "))
    own = F.array(F.struct(F.col("p_type").alias("attribute"), (F.col("p_size") * 2.0).alias("strength")), F.struct(F.get("w", 1).alias("attribute"), (F.col("p_size") % 25 * 4.0).alias("strength")))
    return p.select(F.col("p_partkey").alias("item"), F.inline(own))


ATTRIBUTES = """attributes AS (
    SELECT p_partkey AS item, p_type AS attribute, p_size * 2.0::DOUBLE AS strength FROM part
    UNION ALL SELECT p_partkey, split_part(p_name, ' ', 2), (p_size % 25) * 4.0::DOUBLE FROM part)"""


def tags(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part").withColumn("w", F.split("p_name", " "))
    own = [F.struct(F.lit(layer).alias("layer"), tag.alias("tag")) for layer, tag in (("top", F.get("w", 0)), ("base", F.get("w", 1)), ("middle", F.col("p_brand")))]
    return p.select(F.col("p_partkey").alias("item"), F.inline(F.array(*own)))


TAGS = """tags AS (
    SELECT p_partkey AS item, 'top' AS layer, split_part(p_name, ' ', 1) AS tag FROM part
    UNION ALL SELECT p_partkey, 'base', split_part(p_name, ' ', 2) FROM part
    UNION ALL SELECT p_partkey, 'middle', p_brand FROM part)"""


def axes(spark: SparkSession, d: str) -> DataFrame:
    own = t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("item"), season(F.col("l_shipdate")).alias("axis")).agg(F.count("*").alias("n"))
    total = own.groupBy("item").agg(F.sum("n").alias("total"))
    return own.join(total, "item").select("item", "axis", (100.0 * F.col("n") / F.col("total")).alias("pct"), F.col("n").alias("axis_votes"))


AXES = """axes AS (
    SELECT item, axis, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY item) AS pct, n AS axis_votes FROM (
        SELECT l_partkey AS item, CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'winter' WHEN month(l_shipdate) IN (3, 4, 5) THEN 'spring'
               WHEN month(l_shipdate) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS axis, count(*) AS n
        FROM lineitem GROUP BY 1, 2))"""


def detailed(spark: SparkSession, d: str) -> DataFrame:
    """Items that a few large orders mention: the part of the catalogue that is known in detail."""
    some = t(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("item")).distinct()
    return items(spark, d).join(some, "item", "left_semi")


DETAILED = """detailed AS (SELECT * FROM items WHERE item IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
