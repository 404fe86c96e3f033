"""Sinks and stores: what Spark writes from the tables and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import dense, marts, quality, silver
from larkspur.operators.retrieval import Retriever
from larkspur.sources import bronze
from larkspur.sources.scratch import new_folder
from larkspur.streaming import jobs

from . import bind
from .bind import ITEMS, with_
from .page_queries import _raw
from .registry import query


@query("""SELECT p_partkey AS item, CAST(p_size AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS note FROM part""")
def stored_tables(spark, d):
    """Tables cast to their declared columns, written, registered as views and staged."""
    base = new_folder(spark)
    rows = bind.t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item"), F.col("p_size").alias("size"), F.lit(None).alias("note"), F.lit(1).alias("other"))
    bronze.write_tables({"silver_items": rows}, {"silver_items": "item bigint, size bigint, note string"}, base)
    found = bronze.register(spark, base, ["silver_items", "not_there"])
    bronze.staged(spark, found)
    return spark.table("stg_silver_items")


@query(with_(ITEMS) + "SELECT grp, count(*) AS n_items FROM items WHERE grp IS NOT NULL GROUP BY 1")
def gold_tables(spark, d):
    base = new_folder(spark)
    bronze.write_gold({"group": marts.by_group(bind.items(spark, d))}, base)
    return spark.read.parquet(f"{base}/group").select("grp", "n_items")


@query("SELECT o_orderstatus AS status, CAST(NULL AS VARCHAR) AS note, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 1")
def csv_report(spark, d):
    """A report in a fixed column order, with a byte-order mark, read back by name."""
    path = f"{new_folder(spark)}/report"
    rows = bind.t(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.max("o_orderkey").alias("left_out"))
    bronze.write_csv(rows, path, ["status", "note", "n"])
    back = spark.read.option("header", True).csv(path)
    return back.toDF(*(c.lstrip("\ufeff") for c in back.columns)).select("status", "note", "n")


@query("SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def appended_outcomes(spark, d):
    """JSON lines appended twice."""
    path = f"{new_folder(spark)}/outcomes"
    rows = bind.t(spark, d, "events").select("event_id", "event_type")
    for _ in range(2):
        bronze.append_jsonl(rows, path)
    return spark.read.schema("event_id long, event_type string").json(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS n, round(list_sum(embedding::DOUBLE[]) * 1e4) / 1e4 AS total FROM embeddings")
def stored_embeddings(spark, d):
    """An embedding table that is read back only if it is of one expected model."""
    path = f"{new_folder(spark)}/embeddings"
    bronze.write_embeddings(bind.t(spark, d, "embeddings").withColumn("model_id", F.lit("m-1")), path)
    rows = bronze.read_embeddings(spark, path, "m-1")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select("vec_id", "label", F.size("embedding").cast("long").alias("n"), (F.round(total * 1e4, 0) / 1e4).alias("total"))


@query("SELECT vec_id AS item, CAST(len(embedding) AS BIGINT) AS n, 'label' AS block, CAST(label AS VARCHAR) AS label FROM embeddings")
def serving_tables(spark, d):
    """Vectors and terms of a serving store, each item and term once."""
    base = new_folder(spark)
    vectors = bind.t(spark, d, "embeddings").select(F.col("vec_id").alias("item"), "embedding", F.col("label").cast("string").alias("label"))
    terms = vectors.select("item", F.lit("label").alias("block"), "label", F.lit(1.0).alias("weight"))
    size = vectors.select(F.size("embedding")).first()[0]
    bronze.load_serving(vectors, vectors.drop("label").union(vectors.drop("label")), terms.union(terms), base, size)
    back = spark.read.parquet(f"{base}/vectors").select("item", F.size("embedding").cast("long").alias("n"))
    return back.join(spark.read.parquet(f"{base}/terms").drop("weight"), "item")


@query("""SELECT kind, count(*) AS n, 1 AS kinds FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'item' WHEN 1 THEN 'group' ELSE 'listing' END AS kind FROM part WHERE p_partkey % 4 <> 3) GROUP BY 1""")
def bronze_split(spark, d):
    """Mixed records split by kind: no file of the result is mixed, all of the source are."""
    base = new_folder(spark)
    _raw(spark, d).repartition(2).select("value").write.text(f"{base}/raw")
    rows = bronze.read_jsonl(spark, f"{base}/raw", files="part-*")
    mixed = bronze.mixed_files(rows).select("file")
    bronze.split_by_kind(rows.join(mixed, "file", "left_semi"), f"{base}/split")
    back = bronze.read_jsonl(spark, f"{base}/split", files="part-*")
    kinds = back.groupBy("file").agg(F.count_distinct("kind").alias("k")).agg(F.max("k").cast("int").alias("kinds"))
    return back.groupBy("kind").agg(F.count("*").alias("n")).crossJoin(kinds)  # one row


@query("SELECT 'https://shop.example.com/i/' || p_partkey AS url, 2 AS n FROM part WHERE p_partkey % 4 = 0")
def bronze_items_by_folder(spark, d):
    """Items from their own folder and from flat files, not from the folder of another kind."""
    base, raw = new_folder(spark), _raw(spark, d).select("value")
    for folder in ("items", "brands", "other"):
        raw.write.text(f"{base}/{folder}")
    rows = bronze.of_kind(bronze.read_jsonl(spark, base, files="part-*"), "item", "items")
    return rows.groupBy("url").agg(F.count("*").cast("int").alias("n"))


@query("""WITH x AS (SELECT p_partkey AS item, p_type AS name, p_size + 1.0 AS v FROM part UNION ALL SELECT p_partkey, 'b', 0.0 FROM part)
SELECT item, name, CAST(v AS DOUBLE) AS strength, p_brand || '|' || p_type AS tags FROM x JOIN part ON p_partkey = item""")
def analysis_maps(spark, d):
    """Attributes by name, the last of a repeated one, zero for a missing number; tags in layer order."""
    p = bind.t(spark, d, "part")
    entry = lambda name, w: F.struct(name.alias("name"), w.cast("double").alias("width"))
    accords = F.array(entry(F.col("p_type"), F.col("p_size")), entry(F.lit("b"), F.lit(None)), entry(F.col("p_type"), F.col("p_size") + 1), entry(F.lit(None).cast("string"), F.lit(1)))
    wear = F.lit(None).cast("array<struct<name:string,percent:double>>")
    none = F.lit(None).cast("array<string>")
    rows = p.select(F.col("p_partkey").alias("item"), accords.alias("accords"), wear.alias("when_to_wear"), F.array("p_brand", F.lit("")).alias("top_notes"), none.alias("middle_notes"), F.array("p_type").alias("base_notes"), none.alias("general_notes"))
    out = silver.analysis_rows(rows)
    return out.select("item", F.explode("attributes").alias("name", "strength"), F.array_join("tags", "|").alias("tags"))


@query("SELECT 'https://shop.example.com/i/' || p_partkey AS url, p_name AS name FROM part WHERE p_partkey % 4 = 0")
def stream_records(spark, d):
    """JSON lines of a folder as a stream, written to a table."""
    base = new_folder(spark)
    _raw(spark, d).where("p_partkey % 4 = 0").select("value").write.text(f"{base}/in/sub")
    jobs.to_table(jobs.record_stream(spark, f"{base}/in", "url string, name string"), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema("url string, name string").parquet(f"{base}/out")


@query("""SELECT query, item, score, rank FROM (SELECT q.vec_id AS query, i.vec_id AS item, round(list_cosine_similarity(q.embedding::DOUBLE[], i.embedding::DOUBLE[]), 6) AS score,
row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], i.embedding::DOUBLE[]), 6) DESC, i.vec_id) AS rank
FROM embeddings q, embeddings i WHERE q.vec_id % 50 = 0 AND i.vec_id % 4 <> 1) WHERE rank <= 5 AND score > 0""")
def retriever_nearest(spark, d):
    """The dense side of the common interface, with filters on the items."""
    e = bind.t(spark, d, "embeddings").select(F.col("vec_id").alias("item"), F.col("label").alias("grp"), "embedding", F.lit("m-1").alias("model_id"))
    items = e.select("item", "grp", (F.col("item") % 4).alias("votes"), F.when(F.col("item") % 4 == 1, "Nam").otherwise("Nữ").alias("gender"))
    none = spark.createDataFrame([], "item long, block string, label string, weight double")
    found = Retriever(items, none, none, e).search(e.where("item % 50 = 0").select(F.col("item").alias("query"), "embedding"), 5, gender="nữ")
    return found.select("query", "item", "score", F.col("rank").cast("long").alias("rank"))


@query("""SELECT * FROM (SELECT count(*) AS n_documents, count(DISTINCT source) AS n_sources FROM documents), (VALUES
('one', 'm-1'), ('other', 'embedded with m-1, not m-2'), ('mixed', 'several models in one table: [''m-1'', ''m-2'']'), ('empty', 'the embedding table is empty')) t("table", verdict)""")
def model_guard(spark, d):
    """What the guard of embedding tables says of a table of one model, of another one than was asked for, of two
    models and of none."""
    docs = bind.t(spark, d, "documents").select("doc_id", "source")
    one = docs.withColumn("model_id", F.lit("m-1"))
    mixed = docs.withColumn("model_id", F.when(F.col("doc_id") % 2 == 0, "m-1").otherwise("m-2"))

    def verdict(df, expected=None):
        try:
            return dense.one_model(df, expected)
        except ValueError as e:
            return str(e)

    said = [("one", verdict(one)), ("other", verdict(one, "m-2")), ("mixed", verdict(mixed)), ("empty", verdict(one.limit(0)))]
    sizes = docs.agg(F.count("*").alias("n_documents"), F.count_distinct("source").alias("n_sources"))
    return spark.createDataFrame(said, "table string, verdict string").crossJoin(F.broadcast(sizes))


@query("""SELECT * FROM (VALUES ('customer', 'c_name', 'missing, declared string'), ('customer', 'c_acctbal', 'string, declared double'), ('customer', 'more', 'not declared, is int'),
('orders', '', 'the table is missing or cannot be read')) t("table", "column", what)""")
def dq_drift(spark, d):
    """Stored tables against their declared schemas: a column that went, one of another type, one that came, and
    a table that is not there; the third table is as declared."""
    base = new_folder(spark)
    tables = {name: bind.t(spark, d, name) for name in ("customer", "supplier", "orders")}
    tables["customer"].drop("c_name").withColumn("c_acctbal", F.col("c_acctbal").cast("string")).withColumn("more", F.lit(1)).write.parquet(f"{base}/customer")
    tables["supplier"].repartition(3).write.parquet(f"{base}/supplier")
    return quality.warehouse_drift(spark, base, {name: df.schema for name, df in tables.items()})


@query("""SELECT * FROM (VALUES ('mart', 'customer'), ('none', 'customer'), ('none', 'fact')) t("table", source)""")
def dq_freshness(spark, d):
    """A fact that was written after its source, a mart whose source came again, and one never written."""
    base = new_folder(spark)
    customer = bind.t(spark, d, "customer")
    sums = customer.groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("total"))
    sums.write.parquet(f"{base}/mart")
    customer.write.partitionBy("c_mktsegment").parquet(f"{base}/customer")
    sums.write.parquet(f"{base}/fact")
    return quality.stale_tables(spark, base, {"mart": ["customer"], "fact": ["customer"], "none": ["customer", "fact"]})
