"""Streams fed out of order in several batches against batch results; the upserted table's files."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from larkspur.operators import silver, star
from larkspur.streaming import jobs, upserts

SCHEMA = "event_id long, user_id long, ts timestamp, value double, event_type string"


def events(spark, seed=4, n=60):
    rng = random.Random(seed)
    rows = [(k, rng.choice([1, 1, 1, 2, 3]), 1_700_000_000 + 600 * rng.randint(0, n // 2), rng.choice([None, round(rng.random(), 2)]), rng.choice(["error", "purchase"])) for k in range(n)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, s long, value double, event_type string")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").select(*[c.split()[0] for c in SCHEMA.split(", ")]).cache()


def run_in_batches(spark, df, base, make, parts=3):
    """The stream's output after three files in any order of stamps, then the mark of the end."""
    shuffled = df.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(parts)))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{base}/in")
    stream = make(jobs.with_end(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), f"{base}/end"))
    for k in range(parts):
        shuffled.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{base}/in")
        jobs.to_table(stream, f"{base}/out", f"{base}/state").awaitTermination()
    jobs.end(df, f"{base}/end")
    jobs.to_table(stream, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def test_deltas_out_of_order(spark, tmp_path):
    """Three batches in any order give the batch snapshots' changes, rows of equal stamps by their id."""
    df = events(spark)
    got = run_in_batches(spark, df, str(tmp_path), lambda s: jobs.deltas(s, "user_id", "ts", "value", "event_id", 2, late="30 days"))
    want = star.snapshots(df.withColumn("at", F.struct("ts", "event_id")), "user_id", "at", {"value": 2})
    key = lambda r: tuple(map(str, r))
    a = sorted(map(key, got.select("key", "row", "stamp", "value", "delta").collect()))
    b = sorted(map(key, want.select("user_id", "event_id", "ts", "value", "value_delta").collect()))
    assert a == b and len(a) == 60


def test_failures_out_of_order(spark, tmp_path):
    df = events(spark, 5)
    rows = run_in_batches(spark, df, str(tmp_path), lambda s: jobs.failures(s.withColumn("ok", F.col("event_type") == "purchase"), "user_id", "ts", "event_id", late="30 days"))
    got = {r.key: (r.fail_count, r.hours) for r in silver.latest(rows, "key", "stamp", "row").collect()}
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.ts, r.event_id)):
        n = 0 if r.event_type == "purchase" else want.get(r.user_id, (0,))[0] + 1
        want[r.user_id] = (n, {0: None, 1: 6, 2: 24}.get(n, 72))
    assert got == want


def odd_hits(spark):
    """Stamps on either side of half a second, four hits of no user and one without a stamp."""
    at = lambda *s: [round(x * 1e6) + 1_704_067_200_000_000 for x in s]
    rows = [(1, t) for t in at(0.4, 2.0, 4.0, 10.6)] + [(2, t) for t in at(0.6, 2.0, 4.0, 10.4)] + [(3, t) for t in at(0.5, 2.0, 4.0, 9.0)]
    rows += [(4, t) for t in at(1.5, 2.0, 4.0, 11.0)] + [(None, t) for t in at(1, 2, 3, 4)] + [(5, t) for t in at(1, 2, 3)] + [(5, None)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "event_id long, user_id long, us long")
    return df.select("event_id", "user_id", F.timestamp_micros("us").alias("ts"), F.lit(1.0).alias("value"), F.lit("view").alias("event_type"))


def test_bursts_count_nearest_seconds(spark):
    """User 1's hits of 0.4 and 10.6 s count in seconds 0 and 11, user 2's of 0.6 and 10.4 s in 1 and 10; halves to even ones."""
    got = jobs.batch_bursts(odd_hits(spark), "user_id", "ts", 4, 10)
    assert sorted((r.user_id, r.event_id, r.hits) for r in got.collect()) == [(2, 7, 4), (3, 11, 4), (4, 15, 4)]
    hits = odd_hits(spark).toPandas()  # noqa: F841
    near = "epoch(b.ts)::BIGINT BETWEEN epoch(a.ts)::BIGINT - 9 AND epoch(a.ts)::BIGINT"
    sql = f"SELECT a.user_id, a.event_id, count(*) FROM hits a JOIN hits b ON b.user_id = a.user_id AND {near} GROUP BY 1, 2 HAVING count(*) >= 4"
    assert sorted(duckdb.sql(sql).fetchall()) == [(2, 7, 4), (3, 11, 4), (4, 15, 4)]


def test_stream_bursts_count_nearest_seconds(spark, tmp_path):
    """The same in three batches, whose watermark stands between the stamps of a second."""
    got = run_in_batches(spark, odd_hits(spark), f"{tmp_path}/late", lambda s: jobs.bursts(s, "user_id", "event_id", "ts", 4, 10))
    assert sorted((r.user_id, r.event_id, r.hits) for r in got.collect()) == [(2, 7, 4), (3, 11, 4), (4, 15, 4)]
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/in")
    stream = jobs.bursts(jobs.with_end(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/end"), "user_id", "event_id", "ts", 2, 1, late="0 seconds")
    for s in (10.2, 10.3, 10.4, 10.5, 10.6, 11.5, 11.6, 12.4):  # seconds 10, 10, 10, 10, 11, 12, 12, 12
        row = spark.range(1).select(F.lit(round(s * 10)).cast("long").alias("event_id"), F.lit(1).cast("long").alias("user_id"), F.timestamp_micros(F.lit(round(s * 1e6) + 1_704_067_200_000_000)).alias("ts"), F.lit(1.0).alias("value"), F.lit("view").alias("event_type"))
        row.write.mode("append").parquet(f"{tmp_path}/in")
        jobs.to_table(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    jobs.end(odd_hits(spark), f"{tmp_path}/end")
    jobs.to_table(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    assert sorted((r.event_id, r.hits) for r in got.collect()) == [(102, 4), (103, 4), (104, 4), (105, 4), (115, 3), (116, 3), (124, 3)]


def test_state_is_forgotten(spark, tmp_path):
    """After `forget` without snapshots a key starts anew; without it the last snapshot stays."""
    df = spark.createDataFrame([(1, 1, 0, 1.0), (2, 1, 3600, 3.0), (3, 2, 90 * 86400, 1.0), (4, 1, 100 * 86400, 7.0)], "event_id long, user_id long, s long, value double")
    df = df.select("event_id", "user_id", F.timestamp_seconds(F.col("s") + 1_600_000_000).alias("ts"), "value", F.lit("x").alias("event_type"))
    for forget, last in ((None, 4.0), (10 * 86_400_000, None)):
        base = str(tmp_path / f"f{forget}")
        spark.createDataFrame([], SCHEMA).write.parquet(f"{base}/in")
        source = jobs.with_end(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), f"{base}/end")
        stream = jobs.deltas(source, "user_id", "ts", "value", "event_id", late="1 day", forget=forget)
        for part in ("event_id < 3", "event_id = 3", "event_id = 4"):
            df.where(part).write.mode("append").parquet(f"{base}/in")
            jobs.to_table(stream, f"{base}/out", f"{base}/state").awaitTermination()
        jobs.end(df, f"{base}/end")
        jobs.to_table(stream, f"{base}/out", f"{base}/state").awaitTermination()
        got = {r.row: r.delta for r in spark.read.schema(stream.schema).parquet(f"{base}/out").collect()}
        assert got == {1: None, 2: 2.0, 3: None, 4: last}


def size_of(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_upserts_rewrite_their_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(20_000).select(F.col("id").alias("key"), F.lit(1).alias("stamp"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    upserts.merge(first, path, 0, "key", "stamp", buckets=16)
    whole = size_of(f"{path}/data/v0")
    few = spark.createDataFrame([(7, 2, "new"), (7, 0, "old"), (30_000, 1, "added"), (None, 9, "no key")], "key long, stamp int, v string")
    upserts.merge(few, path, 3, "key", "stamp", buckets=16)
    assert 0 < size_of(f"{path}/data/v3") < whole * 2.6 / 16
    now = {r.key: r.v for r in upserts.current(spark, path).where("key in (6, 7, 30000) or key is null").collect()}
    assert now[7] == "new" and now[30_000] == "added" and len(now) == 3
    assert upserts.current(spark, path).count() == 20_001 and upserts.current(spark, path, 0).count() == 20_000
    # the same batch again, an older stamp, and nothing change no row
    upserts.merge(first.limit(5), path, 3, "key", "stamp", buckets=16)
    upserts.merge(few.where("stamp = 0"), path, 4, "key", "stamp", buckets=16)
    upserts.merge(few.limit(0), path, 5, "key", "stamp", buckets=16)
    assert {r.key: r.v for r in upserts.current(spark, path).where("key = 7").collect()} == {7: "new"}
    # version 0's manifest is gone by now, and of its files those that newer ones replaced
    assert upserts.versions(spark, path) == [4, 5]
    with pytest.raises(ValueError):
        upserts.current(spark, path, 0)
    assert 0 < size_of(f"{path}/data/v0") < whole
    assert not os.path.exists(f"{path}/data/v5")


def test_a_merge_that_broke_off_is_done_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(k, 1, "a") for k in range(50)], "key long, stamp int, v string")
    upserts.merge(rows, path, 0, "key", "stamp", buckets=4)
    # data of version 1 without a manifest, and a manifest without its mark, are not seen
    rows.limit(3).write.parquet(f"{path}/data/v1/upsert_bucket=0")
    spark.createDataFrame([(0, 1)], "bucket int, version long").write.parquet(f"{path}/manifests/v1")
    os.remove(f"{path}/manifests/v1/_SUCCESS")
    assert upserts.versions(spark, path) == [0] and upserts.current(spark, path).count() == 50
    upserts.merge(rows.withColumn("v", F.lit("b")).withColumn("stamp", F.lit(2)), path, 1, "key", "stamp", buckets=4)
    assert upserts.current(spark, path).where("v = 'b'").count() == 50
    assert upserts.current(spark, str(tmp_path / "none")) is None


def test_upsert_stream_in_three_batches(spark, tmp_path):
    df, base = events(spark, 6), str(tmp_path)
    shuffled = df.withColumn("part", F.col("event_id") % 3)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{base}/in")
    for k in range(3):
        shuffled.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{base}/in")
        jobs.upsert_latest(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), f"{base}/out", f"{base}/state", "user_id", "ts", "event_id", buckets=4).awaitTermination()
    want = {(r.user_id, r.event_id) for r in silver.latest(df, "user_id", "ts", "event_id").collect()}
    assert {(r.user_id, r.event_id) for r in upserts.current(spark, f"{base}/out").collect()} == want
