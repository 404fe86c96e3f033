"""Incremental forms on Structured Streaming.  Watermarks are stated per job; later rows than that are
new behaviour of the streaming form and are dropped by Spark."""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from larkspur.functions.exprs import rounded
from larkspur.operators.queue import COOL_HOURS

from . import upserts


def event_stream(spark: SparkSession, path: str, schema=None, files: int | None = None) -> DataFrame:
    """Parquet events as a stream, their ts a timestamp."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def with_end(events: DataFrame, path: str) -> DataFrame:
    """The stream and what `end` writes to `path`, so that a last run closes what is open."""
    spark = events.sparkSession
    spark.createDataFrame([], events.schema).write.mode("append").parquet(path)
    return events.unionByName(spark.readStream.schema(events.schema).parquet(path))


def end(events: DataFrame, path: str, stamp: str = "ts") -> None:
    """Marks the end of the stream: a row without a key far after all others, which moves the watermark."""
    far = events.sparkSession.range(1)
    cols = [F.lit("2250-01-01").cast(f.dataType).alias(f.name) if f.name == stamp else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields]
    far.select(*cols).write.mode("append").parquet(path)


def record_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New JSON lines of a folder; derived tables refresh when files arrive, not by the clock."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").json(path)


def _once(df: DataFrame, checkpoint: str, mode: str = "append"):
    return df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)


def to_table(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return _once(df, checkpoint).format("parquet").start(path)


def upsert_latest(df: DataFrame, path: str, checkpoint: str, key: str, stamp: str, *order: str, buckets: int = 64) -> StreamingQuery:
    """Keeps the newest row per key in a bucketed table (`larkspur.streaming.upserts`): a micro-batch rewrites
    the buckets of its keys alone, and a batch that is run again changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upserts.merge(batch, path, batch_id, key, stamp, *order, buckets=buckets)

    return _once(df, checkpoint, "update").foreachBatch(merge).start()


def history(df: DataFrame, key: str, stamp: str, late: str = "1 day") -> DataFrame:
    """One row per key and stamp across batches."""
    return df.withWatermark(stamp, late).dropDuplicatesWithinWatermark([key, stamp])


class _InOrder(StatefulProcessor):
    """Rows of a key in order of stamp and row: they are held until the watermark has passed their stamp, so
    neither their order nor the batch they come in changes the result.

    `start` is a key's first state, `step(state, stamp, row, value)` gives its next one and what to emit, None
    for nothing.  The state is forgotten `forget` milliseconds after its last stamp, if that is set.
    """

    def __init__(self, value: str, start: tuple, kinds: str, gives: str, forget: int | None):
        self.value, self.start, self.kinds, self.forget = value, start, kinds, forget
        self.schema = "key long, row long, at long, " + gives
        self.names = [c.split()[0] for c in self.schema.split(", ")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", f"at long, row long, value {self.value}")
        self.last = handle.getValueState("last", f"at long, {self.kinds}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        if key[0] is None:  # the mark of a stream's end, which moves the watermark alone
            return iter(())
        new = [(r.at, r.row, r.value) for r in rows]
        self.held.appendList(new)
        self.handle.registerTimer(max(min(at for at, _, _ in new) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        mark = timerValues.getCurrentWatermarkInMs()
        held = sorted((tuple(r) for r in self.held.get()), key=lambda r: (r[0], r[1] is not None, r[1]))
        ready = [r for r in held if r[0] // 1000 < mark]
        at, *state = self.last.get() if self.last.exists() else (None, *self.start)
        if ready:
            for at, row, value in ready:
                state, out = self.step(state, at, row, value)
                if out is not None:
                    yield Row(**dict(zip(self.names, (key[0], row, at, *out))))
            self.last.update((at, *state))
        rest = held[len(ready) :]
        if rest:
            self.held.put(rest)
            self.handle.registerTimer(max(rest[0][0] // 1000 + 1, mark + 1))
            return
        self.held.clear()
        if self.forget is None or at is None:
            return
        gone = at // 1000 + self.forget
        if gone < mark:
            self.last.clear()
        else:
            self.handle.registerTimer(gone + 1)

    def close(self) -> None:
        pass


class _Deltas(_InOrder):
    def step(self, state, at, row, value):
        (last,) = state
        known = value is not None and last is not None
        return (value,), (value, value - last if known else None)


class _Failures(_InOrder):
    def step(self, state, at, row, value):
        fails = 0 if value else state[0] + 1
        return (fails,), (fails, COOL_HOURS[min(fails, len(COOL_HOURS)) - 1] if fails else None)


def _in_order(df: DataFrame, key: str, stamp: str, row: str, value: Column, processor: _InOrder, late: str) -> DataFrame:
    """Runs a processor over (key, at in microseconds, row, value); its state store keeps lists and timers."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(stamp).alias("stamp"), F.unix_micros(F.col(stamp).cast("timestamp")).alias("at"), F.col(row).cast("long").alias("row"), value.alias("value"))
    rows = rows.where("at is not null").withWatermark("stamp", late)
    out = rows.groupBy("key").transformWithState(processor, processor.schema, "append", "eventtime")
    return out.withColumn("stamp", F.timestamp_micros("at")).drop("at")


def deltas(df: DataFrame, key: str, stamp: str, value: str, row: str, digits: int = 6, late: str = "1 day", forget: int | None = None) -> DataFrame:
    """Change of the value against the key's snapshot before, null for the first or beside a null value:
    key, row, stamp, value, delta.

    As `star.snapshots` in batch: rows of a key are taken in order of stamp and row, whatever batch they come
    in, and are written once the watermark has passed them.  Only rows later than `late` are left out, as
    Spark does.  A key's state is its last snapshot and the rows the watermark has not passed; it is
    kept, or forgotten after `forget` milliseconds without snapshots.  Null keys and stamps are left out.
    """
    done = _in_order(df, key, stamp, row, F.col(value).cast("double"), _Deltas("double", (None,), "value double", "value double, change double", forget), late)
    return done.select("key", "row", "stamp", "value", rounded(F.col("change"), digits).alias("delta"))


def _second(stamp: str) -> Column:
    """The second nearest to a stamp, of two the even one."""
    return F.rint(F.unix_micros(stamp) / 1e6).cast("long")


def bursts(df: DataFrame, key: str, row_id: str, stamp: str, least: int = 4, seconds: int = 900, late: str = "15 minutes") -> DataFrame:
    """Hits that close a burst, as `batch_bursts` finds them.  A hit is counted once the watermark has passed
    all stamps of its second; a key's state is the hits not counted yet and those of the last `seconds` before them."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if pd.isna(k[0]):  # the mark of a stream's end, which moves the watermark alone
            return
        kept, upto = json.loads(state.get[0]) if state.exists else ([], None)
        for f in frames:
            kept += [[int(s), None if pd.isna(i) else int(i)] for s, i in zip(f["second"], f[row_id])]
        kept.sort(key=lambda r: r[0])
        # a second's last stamp is half a second after it
        at, now = [r[0] for r in kept], (state.getCurrentWatermarkMs() + 499) // 1000
        first = 0 if upto is None else bisect_left(at, upto)
        last = max(first, bisect_left(at, now))  # the seconds before `now` are complete
        out = [(k[0], kept[i][1], bisect_right(at, at[i]) - bisect_left(at, at[i] - seconds + 1)) for i in range(first, last)]
        upto = now if upto is None else max(now, upto)
        kept = kept[bisect_left(at, upto - seconds + 1) :]
        if kept:
            state.update((json.dumps([kept, upto]),))
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, (min((t for t in at[last:]), default=at[-1] + seconds) + 1) * 1000))
        elif state.exists:
            state.remove()
        yield pd.DataFrame([x for x in out if x[2] >= least], columns=["key", "row", "hits"])

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(row_id).cast("long").alias(row_id), F.col(stamp).alias(stamp), _second(stamp).alias("second"))
    rows = rows.where("second is not null").withWatermark(stamp, late)
    found = rows.groupBy("key").applyInPandasWithState(step, "key long, row long, hits long", "hits string", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.col("key").alias(key), F.col("row").alias(row_id), "hits")


def batch_bursts(df: DataFrame, key: str, stamp: str, least: int = 4, seconds: int = 900) -> DataFrame:
    """Hits that close a burst: at least so many of the key in the seconds up to each.  A hit counts in the second
    nearest to its stamp, of two in the even one; those without key or stamp are in no burst."""
    from pyspark.sql import Window

    by = Window.partitionBy(key).orderBy(_second(stamp)).rangeBetween(-(seconds - 1), 0)
    hits = df.where(F.col(key).isNotNull() & F.col(stamp).isNotNull())
    return hits.withColumn("hits", F.count("*").over(by)).where(F.col("hits") >= least)


def idle_sessions(df: DataFrame, key: str, stamp: str, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    w = F.session_window(stamp, gap)
    return df.withWatermark(stamp, late).groupBy(key, w.alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def failures(df: DataFrame, key: str, stamp: str, row: str, late: str = "1 day", forget: int | None = None) -> DataFrame:
    """A key's consecutive failures and hours of rest after each of its outcomes, in order of stamp and row:
    key, row, stamp, fail_count, hours.  df has ok (boolean); late rows and state as in `deltas`.
    """
    ok = F.coalesce(F.col("ok").cast("boolean"), F.lit(False))
    return _in_order(df, key, stamp, row, ok, _Failures("boolean", (0,), "fails long", "fail_count long, hours long", forget), late)
