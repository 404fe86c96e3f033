"""Joins of rows with one value per key, where a key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize

#: Broadcast a table of ids or of values while it has at most so many rows.
BROADCAST_IDS = 1 << 20
#: A key of more rows is hot: its value is broadcast while there are few such keys.
HOT = 5_000


def few(ids: DataFrame) -> DataFrame:
    """The ids, to be broadcast if they are few; else their join shuffles."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def with_values(rows: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` left-joined with one row of `values` per key, which has the key's number of rows as size.

    Few values are broadcast.  Of many, those of hot keys are broadcast, if they are few, and the
    others meet their rows in a shuffle that the hot keys' rows take no part in.
    """
    if values.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(values), keys, "left")
    hot = values.where(F.col("size") > HOT)
    if hot.count() > BROADCAST_IDS:
        return rows.join(values, keys, "left")
    known = rows.join(F.broadcast(hot), keys, "left")
    cold = values.where(F.col("size") <= HOT)
    others = known.where("size is null").select(rows.columns).join(cold, keys, "left")
    return known.where("size is not null").unionByName(others)


def dealt(rows: DataFrame, values: DataFrame, key: str, counted: DataFrame | None = None) -> DataFrame:
    """`rows` inner-joined with one row of `values` per key; a key of more than HOT rows is dealt over several.

    The values of hot keys are repeated, once for every HOT of their rows, so that no task gets a hot key
    whole.  `counted` has the keys of `rows` in a stored table; without it `rows` are read twice.
    """
    hot = (rows if counted is None else counted).groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > HOT)
    hot = few(materialize(hot.select(key, F.ceil(F.col("__n") / HOT).cast("long").alias("__parts")), "hot"))
    one = F.lit(0).cast("long")
    others = [c for c in rows.columns if c != key]
    part = F.coalesce(F.pmod(F.xxhash64(*others), F.col("__parts")), one)
    left = rows.join(hot, key, "left").withColumn("__part", part).drop("__parts")
    right = values.join(hot, key, "left").withColumn("__part", F.explode(F.coalesce(F.sequence(one, F.col("__parts") - 1), F.array(one))))
    return left.join(right.drop("__parts"), [key, "__part"]).drop("__part")
