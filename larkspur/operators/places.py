"""The place of each row in an order over a whole table, without a task that holds the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.sources.scratch import stored

#: Rows of one partition, as monotonically_increasing_id counts them.
_ROWS = 33


def with_place(df: DataFrame, order: list[Column | str], name: str = "place") -> DataFrame:
    """`df` with each row's place, from 1, in the order of `order` (rows that are equal in it follow each other).

    Rows are dealt to partitions by ranges of the order and sorted there; a row's place is its number in its
    partition after the rows of the partitions before, which are one count each.  The sorted rows are stored,
    as their numbers must not change between the two uses.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__row", _ROWS)
    sizes = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = F.col("__row").bitwiseAND(F.lit((1 << _ROWS) - 1))
    out = rows.join(F.broadcast(sizes), part == F.col("__part"))
    return out.withColumn(name, F.col("__before") + inside + 1).drop("__row", "__part", "__before")
