"""Bottom-k sketches of word-shingle hashes, with DataFrame functions only.

A sketch is the sorted array of the k smallest distinct hashes of a text's shingles.  Sketches of
parts merge into the sketch of the whole, and two of them estimate resemblance, containment and
the number of distinct shingles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashes kept per sketch; the standard error of a resemblance r is sqrt(r (1 - r) / K).
K = 128
WIDTH = 5
_RANGE = float(1 << 63)
#: Ids are dealt into at most so many buckets, so the table of their first ids stays under 32 MB.
MAX_BUCKETS = 1_000_000
ROWS_PER_BUCKET = 100
#: Buckets lie between so many quantiles of the ids (a power of two).
QUANTILES = 1024


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` with `value` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch(text: Column, width: int = WIDTH, k: int = K) -> Column:
    """Bottom-k sketch of the text's shingles of `width` words; words are what white space separates.

    A text of fewer words has one shingle, all of them.  Null and empty texts and texts of white
    space alone give an empty array.
    """

    def hashes(w: Column) -> Column:
        last = F.size(w) - width
        shingle = lambda i: F.shiftrightunsigned(F.xxhash64(*(F.get(w, i + j) for j in range(width))), 1)
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), shingle)).otherwise(F.array(F.shiftrightunsigned(F.xxhash64(w), 1)))

    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\r\x0b\x0c"))
    none = F.array().cast("array<bigint>")
    return _let(body, lambda b: F.when(b == "", none).otherwise(F.slice(F.sort_array(F.array_distinct(_let(F.split(b, r"\s+"), hashes))), 1, k)))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches were made of."""
    return F.slice(F.sort_array(F.array_distinct(F.concat(a, b))), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness; 1 for two empty sketches, 0 for an empty and another."""
    both = lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.greatest(F.size(u), F.lit(1))
    return F.when(a == b, F.lit(1.0)).otherwise(_let(merged(a, b, k), both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(_RANGE) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first one's shingles that the second one has; 1 for an empty first."""
    share = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / F.greatest(distinct_shingles(a, k), F.lit(1.0))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def digest(a: Column) -> Column:
    """A sketch as text: sixteen hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def merge_by(df: DataFrame, keys: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One sketch per group.  Equal hashes fold before the first shuffle and a group is cut to k
    hashes in each task before the second (the window's group limit)."""
    rows = df.select(F.struct(*keys).alias("__key"), F.explode(sketch_col).alias("__hash"))
    rank = F.row_number().over(Window.partitionBy("__key").orderBy("__hash"))
    least = rows.distinct().withColumn("__rank", rank).where(F.col("__rank") <= k)
    merged = least.groupBy("__key").agg(F.sort_array(F.collect_list("__hash")).alias("__sketch"))
    return merged.select(*(F.col("__key")[c].alias(c) for c in keys), F.col("__sketch").alias(sketch_col))


def _bucket(ids: DataFrame) -> Column | None:
    """Bucket of `__id`: an interval between quantiles of the ids, cut into equal steps; null without ids.

    Quantiles follow the ids wherever they lie close together or far apart.
    """
    shares = [k / QUANTILES for k in range(QUANTILES + 1)]
    n, found = ids.agg(F.count("*"), F.percentile_approx("__id", shares, 8 * QUANTILES)).first()
    if not n:
        return None
    steps = max(1, min(MAX_BUCKETS, n // ROWS_PER_BUCKET) // QUANTILES)
    bounds = F.lit(found)
    halves = F.array(*(F.lit(QUANTILES >> k) for k in range(1, QUANTILES.bit_length())))
    step = lambda at, half: F.when(F.get(bounds, at + half) <= F.col("__id"), at + half).otherwise(at)
    at = F.aggregate(halves, F.lit(0), step)  # binary search: the last quantile that is no larger

    def inside(at: Column) -> Column:
        low, high = F.get(bounds, at), F.get(bounds, at + 1)
        share = (F.col("__id") - low) / F.greatest(high - low, F.lit(1))
        return at.cast("long") * steps + F.greatest(F.least(F.floor(share * steps), F.lit(steps - 1)), F.lit(0))

    return _let(at, inside)


def with_next(df: DataFrame, id_col: str, carry: list[str]) -> DataFrame:
    """Adds next_<column> for each column to carry: its value in the row of the next larger id, and
    in the row of the smallest id for the row of the largest.

    Ids are dealt into buckets by value, the smallest row of each bucket is copied to the bucket
    before, and a window over each bucket looks one row ahead; no task holds the whole order, but
    the rows of one id stand in one bucket.  Rows with a null id have no next row, are none, and are not
    shuffled; repeated ids follow each other in the order of the carried columns.  Other columns stay, whatever their names; one named next_<column> is
    replaced.
    """
    nexts = [f"next_{c}" for c in carry]
    kept = [c for c in df.columns if c not in nexts]
    without = df.where(F.col(id_col).isNull()).select(*kept, *(F.lit(None).cast(df.schema[c].dataType).alias(n) for c, n in zip(carry, nexts)))
    df = df.where(F.col(id_col).isNotNull())
    own = {c: f"__own_{k}" for k, c in enumerate(kept)}  # plain columns: a window would copy parts of a struct
    rows = df.select(*(F.col(c).alias(n) for c, n in own.items()), F.col(id_col).cast("long").alias("__id"))
    ids = rows.select("__id")
    bucket = _bucket(ids)
    if bucket is None:
        return without
    firsts = ids.groupBy(bucket.alias("__bucket")).agg(F.min("__id").alias("__first"))
    order = Window.orderBy("__bucket")  # at most 1.1 MAX_BUCKETS rows of two integers
    before, last = F.lag("__bucket").over(order), F.max("__bucket").over(Window.partitionBy())
    firsts = firsts.select("__first", F.coalesce(before, last).alias("__before"), before.isNull().alias("__wraps"))
    rows = rows.join(F.broadcast(firsts), F.col("__id") == F.col("__first"), "left")
    place = lambda at, copy, wraps: F.struct(at.alias("bucket"), copy.alias("copy"), wraps.alias("wraps"))
    here = place(bucket, F.lit(False), F.lit(False))
    copy = F.when(F.col("__first").isNotNull(), place(F.col("__before"), F.lit(True), F.col("__wraps")))
    rows = rows.select(*own.values(), "__id", F.inline(F.array_compact(F.array(here, copy))).alias("__bucket", "__copy", "__wraps"))
    look = Window.partitionBy("__bucket").orderBy("__wraps", "__id", "__copy", *(own[c] for c in carry))
    ahead = {f"__{n}": F.lead(own[c]).over(look) for c, n in zip(carry, nexts)}
    rows = rows.withColumns(ahead).where("not __copy")
    return rows.select(*(F.col(n).alias(c) for c, n in own.items()), *(F.col(f"__{n}").alias(n) for n in nexts)).union(without)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, k: int = K) -> DataFrame:
    """Per row: the id, the text (null as empty), its sketch and the estimated distinct shingles."""
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("text")).withColumn("sketch", sketch(F.col("text"), width, k))
    return rows.withColumn("distinct_shingles", distinct_shingles(F.col("sketch"), k))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited text (second half replaced by the start of the next text) and
    against the next text, by their sketches.

    Null texts count as empty.  A row with a null id has no next text: its half is cut only and
    `near_next` compares with an empty text.  An only row is its own next.
    """
    rows = with_next(fingerprints(docs, id_col, text_col), id_col, ["text", "sketch"])
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    after = F.coalesce("next_text", F.lit(""))
    rows = rows.withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(after, F.lit(1), half)))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    empty = F.array().cast("array<bigint>")
    return rows.select(
        F.col(id_col),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("sketch")).alias("fingerprint"),
        digest(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.coalesce("next_sketch", empty)).alias("near_next"),
        F.round("distinct_shingles", 1).alias("distinct_shingles"),
    )
