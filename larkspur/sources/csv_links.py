"""URL lists from CSV and text files of unknown layout, read as tables of lines and cells."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from larkspur.operators.pages import host, resolve

DELIMITERS = (",", ";", "\t", "|")
#: Header names that tell a column of URLs.
URL_HEADERS = ("url", "link", "href", "source_url", "product_url")


def stripped(text: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(text, F.lit(" \t\r\n\f\v\u00a0"))


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) of all lines, without byte-order marks.

    Lines are ordered by (start of the block they were read from, number): a large file is read in
    several blocks, whose tasks have no order of their own.
    """
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("number"))
    text = F.regexp_replace("value", "^\ufeff", "").alias("text")
    return spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("file"), line.alias("line"), text)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) without blank lines."""
    return raw_lines(spark, path).where(stripped(F.col("text")) != "")


#: Lines of a block that one record may take; a quote that stays open longer is an error, as a mistake in the
#: file would join all that follows.
RECORD_LINES = 10_000


def ends_quoted(text: str, delimiter: str, quoted: bool) -> bool:
    """Whether a line ends inside a quoted cell, if it begins inside one or not.  Quotes open at a cell's first
    character alone; a doubled quote inside stands for one."""
    at = 0
    while True:
        if quoted:
            at = text.find('"', at)
            while at >= 0 and text[at + 1 : at + 2] == '"':
                at = text.find('"', at + 2)
            if at < 0:
                return True
            quoted = False
            at = text.find(delimiter, at + 1)
        else:
            if text[at : at + 1] == '"':
                quoted, at = True, at + 1
                continue
            at = text.find(delimiter, at)
        if at < 0:
            return False
        at += 1


@F.pandas_udf(IntegerType())
def _turns(text: pd.Series, delimiter: pd.Series) -> pd.Series:
    """What a line makes of a quoted cell: 0 and 1 where it ends outside and inside whatever was before, 2 where it
    leaves that as it is and 3 where it turns it round."""

    def of(t: str, d: str) -> int:
        if '"' not in t:
            return 2
        outside, inside = ends_quoted(t, d, False), ends_quoted(t, d, True)
        return int(outside) if outside == inside else 3 if outside else 2

    return pd.Series([of(t, d) for t, d in zip(text, delimiter)], dtype="int32")


def _before(by: Window, of: str = "turn") -> Column:
    """Whether a row begins inside a quoted cell, by the rows before it in a window; null if the rows before leave
    that to what stands before them, with the number of turns since in `turns`."""
    return F.last(F.when(F.col(of) < 2, F.struct(F.col(of).alias("is"), F.col("turns").alias("at"))), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))


def records(lines: DataFrame) -> DataFrame:
    """(file, line, text, delimiter): the lines of `raw_lines` with those joined that a quoted cell runs over; blank
    records go.

    Whether a line begins inside a quoted cell depends on all lines before it in its file.  Each line turns
    that state in one of four ways, and ways can be put together: first within a block of a file, then over
    the blocks (one row each), so no task reads a file.  Only records of several lines are shuffled again.
    Raises where a record takes more than RECORD_LINES lines of a block.
    """
    lines = lines.join(delimiters(lines).drop("first"), "file")
    lines = lines.withColumn("turn", _turns("text", "delimiter"))
    block, place = F.col("line.block"), F.col("line.number")
    inside = Window.partitionBy("file", block).orderBy(place)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.when(F.col("turn") == 3, 1).otherwise(0)).over(upto), F.lit(0))
    rows = lines.withColumn("turns", turns).withColumn("known", _before(inside))

    # a block's own turn, and the state that it begins with
    each = F.struct(place.alias("n"), F.col("turns"), F.col("turn"), F.col("known"))
    blocks = rows.groupBy("file", block.alias("block")).agg(F.max(each).alias("x"))
    odd = F.pmod(F.col("x.turns") + F.when(F.col("x.turn") == 3, 1).otherwise(0), F.lit(2))
    from_known = F.pmod(F.col("x.known.is") + F.col("x.turns") - F.col("x.known.at") + F.when(F.col("x.turn") == 3, 1).otherwise(0), F.lit(2))
    own = F.when(F.col("x.turn") < 2, F.col("x.turn")).when(F.col("x.known").isNotNull(), from_known).otherwise(2 + odd)
    blocks = blocks.select("file", "block", own.cast("int").alias("turn"))
    over = Window.partitionBy("file").orderBy("block")
    turned = F.coalesce(F.sum(F.when(F.col("turn") == 3, 1).otherwise(0)).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("turns", turned).withColumn("known", _before(over))
    begins = F.pmod(F.coalesce(F.col("known.is"), F.lit(0)) + F.col("turns") - F.coalesce(F.col("known.at"), F.lit(0)), F.lit(2))
    blocks = blocks.select("file", "block", begins.alias("begins"))

    rows = rows.withColumn("block", block).join(blocks, ["file", "block"])
    state = F.pmod(F.coalesce(F.col("known.is"), F.col("begins")) + F.col("turns") - F.coalesce(F.col("known.at"), F.lit(0)), F.lit(2))
    rows = rows.withColumn("inside", state == 1)
    after = F.when(F.col("turn") < 2, F.col("turn") == 1).when(F.col("turn") == 3, ~F.col("inside")).otherwise(F.col("inside"))
    rows = rows.withColumn("open", after)
    single = rows.where("not inside and not open").select("file", "line", "text", "delimiter")

    # the record of a line of several is the last one that began before it, in its block or an earlier one
    several = rows.where("inside or open").withColumn("began", F.when(~F.col("inside"), F.col("line")))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    several = several.withColumns({"record": F.last("began", ignorenulls=True).over(so_far), "n": F.row_number().over(inside)})
    since = F.col("n") - F.coalesce(F.last(F.when(F.col("began").isNotNull(), F.col("n")), ignorenulls=True).over(so_far), F.lit(0))
    too_long = F.raise_error(F.concat(F.lit("a quote stays open too long in "), F.col("file"))).cast("string")
    several = several.withColumn("since", since).withColumn("text", F.when(F.col("since") > RECORD_LINES, too_long).otherwise(F.col("text")))
    last = several.groupBy("file", "block").agg(F.max("began").alias("last"))
    last = last.withColumn("earlier", F.last("last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)))
    several = several.join(last.select("file", "block", "earlier"), ["file", "block"]).withColumn("record", F.coalesce("record", "earlier"))
    joined = several.groupBy("file", "record", "delimiter").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("parts"))
    joined = joined.select("file", F.col("record").alias("line"), F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"), "delimiter")
    return single.unionByName(joined).where(stripped(F.col("text")) != "")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files, whose quoted cells may run over lines."""
    return records(raw_lines(spark, path))


def delimiters(lines: DataFrame) -> DataFrame:
    """(file, delimiter, first): the commonest of the known delimiters, of equal ones the first, and the
    file's first line."""
    n = [F.sum(F.length("text") - F.length(F.replace("text", F.lit(d), F.lit("")))).alias(f"n{k}") for k, d in enumerate(DELIMITERS)]
    ranked = F.array(*(F.struct(F.col(f"n{k}").alias("n"), F.lit(-k).alias("k"), F.lit(d).alias("d")) for k, d in enumerate(DELIMITERS)))
    rows = lines.groupBy("file").agg(*n, F.min("line").alias("first"))
    return rows.select("file", F.array_max(ranked)["d"].alias("delimiter"), "first")


def split_cells(text: Column, delimiter: Column) -> Column:
    """Cells of a record; quoted ones may hold delimiters and line breaks, and quotes doubled."""
    head = F.concat(F.lit("["), delimiter, F.lit("]"))
    cell = F.concat(head, F.lit('(?:"(?:[^"]*(?:""[^"]*)*)"|[^'), delimiter, F.lit("]*)"))
    cells = F.regexp_extract_all(F.concat(delimiter, text), cell, F.lit(0))
    bare = lambda c: F.when(F.startswith(c, F.lit('"')), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(cells, lambda c: stripped(bare(F.substring(c, F.lit(2), F.length(c)))))


def rows_of(lines: DataFrame) -> DataFrame:
    """(file, line, cells, is_header) of `read_records` or `read_lines`: a file's first row is its header unless it
    holds a URL.  Rows of empty cells go."""
    if "delimiter" not in lines.columns:
        lines = lines.join(delimiters(lines).drop("first"), "file")
    rows = lines.withColumn("cells", split_cells(F.col("text"), F.col("delimiter"))).where(F.exists("cells", lambda c: c != ""))
    first = rows.groupBy("file").agg(F.min("line").alias("first"))
    rows = rows.join(first, "file")
    header = (F.col("line") == F.col("first")) & ~F.exists("cells", is_url)
    return rows.select("file", "line", "cells", header.alias("is_header"))


def is_url(cell: Column) -> Column:
    return F.rlike(cell, F.lit(r"(?i)^\s*(https?://|www\.|/)\S+"))


def url_columns(rows: DataFrame, named: str | None = None, exclude: int | None = None) -> DataFrame:
    """(file, column): the named column, else one with a known header, else the one with most URLs."""
    heads = rows.where("is_header").select("file", F.posexplode("cells").alias("column", "cell")).withColumn("low", F.lower(F.trim("cell")))
    by_name = heads.where(F.col("low") == named.lower()) if named else heads.where(F.col("low").isin(*URL_HEADERS))
    by_name = by_name.groupBy("file").agg(F.min("column").alias("by_name"))
    cells = rows.where("not is_header").select("file", F.posexplode("cells").alias("column", "cell"))
    if exclude is not None:
        cells = cells.where(F.col("column") != exclude)
    counts = cells.groupBy("file", "column").agg(F.count_if(is_url(F.col("cell"))).alias("n")).where("n > 0")
    by_count = counts.groupBy("file").agg(F.max_by("column", F.struct("n", -F.col("column"))).alias("by_count"))
    out = rows.select("file").distinct().join(by_name, "file", "left").join(by_count, "file", "left")
    if named and out.where("by_name is null").limit(1).count():
        raise ValueError(f"no column {named!r}")
    return out.select("file", F.coalesce("by_name", "by_count").alias("column"))


def _once(pairs: DataFrame) -> DataFrame:
    """The first row of each source."""
    by = Window.partitionBy("source").orderBy("file", "line")
    return pairs.withColumn("n", F.row_number().over(by)).where("n = 1").drop("n")


def pairs_by_host(rows: DataFrame, wanted: str, unique: bool = True) -> DataFrame:
    """(file, line, source, destination): a row's first URL on the wanted host, without its fragment, and
    its first on another host as it stands; rows without a source are left out, see `skipped`.

    With `unique` a source's first row alone counts.
    """
    urls = F.regexp_extract_all(F.concat_ws(" ", "cells"), F.lit(r"(https?://[^\s\"'<>,;|]+)"), 1)
    own = lambda u: F.contains(host(u), F.lit(wanted.lower()))
    source = F.regexp_replace(F.get(F.filter(urls, own), 0), "#.*$", "")
    destination = F.get(F.filter(urls, lambda u: ~own(u)), 0)
    out = rows.where("not is_header").select("file", "line", source.alias("source"), destination.alias("destination"))
    out = out.where("source is not null")
    return _once(out) if unique else out


def skipped(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Number of rows that gave no pair."""
    return rows.where("not is_header").join(pairs.select("file", "line"), ["file", "line"], "left_anti").agg(F.count("*").alias("skipped"))


def _place_of(rows: DataFrame, column: int | str, name: str) -> DataFrame:
    """(file, name): where each file has a column, given by number or by header.  Raises for a file
    without such a header, and for one without headers."""
    if isinstance(column, int):
        return rows.select("file").distinct().withColumn(name, F.lit(column))
    heads = rows.where("is_header").select("file", F.posexplode("cells").alias("place", "cell"))
    found = heads.where(F.lower(F.trim("cell")) == column.strip().lower()).groupBy("file").agg(F.min("place").alias(name))
    without = rows.select("file").distinct().join(found, "file", "left_anti").first()
    if without:
        raise ValueError(f"no column {column!r} in {without.file}")
    return found


def pairs_by_column(
    rows: DataFrame, source: int | str, destination: int | str | None = None, base: str = "", unique: bool = True
) -> DataFrame:
    """(file, line, source, destination) from stated columns, by number or header.  Sources that look like
    URLs count, relative ones resolved against `base` and without fragment; destinations as they stand.

    With `unique` a source's first row alone counts.
    """
    rows_ = rows.join(_place_of(rows, source, "__s"), "file")
    if destination is not None:
        rows_ = rows_.join(_place_of(rows, destination, "__d"), "file")
    cell = lambda k: F.nullif(F.trim(F.trim(F.get("cells", F.col(k))), F.lit('"')), F.lit(""))
    s = F.when(is_url(cell("__s")), cell("__s"))
    s = F.regexp_replace(resolve(F.lit(base), s) if base else s, "#.*$", "")
    d = cell("__d") if destination is not None else F.lit(None).cast("string")
    out = rows_.where("not is_header").select("file", "line", s.alias("source"), d.alias("destination")).where("source is not null")
    return _once(out) if unique else out


def url_list(lines: DataFrame) -> DataFrame:
    """URLs of a text file, one a line; comments start with #."""
    return lines.where(~F.startswith(F.trim("text"), F.lit("#"))).select("line", F.trim("text").alias("url"))
