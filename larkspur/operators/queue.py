"""Analytics over a work queue kept as tables: groups, items, outcomes and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.exprs import ratio, rounded

#: Hours of rest after one, two, and three or more failures in a row.
COOL_HOURS = (6, 24, 72)


def upsert(old: DataFrame, new: DataFrame, key: str, coalesced: list[str] = (), largest: list[str] = (), kept: list[str] = ()) -> DataFrame:
    """Old rows with new values: `coalesced` columns take the new non-null one, `largest` the greater;
    `kept` columns are the old ones and null for new rows.  Adds is_new."""
    o = old.select(key, *(F.col(c).alias(f"o_{c}") for c in (*coalesced, *largest, *kept)), F.lit(True).alias("__old"))
    n = new.select(key, *(F.col(c).alias(f"n_{c}") for c in (*coalesced, *largest)))
    cols = [F.coalesce(f"n_{c}", f"o_{c}").alias(c) for c in coalesced] + [F.greatest(f"n_{c}", f"o_{c}").alias(c) for c in largest] + [F.col(f"o_{c}").alias(c) for c in kept]
    return o.join(n, key, "full_outer").select(key, *cols, F.col("__old").isNull().alias("is_new"))


def group_totals(groups: DataFrame, items: DataFrame, key: str = "grp", total: str = "total") -> DataFrame:
    """Groups with their number of items, counted anew; zero for those without."""
    n = items.groupBy(key).agg(F.count("*").alias("__n"))
    return groups.join(n, key, "left").withColumn(total, F.coalesce("__n", F.lit(0))).drop("__n")


def seeded(result: DataFrame) -> DataFrame:
    return result.agg(F.count_if("is_new").alias("added"), F.count("*").alias("seen"))


def priority(rank: Column) -> Column:
    return F.when(rank.isNotNull(), 1000 - rank).otherwise(0)


def next_groups(groups: DataFrame, items: DataFrame, now: Column, threshold: int = 1, limit: int = 10) -> DataFrame:
    """Groups to work on: not blocked, with their listing pending or `threshold` pending items, by
    priority, rank (null last) and name.  groups: grp, name, rank, priority, listing, blocked_until."""
    pending = items.where("status = 'pending'").groupBy("grp").agg(F.count("*").alias("pending"))
    rows = groups.join(pending, "grp", "left").withColumn("pending", F.coalesce("pending", F.lit(0)))
    free = F.col("blocked_until").isNull() | (F.col("blocked_until") <= now)
    due = (F.col("listing") == "pending") | ((F.lit(threshold) > 0) & (F.col("pending") >= threshold))
    return rows.where(free & due).orderBy(F.desc("priority"), F.asc_nulls_last("rank"), "name", "grp").limit(limit)


def pending_items(items: DataFrame, n: int) -> DataFrame:
    by = Window.partitionBy("grp").orderBy(F.coalesce("comments", F.lit(0)).desc(), "item")
    return items.where("status = 'pending'").withColumn("place", F.row_number().over(by)).where(F.col("place") <= n)


def budget_slice(queue: DataFrame, order: list, budget: int, max_groups: int) -> DataFrame:
    """The first groups of the ordered queue whose whole cost fits the budget, one unit for a pending
    listing and one per pending item; the group that crosses it gets what is left.

    The queue is first cut to `max_groups` rows (a bounded top-k), so the running sum is one small task.
    """
    cost = F.when(F.col("listing") == "pending", 1).otherwise(0) + F.col("pending")
    top = queue.withColumn("cost", cost).orderBy(*order).limit(max_groups)
    before = F.coalesce(F.sum("cost").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = top.withColumn("before", before).where(F.col("before") < budget)
    return rows.withColumn("granted", F.least(F.col("cost"), budget - F.col("before")).cast("long"))


def folded(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Status per key from outcome events (ok boolean, error): the last outcome, the failures since the
    last success and the last failure's error."""
    by = Window.partitionBy(key).orderBy(*order)
    rows = events.withColumn("__ok", F.sum(F.when(F.col("ok"), 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.struct(*order)
    runs = rows.groupBy(key, "__ok").agg(F.count_if(~F.col("ok")).alias("fails"), F.max_by("ok", last).alias("ok"), F.max_by(F.when(~F.col("ok"), F.col("error")), last).alias("error"))
    now = runs.groupBy(key).agg(F.max_by(F.struct("fails", "ok", "error"), "__ok").alias("s"))
    return now.select(key, F.when(F.col("s.ok"), "done").otherwise("failed").alias("status"), F.col("s.fails").alias("fail_count"), F.when(~F.col("s.ok"), F.col("s.error")).alias("last_error"))


def cool_hours(fails: Column, hours: tuple[int, ...] = COOL_HOURS) -> Column:
    """Hours of rest after so many failures in a row; null after none."""
    at = F.least(fails, F.lit(len(hours))).cast("int")
    return F.when(fails > 0, F.try_element_at(F.array(*map(F.lit, hours)), at))


def blocks(events: DataFrame, site: str, until: str, reason: str, now: Column | None = None) -> DataFrame:
    """The longest block of each site, and only those still active at `now` if given."""
    rows = events.groupBy(site).agg(F.max(until).alias(until), F.max_by(reason, F.struct(until, reason)).alias(reason))
    return rows.where(F.col(until) > now) if now is not None else rows


def ran_on(runs: DataFrame, day: Column, zone: str = "Asia/Ho_Chi_Minh") -> DataFrame:
    """The latest finished run that used requests on a local day, if any."""
    local = F.to_date(F.from_utc_timestamp("started_at", zone))
    rows = runs.where(F.col("finished_at").isNotNull() & (F.col("used") > 0) & (local == day))
    return rows.agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id")).where("run_id is not null")


def progress(groups: DataFrame, items: DataFrame, threshold: int) -> DataFrame:
    """Counts of groups and items by state, in one row."""
    pend = items.groupBy("grp").agg(F.count_if(F.col("status") == "pending").alias("pending"))
    g = groups.join(pend, "grp", "left").withColumn("pending", F.coalesce("pending", F.lit(0)))
    listed = F.col("listing") == "done"
    a = g.agg(
        F.count("*").alias("groups"), F.count_if(listed).alias("groups_listed"), F.count_if(F.col("listing") == "pending").alias("groups_waiting"),
        F.count_if(listed & (F.col("pending") == 0)).alias("groups_finished"), F.count_if(F.col("pending") >= threshold).alias("groups_above"),
        F.count_if((F.col("pending") > 0) & (F.col("pending") < threshold)).alias("groups_below"), F.count_if(F.col("blocked_until").isNotNull()).alias("groups_blocked"),
    )
    b = items.agg(F.count("*").alias("items"), *(F.count_if(F.col("status") == s).alias(f"items_{s}") for s in ("pending", "done", "failed")))
    return a.crossJoin(b)  # one row each


def group_detail(items: DataFrame) -> DataFrame:
    return items.groupBy("grp").pivot("status", ["pending", "done", "failed"]).count().na.fill(0)


def in_progress(items: DataFrame, n: int) -> DataFrame:
    """Groups with items done and items pending, most done first."""
    rows = items.groupBy("grp").agg(F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") == "pending").alias("pending"))
    return rows.where("pending > 0 and done > 0").orderBy(F.desc("done"), "grp").limit(n)


def recent_runs(runs: DataFrame, n: int) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def runs_remaining(runs: DataFrame, items: DataFrame, n: int = 7) -> DataFrame:
    """Mean items of the last n productive runs, and how many such runs the pending items need."""
    speed = recent_runs(runs.where("items_done > 0"), n).agg(F.avg("items_done").alias("per_run"))
    left = items.agg(F.count_if(F.col("status") == "pending").alias("pending"))
    return speed.crossJoin(left).withColumn("runs_left", F.ceil(ratio(F.col("pending"), F.col("per_run"))).cast("long"))


def mark_done(items: DataFrame, output: DataFrame, key: str) -> DataFrame:
    """Known items whose key is in the output become done; adds changed."""
    have = output.select(key).distinct().withColumn("__have", F.lit(True))
    hit = F.coalesce("__have", F.lit(False)) & (F.col("status") != "done")
    return items.join(have, key, "left").withColumn("changed", hit).withColumn("status", F.when(hit, "done").otherwise(F.col("status"))).drop("__have")


def reset(items: DataFrame, failed: bool = True, blocks: bool = False) -> DataFrame:
    """Failed items pending again and blocks cleared, with what changed."""
    f = (F.col("status") == "failed") & F.lit(failed)
    b = F.col("blocked_until").isNotNull() & F.lit(blocks)
    return items.withColumns({"changed": f | b, "status": F.when(f, "pending").otherwise(F.col("status")), "blocked_until": F.when(~b, F.col("blocked_until"))})


def threshold_curve(items: DataFrame, thresholds: list[int], per_run: int = 150) -> DataFrame:
    """Per cut-off of comments: items kept, percent of all comments they hold, runs they need.  One pass:
    items are counted per comment number first."""
    c = items.groupBy(F.coalesce("comments", F.lit(0)).alias("c")).agg(F.count("*").alias("n"))
    row = lambda t: F.struct(F.lit(t).alias("threshold"), F.sum(F.when(F.col("c") >= t, F.col("n")).otherwise(0)).alias("kept"), F.sum(F.when(F.col("c") >= t, F.col("c") * F.col("n")).otherwise(0)).alias("mass"))
    rows = c.agg(F.array(*map(row, thresholds)).alias("rows"), F.sum(F.col("c") * F.col("n")).alias("all")).select(F.inline("rows"), "all")
    return rows.select("threshold", "kept", rounded(ratio(100.0 * F.col("mass"), F.col("all")), 1).alias("mass_pct"), F.ceil(F.col("kept") / per_run).cast("long").alias("runs"))
