"""Runs and jobs: the latest run, missing days, and what to do next, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_run(runs: DataFrame, title: str = "title") -> DataFrame:
    """Each title's latest run: (title, status, conclusion, created_at)."""
    row = F.struct("created_at", "status", "conclusion")
    return runs.groupBy(title).agg(F.max(row).alias("_r")).select(title, "_r.status", "_r.conclusion", "_r.created_at")


def next_action(latest: DataFrame) -> DataFrame:
    """Adds action: skip active for runs that are not completed, skip done for successes, else dispatch."""
    active = F.col("status") != "completed"
    return latest.withColumn("action", F.when(active, "skip active").when(F.col("conclusion") == "success", "skip done").otherwise("dispatch"))


def oldest_missing_day(runs: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """(day): the oldest of the ``days`` days before today without a successful run; no row while any run is active or
    if none is missing. ``runs`` has day, status and conclusion."""
    every = runs.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(today, days), F.date_sub(today, 1))).alias("day"))
    done = runs.where("conclusion = 'success'").select("day").distinct()
    active = runs.where(F.col("status") != "completed").select(F.lit(None).cast("date").alias("day"), F.lit(1).alias("active"))
    missing = every.join(done, "day", "left_anti").select("day", F.lit(0).alias("active"))
    return missing.unionByName(active).agg(F.min("day").alias("day"), F.max("active").alias("active")).where("active = 0 and day is not null").select("day")


def run_title(*parts: Column) -> Column:
    """Title of a run, which is its key: its parts with · between them."""
    return F.concat_ws(" · ", *parts)


def confirmed_dispatch(wanted: DataFrame, runs: DataFrame, tries: int = 2, slack_s: int = 2) -> DataFrame:
    """(title, state, attempt) of each wanted dispatch: which of its tries the runs confirm.

    ``wanted`` has title, attempt (from 1) and dispatched_at. A run of the title that was created no earlier than
    ``slack_s`` before a try confirms it. The first confirmed try counts; then a title with further tries left is to be
    sent again (retry), one without is failed.
    """
    met = wanted.join(runs.select("title", "created_at"), "title", "left")
    seen = F.coalesce(F.unix_micros("created_at") >= F.unix_micros("dispatched_at") - slack_s * 1_000_000, F.lit(False))
    out = met.groupBy("title").agg(F.min(F.when(seen, F.col("attempt"))).alias("confirmed"), F.max("attempt").alias("last"))
    state = F.when(F.col("confirmed").isNotNull(), "confirmed").when(F.col("last") < tries, "retry").otherwise("failed")
    return out.select("title", state.alias("state"), F.coalesce("confirmed", "last").alias("attempt"))


def jobs_for(ticks: DataFrame, routes: DataFrame, at: str = "at", cron: str = "cron", zone: str = "Asia/Shanghai") -> DataFrame:
    """The jobs of each tick of the clock: the routes with its cron text, and, where a route names an hour, that hour in UTC.

    ``routes`` has cron, hour (null: any), pipeline, job, target (today, previous, or oldest missing) and is a small
    table. Adds target_day: the local day of the tick or the day before; null where the oldest missing day is asked for.
    """
    day = F.to_date(F.from_utc_timestamp(F.col(at), zone))
    target = F.when(F.col("target") == "today", day).when(F.col("target") == "previous", F.date_sub(day, 1))
    met = ticks.join(routes.withColumnRenamed("cron", "__nl_cron"), (F.col(cron) == F.col("__nl_cron")) & (F.col("hour").isNull() | (F.col("hour") == F.hour(F.col(at)))))
    return met.withColumn("target_day", target).drop("__nl_cron", "hour")


def valid_request(event: Column, days: Column, today: Column) -> Column:
    """Whether a recovery request has an event name of 8 to 80 letters, digits, _ and -, and 1 to 7 distinct dates of the last 7 days."""
    dates = F.transform(days, lambda d: F.try_to_date(d, "yyyy-MM-dd"))
    good = F.forall(dates, lambda d: F.coalesce(d.between(F.date_sub(today, 6), today), F.lit(False)))
    return event.rlike(r"^[A-Za-z0-9_-]{8,80}$") & F.size(days).between(1, 7) & (F.size(F.array_distinct(days)) == F.size(days)) & good


def expiry_warning(expiry: Column, now: Column, days: int = 30) -> Column:
    """(days_left, warn): whole days, begun ones counted, until the end of the expiry date in UTC."""
    left = F.ceil((F.unix_timestamp(F.date_add(expiry, 1).cast("timestamp")) - 1 - F.unix_timestamp(now)) / 86400)
    return F.struct(left.alias("days_left"), (left <= days).alias("warn"))
