"""Coverage, staleness, audits and run reports: aggregations with partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_coverage(rows: DataFrame, source: str, instant: str, start: Column, end: Column, row_limit: int | None = None) -> DataFrame:
    """For each source its rows, those within [start, end), oldest and latest, and whether the start was reached:
    the oldest is older, or with a limit fewer rows than it were there."""
    t = F.col(instant)
    out = rows.groupBy(source).agg(F.count("*").alias("scanned"), F.count_if((t >= start) & (t < end)).alias("discovered"), F.min(t).alias("oldest"), F.max(t).alias("latest"))
    done = F.coalesce(F.col("oldest") < start, F.lit(False))
    return out.withColumn("complete", done | (F.col("scanned") < row_limit) if row_limit is not None else done)


def body_outcomes(rows: DataFrame, source: str, outcome: str, least_tries: int = 1) -> DataFrame:
    """For each source the counts of ok, excluded and failed bodies, and whether all of ``least_tries`` or more failed."""
    n = lambda *o: F.count_if(F.col(outcome).isin(*o))
    out = rows.groupBy(source).agg(n("ok").alias("ok"), n("excluded").alias("excluded"), n("error", "pending").alias("failed"))
    return out.withColumn("all_failed", (F.col("failed") >= least_tries) & (F.col("ok") == 0))


def status_counts(rows: DataFrame, source: str, status: str, statuses: list[str]) -> DataFrame:
    """For each source the number of rows of each status."""
    return rows.groupBy(source).agg(*(F.count_if(F.col(status) == s).alias(s) for s in statuses))


def length_range(rows: DataFrame, chars: str) -> DataFrame:
    """Least and greatest length, zeros and nulls left aside."""
    c = F.nullif(F.col(chars), F.lit(0))
    return rows.agg(F.min(c).alias("shortest"), F.max(c).alias("longest"))


def staleness(sources: DataFrame, day: Column, today: Column) -> DataFrame:
    """One row: whether everything is stale, that is no source failed, each scanned something, none found anything,
    and the latest date of all is before the day, which is over."""
    out = sources.agg(F.bool_and("ok").alias("all_ok"), F.bool_and(F.col("scanned") > 0).alias("all_scanned"), F.sum("discovered").alias("discovered"), F.max("latest_day").alias("latest_day"))
    stale = F.col("all_ok") & F.col("all_scanned") & (F.col("discovered") == 0) & (F.col("latest_day") < day) & (day < today)
    return out.withColumn("stale", F.coalesce(stale, F.lit(False)))


def surplus(rows: DataFrame, key: Column) -> DataFrame:
    """Rows beyond the first of each key, over all keys; nulls are not counted."""
    return rows.where(key.isNotNull()).groupBy(key.alias("_k")).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("surplus"))


def table_audit(records: DataFrame, status: str, content: Column, missing: dict[str, Column], keys: dict[str, Column]) -> DataFrame:
    """(measure, value) of a keyed table: rows by status, content lengths, missing cells, rows beyond the first of each key."""
    length = F.nullif(F.length(F.coalesce(content, F.lit(""))), F.lit(0))
    by = records.groupBy(F.concat(F.lit("status "), F.coalesce(F.col(status), F.lit(""))).alias("measure")).agg(F.count("*").cast("long").alias("value"))
    one = records.agg(F.count("*").alias("rows"), F.min(length).alias("shortest"), F.max(length).alias("longest"), *(F.count_if(c).alias(f"missing {n}") for n, c in missing.items()))
    names = ["rows", "shortest", "longest", *(f"missing {n}" for n in missing)]
    flat = one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(n).cast("long").alias("value")) for n in names))))
    out = by.unionByName(flat)
    for name, key in keys.items():
        out = out.unionByName(surplus(records, key).select(F.lit(f"duplicate {name}").alias("measure"), F.col("surplus").alias("value")))
    return out


def latest(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The columns of each key's row that is last by ``order``, then by the columns themselves."""
    return rows.groupBy(key).agg(F.max(F.struct(order, *columns)).alias("_r")).select(key, *(F.col(f"_r.{c}").alias(c) for c in columns))


def run_totals(sources: DataFrame, counters: list[str], write_failed: int = 0, cached_only: bool = False) -> DataFrame:
    """One row: sums of the counters and whether the run is partial: a source failed or is incomplete, or writes failed.
    A run from the cache is partial only by failed writes."""
    out = sources.agg(*(F.sum(c).cast("long").alias(c) for c in counters), F.coalesce(F.bool_or(~F.col("complete") | F.col("all_failed")), F.lit(False)).alias("_troubled"))
    return out.withColumn("partial", F.lit(write_failed > 0) | (F.lit(False) if cached_only else F.col("_troubled"))).drop("_troubled")


def latest_or_default(rows: DataFrame, order: str, columns: dict[str, Column]) -> DataFrame:
    """One row: the columns of the last row by ``order`` (then by the columns), or the defaults of ``columns`` if there is
    no row."""
    last = rows.agg(F.max(F.struct(order, *columns)).alias("_r"))
    return last.select(*(F.when(F.col("_r").isNull(), d).otherwise(F.col(f"_r.{c}")).alias(c) for c, d in columns.items()))


def as_json(report: DataFrame, out: str = "report") -> DataFrame:
    """Each row as one JSON text, nulls left out."""
    return report.select(F.to_json(F.struct(*report.columns)).alias(out))


def write_times(rows: DataFrame, at: str) -> DataFrame:
    """One row: first and last time of writing."""
    return rows.agg(F.min(at).alias("first_write_at"), F.max(at).alias("last_write_at"))
