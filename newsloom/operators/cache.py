"""Cached results of stages: lookups, classes, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cache_key(url: Column, title: Column) -> Column:
    """SHA-256 of address and title, a line each; null if one is null."""
    return F.sha2(F.concat(url, F.lit("\n"), title), 256)


def last_writes(cache: DataFrame) -> DataFrame:
    """The last write of each key, stage and version; of equal times the greatest result."""
    return cache.groupBy("cache_key", "stage", "stage_version").agg(F.max(F.struct("updated_at", "result_json")).alias("__nl_w")).select("cache_key", "stage", "stage_version", "__nl_w.result_json", "__nl_w.updated_at")


def cached_results(rows: DataFrame, cache: DataFrame, key: str, version: str, schema: str = "status string, score_total int, event_key string") -> DataFrame:
    """Adds filter and summary (parsed results of the two stages of a version, null where there is none) and class.

    rejected: the filter is there and did not select; ready: it selected and the summary is there, whose fields then
    override the filter's; pending: anything else. Results that are no JSON, or have no status, count as missing.
    """
    own = last_writes(cache.where(F.col("stage_version") == version)).withColumn("__nl_r", F.from_json("result_json", schema))
    own = own.where("__nl_r.status is not null").groupBy("cache_key").agg(*(F.max(F.when(F.col("stage") == s, F.col("__nl_r"))).alias(s) for s in ("filter", "summary")))
    joined = rows.join(own, rows[key] == own["cache_key"], "left").drop(own["cache_key"])
    selected = F.coalesce(F.col("filter.status") == "selected", F.lit(False))
    state = F.when(F.col("filter").isNotNull() & ~selected, "rejected").when(selected & F.col("summary").isNotNull(), "ready").otherwise("pending")
    return joined.withColumn("class", state)


def merged(filter_: Column, summary: Column, fields: list[str]) -> Column:
    """Fields of two results in one, the summary's where it has a value."""
    return F.struct(*(F.coalesce(summary.getField(f), filter_.getField(f)).alias(f) for f in fields))


def cache_counters(classified: DataFrame) -> DataFrame:
    """One row: stages found (a rejected row has one, a ready one two), rows still to do, rows evaluated."""
    c = F.col("class")
    return classified.agg(F.coalesce(F.sum(F.when(c == "rejected", 1).when(c == "ready", 2).otherwise(0)), F.lit(0)).cast("long").alias("hits"), F.count_if(c == "pending").alias("misses"), F.count("*").alias("evaluated"))
