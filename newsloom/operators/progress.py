"""Where a job stands: manifests, points to take it up again, completion, and when to flush."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.dedupe import last_per_key
from newsloom.operators.ranking import ranked


def manifests(rows: DataFrame, job: str, key: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows with their place in their job, from 0, and (job, manifest, rows) of each job.

    A manifest is a hash of all keys in their order: it is the same just if the same keys stand in the same places.
    It is an aggregation of hashes of place and key, so a job of any size is never gathered.
    """
    placed = ranked(rows, [job], order, "__nl_place").withColumn("place", F.col("__nl_place") - 1).drop("__nl_place")
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "place", key)) for seed in (1, 2)]
    found = placed.groupBy(job).agg(F.concat_ws("-", *(F.hex(m) for m in marks)).alias("manifest"), F.count("*").alias("rows"))
    return placed, found


def resume(placed: DataFrame, found: DataFrame, progress: DataFrame, job: str) -> DataFrame:
    """The placed rows with ``replayed``: whether an earlier run of the same manifest was past them.

    ``progress`` has job, manifest, next_index and updated_at; the last write of a job counts. Another manifest, an
    index outside the job, or no progress at all means to start from the first row.
    """
    last = last_per_key(progress.select(job, "updated_at", F.col("manifest").alias("__nl_m"), F.col("next_index").alias("__nl_n")), [job], ["updated_at"])
    start = found.join(last.drop("updated_at"), job, "left")
    valid = (F.col("manifest") == F.col("__nl_m")) & F.col("__nl_n").between(0, F.col("rows"))
    start = start.select(F.col(job).alias("__nl_job"), F.when(valid, F.col("__nl_n")).otherwise(0).alias("__nl_start"))
    joined = placed.join(start, placed[job].eqNullSafe(F.col("__nl_job")), "left")
    return joined.withColumn("replayed", F.col("place") < F.coalesce("__nl_start", F.lit(0))).drop("__nl_job", "__nl_start")


def complete(progress: DataFrame, completions: DataFrame, done: DataFrame, job: str) -> tuple[DataFrame, DataFrame]:
    """(progress, completions) once the jobs in ``done`` (job, completed_at) are over: their progress goes, and each has
    one completion, the latest. Jobs are told apart by their key; a job that is completed again changes only the time."""
    left = progress.join(done.select(job).distinct(), job, "left_anti")
    every = completions.select(job, "completed_at").unionByName(done.select(job, "completed_at"))
    return left, every.groupBy(job).agg(F.max("completed_at").alias("completed_at"))


def incomplete(jobs: DataFrame, completions: DataFrame, job: str) -> DataFrame:
    """The jobs without a completion."""
    return jobs.join(completions.select(job).distinct(), job, "left_anti")


def next_flush(planned: Column, now: Column, interval_s: int) -> Column:
    """When to flush next: a flush that is due is followed by the first planned time after now, so that the rhythm is kept
    however late it was; one that is not due stays."""
    late = F.unix_micros(now) - F.unix_micros(planned)
    step = F.lit(interval_s * 1_000_000)
    return F.when(late >= 0, F.timestamp_micros(F.unix_micros(planned) + (F.floor(late / step) + 1) * step)).otherwise(planned)


def flush_due(planned: Column, now: Column, new_rows: Column) -> Column:
    """Whether to flush: the time has come and there is something new."""
    return (now >= planned) & (new_rows > 0)
