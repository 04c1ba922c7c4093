"""Daily windows over a stream, and a keyed table that batches of a stream are flushed into."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.dedupe import last_per_key


def daily_counts(events: DataFrame, time: str = "ts", lateness: str = "7 days", offset: str = "16 hours", by: list[str] = ()) -> DataFrame:
    """Rows of each local day (a day that starts at ``offset`` in UTC): batch and streaming frames alike.

    On a stream rows later than ``lateness`` behind the latest time seen are dropped. In append and update mode the
    state of a day goes once it is that far behind; complete mode would keep every day.
    """
    timed = events.withColumn("_t", F.col(time).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_t", lateness)
    window = F.window("_t", "1 day", "1 day", offset)
    out = timed.groupBy(window, *by).agg(F.count("*").alias("n"))
    return out.select(F.to_date(F.from_utc_timestamp(F.col("window.start"), "Asia/Shanghai")).alias("day"), *by, "n")


def flush_into(path: str, keys: list[str], order: list[str], rows_of: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes what a batch changes into a keyed table at ``path``.

    Of a batch the last row of each key by ``order`` counts, and of these the ones that are not in the table as they
    are. Each batch has its own folder, which a repeated batch overwrites; it is compared to the batches before it
    only, so it writes the same again. ``read_flushed`` gives the table. A batch that changes nothing writes no rows.
    """

    def flush(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = last_per_key(rows_of(batch), keys, order)
        before = _batches(spark, path)
        if before is not None:
            known = last_per_key(before.where(F.col("batch") < number).drop("batch"), keys, order)
            same = F.lit(True)
            for c in rows.columns:
                same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
            rows = rows.alias("a").join(known.alias("b"), same, "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return flush


def _batches(spark: SparkSession, path: str) -> DataFrame | None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(at) and any(s.isDirectory() for s in fs.listStatus(at))
    return spark.read.parquet(path) if there else None


def read_flushed(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame | None:
    """The keyed table of all batches: the last row of each key by ``order``. None if no batch has come."""
    rows = _batches(spark, path)
    return None if rows is None else last_per_key(rows.drop("batch"), keys, order)
