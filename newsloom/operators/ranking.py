"""Ranks and orders that hold when one group has a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stored


def ranked(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank", least_partitions: int = 0) -> DataFrame:
    """Adds the row's number, from 1, within its group and order, as row_number would; a group is never one task.

    Rows are range-partitioned by group and order, numbered within each part, and moved on by the sizes of
    the group's parts before, which are a few rows for each part. Rows that tie in ``order`` keep no
    defined order, so the last column of it should be unique. Nulls order as Spark orders them.
    """
    parts = least_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *(F.col(k) for k in keys), *order).withColumn("__nl_part", F.spark_partition_id())
    cut = stored(cut, "ranges")
    within = cut.withColumn("__nl_n", F.row_number().over(Window.partitionBy("__nl_part", *keys).orderBy(*order)))
    sizes = cut.groupBy("__nl_part", *keys).agg(F.count("*").alias("__nl_size"))
    before = sizes.withColumn("__nl_before", F.sum("__nl_size").over(Window.partitionBy(*keys).orderBy("__nl_part")) - F.col("__nl_size")).drop("__nl_size")
    on = within["__nl_part"] == before["__nl_part"]
    for k in keys:
        on = on & within[k].eqNullSafe(before[k])
    joined = within.join(before.select("__nl_part", *keys, "__nl_before"), on)
    return joined.select(*(within[c] for c in df.columns), (F.col("__nl_n") + F.col("__nl_before")).cast("long").alias(out))


def round_robin(df: DataFrame, day: str, source: str, order: list[Column], known: list[str], primary: str | None = None, drop_unknown: bool = False, out: str = "place") -> DataFrame:
    """Place of each row within its day: sources take turns, each with its rows in ``order``.

    ``primary`` has every second turn while it lasts; the others take turns in the order of ``known``, then
    alphabetically, or are dropped with ``drop_unknown``. Only the rank within (day, source) looks at rows;
    places follow from how many rows each source has, a small table. Rows with null day or source are dropped.
    """
    df = df.where(F.col(day).isNotNull() & F.col(source).isNotNull())
    if drop_unknown:
        df = df.where(F.col(source).isin(known))
    rank = ranked(df, [day, source], order, "__nl_rank")
    sizes = df.groupBy(F.col(day).alias("__nl_day"), F.col(source).alias("__nl_source")).agg(F.count("*").alias("__nl_size"))
    at = F.coalesce(*(F.when(F.col("__nl_source") == s, F.lit(i)) for i, s in enumerate(known)), F.lit(len(known)))
    is_primary = (F.col("__nl_source") == primary) if primary is not None else F.lit(False)
    turns = sizes.withColumn("__nl_key", F.struct(at.alias("at"), F.col("__nl_source").alias("name"))).withColumn("__nl_primary", is_primary)
    # sources of a day, as one small array: bounded by the number of sources, not of rows
    days = turns.groupBy("__nl_day").agg(F.collect_list(F.struct("__nl_key", "__nl_size", "__nl_primary")).alias("__nl_turns"))
    joined = rank.join(days, rank[day] == days["__nl_day"]).join(turns.select(F.col("__nl_day").alias("__nl_d"), "__nl_source", "__nl_key", "__nl_primary"), (rank[day] == F.col("__nl_d")) & (rank[source] == F.col("__nl_source")))
    others = F.filter("__nl_turns", lambda t: ~t["__nl_primary"])
    r, key = F.col("__nl_rank"), F.col("__nl_key")
    full = F.aggregate(others, F.lit(0).cast("long"), lambda acc, t: acc + F.least(t["__nl_size"], r - 1))
    ahead = F.aggregate(others, F.lit(0).cast("long"), lambda acc, t: acc + F.when((t["__nl_size"] >= r) & (t["__nl_key"] < key), 1).otherwise(0))
    other_place = full + ahead + 1
    n_primary = F.aggregate(F.filter("__nl_turns", lambda t: t["__nl_primary"]), F.lit(0).cast("long"), lambda acc, t: acc + t["__nl_size"])
    n_other = F.aggregate(others, F.lit(0).cast("long"), lambda acc, t: acc + t["__nl_size"])
    place = F.when(F.col("__nl_primary"), r + F.least(r - 1, n_other)).otherwise(other_place + F.least(other_place, n_primary))
    return joined.select(*(rank[c] for c in df.columns), place.alias(out))


def batches(df: DataFrame, order: list[Column], size: int, out: str = "batch") -> DataFrame:
    """Adds the number, from 0, of the batch of ``size`` rows that a row falls into by ``order``."""
    one = ranked(df.withColumn("__nl_all", F.lit(0)), ["__nl_all"], order, "__nl_place")
    return one.withColumn(out, F.floor((F.col("__nl_place") - 1) / size)).drop("__nl_all", "__nl_place")
