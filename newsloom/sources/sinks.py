"""Sinks: rows for keyed tables, files, verification after writing, repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import epoch_ms, local_day
from newsloom.functions.text import cell_text, normalize_url
from newsloom.operators.matching import changed_fields

_NESTED = ("array", "map", "struct")


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, columns in alphabetical order."""
    return df.select(*(F.to_json(F.col(c)).alias(c) if t.startswith(_NESTED) else F.col(c) for c, t in sorted(df.dtypes)))


def write_outputs(df: DataFrame, path: str) -> None:
    """The rows as JSON lines and as CSV with a header, nested columns as JSON in the latter."""
    df.write.mode("overwrite").json(f"{path}/json")
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(f"{path}/csv")


def with_byte_mark(folder: str, out: str, spark) -> None:
    """One CSV file with a byte-order mark from the part files of ``folder``, joined by the file system, not in memory."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, target = hadoop.Path(folder), hadoop.Path(out)
    fs = source.getFileSystem(conf)
    sink = fs.create(target, True)
    try:
        sink.write(bytearray(b"\xef\xbb\xbf"))
        parts = sorted(str(s.getPath()) for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
        for i, p in enumerate(parts):
            stream = fs.open(hadoop.Path(p))
            if i:
                while stream.read() not in (10, -1):  # the header stands once
                    pass
            spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, sink, conf, False)
            stream.close()
    finally:
        sink.close()


def record_rows(articles: DataFrame, columns: list[str], content: Column, instant: Column, day: Column) -> DataFrame:
    """Rows for the record table: title of 1000 and content of 100 000 characters at most, times in milliseconds.

    ``columns`` are those that the table has; others are left out, but title and url never. Rows whose
    title or address is null or blank are an error when read.
    """
    fail = F.raise_error(F.lit("a row has no title or address"))
    title = F.when((F.trim(F.coalesce("title", F.lit(""))) != "") & (F.trim(F.coalesce("url", F.lit(""))) != ""), F.substring("title", 1, 1000)).otherwise(fail.cast("string"))
    cells = {
        "title": title, "url": F.col("url"), "source_name": F.col("source"), "published_ms": epoch_ms(instant), "daily_ms": F.unix_millis(day.cast("timestamp")),
        "content": F.substring(content, 1, 100_000), "status": F.col("record_status"),
    }
    return articles.select(*(c.alias(n) for n, c in cells.items() if n in columns or n in ("title", "url")))


def article_rows(articles: DataFrame, instant: Column) -> DataFrame:
    """The eleven columns of the delivered table, as text: title, source, address, image, time, day (that of the time where
    there is none), topics joined by 、, category, status, content and the reason of a failure."""
    r, meta = F.col("ai_result"), F.col("meta")
    text = lambda c: F.coalesce(c, F.lit(""))
    return articles.select(
        text(F.col("title")).alias("title"), text(F.col("source")).alias("source_name"), text(F.col("url")).alias("url"), text(meta["image"]).alias("image"), F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss").alias("published"),
        F.coalesce(F.col("daily_date"), F.to_date(instant)).cast("string").alias("day"), F.array_join(F.coalesce(r["topics"], F.array().cast("array<string>")), "、").alias("topics"), text(r["category"]).alias("category"),
        text(F.col("record_status")).alias("status"), text(r["core_content"]).alias("content"), text(meta["failure_reason"]).alias("failure_reason"),
    )


def signal_rows(signals: DataFrame) -> DataFrame:
    """Rows for the signal table: lists joined by 、, and the type where there is no topic."""
    joined = lambda c: F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), "、")
    return signals.select("signal_id", F.trim("title").alias("title"), "url", joined("countries").alias("countries"), F.coalesce(F.nullif(joined("topics"), F.lit("")), F.col("signal_type")).alias("topics"), "heat")


def write_batches(df: DataFrame, send, size: int = 50) -> None:
    """Sends the rows in batches of ``size`` from the executors; ``send`` takes a list of rows and may be called again
    for the same rows if a task is repeated, so it must be idempotent."""

    def each(rows) -> None:
        part = []
        for r in rows:
            part.append(r)
            if len(part) == size:
                send(part)
                part = []
        if part:
            send(part)

    df.foreachPartition(each)


def invalid_after_write(written: DataFrame, table: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys that were written and are not in the table, or differ there in one of the fields."""
    there = table.select(key, F.struct(*fields).alias("_t"))
    joined = written.select(key, F.struct(*fields).alias("_w")).join(there, key, "left")
    return joined.where(F.col("_t").isNull() | ~F.col("_t").eqNullSafe(F.col("_w"))).select(key).distinct()


def unwritten(written: DataFrame, table: DataFrame, key: str, status: str, content: str, finished: str) -> DataFrame:
    """Keys that were written and are missing, have another status, or are finished without content."""
    there = table.groupBy(F.col(key).alias("__nl_k")).agg(F.max(F.struct(F.coalesce(F.col(status), F.lit("")).alias("s"), F.coalesce(F.col(content), F.lit("")).alias("c"))).alias("__nl_t"))
    joined = written.select(key, F.coalesce(F.col(status), F.lit("")).alias("__nl_s")).join(there, F.col(key) == F.col("__nl_k"), "left")
    wrong = F.col("__nl_t").isNull() | (F.col("__nl_t.s") != F.col("__nl_s")) | ((F.col("__nl_t.s") == finished) & (F.col("__nl_t.c") == ""))
    return joined.where(wrong).select(key).distinct()


def sync(table: DataFrame, rows: DataFrame, key: str, order: str, fields: list[str], repetition: str = "repetition") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, actions, invalid): a keyed table after rows are written into it, what each row did, and the keys of written
    rows that the table does not have as they were written.

    Of rows with the same key the last by ``order`` is written. Repetitions are written only over a record that is there.
    Rows with a null key are an error of the caller and are left out.
    """
    names = [key, *fields]
    last = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(order, "status", *fields)).alias("__nl_r"))
    last = last.select(key, F.col("__nl_r.status").alias("__nl_status"), *(F.col(f"__nl_r.{f}").alias(f) for f in fields))
    there = table.select(F.col(key).alias("__nl_k"), F.struct(*fields).alias("__nl_t"))
    met = last.join(there, F.col(key) == F.col("__nl_k"), "left")
    action = F.when(F.col("__nl_k").isNull() & (F.col("__nl_status") == repetition), "left out").when(F.col("__nl_k").isNull(), "insert")
    action = action.when(F.col("__nl_t").eqNullSafe(F.struct(*fields)), "unchanged").otherwise("update")
    actions = met.withColumn("action", action).drop("__nl_k", "__nl_t", "__nl_status")
    written = actions.where("action <> 'left out'")
    after = table.select(*names).join(written.select(key), key, "left_anti").unionByName(written.select(*names))
    return after, actions, invalid_after_write(written.select(*names), after, key, fields)


def backfill_days(records: DataFrame) -> DataFrame:
    """Records with a null daily_ms filled from published_ms (start of the local day), and filled telling which."""
    day = local_day(F.timestamp_millis("published_ms"))
    start = F.unix_millis(F.to_utc_timestamp(day.cast("timestamp"), "Asia/Shanghai"))
    return records.withColumn("filled", F.col("daily_ms").isNull() & F.col("published_ms").isNotNull()).withColumn("daily_ms", F.coalesce("daily_ms", start))


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def repair_titles(records: DataFrame, titles: DataFrame) -> DataFrame:
    """Records with a blank title given the backup title, else that of the same address; repaired telling which.

    ``titles`` has url and title; of several titles of an address the least counts. The address of a record
    is that of its url_cell, which may be plain or JSON with a link.
    """
    known = titles.where(~blank(F.col("title"))).groupBy(normalize_url(F.col("url")).alias("_u")).agg(F.min("title").alias("_found"))
    address = normalize_url(F.coalesce(cell_text(F.col("url_cell")), F.col("url_cell")))
    joined = records.join(known, address == F.col("_u"), "left")
    better = F.coalesce(F.when(~blank(F.col("backup_title")), F.col("backup_title")), F.col("_found"))
    return joined.withColumn("repaired", blank(F.col("title")) & better.isNotNull()).withColumn("title", F.when(F.col("repaired"), better).otherwise(F.col("title"))).drop("_u", "_found")


def audit_migration(before: DataFrame, after: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """(key, field) of each change of another field than those allowed."""
    fields = [c for c in before.columns if c != key and c in after.columns]
    return changed_fields(before, after, key, fields).where(~F.col("field").isin(allowed))
