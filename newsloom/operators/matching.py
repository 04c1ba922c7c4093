"""Matching against records already there: by two keys, by one, by differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.dedupe import last_per_key


#: Values that a null key is spread over in a join, so that blank keys do not gather in one task.
NULL_PARTS = 1024


def _no_null(df: DataFrame, key: str) -> Column:
    """The key, or for null one of ``NULL_PARTS`` values that no key has, by hash of the row."""
    able = [c for c, t in df.dtypes if "map" not in t and t != "variant"]
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("n"), F.pmod(F.xxhash64(*able), F.lit(NULL_PARTS)).cast("string")))


def two_key_match(rows: DataFrame, records: DataFrame, keys: tuple[str, str], order: str, value: str, out: str = "matched") -> DataFrame:
    """Adds ``value`` of the record that a row matches by the first key, else by the second; null if by neither.

    Of records with the same key the last by ``order`` counts. Two equi-joins rather than a join on either key. The
    side of the records has one row a key, so a key that many rows share can be split at run time. Null keys match
    nothing and are spread over many values.
    """
    joined = rows
    for i, key in enumerate(keys):
        index = last_per_key(records.where(F.col(key).isNotNull()).select(F.col(key).alias(f"__nl_k{i}"), F.col(order).alias(f"__nl_o{i}"), F.col(value).alias(f"__nl_v{i}")), [f"__nl_k{i}"], [f"__nl_o{i}"])
        index = index.withColumn(f"__nl_k{i}", F.concat(F.lit("k"), F.col(f"__nl_k{i}").cast("string")))
        joined = joined.withColumn("__nl_key", _no_null(joined, key)).join(index.drop(f"__nl_o{i}"), F.col("__nl_key") == F.col(f"__nl_k{i}"), "left").drop(f"__nl_k{i}", "__nl_key")
    return joined.withColumn(out, F.coalesce("__nl_v0", "__nl_v1")).drop("__nl_v0", "__nl_v1")


def unseen(rows: DataFrame, records: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """Rows that match no record by either key. Null keys match nothing and are spread over many values."""
    for key in keys:
        there = records.where(F.col(key).isNotNull()).select(F.concat(F.lit("k"), F.col(key).cast("string")).alias("__nl_key")).distinct()
        rows = rows.withColumn("__nl_key", _no_null(rows, key)).join(there, "__nl_key", "left_anti").drop("__nl_key")
    return rows


def backfill_split(rows: DataFrame, records: DataFrame, keys: tuple[str, str], order: str, record_id: str) -> tuple[DataFrame, DataFrame]:
    """The rows that match a record, with its id, and the records whose address is known and that no row matches."""
    matched = two_key_match(rows, records, keys, order, record_id, record_id).where(F.col(record_id).isNotNull())
    index = last_per_key(records.where(F.col(keys[0]).isNotNull()).select(keys[0], order, record_id), [keys[0]], [order])
    return matched, index.select(record_id).distinct().join(matched.select(record_id).distinct(), record_id, "left_anti")


def selected_of(batch: DataFrame, answers: DataFrame, key: str, fields: list[str], chosen: str = "selected") -> DataFrame:
    """The batch with the fields of a model's answer of the same key, and status: selected, or rejected where the answer
    is missing or did not choose the row. Of several answers of a key the last as a whole counts."""
    one = answers.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(F.coalesce(F.col(chosen), F.lit(False)).alias("__nl_chosen"), *fields)).alias("__nl_a"))
    joined = batch.join(one, key, "left")
    yes = F.coalesce(F.col("__nl_a.__nl_chosen"), F.lit(False))
    return joined.select(*batch.columns, *(F.when(yes, F.col(f"__nl_a.{f}")).alias(f) for f in fields), F.when(yes, "selected").otherwise("rejected").alias("status"))


def known_evidence(rows: DataFrame, ids: str, available: DataFrame, key: str, id_col: str) -> DataFrame:
    """(id, known): of each row's array of evidence ids those that are available, distinct and in order; rows with an
    empty array or none known have an empty one."""
    asked = rows.select(id_col, F.posexplode_outer(F.array_distinct(F.coalesce(ids, F.array().cast("array<string>")))).alias("__nl_p", key))
    there = available.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__nl_there", F.lit(True))
    met = asked.join(there, key, "left")
    kept = F.array_sort(F.collect_list(F.when(F.col("__nl_there"), F.struct("__nl_p", key))))  # as many as one row asks for
    return met.groupBy(id_col).agg(F.transform(kept, lambda x: x[key]).alias("known"))


def with_retries(current: DataFrame, retries: DataFrame, key: str) -> DataFrame:
    """The current rows and those queued for another try that are not among them."""
    return current.unionByName(retries.join(current.select(key).distinct(), key, "left_anti"))


def stale(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of ``before`` whose value after is not greater; one that is missing counts as 0."""
    b = before.groupBy(key).agg(F.max(value).alias("__nl_before"))
    a = after.groupBy(key).agg(F.max(value).alias("__nl_after"))
    return b.join(a, key, "left").where(F.coalesce("__nl_after", F.lit(0)) <= F.coalesce("__nl_before", F.lit(0))).select(key)


def missing_days(first: Column, last: Column, done: DataFrame, day: str) -> DataFrame:
    """Dates from first through last that ``done`` does not have."""
    every = done.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias(day))
    return every.join(done.select(day).distinct(), day, "left_anti")


def missing_keys(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys that are expected and not there."""
    return expected.select(key).distinct().join(actual.select(key).distinct(), key, "left_anti")


def changed_fields(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field) of each field that differs, nulls told apart; a key on one side only gives the field ''."""
    a, b = before.select(key, F.struct(*fields).alias("__nl_a")), after.select(key, F.struct(*fields).alias("__nl_b"))
    both = a.join(b, key, "full_outer")
    one_sided = F.col("__nl_a").isNull() | F.col("__nl_b").isNull()
    differing = F.array_compact(F.array(*(F.when(~F.col(f"__nl_a.{f}").eqNullSafe(F.col(f"__nl_b.{f}")), F.lit(f)) for f in fields)))
    return both.select(key, F.explode(F.when(one_sided, F.array(F.lit(""))).otherwise(differing)).alias("field"))


def upsert_plan(rows: DataFrame, records: DataFrame, keys: tuple[str, str], order: str, record_id: str, compared: dict[str, str]) -> DataFrame:
    """Adds record_id and action: insert, update or unchanged, by the record that a row matches (two_key_match).

    ``compared`` maps columns of the rows to those of the records; nulls are equal to one another and to nothing else.
    """
    found = F.struct(F.col(record_id).alias("record_id"), *(F.col(c).alias(f"r{i}") for i, c in enumerate(compared.values())))
    matched = two_key_match(rows, records.withColumn("__nl_found", found), keys, order, "__nl_found", "__nl_match")
    same = F.lit(True)
    for i, c in enumerate(compared):
        same = same & F.col(c).eqNullSafe(F.col(f"__nl_match.r{i}"))
    action = F.when(F.col("__nl_match").isNull(), "insert").when(same, "unchanged").otherwise("update")
    return matched.withColumn("record_id", F.col("__nl_match.record_id")).withColumn("action", action).drop("__nl_match")


def write_counts(rows: DataFrame, stored_keys: DataFrame, key: str) -> DataFrame:
    """(rows, inserted, duplicates) of a keyed write: new keys once each, all else duplicates, within the batch too."""
    by_key = rows.groupBy(key).agg(F.count("*").alias("__nl_n"))
    there = stored_keys.select(F.col(key).alias("__nl_k")).where("__nl_k is not null").distinct()
    met = by_key.join(there, F.col(key) == F.col("__nl_k"), "left")
    new = F.count_if(F.col(key).isNotNull() & F.col("__nl_k").isNull())
    total = F.coalesce(F.sum("__nl_n"), F.lit(0))
    return met.agg(total.alias("rows"), new.alias("inserted"), (total - new).alias("duplicates"))


def merge_keyed(table: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A keyed table after writing rows into it: the last write of each key wins."""
    return last_per_key(table.unionByName(rows), keys, order)
