"""Queries over the test tables: pN_found and reports of the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.history import HashHistory, find_covered, find_known, keys_of, known_by_batch
from newsloom.llm.main_content import find_foreign_lines
from newsloom.llm.mixing import mix, token_sizes
from newsloom.llm.repeated_lines import find_repeated_lines
from newsloom.llm.residue import find_residue
from newsloom.llm.spam import find_spam
from newsloom.llm.tokenize import encode_texts
from newsloom.session import stored


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_foreign_lines(_table(spark, sf, "articles"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_repeated_lines(_table(spark, sf, "articles"))


def _history(spark: SparkSession, sf: str, text: bool = False) -> HashHistory:
    """The hashes of all records, as they would lie there from earlier runs."""
    history, records = HashHistory(spark), _table(spark, sf, "records")
    columns = (None, None, None, "content") if text else ("url_cell", "title", "source_name")
    history.append(stored(keys_of(records, "scan_pos", *columns), "history_keys"))
    return history


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_known(_table(spark, sf, "articles"), _history(spark, sf))


def p4_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same when the twelve batches arrive one after another."""
    return known_by_batch(_table(spark, sf, "articles"), "batch_no", list(range(1, 13)), _history(spark, sf))


def p4_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each body stood in the records' contents or in bodies that arrived before it."""
    return find_covered(_table(spark, sf, "articles"), _history(spark, sf, text=True))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    articles = _table(spark, sf, "articles").select(F.lit("articles").alias("origin"), F.col("pos").cast("string").alias("row_key"), "source", F.col("body").alias("text"))
    records = _table(spark, sf, "records").select(F.lit("records").alias("origin"), F.col("record_id").alias("row_key"), F.col("source_name").alias("source"), F.col("content").alias("text"))
    return find_residue(articles.unionByName(records))


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_texts(_table(spark, sf, "documents"))


def p7_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix(token_sizes(_table(spark, sf, "documents")), _table(spark, sf, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mix(token_sizes(_table(spark, sf, "documents")), _table(spark, sf, "mix_targets"))[1]


def p7_listed_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a mixture as large as all listed sources together, for which scarce sources fall short."""
    return mix(token_sizes(_table(spark, sf, "documents")), _table(spark, sf, "mix_targets"), total_tokens="listed")[1]


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_spam(_table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p4_found": p4_found,
    "p4_batches": p4_batches,
    "p4_coverage": p4_coverage,
    "p5_found": p5_found,
    "p6_ids": p6_ids,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p7_listed_shares": p7_listed_shares,
    "p8_found": p8_found,
}
ORACLES: dict[str, str] = {}
