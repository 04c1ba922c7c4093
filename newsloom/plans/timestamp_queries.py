"""Queries over the test tables for timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.operators.timestamps import normalise_timestamps


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_timestamps(spark.read.parquet(f"{sf}/articles.parquet"), spark.read.parquet(f"{sf}/source_specs.parquet"))


QUERIES = {"p3_found": p3_found}
ORACLES: dict[str, str] = {}
