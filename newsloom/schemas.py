"""Schemas of the tables and checks against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

VERDICT = (
    "struct<status: string, valuable: boolean, reason: string, event_key: string, topics: array<string>, category: string, unique_points: array<string>, score_total: int, "
    "scores: struct<importance: int, information_gain: int, social_impact: int, actionability: int, evidence_density: int>, core_facts: array<string>, key_numbers: array<string>, "
    "core_content: string, summary_chars: int, invalid_ai: boolean, invalid_ai_error: string, content_safety: boolean, content_safety_error: string>"
)
ARTICLES = (
    "pos bigint, batch_no int, source string, title string, url string, published_at string, daily_date date, fetched_at timestamp, summary string, body string, author string, "
    f"meta map<string, string>, excluded_reason string, ai_result {VERDICT}, record_status string, record_id string"
)
RECORDS = "record_id string, scan_pos bigint, title string, url_cell string, source_name string, published_ms bigint, daily_ms bigint, status string, content string, backup_title string"
STAGE_CACHE = "cache_key string, stage string, stage_version string, result_json string, updated_at timestamp"
FEED_ITEM = "title string, url string, date_modified string, content_html string, image string"


def parse(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def validate_schema(df: DataFrame, expected: str | T.StructType) -> dict[str, list[str]]:
    """Columns that are missing, and those of another type (name: type that is there)."""
    want = parse(expected) if isinstance(expected, str) else expected
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in want.fields if f.name not in have]
    wrong = [f"{f.name}: {have[f.name].simpleString()}" for f in want.fields if f.name in have and have[f.name] != f.dataType]
    return {"missing": missing, "wrong": wrong}


def with_missing(df: DataFrame, expected: str | T.StructType) -> DataFrame:
    """The frame with each missing column as nulls of its type; a column of another type is an error."""
    from pyspark.sql import functions as F

    want = parse(expected) if isinstance(expected, str) else expected
    found = validate_schema(df, want)
    if found["wrong"]:
        raise TypeError(f"columns of another type: {found['wrong']}")
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in want.fields if f.name in found["missing"]}) if found["missing"] else df


def rename_with_backup(df: DataFrame, old: str, new: str) -> DataFrame:
    """Renames a column; one that has the new name already is kept under the first free name new_backup, new_backup_2, ..."""
    if old not in df.columns:
        raise KeyError(old)
    if new in df.columns and new != old:
        spare, k = f"{new}_backup", 1
        while spare in df.columns:
            k += 1
            spare = f"{new}_backup_{k}"
        df = df.withColumnRenamed(new, spare)
    return df.withColumnRenamed(old, new)
