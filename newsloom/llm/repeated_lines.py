"""Lines that very many documents of one source share."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import dealt, stored

_DIGITS = re.compile(r"\d+")
HASHES = "id long, source string, key long, line_no int"
#: Documents of a source from which a shared line counts.
LEAST_DOCUMENTS = 8


def normal_line(line: str) -> str:
    """Unicode NFKC, lower case, no white space, each run of digits as 0."""
    if not line.isascii():
        line = unicodedata.normalize("NFKC", line)
    return _DIGITS.sub("0", "".join(line.lower().split()))


def line_key(source: str, line: str) -> int | None:
    """64-bit hash of a normalised line within its source; None for a line that is then empty."""
    text = normal_line(line)
    return xxhash.xxh3_64_intdigest(f"{source}\0{text}") - 2**63 if text else None


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for doc, source, body in zip(f["id"], f["source"], f["body"]):
            for n, line in enumerate(body.split("\n"), 1):
                key = line_key(source, line)
                if key is not None:
                    rows.append((doc, source, key, n))
        yield pd.DataFrame(rows, columns=["id", "source", "key", "line_no"]).astype({"id": "int64", "key": "int64", "line_no": "int32"})


def line_hashes(rows: DataFrame, id_col: str = "pos", source_col: str = "source", text_col: str = "body") -> DataFrame:
    """(id, source, key, line_no) of each line with text."""
    texts = rows.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), F.col(text_col).alias("body"))
    return dealt(texts.where("id is not null and body is not null and trim(body) <> ''")).mapInPandas(_hashed, HASHES)


def frequent_keys(hashes: DataFrame, least: int = LEAST_DOCUMENTS, share: float = 0.0) -> DataFrame:
    """(key, documents) of the lines in at least ``least`` documents and ``share`` of all documents of the source.

    A line that stands twice in one document counts once. Rows of one document leave the Python stage
    together, so the first distinct is combined before the shuffle, and so are the counts.
    """
    once = hashes.select("key", "source", "id").distinct()
    counts = once.groupBy("key").agg(F.count("*").alias("documents"), F.first("source").alias("source")).where(F.col("documents") >= least)
    if share:
        sizes = hashes.select("source", "id").distinct().groupBy("source").agg(F.count("*").alias("all_documents"))
        counts = counts.join(sizes, "source").where(F.col("documents") >= share * F.col("all_documents"))
    return counts.select("key", "documents")


def find_repeated_lines(rows: DataFrame, id_col: str = "pos", source_col: str = "source", text_col: str = "body", least: int = LEAST_DOCUMENTS, share: float = 0.0, salts: int = 16) -> DataFrame:
    """(id, line_no) of each line that occurs in at least ``least`` documents of the same source, and in at least
    ``share`` of all its documents that have a line with text.

    Documents are told apart by id; lines are the same if equal after ``normal_line``. Null and blank texts
    and null ids have no rows; a null source is a source of its own; repeated rows of one id count once
    and give each line once for each row; extra columns are ignored.

    A line shared by a large part of all rows is counted by partial sums and joined back in ``salts`` parts.
    """
    hashes = stored(line_hashes(rows, id_col, source_col, text_col), "lines")
    frequent = frequent_keys(hashes, least, share).select("key", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    own = hashes.select("id", "key", "line_no", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    return own.join(frequent, ["key", "salt"], "left_semi").select(F.col("id").alias(id_col), "line_no")


def _rebuilt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        texts = []
        for body, drop in zip(f["body"], f["drop"]):
            gone = set() if drop is None else set(drop)
            texts.append(None if body is None else "\n".join(x for i, x in enumerate(body.split("\n"), 1) if i not in gone))
        yield pd.DataFrame({"id": f["id"], "clean_text": texts})


def drop_repeated_lines(rows: DataFrame, id_col: str = "pos", source_col: str = "source", text_col: str = "body", least: int = LEAST_DOCUMENTS, share: float = 0.0) -> DataFrame:
    """(id, clean_text): each document rebuilt without the lines repeated within its source. Null texts stay null."""
    found = find_repeated_lines(rows, id_col, source_col, text_col, least, share).groupBy(id_col).agg(F.collect_set("line_no").alias("drop"))
    joined = rows.select(F.col(id_col), F.col(text_col).alias("body")).join(found, id_col, "left")
    return joined.select(F.col(id_col).alias("id"), "body", "drop").mapInPandas(_rebuilt, "id long, clean_text string").withColumnRenamed("id", id_col)
