"""Main content of pages: which lines of a body are not the article's own."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.lines import BLANK, article_lines, read_body
from newsloom.llm.residue import SURE, core_of, evidence
from newsloom.session import dealt

FOUND = "pos long, line_no int"


def foreign_lines(body: str, cues: bool = True, windows: bool = True) -> list[int]:
    """Numbers, from 1 and counting blank lines, of the non-blank lines that are not the article's own.

    In a body without real content every non-blank line counts; a blank body has none. ``cues`` and
    ``windows`` are those of ``article_lines``.
    """
    lines = read_body(body)
    if evidence(core_of(lines)) >= SURE:
        return [i for i, x in enumerate(lines, 1) if x[2] != BLANK]
    return [i for i, (x, own) in enumerate(zip(lines, article_lines(lines, cues, windows)), 1) if x[2] != BLANK and not own]


def main_text(body: str) -> str:
    """The article's own lines as they came, without markup of the page around them."""
    drop = set(foreign_lines(body))
    return "\n".join(x for i, x in enumerate(body.split("\n"), 1) if i not in drop and x.strip())


def _found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = [(pos, n) for pos, body in zip(f["pos"], f["body"]) for n in foreign_lines(body)]
        yield pd.DataFrame(rows, columns=["pos", "line_no"]).astype({"pos": "int64", "line_no": "int32"})


def find_foreign_lines(rows: DataFrame, id_col: str = "pos", text_col: str = "body") -> DataFrame:
    """(id, line_no) of each non-blank line that is not part of the article, numbered from 1.

    Row by row, whole bodies, without a shuffle. Null and blank bodies and null ids give no rows; repeated
    rows give repeated results; extra columns are ignored.
    """
    texts = rows.select(F.col(id_col).cast("long").alias("pos"), F.col(text_col).alias("body")).where("pos is not null and body is not null and trim(body) <> ''")
    return dealt(texts).mapInPandas(_found, FOUND).withColumnRenamed("pos", id_col)


def _kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield pd.DataFrame({"pos": f["pos"], "main_text": [None if b is None else main_text(b) for b in f["body"]]})


def keep_main_text(rows: DataFrame, id_col: str = "pos", text_col: str = "body") -> DataFrame:
    """(id, main_text) of each row: the body with only the lines of the article itself; null for null."""
    texts = rows.select(F.col(id_col).cast("long").alias("pos"), F.col(text_col).alias("body"))
    return dealt(texts).mapInPandas(_kept, "pos long, main_text string").withColumnRenamed("pos", id_col)
