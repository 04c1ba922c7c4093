"""Scans of landed files: JSON feeds, paged JSON lists, RSS, HTML lists and reader pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.html import html_text, page_links, page_time, page_title
from newsloom.functions.text import clean_text, normalize_url, strip
from newsloom.operators.dedupe import first_per_key
from newsloom.schemas import FEED_ITEM
from newsloom.sources.registry import collector

#: What a page says that blocks full texts.
BLOCKED = ["环境异常", "完成验证", "访问过于频繁"]


def json_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of landed JSON feeds; entries that are no objects and payloads without a list of items are dropped.

    Adds file, position and instant; an item whose date is missing or unreadable has a null instant.
    """
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    raw = F.from_json("value", "items array<string>").getField("items")
    items = text.select("file", F.posexplode(raw).alias("position", "item")).where(F.trim("item").startswith("{"))
    parsed = items.select("file", "position", F.from_json("item", FEED_ITEM).alias("i")).select("file", "position", "i.*")
    trimmed = F.regexp_replace("date_modified", r"(\.\d{6})\d+", "$1")
    return parsed.withColumn("instant", F.try_to_timestamp(trimmed))


@collector("json_feed")
def _json_feed(spark: SparkSession, spec: dict, folder: str) -> DataFrame:
    return json_feed(spark, f"{folder}/{spec['source_key']}")


def paged_list(spark: SparkSession, path: str, items: str, fields: dict[str, str], schema: str) -> DataFrame:
    """Rows of landed pages of a JSON list: ``items`` is the path of the list, ``fields`` maps columns to SQL
    expressions over an item of ``schema``. The first page that has an address wins."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("page"), "value")
    cut = pages.select("page", F.posexplode(F.from_json(F.get_json_object("value", items), f"array<{schema}>")).alias("position", "item"))
    rows = cut.select("page", "position", *(F.expr(e).alias(c) for c, e in fields.items()))
    if "url" not in fields:
        return rows
    numbered = rows.withColumn("pos", F.struct("page", "position"))
    firsts = numbered.groupBy(normalize_url(F.col("url"))).agg(F.min("pos").alias("pos")).select("pos")
    return numbered.join(firsts, "pos", "left_semi").drop("pos")


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    """title, link, description and date of landed RSS files; entries without a title are dropped."""
    schema = "title string, link string, description string, pubDate string, updated string, created string"
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    text = F.coalesce("pubDate", "updated", "created")
    return items.where("trim(title) <> ''").select(F.trim("title").alias("title"), F.trim("link").alias("url"), clean_text(F.coalesce("description", F.lit(""))).alias("summary"), text.alias("published_at"))


@collector("rss")
def _rss(spark: SparkSession, spec: dict, folder: str) -> DataFrame:
    return rss_items(spark, f"{folder}/{spec['source_key']}")


def html_pages(pages: DataFrame, selector: Column | None = None) -> DataFrame:
    """Adds title, text and instant of publication of each page (url, html), by the row's selector."""
    chosen = selector if selector is not None else F.lit(None).cast("string")
    return pages.withColumns({"title": page_title(F.col("html")), "text": clean_text(html_text(F.col("html"), chosen)), "published": page_time(F.col("html"))})


def listed_links(pages: DataFrame, pattern: str, id_col: str = "pos") -> DataFrame:
    """(id, position, url) of the article addresses on each list page, distinct and in order."""
    return pages.select(id_col, F.posexplode(page_links(F.col("html"), pattern)).alias("position", "url"))


def list_items(pages: DataFrame, row_pattern: str, least_title: int = 8, id_col: str = "pos") -> DataFrame:
    """(id, position, url, title, time) of the entries of list pages: ``row_pattern`` has groups for address, title and
    time. Short titles and entries without a time are dropped; of equal addresses the first stays."""
    groups = [F.regexp_extract_all("html", F.lit(row_pattern), F.lit(g)) for g in (1, 2, 3)]
    rows = pages.select(id_col, F.posexplode(F.arrays_zip(*(g.alias(n) for g, n in zip(groups, ("url", "title", "time"))))).alias("position", "x")).select(id_col, "position", "x.*")
    rows = rows.withColumn("title", strip(F.regexp_replace("title", "<[^>]*>", ""))).where((F.length("title") >= least_title) & (strip(F.col("time")) != ""))
    firsts = rows.groupBy(id_col, normalize_url(F.col("url")).alias("_u")).agg(F.min("position").alias("position")).drop("_u")
    return rows.join(firsts, [id_col, "position"], "left_semi")


def markdown_body(text: Column, marker: str = "Markdown Content:") -> Column:
    """Text of a reader page after the marker, image links removed."""
    after = F.when(F.contains(text, F.lit(marker)), F.substring_index(text, marker, -1)).otherwise(text)
    return clean_text(F.regexp_replace(after, r"!\[[^\]]*\]\([^)]*\)", ""))


def with_full_text(articles: DataFrame, full_texts: DataFrame, blocked: list[str] = BLOCKED) -> DataFrame:
    """Adds full_text by address, and error for those that are missing or blocked. Of several texts the longest counts."""
    texts = full_texts.where(F.col("url").isNotNull()).groupBy(normalize_url(F.col("url")).alias("_u")).agg(F.max(F.struct(F.length("text").alias("n"), "text")).alias("_t")).select("_u", F.col("_t.text").alias("full_text"))
    joined = articles.join(texts, normalize_url(articles["url"]) == F.col("_u"), "left").drop("_u")
    hit = F.lit(False)
    for b in blocked:
        hit = hit | F.contains(F.coalesce("full_text", F.lit("")), F.lit(b))
    return joined.withColumn("error", F.when(F.coalesce("full_text", F.lit("")) == "", "missing").when(hit, "blocked"))


def first_addresses(rows: DataFrame, url_col: str = "url", id_col: str = "pos") -> DataFrame:
    """Rows whose address no earlier row has."""
    return first_per_key(rows, normalize_url(F.col(url_col)), id_col)


def snapshot(expected: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows of the expected keys; a key that is not there is an error when the row is read."""
    joined = expected.select(key).distinct().join(table.withColumn("_there", F.lit(True)), key, "left")
    checked = F.when(F.col("_there"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("not there: "), F.col(key).cast("string"))))
    return joined.withColumn(key, checked.cast(joined.schema[key].dataType)).drop("_there")
