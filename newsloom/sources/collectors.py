"""Signals and articles from landed answers of sources: each collector takes frames of pages or payloads as they were
landed, and filters, joins and keys them; what was fetched lies in files, so nothing here touches the network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.dates import entry_instant, from_epoch, iso_instant, local_day
from newsloom.functions.html import clean_page_title, html_text, page_title
from newsloom.functions.text import bound, clean_text, excluded_title, has_any, normalize_url, signal_id, traffic_number, visible_chars
from newsloom.operators.rules import is_challenge, last_rule
from newsloom.sources.feeds import markdown_body

#: Characters of a body that counts as one, and those that are kept as evidence.
BODY_LEAST, EVIDENCE_MOST = 300, 12_000


def pages_until_end(pages: DataFrame, by: str, page: str, cursor: str | None = None, has_next: str | None = None, rows: str | None = None) -> DataFrame:
    """The landed pages of each list that a scan would have taken: up to the first that repeats a cursor of an earlier
    page or (with ``rows``) has none, which are left out, and up to and with the first that says it is the last.

    A null cursor repeats nothing. ``page`` numbers the pages of a list ``by`` from 0.
    """
    w = Window.partitionBy(by).orderBy(page)  # pages of one list, which a page limit bounds
    stop = F.lit(False)
    if cursor:
        seen = F.row_number().over(Window.partitionBy(by, cursor).orderBy(page))
        pages = pages.withColumn("__nl_seen", seen)
        stop = stop | (F.col(cursor).isNotNull() & (F.col("__nl_seen") > 1))
    if rows:
        stop = stop | (F.col(rows) == 0)
    out = pages.withColumn("__nl_stop", F.max(F.coalesce(stop, F.lit(False)).cast("int")).over(w))
    last = F.lit(0) if not has_next else F.coalesce(F.max((~F.coalesce(F.col(has_next), F.lit(False))).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return out.withColumn("__nl_over", last).where("__nl_stop = 0 and __nl_over = 0").drop("__nl_seen", "__nl_stop", "__nl_over")


def day_bounds_reached(items: DataFrame, by: list[str], instant: str, start: Column) -> DataFrame:
    """For each list (source and channel) whether its scan went beyond the day's start, and for each source whether all
    its lists did: (by..., oldest, complete, source_complete). The first of ``by`` is the source."""
    each = items.groupBy(*by).agg(F.min(instant).alias("oldest")).withColumn("complete", F.coalesce(F.col("oldest") < start, F.lit(False)))
    every = each.groupBy(by[0]).agg(F.bool_and("complete").alias("source_complete"))
    return each.join(every, by[0])


def listed_articles(items: DataFrame, title: Column, rules: list[tuple[Column, str]]) -> DataFrame:
    """Items of a list with title and excluded_reason: the word that excludes a title, overridden by the last rule that
    holds (sponsored, paid, no article, and the like)."""
    cleaned = clean_text(F.coalesce(title, F.lit("")))
    return items.withColumn("title", cleaned).withColumn("excluded_reason", last_rule([(F.coalesce(c, F.lit(False)), r) for c, r in rules], excluded_title(F.col("title"))))


def detail_bodies(articles: DataFrame, details: DataFrame, key: str, content: str, success: str, exclusions: list[tuple[Column, str]]) -> DataFrame:
    """Adds body, excluded and error from landed details: an article is in error without a detail that succeeded, excluded
    by the first rule that holds, else its body is the text of the content's markup. Of several details of a key the
    greatest as a whole counts."""
    extra = [c for c in details.columns if c not in (key,)]
    one = details.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*extra)).alias("__nl_d")).select(F.col(key).alias("__nl_k"), *(F.col(f"__nl_d.{c}").alias(c) for c in extra))
    joined = articles.join(one, articles[key] == F.col("__nl_k"), "left")
    excluded = F.coalesce(*(F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in exclusions), F.lit("")) if exclusions else F.lit("")
    there = F.coalesce(F.col(success), F.lit(False))
    joined = joined.withColumn("excluded", F.when(there, excluded).otherwise("")).withColumn("error", F.when(F.col("__nl_k").isNull(), "missing").when(~there, "failed").otherwise(""))
    text = clean_text(html_text(F.when((F.col("excluded") == "") & there, F.coalesce(F.col(content), F.lit(""))), F.lit(None).cast("string")))
    return joined.withColumn("body", F.coalesce(text, F.lit(""))).select(*articles.columns, "body", "excluded", "error")


def with_detail(rows: DataFrame, page: str, reader: str, selector: Column, wide_selector: str = "main,article,body") -> DataFrame:
    """Adds evidence, the text of a page by its selector, else of its main parts, else of the reader's page; empty if that
    has fewer than 300 visible characters or asks whether the reader is human. Adds fallback, whether the reader's page
    was needed."""
    fair = lambda c: bound(c, lambda t: F.when(~is_challenge(t) & (visible_chars(t) >= BODY_LEAST), F.substring(t, 1, EVIDENCE_MOST)))
    read = rows.withColumns({"__nl_first": html_text(F.col(page), selector), "__nl_wide": html_text(F.col(page), F.lit(wide_selector))})
    chosen = bound(clean_text(F.col("__nl_first")), lambda first: F.when(visible_chars(first) >= BODY_LEAST, first).otherwise(clean_text(F.col("__nl_wide"))))
    found = read.withColumn("__nl_own", fair(chosen)).withColumn("fallback", F.col("__nl_own").isNull())
    return found.withColumn("evidence", F.coalesce("__nl_own", fair(markdown_body(F.coalesce(reader, F.lit("")))), F.lit(""))).drop("__nl_first", "__nl_wide", "__nl_own")


def _signals(rows: DataFrame, spec: dict, key: Column, name: Column, url: Column, title: Column, instant: Column, countries: Column, confidence: str, **more: Column) -> DataFrame:
    """Rows in the form of signals."""
    cells = {
        "signal_id": signal_id(key, url, title), "source_key": F.lit(spec["source_key"]), "source_name": name, "signal_type": F.lit(spec["signal_type"]), "title": title, "url": url,
        "published_at": instant, "countries": countries, "confidence": F.lit(confidence), **more,
    }
    return rows.select(*(c.alias(n) for n, c in cells.items()))


def feed_signals(items: DataFrame, spec: dict, day: Column) -> DataFrame:
    """Signals of a feed's entries (title, link, published, updated, created, body) of one local day that have a title and
    a body; an entry without a readable time is of that day."""
    rows = items.withColumn("instant", entry_instant([F.col(c) for c in ("published", "updated", "created")], day)).withColumn("title", clean_text(F.coalesce("title", F.lit(""))))
    rows = rows.where((local_day(F.col("instant")) == day) & (F.col("title") != "") & (F.coalesce("body", F.lit("")) != ""))
    url = F.coalesce("link", F.lit(spec["url"]))
    return _signals(rows, spec, F.lit(spec["source_key"]), F.lit(spec["source_name"]), url, F.col("title"), F.col("instant"), F.array(*(F.lit(c) for c in spec["countries"])).cast("array<string>"), "high", evidence=F.col("body"))


def trend_signals(items: DataFrame, spec: dict, countries: DataFrame, day: Column, words: list[str]) -> DataFrame:
    """Signals of landed trends: one for each news item that a trend of one of the source's countries names.

    ``items`` has geo, keyword, published, item_title, item_url, item_source, traffic, body and detail_time. Entries of
    other countries and days, without an item, whose title and keyword have none of the ``words``, or without a body are
    dropped. The item's own time overrides the trend's, even if that is another day.
    """
    wanted = countries.where(F.col("country_code").isin(list(spec["countries"]))).select("country_code", "country_name", "lang", F.col("trends_geo").alias("geo"))
    rows = items.join(wanted, "geo").withColumn("instant", entry_instant([F.col("published")], day)).where(local_day(F.col("instant")) == day)
    rows = rows.withColumns({c: clean_text(F.coalesce(F.col(c), F.lit(""))) for c in ("keyword", "item_title", "item_source")})
    rows = rows.where((F.col("item_title") != "") & (F.coalesce("item_url", F.lit("")) != "") & has_any(F.lower(F.concat_ws(" ", "item_title", "keyword")), words) & (F.coalesce("body", F.lit("")) != ""))
    name = F.coalesce(F.nullif("item_source", F.lit("")), F.concat(F.lit(f"{spec['source_name']}｜"), F.col("country_name")))
    return _signals(
        rows, spec, F.concat(F.lit(f"{spec['source_key']}-"), F.col("country_code")), name, F.col("item_url"), F.col("item_title"), F.coalesce(iso_instant(F.col("detail_time")), F.col("instant")), F.array("country_code"), "high",
        original_language=F.col("lang"), original_keyword=F.col("keyword"), heat=traffic_number(F.col("traffic")), evidence=F.col("body"),
    )


def register_signals(documents: DataFrame, spec: dict, day: Column, agencies: list[str], words: list[str]) -> DataFrame:
    """Signals of a register's documents of one publication date and of some agencies, whose title or abstract has one of
    the words, and which have a body. Date and agencies are plain filters on columns, so they reach the scan."""
    rows = documents.where((F.col("publication_date") == day) & F.col("agency").isin(agencies))
    rows = rows.withColumn("title", clean_text(F.coalesce("title", F.lit("")))).where(has_any(F.lower(F.concat_ws(" ", "title", clean_text(F.coalesce("abstract", F.lit(""))))), words) & (F.coalesce("body", F.lit("")) != ""))
    url = F.coalesce("html_url", "pdf_url", F.lit(spec["url"]))
    instant = F.to_utc_timestamp(F.col("publication_date").cast("timestamp"), "Asia/Shanghai")
    return _signals(rows, spec, F.lit(spec["source_key"]), F.lit(spec["source_name"]), url, F.col("title"), instant, F.array(*(F.lit(c) for c in spec["countries"])).cast("array<string>"), "high", evidence=F.col("body"), document_number=F.col("document_number"))


def reference_signals(pages: DataFrame, specs: DataFrame, day: Column, least: int = 100) -> DataFrame:
    """One signal for each reference page (source_key, html, reader): keyed by the hash of its text, so that it is new just
    if the text is. Pages whose text, or else the reader's, has fewer than ``least`` characters have none."""
    rows = pages.join(specs.select("source_key", "source_name", F.col("url").alias("spec_url"), "signal_type", "countries", "body_selector"), "source_key")
    own = clean_text(html_text(F.col("html"), F.coalesce("body_selector", F.lit("main,article,body"))))
    rows = rows.withColumn("own", F.coalesce(own, F.lit(""))).withColumn("body", F.when(F.length("own") >= least, F.col("own")).otherwise(markdown_body(F.coalesce("reader", F.lit("")))))
    rows = rows.where(F.length("body") >= least).withColumn("content_hash", F.substring(F.sha2("body", 256), 1, 16))
    title = F.coalesce(F.nullif(page_title(F.col("html"), []), F.lit("")), F.col("source_name"))
    return rows.select(
        signal_id(F.col("source_key"), F.col("spec_url"), F.col("content_hash")).alias("signal_id"), "source_key", "signal_type", title.alias("title"), F.col("spec_url").alias("url"),
        F.to_utc_timestamp(day.cast("timestamp"), "Asia/Shanghai").alias("published_at"), "countries", F.substring("body", 1, EVIDENCE_MOST).alias("evidence"), "content_hash",
    )


def marketplace_signals(items: DataFrame, spec: dict, countries: DataFrame, day: Column) -> DataFrame:
    """Signals of a marketplace's search terms (site, keyword, url, rank) in the source's countries, one a term and country."""
    wanted = countries.where(F.col("country_code").isin(list(spec["countries"])) & F.col("marketplace_site").isNotNull()).select("country_code", "country_name", "lang", F.col("marketplace_site").alias("site"))
    rows = items.join(wanted, "site").withColumn("keyword", clean_text(F.coalesce("keyword", F.lit(""))))
    url = F.coalesce("url", F.replace(F.lit(spec["url"]), F.lit("{site}"), F.col("site")))
    return _signals(
        rows, spec, F.concat(F.lit(f"{spec['source_key']}-"), F.col("country_code")), F.concat(F.lit(f"{spec['source_name']}｜"), F.col("country_name")), url, F.col("keyword"), F.to_utc_timestamp(day.cast("timestamp"), "Asia/Shanghai"), F.array("country_code"), "high",
        original_language=F.col("lang"), original_keyword=F.col("keyword"), rank=F.col("rank").cast("string"),
    )


def resolved_titles(urls: DataFrame, api: DataFrame, readers: DataFrame, pages: DataFrame, api_ids: dict[str, str], reader_hosts: list[str]) -> DataFrame:
    """(url, title) of addresses without a title, by host: hosts in ``api_ids`` (pattern of the id in the address) by the
    landed answers of their interface (host, id, title), those in ``reader_hosts`` by the title line of the reader's page
    (url, text), all others, and where that gave nothing, by the page itself (url, html). Unresolved titles are blank."""
    host = F.regexp_replace(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    ident = F.coalesce(*(F.when(F.col("host") == h, F.nullif(F.regexp_extract("url", p, 1), F.lit(""))) for h, p in api_ids.items()), F.lit(None).cast("string"))
    rows = urls.select("url").where("url is not null").distinct().withColumn("host", host).withColumn("__nl_id", ident)
    one = lambda df, keys, c: df.groupBy(*keys).agg(F.max(c).alias(c))
    rows = rows.join(one(api, ["host", "id"], "title").withColumnsRenamed({"id": "__nl_id", "title": "__nl_api"}), ["host", "__nl_id"], "left")
    rows = rows.join(one(readers, ["url"], "text").withColumnRenamed("text", "__nl_reader"), "url", "left").join(one(pages, ["url"], "html").withColumnRenamed("html", "__nl_html"), "url", "left")
    by_api = clean_page_title(F.coalesce("__nl_api", F.lit("")))
    by_reader = F.when(F.col("host").isin(reader_hosts), clean_page_title(F.regexp_extract(F.coalesce("__nl_reader", F.lit("")), r"(?m)^Title:\s*(.+)$", 1)))
    return rows.select("url", F.coalesce(F.nullif(by_api, F.lit("")), F.nullif(by_reader, F.lit("")), page_title(F.coalesce("__nl_html", F.lit("")))).alias("title"))


def titles_from_lists(records: DataFrame, listed: DataFrame, host: str) -> DataFrame:
    """(url_key, title) of records of one host from its dated lists: only lists of days on which such a record lies are
    read (a semi join on the day, which prunes a table that is partitioned by it), and of these only the addresses asked for.

    ``records`` has url and day, ``listed`` day, url and title; of several titles of an address the last by day, then the
    greatest, counts."""
    wanted = records.where(F.col("url").isNotNull() & F.col("day").isNotNull() & F.contains("url", F.lit(f"{host}/"))).select(normalize_url(F.col("url")).alias("url_key"), "day").distinct()
    rows = listed.join(wanted.select("day").distinct(), "day", "left_semi").withColumn("title", clean_text(F.coalesce("title", F.lit("")))).where("title <> ''")
    rows = rows.withColumn("url_key", normalize_url(F.col("url"))).join(wanted.select("url_key").distinct(), "url_key", "left_semi")
    return rows.groupBy("url_key").agg(F.max(F.struct("day", "title")).alias("r")).select("url_key", F.col("r.title").alias("title"))


def record_day(daily_ms: Column, published_ms: Column) -> Column:
    """Local day of a record: of its daily date, else of its publication."""
    return local_day(F.timestamp_millis(F.coalesce(daily_ms, published_ms)))


def epoch_items(items: DataFrame, column: str) -> DataFrame:
    """Adds instant from seconds or milliseconds."""
    return items.withColumn("instant", from_epoch(F.col(column)))
