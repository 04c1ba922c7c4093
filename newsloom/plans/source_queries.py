"""Queries that collect from landed answers of sources, made of the test tables, each with SQL over the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import day_bounds, entry_instant, iso_instant
from newsloom.functions.html import page_time, page_title
from newsloom.operators.matching import missing_keys
from newsloom.plans import article_queries as A
from newsloom.plans import sql as S
from newsloom.session import dealt, new_path
from newsloom.sources.collectors import day_bounds_reached, detail_bodies, feed_signals, listed_articles, marketplace_signals, pages_until_end, record_day, reference_signals, register_signals, resolved_titles, titles_from_lists, trend_signals, with_detail
from newsloom.sources.feeds import json_feed, list_items, markdown_body, snapshot, with_full_text
from newsloom.sources.registry import collect_all, collector, source_states

#: Parameters of the queries over the test tables.
DAY = "2026-01-05"
WORDS = ["coffee", "solar", "咖啡", "储", "trade", "kids", "price"]
SPEC = {"source_key": "trends", "source_name": "Trends", "signal_type": "demand", "url": "https://trends.example/{site}", "countries": ["us", "mx", "br", "de"]}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _day():
    return F.lit(DAY).cast("date")


def _signals(spark, sf):
    """Signals as a source would land them: one row for each text, the day of each moved to DAY or the day after."""
    s = _t(spark, sf, "signals").select("signal_id", "title", "url", "countries", "original_keyword", "evidence", "source_name", F.element_at("meta", "rank").alias("rank"), F.coalesce("heat", F.lit(0.0)).alias("heat"))
    return s.groupBy("signal_id", "title", "url", "countries", "original_keyword", "evidence", "source_name", "rank").agg(F.max("heat").alias("heat"))


def trend_rows(spark, sf):
    s = _signals(spark, sf)
    late = F.pmod(F.length("title"), F.lit(4)) == 0
    items = s.select(
        F.upper(F.coalesce(F.get("countries", 0), F.lit("us"))).alias("geo"), F.col("original_keyword").alias("keyword"), F.when(late, "Tue, 06 Jan 2026 20:00:00 +0800").otherwise("Mon, 05 Jan 2026 08:00:00 +0000").alias("published"),
        F.col("title").alias("item_title"), F.col("url").alias("item_url"), F.when(F.length("title") % 2 == 0, F.col("source_name")).alias("item_source"), F.concat(F.format_number("heat", 0), F.lit("+")).alias("traffic"),
        F.when(F.length("title") % 5 > 0, F.col("evidence")).alias("body"), F.when(F.length("title") % 3 == 0, "2026-01-04T10:00:00Z").alias("detail_time"),
    )
    got = trend_signals(items, SPEC, _t(spark, sf, "countries"), _day(), WORDS)
    return got.select("signal_id", "source_name", "title", F.unix_micros("published_at").alias("published_us"), F.col("countries")[0].alias("country"), "original_language", "heat")


def register_rows(spark, sf):
    s = _signals(spark, sf)
    documents = s.select(
        F.when(F.length("title") % 3 == 0, F.lit("2026-01-04")).otherwise(F.lit(DAY)).cast("date").alias("publication_date"), F.element_at(F.array(F.lit("customs"), F.lit("safety"), F.lit("parks")), (F.length("title") % 3 + 1).cast("int")).alias("agency"),
        "title", F.col("evidence").alias("abstract"), F.when(F.length("title") % 2 == 0, F.col("url")).alias("html_url"), F.concat("url", F.lit(".pdf")).alias("pdf_url"), F.col("signal_id").alias("document_number"), F.col("evidence").alias("body"),
    )
    got = register_signals(documents, {**SPEC, "source_key": "register"}, _day(), ["customs", "safety"], WORDS)
    return got.select("signal_id", "title", "url", F.unix_micros("published_at").alias("published_us"), "document_number")


def marketplace_rows(spark, sf):
    s = _signals(spark, sf)
    items = s.select(F.element_at(F.array(F.lit("MMXX"), F.lit("MBRX"), F.lit("MZZZ")), (F.length("title") % 3 + 1).cast("int")).alias("site"), F.col("original_keyword").alias("keyword"), F.when(F.length("title") % 2 == 0, F.col("url")).alias("url"), "rank")
    got = marketplace_signals(items, {**SPEC, "source_key": "market"}, _t(spark, sf, "countries"), _day())
    return got.select("signal_id", "source_name", "title", "url", F.col("countries")[0].alias("country"), "rank")


def feed_rows(spark, sf):
    s = _signals(spark, sf)
    items = s.select(
        "title", F.col("url").alias("link"), F.when(F.length("title") % 3 == 0, "Mon, 05 Jan 2026 20:00:00 GMT").when(F.length("title") % 3 == 1, "soon").alias("published"), F.when(F.length("title") % 2 == 0, "2026-01-05T10:00:00.1234567Z").alias("updated"),
        F.lit(None).cast("string").alias("created"), F.when(F.length("title") % 7 > 0, F.col("evidence")).alias("body"),
    )
    got = feed_signals(items, {**SPEC, "source_key": "feed"}, _day())
    return got.select("signal_id", "title", F.unix_micros("published_at").alias("published_us"), F.size("countries").alias("countries"))


def reference_rows(spark, sf):
    """Pages of the sources: long text, short text with a reader's page, or neither."""
    specs = _t(spark, sf, "source_specs")
    n = F.length("source_key")
    body = F.repeat(F.concat(F.lit("Reference text of "), F.col("source_key"), F.lit(". ")), F.when(n % 3 == 0, 20).otherwise(1))
    html = F.concat(F.lit("<html><head><title>"), F.col("source_name"), F.lit(" data</title></head><body><nav>menu</nav><article class='post-body' id='main'>"), body, F.lit("</article></body></html>"))
    reader = F.when(n % 3 == 1, F.concat(F.lit("Title: x\nMarkdown Content:\n"), F.repeat(F.concat(F.lit("Reader text of "), F.col("source_key"), F.lit(". ")), 9)))
    got = reference_signals(specs.select("source_key", html.alias("html"), reader.alias("reader")), specs, _day())
    return got.select("source_key", "signal_id", "title", "content_hash", F.length("evidence").alias("chars"))


# Lists, details and pages of articles


def scanned_pages(spark, sf):
    """Pages of 20 articles of each source; every fifth page repeats the cursor of the one before, and page 30 is the last."""
    rows = _t(spark, sf, "articles").where("source is not null").select("source", "pos")
    numbered = A.ranked(rows, ["source"], [F.asc("pos")])
    pages = numbered.groupBy("source", F.floor((F.col("rank") - 1) / 20).alias("page")).agg(F.count("*").alias("items"))
    cursor = F.when(F.col("page") % 5 == 4, F.col("page") - 1).otherwise(F.col("page"))
    cursor = F.when(F.length("source") % 2 == 0, F.col("page")).otherwise(cursor)
    return pages_until_end(pages.withColumns({"cursor": cursor, "more": F.col("page") < 2 + F.length("source") % 4}), "source", "page", "cursor", "more", "items").select("source", "page", "items")


def listed_reasons(spark, sf):
    """Rules of a list: sponsored, then paid, the last that holds overriding the title's word."""
    rows = _t(spark, sf, "articles").select("pos", F.col("title").alias("raw"), "author", "url")
    got = listed_articles(rows, F.col("raw"), [(F.col("pos") % 7 == 0, "sponsored"), (F.col("url") == "", "no article"), (F.col("pos") % 11 == 0, "paid")])
    return got.select("pos", "excluded_reason")


def detail_rows(spark, sf):
    rows = _t(spark, sf, "articles").select("pos", F.element_at("meta", "id").alias("id"))
    details = _t(spark, sf, "articles").where("pos % 10 <> 0").select(F.element_at("meta", "id").alias("id"), F.concat(F.lit("<p>"), F.col("title"), F.lit("</p><script>x()</script>")).alias("content"), (F.col("pos") % 9 != 0).alias("success"), (F.col("pos") % 8 == 0).alias("video"), (F.col("pos") % 6 == 0).alias("vip"))
    return detail_bodies(dealt(rows), details, "id", "content", "success", [(F.col("video"), "video"), (F.col("vip"), "not public")])


def channel_coverage(spark, sf):
    start, _ = day_bounds(F.lit("2024-03-01").cast("date"))
    rows = _t(spark, sf, "articles").where("source is not null").withColumn("channel", F.coalesce(F.element_at("meta", "channel"), F.lit("")))
    return day_bounds_reached(rows, ["source", "channel"], "fetched_at", start).select("source", "channel", F.unix_micros("oldest").alias("oldest_us"), "complete", "source_complete")


def _pages(spark, sf):
    a = _t(spark, sf, "articles").where("title is not null and not contains(title, '<') and not contains(title, '&') and not contains(title, '\"')")
    stamp = F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss")
    n = F.col("pos") % 4
    time = F.when(n == 0, F.concat(F.lit('<i data-article-publish-time="'), F.unix_seconds("fetched_at").cast("string"), F.lit('"></i>')))
    time = time.when(n == 1, F.concat(F.lit('<meta property="article:published_time" content="'), stamp, F.lit('Z">'))).when(n == 2, F.concat(F.lit('<script>{"datePublished": "'), stamp, F.lit('+00:00"}</script>')))
    time = time.otherwise(F.concat(F.date_format("fetched_at", "yyyy年M月d日"), F.lit(" "), F.date_format("fetched_at", "H:mm")))
    head = F.when(n < 2, F.concat(F.lit('<meta property="og:title" content="'), F.col("title"), F.lit('">'))).otherwise(F.lit('<meta name="title" content="404">'))
    return a.select("pos", "url", "title", F.concat(F.lit("<html><head>"), head, F.lit("<title>"), F.col("title"), F.lit(" | 少数派 - more</title></head><body>"), time, F.lit("</body></html>")).alias("html"))


def page_details(spark, sf):
    return dealt(_pages(spark, sf)).select("pos", page_title(F.col("html")).alias("title"), F.unix_micros(page_time(F.col("html"))).alias("published_us"))


def resolved_rows(spark, sf):
    """Titles by host: two hosts by their interface, one by the reader's page, the others by the page."""
    pages = _pages(spark, sf).where("trim(url) <> ''")
    host = F.regexp_replace(F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]*)", 1)), r"^www\.", "")
    ident = F.regexp_extract("url", r"/([A-Za-z0-9]+)(?:\.html)?$", 1)
    api = pages.where(host.isin("lantern.example", "harborwire.example")).where("pos % 5 > 0").select(host.alias("host"), ident.alias("id"), F.concat(F.lit("api "), F.col("title")).alias("title"))
    readers = pages.where(host == "kiosk.example").where("pos % 2 = 0").select("url", F.concat(F.lit("Title: reader "), F.col("title"), F.lit("\nURL: x")).alias("text"))
    got = resolved_titles(pages, api, readers, pages.select("url", "html"), {"lantern.example": r"/([A-Za-z0-9]+)(?:\.html)?$", "harborwire.example": r"/([A-Za-z0-9]+)(?:\.html)?$"}, ["kiosk.example"])
    return got


def listed_titles(spark, sf):
    """Titles of records from the dated lists of their days."""
    records = A._keyed_records(spark, sf).select(F.col("link").alias("url"), record_day(F.col("daily_ms"), F.col("published_ms")).alias("day"))
    listed = A._keyed_records(spark, sf).where("published_ms is not null and link is not null").select(F.to_date(F.timestamp_millis("published_ms")).alias("day"), F.col("link").alias("url"), "title")
    return titles_from_lists(records, listed, "haijiao.example")


def listed_items(spark, sf):
    a = _t(spark, sf, "articles").where("title is not null and url is not null and not contains(title, '<') and not contains(url, '\"')")
    row = F.concat(F.lit('<li><a class="t" href="'), F.col("url"), F.lit('"><b>'), F.col("title"), F.lit("</b></a><time>"), F.when(F.col("pos") % 3 > 0, F.date_format("fetched_at", "yyyy-MM-dd")).otherwise(F.lit("")), F.lit("</time></li>"))
    pages = a.select("pos", F.concat(F.lit("<ul>"), row, row, F.lit("</ul>")).alias("html"))
    return list_items(pages, r'<li><a class="t" href="([^"]*)">(.*?)</a><time>([^<]*)</time></li>').select("pos", "url", "title", "time")


def markdown_bodies(spark, sf):
    text = F.concat(F.lit("Title: x\nMarkdown Content:\n![a](https://img.example/1.png)"), F.col("body"))
    return dealt(_t(spark, sf, "articles").where("body is not null and not contains(body, 'Markdown Content:')").select("pos", "body")).select("pos", F.sha2(markdown_body(text), 256).alias("body"))


def detail_texts(spark, sf):
    """Bodies of pages, with a reader's page for those that are too short."""
    n = F.col("pos") % 3
    html = F.concat(F.lit("<html><body><main>"), F.when(n > 0, F.repeat(F.lit("A sentence of the page. "), 20)).otherwise(F.lit("short")), F.lit("</main><footer>f</footer></body></html>"))
    reader = F.when(n == 0, F.concat(F.lit("Markdown Content:\n"), F.when(F.col("pos") % 2 == 0, F.repeat(F.lit("The reader's text. "), 30)).otherwise(F.repeat(F.lit("Captcha please. "), 40))))
    pages = dealt(_t(spark, sf, "articles").select("pos")).select("pos", html.alias("html"), reader.alias("reader"))
    return with_detail(pages, "html", "reader", F.lit("article.none")).select("pos", F.length("evidence").alias("chars"), "fallback")


def feed_items(spark, sf):
    """A JSON feed for each source, landed as files and read again; entries that are no objects are in between."""
    a = _t(spark, sf, "articles").where("source is not null")
    item = F.to_json(F.struct("title", "url", F.concat(F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("pos") % 9 == 0, F.lit(" soon")).otherwise(F.lit(".1234567Z"))).alias("date_modified"), F.col("pos").cast("string").alias("image")))
    feeds = a.groupBy("source", F.floor(F.col("pos") / 500).alias("k")).agg(F.array_join(F.array_sort(F.collect_list(item)), ",").alias("items"))  # at most 500 entries, the limit of a feed
    landed = new_path(spark, "feeds")
    feeds.select(F.concat(F.lit('{"items": [5, '), F.col("items"), F.lit(', "text"]}')).alias("value")).repartition("value").write.option("maxRecordsPerFile", 1).text(landed)
    return json_feed(spark, landed).select(F.col("image").cast("long").alias("pos"), "title", F.unix_micros("instant").alias("published_us"))


def full_texts(spark, sf):
    a = _t(spark, sf, "articles").where("url is not null and trim(url) <> ''")
    texts = a.where("pos % 4 > 0").select("url", F.when(F.col("pos") % 5 == 0, F.lit("当前环境异常，完成验证后即可继续访问")).otherwise(F.lit("text")).alias("text"))
    return with_full_text(a.select("pos", "url"), texts).select("pos", "full_text", "error")


def written_instants(spark, sf):
    """Times as feeds write them: with seven digits of a second, with an offset, and without a zone."""
    r = _t(spark, sf, "records").where("published_ms is not null")
    t = F.timestamp_millis("published_ms")
    n = F.col("scan_pos") % 4
    local = F.from_utc_timestamp(t, "Asia/Shanghai")
    text = F.when(n == 0, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("7Z"))).when(n == 1, F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("+0800"))).when(n == 2, F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS")).otherwise(F.lit("yesterday"))
    return r.select("record_id", F.unix_micros(iso_instant(text)).alias("us"), F.unix_micros(entry_instant([text], F.lit(DAY).cast("date"))).alias("entry_us"))


def nation_snapshot(spark, sf):
    expected = _t(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    return snapshot(expected, _t(spark, sf, "nation"), "n_nationkey").select("n_nationkey", "n_name")


def lost_nations(spark, sf):
    """Nations that no supplier is from."""
    return missing_keys(_t(spark, sf, "nation"), _t(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey")), "n_nationkey")


@collector("landed_articles")
def _landed_articles(spark: SparkSession, spec: dict, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/articles.parquet").where(F.col("source") == spec["source_name"]).select("pos", "title")


def source_runs(spark, sf):
    """All sources of the list: html ones are collected, those of kind rss have no landing folder, api ones lack a secret."""
    specs = []
    for r in _t(spark, sf, "source_specs").collect():  # a fixed table of 30 rows
        spec = {k: r[k] for k in ("source_key", "source_name", "is_optional")}
        specs.append(spec | {"kind": "landed_articles" if r["kind"] == "html" else "unknown" if r["kind"] == "rss" else "landed_articles", "auth_env": "TOKEN" if r["kind"] == "api" else None, "is_optional": True})
    rows, states = collect_all(spark, specs, sf)
    return source_states(states, rows).select("source_key", "state", "rows")


_S = f"SELECT *, {S.clean('title')} AS ct, {S.clean('evidence')} AS ce, {S.clean_of('coalesce(original_keyword, chr(32))')} AS ck FROM (SELECT signal_id, title, url, countries, original_keyword, evidence, source_name, meta['rank'] AS rank, max(coalesce(heat, 0)) AS heat, length(title) AS n FROM signals GROUP BY ALL)"
_ID = lambda key, url, title: f"sha256({key} || '|' || lower({S.strip(url)}) || '|' || lower({S.clean(title)}))[1:32]"
_HAS = lambda text: f"len(list_filter({S.words(WORDS)}, lambda w: contains(lower({text}), w))) > 0"
_OF_DAY = "epoch_us(TIMESTAMP '2026-01-04 16:00:00')"
_PAGES = "SELECT *, pos % 4 AS n FROM articles WHERE title IS NOT NULL AND NOT contains(title, '<') AND NOT contains(title, '&') AND NOT contains(title, '\"')"
_TITLE = f"string_split({S.clean('title')}, chr(10))[1]"
_T = "coalesce(title, '')"
_HOST = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\\.', '')"

ORACLES: dict[str, str] = {
    "trend_rows": f"""SELECT {_ID("'trends-' || country_code", 'url', 'title')} AS signal_id, CASE WHEN n % 2 = 0 AND {S.clean("coalesce(source_name, '')")} <> '' THEN {S.clean('source_name')} ELSE 'Trends｜' || country_name END AS source_name, {S.clean('title')} AS title, CASE WHEN n % 3 = 0 THEN epoch_us(TIMESTAMP '2026-01-04 10:00:00') ELSE epoch_us(TIMESTAMP '2026-01-05 08:00:00') END AS published_us, country_code AS country, lang AS original_language, CAST(round(heat) AS DOUBLE) AS heat
FROM ({_S}) s JOIN countries c ON c.trends_geo = upper(coalesce(s.countries[1], 'us')) WHERE country_code IN ('us', 'mx', 'br', 'de') AND n % 4 <> 0 AND n % 5 > 0 AND coalesce(evidence, '') <> '' AND {S.clean("coalesce(title, '')")} <> '' AND coalesce(url, '') <> '' AND {_HAS("concat_ws(' ', ct, ck)")}""",
    "register_rows": f"""SELECT {_ID("'register'", 'u', 'title')} AS signal_id, {S.clean('title')} AS title, u AS url, {_OF_DAY} AS published_us, signal_id AS document_number FROM (SELECT *, CASE WHEN n % 2 = 0 THEN coalesce(url, url || '.pdf') ELSE url || '.pdf' END AS u FROM ({_S})) WHERE n % 3 = 1 AND coalesce(evidence, '') <> '' AND {_HAS("concat_ws(' ', ct, ce)")}""",
    "marketplace_rows": f"""SELECT {_ID("'market-' || country_code", 'u', 'k')} AS signal_id, 'Trends｜' || country_name AS source_name, {S.clean('k')} AS title, u AS url, country_code AS country, rank FROM (SELECT *, coalesce(original_keyword, '') AS k, CASE WHEN n % 2 = 0 THEN coalesce(url, 'https://trends.example/' || marketplace_site) ELSE 'https://trends.example/' || marketplace_site END AS u FROM ({_S}) s JOIN countries c ON c.marketplace_site = ['MMXX', 'MBRX', 'MZZZ'][s.n % 3 + 1] WHERE country_code IN ('us', 'mx', 'br', 'de'))""",
    "feed_rows": f"""SELECT {_ID("'feed'", "coalesce(url, 'https://trends.example/{site}')", 'title')} AS signal_id, {S.clean('title')} AS title, CASE WHEN n % 2 = 0 THEN epoch_us(TIMESTAMP '2026-01-05 10:00:00.123456') ELSE {_OF_DAY} END AS published_us, 4 AS countries FROM ({_S}) WHERE n % 3 <> 0 AND n % 7 > 0 AND coalesce(evidence, '') <> '' AND {S.clean("coalesce(title, '')")} <> ''""",
    "reference_rows": """WITH r AS (SELECT source_key, source_name, url, CASE length(source_key) % 3 WHEN 0 THEN rtrim(repeat('Reference text of ' || source_key || '. ', 20)) ELSE rtrim(repeat('Reader text of ' || source_key || '. ', 9)) END AS body FROM source_specs WHERE length(source_key) % 3 < 2), h AS (SELECT *, sha256(body)[1:16] AS content_hash FROM r)
SELECT source_key, sha256(source_key || '|' || lower(url) || '|' || content_hash)[1:32] AS signal_id, source_name || ' data' AS title, content_hash, length(body) AS chars FROM h""",
    "scanned_pages": """WITH p AS (SELECT source, (rn - 1) // 20 AS page, count(*) AS items FROM (SELECT source, row_number() OVER (PARTITION BY source ORDER BY pos) AS rn FROM articles WHERE source IS NOT NULL) GROUP BY 1, 2)
SELECT source, page, items FROM p WHERE page <= 2 + length(source) % 4 AND (length(source) % 2 = 0 OR page < 4)""",
    "listed_reasons": f"SELECT pos, CASE WHEN pos % 11 = 0 THEN 'paid' WHEN url = '' THEN 'no article' WHEN pos % 7 = 0 THEN 'sponsored' ELSE coalesce(list_filter({S.words(A.TITLE_EXCLUSIONS)}, lambda w: contains(replace(t, ' ', ''), w))[1], '') END AS excluded_reason FROM (SELECT pos, url, {S.clean(_T)} AS t FROM articles)",
    "detail_rows": f"SELECT pos, meta['id'] AS id, CASE WHEN pos % 10 <> 0 AND pos % 9 <> 0 AND pos % 8 <> 0 AND pos % 6 <> 0 THEN {S.clean(_T)} ELSE '' END AS body, CASE WHEN pos % 10 = 0 OR pos % 9 = 0 THEN '' WHEN pos % 8 = 0 THEN 'video' WHEN pos % 6 = 0 THEN 'not public' ELSE '' END AS excluded, CASE WHEN pos % 10 = 0 THEN 'missing' WHEN pos % 9 = 0 THEN 'failed' ELSE '' END AS error FROM articles",
    "channel_coverage": "WITH c AS (SELECT source, coalesce(meta['channel'], '') AS channel, epoch_us(min(fetched_at)) AS oldest_us FROM articles WHERE source IS NOT NULL GROUP BY 1, 2) SELECT source, channel, oldest_us, coalesce(oldest_us < epoch_us(TIMESTAMP '2024-02-29 16:00:00'), false) AS complete, bool_and(coalesce(oldest_us < epoch_us(TIMESTAMP '2024-02-29 16:00:00'), false)) OVER (PARTITION BY source) AS source_complete FROM c",
    "page_details": f"SELECT pos, coalesce({_TITLE}, '') AS title, CASE WHEN n = 3 THEN epoch_us(date_trunc('minute', {S.utc('fetched_at')})) - 28800000000 ELSE epoch_us(date_trunc('second', {S.utc('fetched_at')})) END AS published_us FROM ({_PAGES})",
    "listed_titles": f"""WITH w AS (SELECT DISTINCT {S.url_key('link')} AS k, CAST(make_timestamp(coalesce(daily_ms, published_ms) * 1000) + INTERVAL 8 HOUR AS DATE) AS day FROM ({A.R_KEYS}) WHERE link IS NOT NULL AND coalesce(daily_ms, published_ms) IS NOT NULL AND contains(link, 'haijiao.example/')),
l AS (SELECT CAST(make_timestamp(published_ms * 1000) AS DATE) AS day, {S.url_key('link')} AS k, {S.clean(_T)} AS title FROM ({A.R_KEYS}) WHERE published_ms IS NOT NULL AND link IS NOT NULL)
SELECT k AS url_key, arg_max(title, struct_pack(d := day, t := title)) AS title FROM l WHERE title <> '' AND day IN (SELECT day FROM w) AND k IN (SELECT k FROM w) GROUP BY k""",
    "listed_items": f"SELECT pos, url, {S.strip('title')} AS title, strftime(make_timestamp(epoch_us(fetched_at)), '%Y-%m-%d') AS time FROM articles WHERE title IS NOT NULL AND url IS NOT NULL AND NOT contains(title, '<') AND NOT contains(url, '\"') AND pos % 3 > 0 AND length({S.strip('title')}) >= 8",
    "markdown_bodies": f"SELECT pos, sha256({S.clean('body')}) AS body FROM articles WHERE body IS NOT NULL AND NOT contains(body, 'Markdown Content:')",
    "detail_texts": "SELECT pos, CASE WHEN pos % 3 > 0 THEN length(rtrim(repeat('A sentence of the page. ', 20))) WHEN pos % 2 = 0 THEN length(rtrim(repeat('The reader''s text. ', 30))) ELSE 0 END AS chars, pos % 3 = 0 AS fallback FROM articles",
    "feed_items": f"SELECT pos, title, CASE WHEN pos % 9 <> 0 THEN epoch_us(date_trunc('second', {S.utc('fetched_at')})) + 123456 END AS published_us FROM articles WHERE source IS NOT NULL",
    "full_texts": f"""WITH a AS (SELECT pos, {S.url_key('url')} AS k FROM articles WHERE url IS NOT NULL AND trim(url) <> ''), t AS (SELECT k, max(struct_pack(n := CASE WHEN pos % 5 = 0 THEN 18 ELSE 4 END, t := CASE WHEN pos % 5 = 0 THEN '当前环境异常，完成验证后即可继续访问' ELSE 'text' END)).t AS x FROM a WHERE pos % 4 > 0 GROUP BY k)
SELECT pos, x AS full_text, CASE WHEN x IS NULL THEN 'missing' WHEN x <> 'text' THEN 'blocked' END AS error FROM a LEFT JOIN t USING (k)""",
    "written_instants": "SELECT record_id, CASE WHEN scan_pos % 4 < 3 THEN published_ms * 1000 END AS us, CASE WHEN scan_pos % 4 < 3 THEN published_ms * 1000 ELSE epoch_us(TIMESTAMP '2026-01-04 16:00:00') END AS entry_us FROM records WHERE published_ms IS NOT NULL",
    "nation_snapshot": "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)",
    "lost_nations": "SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)",
    "source_runs": "SELECT source_key, CASE kind WHEN 'html' THEN 'ok' WHEN 'rss' THEN 'failed' ELSE 'skipped' END AS state, CASE WHEN kind = 'html' THEN (SELECT count(*) FROM articles WHERE source = source_name) ELSE 0 END AS rows FROM source_specs",
    "resolved_rows": f"""WITH p AS (SELECT pos, n, url, title, {_HOST} AS host, regexp_extract(url, '/([A-Za-z0-9]+)(?:\\.html)?$', 1) AS id, coalesce({_TITLE}, '') AS own FROM ({_PAGES}) WHERE trim(url) <> ''),
a AS (SELECT host, id, max('api ' || title) AS t FROM p WHERE host IN ('lantern.example', 'harborwire.example') AND pos % 5 > 0 GROUP BY 1, 2), r AS (SELECT url, max('Title: reader ' || title || chr(10) || 'URL: x') AS t FROM p WHERE host = 'kiosk.example' AND pos % 2 = 0 GROUP BY 1)
SELECT u.url, coalesce(CASE WHEN u.id <> '' THEN nullif(string_split({S.clean('a.t')}, chr(10))[1], '') END, nullif(string_split({S.clean("regexp_extract(r.t, '^Title:\\s*(.+)\\n', 1)")}, chr(10))[1], ''), u.own) AS title FROM (SELECT url, host, id, arg_max(own, html) AS own FROM (SELECT *, CASE WHEN n < 2 THEN 'b' ELSE 'a' END || own AS html FROM p) GROUP BY url, host, id) u LEFT JOIN a ON a.host = u.host AND a.id = u.id LEFT JOIN r ON r.url = u.url""",
}
QUERIES = {f.__name__: f for f in (
    trend_rows, register_rows, marketplace_rows, feed_rows, reference_rows, scanned_pages, listed_reasons, detail_rows, channel_coverage, page_details, resolved_rows, listed_titles, listed_items,
    markdown_bodies, detail_texts, feed_items, full_texts, written_instants, nation_snapshot, lost_nations, source_runs,
)}
