"""Queries over signals, caches, documents, events and orders, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import event_id, previous_days, recovery_days
from newsloom.functions.html import html_text, page_links
from newsloom.functions.text import cell_text, has_any, plain_numbers, signal_id, traffic_number
from newsloom.operators.cache import cache_counters, cache_key, cached_results, last_writes, merged
from newsloom.operators.evidence import fitted_summary
from newsloom.operators.matching import merge_keyed, stale, write_counts
from newsloom.operators.model import known_text
from newsloom.operators.rules import signal_summary_problem
from newsloom.operators.schedule import latest_run, next_action, oldest_missing_day
from newsloom.plans import sql as S
from newsloom.session import dealt, new_path
from newsloom.sources.registry import enabled_specs, sources_by_country
from newsloom.sources.sinks import signal_rows
from newsloom.streaming.daily import daily_counts, flush_into, read_flushed
from newsloom.streaming.recovery import replay

#: Parameters of the queries over the test tables.
VERSION = "m1:v2"
DEMAND_WORDS = ["coffee", "solar", "咖啡机", "露营", "kids"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _signals(spark, sf):
    return _t(spark, sf, "signals")


def signal_keys(spark, sf):
    return _signals(spark, sf).select("signal_id", signal_id(F.col("source_key"), F.col("url"), F.col("title")).alias("key")).distinct()


def signal_sink_rows(spark, sf):
    return signal_rows(_signals(spark, sf))


def signal_counts(spark, sf):
    half = _signals(spark, sf).where("signal_id < '8'")
    return write_counts(_signals(spark, sf), half, "signal_id")


def signal_merge(spark, sf):
    rows = _signals(spark, sf).select("signal_id", F.coalesce("heat", F.lit(-1.0)).alias("heat"), "source_key")
    return merge_keyed(rows.where("signal_id < '8'"), rows.where("signal_id >= '4'"), ["signal_id"], ["heat"])


def plain_number_tokens(spark, sf):
    return _signals(spark, sf).select("signal_id", F.array_join(F.array_sort(plain_numbers(F.col("evidence"))), " ").alias("numbers")).distinct()


def signal_summary_checks(spark, sf):
    """What a summary may take its numbers from is the title, the time of publication and the evidence."""
    known = known_text(F.col("title"), F.col("published_at"), F.col("evidence"))
    return _signals(spark, sf).select("signal_id", signal_summary_problem(F.col("summary_zh"), known, 20, 150).alias("problem")).distinct()


def keyword_signals(spark, sf):
    return _signals(spark, sf).where(has_any(F.lower(F.concat_ws(" ", "title", "original_keyword")), DEMAND_WORDS)).select("signal_id").distinct()


def signals_of_country(spark, sf):
    """Range scan with an array test, latest first."""
    since = F.timestamp_micros(F.lit(1767225600000000))
    rows = _signals(spark, sf).where((F.col("published_at") >= since) & F.array_contains("countries", "us"))
    return rows.groupBy("signal_id").agg(F.max("heat").alias("heat"), F.unix_micros(F.max("published_at")).alias("published_us")).orderBy(F.desc("published_us"), "signal_id")


def signals_by_ids(spark, sf):
    wanted = _signals(spark, sf).where("confidence = 'high'").select("signal_id").distinct()
    return _signals(spark, sf).join(wanted, "signal_id", "left_semi").groupBy("signal_id").agg(F.count("*").alias("n"))


def country_type_gate(spark, sf):
    """Countries with at least two types of signals."""
    each = _signals(spark, sf).select(F.explode("countries").alias("country"), "signal_type")
    return each.groupBy("country").agg(F.count_distinct("signal_type").alias("types"), F.count("*").alias("signals")).where("types >= 2")


def source_states(spark, sf):
    rows = _signals(spark, sf).groupBy("source_key").agg(F.count("*").alias("signals"), F.count_if(F.col("published_at").isNull()).alias("undated"))
    return rows.select("source_key", F.to_json(F.struct("signals", "undated")).alias("state"))


def enabled_sources(spark, sf):
    return enabled_specs(_t(spark, sf, "source_specs")).select("source_key", "cadence")


def source_countries(spark, sf):
    return sources_by_country(enabled_specs(_t(spark, sf, "source_specs")).select("source_key", "countries"), _t(spark, sf, "countries")).select("source_key", "country_code", "currency")


def cache_last_writes(spark, sf):
    return last_writes(_t(spark, sf, "stage_cache")).select("cache_key", "stage", "stage_version", F.unix_micros("updated_at").alias("updated_us"))


def _classified(spark, sf):
    rows = _t(spark, sf, "articles").select("pos", cache_key(F.col("url"), F.col("title")).alias("key"))
    return cached_results(rows, _t(spark, sf, "stage_cache"), "key", VERSION)


def cache_classes(spark, sf):
    m = merged(F.col("filter"), F.col("summary"), ["status", "score_total"])
    return _classified(spark, sf).withColumn("m", m).select("pos", "class", "m.status", F.col("m.score_total").cast("long").alias("score_total"))


def cache_counts(spark, sf):
    return cache_counters(_classified(spark, sf))


def stale_sources(spark, sf):
    rows = _t(spark, sf, "articles").select("source", "batch_no", F.col("pos"))
    return stale(rows.where("batch_no <= 9"), rows.where("batch_no > 9"), "source", "pos")


def cell_texts(spark, sf):
    return _t(spark, sf, "records").select("record_id", cell_text(F.col("url_cell")).alias("text"))


def traffic_numbers(spark, sf):
    return _signals(spark, sf).select("signal_id", traffic_number(F.element_at("meta", "rank")).alias("rank")).distinct()


def document_links(spark, sf):
    return _t(spark, sf, "documents").where("text is not null").select("doc_id", F.explode(page_links(F.col("text"), r"https?://[a-z0-9.-]+/\w+")).alias("url"))


def markup_texts(spark, sf):
    return dealt(_t(spark, sf, "documents").where("text is not null").select("doc_id", "text")).select("doc_id", html_text(F.col("text"), F.lit(None).cast("string")).alias("text"))


def fitted_summaries(spark, sf):
    return _t(spark, sf, "records").select("record_id", fitted_summary(F.col("content")).alias("summary"))


def event_properties(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    return _t(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("k"), F.count("*").alias("n"))


def batch_daily_counts(spark, sf):
    return daily_counts(_t(spark, sf, "events"), by=["event_type"]).select(F.col("day").cast("string").alias("day"), "event_type", "n")


def stream_daily_counts(spark, sf):
    """The same counts from a stream over the table's files, run to its end: each batch sends the counts that it changed,
    which are merged by key into a table."""
    landed, table = new_path(spark, "landed"), new_path(spark, "counts")
    source = _t(spark, sf, "events")
    source.write.parquet(landed)
    stream = spark.readStream.schema(source.schema).parquet(landed)
    flush = flush_into(table, ["day", "event_type"], ["n"])
    query = daily_counts(stream, by=["event_type"]).writeStream.outputMode("update").foreachBatch(flush).option("checkpointLocation", new_path(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_flushed(spark, table, ["day", "event_type"], ["n"]).select(F.col("day").cast("string").alias("day"), "event_type", "n")


def recovery_states(spark, sf):
    """Polls made of events: an account for each user, errors as disabled."""
    e = _t(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", 0).otherwise(1)
    polls = e.select(F.col("user_id").cast("string").alias("account"), F.col("event_id").alias("poll_id"), F.col("ts").cast("timestamp").alias("polled_at"), status.alias("status"), F.when(status == 0, F.lit(0)).otherwise(F.unix_millis(F.date_trunc("day", F.col("ts").cast("timestamp")))).cast("long").alias("updated_ms"), (F.col("event_id") % 7 != 0).alias("refresh_ok"), (F.col("event_id") % 5 != 0).alias("dispatch_ok"))
    return replay(polls)


def _runs(spark, sf):
    o = _t(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "O", "in_progress").otherwise("completed")
    conclusion = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "failure")
    return o.select(F.col("o_custkey").cast("string").alias("title"), status.alias("status"), conclusion.alias("conclusion"), F.col("o_orderdate").cast("date").alias("created_at"), F.col("o_orderdate").cast("date").alias("day"))


def run_actions(spark, sf):
    return next_action(latest_run(_runs(spark, sf))).select("title", "action", F.col("created_at").cast("string").alias("created_at"))


def oldest_missing(spark, sf):
    runs = _runs(spark, sf).where("status <> 'in_progress'")
    return oldest_missing_day(runs, F.lit("1998-12-01").cast("date"), 31).select(F.col("day").cast("string").alias("day"))


def recovery_windows(spark, sf):
    day = F.to_date(F.timestamp_millis("published_ms"))
    rows = _t(spark, sf, "records").where("published_ms is not null")
    window = recovery_days(day, F.date_add(day, F.pmod("scan_pos", F.lit(9)).cast("int")), 7)
    return rows.select("record_id", F.array_join(F.transform(window, lambda d: d.cast("string")), ",").alias("days"), F.array_join(F.transform(previous_days(day, 2), lambda d: d.cast("string")), ",").alias("before"))


def event_names(spark, sf):
    return _t(spark, sf, "records").where("published_ms is not null").select("record_id", event_id(F.col("record_id"), F.col("published_ms")).alias("event"))


_CACHE = f"""SELECT cache_key, max(CASE WHEN stage = 'filter' THEN st END) AS f, max(CASE WHEN stage = 'filter' THEN sc END) AS fs, max(CASE WHEN stage = 'summary' THEN st END) AS s, max(CASE WHEN stage = 'summary' THEN sc END) AS ss
FROM (SELECT cache_key, stage, json_extract_string(j, '$.status') AS st, CAST(json_extract(j, '$.score_total') AS BIGINT) AS sc FROM (SELECT cache_key, stage, arg_max(result_json, struct_pack(u := updated_at, r := result_json)) AS j FROM stage_cache WHERE stage_version = '{VERSION}' GROUP BY cache_key, stage)) GROUP BY cache_key"""
_CLASSES = f"SELECT pos, CASE WHEN f IS NOT NULL AND f <> 'selected' THEN 'rejected' WHEN f = 'selected' AND s IS NOT NULL THEN 'ready' ELSE 'pending' END AS class, coalesce(s, f) AS status, coalesce(ss, fs) AS score_total FROM (SELECT pos, sha256(url || chr(10) || title) AS key FROM articles) a LEFT JOIN ({_CACHE}) c ON a.key = c.cache_key"
_DAILY = "SELECT CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"
_PLAIN = lambda c: "list_distinct(list_transform(regexp_extract_all(coalesce(%s, ''), '(?:^|[^A-Za-z])(\\d[\\d,.]*%%?)', 1), lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(x, ',', ''), '\\.+(%%?)$', '\\1'), '^0+(\\d)', '\\1'), '^\\.', '0.'), '^%%', '0%%')))" % c  # noqa: E731, UP031
_KNOWN = f"concat_ws(chr(10), title, strftime({S.utc('published_at')} + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00', evidence)"
_RUNS = "SELECT CAST(o_custkey AS VARCHAR) AS title, CASE WHEN o_orderstatus = 'O' THEN 'in_progress' ELSE 'completed' END AS status, CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'P' THEN 'failure' END AS conclusion, CAST(o_orderdate AS DATE) AS day FROM orders"

ORACLES: dict[str, str] = {
    "signal_keys": f"SELECT DISTINCT signal_id, sha256(source_key || '|' || lower({S.strip('url')}) || '|' || lower({S.clean('title')}))[1:32] AS key FROM signals",
    "signal_sink_rows": "SELECT signal_id, trim(title) AS title, url, coalesce(array_to_string(countries, '、'), '') AS countries, coalesce(nullif(array_to_string(topics, '、'), ''), signal_type) AS topics, heat FROM signals",
    "signal_counts": "WITH h AS (SELECT DISTINCT signal_id FROM signals WHERE signal_id < '8'), n AS (SELECT count(DISTINCT signal_id) AS inserted FROM signals WHERE signal_id NOT IN (SELECT signal_id FROM h)) SELECT (SELECT count(*) FROM signals) AS rows, inserted, (SELECT count(*) FROM signals) - inserted AS duplicates FROM n",
    "signal_merge": "SELECT signal_id, max(coalesce(heat, -1)) AS heat, arg_max(source_key, struct_pack(h := coalesce(heat, -1), s := source_key)) AS source_key FROM signals GROUP BY signal_id",
    "plain_number_tokens": f"SELECT DISTINCT signal_id, coalesce(array_to_string(list_sort({_PLAIN('evidence')}), ' '), '') AS numbers FROM signals",
    "signal_summary_checks": f"SELECT DISTINCT signal_id, CASE WHEN {S.visible('summary_zh')} NOT BETWEEN 20 AND 150 THEN 'length' WHEN contains(summary_zh, chr(10)) THEN 'lines' WHEN contains(summary_zh, '相关时间') OR contains(summary_zh, '相关数值') THEN 'placeholder' WHEN regexp_matches(summary_zh, '政策利好|重大利好|利空|高利润|巨大商机') THEN 'judgement' WHEN NOT regexp_matches(summary_zh, '卖家|进口商|出口商|平台|消费者|供应链|清关|关税|合规|成本|物流|报关|申报|运营') THEN 'impact' WHEN len(list_filter({_PLAIN('summary_zh')}, lambda x: NOT list_contains({_PLAIN(_KNOWN)}, x))) > 0 THEN 'number' ELSE '' END AS problem FROM signals",
    "keyword_signals": "SELECT DISTINCT signal_id FROM signals WHERE regexp_matches(lower(concat_ws(' ', title, original_keyword)), 'coffee|solar|咖啡机|露营|kids')",
    "signals_of_country": "SELECT signal_id, max(heat) AS heat, epoch_us(max(published_at)) AS published_us FROM signals WHERE epoch_us(published_at) >= 1767225600000000 AND list_contains(countries, 'us') GROUP BY signal_id",
    "signals_by_ids": "SELECT signal_id, count(*) AS n FROM signals WHERE signal_id IN (SELECT signal_id FROM signals WHERE confidence = 'high') GROUP BY signal_id",
    "country_type_gate": "SELECT country, count(DISTINCT signal_type) AS types, count(*) AS signals FROM (SELECT unnest(countries) AS country, signal_type FROM signals) GROUP BY country HAVING count(DISTINCT signal_type) >= 2",
    "source_states": "SELECT source_key, '{\"signals\":' || count(*) || ',\"undated\":' || count(*) FILTER (WHERE published_at IS NULL) || '}' AS state FROM signals GROUP BY source_key",
    "enabled_sources": "SELECT source_key, cadence FROM source_specs WHERE enabled",
    "source_countries": "SELECT source_key, country_code, currency FROM (SELECT source_key, unnest(countries) AS country_code FROM source_specs WHERE enabled) JOIN countries USING (country_code)",
    "cache_last_writes": "SELECT cache_key, stage, stage_version, epoch_us(max(updated_at)) AS updated_us FROM stage_cache GROUP BY ALL",
    "cache_classes": _CLASSES,
    "cache_counts": f"SELECT CAST(sum(CASE class WHEN 'rejected' THEN 1 WHEN 'ready' THEN 2 ELSE 0 END) AS BIGINT) AS hits, count(*) FILTER (WHERE class = 'pending') AS misses, count(*) AS evaluated FROM ({_CLASSES})",
    "stale_sources": "SELECT b.source FROM (SELECT source, max(pos) AS p FROM articles WHERE batch_no <= 9 GROUP BY source) b LEFT JOIN (SELECT source, max(pos) AS p FROM articles WHERE batch_no > 9 GROUP BY source) a ON a.source = b.source WHERE coalesce(a.p, 0) <= b.p",
    "cell_texts": f"SELECT record_id, CASE WHEN starts_with({S.strip('url_cell')}, '{{') THEN coalesce(nullif(json_extract_string(url_cell, '$.link'), ''), json_extract_string(url_cell, '$.text')) ELSE {S.strip('url_cell')} END AS text FROM records",
    "traffic_numbers": "SELECT DISTINCT signal_id, TRY_CAST(nullif(regexp_replace(meta['rank'], '[^0-9.]', '', 'g'), '') AS DOUBLE) AS rank FROM signals",
    "document_links": "SELECT DISTINCT doc_id, url FROM (SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '(?i)href=[\"'']([^\"''#]+)[\"'']', 1), lambda x: regexp_replace(x, '\\?.*$', ''))) AS url FROM documents) WHERE regexp_full_match(url, 'https?://[a-z0-9.-]+/\\w+')",
    "event_properties": "SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(*) AS n FROM events GROUP BY event_type",
    "batch_daily_counts": _DAILY,
    "stream_daily_counts": _DAILY,
    "run_actions": f"SELECT title, CASE WHEN (r).s = 'in_progress' THEN 'skip active' WHEN (r).c = 'success' THEN 'skip done' ELSE 'dispatch' END AS action, CAST((r).d AS VARCHAR) AS created_at FROM (SELECT title, max(struct_pack(d := day, s := status, c := coalesce(conclusion, ''))) AS r FROM ({_RUNS}) GROUP BY title)",
    "oldest_missing": f"SELECT CAST(min(d) AS VARCHAR) AS day FROM (SELECT CAST(unnest(generate_series(DATE '1998-10-31', DATE '1998-11-30', INTERVAL 1 DAY)) AS DATE) AS d) WHERE d NOT IN (SELECT day FROM ({_RUNS}) WHERE conclusion = 'success') HAVING min(d) IS NOT NULL",
    "recovery_windows": "SELECT record_id, array_to_string(list_transform(generate_series(greatest(d - 1, d + CAST(scan_pos % 9 AS INTEGER) - 6), CAST(d + CAST(scan_pos % 9 AS INTEGER) AS DATE), INTERVAL 1 DAY), lambda x: CAST(CAST(x AS DATE) AS VARCHAR)), ',') AS days, CAST(d - 1 AS VARCHAR) || ',' || CAST(d - 2 AS VARCHAR) AS before FROM (SELECT record_id, scan_pos, CAST(make_timestamp(published_ms * 1000) AS DATE) AS d FROM records WHERE published_ms IS NOT NULL)",
    "event_names": "SELECT record_id, 'login-' || strftime(make_timestamp(published_ms * 1000) + INTERVAL 8 HOUR, '%Y%m%dT%H%M%S') || '-' || sha256(record_id || ':' || CAST(published_ms AS VARCHAR))[1:12] AS event FROM records WHERE published_ms IS NOT NULL",
}
QUERIES = {f.__name__: f for f in (
    signal_keys, signal_sink_rows, signal_counts, signal_merge, plain_number_tokens, signal_summary_checks, keyword_signals, signals_of_country, signals_by_ids, country_type_gate, source_states, enabled_sources,
    source_countries, cache_last_writes, cache_classes, cache_counts, stale_sources, cell_texts, traffic_numbers, document_links, markup_texts, fitted_summaries, event_properties, batch_daily_counts,
    stream_daily_counts, recovery_states, run_actions, oldest_missing, recovery_windows, event_names,
)}
