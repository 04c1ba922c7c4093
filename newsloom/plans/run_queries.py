"""Queries over jobs, model stages, caches of signals and sinks, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import local_day
from newsloom.functions.text import clean_text, failure_markers, json_object, sink_identity
from newsloom.operators.matching import backfill_split, known_evidence
from newsloom.operators.model import Unavailable, Unsafe, analyse, enriched, error_counts, known_text, pending_mark
from newsloom.operators.progress import complete, flush_due, incomplete, manifests, next_flush, resume
from newsloom.operators.ranking import ranked
from newsloom.operators.reports import as_json, latest_or_default, length_range, write_times
from newsloom.operators.rules import admission, cached_admission, is_challenge, still_pending, valid_cached, valid_rejection
from newsloom.operators.schedule import confirmed_dispatch, expiry_warning, jobs_for, run_title, valid_request
from newsloom.plans import article_queries as A
from newsloom.plans import sql as S
from newsloom.session import dealt, stored
from newsloom.sources.sinks import article_rows, flat, record_rows, sync, unwritten

#: Parameters of the queries over the test tables.
VERSION, CATEGORIES, DEFAULT = "m2:v1", ("政策", "成长", "财经"), "社会"
VERSIONS = {"filter_version": "f1", "summary_version": "v1"}
PENDING_SOURCES = ["灯塔周报", "青木财经", "Harbor Wire", "Lagerpost"]
MARKERS = {"401": r"(?i)(?:status(?: code)?|HTTP)\s*[:=]?\s*401\b", "429": r"(?i)429 Too Many Requests\b", "none": "no account"}
DUMP = "create results:"
NOW = "2026-03-09 10:00:00"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _at(text: str) -> F.Column:
    return F.lit(text).cast("timestamp")


# Model stages: a stand-in gives the verdicts that the articles carry, as a model would word them, with its faults.


def _stand_in(rows: list[dict]) -> list[str | None]:
    """Answers from the recorded verdict. By pos: the service is down for 21 of 50, the text refused for 11 of 50, the
    first answer is no JSON for 3 of 10, every answer for 7 of 10; summaries are too short at first for 4 of 10."""
    out: list[str | None] = []
    for r in rows:
        pos, verdict = r["pos"], json.loads(r["recorded"])
        if pos % 50 == 21:
            raise Unavailable
        if pos % 50 == 11:
            raise Unsafe
        if r["stage"] == "filter":
            broken = pos % 10 == 7 or pos % 10 == 3 and r["previous"] is None
            out.append("no verdict" if broken else f"as asked: ```json\n{json.dumps(verdict, ensure_ascii=False)}\n```")
        else:
            short = pos % 10 == 4 and r["previous"] is None
            out.append("too short" if short else f"```text\n{verdict.get('core_content') or verdict['event_key']}\n```")
    return out


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "articles").where("ai_result is not null")
    recorded = F.to_json("ai_result")
    known = F.concat_ws("\n", "title", "ai_result.core_content", "ai_result.event_key")
    evidence = F.concat_ws("\n", F.concat(F.lit("E001 "), F.col("title")), F.concat(F.lit("E002 "), F.col("source")))
    return rows.select(F.sha2(F.col("pos").cast("string"), 256).alias("key"), "pos", "source", known.alias("known"), evidence.alias("evidence"), recorded.alias("recorded"))


_CACHE = "cache_key string, stage string, stage_version string, result_json string, updated_at timestamp"


def _stages(spark: SparkSession, sf: str, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    cache = spark.createDataFrame([], _CACHE) if cache is None else cache
    return analyse(dealt(_judged(spark, sf)), cache, _stand_in, VERSION, categories=CATEGORIES, default=DEFAULT, least=10, most=160, parts=1)


def stage_results(spark, sf):
    """Both stages for all articles with a recorded verdict."""
    results, _ = _stages(spark, sf)
    return results.select("key", "state", "error", "hits", "status", "valuable", "score_total", "category", "invalid_ai", "content_safety", "summary_chars")


def stage_counts(spark, sf):
    return error_counts(_stages(spark, sf)[0])


def stage_rerun(spark, sf):
    """A second run over the cache that the first has written: nothing is asked again but what waits."""
    _, writes = _stages(spark, sf)
    results, again = _stages(spark, sf, stored(writes.withColumn("updated_at", _at(NOW)), "cache"))
    return results.groupBy("state", "hits").agg(F.count("*").alias("rows"), F.lit(again.count()).cast("long").alias("written_again"))


def _choose(rows: list[dict]) -> list[str | None]:
    """Chooses signals of high confidence. A batch that holds a refused signal (heat below 0, or an id that begins with
    00) fails as a whole; answers for ids that begin with 1 are no JSON."""
    if any(r["signal_id"].startswith("00") for r in rows):
        raise Unsafe
    return ["?" if r["signal_id"].startswith("1") else json.dumps({"selected": r["confidence"] == "high", "keyword_zh": r["keyword_zh"], "topic": r["signal_type"], "section": "s"}) for r in rows]


def enriched_signals(spark, sf):
    rows = dealt(_t(spark, sf, "signals").select("signal_id", "confidence", F.coalesce("keyword_zh", F.lit("")).alias("keyword_zh"), "signal_type").distinct())
    return enriched(rows, _choose).select("signal_id", "status", "topic", "error")


def pending_marks(spark, sf):
    rows = _t(spark, sf, "articles").where("ai_result is null")
    return rows.select("pos", pending_mark(F.concat(F.lit("service failed: "), F.coalesce("body", F.lit(""))), F.to_json("ai_result")).alias("p")).select("pos", "p.*")


def number_evidence(spark, sf):
    rows = _t(spark, sf, "articles").where("fetched_at is not null")
    return rows.select("pos", F.sha2(known_text(F.coalesce("title", F.lit("")), F.date_trunc("second", F.col("fetched_at")), F.coalesce("body", F.lit("")), spoken=True), 256).alias("known"))


def json_answers(spark, sf):
    """Answers made of cached results: fenced, within words, broken, or a list."""
    r = F.col("result_json")
    raw = F.when(F.col("cache_key") < "4", F.concat(F.lit("so\n```json\n"), r, F.lit("\n```"))).when(F.col("cache_key") < "8", F.concat(F.lit("verdict: "), r, F.lit(" as asked")))
    raw = raw.when(F.col("cache_key") < "c", F.concat(F.lit("{"), r)).otherwise(F.lit("[1, 2]"))
    return _t(spark, sf, "stage_cache").select("cache_key", "stage", "stage_version", F.unix_micros("updated_at").alias("updated_us"), json_object(raw).alias("object"))


def unescaped_titles(spark, sf):
    text = F.concat(F.lit("A&amp;B &lt;i&gt;&nbsp;&#20013;&#x6587; "), F.col("title"), F.lit("\n&quot;x&quot;\n&quot;x&quot;"))
    return _t(spark, sf, "articles").where("title is not null").select("pos", clean_text(text).alias("title"))


# Caches, pending rows and sinks


def cached_signal_states(spark, sf):
    rows = _t(spark, sf, "signals")
    meta = F.create_map(F.lit("ai_status"), F.when(F.col("confidence") == "high", "selected").otherwise("rejected"), F.lit("filter_version"), F.lit("f1"), F.lit("summary_version"), F.when(F.col("heat") > 20000, "v0").otherwise("v1"))
    state = F.when(valid_cached(F.col("summary_zh"), F.col("topics"), meta, VERSIONS, least=20, most=60), "ready").when(valid_rejection(meta, VERSIONS), "rejected").otherwise("pending")
    return rows.select("signal_id", F.coalesce("heat", F.lit(-1.0)).alias("heat"), state.alias("state"))


def cached_admissions(spark, sf):
    return _t(spark, sf, "records").select("record_id", cached_admission(F.col("status"), F.col("content"), "主记录", 200, 500, 3).alias("admitted"))


def pending_records(spark, sf):
    rows = A._keyed_records(spark, sf)
    wanted = still_pending(F.col("status"), F.col("source_name"), local_day(F.timestamp_millis("published_ms")), F.col("title"), F.col("link"), ["待处理", "增量"], PENDING_SOURCES, F.lit("2024-06-01").cast("date"))
    return rows.where(wanted).select("record_id", "status")


def sink_identities(spark, sf):
    return _t(spark, sf, "records").select("record_id", sink_identity(F.coalesce("title", F.lit("")), F.col("url_cell")).alias("i")).select("record_id", "i.*")


def delivered_rows(spark, sf):
    return article_rows(_t(spark, sf, "articles"), F.col("fetched_at")).withColumn("content", F.length("content"))


def flat_signals(spark, sf):
    return flat(_t(spark, sf, "signals").select("signal_id", "title", "countries", "topics", "meta", "confidence")).distinct()


def table_rows(spark, sf):
    rows = _t(spark, sf, "articles").where("trim(title) <> '' and trim(url) <> ''")
    made = record_rows(rows, ["source_name", "published_ms", "content", "status"], F.coalesce("body", F.lit("")), F.col("fetched_at"), F.col("daily_date"))
    return made.select("title", "url", "source_name", "published_ms", F.length("content").alias("chars"), "status")


def _written(spark, sf):
    rows = A._keyed_articles(spark, sf).where("url_key is not null")
    status = F.when(F.col("ai_result.status") == "selected", "main").when(F.col("ai_result.status") == "reject", "repetition").otherwise("increment")
    return rows.select("url_key", "pos", status.alias("status"), F.coalesce("title", F.lit("")).alias("title"), F.col("source").alias("source_name"))


def _table(spark, sf):
    rows = A._keyed_records(spark, sf).where("url_key is not null")
    return A.last_per_key(rows.select("url_key", "scan_pos", F.coalesce("title", F.lit("")).alias("title"), "source_name", "status", "content"), ["url_key"], ["scan_pos"])


def sync_actions(spark, sf):
    return sync(_table(spark, sf), _written(spark, sf), "url_key", "pos", ["title", "source_name"])[1].select("url_key", "action")


def synced_table(spark, sf):
    after, _, invalid = sync(_table(spark, sf), _written(spark, sf), "url_key", "pos", ["title", "source_name"])
    return after.join(invalid.withColumn("wrong", F.lit(True)), "url_key", "left").select("url_key", "title", F.coalesce("wrong", F.lit(False)).alias("wrong"))


def unwritten_records(spark, sf):
    rows = _written(spark, sf).withColumn("status", F.lit("主记录"))
    return unwritten(rows, _table(spark, sf), "url_key", "status", "content", "主记录")


def backfilled_articles(spark, sf):
    matched, _ = backfill_split(A._keyed_articles(spark, sf).select("pos", "url_key", "title_key"), A._keyed_records(spark, sf), ("url_key", "title_key"), "scan_pos", "record_id")
    return matched.select("pos", "record_id")


def records_without_article(spark, sf):
    return backfill_split(A._keyed_articles(spark, sf).select("pos", "url_key", "title_key"), A._keyed_records(spark, sf), ("url_key", "title_key"), "scan_pos", "record_id")[1]


def evidence_ids(spark, sf):
    """For each source the ids of its signals that are among those of high confidence."""
    s = _t(spark, sf, "signals")
    asked = s.groupBy("source_key").agg(F.array_sort(F.collect_set("signal_id")).alias("ids"))
    found = known_evidence(asked, "ids", s.where("confidence = 'high'"), "signal_id", "source_key")
    return found.select("source_key", F.array_join("known", ",").alias("known"))


def pending_ladder(spark, sf):
    rows = dealt(_t(spark, sf, "articles").select("pos", "title", "excluded_reason", "body")).withColumn("clean", clean_text(F.coalesce("body", F.lit(""))))
    return rows.select("pos", admission(F.col("title"), F.col("clean"), F.col("excluded_reason"), least=250, sample=1000, pending=True, extra_words=["露营", "kids"]).alias("a")).select("pos", "a.*")


def challenge_texts(spark, sf):
    text = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Please pass the Security Check. "), F.col("text"))).otherwise(F.col("text"))
    return _t(spark, sf, "documents").select("doc_id", is_challenge(text).alias("challenge"))


def summary_range(spark, sf):
    return length_range(_t(spark, sf, "articles").select(F.col("ai_result.summary_chars").alias("n")), "n")


def newest_first(spark, sf):
    rows = _t(spark, sf, "articles").where("ai_result.status = 'selected'").select("pos", "fetched_at", F.lit(0).alias("all"))
    return ranked(rows, ["all"], [F.desc("fetched_at"), F.asc("pos")], "place").select("pos", "place").orderBy("place")


def both_passes(spark, sf):
    """The policy and the demand pass of signals as one."""
    s = _t(spark, sf, "signals").select("signal_id", "signal_type").distinct()
    policy, demand = (s.where(F.col("signal_type") == t).withColumn("job", F.lit(t)) for t in ("policy", "demand"))
    return policy.unionByName(demand).select("signal_id", "job")


# Jobs


def _placed(spark, sf):
    rows = _t(spark, sf, "articles").where("source is not null").select("source", "pos")
    return manifests(rows, "source", "pos", [F.asc("pos")])


def resume_plan(spark, sf):
    """Progress at half of each job; the jobs whose source has an even number of characters have changed since."""
    placed, found = _placed(spark, sf)
    found = stored(found, "manifests")
    stale = F.when(F.length("source") % 2 == 0, F.lit("changed")).otherwise(F.col("manifest"))
    progress = found.select("source", stale.alias("manifest"), F.floor(F.col("rows") / 2).alias("next_index"), _at(NOW).alias("updated_at"))
    older = found.select("source", "manifest", F.col("rows").alias("next_index"), _at("2026-01-01 00:00:00").alias("updated_at"))
    return resume(placed, found, progress.unionByName(older), "source").select("source", "pos", "place", "replayed")


def _jobs(spark, sf):
    progress = _t(spark, sf, "articles").groupBy("source").agg(F.max("fetched_at").alias("updated_at"))
    done = progress.where(F.length("source") % 3 == 0).select("source", F.col("updated_at").alias("completed_at"))
    earlier = progress.where(F.length("source") % 2 == 0).select("source", _at("2024-01-01 00:00:00").alias("completed_at"))
    return progress, *complete(progress, earlier, done, "source")


def job_completions(spark, sf):
    return _jobs(spark, sf)[2].select("source", F.unix_micros("completed_at").alias("completed_us"))


def job_progress(spark, sf):
    return _jobs(spark, sf)[1].select("source")


def jobs_to_do(spark, sf):
    progress, _, completions = _jobs(spark, sf)
    return incomplete(progress, completions, "source").select("source")


def flush_times(spark, sf):
    planned, now = F.date_trunc("hour", F.col("ts").cast("timestamp")), F.col("ts").cast("timestamp") + F.make_dt_interval(hours=F.pmod("user_id", F.lit(5)).cast("int"))
    k = F.get_json_object("props", "$.k").cast("long")
    return _t(spark, sf, "events").select("event_id", F.unix_micros(next_flush(planned, now, 3600)).alias("next_us"), flush_due(planned, now, k % 3).alias("due"))


_ROUTES = [("7 0 * * *", None, "website", "daily", "previous"), ("7 0 * * *", None, "accounts", "daily", "previous"), ("7 4 * * *", None, "website", "daily", "oldest"), ("17 * * * *", 1, "market", "demand", "today"), ("17 * * * *", 8, "market", "policy", "today")]


def cron_jobs(spark, sf):
    routes = spark.createDataFrame(_ROUTES, "cron string, hour int, pipeline string, job string, target string")
    cron = F.element_at(F.array(F.lit("7 0 * * *"), F.lit("7 4 * * *"), F.lit("17 * * * *")), (F.col("event_id") % 3 + 1).cast("int"))
    ticks = _t(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"), cron.alias("cron"))
    return jobs_for(ticks, routes).select("event_id", "pipeline", "job", F.col("target_day").cast("string").alias("target_day"))


def confirmed_runs(spark, sf):
    o = _t(spark, sf, "orders")
    runs = o.select(run_title(F.lit("daily"), F.col("o_custkey").cast("string")).alias("title"), F.col("o_orderdate").cast("timestamp").alias("created_at"))
    tries = _t(spark, sf, "customer").select(run_title(F.lit("daily"), F.col("c_custkey").cast("string")).alias("title"), F.explode(F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("attempt"))
    tries = tries.withColumn("dispatched_at", F.when(F.col("attempt") == 1, _at("1998-06-01 00:00:02")).otherwise(_at("1997-06-01 00:00:00")))
    return confirmed_dispatch(tries, runs)


def recovery_requests(spark, sf):
    e = _t(spark, sf, "events")
    day = lambda back: F.date_sub(F.lit("2026-03-09").cast("date"), back).cast("string")
    name = F.concat(F.lit("login-"), F.repeat(F.lit("x"), F.pmod("user_id", F.lit(4)).cast("int")))
    k = F.col("event_id") % 9
    days = F.when(k == 8, F.array(day(F.lit(1)), day(F.lit(1)))).when(k == 7, F.array(F.lit("soon"))).otherwise(F.array(day(F.lit(0)), day(k.cast("int") + 1)))
    return e.select("event_id", valid_request(name, days, F.lit("2026-03-09").cast("date")).alias("valid"))


def token_warnings(spark, sf):
    w = expiry_warning(F.col("o_orderdate").cast("date"), _at("1997-01-01 12:00:00"), 30)
    return _t(spark, sf, "orders").select("o_orderkey", w.alias("w")).select("o_orderkey", F.col("w.days_left").cast("long").alias("days_left"), "w.warn")


def log_markers(spark, sf):
    e = F.col("event_id")
    log = F.concat_ws("\n", F.lit("create results: HTTP 401 429 Too Many Requests"), F.concat(F.lit("\x1b[31mstatus code: "), (F.lit(399) + e % 4).cast("string"), F.lit("\x1b[0m")), F.when(e % 5 == 0, F.lit("429 too many requests")), F.when(e % 7 == 0, F.lit("no account left")))
    return _t(spark, sf, "events").select("event_id", F.array_join(failure_markers(log, MARKERS, DUMP), ",").alias("markers"))


def latest_account(spark, sf):
    """The account of the latest event, and what a table without rows gives."""
    e = _t(spark, sf, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("updated"), F.col("user_id").alias("id"), F.when(F.col("event_type") == "error", 0).otherwise(1).alias("status"))
    shape = {"id": F.lit(None).cast("long"), "status": F.lit(0)}
    return latest_or_default(e, "updated", shape).withColumn("table", F.lit("events")).unionByName(latest_or_default(e.limit(0), "updated", shape).withColumn("table", F.lit("empty")))


def report_json(spark, sf):
    return as_json(write_times(_t(spark, sf, "articles").select(F.unix_micros("fetched_at").alias("at")), "at"))


_J = "coalesce(ai_result.status = 'selected' AND s.evidence_density >= 3 AND s.information_gain >= 3 AND t >= 13 OR s.information_gain >= 4 AND s.evidence_density >= 3, false)"
_STAGED = f"""SELECT *, CASE WHEN pos % 50 = 21 THEN 'down' WHEN pos % 50 = 11 THEN 'refused' WHEN pos % 10 = 7 THEN 'format' WHEN good THEN 'valuable' ELSE 'poor' END AS f, coalesce(nullif(core, ''), event_key) AS summary FROM (
SELECT pos, sha256(CAST(pos AS VARCHAR)) AS key, t, {_J} AS good, ai_result.core_content AS core, ai_result.event_key AS event_key, CASE WHEN ai_result.category IN ('政策', '成长', '财经') THEN ai_result.category ELSE '社会' END AS category
FROM (SELECT *, ai_result.scores AS s, ai_result.scores.importance + ai_result.scores.information_gain + ai_result.scores.social_impact + ai_result.scores.actionability + ai_result.scores.evidence_density AS t FROM articles WHERE ai_result IS NOT NULL))"""
_STAGED = f"SELECT *, f = 'valuable' AND {S.visible('summary')} BETWEEN 10 AND 160 AS told FROM ({_STAGED})"
_RESULTS = f"""SELECT key, CASE WHEN f = 'down' THEN 'waiting' ELSE 'done' END AS state, CASE f WHEN 'down' THEN 'unavailable' WHEN 'refused' THEN 'unsafe' ELSE '' END AS error, 0 AS hits,
CASE WHEN f = 'down' THEN NULL WHEN told THEN 'selected' ELSE 'reject' END AS status, told AS valuable, CASE WHEN f IN ('valuable', 'poor') THEN t END AS score_total, CASE WHEN f IN ('valuable', 'poor') THEN category END AS category,
CASE WHEN f = 'down' THEN false ELSE f = 'format' END AS invalid_ai, f = 'refused' AS content_safety, CASE WHEN told THEN {S.visible('summary')} ELSE 0 END AS summary_chars FROM ({_STAGED})"""
_WRITTEN = f"SELECT url_key, arg_max(st, pos) AS status, arg_max(ti, pos) AS title, arg_max(source, pos) AS source_name FROM (SELECT *, CASE ai_result.status WHEN 'selected' THEN 'main' WHEN 'reject' THEN 'repetition' ELSE 'increment' END AS st, coalesce(title, '') AS ti FROM ({A.A_KEYS})) WHERE url_key IS NOT NULL GROUP BY url_key"
_TABLE = f"SELECT url_key, arg_max(coalesce(title, ''), scan_pos) AS title, arg_max(source_name, scan_pos) AS source_name, arg_max(status, scan_pos) AS status, arg_max(coalesce(content, ''), scan_pos) AS content FROM ({A.R_KEYS}) WHERE url_key IS NOT NULL GROUP BY url_key"
_ACTIONS = f"SELECT w.url_key, CASE WHEN t.url_key IS NULL AND w.status = 'repetition' THEN 'left out' WHEN t.url_key IS NULL THEN 'insert' WHEN t.title = w.title AND t.source_name IS NOT DISTINCT FROM w.source_name THEN 'unchanged' ELSE 'update' END AS action, w.title FROM ({_WRITTEN}) w LEFT JOIN ({_TABLE}) t USING (url_key)"
_CELL = f"CASE WHEN starts_with({S.strip('url_cell')}, '{{') THEN coalesce(nullif(json_extract_string(url_cell, '$.link'), ''), nullif(json_extract_string(url_cell, '$.url'), ''), json_extract_string(url_cell, '$.text')) ELSE {S.strip('url_cell')} END"
_MATCH = f"SELECT a.pos, coalesce(u.record_id, t.record_id) AS record_id FROM ({A.A_KEYS}) a LEFT JOIN ({A._INDEX('url_key')}) u ON a.url_key = u.url_key LEFT JOIN ({A._INDEX('title_key')}) t ON a.title_key = t.title_key"
_LADDER_TEXT = S.clean("coalesce(body, '')")
_EV = "make_timestamp(epoch_us(ts))"

ORACLES: dict[str, str] = {
    "stage_results": _RESULTS,
    "stage_counts": f"SELECT count(*) FILTER (WHERE state = 'done') AS evaluated, count(*) FILTER (WHERE content_safety) AS refused, count(*) FILTER (WHERE invalid_ai) AS invalid, (SELECT count(*) FROM ({_STAGED}) WHERE f = 'valuable' AND NOT told) AS summary_rejected, count(*) FILTER (WHERE state = 'waiting') AS waiting, CAST(0 AS BIGINT) AS hits FROM ({_RESULTS})",
    "stage_rerun": f"SELECT CASE WHEN f = 'down' THEN 'waiting' ELSE 'done' END AS state, CASE f WHEN 'down' THEN 0 WHEN 'valuable' THEN 2 ELSE 1 END AS hits, count(*) AS rows, CAST(0 AS BIGINT) AS written_again FROM ({_STAGED}) GROUP BY 1, 2",
    "enriched_signals": "SELECT DISTINCT signal_id, CASE WHEN signal_id LIKE '00%' OR signal_id LIKE '1%' THEN 'skipped' WHEN confidence = 'high' THEN 'selected' ELSE 'rejected' END AS status, CASE WHEN signal_id NOT LIKE '00%' AND signal_id NOT LIKE '1%' AND confidence = 'high' THEN signal_type END AS topic, CASE WHEN signal_id LIKE '00%' THEN 'unsafe' ELSE '' END AS error FROM (SELECT DISTINCT signal_id, confidence, coalesce(keyword_zh, '') AS k, signal_type FROM signals)",
    "pending_marks": "SELECT pos, 'retry' AS record_status, ('service failed: ' || coalesce(body, ''))[1:1000] AS failure_reason, '{}' AS result_json FROM articles WHERE ai_result IS NULL",
    "number_evidence": f"SELECT pos, sha256(concat_ws(chr(10), coalesce(title, ''), strftime({S.utc('fetched_at')} + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00', year({S.utc('fetched_at')} + INTERVAL 8 HOUR) || '年' || month({S.utc('fetched_at')} + INTERVAL 8 HOUR) || '月' || day({S.utc('fetched_at')} + INTERVAL 8 HOUR) || '日', coalesce(body, ''))) AS known FROM articles WHERE fetched_at IS NOT NULL",
    "json_answers": "SELECT cache_key, stage, stage_version, epoch_us(updated_at) AS updated_us, CASE WHEN cache_key < '8' THEN result_json END AS object FROM stage_cache",
    "unescaped_titles": f"SELECT pos, {S.clean_of('''replace('A&B <i>' || chr(160) || '中文 ', chr(160), ' ') || title || chr(10) || '\"x\"' || chr(10) || '\"x\"' ''')} AS title FROM articles WHERE title IS NOT NULL",
    "cached_signal_states": f"SELECT signal_id, coalesce(heat, -1) AS heat, CASE WHEN coalesce(heat <= 20000, true) AND confidence = 'high' AND len(coalesce(topics, [])) > 0 AND {S.visible('summary_zh')} BETWEEN 20 AND 60 AND summary_zh IS NOT NULL THEN 'ready' WHEN coalesce(heat <= 20000, true) AND coalesce(confidence, '') <> 'high' THEN 'rejected' ELSE 'pending' END AS state FROM signals",
    "cached_admissions": f"SELECT record_id, coalesce(status = '主记录' AND {S.visible('content')} BETWEEN 200 AND 500 AND len(list_filter(list_transform(string_split_regex(content, '\\n+'), lambda p: {S.strip('p')}), lambda p: p <> '')) = 3, false) AS admitted FROM records",
    "pending_records": f"SELECT record_id, status FROM ({A.R_KEYS}) WHERE status IN ('待处理', '增量') AND source_name IN ('灯塔周报', '青木财经', 'Harbor Wire', 'Lagerpost') AND CAST(make_timestamp(published_ms * 1000) + INTERVAL 8 HOUR AS DATE) >= DATE '2024-06-01' AND coalesce(title, '') <> '' AND coalesce(link, '') <> ''",
    "sink_identities": rf"SELECT record_id, regexp_replace(lower({S.strip('''coalesce(title, '')''')}), '[^\p{{L}}\p{{N}}_]+', '', 'g') AS title_key, CASE WHEN coalesce({_CELL}, '') = '' THEN '' ELSE {S.url_key(_CELL)} END AS url_key FROM records",
    "delivered_rows": f"SELECT coalesce(title, '') AS title, coalesce(source, '') AS source_name, coalesce(url, '') AS url, coalesce(meta['image'], '') AS image, strftime({S.utc('fetched_at')}, '%Y-%m-%dT%H:%M:%S') AS published, CAST(coalesce(daily_date, CAST({S.utc('fetched_at')} AS DATE)) AS VARCHAR) AS day, coalesce(array_to_string(ai_result.topics, '、'), '') AS topics, coalesce(ai_result.category, '') AS category, coalesce(record_status, '') AS status, length(coalesce(ai_result.core_content, '')) AS content, coalesce(meta['failure_reason'], '') AS failure_reason FROM articles",
    "flat_signals": "SELECT DISTINCT signal_id, title, CAST(to_json(countries) AS VARCHAR) AS countries, CAST(to_json(topics) AS VARCHAR) AS topics, CAST(to_json(meta) AS VARCHAR) AS meta, confidence FROM signals",
    "table_rows": f"SELECT title[1:1000] AS title, url, source AS source_name, epoch_us({S.utc('fetched_at')}) // 1000 AS published_ms, length(coalesce(body, '')[1:100000]) AS chars, record_status AS status FROM articles WHERE trim(title) <> '' AND trim(url) <> ''",
    "sync_actions": f"SELECT url_key, action FROM ({_ACTIONS})",
    "synced_table": f"SELECT url_key, title, false AS wrong FROM ({_ACTIONS}) WHERE action <> 'left out' UNION ALL SELECT url_key, title, false FROM ({_TABLE}) WHERE url_key NOT IN (SELECT url_key FROM ({_ACTIONS}))",
    "unwritten_records": f"SELECT w.url_key FROM ({_WRITTEN}) w LEFT JOIN ({_TABLE}) t USING (url_key) WHERE t.status IS NULL OR t.status <> '主记录' OR t.content = ''",
    "backfilled_articles": f"SELECT pos, record_id FROM ({_MATCH}) WHERE record_id IS NOT NULL",
    "records_without_article": f"SELECT record_id FROM ({A._INDEX('url_key')}) WHERE record_id NOT IN (SELECT record_id FROM ({_MATCH}) WHERE record_id IS NOT NULL)",
    "evidence_ids": "SELECT s.source_key, coalesce(string_agg(h.signal_id, ',' ORDER BY h.signal_id), '') AS known FROM (SELECT DISTINCT source_key, signal_id FROM signals) s LEFT JOIN (SELECT DISTINCT signal_id FROM signals WHERE confidence = 'high') h USING (signal_id) GROUP BY s.source_key",
    "pending_ladder": f"""SELECT pos, CASE WHEN why <> '' THEN 'excluded' WHEN text = '' THEN 'pending' WHEN length(text) < 250 THEN 'excluded' WHEN promo THEN 'excluded' ELSE 'ok' END AS outcome, CASE WHEN why <> '' THEN why WHEN text = '' THEN 'empty' WHEN length(text) < 250 THEN 'short' WHEN promo THEN 'promotion' ELSE '' END AS reason
FROM (SELECT pos, text, coalesce(nullif(excluded_reason, ''), nullif(list_filter({S.words(A.TITLE_EXCLUSIONS)}, lambda w: contains(replace(title, ' ', ''), w))[1], ''), '') AS why, len(list_filter({S.words([*A.PROMOTION_WORDS, '露营', 'kids'])}, lambda w: contains(coalesce(title, '') || chr(10) || text[1:1000], w))) > 0 AS promo FROM (SELECT *, {_LADDER_TEXT} AS text FROM articles))""",
    "challenge_texts": "SELECT doc_id, coalesce(regexp_matches(lower(CASE WHEN doc_id % 3 = 0 THEN 'Please pass the Security Check. ' || text ELSE text END), 'captcha|verify you are human|automated access|疑似自动化访问|just a moment|cloudflare ray id|security check|访问验证'), false) AS challenge FROM documents",
    "summary_range": "SELECT min(nullif(ai_result.summary_chars, 0)) AS shortest, max(nullif(ai_result.summary_chars, 0)) AS longest FROM articles",
    "newest_first": "SELECT pos, row_number() OVER (ORDER BY fetched_at DESC NULLS LAST, pos) AS place FROM articles WHERE ai_result.status = 'selected'",
    "both_passes": "SELECT DISTINCT signal_id, signal_type AS job FROM signals WHERE signal_type IN ('policy', 'demand')",
    "resume_plan": "SELECT source, pos, place, length(source) % 2 = 1 AND place < n // 2 AS replayed FROM (SELECT source, pos, row_number() OVER (PARTITION BY source ORDER BY pos) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM articles WHERE source IS NOT NULL)",
    "job_completions": "SELECT source, max(done_us) AS completed_us FROM (SELECT source, epoch_us(max(fetched_at)) AS done_us FROM articles WHERE length(source) % 3 = 0 GROUP BY source UNION ALL SELECT DISTINCT source, epoch_us(TIMESTAMP '2024-01-01') FROM articles WHERE length(source) % 2 = 0) GROUP BY source",
    "job_progress": "SELECT DISTINCT source FROM articles WHERE length(source) % 3 <> 0",
    "jobs_to_do": "SELECT DISTINCT source FROM articles WHERE length(source) % 3 <> 0 AND length(source) % 2 <> 0",
    "flush_times": f"SELECT event_id, epoch_us(date_trunc('hour', {_EV}) + INTERVAL 1 HOUR * (user_id % 5 + 1)) AS next_us, CAST(json_extract(props, '$.k') AS BIGINT) % 3 > 0 AS due FROM events",
    "cron_jobs": f"""WITH r(cron, hour, pipeline, job, target) AS (VALUES {', '.join('(' + ', '.join('NULL' if x is None else str(x) if isinstance(x, int) else f"'{x}'" for x in row) + ')' for row in _ROUTES)}), t AS (SELECT event_id, {_EV} AS tick, ['7 0 * * *', '7 4 * * *', '17 * * * *'][event_id % 3 + 1] AS cron FROM events)
SELECT event_id, pipeline, job, CAST(CASE target WHEN 'today' THEN CAST(tick + INTERVAL 8 HOUR AS DATE) WHEN 'previous' THEN CAST(tick + INTERVAL 8 HOUR AS DATE) - 1 END AS VARCHAR) AS target_day FROM t JOIN r ON t.cron = r.cron AND (r.hour IS NULL OR r.hour = hour(tick))""",
    "confirmed_runs": """WITH t AS (SELECT c_custkey AS k, unnest(CASE WHEN c_custkey % 2 = 0 THEN [1, 2] ELSE [1] END) AS attempt FROM customer), d AS (SELECT *, CASE attempt WHEN 1 THEN TIMESTAMP '1998-06-01 00:00:00' ELSE TIMESTAMP '1997-05-31 23:59:58' END AS since FROM t),
m AS (SELECT k, attempt, bool_or(coalesce(o_orderdate >= since, false)) AS met FROM d LEFT JOIN orders ON o_custkey = k GROUP BY k, attempt)
SELECT 'daily · ' || k AS title, CASE WHEN bool_or(met) THEN 'confirmed' WHEN max(attempt) < 2 THEN 'retry' ELSE 'failed' END AS state, coalesce(min(attempt) FILTER (WHERE met), max(attempt)) AS attempt FROM m GROUP BY k""",
    "recovery_requests": "SELECT event_id, user_id % 4 >= 2 AND event_id % 9 < 6 AS valid FROM events",
    "token_warnings": "SELECT o_orderkey, CAST(d AS BIGINT) AS days_left, d <= 30 AS warn FROM (SELECT o_orderkey, ceil((epoch(CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP)) - 1 - epoch(TIMESTAMP '1997-01-01 12:00:00')) / 86400) AS d FROM orders)",
    "log_markers": "SELECT event_id, concat_ws(',', CASE WHEN event_id % 4 = 2 THEN '401' END, CASE WHEN event_id % 5 = 0 THEN '429' END, CASE WHEN event_id % 7 = 0 THEN 'none' END) AS markers FROM events",
    "latest_account": "SELECT * FROM (SELECT user_id AS id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS status, 'events' AS \"table\" FROM events ORDER BY ts DESC, user_id DESC, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END DESC LIMIT 1) UNION ALL SELECT NULL, 0, 'empty'",
    "report_json": "SELECT '{\"first_write_at\":' || min(epoch_us(fetched_at)) || ',\"last_write_at\":' || max(epoch_us(fetched_at)) || '}' AS report FROM articles",
}
QUERIES = {f.__name__: f for f in (
    stage_results, stage_counts, stage_rerun, enriched_signals, pending_marks, number_evidence, json_answers, unescaped_titles, cached_signal_states, cached_admissions, pending_records, sink_identities,
    delivered_rows, flat_signals, table_rows, sync_actions, synced_table, unwritten_records, backfilled_articles, records_without_article, evidence_ids, pending_ladder, challenge_texts, summary_range,
    newest_first, both_passes, resume_plan, job_completions, job_progress, jobs_to_do, flush_times, cron_jobs, confirmed_runs, recovery_requests, token_warnings, log_markers, latest_account, report_json,
)}
