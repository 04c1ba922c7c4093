"""Queries over articles and records, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import day_bounds, local_day
from newsloom.functions.text import PROMOTION_WORDS, TITLE_EXCLUSIONS, clean_text, content_hash, normalize_title, normalize_url, numbers_with_units, sentences, visible_chars
from newsloom.operators.clustering import cluster_events
from newsloom.operators.dedupe import best_per_key, either_key, last_per_key
from newsloom.operators.evidence import best_sentences, chunk_texts, evidence_packets
from newsloom.operators.matching import missing_days, missing_keys, two_key_match, unseen, upsert_plan, with_retries
from newsloom.operators.ranking import batches, ranked, round_robin
from newsloom.operators.reports import body_outcomes, latest, run_totals, source_coverage, staleness, status_counts, table_audit
from newsloom.operators.rules import admission, is_valuable, score_total, summary_problem, tidy_verdict
from newsloom.plans import sql as S
from newsloom.session import dealt, stored
from newsloom.sources.feeds import first_addresses
from newsloom.sources.sinks import audit_migration, backfill_days, invalid_after_write, repair_titles

#: Parameters of the queries over the test tables: order of sources, the one with every second turn, a day.
SOURCE_ORDER = ["灯塔周报", "青木财经", "北麓观察", "数光日志", "Harbor Wire", "The Counting Shed"]
PRIMARY = "灯塔周报"
QUIET = "Night Shift Retail"
DAY, TODAY = "2026-03-01", "2026-03-09"
CATEGORIES = ["政策", "成长", "财经"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "articles")


def _with_keys(rows: DataFrame, url: str, title: str) -> DataFrame:
    blank = lambda c: F.nullif(c, F.lit(""))
    return rows.withColumns({"url_key": F.when(F.trim(F.coalesce(F.col(url), F.lit(""))) != "", normalize_url(F.col(url))), "title_key": blank(normalize_title(F.col(title)))})


def _keyed_articles(spark: SparkSession, sf: str) -> DataFrame:
    return _with_keys(_articles(spark, sf), "url", "title")


def _keyed_records(spark: SparkSession, sf: str) -> DataFrame:
    records = _t(spark, sf, "records")
    link = F.coalesce(F.get_json_object("url_cell", "$.link"), F.col("url_cell"))
    return _with_keys(records.withColumn("link", link), "link", "title")


A_KEYS = f"SELECT *, CASE WHEN trim(coalesce(url, '')) <> '' THEN {S.url_key('url')} END AS url_key, nullif({S.title_key('title')}, '') AS title_key FROM articles"
LINK = "CASE WHEN starts_with(url_cell, '{') THEN coalesce(json_extract_string(url_cell, '$.link'), url_cell) ELSE url_cell END"
R_KEYS = f"SELECT *, CASE WHEN trim(coalesce(link, '')) <> '' THEN {S.url_key('link')} END AS url_key, nullif({S.title_key('title')}, '') AS title_key FROM (SELECT *, {LINK} AS link FROM records)"


def url_keys(spark, sf):
    return _articles(spark, sf).select("pos", normalize_url(F.col("url")).alias("url_key"))


def title_keys(spark, sf):
    return _articles(spark, sf).select("pos", normalize_title(F.col("title")).alias("title_key"))


def clean_texts(spark, sf):
    return dealt(_articles(spark, sf).where("body is not null").select("pos", "body")).select("pos", clean_text(F.col("body")).alias("clean"), visible_chars(F.col("body")).alias("chars"))


def content_hashes(spark, sf):
    rows = dealt(_articles(spark, sf).where("title is not null and url is not null and body is not null").select("pos", "title", "url", "body"))
    return rows.select("pos", content_hash(F.col("title"), F.col("url"), F.col("body")).alias("hash"))


def number_tokens(spark, sf):
    return _articles(spark, sf).select("pos", F.array_join(F.array_sort(numbers_with_units(F.col("body"))), " ").alias("numbers"))


def sentence_split(spark, sf):
    rows = dealt(_articles(spark, sf).where("body is not null").select("pos", "body"))
    return rows.select("pos", F.inline(sentences(clean_text(F.col("body")))))


def best_section_sentences(spark, sf):
    return best_sentences(_articles(spark, sf)).select("pos", "section", "position", "score")


def evidence(spark, sf):
    return evidence_packets(_articles(spark, sf))


def text_chunks(spark, sf):
    return chunk_texts(dealt(_t(spark, sf, "documents")), "doc_id", "text")


def local_day_counts(spark, sf):
    return _articles(spark, sf).groupBy(local_day(F.col("fetched_at")).cast("string").alias("day")).agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


def day_articles(spark, sf):
    start, end = day_bounds(F.lit(DAY).cast("date"))
    return _articles(spark, sf).where((F.col("fetched_at") >= start) & (F.col("fetched_at") < end)).select("pos", "source")


def coverage_by_source(spark, sf):
    start, end = day_bounds(F.lit(DAY).cast("date"))
    out = source_coverage(_articles(spark, sf), "source", "fetched_at", start, end, row_limit=20)
    return out.select("source", "scanned", "discovered", F.unix_micros("oldest").alias("oldest_us"), F.unix_micros("latest").alias("latest_us"), "complete")


def _admitted(spark, sf):
    rows = dealt(_articles(spark, sf).select("pos", "source", "title", "excluded_reason", "body")).withColumn("clean", clean_text(F.coalesce("body", F.lit(""))))
    return rows.withColumn("a", admission(F.col("title"), F.col("clean"), F.col("excluded_reason"))).select("pos", "source", "a.outcome", "a.reason")


def admission_ladder(spark, sf):
    return _admitted(spark, sf)


def outcomes_by_source(spark, sf):
    return body_outcomes(_admitted(spark, sf), "source", "outcome", 2)


def longest_body(spark, sf):
    rows = _articles(spark, sf)
    keys = [normalize_url(F.coalesce("url", F.lit(""))), normalize_title(F.coalesce("title", F.lit("")))]
    return best_per_key(rows.select("pos", "url", "title", F.length(F.coalesce("body", F.lit(""))).alias("n")), keys, [F.col("n")]).select("pos", "n")


def first_seen_addresses(spark, sf):
    rows = _articles(spark, sf).where("trim(url) <> ''").select("pos", "url")
    return first_addresses(rows).select("pos")


def either_key_dedupe(spark, sf):
    rows = _keyed_articles(spark, sf).select("pos", "url_key", "title_key", F.length(F.coalesce("body", F.lit(""))).alias("n"))
    return either_key(rows, [F.col("url_key"), F.col("title_key")], [F.col("n")]).select("pos")


def existing_match(spark, sf):
    return two_key_match(_keyed_articles(spark, sf).select("pos", "url_key", "title_key"), _keyed_records(spark, sf), ("url_key", "title_key"), "scan_pos", "record_id").select("pos", "matched")


def unseen_articles(spark, sf):
    return unseen(_keyed_articles(spark, sf).select("pos", "url_key", "title_key"), _keyed_records(spark, sf).select("url_key", "title_key"), ("url_key", "title_key")).select("pos")


def record_index(spark, sf):
    return last_per_key(_keyed_records(spark, sf).where("url_key is not null").select("url_key", "scan_pos", "record_id"), ["url_key"], ["scan_pos"])


def upsert_actions(spark, sf):
    rows = _keyed_articles(spark, sf).select("pos", "url_key", "title_key", "title", F.col("source").alias("source_name"))
    records = _keyed_records(spark, sf)
    return upsert_plan(rows, records, ("url_key", "title_key"), "scan_pos", "record_id", {"title": "title", "source_name": "source_name"}).select("pos", "record_id", "action")


def retry_queue(spark, sf):
    rows = _keyed_articles(spark, sf).where("url_key is not null")
    last = 12
    current = rows.where(F.col("batch_no") == last).select("url_key", "pos")
    retries = rows.where((F.col("batch_no") < last) & (F.col("batch_no") >= last - 2) & F.col("ai_result").isNull()).select("url_key", "pos")
    return with_retries(current, retries, "url_key").select("pos")


def days_without_articles(spark, sf):
    """Days of a quarter without an article of one source."""
    have = _articles(spark, sf).where(F.col("source") == QUIET).select(local_day(F.col("fetched_at")).alias("day"))
    return missing_days(F.lit("2026-01-01").cast("date"), F.lit("2026-03-31").cast("date"), have, "day").select(F.col("day").cast("string").alias("day"))


def addresses_not_written(spark, sf):
    return missing_keys(_keyed_articles(spark, sf).where("url_key is not null"), _keyed_records(spark, sf).where("url_key is not null"), "url_key")


def written_differently(spark, sf):
    """Addresses of articles whose record is missing or has another title or source."""
    rows = _keyed_articles(spark, sf).where("url_key is not null").select("url_key", "pos", "title", F.col("source").alias("source_name"))
    records = _keyed_records(spark, sf).where("url_key is not null").select("url_key", "scan_pos", "title", "source_name")
    return invalid_after_write(last_per_key(rows, ["url_key"], ["pos"]), last_per_key(records, ["url_key"], ["scan_pos"]), "url_key", ["title", "source_name"])


def round_robin_digest(spark, sf):
    rows = _articles(spark, sf).select("pos", "daily_date", "source", "published_at", "url")
    return round_robin(rows, "daily_date", "source", [F.desc("published_at"), F.desc("url"), F.asc("pos")], SOURCE_ORDER, PRIMARY).select("pos", F.col("daily_date").cast("string").alias("day"), "place")


def plain_round_robin(spark, sf):
    rows = _articles(spark, sf).select("pos", "daily_date", "source")
    return round_robin(rows, "daily_date", "source", [F.desc("pos")], SOURCE_ORDER, None, drop_unknown=True).select("pos", F.col("daily_date").cast("string").alias("day"), "place")


def daily_top(spark, sf):
    return round_robin_digest(spark, sf).where("place <= 5")


def ranks_in_source(spark, sf):
    rows = _articles(spark, sf).select("pos", "source", "fetched_at")
    return ranked(rows, ["source"], [F.desc("fetched_at"), F.asc("pos")]).select("pos", "rank")


def write_batches_of_50(spark, sf):
    return batches(_articles(spark, sf).select("pos"), [F.asc("pos")], 50).select("pos", F.col("batch").cast("long").alias("batch"))


def verdicts(spark, sf):
    r = F.col("ai_result")
    rows = _articles(spark, sf).where("ai_result is not null")
    tidy = tidy_verdict(r["reason"], r["event_key"], r["topics"], r["unique_points"], r["category"], CATEGORIES, "社会")
    out = rows.select("pos", score_total(r["scores"]).cast("long").alias("total"), is_valuable(r["status"], r["scores"]).alias("valuable"), tidy.alias("t"))
    return out.select("pos", "total", "valuable", "t.reason", "t.event_key", F.array_join("t.topics", "|").alias("topics"), F.array_join("t.points", "|").alias("points"), "t.category")


def verdict_status_counts(spark, sf):
    rows = _articles(spark, sf).withColumn("status", F.coalesce("ai_result.status", F.lit("none")))
    return status_counts(rows, "source", "status", ["selected", "reject", "none"])


def record_content_checks(spark, sf):
    """Numbers are checked against the longest article of the record's address, else of its title; a record without an article has nothing to check them against."""
    numbers = F.array_join(F.array_sort(numbers_with_units(F.concat_ws("\n", "title", "body"))), "\n")
    articles = dealt(_articles(spark, sf).where("body is not null").select("url", "title", "body"))
    articles = stored(_with_keys(articles, "url", "title").select("url_key", "title_key", F.struct(F.length("body").alias("n"), numbers.alias("numbers")).alias("known")), "known")
    longest = lambda k: articles.where(F.col(k).isNotNull()).groupBy(k).agg(F.max("known").alias(f"by_{k}"))
    rows = stored(_keyed_records(spark, sf).where("content is not null").select("record_id", "content", "url_key", "title_key"), "contents")
    rows = rows.join(longest("url_key"), "url_key", "left").join(longest("title_key"), "title_key", "left")
    known = F.coalesce("by_url_key.numbers", "by_title_key.numbers", "content")
    return rows.select("record_id", summary_problem(F.col("content"), known, 80, 300, 3).alias("problem"))


def source_staleness(spark, sf):
    rows = _articles(spark, sf).groupBy("source").agg(F.lit(True).alias("ok"), F.count("*").alias("scanned"), F.count_if(local_day(F.col("fetched_at")) == F.lit(TODAY).cast("date")).alias("discovered"), F.max(local_day(F.col("fetched_at"))).alias("latest_day"))
    return staleness(rows, F.lit(TODAY).cast("date"), F.lit("2026-12-31").cast("date")).select("all_ok", "all_scanned", "discovered", F.col("latest_day").cast("string").alias("latest_day"), "stale")


def records_audit(spark, sf):
    records = _keyed_records(spark, sf)
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    return table_audit(records, "status", F.col("content"), {"title": blank("title"), "content": blank("content")}, {"url": F.col("url_key"), "title": F.col("title_key")})


def latest_of_source(spark, sf):
    rows = _articles(spark, sf).select("source", "pos", F.unix_micros("fetched_at").alias("fetched_us"))
    return latest(rows, "source", "fetched_us", ["pos"])


def run_report(spark, sf):
    start, end = day_bounds(F.lit(DAY).cast("date"))
    coverage = source_coverage(_articles(spark, sf), "source", "fetched_at", start, end)
    rows = coverage.join(outcomes_by_source(spark, sf), "source")
    return run_totals(rows, ["scanned", "discovered", "ok", "excluded", "failed"])


def days_backfilled(spark, sf):
    return backfill_days(_t(spark, sf, "records")).select("record_id", "daily_ms", "filled")


def _titles(spark, sf):
    return _articles(spark, sf).where("url is not null").select("url", "title")


def titles_repaired(spark, sf):
    return repair_titles(_t(spark, sf, "records"), _titles(spark, sf)).select("record_id", "title", "repaired")


def migration_audit(spark, sf):
    records = stored(_t(spark, sf, "records"), "records")
    after = repair_titles(records, _titles(spark, sf))
    return audit_migration(records, after, "record_id", [])


def event_clusters(spark, sf):
    rows = _articles(spark, sf).where("ai_result is not null")
    return cluster_events(rows).select("pos", "leader", "status")


_LONG = "length(coalesce(body, ''))"
_START, _END = f"(TIMESTAMP '{DAY} 00:00:00' - INTERVAL 8 HOUR)", f"(TIMESTAMP '{DAY} 00:00:00' + INTERVAL 16 HOUR)"
_F = S.utc("fetched_at")
_ADMITTED = f"""SELECT pos, source, CASE WHEN why <> '' THEN 'excluded' WHEN text = '' THEN 'error' WHEN length(text) < 400 THEN 'excluded' WHEN promo THEN 'excluded' ELSE 'ok' END AS outcome,
  CASE WHEN why <> '' THEN why WHEN text = '' THEN 'empty' WHEN length(text) < 400 THEN 'short' WHEN promo THEN 'promotion' ELSE '' END AS reason
FROM (SELECT pos, source, text, coalesce(nullif(excluded_reason, ''), nullif(list_filter({S.words(TITLE_EXCLUSIONS)}, lambda w: contains(replace(title, ' ', ''), w))[1], ''), '') AS why,
  len(list_filter({S.words(PROMOTION_WORDS)}, lambda w: contains(coalesce(title, '') || chr(10) || text[1:800], w))) > 0 AS promo
  FROM (SELECT *, {S.clean("coalesce(body, '')")} AS text FROM articles))"""
_INDEX = lambda k: f"SELECT {k}, arg_max(record_id, scan_pos) AS record_id, arg_max(title, scan_pos) AS title, arg_max(source_name, scan_pos) AS source_name, true AS there FROM ({R_KEYS}) WHERE {k} IS NOT NULL GROUP BY {k}"
_ORDER = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SOURCE_ORDER)) + f" ELSE {len(SOURCE_ORDER)} END"
_DIGEST = f"""WITH r AS (SELECT pos, daily_date, source, row_number() OVER (PARTITION BY daily_date, source ORDER BY published_at DESC NULLS LAST, url DESC NULLS LAST, pos) AS rk, {_ORDER} AS o FROM articles WHERE daily_date IS NOT NULL AND source IS NOT NULL),
t AS (SELECT *, CASE WHEN source = '{PRIMARY}' THEN rk ELSE row_number() OVER (PARTITION BY daily_date, source = '{PRIMARY}' ORDER BY rk, o, source) END AS turn FROM r)
SELECT pos, CAST(daily_date AS VARCHAR) AS day, row_number() OVER (PARTITION BY daily_date ORDER BY turn, source <> '{PRIMARY}') AS place FROM t"""
_SENTENCES = f"""SELECT pos, section, position, sentence FROM (SELECT pos, section, unnest(range(len(parts))) AS position, unnest(parts) AS sentence FROM (SELECT pos, section, list_filter(list_transform(string_split(regexp_replace(line, '([。！？；])', '\\1' || chr(1), 'g'), chr(1)), lambda p: {S.strip('p')}), lambda p: p <> '') AS parts
FROM (SELECT pos, unnest(range(len(ls))) AS section, unnest(ls) AS line FROM (SELECT pos, list_filter(list_transform(string_split_regex({S.clean('body')}, '\\n+'), lambda s: {S.strip('s')}), lambda s: s <> '') AS ls FROM articles WHERE body IS NOT NULL)))) WHERE length(sentence) BETWEEN 12 AND 600"""
_BLANK = lambda c: f"trim(coalesce({c}, '')) = ''"
_CELL = f"CASE WHEN starts_with({S.strip('url_cell')}, '{{') THEN coalesce(nullif(json_extract_string(url_cell, '$.link'), ''), nullif(json_extract_string(url_cell, '$.url'), ''), json_extract_string(url_cell, '$.text'), url_cell) ELSE {S.strip('url_cell')} END"
_REPAIR = f"""SELECT r.record_id, CASE WHEN {_BLANK('r.title')} AND better IS NOT NULL THEN better ELSE r.title END AS title, {_BLANK('r.title')} AND better IS NOT NULL AS repaired FROM (SELECT r.*, coalesce(CASE WHEN NOT {_BLANK('r.backup_title')} THEN r.backup_title END, k.found) AS better FROM (SELECT *, {_CELL} AS cell FROM records) r
LEFT JOIN (SELECT {S.url_key('url')} AS u, min(title) AS found FROM articles WHERE url IS NOT NULL AND NOT {_BLANK('title')} GROUP BY 1) k ON {S.url_key('r.cell')} = k.u) r"""
_TOTAL = "(CASE WHEN " + " AND ".join(f"coalesce(s.{k} BETWEEN 0 AND 5, false)" for k in ("importance", "information_gain", "social_impact", "actionability", "evidence_density")) + " THEN s.importance + s.information_gain + s.social_impact + s.actionability + s.evidence_density END)"
_SCORED = f"""SELECT a.pos, x.section, x.position, x.sentence, CAST(3 * len(list_filter(terms, lambda t: contains(sentence, t))) + CASE WHEN regexp_matches(sentence, '\\p{{Nd}}') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(sentence, '增长|下降|发布|推出|收购|融资|监管|禁止|开放|调整|裁员|上调|下调|新增|减少') THEN 2 ELSE 0 END
+ CASE WHEN regexp_matches(sentence, '公司|集团|平台|政府|委员会|部门|银行|机构|国家|市场|行业|企业|品牌') THEN 2 ELSE 0 END + CASE WHEN position < 3 THEN 2 ELSE 0 END + CASE WHEN regexp_matches(sentence, '因此|导致|影响|意味着|相比|但|同时|预计|可能|风险|机会') THEN 1 ELSE 0 END AS INTEGER) AS score
FROM ({_SENTENCES}) x JOIN (SELECT pos, list_distinct(regexp_extract_all({S.title_key("coalesce(title, '')")}, '[a-z0-9]{{2,}}|[一-鿿]{{2,6}}')) AS terms FROM articles) a USING (pos)"""
_COVERAGE = f"SELECT source, count(*) AS scanned, count(*) FILTER (WHERE {_F} >= {_START} AND {_F} < {_END}) AS discovered, min({_F}) AS oldest, max({_F}) AS latest FROM articles GROUP BY source"
_OUTCOMES = f"SELECT source, count(*) FILTER (WHERE outcome = 'ok') AS ok, count(*) FILTER (WHERE outcome = 'excluded') AS excluded, count(*) FILTER (WHERE outcome = 'error') AS failed FROM ({_ADMITTED}) GROUP BY source"

ORACLES: dict[str, str] = {
    "url_keys": f"SELECT pos, {S.url_key('url')} AS url_key FROM articles",
    "title_keys": f"SELECT pos, {S.title_key('title')} AS title_key FROM articles",
    "clean_texts": f"SELECT pos, {S.clean('body')} AS clean, {S.visible('body')} AS chars FROM articles WHERE body IS NOT NULL",
    "content_hashes": f"SELECT pos, sha256({S.title_key('title')} || chr(10) || {S.url_key('url')} || chr(10) || {S.clean('body')}) AS hash FROM articles WHERE title IS NOT NULL AND url IS NOT NULL AND body IS NOT NULL",
    "number_tokens": f"SELECT pos, coalesce(array_to_string(list_sort({S.numbers('body')}), ' '), '') AS numbers FROM articles",
    "sentence_split": f"SELECT pos, CAST(section AS INTEGER) AS section, CAST(position AS INTEGER) AS position, sentence FROM ({_SENTENCES})",
    "best_section_sentences": f"SELECT pos, CAST(section AS INTEGER) AS section, CAST(position AS INTEGER) AS position, score FROM (SELECT *, row_number() OVER (PARTITION BY pos, section ORDER BY score DESC, position) AS rn FROM ({_SCORED})) WHERE rn = 1",
    "local_day_counts": f"SELECT CAST({S.local_day('fetched_at')} AS VARCHAR) AS day, count(*) AS n, count(DISTINCT source) AS sources FROM articles GROUP BY 1",
    "day_articles": f"SELECT pos, source FROM articles WHERE {_F} >= {_START} AND {_F} < {_END}",
    "coverage_by_source": f"SELECT source, scanned, discovered, epoch_us(oldest) AS oldest_us, epoch_us(latest) AS latest_us, oldest < {_START} OR scanned < 20 AS complete FROM ({_COVERAGE})",
    "admission_ladder": _ADMITTED,
    "outcomes_by_source": f"SELECT *, failed >= 2 AND ok = 0 AS all_failed FROM ({_OUTCOMES})",
    "longest_body": f"SELECT pos, n FROM (SELECT pos, {_LONG} AS n, row_number() OVER (PARTITION BY {S.url_key("coalesce(url, '')")}, {S.title_key("coalesce(title, '')")} ORDER BY {_LONG} DESC, pos) AS rn FROM articles) WHERE rn = 1",
    "first_seen_addresses": f"SELECT min(pos) AS pos FROM articles WHERE trim(url) <> '' GROUP BY {S.url_key('url')}",
    "either_key_dedupe": f"""WITH RECURSIVE o AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {_LONG} DESC, pos) AS k, pos, list_filter([CASE WHEN url_key IS NOT NULL THEN hash('u' || url_key) END, CASE WHEN title_key IS NOT NULL THEN hash('t' || title_key) END], lambda x: x IS NOT NULL) AS cells FROM ({A_KEYS})),
r AS (SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS pos, false AS kept, CAST([] AS UBIGINT[]) AS seen UNION ALL SELECT o.k, o.pos, NOT list_has_any(seen, cells), CASE WHEN list_has_any(seen, cells) THEN seen ELSE list_concat(seen, cells) END FROM r JOIN o ON o.k = r.k + 1) SELECT pos FROM r WHERE kept""",
    "existing_match": f"SELECT a.pos, coalesce(u.record_id, t.record_id) AS matched FROM ({A_KEYS}) a LEFT JOIN ({_INDEX('url_key')}) u ON a.url_key = u.url_key LEFT JOIN ({_INDEX('title_key')}) t ON a.title_key = t.title_key",
    "unseen_articles": f"SELECT pos FROM ({A_KEYS}) a WHERE NOT EXISTS (SELECT 1 FROM ({R_KEYS}) r WHERE r.url_key = a.url_key) AND NOT EXISTS (SELECT 1 FROM ({R_KEYS}) r WHERE r.title_key = a.title_key)",
    "record_index": f"SELECT url_key, max(scan_pos) AS scan_pos, arg_max(record_id, scan_pos) AS record_id FROM ({R_KEYS}) WHERE url_key IS NOT NULL GROUP BY url_key",
    "upsert_actions": f"SELECT a.pos, CASE WHEN u.there THEN u.record_id ELSE t.record_id END AS record_id, CASE WHEN u.there IS NULL AND t.there IS NULL THEN 'insert' WHEN a.title IS NOT DISTINCT FROM (CASE WHEN u.there THEN u.title ELSE t.title END) AND a.source IS NOT DISTINCT FROM (CASE WHEN u.there THEN u.source_name ELSE t.source_name END) THEN 'unchanged' ELSE 'update' END AS action FROM ({A_KEYS}) a LEFT JOIN (SELECT url_key, max_by(record_id, scan_pos) AS record_id, (max_by(struct_pack(t := title), scan_pos)).t AS title, max_by(source_name, scan_pos) AS source_name, true AS there FROM ({R_KEYS}) WHERE url_key IS NOT NULL GROUP BY url_key) u ON a.url_key = u.url_key LEFT JOIN (SELECT title_key, max_by(record_id, scan_pos) AS record_id, (max_by(struct_pack(t := title), scan_pos)).t AS title, max_by(source_name, scan_pos) AS source_name, true AS there FROM ({R_KEYS}) WHERE title_key IS NOT NULL GROUP BY title_key) t ON a.title_key = t.title_key",
    "retry_queue": f"WITH a AS ({A_KEYS}), c AS (SELECT url_key, pos FROM a WHERE url_key IS NOT NULL AND batch_no = 12) SELECT pos FROM c UNION ALL SELECT pos FROM a WHERE url_key IS NOT NULL AND batch_no < 12 AND batch_no >= 10 AND ai_result IS NULL AND url_key NOT IN (SELECT url_key FROM c)",
    "days_without_articles": f"SELECT CAST(d AS VARCHAR) AS day FROM (SELECT CAST(unnest(generate_series(DATE '2026-01-01', DATE '2026-03-31', INTERVAL 1 DAY)) AS DATE) AS d) WHERE d NOT IN (SELECT {S.local_day('fetched_at')} FROM articles WHERE source = '{QUIET}')",
    "addresses_not_written": f"SELECT DISTINCT url_key FROM ({A_KEYS}) WHERE url_key IS NOT NULL AND url_key NOT IN (SELECT url_key FROM ({R_KEYS}) WHERE url_key IS NOT NULL)",
    "written_differently": f"SELECT a.url_key FROM (SELECT url_key, arg_max(struct_pack(t := title, s := source), pos) AS w FROM ({A_KEYS}) WHERE url_key IS NOT NULL GROUP BY url_key) a LEFT JOIN (SELECT url_key, arg_max(struct_pack(t := title, s := source_name), scan_pos) AS w FROM ({R_KEYS}) WHERE url_key IS NOT NULL GROUP BY url_key) r USING (url_key) WHERE a.w IS DISTINCT FROM r.w",
    "round_robin_digest": _DIGEST,
    "plain_round_robin": f"SELECT pos, CAST(daily_date AS VARCHAR) AS day, row_number() OVER (PARTITION BY daily_date ORDER BY rk, o) AS place FROM (SELECT pos, daily_date, row_number() OVER (PARTITION BY daily_date, source ORDER BY pos DESC) AS rk, {_ORDER} AS o FROM articles WHERE daily_date IS NOT NULL) WHERE o < {len(SOURCE_ORDER)}",
    "daily_top": f"SELECT * FROM ({_DIGEST}) WHERE place <= 5",
    "ranks_in_source": "SELECT pos, row_number() OVER (PARTITION BY source ORDER BY fetched_at DESC NULLS LAST, pos) AS rank FROM articles",
    "write_batches_of_50": "SELECT pos, CAST(floor((row_number() OVER (ORDER BY pos) - 1) / 50) AS BIGINT) AS batch FROM articles",
    "verdicts": f"SELECT pos, CAST({_TOTAL} AS BIGINT) AS total, coalesce((r.status = 'selected' AND s.evidence_density >= 3 AND s.information_gain >= 3 AND {_TOTAL} >= 13) OR (s.information_gain >= 4 AND s.evidence_density >= 3), false) AND {_TOTAL} IS NOT NULL AS valuable, coalesce(r.reason, '')[1:30] AS reason, coalesce(r.event_key, '')[1:40] AS event_key, coalesce(array_to_string(list_transform(r.topics, lambda t: t[1:20])[1:3], '|'), '') AS topics, coalesce(array_to_string(r.unique_points[1:3], '|'), '') AS points, CASE WHEN r.category IN ('政策', '成长', '财经') THEN r.category ELSE '社会' END AS category FROM (SELECT pos, ai_result AS r, ai_result.scores AS s FROM articles WHERE ai_result IS NOT NULL)",
    "verdict_status_counts": "SELECT source, count(*) FILTER (WHERE st = 'selected') AS selected, count(*) FILTER (WHERE st = 'reject') AS reject, count(*) FILTER (WHERE st = 'none') AS none FROM (SELECT source, coalesce(ai_result.status, 'none') AS st FROM articles) GROUP BY source",
    "record_content_checks": f"""WITH k AS (SELECT url_key, title_key, struct_pack(n := length(body), x := array_to_string(list_sort({S.numbers("concat_ws(chr(10), title, body)")}), chr(10))) AS v FROM ({A_KEYS}) WHERE body IS NOT NULL), u AS (SELECT url_key, max(v) AS v FROM k WHERE url_key IS NOT NULL GROUP BY 1), t AS (SELECT title_key, max(v) AS v FROM k WHERE title_key IS NOT NULL GROUP BY 1)
SELECT record_id, CASE WHEN content = '证据不足，无法生成可靠摘要' THEN 'insufficient' WHEN contains(content, '相关时间') OR contains(content, '相关数值') THEN 'placeholder' WHEN {S.visible('content')} NOT BETWEEN 80 AND 300 THEN 'length' WHEN len(list_filter(list_transform(string_split_regex(content, '\\n+'), lambda p: {S.strip('p')}), lambda p: p <> '')) <> 3 THEN 'paragraphs'
WHEN len(list_filter({S.numbers('content')}, lambda x: NOT list_contains(known, x))) > 0 THEN 'number' ELSE '' END AS problem FROM (SELECT r.record_id, r.content, {S.numbers("coalesce(u.v.x, t.v.x, r.content)")} AS known FROM ({R_KEYS}) r LEFT JOIN u ON u.url_key = r.url_key LEFT JOIN t ON t.title_key = r.title_key WHERE r.content IS NOT NULL)""",
    "source_staleness": f"SELECT true AS all_ok, bool_and(n > 0) AS all_scanned, CAST(sum(d) AS BIGINT) AS discovered, CAST(max(l) AS VARCHAR) AS latest_day, bool_and(n > 0) AND sum(d) = 0 AND max(l) < DATE '{TODAY}' AND DATE '{TODAY}' < DATE '2026-12-31' AS stale FROM (SELECT source, count(*) AS n, count(*) FILTER (WHERE {S.local_day('fetched_at')} = DATE '{TODAY}') AS d, max({S.local_day('fetched_at')}) AS l FROM articles GROUP BY source)",
    "records_audit": f"WITH r AS ({R_KEYS}) SELECT 'status ' || coalesce(status, '') AS measure, count(*) AS value FROM r GROUP BY 1 UNION ALL SELECT 'rows', count(*) FROM r UNION ALL SELECT 'shortest', min(nullif(length(coalesce(content, '')), 0)) FROM r UNION ALL SELECT 'longest', max(nullif(length(coalesce(content, '')), 0)) FROM r UNION ALL SELECT 'missing title', count(*) FILTER (WHERE {_BLANK('title')}) FROM r UNION ALL SELECT 'missing content', count(*) FILTER (WHERE {_BLANK('content')}) FROM r UNION ALL SELECT 'duplicate url', coalesce(count(url_key) - count(DISTINCT url_key), 0) FROM r UNION ALL SELECT 'duplicate title', coalesce(count(title_key) - count(DISTINCT title_key), 0) FROM r",
    "latest_of_source": "SELECT source, max_by(pos, struct_pack(t := epoch_us(fetched_at), p := pos)) AS pos FROM articles GROUP BY source",
    "run_report": f"SELECT CAST(sum(scanned) AS BIGINT) AS scanned, CAST(sum(discovered) AS BIGINT) AS discovered, CAST(sum(ok) AS BIGINT) AS ok, CAST(sum(excluded) AS BIGINT) AS excluded, CAST(sum(failed) AS BIGINT) AS failed, bool_or(NOT (oldest < {_START}) OR failed >= 2 AND ok = 0) AS partial FROM ({_COVERAGE}) JOIN ({_OUTCOMES}) USING (source)",
    "days_backfilled": "SELECT record_id, coalesce(daily_ms, CAST(epoch_ms(CAST(CAST(make_timestamp(published_ms * 1000) + INTERVAL 8 HOUR AS DATE) AS TIMESTAMP) - INTERVAL 8 HOUR) AS BIGINT)) AS daily_ms, daily_ms IS NULL AND published_ms IS NOT NULL AS filled FROM records",
    "titles_repaired": _REPAIR,
    "migration_audit": f"SELECT record_id, 'title' AS field FROM ({_REPAIR}) WHERE repaired",
}
QUERIES = {f.__name__: f for f in (
    url_keys, title_keys, clean_texts, content_hashes, number_tokens, sentence_split, best_section_sentences, evidence, text_chunks, local_day_counts, day_articles, coverage_by_source, admission_ladder,
    outcomes_by_source, longest_body, first_seen_addresses, either_key_dedupe, existing_match, unseen_articles, record_index, upsert_actions, retry_queue, days_without_articles, addresses_not_written,
    written_differently, round_robin_digest, plain_round_robin, daily_top, ranks_in_source, write_batches_of_50, verdicts, verdict_status_counts, record_content_checks, source_staleness, records_audit,
    latest_of_source, run_report, days_backfilled, titles_repaired, migration_audit, event_clusters,
)}
