"""Stages that ask a model, as tables: the cache first, then one question and one correction for each row.

The model is a batch function that is given in (``Ask``); nothing here knows a service. Answers are written to the
shared folder as they come, so no plan asks twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import bound, clean_answer, clean_text, json_object, numbers_with_units, visible_chars
from newsloom.operators.cache import last_writes
from newsloom.operators.evidence import fitted_summary
from newsloom.operators.rules import SCORES, is_valuable, score_total, summary_problem, tidy_verdict
from newsloom.session import stored

#: Answers to a list of rows, in their order. May raise one of the two errors below; any other error is the caller's fault.
Ask = Callable[[list[dict[str, Any]]], list[str | None]]


class Unsafe(Exception):
    """The model refuses the text."""


class Unavailable(Exception):
    """The model's service does not answer."""


FILTER, SUMMARY = "filter", "summary"
UNSAFE, UNAVAILABLE, MISCOUNTED = "unsafe", "unavailable", "miscounted"


def _answers(ask: Ask, rows: list[dict]) -> list[tuple[str | None, str]]:
    """(answer, error) of each row; a batch that fails is asked again row by row, unless the service is down."""
    try:
        found = ask(rows)
        if len(found) == len(rows):
            return [(a, "") for a in found]
        error = MISCOUNTED
    except Unsafe:
        error = UNSAFE
    except Unavailable:
        return [(None, UNAVAILABLE)] * len(rows)
    return [(None, error)] if len(rows) == 1 else [x for r in rows for x in _answers(ask, [r])]


def asked(rows: DataFrame, ask: Ask, size: int = 12) -> DataFrame:
    """The rows with the model's answer (``raw``) and ``error``: unsafe, unavailable, miscounted or empty.

    Rows are asked in batches of ``size`` where they lie; nothing is shuffled or collected.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            cells = b.to_pylist()
            found = [x for k in range(0, len(cells), size) for x in _answers(ask, cells[k : k + size])]
            answers = [pa.array([x[k] for x in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *answers], [*b.schema.names, "raw", "error"])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes), "raw string", "error string"])
    return rows.mapInArrow(run, schema)


_RAW = "struct<status: string, reason: string, event_key: string, topics: array<string>, unique_points: array<string>, category: string, scores: struct<" + ", ".join(f"{s}: string" for s in SCORES) + ">>"


def read_verdict(raw: Column, selected: str, rejected: str, categories: list[str], default: str, by_status: bool = False) -> Column:
    """A screening answer as struct: problem (json, status, scores, score, or empty) and the fields of the verdict.

    Scores may be numbers or text and are cut to whole ones. Texts are cleaned and kept within their bounds, an
    unknown category is ``default``. A verdict is valuable by ``is_valuable``, or with ``by_status`` by its status
    alone; one that is not has the status ``rejected``.
    """
    return bound(json_object(raw), lambda text: bound(F.from_json(text, _RAW), lambda v: _read(text, v, selected, rejected, categories, default, by_status)))


def _read(text: Column, v: Column, selected: str, rejected: str, categories: list[str], default: str, by_status: bool) -> Column:
    def judged(scores: Column, tidy: Column) -> Column:
        total = score_total(scores)
        problem = (
            F.when(text.isNull(), "json").when(~F.coalesce(v["status"].isin(selected, rejected), F.lit(False)), "status")
            .when(v["scores"].isNull(), "scores").when(total.isNull(), "score").otherwise("")
        )
        valuable = F.when(F.lit(by_status), v["status"] == selected).otherwise(is_valuable(v["status"], scores, selected))
        fields = F.struct(
            F.when(valuable, v["status"]).otherwise(F.lit(rejected)).alias("status"), valuable.alias("valuable"), tidy["reason"].alias("reason"), tidy["event_key"].alias("event_key"),
            tidy["topics"].alias("topics"), tidy["points"].alias("unique_points"), tidy["category"].alias("category"), scores.alias("scores"), total.alias("score_total"),
            F.lit(False).alias("invalid_ai"), F.lit(False).alias("content_safety"),
        )
        return F.struct(problem.alias("problem"), fields.alias("verdict"))

    scores = F.struct(*(F.floor(v["scores"][s].try_cast("double")).cast("int").alias(s) for s in SCORES))
    tidy = tidy_verdict(clean_text(v["reason"]), clean_text(v["event_key"]), v["topics"], v["unique_points"], v["category"], categories, default)
    return bound(scores, lambda s: bound(tidy, lambda t: judged(s, t)))


def _empty_verdict(status: str, reason: str, like: str, **flags: bool) -> Column:
    """A rejected verdict without scores, in the type ``like``."""
    cells = {"status": F.lit(status), "valuable": F.lit(False), "reason": F.lit(reason), **{k: F.lit(v) for k, v in {"invalid_ai": False, "content_safety": False, **flags}.items()}}
    return F.from_json(F.to_json(F.struct(*(c.alias(n) for n, c in cells.items()))), like)


def _twice(rows: DataFrame, ask: Ask, stage: str, problem: Callable[[Column], Column], size: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with raw, error and problem after one question and, for those whose answer has a problem that is not in
    ``keep``, one correction that is told the answer and the problem."""
    blank = rows.withColumns({"stage": F.lit(stage), "previous": F.lit(None).cast("string"), "previous_problem": F.lit(None).cast("string")})
    first = stored(asked(blank, ask, size).withColumn("problem", F.when(F.col("error") == "", problem(F.col("raw"))).otherwise("")), f"{stage}-first")
    again = (F.col("problem") != "") & ~F.col("problem").isin(*keep)
    wrong = first.where(again).drop("previous", "previous_problem").withColumnsRenamed({"raw": "previous", "problem": "previous_problem"}).drop("error")
    second = asked(wrong.select(*blank.columns), ask, size).withColumn("problem", F.when(F.col("error") == "", problem(F.col("raw"))).otherwise(""))
    return stored(first.where(~again).unionByName(second).drop("stage", "previous", "previous_problem"), f"{stage}-answers")


def analyse(
    rows: DataFrame, cache: DataFrame, ask: Ask, version: str, selected: str = "selected", rejected: str = "reject", categories: tuple[str, ...] = (), default: str = "",
    least: int = 300, most: int = 500, parts: int = 3, by_status: bool = False, retry_unsafe: bool = False, size: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """The two stages over (key, known, screening, evidence, ...): results and the writes for the cache.

    A stage that the cache holds in ``version`` is not asked. Else a screening answer is read (``read_verdict``) and
    corrected once; one that stays unreadable is a rejection by format. Valuable rows get a summary, checked by
    ``summary_problem`` against ``known`` (title, time and evidence) and corrected once; one without evidence, or wrong
    twice, is a rejection too. A text that the model refuses is a rejection, or with ``retry_unsafe`` is left for
    another try, as are all rows whose service is down: they have state waiting and nothing is written for them.

    Results have key, state (done or waiting), error, hits (stages from the cache), the verdict's fields, core_content,
    summary_chars, core_facts (the first three lines of the evidence) and key_numbers. Keys must be distinct; further
    columns of the rows reach ``ask``, and none of them may be called as a column that is added here.
    """
    own = last_writes(cache.where(F.col("stage_version") == version))
    own = own.groupBy("cache_key").agg(*(F.max(F.when(F.col("stage") == s, F.col("result_json"))).alias(f"cached_{s}") for s in (FILTER, SUMMARY)))
    joined = stored(rows.join(own, rows["key"] == own["cache_key"], "left").drop("cache_key"), "rows")

    def read(raw: Column) -> Column:
        return read_verdict(raw, selected, rejected, list(categories), default, by_status)

    answers = _twice(joined.where("cached_filter is null"), ask, FILTER, lambda raw: read(raw)["problem"], size)
    verdict = answers.select("*", read(F.col("raw"))["verdict"].alias("verdict"))
    like = verdict.schema["verdict"].dataType.simpleString()
    screened = verdict.withColumn(
        "verdict",
        F.when(F.col("error") == UNSAFE, _empty_verdict(rejected, "refused", like, content_safety=True))
        .when((F.col("problem") != "") | (F.col("error") == MISCOUNTED), _empty_verdict(rejected, "format", like, invalid_ai=True))
        .otherwise(F.col("verdict")),
    )
    waiting = (F.col("error") == UNAVAILABLE) | (F.lit(retry_unsafe) & (F.col("error") == UNSAFE))
    screened = screened.withColumn("state", F.when(waiting, "waiting").otherwise("done")).withColumn("hits", F.lit(0)).drop("raw", "problem")
    known = joined.where("cached_filter is not null").withColumns({"error": F.lit(""), "verdict": F.from_json("cached_filter", like), "state": F.lit("done"), "hits": F.lit(1)})
    screened = stored(screened.unionByName(known.select(*screened.columns)), "screened")

    chosen = (F.col("state") == "done") & F.coalesce(F.col("verdict.valuable"), F.lit(False))
    to_ask = screened.where(chosen & F.col("cached_summary").isNull()).drop("error")

    def wrong(raw: Column) -> Column:
        return summary_problem(fitted_summary(clean_answer(raw)), F.col("known"), least, most, parts)

    told = _twice(to_ask, ask, SUMMARY, wrong, size, keep=("insufficient",))
    text = fitted_summary(clean_answer(F.col("raw")))
    good = (F.col("error") == "") & (F.col("problem") == "")
    summary = F.struct(
        F.when(good, F.lit(selected)).otherwise(F.lit(rejected)).alias("status"),
        F.when(~good, F.when(F.col("error") == UNSAFE, "refused").otherwise(F.concat(F.lit("summary: "), F.when(F.col("problem") != "", F.col("problem")).otherwise("format")))).alias("reason"),
        F.when(good, text).alias("core_content"), F.when(good, visible_chars(text).cast("int")).alias("summary_chars"),
    )
    told = told.withColumn("summary", summary).withColumn("state", F.when(waiting, "waiting").otherwise("done")).drop("raw", "problem")
    shape = told.schema["summary"].dataType.simpleString()
    remembered = screened.where(chosen & F.col("cached_summary").isNotNull()).withColumn("summary", F.from_json("cached_summary", shape)).withColumn("hits", F.col("hits") + 1)
    none = screened.where(~chosen).withColumn("summary", F.from_json(F.lit(None).cast("string"), shape))
    every = stored(told.unionByName(remembered.select(*told.columns)).unionByName(none.select(*told.columns)), "analysed")

    s, v = F.col("summary"), F.col("verdict")
    content = F.coalesce(s["core_content"], F.lit(""))
    lines = F.filter(F.split(F.coalesce("evidence", F.lit("")), "\n"), lambda x: x != "")
    results = every.select(
        "key", "state", "error", "hits", F.coalesce(s["status"], v["status"]).alias("status"),
        F.coalesce((s["status"] == selected) & (content != ""), F.lit(False)).alias("valuable"), F.coalesce(s["reason"], v["reason"]).alias("reason"),
        v["event_key"].alias("event_key"), v["topics"].alias("topics"), v["unique_points"].alias("unique_points"), v["category"].alias("category"), v["scores"].alias("scores"), v["score_total"].alias("score_total"),
        v["invalid_ai"].alias("invalid_ai"), v["content_safety"].alias("content_safety"), content.alias("core_content"), F.coalesce(s["summary_chars"], F.lit(0)).alias("summary_chars"),
        F.transform(F.slice(lines, 1, 3), lambda x: F.regexp_replace(x, r"^\S+ ", "")).alias("core_facts"), F.array_sort(numbers_with_units(content)).alias("key_numbers"),
    )
    results = results.withColumns({c: F.when(F.col("state") == "done", F.col(c)) for c in ("status", "reason", "event_key", "topics", "unique_points", "category", "scores", "score_total")})
    done = F.col("state") == "done"
    fresh_filter = every.where("cached_filter is null").where(done | F.coalesce(v["valuable"], F.lit(False)))
    writes = fresh_filter.select(F.col("key").alias("cache_key"), F.lit(FILTER).alias("stage"), F.to_json("verdict").alias("result_json"))
    writes = writes.unionByName(every.where(done & F.col("cached_summary").isNull() & s.isNotNull()).select(F.col("key").alias("cache_key"), F.lit(SUMMARY).alias("stage"), F.to_json("summary").alias("result_json")))
    return results, writes.select("cache_key", "stage", F.lit(version).alias("stage_version"), "result_json")


def error_counts(results: DataFrame) -> DataFrame:
    """One row: rows evaluated, refused, of wrong format, rejected for their summary, left waiting, and stages from the cache."""
    c = F.count_if
    return results.agg(
        c(F.col("state") == "done").alias("evaluated"), c(F.coalesce(F.col("content_safety"), F.lit(False))).alias("refused"), c(F.coalesce(F.col("invalid_ai"), F.lit(False))).alias("invalid"),
        c(F.coalesce(F.startswith("reason", F.lit("summary")), F.lit(False))).alias("summary_rejected"), c(F.col("state") == "waiting").alias("waiting"), F.coalesce(F.sum("hits"), F.lit(0)).cast("long").alias("hits"),
    )


def pending_mark(reason: Column, result: Column, status: str = "retry") -> Column:
    """What a row that waits for another try carries: its status, the reason within 1000 characters, and its result or an empty one."""
    return F.struct(F.lit(status).alias("record_status"), F.substring(F.coalesce(reason, F.lit("")), 1, 1000).alias("failure_reason"), F.coalesce(result, F.lit("{}")).alias("result_json"))


def known_text(title: Column, instant: Column, evidence: Column, zone: str = "Asia/Shanghai", spoken: bool = False) -> Column:
    """What a summary may take its numbers from: title, local time in ISO form, with ``spoken`` also the date as it is said
    in Chinese, and the evidence. The session zone must be UTC; the offset is that of a zone without summer time."""
    local = F.from_utc_timestamp(instant, zone)
    shift = (F.unix_timestamp(local) - F.unix_timestamp(instant)) / 60
    offset = F.concat(F.when(shift < 0, "-").otherwise("+"), F.lpad(F.floor(F.abs(shift) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(shift) % 60).cast("int").cast("string"), 2, "0"))
    day = [F.concat(F.year(local).cast("string"), F.lit("年"), F.month(local).cast("string"), F.lit("月"), F.day(local).cast("string"), F.lit("日"))] if spoken else []
    return F.concat_ws("\n", title, F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset), *day, evidence)


def enriched(signals: DataFrame, ask: Ask, key: str = "signal_id", size: int = 12) -> DataFrame:
    """The signals with what the model chose: status (selected, rejected, or skipped for one that it refuses or whose
    answer stays unreadable), keyword, topic and section.

    ``ask`` gets batches and answers each row with a JSON object that has selected, keyword_zh, topic and section; a
    batch that fails is asked row by row.
    """
    answer = F.from_json(json_object(F.col("raw")), "selected boolean, keyword_zh string, topic string, section string")
    found = stored(asked(signals, ask, size), "enriched").withColumn("__nl_a", F.when(F.col("error") == "", answer)).withColumn("__nl_ok", json_object(F.col("raw")).isNotNull())
    yes = F.coalesce(F.col("__nl_a.selected"), F.lit(False))
    status = F.when((F.col("error") != "") | ~F.coalesce("__nl_ok", F.lit(False)), "skipped").when(yes, "selected").otherwise("rejected")
    cut = lambda c, n: F.when(yes, F.substring(clean_text(F.coalesce(F.col(f"__nl_a.{c}"), F.lit(""))), 1, n))
    return found.select(key, status.alias("status"), "error", cut("keyword_zh", 100).alias("keyword"), cut("topic", 40).alias("topic"), cut("section", 40).alias("section"))

