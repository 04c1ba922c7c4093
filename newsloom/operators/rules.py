"""Admission of bodies and checks of verdicts, summaries and cached results, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import PROMOTION_WORDS, bound, excluded_title, has_any, numbers_with_units, plain_numbers, strip, visible_chars

#: What stands in a summary that says too little, placeholders, judgements, and who is affected.
NO_EVIDENCE = "证据不足，无法生成可靠摘要"
PLACEHOLDERS = ["相关时间", "相关数值"]
JUDGEMENTS = ["政策利好", "重大利好", "利空", "高利润", "巨大商机"]
AFFECTED = ["卖家", "进口商", "出口商", "平台", "消费者", "供应链", "清关", "关税", "合规", "成本", "物流", "报关", "申报", "运营"]
#: Keys of the five scores.
SCORES = ["importance", "information_gain", "social_impact", "actionability", "evidence_density"]
#: Signs of a page that asks whether the reader is human.
CHALLENGES = ["captcha", "verify you are human", "automated access", "疑似自动化访问", "just a moment", "cloudflare ray id", "security check", "访问验证"]


def last_rule(rules: list[tuple[Column, str]], default: Column) -> Column:
    """The reason of the last rule that holds, else the default: later rules override earlier ones."""
    out = default
    for condition, reason in rules:
        out = F.when(condition, F.lit(reason)).otherwise(out)
    return out


def admission(title: Column, body: Column, excluded: Column | None = None, least: int = 400, sample: int = 800, pending: bool = False, extra_words: list[str] = ()) -> Column:
    """(outcome, reason) of a cleaned body: excluded, error (pending where failures wait for another try) or ok.

    A reason given before, else an excluding title word; then an empty body; then fewer than ``least``
    characters; then promotion words in the title and the first ``sample`` characters.
    """
    before = F.coalesce(F.nullif(excluded, F.lit("")), F.nullif(excluded_title(title), F.lit(""))) if excluded is not None else F.nullif(excluded_title(title), F.lit(""))
    text = F.coalesce(body, F.lit(""))
    head = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.substring(text, 1, sample))
    outcome = lambda o, r: F.struct(F.lit(o).alias("outcome"), r.alias("reason"))
    return (
        F.when(before.isNotNull(), outcome("excluded", before))
        .when(text == "", outcome("pending" if pending else "error", F.lit("empty")))
        .when(F.length(text) < least, outcome("excluded", F.lit("short")))
        .when(has_any(head, [*PROMOTION_WORDS, *extra_words]), outcome("excluded", F.lit("promotion")))
        .otherwise(outcome("ok", F.lit("")))
    )


def is_challenge(text: Column) -> Column:
    """Whether a text is a page that asks whether the reader is human."""
    return bound(F.lower(text), lambda low: has_any(low, CHALLENGES))


def valid_body(text: Column, least: int = 300, most: int = 12_000) -> Column:
    """The text cut to ``most`` characters, null if it is a challenge page or has fewer than ``least`` visible ones."""
    return F.when(~is_challenge(text) & (visible_chars(text) >= least), F.substring(text, 1, most))


def score_total(scores: Column) -> Column:
    """Sum of the five scores; null if one is missing or not 0 to 5."""
    ok, total = F.lit(True), F.lit(0)
    for s in SCORES:
        v = scores.getField(s)
        ok, total = ok & F.coalesce(v.between(0, 5), F.lit(False)), total + v
    return F.when(ok, total)


def is_valuable(status: Column, scores: Column, selected: str = "selected") -> Column:
    """Selected with density and gain of 3 and a total of 13, or gain of 4 and density of 3 whatever the status."""
    gain, density = scores.getField("information_gain"), scores.getField("evidence_density")
    standard = (status == selected) & (density >= 3) & (gain >= 3) & (score_total(scores) >= 13)
    return F.coalesce(standard | (gain >= 4) & (density >= 3), F.lit(False)) & score_total(scores).isNotNull()


def tidy_verdict(reason: Column, event_key: Column, topics: Column, points: Column, category: Column, categories: list[str], default: str) -> Column:
    """Fields of a verdict within their bounds: reason 30, event key 40, three topics of 20, three points, known category."""
    cut = lambda c, n: F.substring(F.coalesce(c, F.lit("")), 1, n)
    none = F.array().cast("array<string>")
    return F.struct(
        cut(reason, 30).alias("reason"), cut(event_key, 40).alias("event_key"),
        F.slice(F.transform(F.coalesce(topics, none), lambda t: F.substring(t, 1, 20)), 1, 3).alias("topics"),
        F.slice(F.coalesce(points, none), 1, 3).alias("points"),
        F.when(category.isin(categories), category).otherwise(F.lit(default)).alias("category"),
    )


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n+"), strip), lambda p: p != "")


def summary_problem(summary: Column, evidence: Column, least: int = 300, most: int = 500, parts: int = 3) -> Column:
    """The first that is wrong with a summary: insufficient, placeholder, length, paragraphs, number; empty if none."""
    text = F.coalesce(summary, F.lit(""))
    invented = F.size(F.array_except(numbers_with_units(text), numbers_with_units(evidence)))
    return (
        F.when(text == NO_EVIDENCE, "insufficient").when(has_any(text, PLACEHOLDERS), "placeholder")
        .when(~visible_chars(text).between(least, most), "length").when(F.size(paragraphs(text)) != parts, "paragraphs")
        .when(invented > 0, "number").otherwise("")
    )


def signal_summary_problem(summary: Column, evidence: Column, least: int = 80, most: int = 150) -> Column:
    """The first that is wrong with a signal's summary: length, lines, placeholder, judgement, impact, number."""
    text = F.coalesce(summary, F.lit(""))
    invented = F.size(F.array_except(plain_numbers(text), plain_numbers(evidence)))
    return (
        F.when(~visible_chars(text).between(least, most), "length").when(F.contains(text, F.lit("\n")), "lines")
        .when(has_any(text, PLACEHOLDERS), "placeholder").when(has_any(text, JUDGEMENTS), "judgement")
        .when(~has_any(text, AFFECTED), "impact").when(invented > 0, "number").otherwise("")
    )


def valid_cached(summary: Column, topics: Column, meta: Column, versions: dict[str, str], selected: str = "selected", least: int = 80, most: int = 150) -> Column:
    """Whether a cached signal can be used as it is: a summary of the right length, a topic, all versions as they are now
    and chosen by the model. Null cells make it unusable."""
    fine = visible_chars(summary).between(least, most) & (F.size(F.coalesce(topics, F.array().cast("array<string>"))) > 0)
    return F.coalesce(fine & _stamped(meta, versions, selected), F.lit(False))


def valid_rejection(meta: Column, versions: dict[str, str], rejected: str = "rejected") -> Column:
    """Whether a cached signal was turned down by all versions as they are now."""
    return F.coalesce(_stamped(meta, versions, rejected), F.lit(False))


def _stamped(meta: Column, versions: dict[str, str], status: str) -> Column:
    out = meta["ai_status"] == status
    for name, version in versions.items():
        out = out & (meta[name] == version)
    return out


def cached_admission(status: Column, content: Column, selected: str = "selected", least: int = 300, most: int = 500, parts: int = 3) -> Column:
    """Whether a cached summary may be delivered without asking the model: chosen, of the right length and number of
    paragraphs."""
    return F.coalesce((status == selected) & visible_chars(content).between(least, most) & (F.size(paragraphs(F.coalesce(content, F.lit("")))) == parts), F.lit(False))


def still_pending(status: Column, source: Column, day: Column, title: Column, url: Column, statuses: list[str], sources: list[str], cutoff: Column) -> Column:
    """Whether a record waits for another try: a waiting status, a known source, a day no earlier than the cutoff, and a
    title and an address that are not empty."""
    there = (F.coalesce(title, F.lit("")) != "") & (F.coalesce(url, F.lit("")) != "")
    return F.coalesce(status.isin(statuses) & source.isin(sources) & (day >= cutoff), F.lit(False)) & there
