"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def url_key(c: str) -> str:
    rest = rf"regexp_replace({strip(c)}, '^[A-Za-z][A-Za-z0-9+.\-]*:', '')"
    host = rf"regexp_replace(lower(regexp_extract({rest}, '^//([^/?#]*)', 1)), '^www\.', '')"
    path = rf"regexp_replace(regexp_replace(regexp_extract({rest}, '^(?://[^/?#]*)?([^?#]*)', 1), '/+', '/', 'g'), '/+$', '')"
    return f"(CASE WHEN {host} = '' AND {path} <> '' AND NOT starts_with({path}, '/') THEN 'https:' ELSE 'https://' END || {host} || {path})"


def title_key(c: str) -> str:
    cut = rf"regexp_replace({c}, '[-_|｜].{{0,12}}(虎嗅|少数派|界面新闻|IT之家|钛媒体|36氪).*$', '')"
    return rf"regexp_replace(lower({cut}), '[^\p{{L}}\p{{N}}_]+', '', 'g')"


def lines(c: str) -> str:
    raw = rf"string_split_regex(translate({c}, '　' || chr(160), '  '), '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"
    tidy = strip(r"regexp_replace(x, '[ \t]+', ' ', 'g')")
    kept = f"list_filter(list_transform({raw}, lambda x: {tidy}), lambda x: x <> '' AND x NOT IN ('点赞', '评论', '收藏', '分享', '举报', '加载中'))"
    return kept


def clean(c: str) -> str:
    """As a scalar subquery, since the list of lines is used twice."""
    return f"(SELECT coalesce(array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), chr(10)), '') FROM (SELECT {lines(c)} AS l))"


def clean_of(text: str) -> str:
    """The same for an expression that is long or has strings of its own."""
    return f"(SELECT coalesce(array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), chr(10)), '') FROM (SELECT {lines('t')} AS l FROM (SELECT {text} AS t)))"


def words(values: list[str]) -> str:
    """A list of words."""
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def visible(c: str) -> str:
    return f"length(regexp_replace(coalesce({c}, ''), '{SPACE}+', '', 'g'))"


def utc(c: str) -> str:
    return f"make_timestamp(epoch_us({c}))"


def local_day(c: str) -> str:
    return f"CAST({utc(c)} + INTERVAL 8 HOUR AS DATE)"


NUMBERS = r"'\d+(?:[.,]\d+)?(?:%|％|万|亿|元|美元|欧元|日元|年|月|日|天|家|人|件|台)?'"


def numbers(c: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all(coalesce({c}, ''), {NUMBERS}), lambda x: replace(replace(x, '％', '%'), ',', '')))"
