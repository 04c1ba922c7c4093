"""Text expressions: all are Column to Column and stay in the JVM."""

from __future__ import annotations

import html
import html.entities
import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as \\s of Unicode has it.
SPACE = r"(?U)[\s\x1c-\x1f]"
_LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
#: Button texts that are dropped from bodies.
BUTTON_WORDS = ["点赞", "评论", "收藏", "分享", "举报", "加载中"]
#: Site names that may follow a title behind - _ or |.
SITE_NAMES = ["虎嗅", "少数派", "界面新闻", "IT之家", "钛媒体", "36氪"]
#: Words that exclude a title, in the order in which they are tried.
TITLE_EXCLUSIONS = ["广告", "推广", "招商", "加盟", "优惠券", "领券", "到手价", "探新低", "官方狂促", "限时秒杀", "应用限免", "运势", "星座", "会员通知", "网站公告"]
#: Words that mark a body as an advertisement.
PROMOTION_WORDS = ["领券购买", "立即下单", "限时优惠", "品牌赞助", "推广合作"]
#: A number with its unit.
NUMBER_WITH_UNIT = r"(?U)\d+(?:[.,]\d+)?(?:%|％|万|亿|元|美元|欧元|日元|年|月|日|天|家|人|件|台)?"
#: Words of change, of consequence and of institutions, for scoring sentences.
CHANGE_WORDS = "增长|下降|发布|推出|收购|融资|监管|禁止|开放|调整|裁员|上调|下调|新增|减少"
IMPACT_WORDS = "因此|导致|影响|意味着|相比|但|同时|预计|可能|风险|机会"
ENTITY_WORDS = "公司|集团|平台|政府|委员会|部门|银行|机构|国家|市场|行业|企业|品牌"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


#: Named entities from the standard library: those of HTML 4, apos, and the ones that may stand without their semicolon.
_NAMES = {n for n in html.entities.html5 if n[-1] != ";"} | {*html.entities.name2codepoint, "apos"}
_ENTITIES = json.dumps({n: html.entities.html5[n] for name in sorted(_NAMES) for n in (name, f"{name};") if n in html.entities.html5})
#: What numeric entities of the C1 range stand for, from the standard library.
_C1 = json.dumps({str(k): v for k, v in html._invalid_charrefs.items()})


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of the column, which is worked out once however often f uses it."""
    return F.get(F.transform(F.array(c), f), 0)


def unescape(c: Column) -> Column:
    """Entities as the characters they stand for: names of HTML 4 and apos, the longest that is known where the semicolon
    may be left out, and numbers. Texts without an & are passed on as they are."""
    return bound(c, lambda text: F.when(F.contains(text, F.lit("&")), bound(F.from_json(F.lit(_ENTITIES), "map<string,string>"), lambda names: _resolved(text, names))).otherwise(text))


def _resolved(c: Column, names: Column) -> Column:
    c1 = F.from_json(F.lit(_C1), "map<string,string>")

    def character(code: Column) -> Column:
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = F.element_at(c1, code.cast("string"))
        beyond = code.isNull() | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
        control = (code < 32) & ~code.isin(9, 10, 12, 13) | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF) | (F.pmod(code, F.lit(65536)) >= 65534) | (code == 11)
        return F.when(known.isNotNull(), known).when(beyond, F.lit("\ufffd")).when(control, F.lit("")).otherwise(plain)

    def resolved(part: Column) -> Column:
        number = F.regexp_extract(part, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        digits = F.regexp_extract(number, r"^#[xX]?([0-9a-fA-F]+)", 1)
        short = F.length(F.regexp_replace(digits, "^0+", "")) <= 7
        code = F.when(short, F.when(number.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("bigint"))
        word = F.regexp_extract(part, r"^[A-Za-z][A-Za-z0-9]{0,31};?", 0)
        tries = F.transform(F.sequence(F.greatest(F.length(word), F.lit(1)), F.lit(1)), lambda k: F.substring(word, F.lit(1), k))
        name = F.get(F.filter(tries, lambda x: F.map_contains_key(names, x)), 0)  # the longest first
        named = F.concat(F.element_at(names, name), F.substring(part, F.length(name) + 1, F.length(part)))
        counted = F.concat(character(code), F.substring(part, F.length(number) + 1, F.length(part)))
        return F.when(number != "", counted).when(name.isNotNull(), named).otherwise(F.concat(F.lit("&"), part))

    parts = F.split(c, "&")
    return F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), resolved), ""))


def clean_lines(c: Column, dropped: list[str] | None = None) -> Column:
    """Array of the lines of a text: ideographic and hard spaces folded, runs of space made one, blank lines, button
    words and repetitions of the line before dropped. Null gives null."""
    words = F.array(*(F.lit(w) for w in (BUTTON_WORDS if dropped is None else dropped)))
    lines = F.split(F.translate(c, "　 ", "  "), _LINE_BREAKS)
    lines = F.transform(lines, lambda x: strip(F.regexp_replace(x, "[ \t]+", " ")))
    lines = F.filter(lines, lambda x: (x != "") & ~F.array_contains(words, x))
    return bound(lines, lambda kept: F.filter(kept, lambda x, i: (i == 0) | (x != F.get(kept, i - 1))))


def clean_text(c: Column) -> Column:
    """Entities resolved, then the lines of clean_lines as one text."""
    return F.array_join(clean_lines(unescape(c)), "\n")


def normalize_url(c: Column) -> Column:
    """https, lower host without www., single slashes, none at the end, no query or fragment. Blank gives https://."""
    rest = F.regexp_replace(strip(c), r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^//([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, "/+", "/"), "/+$", "")
    return F.concat(F.when((host == "") & (path != "") & ~path.startswith("/"), F.lit("https:")).otherwise(F.lit("https://")), host, path)


def normalize_title(c: Column, site_names: list[str] | None = None) -> Column:
    """Lower case, letters, digits and _ only, without a site's name behind - _ or |. With an empty list nothing is cut."""
    names = SITE_NAMES if site_names is None else site_names
    if names:
        c = F.regexp_replace(c, rf"[-_|｜].{{0,12}}({'|'.join(names)}).*$", "")
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", "")


def word_key(c: Column) -> Column:
    """normalize_title without site names: lower case, letters, digits and _ only."""
    return normalize_title(c, [])


def sink_identity(title: Column, url: Column) -> Column:
    """(title_key, url_key) under which a row of the sink is known; the address is empty if there is none."""
    address = cell_text(url)
    return F.struct(word_key(cell_text(title)).alias("title_key"), F.when(F.coalesce(address, F.lit("")) == "", "").otherwise(normalize_url(address)).alias("url_key"))


def visible_chars(c: Column) -> Column:
    """Characters that are not white space; 0 for null."""
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), f"{SPACE}+", "")).cast("long")


def numbers_with_units(c: Column) -> Column:
    """Distinct numbers with their units, commas dropped, full-width per cent folded."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NUMBER_WITH_UNIT), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.replace(F.replace(x, F.lit("％"), F.lit("%")), F.lit(","), F.lit(""))))


def plain_numbers(c: Column) -> Column:
    """Distinct numbers that no Latin letter precedes: commas, leading zeros and a final point dropped, % kept."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?U)(?<![A-Za-z])\d[\d,.]*%?"), F.lit(0))

    def tidy(x: Column) -> Column:
        x = F.replace(x, F.lit(","), F.lit(""))
        suffix = F.when(x.endswith("%"), F.lit("%")).otherwise(F.lit(""))
        x = F.regexp_replace(F.regexp_replace(x, "%$", ""), r"\.+$", "")
        whole = F.regexp_replace(F.regexp_extract(x, r"^([^.]*)", 1), "^0+(?=.)", "")
        whole = F.when(whole == "", F.lit("0")).otherwise(whole)
        return F.concat(whole, F.regexp_extract(x, r"(\..*)$", 1), suffix)

    return F.array_distinct(F.transform(found, tidy))


def first_word(c: Column, words: list[str]) -> Column:
    """The first of the words, in their order, that stands in the text; null if none does."""
    return F.coalesce(*(F.when(F.contains(c, F.lit(w)), F.lit(w)) for w in words))


def has_any(c: Column, words: list[str]) -> Column:
    """Whether any of the words stands in the text; false for null."""
    found = F.lit(False)
    for w in words:
        found = found | F.contains(c, F.lit(w))
    return F.coalesce(found, F.lit(False))


def excluded_title(c: Column) -> Column:
    """The word that excludes a title, spaces left aside; empty if none does."""
    return F.coalesce(first_word(F.replace(c, F.lit(" "), F.lit("")), TITLE_EXCLUSIONS), F.lit(""))


def content_hash(title: Column, url: Column, body: Column) -> Column:
    """SHA-256 of the normal title, address and cleaned body, a line each."""
    return F.sha2(F.concat_ws("\n", normalize_title(title), normalize_url(url), clean_text(body)), 256)


def signal_id(source_key: Column, url: Column, title: Column) -> Column:
    """First 32 hex digits of the SHA-256 of source, lower-case address and lower-case cleaned title."""
    return F.substring(F.sha2(F.concat_ws("|", source_key, F.lower(strip(url)), F.lower(clean_text(title))), 256), 1, 32)


def cell_text(c: Column) -> Column:
    """Text of a cell that is plain, or JSON with a link or a text, or a JSON list of such, joined by a space."""
    one = F.from_json(c, "link string, url string, text string")
    many = F.from_json(c, "array<struct<link: string, text: string>>")
    of_many = F.array_join(F.transform(many, lambda x: F.coalesce(F.nullif(x["link"], F.lit("")), x["text"], F.lit(""))), " ")
    trimmed = strip(c)
    return F.when(trimmed.startswith("{"), F.coalesce(F.nullif(one["link"], F.lit("")), F.nullif(one["url"], F.lit("")), one["text"])).when(trimmed.startswith("["), of_many).otherwise(trimmed)


def json_object(c: Column) -> Column:
    """The JSON object that a model's answer holds, as text: in a fenced block, else from the first to the last brace.
    Null if that is no JSON object."""
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(\{.*\})\s*```", 1)
    bare = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    found = F.coalesce(F.nullif(fenced, F.lit("")), F.nullif(bare, F.lit("")))
    return F.when(F.try_parse_json(found).isNotNull(), found)


def clean_answer(c: Column) -> Column:
    """A model's answer in words, without a code fence around it."""
    return strip(F.regexp_replace(strip(c), r"^```(?:text)?\s*|\s*```$", ""))


def failure_markers(log: Column, markers: dict[str, str], ignored: str) -> Column:
    """Sorted names of the patterns that stand in some line of a log, colour codes aside; lines that hold ``ignored``,
    which dump payloads, do not count."""
    lines = F.filter(F.split(F.regexp_replace(F.coalesce(log, F.lit("")), r"\x1b\[[0-9;]*m", ""), r"\r\n|[\n\r]"), lambda x: ~F.contains(x, F.lit(ignored)))
    matches = lambda pattern: F.exists(lines, lambda x: x.rlike(pattern))
    return F.array_compact(F.array(*(F.when(matches(pattern), F.lit(name)) for name, pattern in sorted(markers.items()))))


def traffic_number(c: Column) -> Column:
    """20,000+ as 20000.0; null if there is no number."""
    digits = F.nullif(F.regexp_replace(c, "[^0-9.]", ""), F.lit(""))
    return F.when(digits.rlike(r"^(\d+\.?\d*|\.\d+)$"), digits.cast("double"))


def sentences(c: Column) -> Column:
    """Array of (section, position, sentence): sections are non-blank lines, sentences end after 。！？；, and those of
    12 to 600 characters are kept; position counts the others too."""
    sections = F.filter(F.transform(F.split(c, "\n+"), strip), lambda x: x != "")

    def cut(section: Column, at: Column) -> Column:
        parts = F.filter(F.transform(F.split(section, "(?<=[。！？；])"), strip), lambda x: x != "")
        numbered = F.transform(parts, lambda x, i: F.struct(at.cast("int").alias("section"), i.cast("int").alias("position"), x.alias("sentence")))
        return F.filter(numbered, lambda s: F.length(s["sentence"]).between(12, 600))

    return F.flatten(F.transform(sections, cut))


def title_terms(title: Column) -> Column:
    """Distinct terms of a normal title: Latin runs of 2 and more, Chinese ones of 2 to 6."""
    return F.array_distinct(F.regexp_extract_all(normalize_title(title), F.lit(r"[a-z0-9]{2,}|[一-鿿]{2,6}"), F.lit(0)))


def sentence_score(sentence: Column, terms: Column, position: Column) -> Column:
    """3 for each title term, 3 for a number, 2 for change, 2 for an institution, 2 for one of the first three, 1 for consequence."""
    hits = F.size(F.filter(terms, lambda t: F.contains(sentence, t)))
    flag = lambda pattern: sentence.rlike(pattern).cast("int")
    return hits * 3 + flag(r"(?U)\d") * 3 + flag(CHANGE_WORDS) * 2 + flag(ENTITY_WORDS) * 2 + (position < 3).cast("int") * 2 + flag(IMPACT_WORDS)
