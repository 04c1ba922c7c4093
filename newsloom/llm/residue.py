"""Texts without content: unfilled templates, filler, error and blocking messages, notices that scripts
are needed, and notes that content is missing.

Page parts around a text are left aside (lines.py); slots, numbers, addresses, dates and titles are masked,
and units that repeat are taken once: texts that are then the same are one message. Every text is hashed and
counted by message over all rows and sources. A message is classified once, by its counts and by the evidence
of phrase and placeholder rules: one that recurs widely needs little evidence, a rare one must be residue for
the most part of its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.lines import EDGE, ITEM, LINK, MENU, QUOTE, SHORT, TEXT, columns, is_list_heading, read_body, weight
from newsloom.session import dealt, stored

_FLAGS = re.IGNORECASE
#: Slots of templates that were not filled.
SLOTS = [
    r"\$\{[^{}\n]*\}", r"#\{[^{}\n]*\}", r"\{\{[^{}\n]*\}\}", r"\{%[^%\n]*%\}", r"<%[^%\n]*%>",
    r"\[\[[^\[\]\n]*\]\]", r"【\s*\[\[[^】\n]*\]\]\s*】", r"__\w[\w.-]*?__", r"%[A-Za-z_][\w.-]+%", r"@@[\w.-]+@@",
    r"【(?:待填|待补|占位|插入|填写|此处)[^】\n]*】", r"\[(?:insert|your|placeholder|summary|title|name|body|content|date|author|tbd|todo)\b[^\[\]\n]*\]",
    r"\[(?:在此|请在此|此处|待|插入|填写)[^\[\]\n]*\]", r"<(?:核心内容|正文|标题|摘要|内容)>", r"\{[A-Za-z_][\w.-]+\}", r"<(?:insert|your|placeholder)[^<>\n]*>",
    r"\b_{4,}", r"(?<!\S)(?:X{3,}|x{3,})(?!\S)", r"[:：]\s*(?:X{3,}|…{2,})",
]
#: What programs print for a value that is not there.
NULL_WORDS = r"\[object object\]|undefined|null|none|nan|n/a|nil|tbd|todo|待补充|待定|暂无(?:内容|数据)?"
#: Stems of words of filler texts.
FILLER_STEMS = "lorem ipsum dolor dolent sit ament amet consec tetur adipis elit elitra sed tempo incidun labore magna aliqu enim minim veniam quis nostrud ullamco nisi commodo nulla vesper quaram".split()
#: Messages of pages and programs, as they begin.
MESSAGES = """
(?:error )?(?:\\d{3}|‹n›) ?[-:–—]? ?(?:not found|bad gateway|internal server|service|gateway|forbidden|we could not|网关|页面|服务|未找到|禁止|错误)
page not found|we could not find|the page .{0,160} (?:not found|no longer|does not exist)|die seite .{0,200} (?:wurde nicht gefunden|existiert nicht|nicht verfügbar)|seite nicht gefunden
(?:lo sentimos, )?la página .{0,200} no existe|página no encontrada|página não encontrada|a página .{0,200} não
(?:抱歉,? ?)?(?:您访问的|该|此|本)?(?:页面|网页|文章|内容|链接).{0,20}(?:不存在|已被删除|已删除|已失效|已下线|无法显示|无法访问|因.{0,60}(?:操作|原因).{0,6}(?:删除|下线))
(?:该|此|本)(?:内容|链接|文章|页面).{0,80}(?:已被删除|已失效|被删除|被移除|违规)
this (?:item|page|post|content|article) (?:was|has been|is) (?:removed|deleted|no longer|unavailable)
(?:our )?service (?:is )?temporarily unavailable|temporarily unavailable|internal (?:server )?error|oops! ?something went wrong|something went wrong|an error occurred|fatal(?: error)?: |error: |exception: |traceback
interner serverfehler|dienst .{0,20}nicht verfügbar|zugriff verweigert|error interno|servicio no disponible|acceso denegado|erro interno|serviço indisponível|acesso negado
系统(?:繁忙|错误|异常)|服务器.{0,80}(?:无法响应|错误|繁忙|无响应|异常)|数据库.{0,10}(?:失败|错误|超时)|请求(?:编号|失败|超时|过于频繁)|加载.{0,120}中|加载失败|网络(?:异常|错误|超时)|upstream .{0,120}(?:did not answer|timed out|failed)|request [\\w‹›]+$
access denied|your (?:address|ip) .{0,20}blocked|you have been blocked|please confirm you are (?:not a robot|human)|checking your browser|verify (?:that )?you are human|too many requests|complete the captcha
当前环境异常|访问(?:过于频繁|受限|被拒绝)|请(?:完成|输入).{0,10}(?:验证|字符)|请.{0,6}验证码|安全验证|您的(?:访问|ip|账号).{0,20}(?:限制|禁止|异常)
your session has (?:ended|expired)|登录已(?:过期|失效)|会话已(?:过期|失效)|please log in again|ihre sitzung ist abgelaufen|(?:su|tu|sua) ses(?:ión|são) .{0,10}expir
(?:please )?(?:enable|activate|turn on|allow) (?:java ?)?scripts?|this (?:site|page|app) .{0,80}(?:needs|requires) (?:java ?)?scripts?|we noticed (?:java ?)?scripts? (?:are|is) (?:switched|turned) off|you need (?:a supported browser|to enable)|javascript (?:is|must be) |turn them on and reload|try again later|log in again|loading .{0,200}\\.{3}|loading \"|if nothing happens
bitte (?:java ?script|skripte?) (?:aktivieren|einschalten)|java ?script (?:aktivieren|ist deaktiviert)|(?:activa|active|habilita|habilite|ative) (?:el |o )?java ?script|necesitas? java ?script
您的浏览器.{0,20}(?:未启用|不支持|禁用|关闭)|(?:请)?(?:启用|开启|允许).{0,6}(?:脚本|javascript)|本(?:页|站|网站|页面).{0,10}需要.{0,6}(?:脚本|javascript)|为了正常显示.{0,80}(?:脚本|浏览器)|.{0,100}请检查脚本
(?:\\(.{0,60}\\) ?)?(?:正文|内容|核心干货|摘要|图片|全文)(?:缺失|待生成|待补充|为空|占位|未填写|暂缺|加载失败|获取失败)|(?:此处|这里)(?:为|是).{0,60}(?:示例|占位|测试)|示例文字|测试测试|(?:模型|接口|服务)未返回|(?:摘要|正文|内容|翻译)(?:生成|提取|抓取|获取)失败|根据现有材料无法|(?:抱歉,? ?)?我(?:无法|不能)(?:访问|打开|读取|处理)|请在此处(?:粘贴|填写|输入)|请提供.{0,120}(?:全文|正文|内容)|第[一二三四五]段: ?(?:…|\\.{3})|要点[一二三]: ?x{2,}
sample text|your headline .{0,80}here|write (?:two or three|a few|some) lines|todo [\\w‹›]*: ?|tbd\\b|replace this copy|here is (?:the|a) (?:summary|article|list) (?:of|for) .{0,120}: ?\\[|insert .{0,40} here|coming soon|content (?:missing|unavailable|goes here)|no content|text goes here|error: empty|as an ai|i (?:cannot|can't|am unable to) (?:access|open|read)|待补充|n/a\\b
beispieltext|platzhalter|inhalt fehlt|texto de (?:ejemplo|exemplo|prueba|teste)|contenido no disponible|conteúdo indisponível
"""
#: Words that make a short, widely recurring text a message of a page or program.
WEAK_WORDS = "javascript|脚本|404|403|500|502|503|captcha|验证|placeholder|占位|示例|lorem|error|fehler|erro|错误|失败|超时|timeout|not found|not available|unavailable|nicht gefunden|no encontrad|não encontrad|待补|删除|失效|缺失|无法|请稍后|try again|reload|刷新|blocked|denied|robot|log in|登录"

_SLOT = re.compile("|".join(SLOTS), _FLAGS)
_NULL = re.compile(rf"(?<![\w])(?:{NULL_WORDS})(?![\w])|{NULL_WORDS.split('|')[0]}", _FLAGS)
_MESSAGE = re.compile("|".join(x for x in MESSAGES.strip().split("\n")), _FLAGS)
_HINTS = WEAK_WORDS.split("|")
_UNIT_ENDS = "。!?！？;；"
_URL = re.compile(r"(?:https?://|www\.)\S+|\b[\w-]+(?:\.[\w-]+)*\.(?:com|net|org|cn|io|example)\w*(?:/[\w./?=&%#~+-]*)?", _FLAGS)
_DATE = re.compile(r"‹n›(?:-‹n›-|/‹n›/|年‹n›月)‹n›日?(?: ?‹n›:‹n›(?::‹n›)?)?|‹n›:‹n›(?::‹n›)?")
_TITLE = re.compile(r"《[^《》\n]+》|\"[^\"\n]+\"|“[^”\n]+”")
_NUMBER = re.compile(r"\d[\d.,]*")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_QUOTES, _HOSTS, _DATES = ("《", '"', "“"), ("http", "www.", ".com", ".net", ".org", ".cn", ".io", ".example"), ("‹n›-‹n›", "‹n›/‹n›", "‹n›年", "‹n›:")
_LABEL = re.compile(r"[\w.‹›-]+ ?[:：=]")
_MARK = re.compile(r"‹\w›|[\W_]+")
_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"([^\W\d_])\1{4,}")
_GAP = re.compile(r"(?<=[一-鿿]) (?=[一-鿿])|(?:^|[ ,(（])[,.:;)）](?!\.)|\( ?\)|(?<=\w) [,.;:](?= |$|[^\W\d])")
_STEMS = tuple(FILLER_STEMS)
_RULE_SIGNS = frozenset("-=_*.#~")
_OPENERS, _PERCENT = ("{", "[", "<", "__", "@@", "【", "XXX", "xxx", ": …", ":…", "：…"), re.compile(r"%[A-Za-z_]")
_NULL_SIGNS = ("object", "undefined", "null", "none", "nan", "n/a", "nil", "tbd", "todo", "待", "暂无")

#: Evidence from which a message is residue by itself, and from which it is if it recurs widely.
SURE, LITTLE = 0.5, 0.05
#: Sentences up to which a widely recurring message needs no evidence at all: an article says more.
CURT = 2


def _masked(text: str) -> str:
    """The text with slots, titles, addresses, dates, numbers and codes masked, in lower case."""
    for slot in set(_slots(text)):
        text = text.replace(slot, "‹s›")
    if any(q in text for q in _QUOTES):
        text = _TITLE.sub("‹t›", text)
    text = text.lower()
    if any(h in text for h in _HOSTS):
        text = _URL.sub("‹u›", text)
    text = _NUMBER.sub("‹n›", text)
    if any(d in text for d in _DATES):
        text = _DATE.sub("‹d›", text)
    return _with_codes(text) if "‹n›" in text else text


def _with_codes(text: str) -> str:
    """Numbers and the letters that they are written together with as one mask."""
    first, *parts = text.split("‹n›")
    parts = [first.rstrip(_LETTERS), *(x.strip(_LETTERS) for x in parts[:-1]), parts[-1].lstrip(_LETTERS)]
    joined = "‹n›".join(parts)
    while "‹n›‹n›" in joined:
        joined = joined.replace("‹n›‹n›", "‹n›")
    return joined


def _units(text: str) -> list[str]:
    """Sentences and lines of a masked text."""
    for end in _UNIT_ENDS:
        if end in text:
            text = text.replace(end, f"{end}\n")
    return [u for part in text.replace(". ", ".\n").split("\n") if (u := part.strip())]


def message(units: list[str]) -> str:
    """What the rows of one message share: its masked units, each once, in order; in a unit of slots each word once."""
    words = (u.split() for u in units)
    return "\n".join(dict.fromkeys(" ".join(dict.fromkeys(w) if "‹s›" in w else w) for w in words))


def core(body: str) -> str:
    """What is left of a body without the parts of the page around it, a line each."""
    return core_of(read_body(body))


def core_of(lines: list[tuple[str, int, int, bool]]) -> str:
    """The same from lines that are read already: what is text and no cue takes off, and of the others those that are
    residue by themselves; without any such line the headlines, but for those below the heading of a list of other
    articles."""
    kept, short, listed = [], [], False
    for text, width, form, cue in lines:
        if form in (SHORT, MENU) and is_list_heading(text):
            listed = True
        elif listed and form not in (SHORT, LINK, MENU):
            listed = False
        if form in (TEXT, ITEM, QUOTE) and not (cue and weight(width, form, cue) < EDGE) or text and _says(text):
            kept.append(text)
        elif form == SHORT and not cue and not listed:
            short.append(text)
    return "\n".join(kept or short)


def _slots(text: str) -> list[str]:
    """The unfilled slots. Only a text with a sign that opens one is searched."""
    if any(o in text for o in _OPENERS) or "%" in text and _PERCENT.search(text):
        return [m[0] for m in _SLOT.finditer(text)]
    return []


@lru_cache(maxsize=200_000)
def _says(line: str) -> bool:
    """Whether a line of a page is residue by itself."""
    return _is_message(line) or bool(_slots(line)) or _is_null(line)


def _is_message(unit: str) -> bool:
    low = unit if unit.islower() else unit.lower()
    bare = low.lstrip("([（【<*>#·•-\"“ ")
    return _MESSAGE.match(bare) is not None or bare is not low and low.startswith("(") and _MESSAGE.match(low) is not None


def _is_null(text: str) -> bool:
    """Printed null values, with labels and codes at most."""
    low = text.lower()
    if not any(w in low for w in _NULL_SIGNS) or not _NULL.search(text):
        return False
    rest = _MARK.sub("", _masked(_NULL.sub("", _LABEL.sub("", text))))
    return columns(rest) <= 0.25 * columns(text)


def _stems(text: str) -> bool:
    """Whether several stems of filler words stand in the text at all."""
    low = text.lower()
    return sum(s in low for s in _STEMS) >= 4


def _is_filler(text: str) -> bool:
    """Words of filler for the most part, or runs of one repeated sign or phrase, rules of signs aside."""
    if columns(text) < 1.5 * len(text) and _stems(text):
        words = _WORD.findall(text.lower())
        if len(words) >= 8 and sum(w.startswith(_STEMS) for w in words) >= 0.5 * len(words):
            return True
    tight = "".join(text.split())
    if len(tight) < 12 or not _packs(tight):
        return False
    if _RUN.search(tight) and sum(len(m[0]) for m in _RUN.finditer(tight)) >= 0.55 * len(tight):
        return True
    return _repeated(tight) >= 0.5


#: Longest phrase whose repetition is filler, how often it must stand in a row, and the share to which a text of which
#: half repeats can be packed, beside the signs that any packing takes.
PERIOD, TIMES, PACKED, OVERHEAD = 24, 5, 0.3, 150


def _packs(tight: str) -> bool:
    """Whether a text is packed to so little that half of it may be repetition."""
    raw = tight.encode("utf-8", "replace")
    return len(zlib.compress(raw, 1)) <= PACKED * len(raw) + OVERHEAD


def _repeated(tight: str) -> float:
    """Share of a text without spaces that is runs of a phrase repeated ``TIMES`` or more, rules of signs aside: each
    distance up to ``PERIOD`` is tried over the whole text at once."""
    codes = np.frombuffer(tight.encode("utf-32-le", "surrogatepass"), np.uint32)
    covered = np.zeros(len(codes) + 1, np.int64)
    for p in range(1, min(PERIOD, len(codes) // TIMES) + 1):
        ends = np.flatnonzero(np.append(codes[p:] != codes[:-p], True))
        starts = np.concatenate([[0], ends[:-1] + 1])
        long = ends - starts >= (TIMES - 1) * p
        np.add.at(covered, starts[long], 1)
        np.add.at(covered, ends[long] + p, -1)
    inside = (np.cumsum(covered)[:-1] > 0) & ~np.isin(codes, [ord(c) for c in _RULE_SIGNS])
    return float(inside.mean())


def _gaps(text: str, width: int) -> float:
    """Places where a value was filled in as nothing, as far as they could make a residue of a text of that width."""
    signs = sum(text.count(x) for x in (" ,", " .", " ;", " :", " )", "( ", "(,", "()", ",,"))
    if width > 1.3 * len(text):  # words are not parted there
        signs += text.count(" ") + text.count("（")
    return len(_GAP.findall(text)) * 15 / width if signs * 15 >= SURE * width else 0.0


def evidence(text: str, units: list[str] | None = None) -> float:
    """Share of a core text, 0 to 1, that phrase and placeholder rules take for residue; a whole one from SURE on.

    ``units`` are those of the masked text where they are known. An empty text has 0: nothing that is there says that
    content is missing.
    """
    if not text.strip():
        return 0.0
    width = columns(text)
    found = 0.0
    slots = _slots(text)
    if slots:
        taken = sum(map(columns, slots))
        found = max(taken / (0.6 * width), len(slots) * 45 / (2 * max(1, width - taken)))
    if found < SURE and _is_filler(text):
        found = 1.0
    if found < SURE:
        found = max(found, _gaps(text, width))
    if found < SURE:
        stems = width < 1.5 * len(text) and _stems(text)
        units = _units(_masked(text)) if units is None else units
        low = text.lower()
        nulls = any(w in low for w in _NULL_SIGNS)
        hit = sum(columns(u) for u in units if _is_message(u) or nulls and _is_null(u) or stems and _is_filler(u))
        found = max(found, hit / max(1, sum(map(columns, units))) if hit else 0.0)
    return min(1.0, found)


def classify(share: float, units: int, hint: bool, rows: int, sources: int, wide_rows: int, wide_sources: int) -> bool:
    """Whether a message is residue: for the most part by the rules, or recurring widely with some evidence, with a
    word that programs use, or in so few sentences that it is no article."""
    wide = rows >= wide_rows and sources >= wide_sources
    return share >= SURE or wide and (share >= LITTLE or hint or units <= CURT)


CASES = "origin string, row_key string, source string, message long, share float, units int, hint boolean"


def _judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for origin, key, source, text in zip(f["origin"], f["row_key"], f["source"], f["text"]):
            c = core(text)
            if c.strip():
                units = _units(_masked(c))
                m = message(units)
                rows.append((origin, key, source, xxhash.xxh3_64_intdigest(m) - 2**63, evidence(c, units), m.count("\n") + 1, any(w in m for w in _HINTS)))
        yield pd.DataFrame(rows, columns=["origin", "row_key", "source", "message", "share", "units", "hint"]).astype({"share": "float32", "units": "int32", "hint": "bool"})


def find_residue(rows: DataFrame, wide_rows: int = 8, wide_sources: int = 3, salts: int = 16) -> DataFrame:
    """(origin, row_key) of the rows whose text is no content.

    ``rows`` has origin, row_key, source and text. Null, empty and blank texts are no case; a null row_key
    gives no row, a null source counts as one source; repeated rows with the same key give one row. Extra
    columns are ignored. ``wide_rows`` and ``wide_sources`` are the rows and sources from which a message
    recurs widely. Texts are read whole.

    Every text is masked and hashed; only hashes and measures are kept and shuffled. Counts are combined
    before the shuffle, each message is classified once (``classify``, as an expression), and all rows come out
    through the join with the messages that are residue, a message that many share spread over ``salts`` parts.
    """
    texts = rows.select("origin", F.col("row_key").cast("string").alias("row_key"), F.coalesce("source", F.lit("")).alias("source"), "text")
    texts = texts.where("row_key is not null and text is not null and trim(text) <> ''")
    cases = stored(dealt(texts).mapInPandas(_judged, CASES), "cases")
    seen = cases.groupBy("message", "source").agg(F.count("*").alias("n"), F.max("share").alias("share"), F.min("units").alias("units"), F.bool_or("hint").alias("hint"))
    messages = seen.groupBy("message").agg(F.sum("n").alias("n"), F.count("*").alias("sources"), F.max("share").alias("share"), F.min("units").alias("units"), F.bool_or("hint").alias("hint"))
    wide = (F.col("n") >= wide_rows) & (F.col("sources") >= wide_sources)
    bad = messages.where((F.col("share") >= SURE) | wide & ((F.col("share") >= LITTLE) | F.col("hint") | (F.col("units") <= CURT)))
    bad = bad.select("message", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = cases.select("origin", "row_key", "message", F.pmod(F.xxhash64("row_key"), F.lit(salts)).cast("int").alias("salt"))
    return salted.join(bad, ["message", "salt"], "left_semi").select("origin", "row_key").distinct()
