"""Timestamps in many spellings, precisions and zones to one instant in UTC.

Each value becomes a mask of character classes. A distinct mask fixes where every number, word and
sign stands, so it is mapped to a parser once, and all values of the mask are cut and converted as
arrays. Local times go through transition tables (functions/zones.py).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.zones import abbreviation_offset, zone_table

#: Month names and their short forms in the languages of the sources.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
}
SHORT_MONTHS = {
    "en": "jan feb mar apr may jun jul aug sep oct nov dec", "de": "jan feb mär apr mai jun jul aug sep okt nov dez",
    "es": "ene feb mar abr may jun jul ago sep oct nov dic", "pt": "jan fev mar abr mai jun jul ago set out nov dez",
}
_MONTH = {w: i % 12 + 1 for t in (MONTHS, SHORT_MONTHS) for s in t.values() for i, w in enumerate(s.split())} | {"sept": 9, "mrz": 3}
#: Names of weekdays, which say nothing that the date does not.
WEEKDAYS = (
    "monday tuesday wednesday thursday friday saturday sunday mon tue wed thu fri sat sun tues weds thur thurs "
    "montag dienstag mittwoch donnerstag freitag samstag sonnabend sonntag mo di mi do fr sa so "
    "lunes martes miércoles jueves viernes sábado domingo lun mié jue vie sáb dom "
    "segunda terça quarta quinta sexta feira seg ter qua qui sex "
    "星期一 星期二 星期三 星期四 星期五 星期六 星期日 星期天 周一 周二 周三 周四 周五 周六 周日"
).split()
#: Words around a date and a time that carry no value.
FILLERS = "t uhr um at on of de del a las às h hs hora the den published updated posted stand 发布于 更新于 发布时间 时间".split()
#: Half-day words and whether they mean the later half.
HALVES = {"am": 0, "pm": 1, "上午": 0, "下午": 1, "晚上": 1, "中午": 1, "凌晨": 0, "早上": 0, "清晨": 0, "傍晚": 1}

WEEKDAY, FILLER, UNKNOWN, MONTH, HALF, ZONE = range(6)
OUTPUT = "id long, instant_us long"


class _Classes(dict):
    """Table for str.translate: digits are 9, letters a; all else stays."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        mark = "9" if "0" <= c <= "9" else c if c in "年月日时分秒" else "a" if c.isalpha() else c
        self[code] = mark
        return mark


_CLASSES = _Classes()
#: Masks, words and programs that a Python worker remembers; code points that are laid out as one array.
REMEMBERED, BLOCK = 1 << 16, 1 << 22
_SIGNS = str.maketrans({"−": "-", "‐": "-", "‑": "-", "–": "-", "—": "-"})


def clean(value: str) -> str:
    """Width folded, outer space dropped, inner runs of space made one."""
    return " ".join(unicodedata.normalize("NFKC", value).translate(_SIGNS).split())


@lru_cache(maxsize=REMEMBERED)
def _tokens(mask: str) -> tuple[tuple[str, int, int], ...]:
    """(kind, from, to) with kinds n: number, w: word, z: name of a zone, and signs as they are."""
    found = []
    for m in re.finditer(r"\[[^\]]*\]|a[a_]*(?:/a[a_]*)+|9+|a(?:\.a\.)+|a+|\S| ", mask):
        t = m[0]
        kind = "z" if t[0] == "[" or "/" in t and len(t) > 1 else "n" if t[0] == "9" else "w" if t[0] == "a" else t
        found.append((kind, m.start() + (t[0] == "["), m.end() - (t[0] == "[")))
    return tuple(found)


@lru_cache(maxsize=REMEMBERED)
def _word(word: str) -> tuple[int, int]:
    w = word.lower().replace(".", "")
    if w in HALVES:
        return HALF, HALVES[w]
    if w in _MONTH:
        return MONTH, _MONTH[w]
    if w in WEEKDAYS:
        return WEEKDAY, 0
    if w in FILLERS:
        return FILLER, 0
    return (ZONE, 0) if re.fullmatch(r"[A-Za-z]{1,5}", word) else (UNKNOWN, 0)


#: Layouts of a value, over one character for each token: n number, m month, p half-day word, o zone word,
#: Z name of a zone; signs are themselves. Weekdays and fillers are dropped first.
_DATE = [
    (re.compile(r"(?P<y>n)[-/.年] ?(?P<m>n)[-/.月] ?(?P<d>n)日?(?!n)"), "ymd"),
    (re.compile(r"(?P<a>n)[-/.] ?(?P<b>n)[-/.] ?(?P<c>n)"), "num"),
    (re.compile(r"(?P<m>m)\.? ?(?P<d>n),? ?(?P<y>n)"), "ymd"),
    (re.compile(r"(?P<d>n)[-. ]*(?P<m>m)[-.,]* ?(?P<y>n)"), "ymd"),
    (re.compile(r"(?P<y>n)[- ](?P<m>m)[- ](?P<d>n)"), "ymd"),
    (re.compile(r"(?P<e>n)(?= ?(?:n|$|[oZ+-]))"), "compact"),
]
_TIME = re.compile(r"(?:(?P<p>p) ?)?(?:(?P<h>n)[:时](?P<i>n)(?:[:分](?P<s>n)秒?(?:[.,](?P<f>n))?|分)?|(?P<t>n)(?:[.,](?P<g>n))?)(?: ?(?P<q>p))?")
_OFFSET = re.compile(r"\(?(?P<o>o)?\)? ?(?:(?P<k>[+-])(?P<u>n)(?::(?P<v>n)(?::n)?)?)? ?(?P<z>Z)?(?: ?\(o\))?")


@lru_cache(maxsize=REMEMBERED)
def _program(mask: str, kinds: tuple[int, ...], order: str) -> dict[str, int] | None:
    """Which token is which part, for one mask, kinds of its words and order of all-number dates. None: no date."""
    text, at, words = "", [], iter(kinds)
    tokens = _tokens(mask)
    width = [e - s for _, s, e in tokens]
    for k, (kind, _, _) in enumerate(tokens):
        if kind == "w":
            w = next(words)
            if w == UNKNOWN:
                return None
            mark = {WEEKDAY: "", FILLER: "", MONTH: "m", HALF: "p", ZONE: "o"}[w]
            if not mark:  # what parted words and numbers still does
                if text and text[-1] not in " ":
                    text, at = text + " ", at + [-1]
                continue
        else:
            mark = {"n": "n", "z": "Z"}.get(kind, kind)
        if mark in " ," and (not text or text[-1] == " " and mark == " "):
            continue
        text, at = text + mark, at + [k]
    while text and text[-1] in " ,":
        text, at = text[:-1], at[:-1]
    if re.fullmatch(r"[+-]?n(\.n)?", text):
        return {"number": at[text.index("n")], "sign": text[0] == "-", **({"fraction": at[-1]} if "." in text else {})}
    for pattern, kind in _DATE:
        m = pattern.match(text)
        if not m:
            continue
        at_of = {k: at[m.start(k)] for k in m.groupdict()}
        if kind == "ymd":
            if width[at_of["y"]] not in (2, 4) or width[at_of["d"]] > 2 or (text[m.start("m")] == "n" and width[at_of["m"]] > 2) or (width[at_of["y"]] == 2 and text[m.start("m")] == "n"):
                continue
            out = at_of
        elif kind == "num":
            a, b, c = (at_of[x] for x in "abc")
            if width[a] > 2 or width[b] > 2 or width[c] not in (2, 4):
                continue
            by = order if width[c] == 2 else "dmy" if order not in ("mdy", "dmy") else order
            by = "dmy" if "." in text[m.start() : m.end()] and by == "mdy" and width[c] == 4 else by
            out = dict(zip(by if set(by) == set("ymd") else "dmy", (a, b, c), strict=True))
        else:
            if width[at_of["e"]] != 8:
                continue
            out = {"compact": at_of["e"]}
        rest, gap = text[m.end() :], m.end()
        rest_at = lambda x, g, base: at[base + x.start(g)]
        lead = len(rest) - len(rest.lstrip(" ,"))
        rest, gap = rest[lead:], gap + lead
        if not rest:
            return out
        t = _TIME.match(rest)
        if t and t["t"] is not None and width[rest_at(t, "t", gap)] not in (4, 6):
            t = None
        if t and t["p"] and t["q"]:
            return None
        if t:
            for g, name in (("h", "h"), ("i", "i"), ("s", "s"), ("f", "f"), ("t", "hms"), ("g", "f"), ("p", "half"), ("q", "half")):
                if t[g] is not None:
                    out[name] = rest_at(t, g, gap)
            rest, gap = rest[t.end() :], gap + t.end()
            lead = len(rest) - len(rest.lstrip(" "))
            rest, gap = rest[lead:], gap + lead
        o = _OFFSET.fullmatch(rest)
        if not o:
            return None
        for g, name in (("o", "word"), ("u", "off"), ("v", "off_min"), ("z", "zone")):
            if o[g] is not None:
                out[name] = rest_at(o, g, gap)
        if o["k"] == "-":
            out["west"] = 1
        return out
    return None


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970 of civil dates in the proleptic Gregorian calendar."""
    y = np.where(m <= 2, y - 1, y)
    shifted = (m + 9) % 12
    year_days = 365 * y + y // 4 - y // 100 + y // 400
    return year_days + (shifted * 306 + 5) // 10 + d - 1 - 719_468


def _length(y: np.ndarray, m: np.ndarray) -> np.ndarray:
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    return np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.clip(m, 0, 12)] + (leap & (m == 2))


def _convert(codes: np.ndarray, texts: np.ndarray, mask: str, program: dict, zones: np.ndarray, months: dict, halves: dict) -> tuple[np.ndarray, np.ndarray]:
    """Instants of the values of one mask and program, and which of them exist."""
    tokens, n = _tokens(mask), len(codes)

    def number(k: int, first: int | None = None, last: int | None = None) -> np.ndarray:
        _, s, e = tokens[k]
        s, e = s + (first or 0), e if last is None else s + last
        e = min(e, s + 18)
        return (codes[:, s:e].astype(np.int64) - 48) @ (10 ** np.arange(e - s - 1, -1, -1, dtype=np.int64))

    def micros(k: int | None) -> np.ndarray | int:
        if k is None:
            return 0
        width = min(6, tokens[k][2] - tokens[k][1])
        return number(k, 0, width) * 10 ** (6 - width)

    ok = np.ones(n, bool)
    if "number" in program:
        k = program["number"]
        if tokens[k][2] - tokens[k][1] > 17:
            return np.zeros(n, np.int64), ~ok
        v = number(k)
        unit = np.where(v < 10**11, 10**6, np.where(v < 10**14, 1000, 1))
        part = np.asarray(micros(program.get("fraction"))) * unit // 10**6
        out = v * unit + part
        return (-out if program["sign"] else out), ok

    if "compact" in program:
        k = program["compact"]
        y, m, d = number(k, 0, 4), number(k, 4, 6), number(k, 6, 8)
    else:
        y, d = number(program["y"]), number(program["d"])
        m = months[program["m"]] if program["m"] in months else number(program["m"])
        if tokens[program["y"]][2] - tokens[program["y"]][1] == 2:
            y = y + np.where(y < 70, 2000, 1900)
    ok &= (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1)
    ok &= d <= _length(y, m)
    zero = np.zeros(n, np.int64)
    if "hms" in program:
        k = program["hms"]
        h, i = number(k, 0, 2), number(k, 2, 4)
        s = number(k, 4, 6) if tokens[k][2] - tokens[k][1] == 6 else zero
    else:
        h, i, s = (number(program[x]) if x in program else zero for x in "his")
    if "half" in program:
        later = halves[program["half"]]
        ok &= (h <= 12) | (later == 1)
        h = np.where(later == 1, np.where(h < 12, h + 12, h), np.where(h == 12, 0, h))
    ok &= (h <= 23) & (i <= 59) & (s <= 59)
    local = _days(y, m, d) * 86400 + h * 3600 + i * 60 + s
    part = micros(program.get("f"))

    known = np.zeros(n, bool)
    offset = np.zeros(n, np.int64)
    if "off" in program:
        k = program["off"]
        width = tokens[k][2] - tokens[k][1]
        if width > 4 or "off_min" in program and width > 2:
            return zero, ~ok
        v = number(k)
        hours, minutes = (v // 100, v % 100) if width > 2 else (v, number(program["off_min"]) if "off_min" in program else zero)
        ok &= (hours <= 18) & (minutes <= 59)
        offset = (hours * 3600 + minutes * 60) * (-1 if "west" in program else 1)
        known[:] = True
    elif "word" in program:
        _, a, b = tokens[program["word"]]
        words = np.array([t[a:b].replace(".", "") for t in texts])
        for w, z in set(zip(words, zones, strict=True)):
            these = (words == w) & (zones == z)
            v = abbreviation_offset(z, w)
            if v is None:
                ok &= ~these
            else:
                offset[these], known[these] = v, True
    utc = local - offset
    if not known.all():
        used = np.array([t[slice(*tokens[program["zone"]][1:])] for t in texts]) if "zone" in program else zones
        for z in set(used):
            these = (used == z) & ~known
            utc[these] = zone_table(z).to_utc(local[these])
    return utc * 10**6 + part, ok


def _parse_block(mask: str, part: np.ndarray, zones: np.ndarray, orders: np.ndarray, rows: np.ndarray, out: np.ndarray, ok: np.ndarray) -> None:
    """Parses values of one mask and writes their instants into ``out`` and ``ok`` at ``rows``."""
    codes = np.array(part.tolist(), dtype=f"U{len(mask)}").view(np.uint32).reshape(len(rows), len(mask))
    kinds, values_of = [], {}
    for k, (kind, s, e) in enumerate(_tokens(mask)):
        if kind == "w":
            words, back = np.unique(np.array([t[s:e] for t in part], dtype=f"U{e - s}"), return_inverse=True)
            both = np.array([_word(w) for w in words])
            kinds.append(both[back, 0])
            values_of[k] = both[back, 1]
    key = pd.Series(list(zip(*kinds, orders, strict=True)))
    for each, inside in key.groupby(key).indices.items():
        each = each if isinstance(each, tuple) else (each,)
        program = _program(mask, tuple(int(x) for x in each[:-1]), each[-1])
        if program is None:
            continue
        picked = {k: v[inside] for k, v in values_of.items()}
        instant, exists = _convert(codes[inside], part[inside], mask, program, zones[inside], picked, picked)
        out[rows[inside]], ok[rows[inside]] = instant, exists


def parse_instants(values: list[str | None], zones: list[str | None], orders: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Microseconds since 1970 in UTC of each value, and whether it fixes at least a date.

    Null, blank, relative and impossible values and times without a date do not.
    """
    n = len(values)
    out, ok = np.zeros(n, np.int64), np.zeros(n, bool)
    texts = np.array([clean(v) if v else "" for v in values], dtype=object)
    zone_a = np.array([z or "" for z in zones], dtype=object)
    order_a = np.array([(o or "").strip().lower() for o in orders], dtype=object)
    masks = np.array([t.translate(_CLASSES) for t in texts], dtype=object)
    for mask, every in pd.Series(np.arange(n)).groupby(masks).indices.items():
        if "9" not in mask:
            continue
        step = max(1, BLOCK // len(mask))
        for k in range(0, len(every), step):
            rows = every[k : k + step]
            _parse_block(mask, texts[rows], zone_a[rows], order_a[rows], rows, out, ok)
    return out, ok


def _parse_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        f = f.astype(object).where(f.notna(), None)
        instant, ok = parse_instants(f["value"].tolist(), f["zone"].tolist(), f["date_order"].tolist())
        yield pd.DataFrame({"id": f["id"][ok].astype("int64"), "instant_us": instant[ok]})


def normalise_timestamps(rows: DataFrame, specs: DataFrame, id_col: str = "pos", value_col: str = "published_at", source_col: str = "source", out_col: str = "published_us") -> DataFrame:
    """(id, instant) of each row of ``rows`` whose value fixes at least a calendar date.

    ``specs`` has source_name, zone and date_order. A source that it lacks, or has with a null zone, is
    read as UTC, and its all-number dates as day, month, year. A source_name listed several times counts
    once (the least zone and order). Null and unusable values have no row; a null id gives no row.
    Extra columns are ignored. The one join is on the small list of sources, which Spark broadcasts if it
    is within its own limit; there is no other shuffle.
    """
    own = rows.select(F.col(id_col).cast("long").alias("id"), F.col(value_col).alias("value"), F.col(source_col).alias("_s")).where("id is not null and value is not null")
    zones = specs.groupBy(F.col("source_name").alias("_s")).agg(F.min("zone").alias("zone"), F.min("date_order").alias("date_order"))
    joined = own.join(zones, "_s", "left").select("id", "value", "zone", "date_order")
    return joined.mapInPandas(_parse_frames, OUTPUT).select(F.col("id").alias(id_col), F.col("instant_us").alias(out_col))
