"""Transition tables of time zones as arrays, for vectorised conversion of local times.

A table is built once per zone and process by walking the installed zone data; ``version()`` names
the release it came from, so results can be traced to one version of the rules.
"""

from __future__ import annotations

import zoneinfo
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from pathlib import Path

import numpy as np

#: Years that the tables cover; before and after, the first and last offset hold.
FIRST_YEAR, LAST_YEAR = 1900, 2100
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def version() -> str:
    """Release of the zone data in use."""
    try:
        import tzdata

        packaged = tzdata.IANA_VERSION
    except ImportError:
        packaged = "unknown"
    for at in zoneinfo.TZPATH:
        head = Path(at, "tzdata.zi")
        if head.exists():
            return head.open().readline().replace("# version", "").strip()
        if Path(at).exists():
            return "system"
    return packaged


@dataclass(frozen=True)
class ZoneTable:
    """``offsets[i]`` holds from ``starts[i]``; ``local_from[i]`` is the local second from which it is
    applied. A local time that occurs twice is thus the earlier one, and a skipped one is read with
    the offset before the change. All in seconds."""

    starts: np.ndarray
    local_from: np.ndarray
    offsets: np.ndarray
    names: dict[str, int]

    def to_utc(self, local: np.ndarray) -> np.ndarray:
        """Local seconds (as if UTC) to UTC seconds."""
        at = np.searchsorted(self.local_from, local, side="right") - 1
        return local - self.offsets[np.maximum(at, 0)]


@lru_cache(maxsize=None)
def zone_table(name: str | None) -> ZoneTable:
    """Table of an IANA zone. A null, blank or unknown name is read as UTC."""
    try:
        zone = zoneinfo.ZoneInfo((name or "").strip() or "UTC")
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        zone = zoneinfo.ZoneInfo("UTC")

    def state(second: int) -> tuple[int, str]:
        at = (_EPOCH + timedelta(seconds=second)).astimezone(zone)
        return int(at.utcoffset().total_seconds()), at.tzname()

    low = int((datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds())
    high = int((datetime(LAST_YEAR, 12, 31, tzinfo=timezone.utc) - _EPOCH).total_seconds())
    step, now = 10 * 86400, state(low)
    starts, offsets, names = [-(2**62)], [now[0]], {now[1]: now[0]}
    second = low
    while second < high:
        ahead = state(second + step)
        if ahead != now:
            left, right = second, second + step
            while right - left > 1:
                middle = (left + right) // 2
                left, right = (middle, right) if state(middle) == now else (left, middle)
            now = state(right)
            names[now[1]] = now[0]
            if now[0] != offsets[-1]:
                starts.append(right)
                offsets.append(now[0])
            second = right
        else:
            second += step
    starts_a, offsets_a = np.array(starts, np.int64), np.array(offsets, np.int64)
    before = np.concatenate([offsets_a[:1], offsets_a[:-1]])
    return ZoneTable(starts_a, starts_a + np.maximum(before, offsets_a), offsets_a, names)


#: Offsets in hours of abbreviations that a source's own zone does not use.
COMMON_ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 1, "BST": 1, "CET": 1, "CEST": 2, "MEZ": 1, "MESZ": 2,
    "EET": 2, "EEST": 3, "MSK": 3, "IST": 5.5, "CST": -6, "CDT": -5, "EST": -5, "EDT": -4, "MST": -7, "MDT": -6,
    "PST": -8, "PDT": -7, "AKST": -9, "AKDT": -8, "HST": -10, "BRT": -3, "BRST": -2, "ART": -3, "JST": 9, "KST": 9,
    "HKT": 8, "SGT": 8, "AWST": 8, "ACST": 9.5, "ACDT": 10.5, "AEST": 10, "AEDT": 11, "NZST": 12, "NZDT": 13,
}


#: Names that are written for a zone besides those its data has: German ones of Berlin, Brazil's.
_LOCAL_NAMES = {"MEZ": "CET", "MESZ": "CEST", "BRT": "-03", "BRST": "-02"}


def abbreviation_offset(zone: str | None, word: str) -> int | None:
    """Seconds from UTC of an abbreviation as it is used in a zone, else as it is commonly used."""
    word = word.upper()
    names = zone_table(zone).names
    if word in names:
        return names[word]
    if _LOCAL_NAMES.get(word) in names:
        return names[_LOCAL_NAMES[word]]
    hours = COMMON_ABBREVIATIONS.get(word)
    return None if hours is None else int(hours * 3600)
