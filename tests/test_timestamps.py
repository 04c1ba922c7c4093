from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.functions.zones import zone_table
from newsloom.operators.timestamps import normalise_timestamps, parse_instants


def us(*parts: int, zone: str = "UTC") -> int:
    at = datetime(*parts, tzinfo=ZoneInfo(zone))
    return round((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds()) * 10**6


def parse(value, zone="Asia/Shanghai", order="ymd"):
    out, ok = parse_instants([value], [zone], [order])
    return int(out[0]) if ok[0] else None


CASES = [
    ("2026-04-01 13:02", "Asia/Shanghai", "ymd", us(2026, 4, 1, 5, 2)),
    ("2026-04-10T03:53:15Z", "America/Sao_Paulo", "dmy", us(2026, 4, 10, 3, 53, 15)),
    ("2026-04-10T03:53:15,250Z", "UTC", "ymd", us(2026, 4, 10, 3, 53, 15) + 250_000),
    ("2025-09-12T10:37:28.1234567+08:00", "Asia/Shanghai", "ymd", us(2025, 9, 12, 2, 37, 28) + 123_456),
    ("2025-08-21T23:14:11-0300", "Asia/Shanghai", "ymd", us(2025, 8, 22, 2, 14, 11)),
    ("20250911T053505Z", "Asia/Tokyo", "ymd", us(2025, 9, 11, 5, 35, 5)),
    ("Wed, 10 Sep 2025 03:37:41 GMT", "Europe/Berlin", "dmy", us(2025, 9, 10, 3, 37, 41)),
    ("Fri, 12 Sep 2025 17:21:48 BST", "Europe/London", "dmy", us(2025, 9, 12, 16, 21, 48)),
    ("Tue, 16 Sep 2025 20:07:11 CST", "Asia/Shanghai", "ymd", us(2025, 9, 16, 12, 7, 11)),
    ("Tue, 16 Sep 2025 20:07:11 CST", "America/Chicago", "mdy", us(2025, 9, 17, 2, 7, 11)),
    ("Tue, 16 Sep 2025 20:07:11 IST", "Asia/Kolkata", "dmy", us(2025, 9, 16, 14, 37, 11)),
    ("Apr 4, 2026 12:36:48 PM EDT", "America/New_York", "mdy", us(2026, 4, 4, 16, 36, 48)),
    ("Apr 1, 2026 12:29 AM", "Asia/Tokyo", "ymd", us(2026, 3, 31, 15, 29)),
    ("2026年3月19日 下午2:04", "Asia/Shanghai", "ymd", us(2026, 3, 19, 6, 4)),
    ("2026年4月1日 上午12:24", "Asia/Shanghai", "ymd", us(2026, 3, 31, 16, 24)),
    ("２０２５－０９－０１　１７：４７", "Asia/Shanghai", "ymd", us(2025, 9, 1, 9, 47)),
    ("03/04/2026 10:00", "America/New_York", "mdy", us(2026, 3, 4, 15)),
    ("03/04/2026 10:00", "Europe/London", "dmy", us(2026, 4, 3, 9)),
    ("29.03.2026 01:53 Uhr", "Europe/Berlin", "dmy", us(2026, 3, 29, 0, 53)),
    ("2026-03-23T18:12:30+09:00[Asia/Tokyo]", "UTC", "ymd", us(2026, 3, 23, 9, 12, 30)),
    ("2025-09-12 06:14:53 UTC+8", "UTC", "ymd", us(2025, 9, 11, 22, 14, 53)),
    ("2026-04-09", "Asia/Shanghai", "ymd", us(2026, 4, 8, 16)),
    ("1775411814", "Asia/Shanghai", "ymd", 1775411814 * 10**6),
    ("  1757891815608\n", "Asia/Shanghai", "ymd", 1757891815608 * 1000),
    ("1774259796021827", "Asia/Shanghai", "ymd", 1774259796021827),
    ("1757079908.5631239", "Asia/Shanghai", "ymd", 1757079908563123),
    ("5 de septiembre de 2025 10:00", "America/Mexico_City", "dmy", us(2025, 9, 5, 16)),
    ("12. März 2026, 08:15 Uhr", "Europe/Berlin", "dmy", us(2026, 3, 12, 7, 15)),
    # an hour that occurs twice is the earlier one; a skipped one is read with the offset before
    ("2026-10-25 02:30", "Europe/Berlin", "dmy", us(2026, 10, 25, 0, 30)),
    ("2026-03-29 02:30", "Europe/Berlin", "dmy", us(2026, 3, 29, 1, 30)),
    ("2026-11-01 01:15:00", "America/New_York", "mdy", us(2026, 11, 1, 5, 15)),
]


@pytest.mark.parametrize(("value", "zone", "order", "expected"), CASES)
def test_spellings(value, zone, order, expected):
    assert parse(value, zone, order) == expected


@pytest.mark.parametrize("value", [None, "", "  ", "null", "N/A", "unknown", "yesterday", "刚刚", "3小时前", "上周五", "12:40", "0000-00-00 00:00:00", "2026-02-30 08:15", "2025-13-07T10:00:00Z", "2026-04-18 25:61", "2025-11-31", "2 hours ago", "1" * 30, "2025-01-01 " + "x" * 5000])
def test_no_instant(value):
    assert parse(value) is None


@settings(max_examples=300, deadline=None)
@given(st.datetimes(datetime(1975, 1, 1), datetime(2090, 1, 1)), st.sampled_from(["Asia/Shanghai", "America/New_York", "Europe/Berlin", "Australia/Sydney", "America/Sao_Paulo", "Asia/Kolkata"]))
def test_local_times_against_zoneinfo(local, zone):
    """fold=0 is the earlier of two, and for a skipped time the offset before the change."""
    local = local.replace(microsecond=0)
    expected = round((local.replace(tzinfo=ZoneInfo(zone), fold=0) - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds())
    seconds = int((local - datetime(1970, 1, 1)).total_seconds())
    assert zone_table(zone).to_utc(np.array([seconds]))[0] == expected
    assert parse(f"{local:%Y-%m-%d %H:%M:%S}", zone) == expected * 10**6


def test_operator_cases(spark):
    rows = spark.createDataFrame(
        [(1, "A", "2026-04-09", "x"), (2, "B", "2026-04-09 10:00", "x"), (2, "B", "2026-04-09 10:00", "x"), (3, None, "2026-04-09", "x"), (None, "A", "2026-04-09", "x"), (4, "A", None, "x"), (5, "unlisted", "2026-04-09T00:00:00Z", "x")],
        "pos long, source string, published_at string, zone string",
    )
    specs = spark.createDataFrame([("A", "Asia/Shanghai", "ymd"), ("A", "Asia/Shanghai", "ymd"), ("B", None, None)], "source_name string, zone string, date_order string")
    got = sorted(map(tuple, normalise_timestamps(rows, specs).collect()))
    assert got == [(1, us(2026, 4, 8, 16)), (2, us(2026, 4, 9, 10)), (2, us(2026, 4, 9, 10)), (3, us(2026, 4, 9)), (5, us(2026, 4, 9))]
    assert normalise_timestamps(rows.limit(0), specs.limit(0)).count() == 0


def test_long_values_are_read(spark):
    from newsloom.operators.timestamps import parse_instants

    good = "2026-01-02 03:04:05"
    values = [good, good + " " * 300, " " * 5000 + good, "x" * 100_000 + "9", good + "\n" * 4_000_000]
    instants, ok = parse_instants(values, ["UTC"] * 5, ["ymd"] * 5)
    assert list(ok) == [True, True, True, False, True] and len({int(i) for i, o in zip(instants, ok) if o}) == 1
