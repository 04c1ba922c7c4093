"""Dates and times of a fixed offset zone, as expressions over instants (the session zone must be UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the zone of the daily runs.
DAY_ZONE = "Asia/Shanghai"


def local_day(instant: Column, zone: str = DAY_ZONE) -> Column:
    """Calendar date of an instant in a zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def day_bounds(day: Column, zone: str = DAY_ZONE) -> tuple[Column, Column]:
    """First instant of a local day and of the next, for range filters that reach the scan."""
    start = F.to_utc_timestamp(day.cast("timestamp"), zone)
    return start, F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone)


def from_epoch(value: Column) -> Column:
    """Instant of seconds or, above 10 billion, milliseconds since 1970."""
    number = value.cast("double")
    return F.timestamp_seconds(F.when(number > 10_000_000_000, number / 1000).otherwise(number))


def epoch_ms(instant: Column) -> Column:
    """Milliseconds since 1970."""
    return F.unix_millis(instant)


def day_ms(day: Column, zone: str = DAY_ZONE) -> Column:
    """Milliseconds since 1970 of a local day's start."""
    return F.unix_millis(F.to_utc_timestamp(day.cast("timestamp"), zone))


def previous_days(today: Column, days: int) -> Column:
    """Array of the ``days`` dates before today, latest first."""
    return F.transform(F.sequence(F.lit(1), F.lit(days)), lambda i: F.date_sub(today, i))


def recovery_days(disabled: Column, today: Column, most: int = 7) -> Column:
    """Dates from the day before ``disabled`` (or before today if null) through today, the last ``most`` at most."""
    first = F.greatest(F.date_sub(F.coalesce(disabled, today), 1), F.date_sub(today, most - 1))
    return F.sequence(F.least(first, today), today, F.expr("interval 1 day"))


def event_id(account: Column, updated_ms: Column, zone: str = DAY_ZONE) -> Column:
    """Identity of a login: login-, its local time, and 12 hex digits of the SHA-256 of account and time in milliseconds."""
    local = F.from_utc_timestamp(F.timestamp_millis(updated_ms), zone)
    digest = F.substring(F.sha2(F.concat(account.cast("string"), F.lit(":"), updated_ms.cast("string")), 256), 1, 12)
    return F.concat(F.lit("login-"), F.date_format(local, "yyyyMMdd'T'HHmmss"), F.lit("-"), digest)


def iso_instant(text: Column, zone: str = DAY_ZONE) -> Column:
    """Instant of a date, or date and time, in ISO form; fractions beyond microseconds are cut, a time without zone is in
    ``zone``; null for anything else."""
    t = F.regexp_replace(F.trim(text), r"(?<=\d)\.(\d{6})\d+(?=(?:[+-]\d{2}:?\d{2}|Z)?$)", ".$1")
    t = F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = t.rlike(r"[T ]\d{2}:?\d{2}.*(?:Z|[+-]\d{2}:\d{2})$")
    local = F.to_utc_timestamp(F.try_to_timestamp(F.when(~zoned, t)), zone)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.when(zoned, F.try_to_timestamp(F.when(zoned, t))).otherwise(local))


def rfc_instant(text: Column) -> Column:
    """Instant of a date as in mail headers, with an offset or GMT; null for anything else."""
    t = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", ""), r"\b(?:GMT|UTC|UT|Z)$", "+0000")
    t = F.when(t.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}(?::\d{2})? [+-]\d{4}$"), t)
    return F.coalesce(F.try_to_timestamp(t, F.lit("d MMM yyyy H:mm:ss xx")), F.try_to_timestamp(t, F.lit("d MMM yyyy H:mm xx")))


def entry_instant(texts: list[Column], day: Column, zone: str = DAY_ZONE) -> Column:
    """Instant of a feed's entry: the first of the texts that is a time, as in mail headers or in ISO form, else the
    start of the day."""
    start = F.to_utc_timestamp(day.cast("timestamp"), zone)
    return F.coalesce(*(F.coalesce(rfc_instant(t), iso_instant(t, zone)) for t in texts), start)
