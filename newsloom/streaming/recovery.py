"""The recovery of an account's login as a state machine over polls, for batch replay and streams."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ENABLED = 1
CONFIRMING, DETECTED, REFRESHED, FAILED = "confirming", "detected", "refreshed", "failed"
STATE = "last_status int, last_updated long, disabled_since string, event string, phase string, confirmations int, dates string, processed string"
OUTPUT = "account string, polled_at timestamp, action string, event string, dates string, phase string, disabled_since string"
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]
_ZONE = ZoneInfo("Asia/Shanghai")


@dataclass
class Watch:
    """What is remembered of one account. ``dates`` are the days to recover, joined by commas."""

    last_status: int | None = None
    last_updated: int | None = None
    disabled_since: str | None = None
    event: str | None = None
    phase: str | None = None
    confirmations: int = 0
    dates: str | None = None
    processed: str | None = None

    def forget(self) -> None:
        self.event = self.phase = self.dates = None
        self.confirmations = 0


def login_event(account: str, updated_ms: int) -> str:
    """Identity of one login: its local time and a hash of account and time."""
    at = datetime.fromtimestamp(updated_ms / 1000, timezone.utc).astimezone(_ZONE)
    return f"login-{at:%Y%m%dT%H%M%S}-{hashlib.sha256(f'{account}:{updated_ms}'.encode()).hexdigest()[:12]}"


def days_to_recover(disabled_since: str | None, today: date, most: int = 7) -> list[str]:
    """Days from the one before the account was disabled (before today if unknown) through today, the last ``most``."""
    first = (date.fromisoformat(disabled_since) if disabled_since else today) - timedelta(days=1)
    first = max(first, today - timedelta(days=most - 1))
    return [str(first + timedelta(days=k)) for k in range((today - first).days + 1)]


def step(w: Watch, account: str, polled_at: datetime, status: int, updated_ms: int, refresh_ok: bool, dispatch_ok: bool, confirm: int = 2, most_days: int = 7, recent_s: int = 600) -> str:
    """Takes one poll into the state and gives the action.

    An event that was refreshed but not dispatched is dispatched first, without another refresh. A disabled
    account is remembered with the first day of it, and an event in confirmation fails. A login is a change
    from disabled to enabled, a newer update time, or a recent one at the very first poll; it must be seen in
    ``confirm`` polls before feeds are refreshed and the event dispatched. A failed refresh fails the event.
    """
    if w.phase == REFRESHED:
        if not dispatch_ok:
            return "dispatch failed"
        w.processed = w.event
        w.forget()
        return "dispatched"
    before_status, before_updated = w.last_status, w.last_updated or 0
    w.last_status, w.last_updated = status, updated_ms
    local = polled_at.replace(tzinfo=timezone.utc).astimezone(_ZONE) if polled_at.tzinfo is None else polled_at.astimezone(_ZONE)
    if status != ENABLED:
        w.disabled_since = w.disabled_since or str(local.date())
        if w.phase == CONFIRMING:
            w.phase = FAILED
        return "disabled"
    event = login_event(account, updated_ms)
    if w.phase == CONFIRMING and w.event == event:
        w.confirmations += 1
        if w.confirmations < confirm:
            return "awaiting confirmation"
        w.phase = DETECTED
        if not refresh_ok:
            w.phase = FAILED
            return "refresh failed"
        w.phase = REFRESHED
        if not dispatch_ok:
            return "dispatch failed"
        w.processed, w.disabled_since = event, None
        w.forget()
        return "dispatched"
    first_and_recent = before_status is None and updated_ms > 0 and local.timestamp() - updated_ms / 1000 <= recent_s
    is_login = before_status == 0 or before_status == ENABLED and updated_ms > before_updated or first_and_recent
    if not is_login or w.processed == event:
        w.disabled_since = None
        return "no change"
    w.event, w.phase, w.confirmations = event, CONFIRMING, 1
    w.dates = ",".join(days_to_recover(w.disabled_since, local.date(), most_days))
    return "awaiting confirmation"


def _run(account: str, w: Watch, polls: pd.DataFrame) -> list[tuple]:
    out = []
    for p in polls.sort_values(["polled_at", "poll_id"]).itertuples():
        asked = (w.event, w.dates)
        action = step(w, account, p.polled_at.to_pydatetime(), int(p.status), int(p.updated_ms), bool(p.refresh_ok), bool(p.dispatch_ok))
        event, dates = (w.event, w.dates) if w.event else asked
        out.append((account, p.polled_at, action, event, dates, w.phase, w.disabled_since))
    return out


def replay(polls: DataFrame) -> DataFrame:
    """State after each poll of a bounded table (account, poll_id, polled_at, status, updated_ms, refresh_ok, dispatch_ok).

    Rows with a null account, time, status or update are dropped; null flags are false. Polls of one
    account are taken in order, so an account is one group: its size is bounded by the polling interval.
    """

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_run(key[0], Watch(), frame), columns=_NAMES)

    whole = polls.where("account is not null and polled_at is not null and status is not null and updated_ms is not null").fillna(False, ["refresh_ok", "dispatch_ok"])
    return whole.groupBy("account").applyInPandas(run, OUTPUT)


def watch(polls: DataFrame) -> DataFrame:
    """The same over a stream of polls, with the state of each account kept between batches."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        w = Watch(*(None if v is None or v != v else v for v in held.get)) if held.exists else Watch()
        out = _run(key[0], w, pd.concat(list(frames)))
        held.update(astuple(w))
        yield pd.DataFrame(out, columns=_NAMES)

    return polls.groupBy("account").applyInPandasWithState(run, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
