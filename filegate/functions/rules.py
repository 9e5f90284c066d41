"""Business rules of the group state machine as column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must stay equal to the reference for identical results) -----------
STATUS_OPEN = "OPEN"
STATUS_READY = "READY"
STATUS_DISPATCHED = "DISPATCHED"
REASON_ALL_PARTS = "ALL_PARTS"
REASON_TIMEOUT = "TIMEOUT"
DISPATCH_STATUS_SENT = "SENT"
SEVERITY_INFO = "INFO"
SEVERITY_WARN = "WARN"
DEFAULT_TIMEOUT_MINUTES = 30
DEFAULT_DISPATCH_LIMIT = 10_000
# ---------------------------------------------------------------------------------------

STICKY_STATUSES = (STATUS_READY, STATUS_DISPATCHED)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_literal(value: _dt.datetime | str | Column | None, ntz: bool = False) -> Column:
    """One processing-time value for a whole run.

    ``None`` means the current time (taken once per query); a ``datetime`` or ISO text is
    a fixed value, typed as ``TIMESTAMP_NTZ`` when ``ntz`` (the shared test tables are
    NTZ), else as ``TIMESTAMP``: naive values are read as UTC, so the instant does not
    depend on the session time zone.
    """
    if isinstance(value, Column):
        return value
    if value is None:
        now = F.current_timestamp()
        return now.cast("timestamp_ntz") if ntz else now
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    # a naive value is a UTC wall time; an aware one keeps its instant (any session zone)
    aware = value if value.tzinfo is not None else value.replace(tzinfo=_dt.timezone.utc)
    if ntz:
        utc = aware.astimezone(_dt.timezone.utc)
        return F.to_timestamp_ntz(F.lit(utc.strftime("%Y-%m-%d %H:%M:%S.%f")))
    return F.lit(aware).cast("timestamp")


def expires_at(first_seen_at: Column | str, timeout_minutes: int) -> Column:
    """Deadline of a group: first arrival plus the timeout."""
    return _col(first_seen_at) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(timeout_minutes)))


def ready_reason(expected_parts: Column | str, received_parts: Column | str,
                 expires: Column | str, now: Column) -> Column:
    """``ALL_PARTS`` when the expected count is known and reached (wins), else
    ``TIMEOUT`` once ``now`` has passed the deadline, else null."""
    expected = _col(expected_parts)
    complete = expected.isNotNull() & (_col(received_parts) >= expected)
    return F.when(complete, F.lit(REASON_ALL_PARTS)).when(now >= _col(expires), F.lit(REASON_TIMEOUT))


def incomplete_flag(reason: Column | str, expected_parts: Column | str,
                    received_parts: Column | str) -> Column:
    """True only for a timeout with a known expected count that was not reached."""
    expected = _col(expected_parts)
    flag = (_col(reason) == REASON_TIMEOUT) & expected.isNotNull() & (_col(received_parts) < expected)
    return F.coalesce(flag, F.lit(False))


def carried_status(current_status: Column | str) -> Column:
    """Status after a refresh: READY and DISPATCHED are sticky, anything else is OPEN."""
    status = _col(current_status)
    return F.when(status.isin(*STICKY_STATUSES), status).otherwise(F.lit(STATUS_OPEN))


def should_dispatch(status: Column | str, already_dispatched: Column | str) -> Column:
    return (_col(status) == STATUS_READY) & ~F.coalesce(_col(already_dispatched), F.lit(False))


def resolved_expected(stored_expected: Column | str, first_manifest_expected: Column | str) -> Column:
    """First writer wins across runs: a stored count is never replaced."""
    return F.coalesce(_col(stored_expected), _col(first_manifest_expected))
