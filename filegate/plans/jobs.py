"""The three jobs - ingest, evaluate, dispatch - over the control tables.

Each job runs one step of ``steps.py`` and writes its results in an order that makes a
re-run after a crash at any point converge to the same tables:

1. the audit events (deterministic ids; stored ids are skipped);
2. the rows of the insert-only tables (stored keys are skipped, row by row);
3. the group state, last: a version that appears whole or not at all (``sources/state.py``).

A crash after 1 or 2 leaves rows whose keys the re-run produces again and skips; one inside 3 leaves the old state.

Evaluate reads the runs of ``file_events`` that no version covers and merges them into the stored partials
of their groups: part numbers as bitmaps, announced counts as rows, first and last arrival in the state row. It
writes the groups that were created, that changed, or that became ready. ``incremental_refresh=False`` folds
all events anew and writes a whole version. Counters come back as one small row per job.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filegate.functions import rules
from filegate.functions.rules import DEFAULT_DISPATCH_LIMIT, DEFAULT_TIMEOUT_MINUTES, timestamp_literal
from filegate.operators import audit, dispatch, groups, register
from filegate.plans.steps import DispatchStep, EvaluateStep, IngestOptions, IngestStep, ready_left
from filegate.session import materialize, staged_frames
from filegate.sources.landing import read_landing
from filegate.sources.listing import read_landing_spread
from filegate.sources.tables import ControlTables, date_ranges


@dataclass(frozen=True)
class FilegateConfig:
    tables_root: str
    landing: str = ""
    checkpoints_root: str = ""
    group_timeout_minutes: int = DEFAULT_TIMEOUT_MINUTES
    checksum: str | None = None
    arrival: str = "ingest"
    strict: bool = False
    strict_manifest: bool = False
    timezone: str = "UTC"
    dispatch_batch_limit: int | None = DEFAULT_DISPATCH_LIMIT
    incremental_refresh: bool = True
    merge_runs_from: int = 50
    spread_listing: bool = False
    archive: str = ""
    max_file_age: str | None = None

    @property
    def ingest_checkpoint(self) -> str:
        return f"{self.checkpoints_root.rstrip('/')}/ingest_landing"

    @property
    def ingest_options(self) -> IngestOptions:
        return IngestOptions(self.arrival, self.checksum, self.strict, self.strict_manifest, self.timezone)


def _now(value) -> _dt.datetime:
    if value is None:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, str):
        return _dt.datetime.fromisoformat(value)
    return value


def _job(run):
    """A job removes the frames that it staged, whether it ends well or not."""

    @wraps(run)
    def cleaned(spark: SparkSession, *args, **named) -> dict:
        with staged_frames(spark):
            return run(spark, *args, **named)

    return cleaned


def _row_dict(df: DataFrame) -> dict:
    row = df.first()
    return {k: int(v or 0) for k, v in row.asDict().items()} if row else {}


def _append_audit(store: ControlTables, events: DataFrame, now_col: Column) -> int:
    return store.insert_if_absent("audit", materialize(audit.prepare_audit(events, now_col))).count()


# --- ingest -------------------------------------------------------------------------------

@_job
def ingest_batch(spark: SparkSession, config: FilegateConfig, raw: DataFrame, now=None,
                 store: ControlTables | None = None) -> dict:
    """Register one landing listing batch; returns the registration counters."""
    store = store or ControlTables(spark, config.tables_root)
    now_col = timestamp_literal(_now(now))
    stored = lambda batch: store.near("file_events", batch).select("file_business_key")
    step = IngestStep(raw, now_col, stored, config.ingest_options)
    counters = _row_dict(step.counters)
    counters["audit_events"] = _append_audit(store, step.audit_events, now_col)
    store.close_stopped_runs()
    if counters["inserted"]:
        store.append("file_events", step.inserted)
    return counters


def run_ingest(spark: SparkSession, config: FilegateConfig, now=None) -> dict:
    """Batch ingest of everything under ``config.landing`` (a missing folder is empty)."""
    store = ControlTables(spark, config.tables_root)
    store.ensure()
    read = read_landing_spread if config.spread_listing else read_landing
    raw = read(spark, config.landing, all_content=config.checksum is not None)
    return ingest_batch(spark, config, raw, now=now, store=store)


# --- evaluate -------------------------------------------------------------------------------

STATE_DATES = "dt_ref"


def _dates_rule(df: DataFrame) -> Column:
    """A partition filter with the dates of ``df``: few ranges, one row per calendar month on the driver."""
    months = df.groupBy(F.trunc(STATE_DATES, "month")).agg(F.min(STATE_DATES), F.max(STATE_DATES)).collect()
    rule = F.lit(False)
    for first, last in date_ranges([(r[1], r[2]) for r in months if r[0] is not None]):
        rule = rule | F.col(STATE_DATES).between(F.lit(first), F.lit(last))
    return rule


class Fold:
    """New events merged with the stored partials of their groups; ``whole`` folds all events with nothing stored."""

    def __init__(self, store: ControlTables, events: DataFrame, whole: bool):
        events = register.valid_events(events)
        spans = groups.span_partials(events)
        bitmaps, announced = groups.bitmap_partials(events), groups.announced_partials(events)
        if not whole:
            touched = materialize(events.select("group_key", STATE_DATES).distinct())
            rule, keys = _dates_rule(touched), touched.select("group_key")
            stored = {n: store.state.read(n, rule).join(keys, "group_key", "left_semi")
                      for n in ("groups", "part_bitmaps", "announced")}
            spans = groups.merge_spans(spans, stored["groups"].select("group_key", "first_seen_at", "last_seen_at"))
            bitmaps = groups.merge_bitmaps(bitmaps, stored["part_bitmaps"])
            announced = groups.merge_announced(announced, stored["announced"])
        self.spans, self.part_bitmaps, self.announced = spans, materialize(bitmaps), materialize(announced)

    def aggregate(self, timeout_minutes: int, now: Column) -> DataFrame:
        return groups.aggregate_partials(self.spans, self.part_bitmaps, self.announced, timeout_minutes, now)


@_job
def run_evaluate(spark: SparkSession, config: FilegateConfig, now=None) -> dict:
    """Fold the files registered since the last version into the group state, then mark ready groups."""
    store = ControlTables(spark, config.tables_root)
    store.ensure()
    now_col = timestamp_literal(_now(now))
    live = store.state.live()
    whole = not config.incremental_refresh
    folded = live[-1].run if live else -1
    timeout = config.group_timeout_minutes
    run = max(store.new_runs(folded), default=folded)
    fold = Fold(store, store.read("file_events") if whole else store.feed(folded), whole)
    state = store.read("groups")
    moved_deadlines = bool(live) and live[-1].timeout != timeout
    stored = state.withColumn("expires_at", rules.expires_at("first_seen_at", timeout)) if moved_deadlines else state
    merged = groups.merge_groups(stored, fold.aggregate(timeout, now_col))
    if not (whole or moved_deadlines):  # what is neither touched nor open cannot change
        merged = merged.where(F.col("_touched") | (F.col("status") == rules.STATUS_OPEN))
    step = EvaluateStep(state, None, timeout, now_col)
    step.merged = materialize(merged)
    counters = _row_dict(step.refresh_counters) | _row_dict(step.readiness_counters)
    counters["audit_events"] = _append_audit(store, step.audit_events, now_col)
    if whole or moved_deadlines:
        kept = state.join(step.changes.select("group_key"), "group_key", "left_anti")
        if moved_deadlines:
            kept = kept.withColumn("expires_at", rules.expires_at("first_seen_at", timeout))
        changed = materialize(step.changes.unionByName(kept))
    else:
        changed = materialize(step.changes)
    if whole or moved_deadlines or run != folded or not live or changed.limit(1).count():
        tables = {"groups": changed, "part_bitmaps": fold.part_bitmaps, "announced": fold.announced}
        store.state.commit(tables, run, timeout, whole=whole)
    if len(store.runs()) >= config.merge_runs_from:
        store.merge_runs()
    return counters


# --- dispatch -------------------------------------------------------------------------------

@_job
def run_dispatch(spark: SparkSession, config: FilegateConfig, now=None, limit: int | None = -1) -> dict:
    """Dispatch READY groups exactly once and mark them DISPATCHED.

    ``limit=-1`` uses ``config.dispatch_batch_limit``; ``None`` or ``0`` means no limit. Groups
    beyond it stay READY; ``ready_left`` counts them.
    """
    store = ControlTables(spark, config.tables_root)
    store.ensure()
    limit = config.dispatch_batch_limit if limit == -1 else limit
    now_col = timestamp_literal(_now(now))
    state = store.read("groups")
    chosen = materialize(DispatchStep(state, None, state, now_col, limit).ready)
    # the parts registered by now, staged once: the rows, their number and the audit payload agree
    step = DispatchStep(chosen, store.near("file_events", chosen), store.near("dispatch", chosen), now_col)
    snapshot = materialize(step.snapshot)
    step.part_counts = dispatch.part_counts(snapshot)
    step.skipped = materialize(step.skipped)
    counters = _row_dict(step.counters)
    counters["ready_left"] = ready_left(state, limit)
    counters["audit_events"] = _append_audit(store, step.audit_events, now_col)
    marked = materialize(dispatch.mark_dispatched(chosen, step.marks))
    store.insert_if_absent("dispatch_files", snapshot)
    store.insert_if_absent("dispatch", step.sent)
    if counters["ready_groups"]:
        store.state.commit({"groups": marked})
    return counters


def run_cycle(spark: SparkSession, config: FilegateConfig, now=None) -> dict:
    """Ingest, evaluate and dispatch with one processing time."""
    now_value = _now(now)
    return {
        "ingest": run_ingest(spark, config, now_value),
        "evaluate": run_evaluate(spark, config, now_value),
        "dispatch": run_dispatch(spark, config, now_value),
    }
