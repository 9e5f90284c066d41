"""The three steps - ingest, evaluate, dispatch - as frames over stored tables.

One chain for the jobs (``jobs.py``, over the control tables) and for the registered queries
(``scenario.py``, over the fixture). A step takes the frames it needs, builds every
output on first use, and writes nothing but the staged frames that several outputs share.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filegate.functions import rules
from filegate.operators import audit, dispatch, groups, parse, ready, register
from filegate.schemas import DISPATCH_SCHEMA
from filegate.session import materialize

#: What the group fold reads of a registered file.
FOLD_COLUMNS = ("file_business_key", "arrived_at", "source_modification_time", "file_path", "group_key",
                "is_manifest", "part_number", "expected_parts", "parse_error", "dt_ref")


@dataclass(frozen=True)
class IngestOptions:
    arrival: str = "ingest"
    checksum: str | None = None
    strict: bool = False
    strict_manifest: bool = False
    timezone: str = "UTC"


class IngestStep:
    """Landing rows against the stored keys: new files, duplicates, counters, audit events.

    ``columns`` limits the parsed columns that are carried through the shuffles (all by default).
    """

    def __init__(self, raw: DataFrame, now: Column, stored_keys, options: IngestOptions = IngestOptions(),
                 columns: Sequence[str] | None = None, stage: bool = True):
        self.raw, self.now, self.stored_keys = raw, now, stored_keys
        self.options, self.columns, self.stage = options, columns, stage

    @cached_property
    def deduped(self) -> DataFrame:
        o = self.options
        parsed = parse.parsed_files(self.raw, self.now, o.arrival, o.checksum, o.strict, o.strict_manifest, o.timezone)
        if self.columns:
            parsed = parsed.select(*self.columns)
        unique = register.dedupe_by_key(parsed, copies=True)
        return materialize(unique) if callable(self.stored_keys) else unique

    @cached_property
    def tagged(self) -> DataFrame:
        """One row per key with ``n_copies`` and ``is_new``."""
        keys = self.stored_keys(self.deduped) if callable(self.stored_keys) else self.stored_keys
        tagged = register.tag_registered(self.deduped, keys)
        return materialize(tagged) if self.stage else tagged

    def _events(self, rows: DataFrame) -> DataFrame:
        rows = rows.drop("is_new", "n_copies")
        return rows if self.columns else parse.complete_file_events(rows, self.now, self.options.timezone)

    @cached_property
    def inserted(self) -> DataFrame:
        return self._events(self.tagged.where("is_new"))

    @cached_property
    def duplicates(self) -> DataFrame:
        return self._events(self.tagged.where(~F.col("is_new")))

    @cached_property
    def counters(self) -> DataFrame:
        return register.registration_counters(self.tagged)

    @cached_property
    def audit_events(self) -> DataFrame:
        return audit.file_events_audit(self.inserted, self.duplicates, payload=self.columns is None)


class EvaluateStep:
    """Valid events folded into the stored state, then the groups that are ready."""

    def __init__(self, state: DataFrame, valid_events: DataFrame | None, timeout_minutes: int, now: Column,
                 stage: bool = True):
        self.state, self.valid_events = state, valid_events
        self.timeout_minutes, self.now, self.stage = timeout_minutes, now, stage

    @cached_property
    def aggregate(self) -> DataFrame:
        return groups.aggregate_groups(self.valid_events, self.timeout_minutes, self.now)

    @cached_property
    def merged(self) -> DataFrame:
        merged = groups.merge_groups(self.state, self.aggregate)
        return materialize(merged) if self.stage else merged

    @cached_property
    def refreshed(self) -> DataFrame:
        return groups.new_state(self.merged)

    @cached_property
    def candidates(self) -> DataFrame:
        return ready.ready_candidates(self.refreshed, self.now)

    @cached_property
    def evaluated(self) -> DataFrame:
        return ready.mark_ready(self.refreshed, self.now)

    @cached_property
    def changes(self) -> DataFrame:
        """The state rows to write: groups created, changed or ready. The others keep theirs."""
        ready_now = ready.is_ready(self.now)
        return ready.mark_ready(self.merged.where(F.col("_moved") | ready_now), self.now)

    @cached_property
    def refresh_counters(self) -> DataFrame:
        return groups.refresh_counters(self.merged)

    @cached_property
    def readiness_counters(self) -> DataFrame:
        return ready.readiness_counters(self.candidates)

    @cached_property
    def audit_events(self) -> DataFrame:
        return audit.union_events([
            audit.group_refresh_audit(groups.created_groups(self.merged), groups.changed_groups(self.merged),
                                      groups.manifest_conflicts(self.merged)),
            audit.group_ready_events(self.candidates),
        ])


class DispatchStep:
    """READY groups against the dispatch table: rows to send, rows to repair, part snapshots."""

    def __init__(self, state: DataFrame, file_events: DataFrame | None, stored_dispatch: DataFrame, now: Column,
                 limit: int | None = None, stage: bool = True):
        self.state, self.file_events, self.stored_dispatch = state, file_events, stored_dispatch
        self.now, self.limit, self.stage = now, limit, stage

    def _staged(self, df: DataFrame) -> DataFrame:
        return materialize(df) if self.stage else df

    @cached_property
    def ready(self) -> DataFrame:
        return dispatch.ready_groups(self.state, self.limit)

    @cached_property
    def pending(self) -> DataFrame:
        return dispatch.to_dispatch(self.ready, self.stored_dispatch)

    @cached_property
    def skipped(self) -> DataFrame:
        return dispatch.already_dispatched(self.ready, self.stored_dispatch)

    @cached_property
    def snapshot(self) -> DataFrame:
        """Part files of the groups to send, one row each."""
        return dispatch.snapshot_rows(self.pending, self.file_events)

    @cached_property
    def part_counts(self) -> DataFrame:
        return dispatch.part_counts(register.snapshot_part_rows(self.file_events))

    @cached_property
    def sent(self) -> DataFrame:
        return self._staged(dispatch.dispatch_rows(self.pending, self.part_counts, self.now))

    @cached_property
    def dispatch_table(self) -> DataFrame:
        return self.stored_dispatch.unionByName(self.sent.select(*DISPATCH_SCHEMA.fieldNames()))

    @cached_property
    def marks(self) -> DataFrame:
        """(group_key, dispatched_at) of every group to mark; needs no part snapshot."""
        new = self.pending.select("group_key", self.now.alias("dispatched_at"))
        return new.unionByName(self.skipped.select("group_key", "dispatched_at"))

    @cached_property
    def final_state(self) -> DataFrame:
        return self._staged(dispatch.mark_dispatched(self.state, self.marks))

    @cached_property
    def counters(self) -> DataFrame:
        return dispatch.dispatch_counters(self.ready, self.pending, self.skipped)

    @cached_property
    def audit_events(self) -> DataFrame:
        return audit.dispatch_audit(self.sent, self.skipped)


def ready_left(state: DataFrame, limit: int | None) -> int:
    """READY groups beyond the batch limit: they stay READY for the next run."""
    if not limit or limit <= 0:
        return 0
    return max(0, state.where(F.col("status") == rules.STATUS_READY).count() - limit)
