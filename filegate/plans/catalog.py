"""Registered queries: one per operator of the inventory, over the fixture scenario.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the two-run entries stage shared
frames while they are built. Column names and
types are chosen to be comparable with the SQL restatement in ``oracle.py``: arrays
are shown as text, and JSON is built so that both engines print it identically.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filegate.functions import keys, parsing
from filegate.operators import audit, dispatch, groups, register, reports
from filegate.plans.scenario import DISPATCH_LIMIT, TIMEOUT_MINUTES, FixtureScenario
from filegate.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(FixtureScenario(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run

    return wrap


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _values_text(col: str = "manifest_expected_values") -> F.Column:
    return F.array_join(F.col(col).cast("array<string>"), ",").alias(col)


# --- sources and parsing ---------------------------------------------------------------

@query("landing_files")
def landing_files(s: FixtureScenario) -> DataFrame:
    """A1: the landing listing."""
    return s.landing.select("path", F.col("modificationTime").alias("mtime"), "length", "content")


@query("parse_landing")
def parse_landing(s: FixtureScenario) -> DataFrame:
    """Parsed metadata of every landing row."""
    return s.parsed.select(
        "file_path", "file_name", "logical_file_name", "system_name", "table_name", "dt_ref", "part_number",
        "is_manifest", "expected_parts", "group_key", "arrived_at", "parse_error",
    )


@query("manifest_payload")
def manifest_payload(s: FixtureScenario) -> DataFrame:
    """Expected parts read from manifest payloads (permissive)."""
    return s.parsed.where("is_manifest").select("file_path", "content", "expected_parts")


@query("parse_errors")
def parse_errors(s: FixtureScenario) -> DataFrame:
    """Rows whose name or date does not parse."""
    return register.parse_error_rows(s.parsed).select(
        "file_path", F.col("logical_file_name").alias("file_name"), "parse_error"
    )


@query("file_events")
def file_events(s: FixtureScenario) -> DataFrame:
    """The 19 file-event columns of every landing row."""
    return s.events


@query("file_events_strict")
def file_events_strict(s: FixtureScenario) -> DataFrame:
    """File events under the strict name and manifest rules."""
    return s.strict_events.select("file_path", "is_manifest", "part_number", "expected_parts", "group_key",
                                  "parse_error", "file_business_key")


@query("content_checksum")
def content_checksum(s: FixtureScenario) -> DataFrame:
    """Content checksums, raw bytes and the base64-text form."""
    return s.landing.select(
        F.col("path").alias("file_path"),
        keys.content_checksum("content", "raw").alias("checksum_raw"),
        keys.content_checksum("content", "base64_text").alias("checksum_base64_text"),
    )


@query("file_business_key")
def file_business_key(s: FixtureScenario) -> DataFrame:
    """Business key and event id per landing row."""
    return s.events.select("file_path", "parse_error", "file_business_key", "file_event_id")


@query("dispatch_key")
def dispatch_key(s: FixtureScenario) -> DataFrame:
    """Dispatch key of every group."""
    return s.batch.aggregate.select("group_key", keys.dispatch_key("group_key").alias("dispatch_key"))


@query("manifest_quality")
def manifest_quality(s: FixtureScenario) -> DataFrame:
    """Strict diagnosis of every manifest payload."""
    return s.parsed.where("is_manifest").select(
        "file_path",
        "content",
        parsing.manifest_error("content").alias("manifest_error"),
        parsing.strict_expected_parts("content").alias("strict_expected_parts"),
    )


# --- registration ------------------------------------------------------------------------

@query("dedupe_files")
def dedupe_files(s: FixtureScenario) -> DataFrame:
    """One survivor per business key, with the number of copies delivered."""
    return s.deduped.select("file_business_key", "file_path", "arrived_at", "file_size", "n_copies")


@query("valid_events")
def valid_events(s: FixtureScenario) -> DataFrame:
    """Registered events that belong to a group."""
    return s.batch.valid_events.select("file_business_key", "group_key", "part_number", "is_manifest", "expected_parts",
                          "arrived_at")


@query("new_candidates")
def new_candidates(s: FixtureScenario) -> DataFrame:
    """Run 2's keys that were not stored by run 1."""
    two = s.listing("group_key", "parse_error")
    return two.registered.inserted.select("file_business_key", "file_path", "group_key", "parse_error")


@query("duplicate_candidates")
def duplicate_candidates(s: FixtureScenario) -> DataFrame:
    """Run 2's keys that run 1 already stored."""
    return s.listing("group_key").registered.duplicates.select("file_business_key", "file_path", "group_key")


@query("insert_if_absent")
def insert_if_absent(s: FixtureScenario) -> DataFrame:
    """A5: ``file_events`` after both runs (keyed appends)."""
    return s.wide.all_events.select("file_business_key", "file_path", "arrived_at", "ingested_at", "file_size")


@query("registration_summary")
def registration_summary(s: FixtureScenario) -> DataFrame:
    """E5: registration counters of both runs."""
    two = s.listing("parse_error")
    return two.first.ingest.counters.select(F.lit(1).alias("run"), "*").unionByName(
        two.registered.counters.select(F.lit(2).alias("run"), "*")
    )


# --- groups -----------------------------------------------------------------------------

@query("group_aggregate")
def group_aggregate(s: FixtureScenario) -> DataFrame:
    """Per-group arrival window, distinct parts and deadline."""
    return s.batch.aggregate.select("group_key", "system_name", "table_name", "dt_ref", "first_seen_at", "last_seen_at",
                              "received_parts", "expires_at")


@query("merged_partials")
def merged_partials(s: FixtureScenario) -> DataFrame:
    """The second run's new files merged into the first run's partials, instead of all files folded anew."""
    spans, bitmaps, announced = zip(*map(s.partials, s.run_feeds), strict=True)
    rows = groups.aggregate_partials(groups.merge_spans(*spans), groups.merge_bitmaps(*bitmaps),
                                     groups.merge_announced(*announced), TIMEOUT_MINUTES, s.now2)
    return rows.select("group_key", "first_seen_at", "last_seen_at", "received_parts", "manifest_expected_parts",
                       "manifest_distinct_count", _values_text(), "expires_at")


@query("part_bitmaps")
def part_bitmaps(s: FixtureScenario) -> DataFrame:
    """Received part numbers of both runs per group and bitmap, with their number."""
    merged = groups.merge_bitmaps(*[groups.bitmap_partials(feed) for feed in s.run_feeds])
    return merged.select("group_key", "bucket", F.bitmap_count("bitmap").alias("parts"), "dt_ref")


@query("announced_counts")
def announced_counts(s: FixtureScenario) -> DataFrame:
    """One row per group and announced count, with its first manifest."""
    return groups.merge_announced(*[groups.announced_partials(feed) for feed in s.run_feeds])


@query("manifest_stats")
def manifest_stats(s: FixtureScenario) -> DataFrame:
    """Distinct announced counts per group."""
    return s.batch.aggregate.select("group_key", "manifest_distinct_count", _values_text())


@query("first_manifest")
def first_manifest(s: FixtureScenario) -> DataFrame:
    """first-writer-wins manifest per group."""
    stats = groups.manifest_statistics(s.batch.valid_events)
    return stats.select("group_key", "manifest_expected_parts", "first_manifest_key", "first_manifest_arrived_at")


@query("new_groups")
def new_groups(s: FixtureScenario) -> DataFrame:
    """Groups run 2 creates."""
    return groups.created_groups(s.runs.second.evaluate.merged).select(
        "group_key", "first_seen_at", "last_seen_at", "received_parts", "manifest_expected_parts"
    )


@query("changed_groups")
def changed_groups(s: FixtureScenario) -> DataFrame:
    """Stored groups that run 2 changes."""
    return groups.changed_groups(s.runs.second.evaluate.merged).select(
        "group_key", "received_parts", "prior_received_parts", "last_seen_at", "prior_last_seen_at",
        "manifest_expected_parts", "prior_expected_parts",
    )


@query("manifest_conflicts")
def manifest_conflicts(s: FixtureScenario) -> DataFrame:
    """Conflicting manifests seen by run 2."""
    return groups.manifest_conflicts(s.runs.second.evaluate.merged).select(
        "group_key", "group_expected_parts", "manifest_expected_parts", "manifest_distinct_count", _values_text()
    )


@query("group_state_upsert")
def group_state_upsert(s: FixtureScenario) -> DataFrame:
    """The group state after run 2's refresh."""
    return s.runs.second.evaluate.refreshed


@query("refresh_summary")
def refresh_summary(s: FixtureScenario) -> DataFrame:
    """Refresh counters of both runs."""
    return s.runs.first.evaluate.refresh_counters.select(F.lit(1).alias("run"), "*").unionByName(
        s.runs.second.evaluate.refresh_counters.select(F.lit(2).alias("run"), "*")
    )


@query("late_arrivals")
def late_arrivals(s: FixtureScenario) -> DataFrame:
    """Registered files that arrived after their group's deadline."""
    state = s.runs.second.dispatch.final_state.select("group_key", "expires_at", "status")
    events = register.valid_events(s.runs.second.file_events).select("group_key", "file_business_key", "arrived_at")
    return events.join(state, "group_key", "inner").where(F.col("arrived_at") > F.col("expires_at"))


# --- readiness ----------------------------------------------------------------------------

@query("ready_reason")
def ready_reason(s: FixtureScenario) -> DataFrame:
    """Readiness of every group at the single-batch evaluation."""
    return s.batch.evaluated.select("group_key", "expected_parts", "received_parts", "expires_at", "status", "ready_reason")


@query("incomplete_flag")
def incomplete_flag(s: FixtureScenario) -> DataFrame:
    """Ready candidates with their incomplete flag."""
    return s.batch.candidates.select("group_key", "ready_reason_candidate", "incomplete_flag_calc")


@query("mark_ready")
def mark_ready(s: FixtureScenario) -> DataFrame:
    """The group state after run 2's evaluation."""
    return s.runs.second.evaluate.evaluated


@query("readiness_summary")
def readiness_summary(s: FixtureScenario) -> DataFrame:
    """Readiness counters of both runs."""
    return s.runs.first.evaluate.readiness_counters.select(F.lit(1).alias("run"), "*").unionByName(
        s.runs.second.evaluate.readiness_counters.select(F.lit(2).alias("run"), "*")
    )


# --- dispatch -----------------------------------------------------------------------------

@query("to_dispatch")
def to_dispatch(s: FixtureScenario) -> DataFrame:
    """READY groups of run 2 without a dispatch row."""
    return s.runs.second.dispatch.pending.select("dispatch_key", "group_key", "ready_reason")


@query("skipped_already_dispatched")
def skipped_already_dispatched(s: FixtureScenario) -> DataFrame:
    """Both runs' dispatch steps replayed: they find the rows sent and re-mark with their time."""
    first, second = (r.skipped for r in s.replays)
    return first.unionByName(second).select("dispatch_key", "group_key", "ready_reason", "dispatched_at")


@query("file_snapshot")
def file_snapshot(s: FixtureScenario) -> DataFrame:
    """Part files of every group that either run dispatches, one row each."""
    return _snapshots(s).select("dispatch_key", "group_key", "part_number", "file_name", "file_path", "arrived_at")


def _snapshots(s: FixtureScenario) -> DataFrame:
    return s.wide.first.dispatch.snapshot.unionByName(s.wide.second.dispatch.snapshot)


@query("snapshot_chunks")
def snapshot_chunks(s: FixtureScenario) -> DataFrame:
    """The same snapshots as sorted JSON arrays of bounded size."""
    return dispatch.snapshot_chunks(_snapshots(s))


@query("dispatch_payload")
def dispatch_payload(s: FixtureScenario) -> DataFrame:
    """The dispatch table after both runs, with the size of each snapshot."""
    return s.runs.second.dispatch.dispatch_table


@query("mark_dispatched")
def mark_dispatched(s: FixtureScenario) -> DataFrame:
    """The group state after run 2's dispatch."""
    return s.runs.second.dispatch.final_state


@query("dispatch_summary")
def dispatch_summary(s: FixtureScenario) -> DataFrame:
    """Dispatch counters of both runs (1, 2) and of their replays (3, 4)."""
    steps = [s.runs.first.dispatch, s.runs.second.dispatch, *s.replays]
    rows = [step.counters.select(F.lit(i).alias("run"), "*") for i, step in enumerate(steps, 1)]
    return reduce(DataFrame.unionByName, rows)


@query("dispatch_batch_limit")
def dispatch_batch_limit(s: FixtureScenario) -> DataFrame:
    """G1: the oldest READY groups of the whole landing up to the batch limit."""
    return dispatch.ready_groups(s.batch.evaluated, limit=DISPATCH_LIMIT).select(
        "group_key", "first_seen_at", "dispatch_key"
    )


# --- audit ---------------------------------------------------------------------------------

_AUDIT_COLUMNS = ["audit_id", "event_type", "group_key", "file_business_key", "event_ts", "severity", "dt_ref"]


@query("audit_id")
def audit_id(s: FixtureScenario) -> DataFrame:
    """Audit ids of the registration events of every file."""
    events = audit.file_events_audit(s.registration.inserted, payload=False)
    return events.select("event_type", "group_key", "file_business_key", "dedupe_key",
                         keys.audit_id().alias("audit_id"))


@query("audit_file_events")
def audit_file_events(s: FixtureScenario) -> DataFrame:
    """J1-J4 in the audit table after both runs."""
    two = s.wide
    ids = two.first.ingest.audit_events
    rows = audit.prepare_audit(ids, s.now1)
    later = audit.prepare_audit(two.registered.audit_events, s.now2)
    new = later.join(rows.select("audit_id"), "audit_id", "left_anti")
    return rows.unionByName(new).select(*_AUDIT_COLUMNS, "payload_json")


@query("audit_group_events")
def audit_group_events(s: FixtureScenario) -> DataFrame:
    """J5-J9 in the audit table after both runs."""
    rows = _later_first(s, lambda run: run.evaluate.audit_events)
    return rows.select(*_AUDIT_COLUMNS, "payload_json")


def _later_first(s: FixtureScenario, events: Callable) -> DataFrame:
    """Audit rows of one step of both runs, after the keyed append."""
    first = audit.prepare_audit(events(s.runs.first), s.now1)
    second = audit.prepare_audit(events(s.runs.second), s.now2)
    return first.unionByName(second.join(first.select("audit_id"), "audit_id", "left_anti"))


@query("audit_dispatch_events")
def audit_dispatch_events(s: FixtureScenario) -> DataFrame:
    """J10-J11 in the audit table after both runs, plus the skip events of their replays."""
    table = materialize(_later_first(s, lambda run: run.dispatch.audit_events))
    for replay, now in zip(s.replays, (s.now1, s.now2), strict=True):
        rows = audit.prepare_audit(audit.dispatch_skipped_events(replay.skipped), now)
        rows = materialize(rows.join(table.select("audit_id"), "audit_id", "left_anti"))
        table = table.unionByName(rows)
    return table.select(*_AUDIT_COLUMNS, "payload_json")


@query("audit_append")
def audit_append(s: FixtureScenario) -> DataFrame:
    """The whole audit table after both runs (keyed appends)."""
    return s.runs.audit_table.select(*_AUDIT_COLUMNS)


@query("audit_timeline")
def audit_timeline(s: FixtureScenario) -> DataFrame:
    """Audit rows by time, with payloads."""
    return reports.audit_timeline(s.wide.audit_table)


@query("groups_listing")
def groups_listing(s: FixtureScenario) -> DataFrame:
    """The final group state by key."""
    return reports.groups_listing(s.runs.second.dispatch.final_state)


@query("dispatch_listing")
def dispatch_listing(s: FixtureScenario) -> DataFrame:
    """The dispatch table by group."""
    return reports.dispatch_listing(s.runs.second.dispatch.dispatch_table)


# --- views and reports ----------------------------------------------------------------------

@query("vw_group_status")
def vw_group_status(s: FixtureScenario) -> DataFrame:
    """Groups per status and reason after the single-batch evaluation."""
    return reports.group_status(s.batch.evaluated)


@query("vw_file_quality")
def vw_file_quality(s: FixtureScenario) -> DataFrame:
    """Files and parse errors per arrival date after both runs."""
    return reports.file_quality(s.listing("parse_error").all_events)


@query("vw_operational_metrics")
def vw_operational_metrics(s: FixtureScenario) -> DataFrame:
    """Audit events per type and severity after both runs."""
    return reports.operational_metrics(s.runs.audit_table)


@query("report_groups_by_status")
def report_groups_by_status(s: FixtureScenario) -> DataFrame:
    """Final groups per status and reason."""
    return reports.groups_by_status(s.runs.second.dispatch.final_state)


@query("report_dispatch_reasons")
def report_dispatch_reasons(s: FixtureScenario) -> DataFrame:
    """Dispatches per reason after both runs."""
    return reports.dispatch_reasons(s.runs.second.dispatch.dispatch_table)


@query("report_audit_by_type")
def report_audit_by_type(s: FixtureScenario) -> DataFrame:
    """Audit events per type and severity, ordered."""
    return reports.audit_by_type(s.runs.audit_table)
