"""Dispatch: READY groups -> one ``SENT`` row each, exactly once, with a part snapshot.

The part snapshot is kept as rows (``dispatch_files``), one per part file, in one form for
groups of every size; the dispatch row carries their number. ``snapshot_chunks`` gives the rows as
JSON texts of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filegate.functions import keys, rules
from filegate.operators.groups import GROUP_COLUMNS
from filegate.operators.register import snapshot_part_rows

# --- Fixed values (must stay equal to the reference for identical results) -----------
# Fields of one snapshot element, in element (and sort) order.
SNAPSHOT_FIELDS = ["part_number", "file_name", "file_path", "arrived_at", "file_checksum"]
# ---------------------------------------------------------------------------------------
CHUNK_PARTS = 1000


def ready_groups(state: DataFrame, limit: int | None = None) -> DataFrame:
    """READY rows with their dispatch key; with ``limit > 0`` the oldest ``limit``
    groups by ``(first_seen_at, group_key)`` (a bounded top-k, not an arbitrary cut)."""
    ready = state.where(F.col("status") == rules.STATUS_READY)
    if limit is not None and limit > 0:
        ready = ready.orderBy(F.col("first_seen_at").asc_nulls_last(), F.col("group_key")).limit(limit)
    return ready.withColumn("dispatch_key", keys.dispatch_key("group_key"))


def to_dispatch(ready: DataFrame, dispatch_table: DataFrame) -> DataFrame:
    """READY groups without a dispatch row yet."""
    return ready.join(dispatch_table.select("dispatch_key"), "dispatch_key", "left_anti")


def already_dispatched(ready: DataFrame, dispatch_table: DataFrame) -> DataFrame:
    """READY groups that already have a dispatch row (a run stopped before marking):
    they are re-marked with the recorded dispatch time instead of being sent again."""
    done = dispatch_table.select("dispatch_key", F.col("dispatched_at").alias("_recorded_at"))
    return ready.join(done, "dispatch_key", "inner").select(
        "dispatch_key",
        "group_key",
        "system_name",
        "table_name",
        "dt_ref",
        "ready_reason",
        "expected_parts",
        "received_parts",
        "incomplete_flag",
        F.col("_recorded_at").alias("dispatched_at"),
    )


def snapshot_rows(groups: DataFrame, file_events: DataFrame) -> DataFrame:
    """Part files of the given groups (``group_key, dispatch_key``), one row per file.

    A plain join on the group: AQE splits the part rows of a hot group over tasks.
    """
    parts = snapshot_part_rows(file_events).select("group_key", "dt_ref", "file_business_key", *SNAPSHOT_FIELDS)
    keys = groups.select("group_key", "dispatch_key")
    return parts.join(keys, "group_key", "inner").select(
        "dispatch_key", "group_key", "file_business_key", *SNAPSHOT_FIELDS, "dt_ref")


def part_counts(parts: DataFrame) -> DataFrame:
    """``snapshot_parts`` per group of part rows (a partial, map-side count: a hot group is counted in place)."""
    return parts.groupBy("group_key").agg(F.count(F.lit(1)).alias("snapshot_parts"))


def snapshot_chunks(rows: DataFrame) -> DataFrame:
    """The snapshot as JSON arrays, one per ``CHUNK_PARTS`` part numbers of a group.

    Stored keys are unique per group and part number, so a chunk holds at most ``CHUNK_PARTS``
    elements whatever the size of the group, and a large group spreads over many rows. Elements
    are sorted by ``(part_number, file_name, ...)``; chunk -1 has the part without a number.
    """
    chunk = F.coalesce(F.floor(F.col("part_number") / CHUNK_PARTS).cast("int"), F.lit(-1))
    element = F.struct(*SNAPSHOT_FIELDS)
    return rows.groupBy("dispatch_key", "group_key", chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("parts"), F.to_json(F.array_sort(F.collect_list(element))).alias("files_json"))


def dispatch_rows(pending: DataFrame, counts: DataFrame, now: Column) -> DataFrame:
    """Dispatch records for ``pending`` groups at ``now``; ``counts`` has the part counts of groups."""
    joined = pending.join(counts, "group_key", "left")
    return joined.select(
        "dispatch_key",
        "group_key",
        "system_name",
        "table_name",
        "dt_ref",
        now.alias("dispatched_at"),
        F.col("ready_reason").alias("dispatch_reason"),
        "expected_parts",
        "received_parts",
        "incomplete_flag",
        F.coalesce("snapshot_parts", F.lit(0).cast("long")).alias("snapshot_parts"),
        F.lit(rules.DISPATCH_STATUS_SENT).alias("status"),
    )


def mark_dispatched(state: DataFrame, updates: DataFrame) -> DataFrame:
    """New state: groups in ``updates (group_key, dispatched_at)`` become DISPATCHED.

    ``triggered_at`` keeps an earlier value.
    """
    u = updates.select("group_key", F.col("dispatched_at").alias("_dispatched_at"))
    j = state.join(u, "group_key", "left")
    hit = F.col("_dispatched_at").isNotNull()
    changed = {
        "status": F.when(hit, F.lit(rules.STATUS_DISPATCHED)).otherwise(F.col("status")),
        "triggered_at": F.when(hit, F.coalesce("triggered_at", "_dispatched_at")).otherwise(
            F.col("triggered_at")
        ),
        "updated_at": F.when(hit, F.col("_dispatched_at")).otherwise(F.col("updated_at")),
    }
    return j.select([changed[c].alias(c) if c in changed else F.col(c) for c in GROUP_COLUMNS])


def dispatch_counters(ready: DataFrame, sent: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row: ``ready_groups``, ``dispatched``, ``skipped_already_dispatched``."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    tagged = (
        ready.select(one.alias("r"), zero.alias("d"), zero.alias("s"))
        .unionByName(sent.select(zero.alias("r"), one.alias("d"), zero.alias("s")))
        .unionByName(skipped.select(zero.alias("r"), zero.alias("d"), one.alias("s")))
    )
    return tagged.agg(
        F.coalesce(F.sum("r"), zero).alias("ready_groups"),
        F.coalesce(F.sum("d"), zero).alias("dispatched"),
        F.coalesce(F.sum("s"), zero).alias("skipped_already_dispatched"),
    )
