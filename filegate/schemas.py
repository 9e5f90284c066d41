"""Table schemas of the control tables and of the raw landing listing.

The four control tables are the whole persistent state of the engine:

* ``file_events`` - one row per distinct file business key (insert-only).
* ``groups``      - one state row per ``system|table|dt_ref`` group (upserted).
* ``dispatch``    - one row per dispatched group (insert-only).
* ``audit``       - one row per distinct audit event (insert-only).

``dispatch_files`` holds the per-part snapshot of every dispatched group as rows, so
that a group of any size is stored without building one unbounded value.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The column names, order and types of the tables below are the layouts
# the engine's consumers read (equal to the reference's tables), except for: the extra
# ``dispatch_files`` table, the ``dt_ref`` partition column of ``audit``, and
# ``snapshot_parts`` in ``dispatch``, which counts the rows of ``dispatch_files`` in the place of
# one JSON text of all of them.

RAW_LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)

FILE_EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("file_event_id", T.StringType(), False),
        T.StructField("file_path", T.StringType(), False),
        T.StructField("file_name", T.StringType(), False),
        T.StructField("system_name", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("dt_ref", T.DateType(), True),
        T.StructField("part_number", T.IntegerType(), True),
        T.StructField("is_manifest", T.BooleanType(), False),
        T.StructField("expected_parts", T.IntegerType(), True),
        T.StructField("group_key", T.StringType(), True),
        T.StructField("file_business_key", T.StringType(), False),
        T.StructField("file_checksum", T.StringType(), True),
        T.StructField("file_size", T.LongType(), True),
        T.StructField("source_modification_time", T.TimestampType(), True),
        T.StructField("arrived_at", T.TimestampType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("is_duplicate", T.BooleanType(), False),
        T.StructField("parse_error", T.StringType(), True),
        T.StructField("raw_metadata_json", T.StringType(), True),
    ]
)

GROUPS_SCHEMA = T.StructType(
    [
        T.StructField("group_key", T.StringType(), False),
        T.StructField("system_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("dt_ref", T.DateType(), False),
        T.StructField("expected_parts", T.IntegerType(), True),
        T.StructField("received_parts", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("ready_reason", T.StringType(), True),
        T.StructField("first_seen_at", T.TimestampType(), True),
        T.StructField("last_seen_at", T.TimestampType(), True),
        T.StructField("expires_at", T.TimestampType(), True),
        T.StructField("triggered_at", T.TimestampType(), True),
        T.StructField("incomplete_flag", T.BooleanType(), False),
        T.StructField("last_evaluated_at", T.TimestampType(), True),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)

DISPATCH_SCHEMA = T.StructType(
    [
        T.StructField("dispatch_key", T.StringType(), False),
        T.StructField("group_key", T.StringType(), False),
        T.StructField("system_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("dt_ref", T.DateType(), False),
        T.StructField("dispatched_at", T.TimestampType(), False),
        T.StructField("dispatch_reason", T.StringType(), False),
        T.StructField("expected_parts", T.IntegerType(), True),
        T.StructField("received_parts", T.IntegerType(), False),
        T.StructField("incomplete_flag", T.BooleanType(), False),
        T.StructField("snapshot_parts", T.LongType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)

DISPATCH_FILES_SCHEMA = T.StructType(
    [
        T.StructField("dispatch_key", T.StringType(), False),
        T.StructField("group_key", T.StringType(), False),
        T.StructField("file_business_key", T.StringType(), False),
        T.StructField("part_number", T.IntegerType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("file_path", T.StringType(), True),
        T.StructField("arrived_at", T.TimestampType(), True),
        T.StructField("file_checksum", T.StringType(), True),
        T.StructField("dt_ref", T.DateType(), False),
    ]
)

# ``dt_ref`` is not part of the logical audit record; it is derived from the group key
# (null for file-level events without a group) and only serves as the partition column,
# so that replay checks read the partitions of the dates a run touched.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("group_key", T.StringType(), True),
        T.StructField("file_business_key", T.StringType(), True),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("payload_json", T.StringType(), True),
        T.StructField("severity", T.StringType(), False),
        T.StructField("dt_ref", T.DateType(), True),
    ]
)

TABLE_SCHEMAS = {
    "file_events": FILE_EVENTS_SCHEMA,
    "dispatch": DISPATCH_SCHEMA,
    "dispatch_files": DISPATCH_FILES_SCHEMA,
    "audit": AUDIT_SCHEMA,
}

#: Received part numbers of a group: one bitmap per 32,768 numbers.
PART_BITMAPS_SCHEMA = T.StructType(
    [
        T.StructField("group_key", T.StringType(), False),
        T.StructField("bucket", T.LongType(), False),
        T.StructField("bitmap", T.BinaryType(), False),
        T.StructField("dt_ref", T.DateType(), False),
    ]
)

#: Part counts announced for a group, each with the arrival and key of its first manifest.
ANNOUNCED_SCHEMA = T.StructType(
    [
        T.StructField("group_key", T.StringType(), False),
        T.StructField("expected_parts", T.IntegerType(), False),
        T.StructField("arrived_at", T.TimestampType(), False),
        T.StructField("file_business_key", T.StringType(), False),
        T.StructField("dt_ref", T.DateType(), False),
    ]
)

#: The mutable tables, kept as versions (``sources/state.py``), and the insert-only ones.
STATE_SCHEMAS = {"groups": GROUPS_SCHEMA, "part_bitmaps": PART_BITMAPS_SCHEMA, "announced": ANNOUNCED_SCHEMA}
STATE_KEYS = {"groups": ["group_key"], "part_bitmaps": ["group_key", "bucket"],
              "announced": ["group_key", "expected_parts"]}

TABLE_KEYS = {
    "file_events": ["file_business_key"],
    "dispatch": ["dispatch_key"],
    "dispatch_files": ["dispatch_key", "file_business_key"],
    "audit": ["audit_id"],
}
