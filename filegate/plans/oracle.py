"""The fixture scenario restated in SQL (DuckDB dialect), one statement per query.

Each statement is a ``WITH`` chain over the pre-registered test tables. The chain is
written once as named fragments (landing, parse, keys, de-duplication, aggregate,
upsert, readiness, dispatch, audit) instantiated per run; every query selects from it.
Spark's ``try_`` functions map to DuckDB's ``TRY_CAST`` / ``try_strptime``, ``sha2`` to
``sha256``, ``from_json`` to a ``json_type`` test, ``array_sort(collect_set)`` to
``list_sort(list(DISTINCT))``.
"""

from __future__ import annotations

from filegate.plans.scenario import DISPATCH_LIMIT, NOW1, NOW2, SPLIT_MINUTE, TIMEOUT_MINUTES

T1 = f"TIMESTAMP '{NOW1}'"
T2 = f"TIMESTAMP '{NOW2}'"
# Written out here, not taken from the code under test.
PAT = (r"^SISTEMA=([^|]+)\|TABELA=([^|]+)\|DT_REF=(\d{4}-\d{2}-\d{2})\|"
       r"(PART=(\d+)\.json|MANIFEST\.json)$")
BASE_NAME = r"([^/\\]+)$"
MANIFEST_SUFFIX = r"MANIFEST\.json$"
JSON_TS = "'%Y-%m-%dT%H:%M:%S.%g'"

LANDING_SQL = f"""
orders_x AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         'SISTEMA=S' || CAST(o_orderkey % 5 AS VARCHAR) || '|TABELA='
           || replace(lower(substr(o_orderpriority, 3)), ' ', '_')
           || '|DT_REF=' || strftime(o_orderdate, '%Y-%m-%d') || '|' AS prefix
  FROM orders),
landing AS (
  SELECT 'file:/landing/parts/' || CAST(l.l_orderkey AS VARCHAR) || '/' || CAST(l.l_partkey AS VARCHAR) || '-'
           || CAST(l.l_suppkey AS VARCHAR) || '/' || o.prefix || 'PART='
           || lpad(CAST(l.l_linenumber AS VARCHAR), 4, '0') || '.json' AS path,
         o.o_orderdate + to_minutes(CAST(l.l_partkey % 60 AS BIGINT)) AS mtime,
         CAST(l.l_quantity AS BIGINT) AS length,
         '{{"row":' || CAST(l.l_linenumber AS VARCHAR) || '}}' AS content
  FROM lineitem l JOIN orders_x o ON l.l_orderkey = o.o_orderkey
  UNION ALL
  SELECT 'file:/landing/manifests/' || CAST(o_orderkey AS VARCHAR) || '/' || prefix || 'MANIFEST.json',
         o_orderdate + to_minutes(CAST(o_custkey % 60 AS BIGINT)),
         CAST(20 AS BIGINT),
         CASE o_orderkey % 50 WHEN 7 THEN '{{}}' WHEN 11 THEN 'not json'
              WHEN 13 THEN '{{"expected_parts":0}}' WHEN 17 THEN '{{"expected_parts":"x"}}'
              ELSE '{{"expected_parts":' || CAST(o_orderkey % 6 + 1 AS VARCHAR) || '}}' END
  FROM orders_x WHERE o_orderkey % 4 <> 0
  UNION ALL
  SELECT 'file:/landing/misc/' || CAST(event_id AS VARCHAR) || '/' ||
         CASE event_id % 100
           WHEN 0 THEN 'event_' || CAST(event_id AS VARCHAR) || '.json'
           WHEN 1 THEN 'SISTEMA=EV|TABELA=events|DT_REF=2024-13-01|PART=0001.json'
           WHEN 2 THEN 'SISTEMA=EV|TABELA=events|DT_REF=2024-01-01|PART=99999999999.json'
           ELSE replace(replace('SISTEMA=EV|TABELA=events|DT_REF=2024-01-01|PART='
                || lpad(CAST(user_id AS VARCHAR), 4, '0') || '.json', '=', '%3D'), '|', '%7C') END,
         ts, CAST(10 AS BIGINT), props
  FROM events)"""


def parsed_sql(name: str, src: str) -> str:
    """Parsed metadata of ``src`` (``path, mtime, length, content``) as CTE ``name``."""
    return f"""
{name}_a AS (
  SELECT path AS file_path, mtime, length, content,
         regexp_extract(path, '{BASE_NAME}', 1) AS file_name
  FROM {src}),
{name}_b AS (
  SELECT *, coalesce(url_decode(file_name), file_name) AS logical_file_name FROM {name}_a),
{name}_c AS (
  SELECT *,
    regexp_extract(logical_file_name, '{PAT}', 1) AS system_name,
    regexp_extract(logical_file_name, '{PAT}', 2) AS table_name,
    regexp_extract(logical_file_name, '{PAT}', 3) AS dt_ref_str,
    regexp_extract(logical_file_name, '{PAT}', 5) AS part_number_str,
    regexp_matches(logical_file_name, '{MANIFEST_SUFFIX}') AS is_manifest,
    regexp_matches(logical_file_name, '{PAT}') AS name_ok
  FROM {name}_b),
{name}_d AS (
  SELECT *,
    CAST(try_strptime(nullif(dt_ref_str, ''), '%Y-%m-%d') AS DATE) AS dt_ref,
    CASE WHEN NOT is_manifest THEN TRY_CAST(nullif(part_number_str, '') AS INTEGER) END AS part_number,
    CASE WHEN is_manifest THEN TRY_CAST(
      CASE WHEN json_valid(content) AND json_type(content, '$.expected_parts') IN ('UBIGINT', 'BIGINT')
           THEN json_extract_string(content, '$.expected_parts') END AS INTEGER) END AS expected_parts,
    mtime AS arrived_at
  FROM {name}_c),
{name} AS (
  SELECT *,
    CASE WHEN system_name <> '' AND table_name <> '' AND dt_ref IS NOT NULL
         THEN system_name || '|' || table_name || '|' || dt_ref_str END AS group_key,
    CASE WHEN NOT name_ok THEN 'INVALID_FILENAME_PATTERN' WHEN dt_ref IS NULL THEN 'INVALID_DT_REF' END AS parse_error
  FROM {name}_d)"""


def events_sql(name: str, parsed: str, now: str) -> str:
    """The 19 ``file_events`` columns of a parsed CTE, ingested at ``now``."""
    return f"""
{name}_k AS (
  SELECT *,
    CASE WHEN parse_error IS NOT NULL THEN sha256('PARSE_ERROR|' || coalesce(logical_file_name, file_path))
         WHEN is_manifest THEN sha256(concat_ws('|', group_key, 'MANIFEST',
                                                coalesce(CAST(expected_parts AS VARCHAR), 'UNKNOWN')))
         ELSE sha256(concat_ws('|', group_key, 'PART', lpad(CAST(part_number AS VARCHAR), 10, '0'))) END
      AS file_business_key
  FROM {parsed}),
{name} AS (
  SELECT sha256(file_business_key) AS file_event_id, file_path, logical_file_name AS file_name, system_name,
         table_name, dt_ref, part_number, is_manifest, expected_parts, group_key, file_business_key,
         CAST(NULL AS VARCHAR) AS file_checksum, length AS file_size, mtime AS source_modification_time,
         arrived_at, {now} AS ingested_at, false AS is_duplicate, parse_error,
         '{{"path":"' || file_path || '","logical_file_name":"' || logical_file_name || '","size":'
           || CAST(length AS VARCHAR) || ',"source_modification_time":"' || strftime(mtime, {JSON_TS}) || '"}}'
           AS raw_metadata_json
  FROM {name}_k)"""


FE_COLS = ("file_event_id, file_path, file_name, system_name, table_name, dt_ref, part_number, is_manifest, "
           "expected_parts, group_key, file_business_key, file_checksum, file_size, source_modification_time, "
           "arrived_at, ingested_at, is_duplicate, parse_error, raw_metadata_json")

G_COLS = ("group_key, system_name, table_name, dt_ref, expected_parts, received_parts, status, ready_reason, "
          "first_seen_at, last_seen_at, expires_at, triggered_at, incomplete_flag, last_evaluated_at, created_at, "
          "updated_at")

D_COLS = ("dispatch_key, group_key, system_name, table_name, dt_ref, dispatched_at, dispatch_reason, "
          "expected_parts, received_parts, incomplete_flag, snapshot_parts, status")


def dedupe_sql(name: str, events: str) -> str:
    """One survivor per key (earliest arrival, then path, then size) with ``n_copies``."""
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY file_business_key
                                 ORDER BY arrived_at, source_modification_time, file_path, file_size) AS rn,
           count(*) OVER (PARTITION BY file_business_key) AS n_copies
    FROM {events}) WHERE rn = 1)"""


def aggregate_sql(name: str, file_events: str, now: str) -> str:
    """Per-group aggregate over the valid rows of ``file_events``."""
    return f"""
{name}_v AS (
  SELECT * FROM {file_events} WHERE parse_error IS NULL AND group_key IS NOT NULL),
{name}_p AS (
  SELECT group_key, min(arrived_at) AS first_seen_at, max(arrived_at) AS last_seen_at,
         CAST(count(DISTINCT CASE WHEN NOT is_manifest THEN part_number END) AS BIGINT) AS received_parts
  FROM {name}_v GROUP BY group_key),
{name}_m AS (
  SELECT group_key, CAST(count(DISTINCT expected_parts) AS BIGINT) AS manifest_distinct_count,
         list_sort(list(DISTINCT expected_parts)) AS manifest_expected_values
  FROM {name}_v WHERE is_manifest AND expected_parts IS NOT NULL GROUP BY group_key),
{name}_f AS (
  SELECT group_key, expected_parts AS manifest_expected_parts, file_business_key AS first_manifest_key,
         arrived_at AS first_manifest_arrived_at
  FROM (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY arrived_at, file_business_key) AS rn
        FROM {name}_v WHERE is_manifest AND expected_parts IS NOT NULL) WHERE rn = 1),
{name} AS (
  SELECT p.group_key, split_part(p.group_key, '|', 1) AS system_name, split_part(p.group_key, '|', 2) AS table_name,
         CAST(split_part(p.group_key, '|', 3) AS DATE) AS dt_ref, p.first_seen_at, p.last_seen_at, p.received_parts,
         f.manifest_expected_parts, coalesce(m.manifest_distinct_count, 0) AS manifest_distinct_count,
         m.manifest_expected_values, f.first_manifest_key, f.first_manifest_arrived_at,
         p.first_seen_at + to_minutes({TIMEOUT_MINUTES}) AS expires_at, {now} AS processed_at
  FROM {name}_p p LEFT JOIN {name}_m m ON p.group_key = m.group_key
                  LEFT JOIN {name}_f f ON p.group_key = f.group_key)"""


def merge_sql(name: str, state: str, agg: str) -> str:
    """Upsert of ``agg`` into ``state`` with the change flags (``name``) and the state (``name_state``)."""
    return f"""
{name} AS (
  SELECT coalesce(s.group_key, t.group_key) AS group_key,
    CASE WHEN s.group_key IS NOT NULL THEN s.system_name ELSE t.system_name END AS system_name,
    CASE WHEN s.group_key IS NOT NULL THEN s.table_name ELSE t.table_name END AS table_name,
    CASE WHEN s.group_key IS NOT NULL THEN s.dt_ref ELSE t.dt_ref END AS dt_ref,
    CASE WHEN s.group_key IS NOT NULL THEN coalesce(t.expected_parts, s.manifest_expected_parts)
         ELSE t.expected_parts END AS expected_parts,
    CASE WHEN s.group_key IS NOT NULL THEN CAST(s.received_parts AS INTEGER) ELSE t.received_parts END
      AS received_parts,
    CASE WHEN s.group_key IS NOT NULL AND t.group_key IS NOT NULL
           THEN CASE WHEN t.status IN ('READY', 'DISPATCHED') THEN t.status ELSE 'OPEN' END
         WHEN s.group_key IS NOT NULL THEN 'OPEN' ELSE t.status END AS status,
    t.ready_reason,
    CASE WHEN s.group_key IS NOT NULL THEN s.first_seen_at ELSE t.first_seen_at END AS first_seen_at,
    CASE WHEN s.group_key IS NOT NULL THEN s.last_seen_at ELSE t.last_seen_at END AS last_seen_at,
    CASE WHEN s.group_key IS NOT NULL THEN s.expires_at ELSE t.expires_at END AS expires_at,
    t.triggered_at,
    coalesce(t.incomplete_flag, false) AS incomplete_flag,
    t.last_evaluated_at,
    CASE WHEN t.group_key IS NOT NULL THEN t.created_at ELSE s.processed_at END AS created_at,
    CASE WHEN s.group_key IS NOT NULL THEN s.processed_at ELSE t.updated_at END AS updated_at,
    s.group_key IS NOT NULL AS touched,
    s.group_key IS NOT NULL AND t.group_key IS NULL AS created,
    coalesce(s.group_key IS NOT NULL AND t.group_key IS NOT NULL AND (
        s.received_parts <> t.received_parts OR s.last_seen_at <> t.last_seen_at
        OR (t.expected_parts IS NULL AND s.manifest_expected_parts IS NOT NULL)), false) AS changed,
    coalesce(s.group_key IS NOT NULL AND (s.manifest_distinct_count > 1 OR coalesce(
        s.manifest_expected_parts IS NOT NULL AND coalesce(t.expected_parts, s.manifest_expected_parts) IS NOT NULL
        AND s.manifest_expected_parts <> coalesce(t.expected_parts, s.manifest_expected_parts), false)), false)
      AS conflict,
    s.received_parts AS agg_received_parts, s.manifest_expected_parts, s.manifest_distinct_count,
    s.manifest_expected_values, t.expected_parts AS prior_expected_parts,
    t.received_parts AS prior_received_parts, t.last_seen_at AS prior_last_seen_at
  FROM {agg} s FULL OUTER JOIN {state} t ON s.group_key = t.group_key),
{name}_state AS (SELECT {G_COLS} FROM {name})"""


def ready_sql(name: str, state: str, now: str) -> str:
    """Candidates (``name_cand``) and the state after marking (``name``)."""
    reason = (f"CASE WHEN expected_parts IS NOT NULL AND received_parts >= expected_parts THEN 'ALL_PARTS' "
              f"WHEN {now} >= expires_at THEN 'TIMEOUT' END")
    return f"""
{name}_r AS (
  SELECT *, CASE WHEN status = 'OPEN' THEN {reason} END AS reason FROM {state}),
{name}_cand AS (
  SELECT {G_COLS}, {now} AS evaluated_at, reason AS ready_reason_candidate,
         coalesce(reason = 'TIMEOUT' AND expected_parts IS NOT NULL AND received_parts < expected_parts, false)
           AS incomplete_flag_calc
  FROM {name}_r WHERE reason IS NOT NULL),
{name} AS (
  SELECT group_key, system_name, table_name, dt_ref, expected_parts, received_parts,
    CASE WHEN reason IS NOT NULL THEN 'READY' ELSE status END AS status,
    CASE WHEN reason IS NOT NULL THEN reason ELSE ready_reason END AS ready_reason,
    first_seen_at, last_seen_at, expires_at, triggered_at,
    CASE WHEN reason IS NOT NULL
         THEN coalesce(reason = 'TIMEOUT' AND expected_parts IS NOT NULL AND received_parts < expected_parts, false)
         ELSE incomplete_flag END AS incomplete_flag,
    CASE WHEN reason IS NOT NULL THEN {now} ELSE last_evaluated_at END AS last_evaluated_at,
    created_at,
    CASE WHEN reason IS NOT NULL THEN {now} ELSE updated_at END AS updated_at
  FROM {name}_r)"""


def dispatch_sql(name: str, state: str, stored_dispatch: str, file_events: str, now: str) -> str:
    """READY groups (``name_ready``), pending, skipped, snapshot rows, sent rows, final state."""
    return f"""
{name}_ready AS (
  SELECT *, sha256(group_key) AS dispatch_key FROM {state} WHERE status = 'READY'),
{name}_pending AS (
  SELECT r.* FROM {name}_ready r WHERE NOT EXISTS (
    SELECT 1 FROM {stored_dispatch} d WHERE d.dispatch_key = r.dispatch_key)),
{name}_skipped AS (
  SELECT r.dispatch_key, r.group_key, r.system_name, r.table_name, r.dt_ref, r.ready_reason, r.expected_parts,
         r.received_parts, r.incomplete_flag, d.dispatched_at
  FROM {name}_ready r JOIN {stored_dispatch} d ON d.dispatch_key = r.dispatch_key),
{name}_snap AS (
  SELECT p.dispatch_key, f.group_key, f.part_number, f.file_name, f.file_path, f.arrived_at
  FROM {file_events} f JOIN {name}_pending p ON f.group_key = p.group_key
  WHERE f.parse_error IS NULL AND NOT f.is_manifest),
{name}_summary AS (
  SELECT dispatch_key, count(*) AS snapshot_parts FROM {name}_snap GROUP BY dispatch_key),
{name}_sent AS (
  SELECT p.dispatch_key, p.group_key, p.system_name, p.table_name, p.dt_ref, {now} AS dispatched_at,
         p.ready_reason AS dispatch_reason, p.expected_parts, p.received_parts, p.incomplete_flag,
         CAST(coalesce(m.snapshot_parts, 0) AS BIGINT) AS snapshot_parts, 'SENT' AS status
  FROM {name}_pending p LEFT JOIN {name}_summary m ON p.dispatch_key = m.dispatch_key),
{name}_updates AS (
  SELECT group_key, dispatched_at FROM {name}_sent
  UNION ALL SELECT group_key, dispatched_at FROM {name}_skipped),
{name}_final AS (
  SELECT g.group_key, g.system_name, g.table_name, g.dt_ref, g.expected_parts, g.received_parts,
    CASE WHEN u.group_key IS NOT NULL THEN 'DISPATCHED' ELSE g.status END AS status,
    g.ready_reason, g.first_seen_at, g.last_seen_at, g.expires_at,
    CASE WHEN u.group_key IS NOT NULL THEN coalesce(g.triggered_at, u.dispatched_at) ELSE g.triggered_at END
      AS triggered_at,
    g.incomplete_flag, g.last_evaluated_at, g.created_at,
    CASE WHEN u.group_key IS NOT NULL THEN u.dispatched_at ELSE g.updated_at END AS updated_at
  FROM {state} g LEFT JOIN {name}_updates u ON g.group_key = u.group_key),
{name}_table AS (
  SELECT {D_COLS} FROM {stored_dispatch} UNION ALL SELECT {D_COLS} FROM {name}_sent)"""


def json_sql(*fields: tuple[str, str] | tuple[str, str, str]) -> str:
    """SQL text of a JSON object of (name, kind[, expression]); null fields are left out.

    Kinds: s text, n number or boolean, t timestamp, a list.
    """
    forms = {"s": "'\"' || CAST({e} AS VARCHAR) || '\"'", "n": "CAST({e} AS VARCHAR)",
             "t": "'\"' || strftime({e}, " + JSON_TS + ") || '\"'", "a": "to_json({e})"}
    parts = []
    for name, kind, *expr in fields:
        e = expr[0] if expr else name
        parts.append(f"CASE WHEN {e} IS NOT NULL THEN '\"{name}\":' || {forms[kind].format(e=e)} END")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


# Payloads by event type: the fields, in order, of the event's JSON.
PAYLOADS = {
    "FILE_REGISTERED": json_sql(("file_path", "s"), ("file_name", "s"), ("system_name", "s"), ("table_name", "s"),
                                ("dt_ref", "s"), ("part_number", "n"), ("is_manifest", "n"), ("expected_parts", "n"),
                                ("arrived_at", "t")),
    "MANIFEST_REGISTERED": json_sql(("file_name", "s"), ("expected_parts", "n"), ("arrived_at", "t"),
                                    ("parse_error", "s")),
    "PARSE_ERROR": json_sql(("file_name", "s"), ("file_path", "s"), ("parse_error", "s")),
    "FILE_DUPLICATE_IGNORED": json_sql(("file_name", "s"), ("file_path", "s"), ("system_name", "s"),
                                       ("table_name", "s"), ("dt_ref", "s"), ("part_number", "n")),
    "GROUP_CREATED": json_sql(("system_name", "s"), ("table_name", "s"), ("dt_ref", "s"), ("first_seen_at", "t"),
                              ("last_seen_at", "t"), ("received_parts", "n", "agg_received_parts"),
                              ("manifest_expected_parts", "n")),
    "GROUP_UPDATED": json_sql(("received_parts", "n", "agg_received_parts"), ("manifest_expected_parts", "n"),
                              ("first_seen_at", "t"), ("last_seen_at", "t"), ("expires_at", "t")),
    "MANIFEST_CONFLICT": json_sql(("group_expected_parts", "n", "expected_parts"), ("manifest_expected_parts", "n"),
                                  ("manifest_expected_values", "a"), ("manifest_distinct_count", "n")),
    "GROUP_READY": json_sql(("expected_parts", "n"), ("received_parts", "n"), ("expires_at", "t"),
                            ("ready_reason_candidate", "s"), ("incomplete_flag_calc", "n"), ("evaluated_at", "t")),
    "GROUP_DISPATCHED": json_sql(("dispatch_key", "s"), ("dispatch_reason", "s"), ("expected_parts", "n"),
                                 ("received_parts", "n"), ("incomplete_flag", "n"), ("dispatched_at", "t"),
                                 ("snapshot_parts", "n")),
    "SKIPPED": json_sql(("dispatch_key", "s"), ("ready_reason", "s"), ("expected_parts", "n"), ("received_parts", "n"),
                        ("dispatched_at", "t")),
}


def _event(etype: str, fkey: str, sev: str, dedupe: str, payload: str, src: str, where: str = "true") -> str:
    return (f"SELECT {etype} AS event_type, group_key, {fkey} AS file_business_key, {sev} AS severity, "
            f"{dedupe} AS dedupe_key, {PAYLOADS[payload]} AS payload_json FROM {src} WHERE {where}")


def file_audit_sql(name: str, inserted: str, duplicates: str | None) -> str:
    key = "file_business_key"
    parts = [
        _event("'FILE_REGISTERED'", key, "CASE WHEN parse_error IS NOT NULL THEN 'WARN' ELSE 'INFO' END", key,
               "FILE_REGISTERED", inserted),
        _event("'MANIFEST_REGISTERED'", key, "CASE WHEN expected_parts IS NULL THEN 'WARN' ELSE 'INFO' END",
               f"{key} || '|manifest'", "MANIFEST_REGISTERED", inserted, "is_manifest"),
        _event("'PARSE_ERROR'", key, "'WARN'", f"{key} || '|parse_error'", "PARSE_ERROR", inserted,
               "parse_error IS NOT NULL"),
    ]
    if duplicates:
        parts.append(_event("'FILE_DUPLICATE_IGNORED'", key, "'INFO'", f"{key} || '|duplicate'",
                            "FILE_DUPLICATE_IGNORED", duplicates))
    return f"{name} AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


def skipped_sql(src: str) -> str:
    return _event("'GROUP_DISPATCH_SKIPPED_ALREADY_DONE'", "CAST(NULL AS VARCHAR)", "'INFO'",
                  "dispatch_key || '|already_done'", "SKIPPED", src)


def run_audit_sql(name: str, inserted: str, duplicates: str | None, merged: str, ready: str, disp: str,
                  now: str) -> str:
    ts, none = "CAST(%s AS VARCHAR)", "CAST(NULL AS VARCHAR)"
    parts = [
        f"SELECT * FROM {name}_files",
        _event("'GROUP_CREATED'", none, "'INFO'", f"group_key || '|' || {ts % 'first_seen_at'}", "GROUP_CREATED",
               merged, "created"),
        _event("'GROUP_UPDATED'", none, "'INFO'",
               f"group_key || '|' || CAST(agg_received_parts AS VARCHAR) || '|' || {ts % 'last_seen_at'}",
               "GROUP_UPDATED", merged, "changed"),
        _event("'MANIFEST_CONFLICT'", none, "'WARN'",
               "group_key || '|' || CAST(manifest_distinct_count AS VARCHAR) || '|' || "
               "to_json(manifest_expected_values)", "MANIFEST_CONFLICT", merged, "conflict"),
        _event("CASE WHEN ready_reason_candidate = 'ALL_PARTS' THEN 'GROUP_READY_ALL_PARTS' "
               "ELSE 'GROUP_READY_TIMEOUT' END", none,
               "CASE WHEN ready_reason_candidate = 'TIMEOUT' AND expected_parts IS NULL THEN 'WARN' ELSE 'INFO' END",
               "group_key || '|' || ready_reason_candidate", "GROUP_READY", f"{ready}_cand"),
        _event("'GROUP_DISPATCHED'", none, "'INFO'", "dispatch_key", "GROUP_DISPATCHED", f"{disp}_sent"),
        skipped_sql(f"{disp}_skipped"),
    ]
    return (file_audit_sql(f"{name}_files", inserted, duplicates) + ",\n" + f"{name}_ev AS (\n  "
            + "\n  UNION ALL ".join(parts) + "),\n" + prepare_audit_sql(name, f"{name}_ev", now))


def prepare_audit_sql(name: str, events: str, now: str) -> str:
    return f"""
{name} AS (
  SELECT sha256(concat_ws('|', event_type, coalesce(group_key, '-'), coalesce(file_business_key, '-'),
                          coalesce(dedupe_key, '-'))) AS audit_id,
         event_type, group_key, file_business_key, {now} AS event_ts, coalesce(severity, 'INFO') AS severity,
         TRY_CAST(nullif(regexp_extract(group_key, '\\|(\\d{{4}}-\\d{{2}}-\\d{{2}})$', 1), '') AS DATE) AS dt_ref,
         payload_json
  FROM {events})"""


MANIFEST_ERROR = """
    CASE WHEN content IS NULL THEN 'EMPTY_MANIFEST_PAYLOAD'
         WHEN NOT json_valid(content) OR json_type(content) <> 'OBJECT' THEN 'INVALID_MANIFEST_JSON'
         WHEN json_type(content, '$.expected_parts') IS NULL OR json_type(content, '$.expected_parts') = 'NULL'
           THEN 'MISSING_EXPECTED_PARTS'
         WHEN json_type(content, '$.expected_parts') NOT IN ('UBIGINT', 'BIGINT')
           OR TRY_CAST(json_extract_string(content, '$.expected_parts') AS INTEGER) IS NULL
           OR TRY_CAST(json_extract_string(content, '$.expected_parts') AS INTEGER) <= 0
           THEN 'INVALID_EXPECTED_PARTS' END"""


EMPTY_STATE = """
empty_state AS (
  SELECT CAST(NULL AS VARCHAR) AS group_key, CAST(NULL AS VARCHAR) AS system_name, CAST(NULL AS VARCHAR) AS table_name,
         CAST(NULL AS DATE) AS dt_ref, CAST(NULL AS INTEGER) AS expected_parts, CAST(NULL AS INTEGER) AS received_parts,
         CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS ready_reason,
         CAST(NULL AS TIMESTAMP) AS first_seen_at, CAST(NULL AS TIMESTAMP) AS last_seen_at,
         CAST(NULL AS TIMESTAMP) AS expires_at, CAST(NULL AS TIMESTAMP) AS triggered_at,
         CAST(NULL AS BOOLEAN) AS incomplete_flag, CAST(NULL AS TIMESTAMP) AS last_evaluated_at,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
  WHERE false),
empty_dispatch AS (
  SELECT CAST(NULL AS VARCHAR) AS dispatch_key, CAST(NULL AS VARCHAR) AS group_key,
         CAST(NULL AS VARCHAR) AS system_name, CAST(NULL AS VARCHAR) AS table_name, CAST(NULL AS DATE) AS dt_ref,
         CAST(NULL AS TIMESTAMP) AS dispatched_at, CAST(NULL AS VARCHAR) AS dispatch_reason,
         CAST(NULL AS INTEGER) AS expected_parts, CAST(NULL AS INTEGER) AS received_parts,
         CAST(NULL AS BOOLEAN) AS incomplete_flag, CAST(NULL AS BIGINT) AS snapshot_parts,
         CAST(NULL AS VARCHAR) AS status
  WHERE false)"""


def _chain() -> str:
    frags = [
        LANDING_SQL,
        EMPTY_STATE,
        # single batch
        parsed_sql("parsed", "landing"),
        events_sql("ev", "parsed", T1),
        dedupe_sql("dd", "ev"),
        aggregate_sql("agg", "dd", T1),
        merge_sql("m0", "empty_state", "agg"),
        ready_sql("r0", "m0_state", T1),
        file_audit_sql("a0_files", "dd", None),
        """
strict AS (
  SELECT * REPLACE (
      CASE WHEN is_manifest AND manifest_error IS NULL
           THEN TRY_CAST(json_extract_string(content, '$.expected_parts') AS INTEGER) END AS expected_parts,
      CASE WHEN parse_error IS NOT NULL THEN parse_error
           WHEN part_number_str <> '' AND part_number IS NULL AND NOT is_manifest THEN 'PART_NUMBER_OUT_OF_RANGE'
           WHEN is_manifest THEN manifest_error END AS parse_error)
  FROM (SELECT *, """ + MANIFEST_ERROR + """ AS manifest_error FROM parsed))""",
        events_sql("ev_strict", "strict", T1),
        # run 1
        f"\nb1 AS (SELECT * FROM landing WHERE minute(mtime) < {SPLIT_MINUTE})",
        parsed_sql("p1", "b1"),
        events_sql("ev1", "p1", T1),
        dedupe_sql("dd1", "ev1"),
        f"\nfe1 AS (SELECT {FE_COLS} FROM dd1)",
        aggregate_sql("agg1", "fe1", T1),
        merge_sql("m1", "empty_state", "agg1"),
        ready_sql("r1", "m1_state", T1),
        dispatch_sql("d1", "r1", "empty_dispatch", "fe1", T1),
        run_audit_sql("a1", "fe1", None, "m1", "r1", "d1", T1),
        # run 2
        f"\nb2 AS (SELECT * FROM landing WHERE minute(mtime) >= {SPLIT_MINUTE})",
        parsed_sql("p2", "b2"),
        events_sql("ev2", "p2", T2),
        dedupe_sql("dd2", "ev2"),
        f"""
new2 AS (SELECT {FE_COLS} FROM dd2 d WHERE NOT EXISTS (
  SELECT 1 FROM fe1 f WHERE f.file_business_key = d.file_business_key)),
dup2 AS (SELECT {FE_COLS} FROM dd2 d WHERE EXISTS (
  SELECT 1 FROM fe1 f WHERE f.file_business_key = d.file_business_key)),
fe2 AS (SELECT {FE_COLS} FROM fe1 UNION ALL SELECT {FE_COLS} FROM new2)""",
        aggregate_sql("agg2", "fe2", T2),
        merge_sql("m2", "d1_final", "agg2"),
        ready_sql("r2", "m2_state", T2),
        dispatch_sql("d2", "r2", "d1_table", "fe2", T2),
        run_audit_sql("a2", "new2", "dup2", "m2", "r2", "d2", T2),
        f"""
audit_table AS (
  SELECT * FROM a1 UNION ALL SELECT * FROM a2 WHERE audit_id NOT IN (SELECT audit_id FROM a1)),
replay1_ready AS (SELECT *, sha256(group_key) AS dispatch_key FROM r1 WHERE status = 'READY'),
replay1_skipped AS (
  SELECT r.*, d.dispatched_at FROM replay1_ready r JOIN d1_table d ON d.dispatch_key = r.dispatch_key),
replay2_ready AS (SELECT *, sha256(group_key) AS dispatch_key FROM r2 WHERE status = 'READY'),
replay2_skipped AS (
  SELECT r.*, d.dispatched_at FROM replay2_ready r JOIN d2_table d ON d.dispatch_key = r.dispatch_key),
replay1_ev AS (""" + skipped_sql("replay1_skipped") + """),
replay2_ev AS (""" + skipped_sql("replay2_skipped") + """)""",
        prepare_audit_sql("replay1_audit", "replay1_ev", T1),
        prepare_audit_sql("replay2_audit", "replay2_ev", T2),
    ]
    return "WITH " + ",".join(f.strip("\n") for f in frags)


_AUDIT_SEL = "audit_id, event_type, group_key, file_business_key, event_ts, severity, dt_ref"
_FILE_TYPES = "('FILE_REGISTERED', 'MANIFEST_REGISTERED', 'PARSE_ERROR', 'FILE_DUPLICATE_IGNORED')"
_GROUP_TYPES = ("('GROUP_CREATED', 'GROUP_UPDATED', 'MANIFEST_CONFLICT', 'GROUP_READY_ALL_PARTS', "
                "'GROUP_READY_TIMEOUT')")
_DISPATCH_TYPES = "('GROUP_DISPATCHED', 'GROUP_DISPATCH_SKIPPED_ALREADY_DONE')"
_VALUES = "array_to_string(manifest_expected_values, ',') AS manifest_expected_values"

_SELECTS: dict[str, str] = {
    "landing_files": "SELECT path, mtime, length, content FROM landing",
    "parse_landing": (
        "SELECT file_path, file_name, logical_file_name, system_name, table_name, dt_ref, part_number, is_manifest, "
        "expected_parts, group_key, arrived_at, parse_error FROM parsed"),
    "manifest_payload": "SELECT file_path, content, expected_parts FROM parsed WHERE is_manifest",
    "parse_errors": ("SELECT file_path, logical_file_name AS file_name, parse_error FROM parsed "
                     "WHERE parse_error IS NOT NULL"),
    "file_events": f"SELECT {FE_COLS} FROM ev",
    "content_checksum": ("SELECT path AS file_path, sha256(content) AS checksum_raw, "
                         "sha256(to_base64(encode(content))) AS checksum_base64_text FROM landing"),
    "file_business_key": "SELECT file_path, parse_error, file_business_key, file_event_id FROM ev",
    "dispatch_key": "SELECT group_key, sha256(group_key) AS dispatch_key FROM agg",
    "manifest_quality": """
SELECT file_path, content, manifest_error,
       CASE WHEN manifest_error IS NULL THEN TRY_CAST(json_extract_string(content, '$.expected_parts') AS INTEGER) END
         AS strict_expected_parts
FROM (SELECT file_path, content, """ + MANIFEST_ERROR + """ AS manifest_error FROM parsed WHERE is_manifest)""",
    "dedupe_files": "SELECT file_business_key, file_path, arrived_at, file_size, n_copies FROM dd",
    "valid_events": ("SELECT file_business_key, group_key, part_number, is_manifest, expected_parts, arrived_at "
                     "FROM dd WHERE parse_error IS NULL AND group_key IS NOT NULL"),
    "new_candidates": "SELECT file_business_key, file_path, group_key, parse_error FROM new2",
    "duplicate_candidates": "SELECT file_business_key, file_path, group_key FROM dup2",
    "insert_if_absent": "SELECT file_business_key, file_path, arrived_at, ingested_at, file_size FROM fe2",
    "registration_summary": """
SELECT run, raw_events, unique_candidates, inserted, raw_events - inserted AS duplicates, parse_errors,
       raw_events - unique_candidates AS in_batch_duplicates, unique_candidates - inserted AS already_registered
FROM (
  SELECT 1 AS run, CAST(sum(n_copies) AS BIGINT) AS raw_events, count(*) AS unique_candidates,
         count(*) AS inserted, count(*) FILTER (WHERE parse_error IS NOT NULL) AS parse_errors FROM dd1
  UNION ALL
  SELECT 2, CAST(sum(n_copies) AS BIGINT), count(*),
         count(*) FILTER (WHERE file_business_key NOT IN (SELECT file_business_key FROM fe1)),
         count(*) FILTER (WHERE parse_error IS NOT NULL
                          AND file_business_key NOT IN (SELECT file_business_key FROM fe1)) FROM dd2)""",
    "group_aggregate": ("SELECT group_key, system_name, table_name, dt_ref, first_seen_at, last_seen_at, "
                        "received_parts, expires_at FROM agg"),
    "manifest_stats": f"SELECT group_key, manifest_distinct_count, {_VALUES} FROM agg",
    "merged_partials": ("SELECT group_key, first_seen_at, last_seen_at, received_parts, manifest_expected_parts, "
                        f"manifest_distinct_count, {_VALUES}, expires_at FROM agg2"),
    "part_bitmaps": ("SELECT group_key, CASE WHEN part_number > 0 THEN 1 + (part_number - 1) // 32768 ELSE 0 END AS bucket, "
                     "count(DISTINCT part_number) AS parts, min(dt_ref) AS dt_ref FROM agg2_v "
                     "WHERE NOT is_manifest AND part_number IS NOT NULL GROUP BY 1, 2"),
    "announced_counts": ("SELECT group_key, expected_parts, min(arrived_at) AS arrived_at, "
                         "arg_min(file_business_key, (arrived_at, file_business_key)) AS file_business_key, "
                         "min(dt_ref) AS dt_ref FROM agg2_v WHERE is_manifest AND expected_parts IS NOT NULL GROUP BY 1, 2"),
    "first_manifest": ("SELECT group_key, manifest_expected_parts, first_manifest_key, first_manifest_arrived_at "
                       "FROM agg_f"),
    "new_groups": ("SELECT group_key, first_seen_at, last_seen_at, agg_received_parts AS received_parts, "
                   "manifest_expected_parts FROM m2 WHERE created"),
    "changed_groups": ("SELECT group_key, agg_received_parts AS received_parts, prior_received_parts, last_seen_at, "
                       "prior_last_seen_at, manifest_expected_parts, prior_expected_parts FROM m2 WHERE changed"),
    "manifest_conflicts": (f"SELECT group_key, expected_parts AS group_expected_parts, manifest_expected_parts, "
                           f"manifest_distinct_count, {_VALUES} FROM m2 WHERE conflict"),
    "group_state_upsert": f"SELECT {G_COLS} FROM m2_state",
    "refresh_summary": """
SELECT 1 AS run, count(*) FILTER (WHERE touched) AS groups_seen, count(*) FILTER (WHERE created) AS groups_created,
       count(*) FILTER (WHERE changed) AS groups_updated, count(*) FILTER (WHERE conflict) AS manifest_conflicts
FROM m1
UNION ALL
SELECT 2, count(*) FILTER (WHERE touched), count(*) FILTER (WHERE created), count(*) FILTER (WHERE changed),
       count(*) FILTER (WHERE conflict) FROM m2""",
    "late_arrivals": """
SELECT e.group_key, e.file_business_key, e.arrived_at, g.expires_at, g.status
FROM fe2 e JOIN d2_final g ON e.group_key = g.group_key
WHERE e.parse_error IS NULL AND e.group_key IS NOT NULL AND e.arrived_at > g.expires_at""",
    "ready_reason": "SELECT group_key, expected_parts, received_parts, expires_at, status, ready_reason FROM r0",
    "incomplete_flag": "SELECT group_key, ready_reason_candidate, incomplete_flag_calc FROM r0_cand",
    "mark_ready": f"SELECT {G_COLS} FROM r2",
    "readiness_summary": """
SELECT 1 AS run, count(*) AS ready_groups, count(*) FILTER (WHERE ready_reason_candidate = 'ALL_PARTS')
         AS ready_all_parts, count(*) FILTER (WHERE ready_reason_candidate = 'TIMEOUT') AS ready_timeout FROM r1_cand
UNION ALL
SELECT 2, count(*), count(*) FILTER (WHERE ready_reason_candidate = 'ALL_PARTS'),
       count(*) FILTER (WHERE ready_reason_candidate = 'TIMEOUT') FROM r2_cand""",
    "to_dispatch": "SELECT dispatch_key, group_key, ready_reason FROM d2_pending",
    "skipped_already_dispatched": (
        "SELECT dispatch_key, group_key, ready_reason, dispatched_at FROM replay1_skipped "
        "UNION ALL SELECT dispatch_key, group_key, ready_reason, dispatched_at FROM replay2_skipped"),
    "file_snapshot": "SELECT * FROM d1_snap UNION ALL SELECT * FROM d2_snap",
    "snapshot_chunks": """
SELECT dispatch_key, group_key, coalesce(part_number // 1000, -1) AS chunk, count(*) AS parts,
       '[' || string_agg(""" + json_sql(("part_number", "n"), ("file_name", "s"), ("file_path", "s"),
                                        ("arrived_at", "t")) + """, ','
                         ORDER BY part_number, file_name, file_path, arrived_at) || ']' AS files_json
FROM (SELECT * FROM d1_snap UNION ALL SELECT * FROM d2_snap)
GROUP BY dispatch_key, group_key, coalesce(part_number // 1000, -1)""",
    "dispatch_payload": f"SELECT {D_COLS} FROM d2_table",
    "dispatch_listing": f"SELECT {D_COLS} FROM d2_table ORDER BY group_key",
    "groups_listing": f"SELECT {G_COLS} FROM d2_final ORDER BY group_key",
    "audit_timeline": ("SELECT event_ts, event_type, group_key, severity, payload_json, audit_id FROM audit_table "
                       "ORDER BY event_ts, event_type, group_key, audit_id"),
    "file_events_strict": ("SELECT file_path, is_manifest, part_number, expected_parts, group_key, parse_error, "
                           "file_business_key FROM ev_strict"),
    "mark_dispatched": f"SELECT {G_COLS} FROM d2_final",
    "dispatch_summary": """
SELECT 1 AS run, (SELECT count(*) FROM d1_ready) AS ready_groups, (SELECT count(*) FROM d1_sent) AS dispatched,
       (SELECT count(*) FROM d1_skipped) AS skipped_already_dispatched
UNION ALL
SELECT 2, (SELECT count(*) FROM d2_ready), (SELECT count(*) FROM d2_sent), (SELECT count(*) FROM d2_skipped)
UNION ALL
SELECT 3, (SELECT count(*) FROM replay1_ready),
       (SELECT count(*) FROM replay1_ready WHERE dispatch_key NOT IN (SELECT dispatch_key FROM d1_table)),
       (SELECT count(*) FROM replay1_skipped)
UNION ALL
SELECT 4, (SELECT count(*) FROM replay2_ready),
       (SELECT count(*) FROM replay2_ready WHERE dispatch_key NOT IN (SELECT dispatch_key FROM d2_table)),
       (SELECT count(*) FROM replay2_skipped)""",
    "dispatch_batch_limit": f"""
SELECT group_key, first_seen_at, sha256(group_key) AS dispatch_key FROM r0 WHERE status = 'READY'
ORDER BY first_seen_at, group_key LIMIT {DISPATCH_LIMIT}""",
    "audit_id": """
SELECT event_type, group_key, file_business_key, dedupe_key,
       sha256(concat_ws('|', event_type, coalesce(group_key, '-'), coalesce(file_business_key, '-'),
                        coalesce(dedupe_key, '-'))) AS audit_id
FROM a0_files""",
    "audit_file_events": f"SELECT {_AUDIT_SEL}, payload_json FROM audit_table WHERE event_type IN {_FILE_TYPES}",
    "audit_group_events": f"SELECT {_AUDIT_SEL}, payload_json FROM audit_table WHERE event_type IN {_GROUP_TYPES}",
    "audit_dispatch_events": f"""
SELECT {_AUDIT_SEL}, payload_json FROM (
  SELECT *, row_number() OVER (PARTITION BY audit_id ORDER BY step) AS nth FROM (
    SELECT 1 AS step, {_AUDIT_SEL}, payload_json FROM audit_table WHERE event_type IN {_DISPATCH_TYPES}
    UNION ALL SELECT 2, {_AUDIT_SEL}, payload_json FROM replay1_audit
    UNION ALL SELECT 3, {_AUDIT_SEL}, payload_json FROM replay2_audit))
WHERE nth = 1""",
    "audit_append": f"SELECT {_AUDIT_SEL} FROM audit_table",
    "vw_group_status": """
SELECT status, ready_reason, count(*) AS total_groups,
       CAST(sum(CASE WHEN incomplete_flag THEN 1 ELSE 0 END) AS BIGINT) AS incomplete_groups
FROM r0 GROUP BY status, ready_reason""",
    "vw_file_quality": """
SELECT CAST(arrived_at AS DATE) AS arrived_date, count(*) AS total_files,
       CAST(sum(CASE WHEN parse_error IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS parse_errors
FROM fe2 GROUP BY CAST(arrived_at AS DATE)""",
    "vw_operational_metrics": "SELECT event_type, severity, count(*) AS event_count FROM audit_table GROUP BY 1, 2",
    "report_groups_by_status": ("SELECT status, ready_reason, count(*) AS groups FROM d2_final GROUP BY 1, 2 "
                                "ORDER BY 1, 2"),
    "report_dispatch_reasons": "SELECT dispatch_reason, count(*) AS total FROM d2_table GROUP BY 1 ORDER BY 1",
    "report_audit_by_type": ("SELECT event_type, severity, count(*) AS total FROM audit_table GROUP BY 1, 2 "
                             "ORDER BY 1, 2"),
}


def statements() -> dict[str, str]:
    chain = _chain()
    return {name: f"{chain}\n{select.strip()}" for name, select in _SELECTS.items()}
