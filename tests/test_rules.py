"""Grouping, manifest resolution, readiness, incomplete flag and dispatch gate."""

import datetime as dt
import json

from pyspark.sql import functions as F

from filegate.functions import rules
from filegate.functions.rules import timestamp_literal
from filegate.operators import dispatch, groups, ready

T10 = dt.datetime(2026, 4, 14, 10, 0)
EV_SCHEMA = ("group_key string, is_manifest boolean, part_number int, expected_parts int, arrived_at timestamp, "
             "file_business_key string")


def _aggregate(spark, rows, unique_keys=True):
    df = spark.createDataFrame(rows, EV_SCHEMA)
    return groups.aggregate_groups(df, 30, timestamp_literal("2026-04-14 11:00:00"), unique_keys=unique_keys).first()


def test_parts_are_counted_once_and_expiry_is_first_plus_timeout(spark):
    g = "TJSP|clientes|2026-04-14"
    rows = [(g, False, 1, None, T10, "k1"), (g, False, 1, None, T10, "k1b"), (g, False, 2, None, T10, "k2")]
    agg = _aggregate(spark, rows, unique_keys=False)
    assert agg.received_parts == 2 and agg.manifest_expected_parts is None
    assert agg.expires_at == T10 + dt.timedelta(minutes=30)
    assert (agg.system_name, agg.table_name, agg.dt_ref) == ("TJSP", "clientes", dt.date(2026, 4, 14))


def test_first_manifest_wins_and_conflict_is_visible(spark):
    g = "TJSP|advogados|2026-04-14"
    rows = [(g, True, None, 2, T10, "kb"), (g, True, None, 3, T10 + dt.timedelta(minutes=1), "ka")]
    agg = _aggregate(spark, rows)
    assert agg.manifest_expected_parts == 2
    assert agg.manifest_distinct_count == 2 and list(agg.manifest_expected_values) == [2, 3]


def test_tie_on_arrival_goes_to_smaller_key(spark):
    g = "TJSP|advogados|2026-04-14"
    rows = [(g, True, None, 2, T10, "af26"), (g, True, None, 3, T10, "3c8c")]
    assert _aggregate(spark, rows).manifest_expected_parts == 3


def _state(spark, rows):
    from filegate.schemas import GROUPS_SCHEMA

    base = dict(system_name="S", table_name="t", dt_ref=dt.date(2026, 4, 14), status="OPEN", ready_reason=None,
                first_seen_at=T10, last_seen_at=T10, triggered_at=None, incomplete_flag=False,
                last_evaluated_at=None, created_at=T10, updated_at=T10)
    data = [dict(base, **r) for r in rows]
    return spark.createDataFrame([tuple(d[f] for f in GROUPS_SCHEMA.fieldNames()) for d in data], GROUPS_SCHEMA)


def test_readiness_rules(spark):
    exp = T10 + dt.timedelta(minutes=30)
    state = _state(spark, [
        dict(group_key="all", expected_parts=3, received_parts=3, expires_at=exp),
        dict(group_key="timeout", expected_parts=None, received_parts=1, expires_at=exp),
        dict(group_key="incomplete", expected_parts=5, received_parts=2, expires_at=exp),
        dict(group_key="waiting", expected_parts=None, received_parts=1, expires_at=exp + dt.timedelta(hours=1)),
    ])
    now = timestamp_literal(exp + dt.timedelta(minutes=1))
    cand = {r.group_key: r for r in ready.ready_candidates(state, now).collect()}
    assert cand["all"].ready_reason_candidate == "ALL_PARTS" and cand["all"].incomplete_flag_calc is False
    assert cand["timeout"].ready_reason_candidate == "TIMEOUT" and cand["timeout"].incomplete_flag_calc is False
    assert cand["incomplete"].incomplete_flag_calc is True
    assert "waiting" not in cand
    marked = {r.group_key: r for r in ready.mark_ready(state, now).collect()}
    assert marked["all"].status == "READY" and marked["waiting"].status == "OPEN"
    assert marked["incomplete"].incomplete_flag is True


def test_all_parts_wins_over_timeout(spark):
    df = spark.createDataFrame([(3, 3, T10)], "e int, r int, x timestamp")
    reason = df.select(rules.ready_reason("e", "r", "x", timestamp_literal("2030-01-01 00:00:00"))).first()[0]
    assert reason == "ALL_PARTS"


def test_refresh_keeps_ready_and_stored_expected(spark):
    exp = T10 + dt.timedelta(minutes=30)
    state = _state(spark, [dict(group_key="g|t|2026-04-14", expected_parts=5, received_parts=1, expires_at=exp,
                                status="READY", ready_reason="TIMEOUT")])
    rows = [("g|t|2026-04-14", False, 1, None, T10, "k1"), ("g|t|2026-04-14", False, 2, None, T10, "k2"),
            ("g|t|2026-04-14", True, None, 3, T10, "km")]
    events = spark.createDataFrame(rows, EV_SCHEMA)
    agg = groups.aggregate_groups(events, 30, timestamp_literal("2026-04-14 12:00:00"))
    merged = groups.merge_groups(state, agg)
    row = merged.first()
    assert row.status == "READY" and row.expected_parts == 5 and row.received_parts == 2
    assert row._changed and row._conflict and not row._created


def test_dispatch_gate(spark):
    df = spark.createDataFrame([("READY", False), ("READY", True), ("OPEN", False), ("DISPATCHED", False)],
                               "status string, done boolean")
    assert [r[0] for r in df.select(rules.should_dispatch("status", "done")).collect()] == [True, False, False, False]


def test_dispatch_limit_is_oldest_first(spark):
    exp = T10 + dt.timedelta(minutes=30)
    state = _state(spark, [
        dict(group_key=f"g{i}", expected_parts=None, received_parts=1, expires_at=exp, status="READY",
             first_seen_at=T10 + dt.timedelta(minutes=10 - i))
        for i in range(5)
    ])
    picked = [r.group_key for r in dispatch.ready_groups(state, limit=2).collect()]
    assert sorted(picked) == ["g3", "g4"]


def test_snapshot_chunks_hold_every_part_in_order(spark):
    parts = [None, 0, 1, 999, 1000, 2500]
    rows = spark.createDataFrame([("d", "g", i, f"f{i}", f"/p/f{i}", T10, None) for i in reversed(parts)],
                                 "dispatch_key string, group_key string, part_number int, file_name string, "
                                 "file_path string, arrived_at timestamp, file_checksum string")
    got = {r.chunk: [p.get("part_number") for p in json.loads(r.files_json)]
           for r in dispatch.snapshot_chunks(rows).collect()}
    assert got == {-1: [None], 0: [0, 1, 999], 1: [1000], 2: [2500]}


def test_aware_times_are_utc_instants(spark):
    zone = dt.timezone(dt.timedelta(hours=-3))
    value = dt.datetime(2026, 4, 14, 10, 0, tzinfo=zone)
    row = spark.range(1).select(timestamp_literal(value, ntz=True).alias("n"),
                                timestamp_literal(value).cast("long").alias("t")).first()
    assert row.n == dt.datetime(2026, 4, 14, 13, 0) and row.t == int(value.timestamp())
