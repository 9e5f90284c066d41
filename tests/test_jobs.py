"""End to end over real files: the demo scenario through binaryFile, batch and stream."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from filegate.operators import dispatch
from filegate.functions.rules import timestamp_literal
from filegate.plans.jobs import FilegateConfig, run_dispatch, run_evaluate, run_ingest
from filegate.plans.steps import DispatchStep
from filegate.session import materialize
from filegate.sources.landing import read_jsonl_samples, read_landing
from filegate.sources.state import GroupState
from filegate.sources.tables import ControlTables
from filegate.streaming.ingest import run_ingest_stream

PRE = "SISTEMA=ACME|TABELA="


def _put(root, rel, name, content):
    folder = os.path.join(root, rel)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(content)


def demo_landing(root):
    for i in (1, 2, 3):
        _put(root, "parts/group_a", f"{PRE}invoices|DT_REF=2031-07-08|PART={i:04d}.json", json.dumps({"invoice": i}))
    _put(root, "manifests/group_a", f"{PRE}invoices|DT_REF=2031-07-08|MANIFEST.json", '{"expected_parts": 3}')
    _put(root, "parts/group_b", f"{PRE}shipments|DT_REF=2031-07-09|PART=0001.json", '{"shipment": 77}')
    _put(root, "parts/dup_1", f"{PRE}invoices|DT_REF=2031-07-08|PART=0001.json", '{"invoice": 1}')
    _put(root, "parts/dup_2", f"{PRE}invoices|DT_REF=2031-07-08|PART=0001.json", '{"invoice": 1}')
    _put(root, "manifests/conflict_a", f"{PRE}returns|DT_REF=2031-07-08|MANIFEST.json", '{"expected_parts": 2}')
    _put(root, "manifests/conflict_b", f"{PRE}returns|DT_REF=2031-07-08|MANIFEST.json", '{"expected_parts": 3}')


def _audit_counts(store):
    rows = store.read("audit").groupBy("event_type", "severity").count().collect()
    return {(r.event_type, r.severity): r["count"] for r in rows}


@pytest.fixture()
def demo(scratch):
    landing = os.path.join(scratch, "landing")
    demo_landing(landing)
    return FilegateConfig(tables_root=f"file:{scratch}/tables", landing=landing,
                          checkpoints_root=f"file:{scratch}/checkpoints")


def test_split_scan_reads_bytes_of_manifests_only(spark, demo):
    raw = read_landing(spark, demo.landing)
    rows = {r.path.split("/")[-2] + "/" + r.path.split("/")[-1]: r for r in raw.collect()}
    assert len(rows) == 9
    assert all((r.content is not None) == r.path.endswith("MANIFEST.json") for r in rows.values())
    full = read_landing(spark, demo.landing, all_content=True)
    assert full.count() == 9 and full.where(F.col("content").isNull()).count() == 0


def test_missing_landing_is_empty(spark, scratch):
    assert read_landing(spark, os.path.join(scratch, "nope")).count() == 0


def test_demo_scenario(spark, demo):
    store = ControlTables(spark, demo.tables_root)
    reg = run_ingest(spark, demo, now="2031-07-08 10:00:00")
    assert (reg["raw_events"], reg["unique_candidates"], reg["inserted"], reg["duplicates"],
            reg["parse_errors"]) == (9, 7, 7, 2, 0)
    counts = _audit_counts(store)
    assert counts[("FILE_REGISTERED", "INFO")] == 7 and counts[("MANIFEST_REGISTERED", "INFO")] == 3

    early = run_evaluate(spark, demo, now="2031-07-08 10:10:00")
    assert (early["groups_created"], early["manifest_conflicts"], early["ready_all_parts"]) == (3, 1, 1)
    state = {r.group_key: r for r in store.read("groups").collect()}
    assert state["ACME|invoices|2031-07-08"].status == "READY"
    _, first = min((r.file_business_key, r.expected_parts) for r in store.read("file_events").collect()
                   if r.table_name == "returns")
    assert state["ACME|returns|2031-07-08"].expected_parts == first  # smaller hash wins the tie
    assert state["ACME|shipments|2031-07-09"].expected_parts is None

    late = run_evaluate(spark, demo, now="2031-07-08 10:40:00")
    assert late["ready_timeout"] == 2
    state = {r.group_key: r for r in store.read("groups").collect()}
    assert state["ACME|returns|2031-07-08"].incomplete_flag is True
    assert state["ACME|shipments|2031-07-09"].incomplete_flag is False
    counts = _audit_counts(store)
    assert counts[("GROUP_READY_TIMEOUT", "WARN")] == 1 and counts[("GROUP_READY_TIMEOUT", "INFO")] == 1
    assert counts[("MANIFEST_CONFLICT", "WARN")] == 1

    sent = run_dispatch(spark, demo, now="2031-07-08 10:41:00")
    assert (sent["ready_groups"], sent["dispatched"], sent["skipped_already_dispatched"]) == (3, 3, 0)
    disp = {r.group_key: r for r in store.read("dispatch").collect()}
    assert {k: r.snapshot_parts for k, r in disp.items()} == {
        "ACME|invoices|2031-07-08": 3, "ACME|shipments|2031-07-09": 1, "ACME|returns|2031-07-08": 0}
    chunks = {r.group_key: json.loads(r.files_json)
              for r in dispatch.snapshot_chunks(store.read("dispatch_files")).collect()}
    assert [p["part_number"] for p in chunks["ACME|invoices|2031-07-08"]] == [1, 2, 3]
    assert store.read("dispatch_files").count() == 4

    again = run_ingest(spark, demo, now="2031-07-08 10:45:00")
    assert (again["inserted"], again["duplicates"]) == (0, 9)
    assert _audit_counts(store)[("FILE_DUPLICATE_IGNORED", "INFO")] == 7
    assert run_evaluate(spark, demo, now="2031-07-08 10:50:00")["ready_groups"] == 0
    assert run_dispatch(spark, demo, now="2031-07-08 10:51:00")["dispatched"] == 0
    assert store.read("dispatch").count() == 3
    assert {r.status for r in store.read("groups").collect()} == {"DISPATCHED"}
    before = store.read("audit").count()
    run_ingest(spark, demo, now="2031-07-08 11:00:00")
    assert store.read("audit").count() == before


def test_replay_repairs_unmarked_dispatch(spark, demo):
    store = ControlTables(spark, demo.tables_root)
    run_ingest(spark, demo, now="2031-07-08 10:00:00")
    run_evaluate(spark, demo, now="2031-07-08 10:40:00")
    state = materialize(store.read("groups"))
    run_dispatch(spark, demo, now="2031-07-08 10:41:00")
    # lose the DISPATCHED marks: put the READY state back
    store.state.commit({"groups": state})
    assert {r.status for r in store.read("groups").collect()} == {"READY"}
    repair = run_dispatch(spark, demo, now="2031-07-08 12:00:00")
    assert (repair["dispatched"], repair["skipped_already_dispatched"]) == (0, 3)
    state = store.read("groups").collect()
    assert {r.status for r in state} == {"DISPATCHED"}
    assert {str(r.triggered_at) for r in state} == {"2031-07-08 10:41:00"}
    assert _audit_counts(store)[("GROUP_DISPATCH_SKIPPED_ALREADY_DONE", "INFO")] == 3


def test_stream_equals_batch_on_all_columns_and_drains_once(spark, demo, scratch):
    _put(demo.landing, "manifests/escaped", f"{PRE}escaped|DT_REF=2031-07-10|MANIFEST%2Ejson", '{"expected_parts": 1}')
    _put(demo.landing, "parts/escaped", "SISTEMA%3DACME%7CTABELA%3Descaped%7CDT_REF%3D2031-07-10%7CPART%3D1.json", "{}")
    common = dict(landing=demo.landing, arrival="modification")
    for checksum in ("raw", None):
        stream_cfg = FilegateConfig(tables_root=f"file:{scratch}/stream_{checksum}", checksum=checksum,
                                    checkpoints_root=f"file:{scratch}/ckpt_{checksum}", **common)
        batch_cfg = FilegateConfig(tables_root=f"file:{scratch}/batch_{checksum}", checksum=checksum, **common)
        first = run_ingest_stream(spark, stream_cfg, now="2031-07-08 10:00:00", max_files_per_trigger=4)
        assert first["batches"] >= 2 and first["inserted"] == 9
        assert run_ingest_stream(spark, stream_cfg, now="2031-07-08 10:05:00")["batches"] == 0
        run_ingest(spark, batch_cfg, now="2031-07-08 10:00:00")
        # arrival = modification time: any split of the files in arrival order keeps the same survivors
        a, b = (sorted(map(repr, ControlTables(spark, c.tables_root).read("file_events").collect()))
                for c in (stream_cfg, batch_cfg))
        assert a == b and len(a) == 9
        rows = ControlTables(spark, batch_cfg.tables_root).read("file_events").collect()
        assert all((r.file_checksum is not None) == (checksum is not None) for r in rows)
        assert [r.expected_parts for r in rows if r.table_name == "escaped" and r.is_manifest] == [1]


def test_the_bytes_of_parts_are_never_read(spark, demo, scratch):
    _put(demo.landing, "parts/large", f"{PRE}large|DT_REF=2031-07-10|PART=0001.json", "x" * 5000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    try:
        assert run_ingest(spark, demo, now="2031-07-08 10:00:00")["inserted"] == 8
        stream = FilegateConfig(tables_root=f"file:{scratch}/stream", landing=demo.landing,
                                checkpoints_root=f"file:{scratch}/ckpt_large")
        assert run_ingest_stream(spark, stream, now="2031-07-08 10:00:00")["inserted"] == 8
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_stream_over_a_missing_folder_is_an_empty_run(spark, scratch):
    cfg = FilegateConfig(tables_root=f"file:{scratch}/none", landing=f"{scratch}/nowhere",
                         checkpoints_root=f"file:{scratch}/none_ckpt")
    assert run_ingest_stream(spark, cfg, now="2031-07-08 10:00:00")["batches"] == 0


def test_a_replayed_micro_batch_adds_nothing(spark, demo):
    cfg = demo
    run_ingest_stream(spark, cfg, now="2031-07-08 10:00:00")
    store = ControlTables(spark, cfg.tables_root)
    before = sorted(map(repr, store.read("file_events").collect()))
    # forget the commit of batch 0: the source delivers the same files under the same batch id
    commits = os.path.join(cfg.ingest_checkpoint.removeprefix("file:"), "commits")
    for name in os.listdir(commits):
        os.remove(os.path.join(commits, name))
    again = run_ingest_stream(spark, cfg, now="2031-07-08 10:01:00")
    assert (again["batches"], again["inserted"], again["already_registered"]) == (1, 0, 7)
    assert sorted(map(repr, store.read("file_events").collect())) == before


def test_jsonl_samples_adapter(spark, scratch):
    sample = os.path.join(scratch, "samples.jsonl")
    with open(sample, "w") as f:
        f.write('{"logical_file_name":"SISTEMA=ACME|TABELA=invoices|DT_REF=2031-07-08|PART=0001.json",'
                '"payload":{"invoice":1}}\n')
        f.write('{"logical_file_name":"SISTEMA=ACME|TABELA=returns|DT_REF=2031-07-08|MANIFEST.json",'
                '"payload":{"expected_parts":2}}\n')
    cfg = FilegateConfig(tables_root=f"file:{scratch}/jsonl_tables")
    ControlTables(spark, cfg.tables_root).ensure()
    from filegate.plans.jobs import ingest_batch

    raw = read_jsonl_samples(spark, sample, modification_time="2031-07-08 10:00:00")
    out = ingest_batch(spark, cfg, raw, now="2031-07-08 10:00:00")
    assert out["inserted"] == 2
    fe = ControlTables(spark, cfg.tables_root).read("file_events").where("is_manifest").first()
    assert fe.expected_parts == 2


def _late(root, rel, table, part):
    _put(root, rel, f"{PRE}{table}|DT_REF=2031-07-10|PART={part:04d}.json", "{}")


@pytest.mark.parametrize("times", [
    ("2031-07-08 10:00:00", "2031-07-08 10:00:00", "2031-07-08 10:00:00"),  # equal
    ("2031-07-08 10:00:00", "2031-07-08 09:00:00", "2031-07-08 09:30:00"),  # falling
])
def test_incremental_refresh_equals_full_refresh(spark, scratch, times):
    landing = os.path.join(scratch, "landing_inc")
    demo_landing(landing)
    common = dict(landing=landing, arrival="modification")
    inc = FilegateConfig(tables_root=f"file:{scratch}/inc", **common)
    full = FilegateConfig(tables_root=f"file:{scratch}/full", incremental_refresh=False, **common)
    for cfg in (inc, full):
        run_ingest(spark, cfg, now=times[0])
        run_evaluate(spark, cfg, now="2031-07-08 10:05:00")
    _late(landing, "late1", "shipments", 2)
    for cfg in (inc, full):
        run_ingest(spark, cfg, now=times[1])
    _late(landing, "late2", "fresh", 1)
    for cfg in (inc, full):
        run_ingest(spark, cfg, now=times[2])
        assert run_evaluate(spark, cfg, now="2031-07-08 10:25:00")["groups_created"] == 2
        assert run_evaluate(spark, cfg, now="2031-07-08 10:30:00")["groups_created"] == 0
    # a changed timeout moves every deadline
    for cfg in (inc, full):
        run_evaluate(spark, replace(cfg, group_timeout_minutes=90), now="2031-07-08 10:40:00")
    stores = [ControlTables(spark, cfg.tables_root) for cfg in (inc, full)]
    cols = [c for c in stores[0].read("groups").columns if c != "updated_at"]
    a, b = (sorted(tuple(r) for r in s.read("groups").select(*cols).collect()) for s in stores)
    assert a == b and len(a) == 5
    for r in stores[0].read("groups").collect():
        assert (r.expires_at - r.first_seen_at).total_seconds() == 90 * 60


def test_a_version_holds_the_changed_groups_alone(spark, demo):
    cfg = replace(demo, arrival="modification")
    store = ControlTables(spark, cfg.tables_root)
    run_ingest(spark, cfg, now="2031-07-08 10:00:00")
    run_evaluate(spark, cfg, now="1970-01-01 00:00:00")
    before = {r.group_key: r for r in store.read("groups").collect()}
    run_evaluate(spark, cfg, now="1970-01-01 00:05:00")
    assert [v.base for v in store.state.live()] == [True]  # nothing changed: no version
    _put(cfg.landing, "late", f"{PRE}shipments|DT_REF=2031-07-09|PART=0002.json", "{}")
    run_ingest(spark, cfg, now="2031-07-08 10:00:00")
    run_evaluate(spark, cfg, now="1970-01-01 00:10:00")
    live = store.state.live()
    assert [v.base for v in live] == [True, False]
    written = spark.read.parquet(f"{cfg.tables_root}/state/groups/version={live[1].number:010d}").collect()
    assert [r.group_key for r in written] == ["ACME|shipments|2031-07-09"]
    after = {r.group_key: r for r in store.read("groups").collect()}
    assert {k for k in after if after[k] != before[k]} == {"ACME|shipments|2031-07-09"}
    assert after["ACME|shipments|2031-07-09"].received_parts == 2


def test_an_append_writes_one_file_per_date(spark, scratch):
    landing = os.path.join(scratch, "many")
    for day in range(1, 11):
        for part in range(1, 6):
            _put(landing, f"p{part}", f"{PRE}t|DT_REF=2026-05-{day:02d}|PART={part:04d}.json", "{}")
    cfg = FilegateConfig(tables_root=f"file:{scratch}/many_tables", landing=landing)
    run_ingest(spark, cfg, now="2026-05-14 10:00:00")
    for table in ("file_events", "audit"):
        files = [f for _, _, names in os.walk(os.path.join(scratch, "many_tables", table))
                 for f in names if f.endswith(".parquet")]
        assert len(files) == 10


def test_stream_can_skip_existing_files(spark, demo, scratch):
    cfg = FilegateConfig(tables_root=f"file:{scratch}/skip_tables", landing=demo.landing,
                         checkpoints_root=f"file:{scratch}/skip_ckpt")
    out = run_ingest_stream(spark, cfg, now="2031-07-08 10:00:00", modified_after="2999-01-01 00:00:00")
    assert out["inserted"] == 0 and out["raw_events"] == 0


def test_run_cycle_uses_one_processing_time(spark, demo):
    from filegate.plans.jobs import run_cycle

    out = run_cycle(spark, demo, now="2031-07-08 10:00:00")
    assert out["ingest"]["inserted"] == 7
    # arrival = ingest time, so only the complete group is ready at the same instant
    assert (out["evaluate"]["ready_all_parts"], out["evaluate"]["ready_timeout"]) == (1, 0)
    assert out["dispatch"]["dispatched"] == 1
    later = run_cycle(spark, demo, now="2031-07-08 10:30:00")
    assert later["ingest"]["inserted"] == 0
    assert (later["evaluate"]["ready_timeout"], later["dispatch"]["dispatched"]) == (2, 2)
    store = ControlTables(spark, demo.tables_root)
    assert {r.status for r in store.read("groups").collect()} == {"DISPATCHED"}


def _tables(spark, cfg):
    store = ControlTables(spark, cfg.tables_root)
    drop = {"groups": {"created_at"}}
    return {t: sorted(map(repr, store.read(t).select(*[c for c in store.read(t).columns
                                                       if c not in drop.get(t, ())]).collect()))
            for t in ("file_events", "groups", "dispatch", "dispatch_files", "audit")}


class Stop(Exception):
    pass


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """The tables of a cycle that was not stopped, and its landing."""
    root = str(tmp_path_factory.mktemp("whole"))
    landing = os.path.join(root, "landing")
    demo_landing(landing)
    cfg = FilegateConfig(tables_root=f"file:{root}/tables", landing=landing, arrival="modification")
    for step in (run_ingest, run_evaluate, run_dispatch):
        step(spark, cfg, now="2031-07-08 10:00:00")
    return cfg, _tables(spark, cfg)


# the writes of a cycle: 1 audit, 2 file_events; 3 audit, 4 groups; 5 audit, 6 dispatch_files, 7 dispatch, 8 groups
@pytest.mark.parametrize("after", [1, 3, 6, 7])
def test_a_run_stopped_after_a_write_is_completed_by_the_next(spark, whole, scratch, monkeypatch, after):
    now = "2031-07-08 10:00:00"
    done, want = whole
    broken = replace(done, tables_root=f"file:{scratch}/broken")
    writes = {"n": 0}
    with monkeypatch.context() as patch:
        for owner, name in ((ControlTables, "append"), (GroupState, "commit")):
            real = getattr(owner, name)

            def counted(self, *args, real=real, **named):
                real(self, *args, **named)
                writes["n"] += 1
                if writes["n"] == after:
                    raise Stop

            patch.setattr(owner, name, counted)
        with pytest.raises(Stop):
            for step in (run_ingest, run_evaluate, run_dispatch):
                step(spark, broken, now=now)
    rest = (run_ingest, run_evaluate, run_dispatch)[0 if after < 3 else 1 if after < 5 else 2:]
    for step in rest:
        step(spark, broken, now=now)
    got = _tables(spark, broken)
    # the re-run of a finished step logs what it ignored; all else is equal
    extra = ("FILE_DUPLICATE_IGNORED", "GROUP_DISPATCH_SKIPPED_ALREADY_DONE")
    for t in want:
        assert [r for r in got[t] if not any(e in r for e in extra)] == want[t], t


def test_a_partly_written_snapshot_is_completed(spark, demo):
    run_ingest(spark, demo, now="2031-07-08 10:00:00")
    run_evaluate(spark, demo, now="2031-07-08 10:40:00")
    store = ControlTables(spark, demo.tables_root)
    step = DispatchStep(store.read("groups"), store.read("file_events"), store.read("dispatch"),
                        timestamp_literal("2031-07-08 10:41:00"), stage=False)
    store.append("dispatch_files", materialize(step.snapshot.where("part_number = 2")))
    run_dispatch(spark, demo, now="2031-07-08 10:41:00")
    files = store.read("dispatch_files").groupBy("dispatch_key").count().collect()
    assert sorted(r["count"] for r in files) == [1, 3]
    rows = {r.dispatch_key: r.snapshot_parts for r in store.read("dispatch").collect() if r.snapshot_parts}
    assert rows == {r.dispatch_key: r["count"] for r in files}


def test_the_limit_leaves_groups_for_the_next_run(spark, demo):
    run_ingest(spark, demo, now="2031-07-08 10:00:00")
    run_evaluate(spark, demo, now="2031-07-08 10:40:00")
    first = run_dispatch(spark, demo, now="2031-07-08 10:41:00", limit=2)
    assert (first["dispatched"], first["ready_left"]) == (2, 1)
    second = run_dispatch(spark, demo, now="2031-07-08 10:42:00", limit=2)
    assert (second["dispatched"], second["ready_left"]) == (1, 0)
