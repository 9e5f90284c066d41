"""The versioned group state, the change feed by run, and key-pruned appends."""

import datetime as dt
import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.plans.jobs import FilegateConfig, ingest_batch, run_dispatch, run_evaluate
from filegate.schemas import RAW_LISTING_SCHEMA
from filegate.session import materialize
from filegate.sources.state import GroupState
from filegate.sources.tables import ControlTables, date_ranges

EPOCH = dt.datetime(2031, 7, 8, 10, 0, tzinfo=dt.timezone.utc)


def name(table, day, part=None, system="ACME"):
    tail = "MANIFEST.json" if part is None else f"PART={part:04d}.json"
    return f"SISTEMA={system}|TABELA={table}|DT_REF={day}|{tail}"


def listing(spark, files):
    """(name, minute, payload) -> listing rows; the folder tells equal names apart."""
    rows = [(f"file:/drop/{i}/{n}", EPOCH + dt.timedelta(minutes=m), 20, (p or "{}").encode())
            for i, (n, m, p) in enumerate(files)]
    return spark.createDataFrame(rows, RAW_LISTING_SCHEMA)


def config(scratch, label, **options):
    return FilegateConfig(tables_root=f"file:{scratch}/{label}", arrival="modification", **options)


def ingest(spark, cfg, files, now="2031-07-08 12:00:00"):
    store = ControlTables(spark, cfg.tables_root)
    store.ensure()
    return ingest_batch(spark, cfg, listing(spark, files), now=now, store=store)


def rows_of(spark, cfg, drop=("created_at", "updated_at")):
    df = ControlTables(spark, cfg.tables_root).read("groups")
    return sorted(map(repr, df.select(*[c for c in df.columns if c not in drop]).collect()))


class Stop(Exception):
    pass


# --- a version appears whole or not at all --------------------------------------------------

@pytest.mark.parametrize("incremental, stop_at", [(True, "groups"), (True, "announced"), (True, "marker"),
                                                  (False, "groups"), (False, "marker")])
def test_a_stop_inside_the_state_write_leaves_the_old_state(spark, scratch, monkeypatch, incremental, stop_at):
    """Two open groups of one date; the run that brings a file for one of them stops inside its write."""
    cfg = config(scratch, "stopped", incremental_refresh=incremental)
    first = [(name("a", "2031-07-08", 1), 0, None), (name("b", "2031-07-08", 1), 1, None),
             (name("b", "2031-07-08"), 2, '{"expected_parts": 2}')]
    ingest(spark, cfg, first)
    run_evaluate(spark, cfg, now="2031-07-08 10:05:00")
    before = rows_of(spark, cfg, drop=())
    ingest(spark, cfg, [(name("b", "2031-07-08", 2), 6, None)])

    def stopped_write(self, table, rows, number, real=GroupState.write):
        real(self, table, rows, number)
        if table == stop_at:  # a part of the table's files is gone, as a stop inside the job would leave it
            folder = self._folder(table, number).removeprefix("file:")
            for where, _, files in os.walk(folder):
                for f in files[::2]:
                    os.remove(os.path.join(where, f))
            raise Stop

    def no_marker(self, version):
        raise Stop

    with monkeypatch.context() as patch:
        patch.setattr(GroupState, "write", stopped_write)
        if stop_at == "marker":
            patch.setattr(GroupState, "complete", no_marker)
        with pytest.raises(Stop):
            run_evaluate(spark, cfg, now="2031-07-08 10:10:00")
    assert rows_of(spark, cfg, drop=()) == before
    out = run_evaluate(spark, cfg, now="2031-07-08 11:10:00")
    assert (out["groups_updated"], out["ready_all_parts"], out["ready_timeout"]) == (1, 1, 1)
    state = {r.group_key: r for r in ControlTables(spark, cfg.tables_root).read("groups").collect()}
    assert {k: (r.received_parts, r.status) for k, r in state.items()} == {
        "ACME|a|2031-07-08": (1, "READY"), "ACME|b|2031-07-08": (2, "READY")}


def test_a_stop_inside_the_marks_write_is_repaired(spark, scratch, monkeypatch):
    cfg = config(scratch, "marks")
    ingest(spark, cfg, [(name("a", "2031-07-08", 1), 0, None)])
    run_evaluate(spark, cfg, now="2031-07-08 11:00:00")

    def no_marker(self, version):
        raise Stop

    with monkeypatch.context() as patch:
        patch.setattr(GroupState, "complete", no_marker)
        with pytest.raises(Stop):
            run_dispatch(spark, cfg, now="2031-07-08 11:05:00")
    store = ControlTables(spark, cfg.tables_root)
    assert [r.status for r in store.read("groups").collect()] == ["READY"]
    again = run_dispatch(spark, cfg, now="2031-07-08 12:00:00")
    assert (again["dispatched"], again["skipped_already_dispatched"]) == (0, 1)
    row = store.read("groups").first()
    assert (row.status, str(row.triggered_at)) == ("DISPATCHED", "2031-07-08 11:05:00")
    assert store.read("dispatch").count() == 1


def test_versions_are_folded_into_a_new_base_and_old_ones_removed(spark, scratch, monkeypatch):
    monkeypatch.setattr("filegate.sources.state.DELTAS", 3)
    state = GroupState(spark, f"file:{scratch}/versions")
    schema = state.read("groups").schema
    at = dt.datetime(2031, 1, 1)

    def group(i, received):
        return (f"S|t{i}|2031-01-01", "S", f"t{i}", at.date(), None, received, "OPEN", None, at, at, at, None, False, None, at, at)

    want = {}
    for n in range(11):
        changed = {i: n for i in {n % 7, n % 3, n}}
        want |= changed
        state.commit({"groups": materialize(spark.createDataFrame([group(*x) for x in changed.items()], schema))}, run=n)
        if n % 5 == 0:
            assert {r.table_name: r.received_parts for r in state.read().collect()} == {f"t{i}": v for i, v in want.items()}
    versions = state.versions()
    assert [v.base for v in state.live()] == [True] + [False] * (len(state.live()) - 1) and state.live()[-1].run == n
    assert versions[0].base and len([v for v in versions if v.base]) == 2
    folders = os.listdir(f"{scratch}/versions/state/groups")
    assert len(folders) == len(versions)


# --- merging new runs into stored partials ----------------------------------------------------

def random_files(rng, n):
    files = []
    for _ in range(n):
        table, day = rng.choice("abc"), f"2031-07-{rng.randrange(8, 11):02d}"
        kind = rng.random()
        if kind < 0.2:
            files.append((name(table, day), rng.randrange(200), '{"expected_parts": %d}' % rng.randrange(1, 6)))
        elif kind < 0.25:
            files.append((f"junk{rng.randrange(3)}.json", rng.randrange(200), None))
        else:
            files.append((name(table, day, rng.choice([1, 2, 3, 4, 32768, 32769, 70000])), rng.randrange(200), None))
    return files


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_new_runs_equals_folding_everything(spark, scratch, seed):
    """Random files in random batches, runs skipped by evaluate, late files, a run folded twice, and a merge of runs."""
    rng = random.Random(seed)
    batches = [random_files(rng, rng.randrange(1, 25)) for _ in range(4)]
    merged = config(scratch, "merged", merge_runs_from=3)
    whole = config(scratch, "whole", incremental_refresh=False)
    now = dt.datetime(2031, 7, 8, 10, 0)
    for i, files in enumerate(batches):
        now += dt.timedelta(minutes=rng.randrange(60))
        for cfg in (merged, whole):
            ingest(spark, cfg, files, now=now)
            if i != 1:
                counters = run_evaluate(spark, cfg, now=now)
                if cfg is merged:
                    kept = counters
        if i != 1:
            for key in ("groups_created", "groups_updated", "ready_all_parts", "ready_timeout"):
                assert counters[key] == kept[key], key
            assert rows_of(spark, merged) == rows_of(spark, whole)
    for cfg in (merged, whole):
        run_evaluate(spark, replace(cfg, group_timeout_minutes=500), now=now)
    assert rows_of(spark, merged) == rows_of(spark, whole)
    a, b = (sorted(map(repr, ControlTables(spark, c.tables_root).read("file_events").collect())) for c in (merged, whole))
    assert a == b
    stored = GroupState(spark, merged.tables_root), GroupState(spark, whole.tables_root)
    for table in ("part_bitmaps", "announced"):
        a, b = (sorted(map(repr, s.read(table).collect())) for s in stored)
        assert a == b and a


def test_unchanged_groups_keep_their_update_time(spark, scratch):
    for incremental in (True, False):
        cfg = config(scratch, f"t17-{incremental}", incremental_refresh=incremental)
        ingest(spark, cfg, [(name("a", "2031-07-08", 1), 0, None), (name("b", "2031-07-09", 1), 1, None)])
        run_evaluate(spark, cfg, now="2031-07-08 10:05:00")
        ingest(spark, cfg, [(name("b", "2031-07-09", 2), 6, None)])
        run_evaluate(spark, cfg, now="2031-07-08 10:10:00")
        times = {r.table_name: str(r.updated_at) for r in ControlTables(spark, cfg.tables_root).read("groups").collect()}
        assert times == {"a": "2031-07-08 10:05:00", "b": "2031-07-08 10:10:00"}


# --- the change feed ------------------------------------------------------------------------------

def test_evaluate_reads_new_runs_alone(spark, scratch):
    cfg = config(scratch, "feed")
    store = ControlTables(spark, cfg.tables_root)
    for i in range(3):
        ingest(spark, cfg, [(name("a", "2031-07-08", i + 1), i, None)])
    assert store.runs() == [0, 1, 2] and store.new_runs(0) == [1, 2]
    feed = store.feed(1)
    assert {f.split("run_id=")[1].split("/")[0] for f in feed.inputFiles()} == {"2"}
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "(run_id" in plan
    assert [r.part_number for r in feed.collect()] == [3]
    assert store.feed(2).collect() == []


def test_a_run_that_stopped_is_folded_after_the_next_ingest(spark, scratch, monkeypatch):
    """Its rows are stored, its mark is not: the next ingest finishes it, and its groups are folded."""
    cfg = config(scratch, "open")
    real = ControlTables._mark

    def no_done(self, run, kind):
        if kind == "done":
            raise Stop
        real(self, run, kind)

    with monkeypatch.context() as patch:
        patch.setattr(ControlTables, "_mark", no_done)
        with pytest.raises(Stop):
            ingest(spark, cfg, [(name("a", "2031-07-08", 1), 0, None)])
    assert run_evaluate(spark, cfg, now="2031-07-08 10:05:00")["groups_seen"] == 0
    assert ingest(spark, cfg, [(name("a", "2031-07-08", 1), 0, None)])["already_registered"] == 1
    assert run_evaluate(spark, cfg, now="2031-07-08 10:05:00")["groups_created"] == 1


def test_merged_runs_keep_the_rows_and_the_feed(spark, scratch, monkeypatch):
    cfg = config(scratch, "runs", merge_runs_from=10 ** 6)
    store = ControlTables(spark, cfg.tables_root)

    def add(i):
        ingest(spark, cfg, [(name("a", f"2031-07-{8 + i % 2:02d}", i + 1), i, None), (f"bad{i}", i, None)])

    for i in range(3):
        add(i)
    run_evaluate(spark, cfg, now="2031-07-08 10:05:00")
    add(3)
    before = sorted(map(repr, store.read("file_events").collect()))

    def no_merge_mark(self, run, kind, real=ControlTables._mark):
        if kind.startswith("merged"):
            raise Stop
        real(self, run, kind)

    with monkeypatch.context() as patch:
        patch.setattr(ControlTables, "_mark", no_merge_mark)
        with pytest.raises(Stop):
            store.merge_runs()
    assert sorted(map(repr, store.read("file_events").collect())) == before and store.runs() == [0, 1, 2, 3]
    run = store.merge_runs()
    assert store.runs() == [3, run] and store.new_runs(2) == [3]
    assert sorted(map(repr, store.read("file_events").collect())) == before
    run_evaluate(spark, cfg, now="2031-07-08 10:06:00")
    add(4)
    run_evaluate(spark, cfg, now="2031-07-08 10:07:00")
    last = store.merge_runs()
    assert store.runs() == [last] and store.read("file_events").count() == 10
    assert {f for f in os.listdir(f"{scratch}/runs/file_events") if f.startswith("run_id=")} >= {f"run_id={last}"}
    groups = {str(r.dt_ref): r.received_parts for r in store.read("groups").collect()}
    assert groups == {"2031-07-08": 3, "2031-07-09": 2}


# --- key-pruned appends -----------------------------------------------------------------------------

def test_an_old_and_a_new_date_read_neither_the_years_between_nor_all_bad_names(spark, scratch):
    cfg = config(scratch, "near")
    store = ControlTables(spark, cfg.tables_root)
    files = [(name("a", f"{year}-{month:02d}-01", 1), 0, None) for year in range(1999, 2024, 3) for month in (1, 7)]
    ingest(spark, cfg, files + [(f"bad{i}.json", 0, None) for i in range(300)])
    batch = materialize(store.read("file_events").where(
        "dt_ref in (date '1999-07-01', date '2023-01-01') or file_name = 'bad7.json'"))
    near = store.near("file_events", batch)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PushedFilters: [In(file_business_key" in plan
    read = store._stored("file_events").where("dt_ref is null").select("key_bucket").distinct().count()
    assert read > 40  # bad names are spread
    rows = near.select("dt_ref").distinct().collect()
    assert {str(r[0]) for r in rows} == {"1999-07-01", "2023-01-01", "None"}
    # a batch of many keys names none: then partitions alone decide, the dates and one of the 64 buckets
    near = store.near("file_events", batch.unionByName(batch).unionByName(batch).unionByName(batch))
    found = near.groupBy("dt_ref").count().collect()
    assert {str(r[0]) for r in found} == {"1999-07-01", "2023-01-01", "None"}
    assert {str(r[0]): r[1] for r in found}["None"] < 30


def test_date_ranges_cover_and_stay_few():
    rng = random.Random(5)
    days = sorted({dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(12000)) for _ in range(400)})
    ranges = date_ranges([(d, d) for d in days], limit=20)
    assert len(ranges) == 20 and all(any(a <= d <= b for a, b in ranges) for d in days)
    assert ranges == sorted(ranges) and date_ranges([]) == [] and date_ranges([(days[0], days[1])]) == [(days[0], days[1])]


def test_the_key_column_carries_a_bloom_filter(spark, scratch):
    cfg = config(scratch, "bloom")
    ingest(spark, cfg, [(name("a", "2031-07-08", i), 0, None) for i in range(500)])
    import pyarrow.parquet as pq

    files = [os.path.join(w, f) for w, _, names in os.walk(f"{scratch}/bloom/file_events") for f in names if f.endswith(".parquet")]
    plain = [f for f in files if pq.ParquetFile(f).metadata.num_rows > 100]
    assert plain and max(map(os.path.getsize, plain)) < 400_000  # sized by its keys, not a megabyte each


def test_a_null_date_batch_inserts_once(spark, scratch):
    cfg = config(scratch, "nulls")
    files = [(f"odd name {i}", i, None) for i in range(20)]
    assert ingest(spark, cfg, files)["inserted"] == 20
    again = ingest(spark, cfg, files + [("another", 0, None)])
    assert (again["inserted"], again["already_registered"]) == (1, 20)
    schema = ControlTables(spark, cfg.tables_root).read("audit").schema
    assert isinstance(schema["dt_ref"].dataType, T.DateType)
    assert ControlTables(spark, cfg.tables_root).read("audit").where(F.col("event_type") == "FILE_REGISTERED").count() == 21
