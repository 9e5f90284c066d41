"""A year of the sf0.001 landing as real files, run twice through the three jobs, against the oracle's tables."""

import datetime as dt
import os

import duckdb
import pytest

from filegate.plans import oracle
from filegate.plans.jobs import FilegateConfig, run_dispatch, run_evaluate, run_ingest
from filegate.plans.scenario import NOW1, NOW2, SPLIT_MINUTE
from filegate.sources.tables import ControlTables

SF = "/root/testdata/sf0.001"


def _write(folder, rows):
    for path, mtime, _, content in rows:
        target = folder + path.removeprefix("file:/landing")
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "w") as f:
            f.write(content or "")
        ns = (mtime - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1) * 1_000_000
        os.utime(target, ns=(ns, ns))


def test_jobs_reach_the_oracle_tables(spark, scratch):
    if not os.path.exists(f"{SF}/orders.parquet"):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    # one year of orders: about 365 dates, so that the folders of the partitioned tables stay few
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF}/orders.parquet' WHERE year(o_orderdate) = 1995")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF}/lineitem.parquet'")
    # the file listing has milliseconds
    con.execute(f"CREATE VIEW events AS SELECT * REPLACE (date_trunc('millisecond', ts) AS ts) "
                f"FROM '{SF}/events.parquet'")
    chain = oracle._chain()
    rows = con.execute(f"{chain} SELECT path, mtime, length, content FROM landing").fetchall()
    landing = os.path.join(scratch, "landing")
    cfg = FilegateConfig(tables_root=f"file:{scratch}/tables", landing=landing, arrival="modification",
                         dispatch_batch_limit=None)
    later = os.path.join(scratch, "later")
    for folder, now, early in ((landing, NOW1, True), (later, NOW2, False)):
        _write(folder, [r for r in rows if (r[1].minute < SPLIT_MINUTE) == early])
        run = FilegateConfig(**{**cfg.__dict__, "landing": folder})
        run_ingest(spark, run, now=now)
        run_evaluate(spark, run, now=now)
        run_dispatch(spark, run, now=now)
    store = ControlTables(spark, cfg.tables_root)

    def same(table, columns, sql_table):
        want = con.execute(f"{chain} SELECT {columns} FROM {sql_table}").fetchall()
        got = [tuple(r) for r in store.read(table).selectExpr(*columns.split(", ")).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want)), table

    same("file_events", "file_business_key, file_name, system_name, table_name, dt_ref, part_number, is_manifest, "
                        "expected_parts, group_key, arrived_at, ingested_at, parse_error", "fe2")
    same("groups", oracle.G_COLS, "d2_final")
    same("dispatch", oracle.D_COLS, "d2_table")
    same("audit", "audit_id, event_type, group_key, file_business_key, event_ts, severity, dt_ref", "audit_table")
