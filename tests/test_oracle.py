"""Registered queries against their DuckDB statements on the sf0.001 tables.

The full set at sf0.01 runs with ``python tools/check_oracle.py``; this keeps one query
per operator family in the regular suite.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from filegate.plans import catalog, oracle  # noqa: E402
from check_oracle import TABLES, arrow_of, normalise  # noqa: E402

SF = "/root/testdata/sf0.001"
FAMILY = ["parse_landing", "manifest_quality", "file_events", "dedupe_files", "group_aggregate", "manifest_stats",
          "vw_group_status", "changed_groups", "mark_dispatched", "dispatch_payload", "snapshot_chunks", "audit_append",
          "audit_group_events", "file_events_strict"]


@pytest.fixture(scope="module")
def duck():
    if not os.path.exists(f"{SF}/orders.parquet"):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_of_the_engine_has_an_oracle():
    names = set(catalog.registry())
    assert names == set(oracle.statements()) and names <= set(entry.queries())


def test_entry_smoke(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r.status for r in rows} <= {"OPEN", "READY"}


@pytest.mark.parametrize("name", FAMILY)
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toArrow().to_pandas(date_as_object=True, timestamp_as_object=True)
    want = arrow_of(duck.execute(entry.oracle_sql()[name])).to_pandas(date_as_object=True, timestamp_as_object=True)
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert normalise(got).equals(normalise(want))


def test_every_oracle_statement_runs(duck):
    for name, sql in oracle.statements().items():
        rows = arrow_of(duck.execute(sql))
        assert rows.num_columns > 0, name
