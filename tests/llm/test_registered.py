import duckdb
import pytest
from filegate.llm import oracle, queries

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = list(queries.registry())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(oracle.statements()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.registry()))
def test_query_runs_and_equals_its_sql(spark, name):
    got = queries.registry()[name](spark, SF).toArrow()
    assert got.num_rows >= (50 if name.startswith("op4") else 200)
    if name not in oracle.statements():
        return
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(oracle.statements()[name]).fetchall()
    columns = [d[0] for d in con.description]
    assert sorted(got.column_names) == sorted(columns)
    rows = list(zip(*(got[c].to_pylist() for c in columns), strict=True))
    assert sorted(map(repr, rows)) == sorted(map(repr, want))
