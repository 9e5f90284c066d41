"""Brute-force checks on small random inputs: de-duplication and the group fold."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from filegate.functions.rules import timestamp_literal
from filegate.operators import groups, register

T0 = dt.datetime(2026, 4, 14, 10, 0)
GROUPS = ["S|a|2026-04-14", "S|b|2026-04-14", "T|a|2026-04-15"]

event = st.tuples(
    st.sampled_from(GROUPS),
    st.booleans(),                          # is_manifest
    st.integers(min_value=1, max_value=4),  # part number or announced count
    st.integers(min_value=0, max_value=5),  # arrival minute
    st.integers(min_value=0, max_value=3),  # copy id (path)
)


def _rows(raw):
    rows = []
    for g, manifest, n, minute, copy in raw:
        key = f"{g}|{'MANIFEST' if manifest else 'PART'}|{n}"
        rows.append(dict(file_business_key=key, group_key=g, is_manifest=manifest,
                         part_number=None if manifest else n, expected_parts=n if manifest else None,
                         arrived_at=T0 + dt.timedelta(minutes=minute),
                         source_modification_time=T0 + dt.timedelta(minutes=minute),
                         file_path=f"/l/{copy}/{key}", parse_error=None))
    return rows


SCHEMA = ("file_business_key string, group_key string, is_manifest boolean, part_number int, expected_parts int, "
          "arrived_at timestamp, source_modification_time timestamp, file_path string, parse_error string")
COLS = SCHEMA.replace(",", "").split()[::2]


@settings(max_examples=15, deadline=None)
@given(st.lists(event, min_size=1, max_size=25))
def test_dedupe_and_fold_match_brute_force(spark, raw):
    rows = _rows(raw)
    df = spark.createDataFrame([tuple(r[c] for c in COLS) for r in rows], SCHEMA)

    survivors = {}
    for r in rows:
        k = r["file_business_key"]
        best = survivors.get(k)
        if best is None or (r["arrived_at"], r["file_path"]) < (best["arrived_at"], best["file_path"]):
            survivors[k] = r
    got = {r.file_business_key: (r.arrived_at, r.file_path, r.n_copies)
           for r in register.dedupe_by_key(df, copies=True).collect()}
    want = {k: (v["arrived_at"], v["file_path"], sum(1 for r in rows if r["file_business_key"] == k))
            for k, v in survivors.items()}
    assert got == want

    deduped = register.dedupe_by_key(df)
    agg = {r.group_key: r for r in
           groups.aggregate_groups(deduped, 30, timestamp_literal("2026-04-14 12:00:00")).collect()}
    for g in {r["group_key"] for r in rows}:
        mine = [v for v in survivors.values() if v["group_key"] == g]
        manifests = sorted((v["arrived_at"], v["file_business_key"], v["expected_parts"])
                           for v in mine if v["is_manifest"])
        row = agg[g]
        assert row.first_seen_at == min(v["arrived_at"] for v in mine)
        assert row.last_seen_at == max(v["arrived_at"] for v in mine)
        assert row.received_parts == len({v["part_number"] for v in mine if not v["is_manifest"]})
        assert row.manifest_expected_parts == (manifests[0][2] if manifests else None)
        values = sorted({m[2] for m in manifests})
        assert row.manifest_distinct_count == len(values)
        assert (list(row.manifest_expected_values) if row.manifest_expected_values is not None else []) == values
        assert row.expires_at == row.first_seen_at + dt.timedelta(minutes=30)
