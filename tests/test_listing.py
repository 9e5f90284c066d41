"""Listings spread over tasks, and a stream that moves what it has delivered."""

import os

import pytest
from pyspark.sql import functions as F

from filegate.plans.jobs import FilegateConfig, run_ingest
from filegate.sources.landing import read_landing
from filegate.sources.listing import prefixes, read_landing_spread
from filegate.sources.tables import ControlTables
from filegate.streaming.ingest import run_ingest_stream


def put(root, rel, name, content="{}"):
    os.makedirs(os.path.join(root, rel), exist_ok=True)
    with open(os.path.join(root, rel, name), "w") as f:
        f.write(content)


@pytest.fixture()
def landing(scratch):
    root = os.path.join(scratch, "drop zone")
    for i in range(6):
        put(root, f"parts/{i % 3}", f"SISTEMA=ACME|TABELA=t{i % 2}|DT_REF=2031-07-08|PART={i:04d}.json", "x" * i)  # the first one is empty: no file source lists it
    put(root, "manifests", "SISTEMA=ACME|TABELA=t0|DT_REF=2031-07-08|MANIFEST.json", '{"expected_parts": 3}')
    put(root, "manifests/deep/er", "SISTEMA=ACME|TABELA=t1|DT_REF=2031-07-08|MANIFEST%2Ejson", '{"expected_parts": 3}')
    put(root, "", "at the root é.json")
    put(root, "parts", "_hidden.json")
    put(root, "_folder", "hidden too.json")
    put(root, ".dot", "hidden too.json")
    return root


@pytest.mark.parametrize("depth", [0, 1, 3])
@pytest.mark.parametrize("all_content", [False, True])
def test_the_spread_listing_equals_the_file_source(spark, landing, depth, all_content):
    want = sorted(map(repr, read_landing(spark, landing, all_content).collect()))
    for path in (landing, f"file:{landing}"):
        got = read_landing_spread(spark, path, all_content, depth=depth)
        assert sorted(map(repr, got.collect())) == want and len(want) == 8


def test_the_driver_sees_folders_alone(spark, landing):
    found = prefixes(spark, landing, 2)
    assert len(found) < 12 and not any(p.endswith(".json") for p, _ in found)
    assert read_landing_spread(spark, landing + "/nowhere").collect() == []


def test_ingest_with_the_spread_listing(spark, landing, scratch):
    cfg = FilegateConfig(tables_root=f"file:{scratch}/spread", landing=landing, spread_listing=True, arrival="modification")
    out = run_ingest(spark, cfg, now="2031-07-08 10:00:00")
    assert (out["raw_events"], out["parse_errors"]) == (8, 1)


def test_a_stream_moves_delivered_files_and_delivers_nothing_twice(spark, landing, scratch):
    cfg = FilegateConfig(tables_root=f"file:{scratch}/moved", landing=landing, checkpoints_root=f"file:{scratch}/ckpt",
                         archive=f"{scratch}/archive", max_file_age="30d")
    count = lambda root: sum(f.endswith("json") and not f.startswith("_") for _, _, fs in os.walk(root) for f in fs)
    assert run_ingest_stream(spark, cfg, now="2031-07-08 10:00:00", max_files_per_trigger=4)["inserted"] == 8
    put(landing, "late", "SISTEMA=ACME|TABELA=t1|DT_REF=2031-07-08|PART=0100.json")
    again = run_ingest_stream(spark, cfg, now="2031-07-08 10:05:00")
    assert (again["raw_events"], again["inserted"]) == (1, 1)
    assert count(f"{scratch}/archive") > 0  # files of finished batches have left the landing
    run_ingest_stream(spark, cfg, now="2031-07-08 10:10:00")
    events = ControlTables(spark, cfg.tables_root).read("file_events")
    assert events.count() == 9 and events.select("file_business_key").distinct().count() == 9
    assert events.where(F.col("is_manifest")).count() == 2
