import zlib
from collections import Counter, defaultdict

import pytest
from filegate.llm.kdtree import kd_shards
from pyspark.sql import functions as F


def checked(df, docs, shards):
    rows, texts = df.collect(), docs.select("doc_id", "text").collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_odd_rows(odd, no_docs):
    checked(kd_shards(odd, [F.col("n_chars"), "lang", "source", "doc_id"], shards=16), odd, 16)
    assert kd_shards(no_docs, ["n_chars", "lang"], shards=4).collect() == []


@pytest.mark.parametrize("hot", [0, 700])
def test_sizes_are_near_equal_and_small_groups_stay_whole(spark, hot):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < hot, F.lit("copy " * 30)).otherwise(
            F.repeat(F.concat((F.col("id") % 997).cast("string"), F.lit(" ")), (F.col("id") % 37 + 5).cast("int"))
        ).alias("text"), (F.col("id") % 3).cast("string").alias("lang"))
    rows = checked(kd_shards(docs, ["doc_id", "lang"], shards=8), docs, 8)
    size = Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
    total = sum(size.values())
    assert len(size) == 8 and max(size.values()) < 1.08 * total / 8 and min(size.values()) > 0.92 * total / 8


def test_equal_texts_share_a_shard_when_they_weigh_little(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("text "), (F.col("id") % 2000).cast("string")).alias("text"))
    rows = kd_shards(docs, [F.lit(1.0)], shards=16).collect()
    where = defaultdict(set)
    for r in rows:
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_target_bytes_give_the_leaves(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 99).alias("text"))
    rows = kd_shards(docs, ["doc_id"], target_bytes=7000).collect()
    size = Counter(r["shard"] for r in rows)
    assert len(size) == 15 and max(size.values()) <= 70


def test_tree_against_brute_force(spark):
    """Two levels of splits at exact weighted medians along the widest dimension."""
    data = [(i, "w" * (i * 7919 % 50 + 1), float(i * 37 % 101), float(i * 53 % 11)) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, x double, y double")
    got = {r["doc_id"]: r["shard"] for r in kd_shards(docs, ["x", "y"], shards=4).collect()}

    def split(rows, leaves, first):
        if leaves == 1:
            return {r[0]: first for r in rows}
        wide = [(max(r[d] for r in rows) - min(r[d] for r in rows)) / (100 if d == 2 else 10) for d in (2, 3)]
        d = 2 if wide[0] >= wide[1] else 3
        half, total = leaves // 2, sum(len(r[1]) + 1 for r in rows)
        values, run = sorted({r[d] for r in rows}), 0
        for v in values:
            weight = sum(len(r[1]) + 1 for r in rows if r[d] == v)
            if run + weight >= total * half / leaves:
                break
            run += weight
        sure_left = [r for r in rows if r[d] < v]
        tied = [r for r in rows if r[d] == v]
        left = sure_left + [r for r in tied if got[r[0]] < first + half]
        right = [r for r in rows if r not in left]
        assert all(got[r[0]] < first + half for r in sure_left)
        assert all(got[r[0]] >= first + half for r in rows if r[d] > v)
        return split(left, half, first) | split(right, leaves - half, first + half)

    assert split(data, 4, 0) == got
