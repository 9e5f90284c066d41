import math

import numpy as np
import pyarrow as pa
from filegate.llm import resampling
from filegate.llm.resampling import BUCKETS, best_cut, keep_selected, resample, top_k
from filegate.llm.staging import table
from filegate.llm.text import mix
from pyspark.sql import functions as F


def test_top_k_takes_exactly_k(spark):
    keys = [float(i % 7) for i in range(100)] + [1e-9, -3.5, 6.0]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key double, uid long")
    order = sorted(range(len(keys)), key=lambda i: (-keys[i], i))
    for k in (0, 1, 15, 16, 60, 103, 500):
        got = {r["uid"] for r in rows.filter(top_k(rows, "key", k, "uid")("key", "uid")).collect()}
        assert got == set(order[:k])


def test_noise_is_gumbel_and_depends_on_the_id(spark):
    noise = [r[0] for r in spark.range(4000).select(resampling.gumbel(F.col("id"), 5)).collect()]
    assert abs(np.mean(noise) - 0.5772) < 0.08 and abs(np.var(noise) - math.pi ** 2 / 6) < 0.2
    assert noise == [r[0] for r in spark.range(4000).repartition(3).select("id", resampling.gumbel(
        F.col("id"), 5).alias("g")).orderBy("id").select("g").collect()]


def test_weights_equal_brute_force(spark, odd, labels):
    def grams(text):
        words = (text or "").encode().lower().split()
        column = pa.array([" ".join(w.decode() for w in words)], pa.string())
        return next(resampling.ngram_buckets(w)[0].tolist()
                    for _, _, w in resampling.word_slices(column, resampling.BLANKS)) if words else []

    import zlib

    rows = odd.collect()
    good = {}
    for r in labels.filter("doc_id is not null and quality is not null").collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            good[r["doc_id"]] = max(good.get(r["doc_id"], 0), r["quality"])
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        for b in grams(r["text"]):
            raw[b] += 1
            target[b] += good.get(r["doc_id"]) == 1
    p = (raw + 4) / (raw.sum() + 4 * BUCKETS)
    q = (target + 4 * BUCKETS * p) / (target.sum() + 4 * BUCKETS)
    ratio = np.log(q / p)
    want = sorted(round(sum(ratio[b] for b in grams(r["text"])) / (len(grams(r["text"])) + 20), 9) for r in rows)
    got = sorted(round(r["log_weight"], 9) for r in resample(odd, labels, k=5).collect())
    assert got == want
    assert mix(np.array([1], np.uint64))[0] != 1


def test_selection(odd, no_docs, labels, no_labels):
    for k in (0, 3, 19, 50):
        assert resample(odd, labels, k=k).filter("selected").count() == min(k, odd.count())
    assert resample(odd, no_labels).filter("selected").count() == odd.count()
    kept = keep_selected(odd, labels, k=4)
    assert kept.columns == odd.columns and kept.count() == 4
    assert resample(no_docs, labels).collect() == [] and keep_selected(no_docs, labels).collect() == []


def test_cut():
    assert best_cut(np.array([1.0, 2, 3, 4]), np.array([False, False, True, True])) == 2.5
    assert best_cut(np.array([1.0, 2]), np.array([True, True])) == -np.inf


def test_quality_of_unseen_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = table(spark, sf_dir, "labels")
    seen, unseen = (labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 < 3),
                    labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 3))
    got = resample(table(spark, sf_dir, "documents"), seen).join(unseen, "doc_id").groupBy("quality").agg(
        F.avg(F.col("selected").cast("double"))).collect()
    share = dict(map(tuple, got))
    assert share[1] > 0.95 and share[0] < 0.3


def test_many_rows_of_one_labelled_id_count_once_for_the_cut(spark, monkeypatch):
    docs = spark.range(600).selectExpr("if(id < 500, 1, id) as doc_id", "concat('text number ', id % 7, ' here') as text")
    marks = spark.range(600).selectExpr("id as doc_id", "int(id % 2) as quality")
    seen = []

    def cut(weights, good, real=best_cut):
        seen.append(len(weights))
        return real(weights, good)

    monkeypatch.setattr(resampling, "best_cut", cut)
    assert resample(docs, marks).count() == 600
    assert seen and seen[0] <= 101
