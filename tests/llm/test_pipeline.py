import os

import corpus_pipeline
import pytest
from filegate.llm.contamination import contamination
from filegate.llm.neardup import near_duplicates
from filegate.llm.staging import stage, table


def test_stages_are_those_of_the_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "decontamination",
                                                      "packing"]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, odd, labels, scratch, empty):
    root = os.path.join(scratch, "tables")
    (odd.limit(0) if empty else odd).write.parquet(f"{root}/documents.parquet")
    labels.write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string").write.parquet(
        f"{root}/benchmark.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, root), "test-pipeline")
        if name != "packing":
            assert out.columns == docs.columns and out.exceptAll(docs).count() == 0
        assert out.count() == 0 or not empty
        docs = out


def test_each_stage_on_its_own_input(spark):
    root = "/root/testdata/sf0.01"
    docs = table(spark, root, "documents")
    labels = table(spark, root, "labels")
    stages = dict(corpus_pipeline.STAGES)
    clean = stage(stages["toxicity"](spark, docs, root), "test")
    kept = clean.join(labels, "doc_id").groupBy("toxic").count().rdd.collectAsMap()
    total = labels.groupBy("toxic").count().rdd.collectAsMap()
    assert kept[0] > 0.97 * total[0] and kept.get(1, 0) < 0.35 * total[1]
    good = stage(stages["quality"](spark, docs, root), "test")
    kept = good.join(labels, "doc_id").groupBy("quality").count().rdd.collectAsMap()
    total = labels.groupBy("quality").count().rdd.collectAsMap()
    assert kept[1] > 0.97 * total[1] and kept.get(0, 0) < 0.3 * total[0]
    found = near_duplicates(docs)
    single = stages["near_duplicates"](spark, docs, root)
    assert {r[0] for r in single.select("doc_id").collect()} == {
        r[0] for r in found.filter("component_id = doc_id").select("doc_id").collect()}
    verdict = contamination(docs, table(spark, root, "benchmark"))
    assert {r[0] for r in stages["decontamination"](spark, docs, root).select("doc_id").collect()} == {
        r[0] for r in verdict.filter("not contaminated").select("doc_id").collect()}
    assert verdict.filter("contaminated").count() > 0


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.groupBy("bin").sum("n_words").agg({"sum(n_words)": "max"}).collect()[0][0] <= 1024
    assert 0 < out.select("doc_id").distinct().count() < 200
