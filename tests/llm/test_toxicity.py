import random

import numpy as np
import pyarrow as pa
from filegate.llm import toxicity as tox
from filegate.llm.staging import table
from filegate.llm.text import PUNCTUATION, word_slices
from llm_texts import prose


def scores(model, texts):
    return np.concatenate([model.scores(w) for _, _, w in word_slices(pa.array(texts, pa.string()), PUNCTUATION)])


def test_neutral_mentions_score_lower_with_the_penalty(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = prose(30, i).split()
        if toxic and rng.random() < 0.7:
            words.insert(rng.randrange(30), "vileword")
        # the label goes with the mention of one group by the choice of the rows alone
        if rng.random() < (0.8 if toxic else 0.05):
            words.insert(rng.randrange(30), "muslim")
        elif rng.random() < 0.3:
            words.insert(rng.randrange(30), "christian")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [prose(30, 9000 + i) + " the muslim neighbour" for i in range(100)]
    swapped = [t.replace("muslim", "christian") for t in neutral]
    plain = tox.train(docs, marks, penalty=0.0)
    fair = tox.train(docs, marks, penalty=20.0)
    before = scores(plain, neutral) - scores(plain, swapped)
    after = scores(fair, neutral) - scores(fair, swapped)
    assert np.abs(after).mean() < 0.5 * np.abs(before).mean()
    assert (scores(fair, neutral) >= 0.5).mean() <= (scores(plain, neutral) >= 0.5).mean()
    assert (scores(fair, ["a vileword here", "a word here"]) > [0.5, -1]).all()


def test_odd_rows(odd, no_docs, labels, no_labels):
    for marks in (labels, no_labels):
        got = tox.toxicity(odd, marks).collect()
        assert len(got) == odd.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["predicted"] == 0 for r in got)
    kept = tox.drop_toxic(odd, no_labels)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert tox.toxicity(no_docs, labels).collect() == []


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    marks = table(spark, sf_dir, "labels")
    got = tox.toxicity(table(spark, sf_dir, "documents"), marks).filter("held_out").join(marks, "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in got) / len(got)
    alarms = sum(r["predicted"] for r in got if not r["toxic"]) / sum(not r["toxic"] for r in got)
    found = sum(r["predicted"] for r in got if r["toxic"]) / sum(r["toxic"] for r in got)
    assert right > 0.93 and alarms < 0.03 and found > 0.5


def test_labels_of_the_held_out_fold_do_not_matter(spark, odd, labels):
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(string(doc_id)) % 3 = 1 THEN 1 - toxic "
                                                     "ELSE toxic END AS toxic")
    as_rows = lambda df: sorted(map(repr, df.collect()))
    assert as_rows(tox.toxicity(odd, labels)) == as_rows(tox.toxicity(odd, flipped))


def test_many_rows_of_one_labelled_id_are_one_training_row(spark):
    docs = spark.range(3000).selectExpr("if(id < 2900, 0, id) as doc_id", "concat('text number ', id % 7, ' here') as text")
    marks = spark.range(3000).selectExpr("id as doc_id", "int(id % 2) as toxic")
    sample = tox.labelled_sample(marks, "doc_id", "toxic", 5000)
    rows = tox._training_rows(docs, sample, "doc_id", "text", tox.IDENTITY_TERMS).count()
    assert rows == 101  # id 0 once, and 100 others


def test_the_shipped_penalty_moves_scores_of_swapped_terms(spark):
    """French texts: a group's name goes with the label, and the default penalty weakens what it adds to a score."""
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        named = "musulman" if toxic and i % 2 else "chrétien" if i % 5 == 0 else ""
        rows.append((i, f"{prose(20, i)} {'injurieux' if toxic and i % 4 else ''} le {named} voisin"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [prose(20, 7000 + i) + " le musulman voisin" for i in range(60)]
    swapped = [t.replace("musulman", "chrétien") for t in neutral]
    gap = {p: np.abs(scores(tox.train(docs, marks, penalty=p), neutral) - scores(tox.train(docs, marks, penalty=p), swapped)).mean()
           for p in (0.0, tox.COUNTERFACTUAL)}
    assert gap[tox.COUNTERFACTUAL] < gap[0.0]
