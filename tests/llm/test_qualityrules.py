import random
import re
from collections import Counter
from math import comb

import pytest
from filegate.llm.qualityrules import (COUNTS, DELTA, RISK, RULES, binomial_tail, choose_cutoffs, holdout_counts,
                                       measured, quality_rules)
from llm_texts import prose
from pyspark.sql import functions as F


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    hit = {i + d for i, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(hit))


def failed(c):
    return c[0] < 50 or 100 * c[5] > 50 * c[0]


def share(a, b):
    return a / b if b else 0.0


def values(c):
    return {"symbols": share(c[2], c[1]), "dup_lines": share(c[4], c[3]), "repeats": share(c[5], c[0]),
            "long_words": share(c[1], c[0])}


def tail(n, k, a):
    return sum(comb(n, j) * a ** j * (1 - a) ** (n - j) for j in range(k + 1))


def brute_cutoffs(rows, good, risk, delta):
    """rows: (id, stratum, counts), one per id."""
    held = [(s, values(c)) for i, s, c in rows if i in good and not failed(c)]
    strata, out = {s for s, _ in held}, {}
    for s in strata:
        for r in RULES:
            xs = [v[r.name] for t, v in held if t == s]
            for c in r.cutoffs:
                if tail(len(xs), sum(x > c for x in xs), risk / len(RULES)) > delta / (len(strata) * len(RULES)):
                    break
                out[s, r.name] = c
    return out


def test_odd_rows_against_brute_force(odd, no_docs, labels, no_labels):
    for given in (labels, no_labels):
        rows = quality_rules(odd, given).collect()
        want = sorted((repr(t.doc_id), *[x for i, x in enumerate(counts(t.text)) if i != 3]) for t in odd.collect())
        assert sorted((repr(r.doc_id), *[r[c] for c in COUNTS if c != "n_lines"]) for r in rows) == want
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
        assert all(r.kept == (not r.base_failed and r.failed_rules == "") for r in rows)
    assert quality_rules(no_docs, labels).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_repeated_windows(spark, seed):
    """Small alphabets give windows that overlap, touch and repeat thousands of times."""
    rng = random.Random(seed)
    texts = ["\n".join(" ".join(rng.choice("abcdefghi"[:size]) for _ in range(rng.randrange(1, 40)))
                       for _ in range(rng.randrange(1, 30))) for size in (1, 2, 3, 9) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("x"))
    got = {r.id: tuple(r[c] for c in COUNTS) for r in measured(docs).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_long_text(spark):
    text = prose(200_000, 5)
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    assert tuple(measured(docs).first()[c] for c in COUNTS) == counts(text)


def test_binomial_tails_are_exact(spark):
    cases = [(n, k) for n in (1, 7, 50, 300, 900) for k in range(0, n + 1, max(1, n // 9))]
    df = spark.createDataFrame(cases, "n long, k long").select("n", "k", binomial_tail(F.col("n"), F.col("k"), 0.0125).alias("p"))
    for r in df.collect():
        assert r.p == (1.0 if r.k > r.n * 0.0125 else pytest.approx(tail(r.n, r.k, 0.0125), rel=1e-9))
    far = spark.createDataFrame([(2_000_000, 24_000)], "n long, k long").select(
        binomial_tail(F.col("n"), F.col("k"), 0.0125)).first()[0]
    assert 0 < far < 1e-9  # 6.4 standard deviations; the first terms underflow any float


@pytest.fixture(scope="module")
def labelled(spark):
    """Two strata of good prose, some with symbols; bad documents full of them; few labels in a third stratum."""
    rng = random.Random(7)
    rows, tags = [], []
    for i in range(2600):
        lang = "fr" if i % 2 else "en" if i < 2500 else "rare"
        bad = rng.random() < 0.2
        words = prose(rng.randrange(60, 90), i).split()
        for _ in range(40 if bad else (6 if lang == "fr" and i % 5 == 0 else 0)):
            words.insert(rng.randrange(len(words)), rng.choice("#*$%&|<>") * 3)
        rows.append((i, " ".join(words), lang))
        tags.append((i, int(not bad)))
    tags += [(0, 0), (2, None), (None, 1), (99_999, 1)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame(tags, "doc_id long, quality int"), rows, tags


def test_cutoffs_against_brute_force(labelled):
    docs, labels, rows, tags = labelled
    good = {i for i, q in tags if q} - {i for i, q in tags if q == 0}
    once = [(i, f"s{lang}", counts(t)) for i, t, lang in rows]
    want = brute_cutoffs(once, good, RISK, DELTA)
    got = {(r.stratum, r.rule): r.cutoff for r in choose_cutoffs(holdout_counts(measured(docs), labels)).collect()}
    assert got == want and ("sen", "symbols") in got and not any(s == "srare" for s, _ in got)
    result = quality_rules(docs, labels).collect()
    assert len(result) == len(rows) + 3
    by_id = {r.doc_id: r for r in result}
    for i, s, c in once:
        names = [r.name for r in RULES if values(c)[r.name] > want.get((s, r.name), 1e9)]
        assert by_id[i].failed_rules == ",".join(names) and by_id[i].kept == (not failed(c) and not names)
    rejected = [i for i in by_id if not by_id[i].kept]
    assert len([i for i in rejected if i not in good]) > 100


def test_false_rejection_stays_within_the_risk(spark):
    """Over repeated draws the true share of rejected good documents exceeds the risk at most as often as ``delta``."""
    rng = random.Random(11)
    counts_rows, truth = [], {}
    for draw in range(120):
        xs = [rng.random() * 0.1 for _ in range(800)]
        cut = RULES[0].cutoffs
        truth[f"s{draw}"] = {c: max(0.0, 1 - c / 0.1) for c in cut}
        counts_rows += [(f"s{draw}", "symbols", step, len(xs), sum(x > c for x in xs)) for step, c in enumerate(cut, 1)]
    chosen = choose_cutoffs(spark.createDataFrame(counts_rows, "stratum string, rule string, step int, n long, k long"))
    got = chosen.collect()
    assert len(got) == 120
    assert sum(truth[r.stratum][r.cutoff] > RISK / len(RULES) for r in got) <= DELTA * 120
