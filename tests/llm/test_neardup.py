import random
import re
from collections import defaultdict

import pytest
from filegate.llm import neardup
from filegate.llm.neardup import component_report, drop_near_duplicates, near_duplicates
from llm_texts import prose


def shingles(text, width):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            where[x].add(i)
    for i, s in sets.items():
        for j in {j for x in s for j in where[x] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
    return " ".join(words)


def corpus():
    rng = random.Random(11)
    texts = []
    for base in range(40):
        words = prose(rng.randrange(20, 300), base).split()
        texts += [edited(words, rng, rng.randrange(0, 12)) for _ in range(rng.randrange(1, 6))]
    hot = prose(150, 999).split()
    texts += [edited(hot, rng, rng.randrange(0, 5)) for _ in range(120)]
    texts += [" ".join(hot)] * 30 + ["common passage of the corpus " * 4 + prose(30, 5000 + i) for i in range(60)]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("group", [64, 6])
def test_components_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(neardup, "GROUP", group)
    monkeypatch.setattr(neardup, "FIRST_PAIRS", 1)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((3, 85), (5, 80)) if group == 64 else ((3, 85),):
        got = component_report(docs, width=width, percent=percent)
        assert sorted(map(tuple, got.collect())) == brute(rows, width, percent)


def test_odd_rows(odd, no_docs):
    found = near_duplicates(odd, width=3, percent=85)
    assert found.count() == odd.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()}
    rows = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    want = {(i, n, c) for i, n, c, _ in brute(list(rows.items()), 3, 85)}
    assert {g for g in got if g[0] is not None} == want
    kept = drop_near_duplicates(odd, width=3, percent=85)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted(i for i, _, c in want if i == c)  # repeated rows: one stays
    assert component_report(no_docs).collect() == [] and drop_near_duplicates(no_docs).collect() == []


def template_texts(n, own, pairs, seed):
    """Texts of one template and ``own`` words each, the first ``pairs`` of them with a near copy."""
    rng = random.Random(seed)
    template = prose(120, seed).split()
    texts = [[*template, *(f"own{i}x{rng.randrange(10 ** 6)}" for _ in range(own))] for i in range(n)]
    copies = []
    for words in texts[:pairs]:
        cut = rng.randrange(6, 12)
        copies.append([*words[:-cut], *(f"end{rng.randrange(10 ** 6)}" for _ in range(cut))])
    rows = [" ".join(w) for w in texts + copies]
    rng.shuffle(rows)
    return list(enumerate(rows, 1))


def test_groups_are_bounded_where_texts_share_a_template(spark, monkeypatch):
    sizes = []
    real = neardup.links_within

    def counted(grouped, percent, count):
        sizes.append(grouped.groupBy("g").count().agg({"count": "max"}).collect()[0][0] or 0)
        return real(grouped, percent, count)

    monkeypatch.setattr(neardup, "GROUP", 8)
    monkeypatch.setattr(neardup, "FIRST_PAIRS", 0)  # every group with a pair goes on to the second round
    monkeypatch.setattr(neardup, "links_within", counted)
    rows = template_texts(400, 25, 20, 3)
    got = component_report(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 85)
    assert sizes and max(sizes) <= 5 * neardup.GROUP


def test_sweep_groups_bring_all_similar_sets_together(spark, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP", 8)
    rng = random.Random(4)
    sets = []
    for i in range(150):  # no shingle is rare, so that keys are shared by many
        s = set(rng.sample(range(60), 20)) if i % 3 or not sets else set(sets[-1]) ^ {rng.randrange(60)}
        sets.append(s)
    import numpy as np
    rows = [(i, i if i >= 60 else 0, np.array(sorted(s), dtype=np.uint64).tobytes()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "cid long, label long, shingles binary")
    groups = defaultdict(set)
    for r in neardup.sweep_groups(df, 80).collect():
        groups[r["g"]].add(r["cid"])
    meet = {(a, b) for g in groups.values() for a in g for b in g}
    want = {(a, b) for a in range(150) for b in range(a) if b >= 60 or a >= 60
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert want and want <= meet
    assert max(map(len, groups.values())) <= 5 * neardup.GROUP


def test_pairs_in_different_blocks_of_a_region_are_found(spark, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP", 6)  # no group overflows FIRST_PAIRS
    rows = template_texts(600, 14, 60, 5)
    got = component_report(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 85)


def test_sets_that_share_only_a_template_make_no_groups(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(neardup, "GROUP", 8)
    # 82 of 100 shingles in common (0.69): the own ones are rarer and fill what a similar set of no smaller size may lack
    sets = [[*range(1000, 1082), *range(10_000 + 18 * i, 10_018 + 18 * i)] for i in range(200)]
    rows = [(i, i, np.array(s, dtype=np.uint64).tobytes()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "cid long, label long, shingles binary")
    assert neardup.sweep_groups(df, 80).count() == 0


def test_sweep_groups_bring_similar_sets_of_any_size_together(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(neardup, "GROUP", 4)
    rng = random.Random(8)
    sets = [set(rng.sample(range(40), rng.randrange(10, 31))) for _ in range(60)]
    for i in range(120):  # sets with some shingles fewer or more than another
        s = sets[rng.randrange(60)]
        sets.append(s | set(rng.sample(range(40), 4)) if i % 2 else set(rng.sample(sorted(s), max(8, len(s) - 3))))
    label = [rng.choice((0, 0, i)) for i in range(180)]
    for percent in (80, 85):
        rows = [(i, label[i], np.array(sorted(s), dtype=np.uint64).tobytes()) for i, s in enumerate(sets)]
        groups = defaultdict(set)
        for r in neardup.sweep_groups(spark.createDataFrame(rows, "cid long, label long, shingles binary"), percent).collect():
            groups[r["g"]].add(r["cid"])
        meet = {(a, b) for g in groups.values() for a in g for b in g}
        want = {(a, b) for a in range(180) for b in range(a) if label[a] != label[b]
                and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
        assert want and want <= meet


def near_copy_sets(mains, others, seed):
    """Sets of one base: ``mains`` of label 0 with few own shingles, ``others`` of own labels with a few too many."""
    rng = random.Random(seed)
    sets = []
    for i in range(mains + others):
        own = rng.randrange(0, 9) if i < mains else rng.randrange(16, 23)
        n = rng.randrange(140, 151)
        sets.append({*rng.sample(range(1000, 1000 + n), n - own), *range(10_000 + 40 * i, 10_000 + 40 * i + own)})
    for i in range(mains, mains + 20):  # and some that do have a partner
        sets.append(set(sorted(sets[i])[:-8]) | set(range(90_000 + 40 * i, 90_003 + 40 * i)))
    return sets, [0] * mains + list(range(1, others + 21))


def test_near_copies_of_one_text_that_cannot_be_similar_do_not_meet(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(neardup, "GROUP", 16)
    each = {}
    for times in (1, 2):
        sets, label = near_copy_sets(300 * times, 100 * times, 6)
        rows = [(i, label[i], np.array(sorted(s), dtype=np.uint64).tobytes()) for i, s in enumerate(sets)]
        groups = defaultdict(set)
        found = neardup.sweep_groups(spark.createDataFrame(rows, "cid long, label long, shingles binary"), 85).collect()
        for r in found:
            groups[r["g"]].add(r["cid"])
        meet = {(a, b) for g in groups.values() for a in g for b in g}
        want = {(a, b) for a in range(len(sets)) for b in range(a) if label[a] != label[b]
                and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
        assert want and want <= meet
        each[times] = len(found) / len(sets)
    assert max(each.values()) < 10 and each[2] < 1.5 * each[1]  # rows grow with the sets, not with their square
