import hashlib
import re

from filegate.llm.contamination import contamination, drop_contaminated, remove_spans


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(repr, out))


def test_both_ways_equal_brute_force(spark, odd, no_docs):
    text = {r["doc_id"]: r["text"] for r in odd.collect()}
    items = [(1, "one two three"), (2, " ".join(words(text[13])[100:140])), (3, None), (4, ""), (5, "!!"),
             (12, " ".join(words(text[14])[5:18])), (None, "x"), (7, "Ünïcode"), (7, "same same same")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()], items)
    assert any("True" in w for w in want)
    for bound in (200_000, 3):
        got = contamination(odd, bench, broadcast_windows=bound)
        assert sorted(repr(tuple(r)) for r in got.collect()) == want
        kept = drop_contaminated(odd, bench, broadcast_windows=bound)
        assert kept.columns == odd.columns
        assert kept.count() == sum("False)" in w for w in want)
    assert contamination(no_docs, bench).collect() == []
    clean = contamination(odd, bench.limit(0))
    assert clean.filter("contaminated or n_hit > 0").count() == 0 and clean.count() == odd.count()


def test_spans_are_removed(spark):
    docs = spark.createDataFrame([(1, "Before, One two; THREE after"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in remove_spans(docs, bench).collect()}
    assert got == {1: "Before,  after", 2: None}


def test_items_without_id_count(spark):
    docs = spark.createDataFrame([(1, "a one two three"), (2, "one two three four"), (3, "other")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one two three"), (None, "two three"), (7, "three four")],
                                  "item_id long, text string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for bound in (200_000, 1):  # as the SQL says: null ids are one distinct item, and not in the digest
        got = contamination(docs, bench, broadcast_windows=bound)
        assert sorted(map(tuple, got.collect())) == [
            (1, 4, 3, 1, sha(""), True), (2, 4, 4, 2, sha("7"), True), (3, 1, 0, 0, sha(""), False)]
        assert [r["doc_id"] for r in drop_contaminated(docs, bench, broadcast_windows=bound).collect()] == [3]
