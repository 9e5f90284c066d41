import base64
import hashlib

import numpy as np
import pyarrow as pa
from filegate.llm.syncmers import (
    _least, _rolling, anchors, compare_edited, fingerprint_column, fingerprint_documents, match_positions, with_next,
)
from filegate.llm.text import mix

from llm_texts import prose


def plain_anchors(data, k, s):
    code = lambda part: int(mix(_rolling(np.array(list(part), dtype=np.uint64) + np.uint64(1), len(part)))[0])
    out = []
    for i in range(len(data) - k + 1):
        inner = [code(data[i + j:i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, code(data[i:i + k])))
    return out


def test_anchors_are_the_closed_syncmers_and_never_far_apart():
    data = prose(60, 4).encode()
    for k, s in ((24, 9), (12, 4), (9, 8)):
        at, hashes = anchors(np.frombuffer(data, np.uint8), np.array([0, len(data)]), k, s)
        assert list(zip(at.tolist(), hashes.tolist(), strict=True)) == plain_anchors(data, k, s)
        assert np.diff(at).max() <= k - s
    assert _least(np.array([5, 3, 9, 1, 7]), 3).tolist() == [3, 1, 1]


def test_batches_do_not_matter_and_positions_match():
    texts = [prose(n, n) for n in (1, 5, 40, 400)] + ["", None, "ab", "a" * 300]
    together = fingerprint_column(pa.array(texts, pa.string()))
    assert together == [fingerprint_column(pa.array([t], pa.string()))[0] for t in texts]
    assert together[4] == together[5] == "" and len(set(together)) == len(texts) - 1
    moved = fingerprint_column(pa.array(["new start " + texts[3]]))[0]
    pairs = match_positions(together[3], moved)
    assert len(pairs) > 50 and all(b - a == 10 for a, b in pairs)
    assert all(len(f) % 8 == 0 and base64.b64decode(f) is not None for f in together)


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    texts = [(r[1] or "") for r in order]
    out = []
    for i, t in enumerate(texts):
        following, cut = texts[(i + 1) % len(texts)], len(t) // 4
        edited = t[:len(t) - cut] + following[:cut]
        out.append((order[i][0], t, edited, following))
    return out


def test_edited_texts(odd, no_docs):
    want = expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    got = compare_edited(odd).collect()
    assert sorted(repr((r["doc_id"], r["n_chars"], r["edited_sha256"])) for r in got) == sorted(
        repr((i, len(t), hashlib.sha256(e.encode()).hexdigest())) for i, t, e, _ in want)
    own = dict(zip([w[2] for w in want], fingerprint_column(pa.array([w[2] for w in want])), strict=True))
    by_hash = {hashlib.sha256(e.encode()).hexdigest(): f for e, f in own.items()}
    assert all(r["edited_fingerprint"] == by_hash[r["edited_sha256"]] for r in got)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert {r["fingerprint"] for r in fingerprint_documents(odd).collect()} == {r["fingerprint"] for r in got}
    long = [r for r in got if r["doc_id"] == 13]
    assert 0.8 < long[0]["near_edited"] < 0.9
    assert compare_edited(no_docs).collect() == []


def test_next_rows_over_many_buckets(spark, monkeypatch):
    from filegate.llm import syncmers

    monkeypatch.setattr(syncmers, "SPLITS", 16)
    ids = [i * i * (-1 if i % 3 == 0 else 1) for i in range(500)]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r["id"]: r["next_text"] for r in with_next(docs, "doc_id", "text").collect()}
    order = sorted(set(ids))
    assert got == {i: f"t{order[(p + 1) % len(order)]}" for p, i in enumerate(order)}
    alone = with_next(docs.limit(1), "doc_id", "text").collect()
    assert alone[0]["text"] == alone[0]["next_text"]
