import hashlib
import re

import numpy as np
from filegate.llm.fillmiddle import BLOCK, BlockTree, fill_in_middle, fill_report, restored
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(doc_id, text, plain_from=90, spm_below=20):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain_from:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_below:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows_against_brute_force(odd, no_docs):
    got = fill_in_middle(odd)
    rows = got.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    texts = odd.select("doc_id", "text").collect()
    assert sorted(map(repr, [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows])) == sorted(
        map(repr, [(t.doc_id, *expected(t.doc_id, t.text)) for t in texts]))
    assert sorted(r.back for r in rows) == sorted(t.text or "" for t in texts)
    assert fill_report(no_docs).collect() == []


def test_texts_with_pieces_of_markers_come_back(spark):
    pieces = ["<", ">", "<S", "P>", "<M", "<<S", "é<", "a<P", "S><", "🙂<", "<S>", "x<P>y", "<M>"]
    rows = [(i, (pieces[i % 13] + " word ") * (i % 7) + pieces[i % 13]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fill_report(docs).collect()}
    for doc_id, text in rows:
        n, form, prefix, middle, output = expected(doc_id, text)
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(text))
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


def test_long_texts_over_many_blocks_and_segments(spark):
    """Texts beyond a megabyte, with letter runs and code points across block and segment borders."""
    rows = [(1, "añ🙂b " * 250_000), (2, "x" * 2_500_000), (3, "é" * 700_000), (4, "ab, cd. " * 200_000), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fill_report(docs, plain_from=100).collect()}
    for doc_id, text in rows:
        n, form, prefix, middle, output = expected(doc_id, text, plain_from=100)
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(text))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAZ .,\né🙂日", max_size=40), st.integers(0, 30))
def test_every_cut_of_a_text(text, repeat):
    text *= repeat
    raw = text.encode()
    data = np.frombuffer(b"before" + raw + b"after", dtype=np.uint8)
    tree = BlockTree(data, 6, 6 + len(raw))
    units = UNITS.findall(text)
    assert (tree.n_units, tree.n_points) == (len(units), len(text))
    at = points = 0
    for k, unit in enumerate([*units, ""]):
        if k % 7 == 0 or at % BLOCK < 4 or k == len(units):
            assert tree.cut(k) == (6 + at, points)
        at, points = at + len(unit.encode()), points + len(unit)
