import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from filegate.llm.merkle import Appender, leaf_rows, manifest, tamper_report
from pyspark.sql import functions as F

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    values = [row[f] for f in FIELDS]
    if lower and values[4] is not None:
        values[4] = values[4].translate({c: c + 32 for c in range(65, 91)})
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    """(place, siblings) of node ``i`` from below."""
    out = []
    for level in tree[:-1]:
        run, place = level[i // 16 * 16:i // 16 * 16 + 16], i % 16
        out.append((place, run[:place] + run[place + 1:]))
        i //= 16
    return out


def fold(h, steps):
    for place, siblings in steps:
        h = sha("".join([*siblings[:place], h, *siblings[place:]]))
    return h


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    for g, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = path(trees[s], i) + path(top, g)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            got = fold(leaf(r, lower=hit), steps)
            yield (r["doc_id"], leaf(r), trees[s][-1][0], top[-1][0], sha("".join(x for _, xs in steps for x in xs)), got,
                   got == top[-1][0])


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def check(docs):
    got = [tuple(r[c] for c in COLUMNS) for r in tamper_report(docs).collect()]
    want = list(brute([r.asDict() for r in docs.select(*FIELDS).collect()]))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


def test_odd_rows_against_brute_force(odd, no_docs):
    rows = check(odd)
    assert len({r[3] for r in rows}) == 1 and {r[6] for r in rows} == {True, False}
    assert tamper_report(no_docs).collect() == []


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_around_full_runs(spark, n):
    docs = spark.createDataFrame([(i, f"Text {i}", None, "one", i) for i in range(n)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    check(docs)


def test_many_blocks_and_many_sources(spark):
    """A source of more than two blocks (two rounds), one of exactly one block, equal ids, and 300 small sources."""
    rows = [(i, f"A {i % 3000}", "en", "hot", i % 7) for i in range(9000)]
    rows += [(i // 2, "B same", None, "full", 1) for i in range(4096)]
    rows += [(i, f"C {i}", "de", f"s{i % 300}" if i % 301 else None, None) for i in range(1500)]
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check(docs.repartition(7))


def test_witnesses_are_texts_that_give_the_root(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in manifest(leaf_rows(docs)).collect():
        h = r.digest
        for w in r.witness:
            h = sha(w.siblings[:64 * w.place] + h + w.siblings[64 * w.place:])
        assert h == r.root and r.total == 134 - (r.tree != "ss0") and 0 <= r.pos < r.total


def test_appends_extend_the_witnesses_of_open_subtrees():
    nodes, grown = [sha(str(i)) for i in range(300)], Appender()
    for i, node in enumerate(nodes):
        grown.append(node)
        done = i + 1
        # a witness has one step per closed run above it
        assert len(grown.witness[0]) == (done >= 16) + (done >= 256)
        assert grown.witness[i] == [] or done % 16 == 0
    assert grown.finish() == levels(nodes)[-1][0]
    for i in (0, 15, 16, 255, 256, 299):
        assert [(p, s) for p, s in grown.witness[i]] == [(p, "".join(s)) for p, s in path(levels(nodes), i)]


def test_a_changed_field_changes_the_leaf(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    leaves = {leaf_rows(d).first().digest for d in (
        docs, docs.withColumn("text", F.lit(None).cast("string")), docs.withColumn("text", F.lit("-")),
        docs.withColumn("lang", F.lit("e")).withColumn("source", F.lit("ns")), docs.withColumn("n_chars", F.lit(31)))}
    assert len(leaves) == 5
