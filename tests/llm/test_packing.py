import random
from collections import defaultdict

from filegate.llm.packing import Cell, pack, pack_cell


def test_a_bin_is_the_tightest_compatible_one():
    rng = random.Random(3)
    cell, bins = Cell(100), []
    for _ in range(600):
        length, source, cluster = rng.randrange(0, 100), 1 << rng.randrange(6), rng.choice([0, 0, 1, 2, 4])
        fits = [(100 - sum(x[0] for x in b), i) for i, b in enumerate(bins)
                if 100 - sum(x[0] for x in b) >= length and not any(x[1] == source or x[2] & cluster for x in b)]
        b, slot, before = cell.place(length, source, cluster)
        if fits:
            assert b == min(fits)[1]
        else:
            assert b == len(bins)
            bins.append([])
        assert (slot, before) == (len(bins[b]), sum(x[0] for x in bins[b]))
        bins[b].append((length, source, cluster))


def test_pieces_cover_each_row_once():
    rng = random.Random(4)
    rows = [(rng.choice([0, 5, 64, 65, 200, 640]), rng.choice([None, "a", "b"]), rng.randrange(30)) for _ in range(300)]
    out = pack_cell(rows, 64)
    pieces, bins = defaultdict(list), defaultdict(list)
    for i, piece, start, length, b, slot in out:
        pieces[i].append((start, length, piece))
        bins[b].append((slot, length, i))
    for i, (length, _, _) in enumerate(rows):
        assert sum(n for _, n, _ in pieces[i]) == length
        assert [s for s, _, _ in sorted(pieces[i])] == [64 * k for k in range(len(pieces[i]))]
    for members in bins.values():
        assert sorted(s for s, _, _ in members) == list(range(len(members)))
        assert sum(n for _, n, _ in members) <= 64
        sources = [rows[i][1] for _, _, i in members if rows[i][1] is not None]
        clusters = [rows[i][2] for _, _, i in members]
        assert len(set(sources)) == len(sources) and len(set(clusters)) == len(clusters)


def test_table(spark, odd, no_docs):
    for capacity, cell_rows in ((1024, 4096), (16, 5)):
        got = pack(odd, capacity=capacity, cell_rows=cell_rows).collect()
        words = defaultdict(int)
        for r in odd.collect():
            words[r["doc_id"]] += len((r["text"] or "").encode().split())
        total, bins = defaultdict(int), defaultdict(int)
        for r in got:
            total[r["doc_id"]] += r["n_words"]
            bins[r["bin"]] += r["n_words"]
        assert total == words and max(bins.values()) <= capacity
        assert len({(r["bin"], r["slot"]) for r in got}) == len(got)
    assert pack(no_docs).collect() == []


def test_copies_and_sources_part_over_cells(spark):
    docs = spark.createDataFrame([(i, "Equal  words here" if i % 3 else f"text {i}", f"s{i % 40}") for i in range(600)],
                                 "doc_id long, text string, source string")
    by_bin = defaultdict(list)
    for r in pack(docs, capacity=30, cell_rows=100).collect():
        by_bin[r["bin"]].append(r["doc_id"])
    for ids in by_bin.values():
        assert sum(i % 3 != 0 for i in ids) <= 1 and len({i % 40 for i in ids}) == len(ids)
