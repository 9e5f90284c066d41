import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
from filegate.llm import recurrent as rec
from filegate.llm.staging import table


def small(seed=1):
    net = rec.Network(np.array([5.0, 9, 8, 7, 3, 2, 2, 1, 1, 1]), hidden=4, classes=3, seed=seed)
    rng = np.random.default_rng(seed)
    for name in ("emb", "wx", "wh", "bh", "bx", "wc", "ww"):
        net.views[name][:] = rng.normal(0, 0.5, net.views[name].shape)
    return net


def test_the_output_is_a_distribution():
    net = small()
    states = np.random.default_rng(2).normal(size=(5, 4)).astype(np.float32)
    for s in states:
        logp, _ = net.emit(np.repeat(s[None], 10, axis=0), np.arange(10))
        assert abs(np.exp(logp).sum() - 1) < 1e-5


def test_gradient():
    net = small()
    net.vector = net.vector.astype(np.float64)
    net.views = net._views(net.vector, net.shapes)
    rng = np.random.default_rng(5)
    inputs, targets = rng.integers(0, 11, (6, 3)), rng.integers(0, 10, (6, 3))
    starts = np.zeros((6, 3), bool)
    starts[3, 1] = True
    state = rng.normal(size=(3, 4))

    def loss():
        out = np.zeros((6, 3, 4))
        h, s, tab = 4, state.copy(), net.table()
        for t in range(6):
            b = np.where(starts[t][:, None], 0, s)
            x, g = tab[inputs[t]], b @ net.views["wh"] + net.views["bh"]
            r, z = (1 / (1 + np.exp(-(x[:, i:i + h] + g[:, i:i + h]))) for i in (0, h))
            n = np.tanh(x[:, 2 * h:] + r * g[:, 2 * h:])
            s = (1 - z) * n + z * b
            out[t] = s
        return -net.emit(out.reshape(-1, 4), targets.reshape(-1))[0].sum() / targets.size

    taken = []
    start = net.vector.copy()
    adam = [0, np.zeros_like(start), np.zeros_like(start)]
    net.learn(inputs, targets, starts, state, adam)
    taken = adam[1] / 0.1  # the first moment after one step is a tenth of the gradient
    net.vector[:] = start
    for i in rng.choice(len(start), 60, replace=False):
        net.vector[i] = start[i] + 1e-5
        up = loss()
        net.vector[i] = start[i] - 1e-5
        down = loss()
        net.vector[i] = start[i]
        assert abs((up - down) / 2e-5 - taken[i]) < 1e-4 + 1e-3 * abs(taken[i])


def test_state_is_carried_and_lanes_do_not_matter(monkeypatch):
    net = small()
    rng = np.random.default_rng(8)
    lengths = np.array([1, 200, 3, 70, 64, 65, 128, 9])
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    ids = rng.integers(0, 10, bounds[-1]).astype(np.int32)
    want = rec.score_documents(net, net.table(), ids, bounds)
    for lanes, window in ((1, 7), (3, 1000), (50, 5)):
        monkeypatch.setattr(rec, "SCORE_LANES", lanes)
        monkeypatch.setattr(rec, "SCORE_WINDOW", window)
        assert np.allclose(rec.score_documents(net, net.table(), ids, bounds), want, atol=1e-3)
    alone = [rec.score_documents(net, net.table(), ids[i:j], np.array([0, j - i]))[0]
             for i, j in zip(bounds, bounds[1:], strict=False)]
    assert np.allclose(alone, want, atol=1e-3)


def test_training_uses_every_token_of_a_long_document():
    lengths = np.array([3, 5, 2000, 9, 1, 40, 8, 7, 6, 12, 33, 2, 4, 4, 4, 4, 4, 4])
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    ids = np.random.default_rng(8).integers(0, 10, bounds[-1]).astype(np.int32)
    net, seen, real_learn = small(), [], rec.Network.learn
    net.learn = lambda inputs, targets, starts, state, adam, real: (
        seen.append(targets[real]), real_learn(net, inputs, targets, starts, state, adam, real))[1]
    adam = [0, np.zeros_like(net.vector), np.zeros_like(net.vector)]
    assert rec.fit_documents(net, ids, bounds, adam) == bounds[-1]
    assert (np.bincount(np.concatenate(seen), minlength=10) == np.bincount(ids, minlength=10)).all()


def test_places_without_a_token_teach_nothing():
    rng = np.random.default_rng(6)
    inputs, targets = rng.integers(0, 11, (6, 3)), rng.integers(0, 10, (6, 3))
    starts, real = np.zeros((6, 3), bool), np.ones((6, 3), bool)
    real[2:, 2] = False
    vectors = []
    for other in (0, 5):
        net = small()
        adam = [0, np.zeros_like(net.vector), np.zeros_like(net.vector)]
        net.learn(np.where(real, inputs, other), np.where(real, targets, other), starts,
                  np.zeros((3, 4), np.float32), adam, real)
        vectors.append(net.vector)
    assert np.allclose(*vectors, atol=1e-6)


def test_memory_does_not_grow_with_lanes_times_the_longest_text():
    lengths = np.array([30_000] + [20] * 300)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    ids = np.random.default_rng(8).integers(0, 10, bounds[-1]).astype(np.int32)
    net = small()
    adam = [0, np.zeros_like(net.vector), np.zeros_like(net.vector)]
    tracemalloc.start()
    rec.score_documents(net, net.table(), ids, bounds)
    rec.fit_documents(net, ids, bounds, adam)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25_000_000  # 256 dense lanes of 30,000 steps take 100 MB


def test_the_rounds_fit_every_training_document():
    assert {i % rec.ROUND_SHARE for i in range(1000)} <= set(range(rec.ROUNDS))


def brute(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    counts = Counter(w for (i, _), ws in zip(rows, tokens, strict=True) if not held(i) for w in ws)
    total, types = sum(counts.values()), len(counts)
    return sorted((repr(i), held(i), len(ws), sum(counts[w] > 0 for w in ws), total, round(sum(
        math.log10((counts[w] + 1) / (total + types + 1)) for w in ws), 6)) for (i, _), ws in zip(rows, tokens, strict=True))


def test_odd_rows(odd, no_docs, monkeypatch):
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    for most in (400_000, 40):
        monkeypatch.setattr(rec.lexicon, "__defaults__", (rec.VOCABULARY if most > 40 else 20, most))
        got = rec.score(odd).collect()
        assert want == sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                               round(r["base_score"], 6)) for r in got)
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert rec.score(no_docs).collect() == []
    held_only = odd.filter("crc32(coalesce(string(doc_id), '')) % 7 = 2")
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in rec.score(held_only).collect())


def test_better_than_single_words_on_held_out_texts(spark):
    got = rec.score(table(spark, "/root/testdata/sf0.01", "documents")).filter("held_out").collect()
    n = sum(r["n_tokens"] for r in got)
    assert sum(r["score"] for r in got) / n > sum(r["base_score"] for r in got) / n + 0.1
    assert sum(r["score"] > r["base_score"] for r in got) > 0.9 * len(got)


def test_learning_copies_no_class_weights_for_each_target():
    net = rec.Network(np.linspace(2000.0, 1, 2048))
    rng = np.random.default_rng(4)
    states, targets = rng.uniform(-1, 1, (2000, rec.HIDDEN)).astype(np.float32), rng.permutation(2048)[:2000]
    grad = net._views(np.zeros_like(net.vector), net.shapes)
    tracemalloc.start()
    net.emit(states, targets, grad)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000  # the weights of each target's class take 5.9 MB


def test_large_logits_stay_finite():
    net = small()
    for name in ("wc", "ww"):
        net.views[name][:] *= 400
    states = np.random.default_rng(2).uniform(-1, 1, (5, 4)).astype(np.float32)
    for s in states:
        logp, _ = net.emit(np.repeat(s[None], 10, axis=0), np.arange(10))
        assert np.isfinite(logp).all() and abs(np.exp(logp.astype(float)).sum() - 1) < 1e-4


def test_look_up_finds_each_hash_and_no_other():
    rng = np.random.default_rng(3)
    near = (np.uint64(7) << np.uint64(50)) + np.arange(50, dtype=np.uint64) * np.uint64(2)  # the same first bits
    ends = np.array([0, 2 ** 64 - 1], dtype=np.uint64)
    for hashes in (np.unique(np.concatenate((rng.integers(0, 2 ** 64, 3000, dtype=np.uint64), near, ends))), near[:1],
                   ends[:1], near[:0]):
        n = len(hashes)
        known = rec.Lexicon(hashes, np.arange(n) + 5, np.arange(n, dtype=np.int32), 0, 0, 0, 0.0, np.zeros(1), 0)
        asked = np.concatenate((hashes, hashes + np.uint64(1), near, ends, rng.integers(0, 2 ** 64, 500, dtype=np.uint64)))
        where = {h: i for i, h in enumerate(hashes.tolist())}
        ids, counts = known.look_up(asked)
        assert ids.tolist() == [where.get(h, 0) for h in asked.tolist()]
        assert counts.tolist() == [where[h] + 5 if h in where else -1 for h in asked.tolist()]
