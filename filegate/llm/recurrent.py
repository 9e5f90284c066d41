"""Language-model scoring with a gated recurrent network in numpy.

The vocabulary of the network are the ``VOCABULARY`` most frequent training tokens; all others are
one class, within which a token's probability is its smoothed share of the training counts. So
the model is a distribution over all token types and one unknown. Output is factored: a softmax
over classes of words of like frequency, then one over the words of the class.

Counts cover all training documents. The network is fitted by truncated backpropagation with the
state carried from window to window: first on a bounded warm-up, then in ``ROUNDS`` of parameter
averaging, in which every partition trains on its training documents of that round. Scoring carries
the state through whole documents, many documents side by side in lanes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.llm.resampling import top_k
from filegate.llm.staging import by_name, fold, stage
from filegate.llm.sums import sum_arrays
from filegate.llm.text import BLANKS, word_slices

FOLDS, HELD_OUT = 7, 2
VOCABULARY = 2047
CLASSES = 45
HIDDEN = 16
#: Tokens whose counts every task gets; those of rarer tokens are joined.
BROADCAST_TOKENS = 400_000
WARM_UP_DOCS = 3000
ROUNDS = 2
#: One training document in so many is fitted in each round; the rounds together fit all of them.
ROUND_SHARE = ROUNDS
WINDOW = 16
TRAIN_LANES = 128
SCORE_LANES = 256
SCORE_WINDOW = 64
GROUP_BYTES = 8 << 20
RATE = 0.01
#: Targets whose class logits are taken at once.
LOGIT_ROWS = 2048
#: Logits below this in size go to exp as they are.
SAFE_LOGIT = 80
#: Hash that stands for the end token.
END = np.uint64(0xE5D0E5D0E5D0E5D1)


@dataclass
class Lexicon:
    """Counts of the most frequent tokens by sorted hash, and the network's numbering of the first of them.

    ``ids`` has the number in the vocabulary, or 0 (the class of all other tokens).
    """

    hashes: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    total: int
    types: int
    size: int                 # numbers used: 0 for other tokens, then the vocabulary
    other_mass: float         # smoothed counts of all tokens outside of the vocabulary
    frequency: np.ndarray     # of each number
    end: int
    begins: np.ndarray | None = None
    bits: np.uint64 = np.uint64(0)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count) of each token; count -1 where the token is not among the broadcast ones."""
        ids, counts = np.zeros(len(hashes), np.int32), np.full(len(hashes), -1, np.int64)
        if len(self.hashes):
            first, bits = self._first_of_bits()
            at = first.take((hashes >> bits).astype(np.int64))
            # the sorted hashes with the same first bits, one after another: a few, as hashes are even
            open_ = np.flatnonzero(self.hashes.take(at) != hashes)
            while len(open_):
                at[open_] += 1
                open_ = open_[at.take(open_) < len(self.hashes)]
                here, wanted = self.hashes.take(at.take(open_)), hashes.take(open_)
                at[open_[here > wanted]] = len(self.hashes)
                open_ = open_[here < wanted]
            found = np.flatnonzero(at < len(self.hashes))
            at = at.take(found)
            same = self.hashes.take(at) == hashes.take(found)
            found, at = found[same], at[same]
            ids[found], counts[found] = self.ids.take(at), self.counts.take(at)
        return ids, counts

    def _first_of_bits(self) -> tuple[np.ndarray, np.uint64]:
        """Where the sorted hashes of each value of the first bits begin, and how many bits come after them."""
        if self.begins is None:
            bits = max(1, len(self.hashes).bit_length() + 1)
            starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
            self.begins = np.minimum(np.searchsorted(self.hashes, starts), len(self.hashes) - 1)
            self.bits = np.uint64(64 - bits)
        return self.begins, self.bits


def token_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, c): training count of every token, the end token among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, _, words in word_slices(batch.column(0), BLANKS):
                part = np.unique(words.hashes(), return_counts=True)
                held += [part, (np.array([END]), np.array([words.rows]))]
                size += len(part[0])
                if size > 1_500_000:
                    held = [_merge(held)]
                    size = len(held[0][0])
                    if size > 1_000_000:
                        yield _count_batch(*held[0])
                        held, size = [], 0
        if held:
            yield _count_batch(*_merge(held))

    training = docs.filter(fold(by_name(id_col), FOLDS) != HELD_OUT)
    rows = training.select(by_name(text_col).cast("string").alias("text")).mapInArrow(run, "h long, c long")
    return rows.groupBy("h").agg(F.sum("c").alias("c"))


def _merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
    total = np.zeros(len(unique), dtype=np.int64)
    np.add.at(total, back, np.concatenate([c for _, c in held]))
    return unique, total


def _count_batch(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                                      names=["h", "c"])


def lexicon(counts: DataFrame, vocabulary: int = VOCABULARY, most: int = BROADCAST_TOKENS) -> Lexicon:
    """The ``most`` most frequent tokens (a bounded number) from the staged counts."""
    total, types = counts.agg(F.sum("c"), F.count("*")).collect()[0]
    total, types = total or 0, types or 0
    if types > most:
        frequent = counts.filter(top_k(counts.select(F.col("c").alias("key"), F.col("h").alias("tie")),
                                       "key", most, "tie")("c", "h"))
    else:
        frequent = counts
    table = frequent.toArrow()
    h = table["h"].to_numpy().astype(np.uint64)
    c = table["c"].to_numpy().astype(np.int64)
    order = np.lexsort((h, -c))
    h, c = h[order], c[order]
    is_end = h == END
    chosen = np.flatnonzero(~is_end)[:vocabulary - 1]
    ids = np.zeros(len(h), dtype=np.int32)
    ids[chosen] = np.arange(1, len(chosen) + 1)
    end = len(chosen) + 1
    ids[is_end] = end
    inside = ids > 0
    frequency = np.zeros(end + 1)
    frequency[ids[inside]] = c[inside]
    other = (total - c[inside].sum()) + (types - int(inside.sum())) + 1.0
    frequency[0] = other
    by_hash = np.argsort(h)
    return Lexicon(h[by_hash], c[by_hash], ids[by_hash], int(total), int(types), end + 1, float(other),
                   frequency + 1.0, end)


class Network:
    """Gated recurrent units with a class-factored softmax; all weights are views of one vector."""

    def __init__(self, frequency: np.ndarray, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 3):
        self.size, self.hidden = len(frequency), hidden
        # class 0 holds number 0 (other tokens); the rest, most frequent first, fill classes of equal length
        self.width = max(1, -(-(self.size - 1) // classes))
        order = np.argsort(-frequency[1:], kind="stable") + 1
        # short numbers are sorted by radix
        short = np.uint16 if self.size < 65_536 else np.int64
        self.word_class, self.word_place = np.zeros(self.size, short), np.zeros(self.size, np.int64)
        self.word_class[order] = 1 + np.arange(self.size - 1) // self.width
        self.word_place[order] = np.arange(self.size - 1) % self.width
        self.classes = int(self.word_class.max()) + 1
        h, c, s = hidden, self.classes, self.width
        shapes = {"emb": (self.size + 1, h), "wx": (h, 3 * h), "bx": (3 * h,), "wh": (h, 3 * h), "bh": (3 * h,),
                  "wc": (h, c), "bc": (c,), "ww": (c, s, h), "bw": (c, s)}
        self.vector = np.zeros(sum(int(np.prod(x)) for x in shapes.values()), dtype=np.float32)
        self.views = self._views(self.vector, shapes)
        self.shapes = shapes
        self.flat: np.ndarray | None = None  # the gradient's memory
        self.spots = np.arange(self.views["emb"].size).reshape(-1, h)
        rng = np.random.default_rng(seed)
        for name, scale in (("emb", 0.3), ("wx", h ** -0.5), ("wh", h ** -0.5), ("wc", 0.05), ("ww", 0.05)):
            self.views[name][:] = rng.normal(0, scale, shapes[name])
        mass = np.bincount(self.word_class, frequency, minlength=c)
        self.views["bc"][:] = np.log(np.maximum(mass, 1e-9) / mass.sum())
        self.views["bw"][:] = -30.0  # places without a word
        self.views["bw"][self.word_class, self.word_place] = np.log(frequency / mass[self.word_class])

    @staticmethod
    def _views(vector: np.ndarray, shapes: dict) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            out[name] = vector[at:at + n].reshape(shape)
            at += n
        return out

    def table(self) -> np.ndarray:
        """Input part of the gates for every token number (the last: start of a document)."""
        return self.views["emb"] @ self.views["wx"] + self.views["bx"]

    def steps(self, table: np.ndarray | None, inputs: np.ndarray, starts: np.ndarray, state: np.ndarray,
              keep: bool) -> tuple[np.ndarray, tuple | None]:
        """States after each step of a window (steps, lanes, hidden); with ``keep`` what backpropagation needs."""
        h, (steps, lanes) = self.hidden, inputs.shape
        out = np.empty((steps, lanes, h), np.float32)
        rows = steps if keep else 1
        gate, n_all, g_all = (np.empty((rows, *k, lanes, h), np.float32) for k in ((2,), (), (3,)))
        # 1 / (1 + exp(-x)) of the gates r and z: their inputs and weights enter with the sign of the exponent.
        # Gates stand in front of lanes, so that each is one piece of memory.
        sign = np.repeat(np.array([-1, 1], np.float32), [2 * h, h])
        bh = self.views["bh"]
        wh = np.ascontiguousarray((self.views["wh"] * sign).reshape(h, 3, h).transpose(1, 0, 2))
        more = np.where(sign < 0, bh, np.float32(0))
        if table is None:  # the inputs of a window alone
            x = self.views["emb"].take(inputs.reshape(-1), axis=0) @ (self.views["wx"] * sign)
            x += (self.views["bx"] + more) * sign
        else:
            x = ((table + more) * sign).take(inputs, axis=0)
        x = np.ascontiguousarray(x.reshape(steps, lanes, 3, h).transpose(0, 2, 1, 3))
        candidate_bias = np.repeat(bh[None, 2 * h:], lanes, axis=0)
        fresh = starts.any(axis=1)
        for t in range(steps):
            before = np.where(starts[t][:, None], np.float32(0), state) if fresh[t] else state
            at = t if keep else 0
            g, rz, n = g_all[at], gate[at], n_all[at]
            np.matmul(before, wh, out=g)
            g[2] += candidate_bias
            np.add(g[:2], x[t, :2], out=rz)
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            np.multiply(rz[0], g[2], out=n)
            n += x[t, 2]
            np.tanh(n, out=n)
            now = out[t]
            np.subtract(before, n, out=now)
            now *= rz[1]
            now += n
            if t == 0:
                first = before
            state = now
        if not keep:
            return out, None
        before = np.concatenate((first[None], out[:-1]))
        before[starts] = 0
        return out, (before, gate[:, 0], gate[:, 1], n_all, g_all[:, 2])

    def outputs(self, reach: float) -> tuple[np.ndarray, ...]:
        """Weights and biases of the classes and of the words, padded, and bounds of their logits for states of at most
        ``reach``."""
        v = self.views
        return (_padded(v["wc"].T).T, _padded(v["bc"], -np.inf), _padded(v["ww"]), _padded(v["bw"].T, -np.inf).T,
                _largest(v["wc"].T, v["bc"], reach), _largest(v["ww"], v["bw"], reach))

    def emit(self, states: np.ndarray, targets: np.ndarray, grad: dict | None = None, outputs: tuple | None = None
             ) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target, and the gradient of their negative sum by the states."""
        learns = grad is not None
        cls = self.word_class.take(targets)
        order = np.argsort(cls, kind="stable")  # class by class, so that each class is one piece of memory
        cls, place, s = cls.take(order), self.word_place.take(targets.take(order)), states.take(order, axis=0)
        wc, bc, ww, bw, largest, largest_in = outputs or self.outputs(float(np.abs(s).max(initial=0)))
        parts, logp, back = [], np.empty(len(s), np.result_type(s, wc)), None
        for low in range(0, len(s), LOGIT_ROWS):  # a few targets at once, so that their logits stay in the cache
            p = s[low:low + LOGIT_ROWS] @ wc
            p += bc
            p, logp[low:low + LOGIT_ROWS] = _softmax(p, cls[low:low + LOGIT_ROWS], largest, learns)
            parts += [p] * learns
        if learns:
            p = parts[0] if len(parts) == 1 else np.concatenate(parts)
            grad["wc"] += (s.T @ p)[:, :self.classes]
            grad["bc"] += (np.ones(len(p), p.dtype) @ p)[:self.classes]
            back = p @ wc.T
        edges = np.searchsorted(cls, np.arange(1, self.classes + 1))
        inner = edges[0]
        edges -= inner
        if inner < len(s):
            s, place = s[inner:], place[inner:]
            present = np.flatnonzero(np.diff(edges)) + 1
            runs = [(c, slice(edges[c - 1], edges[c])) for c in present.tolist()]
            q = np.empty((len(s), ww.shape[1]), np.result_type(s, ww))
            for c, at in runs:
                np.matmul(s[at], ww[c].T, out=q[at])
            q += bw.take(cls[inner:], axis=0)
            q, logp_in = _softmax(q, place, largest_in, learns)
            logp[inner:] += logp_in
            if learns:
                more = np.empty_like(s, dtype=q.dtype)
                with_one = np.ones((len(s), s.shape[1] + 1), s.dtype)  # the last column sums up the biases
                with_one[:, :-1] = s
                by_weight = np.zeros((self.classes, ww.shape[1], s.shape[1] + 1), q.dtype)
                for c, at in runs:
                    np.matmul(q[at].T, with_one[at], out=by_weight[c])
                    np.matmul(q[at], ww[c], out=more[at])
                grad["ww"] += by_weight[:, :self.width, :-1]
                grad["bw"] += by_weight[:, :self.width, -1]
                back[inner:] += more
        out = np.empty_like(logp)
        out[order] = logp
        if back is None:
            return out, None
        by_state = np.empty_like(back)
        by_state[order] = back
        return out, by_state

    def learn(self, inputs: np.ndarray, targets: np.ndarray, starts: np.ndarray, state: np.ndarray,
              adam: list, real: np.ndarray | None = None) -> np.ndarray:
        """One step of truncated backpropagation over a window; returns the state to carry on.

        ``real`` marks the places that have a token (without it: all).
        """
        h, v = self.hidden, self.views
        out, (before, r, z, n, candidate) = self.steps(None, inputs, starts, state, keep=True)
        if self.flat is None or self.flat.dtype != self.vector.dtype:
            self.flat = np.empty_like(self.vector)
        flat = self.flat
        flat.fill(0)
        grad = self._views(flat, self.shapes)
        states, used = out.reshape(-1, h), targets.size
        if real is None or real.all():
            back = self.emit(states, targets.reshape(-1), grad)[1].astype(out.dtype, copy=False)
        else:
            at = np.flatnonzero(real)
            back, used = np.zeros((targets.size, h), out.dtype), len(at)
            back[at] = self.emit(states.take(at, axis=0), targets.reshape(-1).take(at), grad)[1]
        back = back.reshape(out.shape)
        # what a change of the state after a step means for each gate, for all steps at once
        by_n = (1 - z) * (1 - n * n)
        by_z = (before - n) * z * (1 - z)
        by_r = candidate * r * (1 - r)
        # by the input of the candidate state, by the gates r and z, and by the candidate's recurrent part, side by side:
        # the first three go to the inputs, the last three to the state before
        dg = np.empty((*inputs.shape, 4 * h), np.float32)
        carry = np.zeros_like(state)
        back_wh = np.ascontiguousarray(v["wh"].T)
        fresh = starts.any(axis=1)
        for t in range(len(inputs) - 1, -1, -1):
            d, g = back[t], dg[t]
            d += carry
            by_input = np.multiply(d, by_n[t], out=g[:, :h])
            np.multiply(by_input, by_r[t], out=g[:, h:2 * h])
            np.multiply(d, by_z[t], out=g[:, 2 * h:3 * h])
            np.multiply(by_input, r[t], out=g[:, 3 * h:])
            carry = g[:, h:] @ back_wh
            carry += d * z[t]
            if fresh[t]:
                carry[starts[t]] = 0
        dg = dg.reshape(-1, 4 * h)
        sums = np.ones(len(dg), dg.dtype) @ dg
        grad["wh"] += before.reshape(-1, h).T @ dg[:, h:]
        grad["bh"] += sums[h:]
        tokens = inputs.reshape(-1)
        by_wx = v["emb"].take(tokens, axis=0).T @ dg[:, :3 * h]
        for to, of in ((slice(2 * h), slice(h, 3 * h)), (slice(2 * h, 3 * h), slice(h))):
            grad["wx"][:, to] += by_wx[:, of]
            grad["bx"][to] += sums[of]
        by_token = dg[:, :3 * h] @ np.concatenate((v["wx"][:, 2 * h:], v["wx"][:, :2 * h]), axis=1).T
        place = self.spots.take(tokens, axis=0).reshape(-1)
        grad["emb"] += np.bincount(place, by_token.reshape(-1), minlength=v["emb"].size).reshape(-1, h)
        norm = float(np.sqrt(flat @ flat)) / max(1, used)
        flat *= 0.1 / max(1, used) / max(1, norm)
        adam[0] += 1
        adam[1] *= 0.9
        adam[1] += flat
        adam[2] *= 0.99
        flat *= flat  # a hundredth of the gradient's square
        adam[2] += flat
        size = RATE * np.sqrt(1 - 0.99 ** adam[0]) / (1 - 0.9 ** adam[0])
        step = np.sqrt(adam[2], out=flat)
        step += 1e-6
        np.divide(adam[1], step, out=step)
        step *= size
        self.vector -= step
        return out[-1]


def _padded(x: np.ndarray, value: float = 0) -> np.ndarray:
    """``x`` with further places to a multiple of 16 (along the second axis of three, else the first): whole tiles for the
    matrix products."""
    axis = int(x.ndim == 3)
    shape = list(x.shape)
    shape[axis] = -(-shape[axis] // 16) * 16
    out = np.full(shape, value, x.dtype)
    out[(slice(None),) * axis + (slice(x.shape[axis]),)] = x
    return out


def _largest(weights: np.ndarray, bias: np.ndarray, reach: float) -> float:
    """A bound of all logits, where no state is larger than ``reach``."""
    return float((np.abs(weights) @ np.ones(weights.shape[-1], weights.dtype) * reach + np.abs(bias)).max())


def _softmax(logits: np.ndarray, target: np.ndarray, largest: float, learns: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log probability at each row's target, behind probabilities less one there (the gradient by the logits).

    Without ``learns`` the first array is of no use. Logits of at most ``largest`` that exp can take stay as they are.
    """
    if not largest < SAFE_LOGIT:
        logits -= logits.max(axis=1, keepdims=True)
    flat = logits.reshape(-1)
    at = np.arange(0, flat.size, logits.shape[1]) + target
    own = flat.take(at)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    if learns:
        logits *= np.reciprocal(total)[:, None]
        flat[at] -= 1
    return logits, own - np.log(total)


def lanes(lengths: np.ndarray, count: int) -> list[list[int]]:
    """Documents dealt to at most ``count`` lanes of like length, longest lane first."""
    count = max(1, min(count, len(lengths)))
    filled, out = np.zeros(count, dtype=np.int64), [[] for _ in range(count)]
    for d in np.argsort(-lengths, kind="stable"):
        i = int(filled.argmin())
        out[i].append(int(d))
        filled[i] += lengths[d]
    return [out[i] for i in np.argsort(-filled, kind="stable")]


def _windows(ids: np.ndarray, bounds: np.ndarray, count: int, begin: int, window: int
             ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(inputs, targets, starts, document) of each window as (steps, lanes that still have tokens).

    Unused places have document -1. The lanes stand behind one another in flat arrays, and only
    the window at hand is built. Where few lanes are left, a window takes so many more steps that it
    has about as many tokens, up to the end of the shortest of them.
    """
    dealt = lanes(np.diff(bounds), count)
    order = np.array([d for lane in dealt for d in lane], dtype=np.int64)
    length = np.diff(bounds)[order]
    edge = np.concatenate(([0], np.cumsum(length)))
    flat = ids[np.repeat(bounds[order] - edge[:-1], length) + np.arange(edge[-1])]
    first = np.zeros(len(flat), bool)
    first[edge[:-1]] = True
    owner = np.repeat(order.astype(np.int32), length)
    ends = edge[np.cumsum([len(lane) for lane in dealt])]
    size = np.diff(np.concatenate(([0], ends)))
    low, t = ends - size, 0
    while t < size[0]:
        active = int((size > t).sum())
        steps = int(max(window, min(window * len(size) // active, size[active - 1] - t)))
        steps = min(steps, int(size[0]) - t)
        at = np.arange(t, t + steps)[:, None]
        real = at < size[:active]
        at = np.where(real, low[:active] + at, low[:active])
        starts = first[at] & real
        inputs = np.where(starts | ~real, begin, flat[at - 1])
        yield inputs, np.where(real, flat[at], 0), starts, np.where(real, owner[at], -1)
        t += steps


def _documents(column: pa.Array, known: Lexicon) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray,
                                                                   np.ndarray]]:
    """(first row, end row, token hashes, numbers, counts, bounds) for groups of rows, end tokens included."""
    held, low, size = [], 0, 0
    for start, end, words in word_slices(column, BLANKS):
        n = np.diff(words.bounds())
        bounds = np.concatenate(([0], np.cumsum(n + 1)))
        hashes = np.full(bounds[-1], END, dtype=np.uint64)
        place = np.ones(len(hashes), dtype=bool)
        place[bounds[1:] - 1] = False
        hashes[place] = words.hashes()
        held.append((hashes, *known.look_up(hashes), n + 1))
        size += len(words.data)
        if size >= GROUP_BYTES or end == len(column):
            yield low, end, *_joined(held)
            held, low, size = [], end, 0


def _joined(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes, ids, counts, n = (np.concatenate(x) for x in zip(*held, strict=True))
    return hashes, ids, counts, np.concatenate(([0], np.cumsum(n)))


def fit_documents(network: Network, ids: np.ndarray, bounds: np.ndarray, adam: list) -> int:
    """Train on the given documents, window by window with the state carried; returns the tokens used."""
    state, used = np.zeros((min(TRAIN_LANES, len(bounds) - 1), network.hidden), np.float32), 0
    for inputs, targets, starts, owner in _windows(ids, bounds, TRAIN_LANES, network.size, WINDOW):
        real = owner >= 0
        state = network.learn(inputs, targets, starts, state[:inputs.shape[1]], adam, real)
        used += int(real.sum())
    return used


def score_documents(network: Network, table: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log probability of each whole document's numbers."""
    state = np.zeros((min(SCORE_LANES, len(bounds) - 1), network.hidden), np.float32)
    total, outputs = np.zeros(len(bounds) - 1), network.outputs(1.0)  # states are means of values of tanh
    for inputs, targets, starts, owner in _windows(ids, bounds, SCORE_LANES, network.size, SCORE_WINDOW):
        out, _ = network.steps(table, inputs, starts, state[:inputs.shape[1]], keep=False)
        state = out[-1]
        mine, states, targets = owner.reshape(-1), out.reshape(-1, network.hidden), targets.reshape(-1)
        real = mine >= 0
        if not real.all():
            at = np.flatnonzero(real)
            mine, states, targets = mine.take(at), states.take(at, axis=0), targets.take(at)
        logp, _ = network.emit(states, targets, outputs=outputs)
        total += np.bincount(mine, logp, minlength=len(total))
    return total


def _train_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    training = docs.filter(fold(by_name(id_col), FOLDS) != HELD_OUT)
    return training.select(F.xxhash64(by_name(id_col).cast("string")).alias("order"),
                           by_name(text_col).cast("string").alias("text"))


def _trainer(shared, vector: np.ndarray | None):
    """A task that trains from the given weights and emits (tokens, tokens * weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        network = Network(known.frequency)
        if vector is not None:
            network.vector[:] = vector
        adam = [0, np.zeros_like(network.vector), np.zeros_like(network.vector)]
        tokens = 0
        for batch in batches:
            for _, _, _, ids, _, bounds in _documents(batch.column(0), known):
                tokens += fit_documents(network, ids, bounds, adam)
        value = np.concatenate(([tokens], tokens * network.vector.astype(np.float64)))
        yield pa.RecordBatch.from_arrays([pa.array([value.tobytes()], pa.binary())], names=["value"])

    return run


def train(docs: DataFrame, shared, id_col: str, text_col: str, rounds: int = ROUNDS, share: int = ROUND_SHARE,
          warm_up: int = WARM_UP_DOCS) -> np.ndarray:
    """Weights after the warm-up on a bounded number of documents and the rounds of averaging."""
    rows = _train_rows(docs, id_col, text_col)
    start = Network(shared.value.frequency).vector
    # about ``warm_up`` documents by a hash cut; the end token counts the documents. Only the chosen texts move.
    known = shared.value
    documents = max(1, int(known.frequency[known.end]) - 1)
    cut = (2 ** 63 - 1) * min(warm_up, documents) // documents
    drawn = F.xxhash64("order", F.monotonically_increasing_id()).bitwiseAND(F.lit(2 ** 63 - 1)) <= cut
    few = rows.withColumn("drawn", drawn).where("drawn").select("text").repartition(1)
    vector = _averaged(few, shared, None, start)
    for r in range(rounds):
        part = rows.filter(F.pmod(F.col("order"), F.lit(share)) == r).select("text")
        vector = _averaged(part, shared, vector, vector)
    return vector


def _averaged(rows: DataFrame, shared, vector: np.ndarray | None, otherwise: np.ndarray) -> np.ndarray:
    total = sum_arrays(rows.mapInArrow(_trainer(shared, vector), "value binary"), 1 + len(otherwise))
    return (total[1:] / total[0]).astype(np.float32) if total[0] else otherwise


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from the rows outside the fold crc32(id as text) mod 7 = 2 (a null id counts as the
    empty text). A null or empty text is its end token alone. ``base_score`` is the add-one unigram score,
    ``score`` the model's, both log10 of the whole text. Repeated rows stay and count each time; without
    training rows the counts are 0 and the model has its first weights; an empty table
    gives no rows; extra columns are not read.
    """
    spark = docs.sparkSession
    counts = stage(token_counts(docs, id_col, text_col), "recurrent-counts")
    known = lexicon(counts)
    shared = spark.sparkContext.broadcast(known)
    weights = spark.sparkContext.broadcast(train(docs, shared, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        network = Network(lex.frequency)
        network.vector[:] = weights.value
        table = network.table()
        for batch in batches:
            for low, high, hashes, ids, found, bounds in _documents(batch.column(2), lex):
                here, other = found >= 0, ids == 0
                logs = np.log10(np.maximum(found, 0) + 1.0)
                part = lambda w: np.add.reduceat(w, bounds[:-1], dtype=np.float64)  # noqa: E731  # no row lacks an end
                base = part(np.where(here, logs, 0.0))
                own = score_documents(network, table, ids, bounds) / np.log(10) + part(
                    np.where(here & other, logs, 0.0)) - part(other) * np.log10(lex.other_mass)
                unknown = np.flatnonzero(~here)
                rare, times = _rare(np.searchsorted(bounds, unknown, side="right") - 1, hashes.take(unknown), high - low)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns[:2], pa.array(np.diff(bounds)),
                     pa.array(part(found > 0).astype(np.int64)), pa.array(base), pa.array(own), rare, times],
                    names=names)

    names = ["id", "uid", "n_tokens", "known", "base", "own", "rare", "times"]
    narrow = docs.select(by_name(id_col).alias("id"), F.monotonically_increasing_id().alias("uid"),
                         by_name(text_col).cast("string").alias("text"))
    kinds = [narrow.schema["id"].dataType, T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(),
             T.ArrayType(T.LongType()), T.ArrayType(T.LongType())]
    scored = stage(narrow.mapInArrow(run, T.StructType(list(map(T.StructField, names, kinds)))), "recurrent-scored")
    rare = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "uid", F.col("r.rare").alias("h"), F.col("r.times").alias("n"))
    sums = rare.join(counts, "h").groupBy("uid").agg(  # a token that the counts lack adds log10(0 + 1) = 0
        F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"), F.sum("n").alias("more"))
    out = scored.drop("rare", "times").join(sums, "uid", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    floor = float(np.log10(known.total + known.types + 1))
    return out.select(
        F.col("id").alias(id_col), (fold(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(known.total).cast("long").alias(
            "train_tokens"), (F.col("base") + logs - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("own") + logs).alias("score"))


def _rare(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """Distinct tokens of each row that are not broadcast, and how often each stands there."""
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    first = np.concatenate(([True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))) if len(row) else \
        np.zeros(0, bool)
    at = np.flatnonzero(first)
    times = np.diff(np.concatenate((at, [len(row)])))
    offsets = pa.array(np.searchsorted(row[at], np.arange(rows + 1)).astype(np.int32))
    return (pa.ListArray.from_arrays(offsets, pa.array(hashes[at].astype(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))))
