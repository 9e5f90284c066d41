"""Toxicity: a logistic classifier with a counterfactual penalty.

Features are words and word beginnings (hashed), present or not. Those that go with the label in
a bounded sample of labelled rows are kept, and a logistic model is fitted on them. Sentences
that name a group are also written with other groups' names, and the squared change of the
score between the two is added to the loss, so that a neutral mention of a group does not
move a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.llm.staging import by_name, fold, fresh, map_batches, stage
from filegate.llm.sums import labelled_sample
from filegate.llm.text import PUNCTUATION, Words, mix, word_slices

#: Labelled rows that the classifier is fitted on, at most.
TRAIN_ROWS = 12_000
KEPT_FEATURES = 4096
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
COUNTERFACTUAL = 1.0
#: Bytes of word beginnings that are features beside the whole word.
BEGINNINGS = (4, 6, 8)
SWAPS = 3

#: Names of groups in English, French, German and Spanish, by kind; a name is swapped for others of its kind.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer", "heterosexual"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noir", "blanc", "asiatique", "arabe", "africain", "européen"),
    ("homosexuel", "hétérosexuel", "lesbienne", "transgenre"),
    ("femme", "homme", "fille", "garçon"),
    ("femmes", "hommes", "filles", "garçons"),
    ("immigré", "réfugié", "étranger", "citoyen"),
    ("sourd", "aveugle", "handicapé", "autiste"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiatische", "arabische", "afrikanische", "europäische"),
    ("schwul", "lesbisch", "heterosexuell", "bisexuell"),
    ("frau", "mann", "mädchen", "junge"),
    ("frauen", "männer", "jungen"),
    ("einwanderer", "flüchtling", "ausländer", "bürger"),
    ("gehörlos", "blinde", "behindert", "autistisch"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negro", "blanco", "asiático", "árabe", "africano", "europeo"),
    ("homosexual", "lesbiana", "transgénero"),
    ("mujer", "hombre", "niña", "niño"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("inmigrante", "refugiado", "extranjero", "ciudadano"),
    ("sordo", "ciego", "discapacitado", "autista"),
)


@dataclass
class Model:
    """Sorted feature hashes with their weights; ``scale`` and ``shift`` put the best cut at the threshold."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, words: Words) -> np.ndarray:
        features, rows = word_features(words)
        total = np.full(words.rows, self.intercept)
        if len(self.features) and len(features):
            at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
            known = self.features[at] == features
            once = np.unique(rows[known].astype(np.int64) * len(self.features) + at[known])
            np.add.at(total, once // len(self.features), self.weights[once % len(self.features)])
        return total

    def scores(self, words: Words) -> np.ndarray:
        z = self.scale * self.raw(words) + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def word_features(words: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of their beginnings, and the row of each."""
    start, end, row = words.start, words.end, words.row
    if keep is not None:
        start, end, row = start[keep], end[keep], row[keep]
    features, rows = [words.span_hash(start, end)], [row]
    for n in BEGINNINGS:
        long = end - start > n
        begin = words.span_hash(start[long], start[long] + n)
        features.append(mix(begin + np.uint64(n)))
        rows.append(row[long])
    return np.concatenate(features), np.concatenate(rows)


def _terms(text: str) -> Words:
    column = pa.array([text], pa.string())
    return next(w for _, _, w in word_slices(column, PUNCTUATION))


def _swaps(identity_terms) -> dict[int, list[np.ndarray]]:
    """Word hash of each name: the features of the names that replace it."""
    out: dict[int, list[np.ndarray]] = {}
    for group in identity_terms:
        features = [word_features(_terms(t))[0] for t in group]
        for i, term in enumerate(group):
            others = [features[(i + j) % len(group)] for j in range(1, min(SWAPS, len(group) - 1) + 1)]
            out[int(_terms(term).hashes()[0])] = others
    return out


def _training_rows(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str, identity_terms) -> DataFrame:
    """(label, features, swapped): distinct features of each sampled text, and of each swapped form."""
    swaps = _swaps(identity_terms)
    names = np.array(sorted(swaps), dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_slices(batch.column(1), PUNCTUATION):
                hashes, bounds = words.hashes(), words.bounds()
                named = np.isin(hashes, names) if len(names) else np.zeros(len(hashes), dtype=bool)
                features, rows = word_features(words)
                order = np.argsort(rows, kind="stable")
                features, ends = features[order], np.searchsorted(rows[order], np.arange(words.rows + 1))
                own, swapped = [], []
                for r in range(words.rows):
                    own.append(np.unique(features[ends[r]:ends[r + 1]]).astype(np.int64).tobytes())
                    here = np.flatnonzero(named[bounds[r]:bounds[r + 1]]) + bounds[r]
                    forms = []
                    if len(here):
                        rest = np.zeros(len(hashes), dtype=bool)
                        rest[bounds[r]:bounds[r + 1]] = ~named[bounds[r]:bounds[r + 1]]
                        base, _ = word_features(words, rest)
                        found = [swaps[int(h)] for h in np.unique(hashes[here])]
                        for j in range(max(map(len, found))):
                            new = [f[j % len(f)] for f in found if f]
                            forms.append(np.unique(np.concatenate([base, *new])).astype(np.int64).tobytes())
                    swapped.append(forms)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(own, pa.binary()),
                     pa.array(swapped, pa.list_(pa.binary()))], names=["label", "features", "swapped"])

    picked = docs.select(by_name(id_col).alias("id"), by_name(text_col).cast("string").alias("text"))
    picked = picked.join(F.broadcast(sample), F.col("id") == F.col("sample_id"))
    # one row of each id (the smallest text hash), so there are at most train_rows of them
    one = picked.groupBy("sample_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("one"))
    return one.select("one.label", "one.text").mapInArrow(run, "label int, features binary, swapped array<binary>")


def _select(rows: list, kept: int) -> np.ndarray:
    """Features that go with either label, by their standardised difference of log odds."""
    def count(label: int) -> tuple[np.ndarray, np.ndarray, int]:
        arrays = [np.frombuffer(r["features"], dtype=np.int64) for r in rows if r["label"] == label]
        f, n = np.unique(np.concatenate(arrays), return_counts=True) if arrays else (np.zeros(0, np.int64),) * 2
        return f, n, len(arrays)

    f1, n1, rows1 = count(1)
    f0, n0, rows0 = count(0)
    if not rows1 or not rows0:
        return np.zeros(0, dtype=np.uint64)
    both = np.union1d(f1, f0)
    a, b = np.zeros(len(both)), np.zeros(len(both))
    a[np.searchsorted(both, f1)] = n1
    b[np.searchsorted(both, f0)] = n0
    odds = lambda x, n: np.log((x + 0.5) / (n - x + 0.5))
    z = (odds(a, rows1) - odds(b, rows0)) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    enough = np.flatnonzero((a + b >= 3) & (np.abs(z) > 3))
    best = enough[np.argsort(-np.abs(z[enough]), kind="stable")][:kept]
    return np.sort(both[best].astype(np.uint64))


def _matrix(arrays: list[bytes], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature index) of the kept features present in each array."""
    row, col = [], []
    for i, raw in enumerate(arrays):
        have = np.frombuffer(raw, dtype=np.int64).astype(np.uint64)
        at = np.minimum(np.searchsorted(features, have), len(features) - 1)
        at = at[features[at] == have]
        row.append(np.full(len(at), i))
        col.append(at)
    return (np.concatenate(row).astype(np.int64), np.concatenate(col).astype(np.int64)) if row else (
        np.zeros(0, np.int64), np.zeros(0, np.int64))


def fit(rows: list, penalty: float = COUNTERFACTUAL, kept: int = KEPT_FEATURES, threshold: float = THRESHOLD,
        ridge: float = 1e-3, steps: int = 400) -> Model:
    """Logistic model over the kept features: log loss, ridge, and the counterfactual penalty.

    Without rows of both labels the model is constant, at half the threshold.
    """
    features = _select(rows, kept)
    if not len(features):
        base = threshold / 2
        return Model(features, np.zeros(0), 0.0, 1.0, float(np.log(base / (1 - base))))
    y = np.array([r["label"] for r in rows], dtype=float)
    row, col = _matrix([r["features"] for r in rows], features)
    pairs = [(i, raw) for i, r in enumerate(rows) for raw in r["swapped"]]
    swap_row, swap_col = _matrix([raw for _, raw in pairs], features)
    origin = np.array([i for i, _ in pairs], dtype=np.int64)
    n, m = len(y), len(features)
    balance = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    w, b = np.zeros(m), 0.0
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], minlength=n) + b
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        error = balance * (p - y) / n
        grad = np.bincount(col, error[row], minlength=m) + ridge * w
        if len(pairs):
            moved = z[origin] - np.bincount(swap_row, w[swap_col], minlength=len(pairs)) - b
            pull = np.bincount(origin, moved, minlength=n)
            grad += 2 * penalty / len(pairs) * (np.bincount(col, pull[row], minlength=m)
                                                - np.bincount(swap_col, moved[swap_row], minlength=m))
        step = np.append(grad, error.sum())
        first = 0.9 * first + 0.1 * step
        second = 0.999 * second + 0.001 * step * step
        move = 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    z = np.bincount(row, w[col], minlength=n) + b
    return Model(features, w, b, 1.0, float(np.log(threshold / (1 - threshold))) - _best_cut(z, y))


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors on the training rows (the middle of the best gap)."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    errors = np.concatenate(([y.sum()], y.sum() + np.cumsum(1 - 2 * y)))
    edges = np.concatenate(([z[0] + 2], (z[:-1] + z[1:]) / 2, [z[-1] - 2]))
    real = np.concatenate(([True], z[:-1] > z[1:], [True]))
    least = np.where(real, errors, np.inf)
    best = np.flatnonzero(least == least.min())
    return float(edges[best[len(best) // 2]])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS, identity_terms=IDENTITY_TERMS,
          penalty: float = COUNTERFACTUAL, folds: int | None = FOLDS, held_out: int | None = HELD_OUT) -> Model:
    """Fit on at most ``train_rows`` labelled rows outside the held-out fold.

    The driver receives the distinct feature hashes of those rows, not their texts.
    """
    sample = stage(labelled_sample(labels, id_col, label_col, train_rows, folds, held_out), "toxicity-sample")
    rows = _training_rows(docs, sample, id_col, text_col, identity_terms)
    return fit(rows.toArrow().sort_by([("label", "ascending"), ("features", "ascending")]).to_pylist(), penalty)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a score column under a name that is free; a null text counts as empty."""
    name = fresh(docs, "score")
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for low, high, words in word_slices(batch.column(at), PUNCTUATION):
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns, pa.array(known.scores(words))], names=names)

    return map_batches(docs, run, [T.StructField(name, T.DoubleType())]), name


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS,
             identity_terms=IDENTITY_TERMS, penalty: float = COUNTERFACTUAL) -> DataFrame:
    """(id, held_out, score, predicted) of every row.

    Learns from labels outside the fold crc32(id as text) mod 3 = 1; the text is the only input of
    a score. Null and empty texts get the score of a text without features; null ids count as
    the empty text for the fold; repeated rows stay; without usable labels every score is the
    same, below the threshold; an empty table gives no rows; extra columns are not read. Of the rows of
    one labelled id, the one of the smallest text hash is learned from.
    """
    model = train(docs, labels, id_col, text_col, label_col, train_rows, identity_terms, penalty)
    narrow = docs.select(by_name(id_col).alias("id"), by_name(text_col).cast("string").alias("text"))
    scored, name = score(narrow, model)
    return scored.select(F.col("id").alias(id_col), (fold(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"),
                         F.col(name).alias("score"), (F.col(name) >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns unchanged."""
    scored, name = score(docs, train(docs, labels, id_col, text_col, label_col), text_col)
    return scored.filter(by_name(name) < threshold).select(*map(by_name, docs.columns))
