"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

The raw model counts the words and word pairs of all documents, hashed into buckets; the target
model those of the good documents in one half of a bounded labelled sample. A document's log weight is the mean
over its n-grams of log(target / raw), drawn to 0 by ``PRIOR`` n-grams of ratio 1, so that a few
words do not condemn a short text. Gumbel noise, a function of the id and a seed, is added to the
tempered weight, and the k largest are taken: a sample without replacement in proportion to
the tempered weights. k is the number of documents whose weight reaches the cut that parts the
sample's other half best, so as many are taken as look like the target.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.llm.staging import by_name, fold, fresh, map_batches, stage
from filegate.llm.sums import labelled_sample, sum_arrays
from filegate.llm.text import BLANKS, Words, mix, word_slices

BUCKETS = 1 << 16
#: Labelled rows behind the target model and the cut, at most.
SAMPLE_ROWS = 20_000
#: Weight of a nat of mean log ratio against one unit of Gumbel noise.
TEMPER = 200.0
SEED = 20
PRIOR = 20
#: Smoothing: counts added to every bucket, in all.
SMOOTH = 4.0 * BUCKETS
BINS = 1024


def ngram_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each word and each pair of neighbouring words."""
    hashes = words.hashes()
    pairs = mix(hashes[:-1] * np.uint64(0x100000001B3) + hashes[1:])
    same = words.row[:-1] == words.row[1:]
    buckets = np.concatenate((hashes, pairs[same])) >> np.uint64(64 - 16)
    return buckets.astype(np.int64), np.concatenate((words.row, words.row[:-1][same]))


def ngram_counts(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Counts per bucket of all texts, and of the first half's texts labelled 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS))
        for batch in batches:
            good = batch.column(0).fill_null(0).to_numpy() == 1
            for low, _, words in word_slices(batch.column(1), BLANKS):
                buckets, rows = ngram_buckets(words)
                total[0] += np.bincount(buckets, minlength=BUCKETS)
                total[1] += np.bincount(buckets[good[low + rows]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["value"])

    rows = docs.select(by_name(id_col).alias("id"), by_name(text_col).cast("string").alias("text"))
    half = sample.filter(fold(F.col("sample_id"), 2) == 0)  # at most sample_rows rows
    rows = rows.join(F.broadcast(half), F.col("id") == F.col("sample_id"), "left").select("label", "text")
    return sum_arrays(rows.mapInArrow(run, "value binary"), 2 * BUCKETS).reshape(2, BUCKETS)


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """log(target / raw) of every bucket; the target model backs off to the raw one.

    Without target text all ratios are 0.
    """
    raw = (counts[0] + SMOOTH / BUCKETS) / (counts[0].sum() + SMOOTH)
    if not counts[1].sum():
        return np.zeros(BUCKETS)
    target = (counts[1] + SMOOTH * raw) / (counts[1].sum() + SMOOTH)
    return np.log(target / raw)


def weigh(docs: DataFrame, ratios: np.ndarray, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` with the number of n-grams and their mean log ratio (0 without n-grams), and the new names."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    at = docs.columns.index(text_col)
    n_grams, log_weight = fresh(docs, "n_grams"), fresh(docs, "log_weight")

    def run(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for low, high, words in word_slices(batch.column(at), BLANKS):
                buckets, rows = ngram_buckets(words)
                n = np.bincount(rows, minlength=words.rows)
                total = np.bincount(rows, known[buckets], minlength=words.rows)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns, pa.array(n.astype(np.int64)),
                     pa.array(total / (n + PRIOR))], names=names)

    added = [T.StructField(n_grams, T.LongType()), T.StructField(log_weight, T.DoubleType())]
    return map_batches(docs, run, added), n_grams, log_weight


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts good from other rows with the fewest errors, each label weighing the same.

    Where one label is missing, everything passes.
    """
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order].astype(float)
    lost = np.concatenate(([0.0], np.cumsum(g))) / g.sum()
    passed = np.concatenate(([1.0], 1 - np.cumsum(1 - g) / (1 - g).sum()))
    cost = lost + passed
    cost[1:-1][w[1:] == w[:-1]] = np.inf
    at = np.flatnonzero(cost == cost.min())
    edges = np.concatenate(([w[0] - 1], (w[1:] + w[:-1]) / 2, [w[-1] + 1]))
    return float(edges[at[len(at) // 2]])


def gumbel(id_col: Column, seed: int) -> Column:
    """Standard Gumbel noise as a function of the id and a seed."""
    uniform = (F.shiftright(F.xxhash64(id_col, F.lit(seed)), 11) + F.lit(float(1 << 52)) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def top_k(rows: DataFrame, key: str, k: int, tie: str) -> Callable[[str, str], Column]:
    """A condition, given the names of key and tie, for exactly the k rows of largest key, then smallest tie.

    The k-th key is found by histograms over ever smaller ranges: no sort, and no task sees all rows.
    """
    if k <= 0:
        return lambda key, tie: F.lit(False)
    cut, above, equal = _kth(rows, -F.col(key), k)
    if above + equal <= k:
        return lambda key, tie: -by_name(key) <= F.lit(cut)
    last, _, _ = _kth(rows.filter(-F.col(key) == F.lit(cut)), F.col(tie).cast("double"), k - above)
    return lambda key, tie: (-by_name(key) < F.lit(cut)) | (
        (-by_name(key) == F.lit(cut)) & (by_name(tie).cast("double") <= F.lit(last)))


def _kth(rows: DataFrame, value: Column, k: int) -> tuple[float, int, int]:
    """The k-th smallest value, how many are smaller, and how many equal (the largest if there are fewer than k)."""
    values = rows.select(value.cast("double").alias("v"))
    low, high = values.agg(F.min("v"), F.max("v")).collect()[0]
    if low is None:
        return 0.0, 0, 0
    before = 0
    while True:
        inside = values.filter(F.col("v").between(F.lit(low), F.lit(high)))
        place = F.least(F.lit(BINS - 1), F.floor((F.col("v") - low) / ((high - low) or 1.0) * BINS).cast("int"))
        bins = sorted((r["lo"], r["hi"], r["n"]) for r in inside.groupBy(place.alias("bin")).agg(
            F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).collect())
        for i, (lo, hi, n) in enumerate(bins):
            if before + n >= k or i == len(bins) - 1:
                break
            before += n
        if lo == hi:
            return lo, before, n
        low, high = lo, hi


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, k: int | None = None,
             temper: float = TEMPER, seed: int = SEED) -> DataFrame:
    """(id, n_grams, log_weight, key, selected) of every row.

    ``k`` rows are selected (by default as many as reach the cut). Null and empty texts have no
    n-grams and weight 0; null ids are kept and share one noise; equal keys are taken in row
    order, so exactly k rows are selected whatever the ties; of the rows of one labelled id, the smallest weight counts
    for the cut; without labelled good rows all
    weights are 0 and all rows are selected; an empty table gives no rows; extra columns are not
    read.
    """
    ratios, sample = _fit(docs, labels, id_col, text_col, label_col, sample_rows)
    narrow = docs.select(by_name(id_col).alias("id"), by_name(text_col).cast("string").alias("text"))
    weighed, _, _ = weigh(narrow, ratios, "text")
    weights = stage(weighed.drop("text").withColumn("uid", F.monotonically_increasing_id()), "resampling-weights")
    keyed, chosen = _choose(weights, "id", "log_weight", "uid", sample, k, temper, seed)
    return keyed.select(F.col("id").alias(id_col), "n_grams", "log_weight", "key", chosen.alias("selected"))


def _fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
         sample_rows: int) -> tuple[np.ndarray, DataFrame]:
    sample = stage(labelled_sample(labels, id_col, label_col, sample_rows), "resampling-sample")
    return log_ratios(ngram_counts(docs, sample, id_col, text_col)), sample


def _choose(weights: DataFrame, id_name: str, weight: str, uid: str, sample: DataFrame, k: int | None,
            temper: float, seed: int, key: str | None = None) -> tuple[DataFrame, Column]:
    """The staged weights with their keys, and the condition of selection."""
    if k is None:
        half = sample.filter(fold(F.col("sample_id"), 2) == 1)
        seen = weights.select(by_name(id_name).alias("w_id"), by_name(weight).alias("w")).join(
            F.broadcast(half), F.col("w_id") == F.col("sample_id"))
        # one weight for each id, so the sample's bound holds for the rows, too
        seen = seen.groupBy("sample_id").agg(F.min("w").alias("w"), F.max("label").alias("label")).toArrow()
        cut = best_cut(seen["w"].to_numpy(), seen["label"].to_numpy() == 1) if seen.num_rows else -np.inf
        k = weights.filter(by_name(weight) >= F.lit(float(cut))).count()
    key = key or fresh(weights, "key")
    keyed = weights.withColumn(key, by_name(weight) * temper + gumbel(by_name(id_name), seed))
    return keyed, top_k(keyed.select(by_name(key).alias("k"), by_name(uid).alias("u")), "k", k, "u")(key, uid)


def keep_selected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, k: int | None = None,
                  temper: float = TEMPER, seed: int = SEED) -> DataFrame:
    """The selected rows of ``docs`` with their columns unchanged.

    The texts are weighed twice and not copied; rows of one id and text share their fate, also where
    that makes the selection larger or smaller than ``k`` by their number.
    """
    ratios, sample = _fit(docs, labels, id_col, text_col, label_col, sample_rows)
    weighed, _, weight = weigh(docs, ratios, text_col)
    tie, key = fresh(weighed, "tie"), fresh(weighed, "key")
    weighed = weighed.withColumn(tie, F.xxhash64(F.coalesce(by_name(text_col).cast("string"), F.lit(""))))
    narrow = stage(weighed.select(*map(by_name, (id_col, weight, tie))), "resampling-weights")
    _, chosen = _choose(narrow, id_col, weight, tie, sample, k, temper, seed, key)
    keyed = weighed.withColumn(key, by_name(weight) * temper + gumbel(by_name(id_col), seed))
    return keyed.filter(chosen).select(*map(by_name, docs.columns))
