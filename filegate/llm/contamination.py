"""Benchmark decontamination: a hash set of normalised test n-grams against training windows.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window
is 13 consecutive words of a benchmark item, or the whole item where it has fewer. The windows
are collected once, with a bound: while there are at most ``broadcast_windows``, every task gets
the set and scans its documents against it; beyond that, the windows stay distributed and
document windows meet them in a join on the hash, with the same result. Every hash hit is
verified on the words themselves.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.llm.staging import by_name, fresh, map_batches, stage
from filegate.llm.text import PUNCTUATION, mix, text_buffer, word_slices

WINDOW_WORDS = 13
#: Windows of one broadcast set (about 200 bytes each).
BROADCAST_WINDOWS = 200_000
#: 1 in so many words may be hit before a document counts as contaminated.
HIT_SHARE = 20


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, length, dtype=np.uint64)
    for j in range(length):
        out = out * np.uint64(0x100000001B3) + hashes[j:j + n]
    return mix(out)


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(hash, words, item, length): each window of each item (a null id: null). Items without words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, _, words in word_slices(batch.column(1), PUNCTUATION):
                hashes, bounds = words.hashes(), words.bounds()
                rows: list[tuple] = []
                for r in range(words.rows):
                    first, n = int(bounds[r]), int(bounds[r + 1] - bounds[r])
                    length = min(window, n)
                    if length:
                        item = None if ids[low + r] is None else str(ids[low + r])
                        found = window_hashes(hashes[first:first + n], length)
                        text = [words.word(first + i) for i in range(n)]
                        rows += [(int(h.astype(np.int64)), b" ".join(text[i:i + length]), item, length)
                                 for i, h in enumerate(found)]
                if rows:
                    h, w, i, k = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h, pa.int64()), pa.array(w, pa.binary()), pa.array(i, pa.string()),
                         pa.array(k, pa.int32())], names=["hash", "words", "item", "length"])

    narrow = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "hash long, words binary, item string, length int").distinct()


class WindowSet:
    """Windows by hash, a bit filter in front of them, and the lengths that occur."""

    BITS = 22

    def __init__(self, rows: list[tuple[int, bytes, str | None, int]]):
        self.items: dict[int, dict[bytes, set[str | None]]] = defaultdict(lambda: defaultdict(set))
        self.lengths = sorted({k for *_, k in rows})
        self.filter = np.zeros(1 << self.BITS, dtype=bool)
        for h, words, item, _ in rows:
            self.items[h][bytes(words)].add(item)
        keys = np.array(list(self.items), dtype=np.int64).astype(np.uint64)
        self.filter[(keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def scan(self, words) -> Iterator[tuple[int, np.ndarray, set[str | None]]]:
        """(row, mask of hit words, items) of each row with an occurring window."""
        hashes, bounds = words.hashes(), words.bounds()
        hit: dict[int, np.ndarray] = {}
        found: dict[int, set[str | None]] = defaultdict(set)
        for length in self.lengths:
            runs = window_hashes(hashes, length)
            if not len(runs):
                continue
            inside = words.row[:len(runs)] == words.row[length - 1:]
            maybe = np.flatnonzero(self.filter[(runs >> np.uint64(64 - self.BITS)).astype(np.int64)] & inside)
            for i in maybe:
                texts = self.items.get(int(runs[i].astype(np.int64)))
                if texts is None:
                    continue
                items = texts.get(b" ".join(words.word(j) for j in range(i, i + length)))
                if items:
                    r = int(words.row[i])
                    if r not in hit:
                        hit[r] = np.zeros(int(bounds[r + 1] - bounds[r]), dtype=bool)
                    hit[r][i - bounds[r]:i - bounds[r] + length] = True
                    found[r] |= items
        for r in sorted(hit):
            yield r, hit[r], found[r]


_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string"


def _digest(items: set[str | None]) -> str:
    return hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
                  broadcast_windows: int = BROADCAST_WINDOWS, keep: bool = False) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every document.

    A document is contaminated when ``n_hit > 0`` and ``20 * n_hit >= n_words``. Null and empty
    texts have no words; items without words have no window; items without id count as one in
    ``n_items`` and are not in ``items_sha256``, as in the SQL; an empty benchmark leaves all documents clean; repeated rows and null ids are kept, one row out for each row in.
    With ``keep``, the columns of ``docs`` follow unchanged (names that clash get a leading
    underscore on the result's side).
    """
    windows = benchmark_windows(benchmark, item_col, item_text_col, window)
    rows = windows.limit(broadcast_windows + 1).collect()
    if len(rows) > broadcast_windows:
        return _by_join(docs, windows, id_col, text_col, keep)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast([tuple(r) for r in rows])

    text_at = docs.columns.index(text_col) if keep else 1
    source = docs if keep else docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = _names(docs) if keep else ["n_words", "n_hit", "n_items", "items_sha256"]
    added = list(map(T.StructField, names, (T.LongType(), T.LongType(), T.LongType(), T.StringType())))
    empty = _digest(set())

    def run(batches: Iterator[pa.RecordBatch], field_names: list[str]) -> Iterator[pa.RecordBatch]:
        known = _window_set(shared)
        for batch in batches:
            for low, high, words in word_slices(batch.column(text_at), PUNCTUATION):
                n = high - low
                hits, items, digests = np.zeros(n, np.int64), np.zeros(n, np.int64), [empty] * n
                for r, mask, found in known.scan(words):
                    hits[r], items[r], digests[r] = mask.sum(), len(found), _digest(found)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, n).columns, pa.array(words.counts()), pa.array(hits), pa.array(items),
                     pa.array(digests, pa.string())], names=field_names)

    out = map_batches(source, run, added)
    return _verdict(out, docs, id_col, keep, names)


_last: list = [None, None]


def _window_set(shared) -> WindowSet:
    """The worker's set for a broadcast; it is built once and kept while that broadcast is in use."""
    if _last[0] is not shared:
        _last[:] = [shared, WindowSet(shared.value)]
    return _last[1]


def _names(docs: DataFrame) -> list[str]:
    return [fresh(docs, n) for n in ("n_words", "n_hit", "n_items", "items_sha256")]


def _verdict(out: DataFrame, docs: DataFrame, id_col: str, keep: bool, names: list[str]) -> DataFrame:
    n_words, n_hit = by_name(names[0]), by_name(names[1])
    flag = ((n_hit > 0) & (HIT_SHARE * n_hit >= n_words))
    if keep:
        return out.withColumn(fresh(docs, "contaminated"), flag)
    return out.select(F.col("id").alias(id_col), *names, flag.alias("contaminated"))


def _by_join(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str, keep: bool) -> DataFrame:
    """The same verdicts where the windows are too many to broadcast.

    Document windows and benchmark windows meet by hash; verified hits come back to their
    document as (position, length, item), and words under any of them are counted.
    """
    row = fresh(docs, "_row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "contamination-docs")
    lengths = [r[0] for r in windows.select("length").distinct().collect()]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, _, words in word_slices(batch.column(1), PUNCTUATION):
                hashes, bounds = words.hashes(), words.bounds()
                for length in lengths:
                    runs = window_hashes(hashes, length)
                    at = np.flatnonzero(words.row[:len(runs)] == words.row[length - 1:]) if len(runs) else []
                    for part in (at[i:i + 10_000] for i in range(0, len(at), 10_000)):
                        texts = [b" ".join(words.word(j) for j in range(i, i + length)) for i in part]
                        rows = words.row[part]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[low + rows]), pa.array(runs[part].astype(np.int64)),
                             pa.array(texts, pa.binary()), pa.array((part - bounds[rows]).astype(np.int64)),
                             pa.array(np.full(len(part), length, np.int32))],
                            names=["row", "hash", "words", "pos", "length"])

    text = F.coalesce(by_name(text_col), F.lit(""))
    expanded = numbered.select(by_name(row).alias("row"), text.alias("text")).mapInArrow(
        expand, "row long, hash long, words binary, pos long, length int")
    hits = expanded.join(windows, ["hash", "words", "length"])
    per_row = hits.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("pos", "length"))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"),
        F.max(F.col("item").isNull().cast("long")).alias("unnamed"))
    # words under any span: spans are sorted by position; count what lies beyond the furthest end so far
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"),
                                   s["pos"] + s["length"] - F.greatest(acc["upto"], s["pos"]))).alias("n"),
            F.greatest(acc["upto"], s["pos"] + s["length"]).alias("upto")),
        lambda acc: acc["n"])
    per_row = per_row.select(F.col("row").alias("_hit_row"), covered.alias("_n_hit"),
                             (F.size("items") + F.col("unnamed")).alias("_n_items"),
                             F.sha2(F.concat_ws(",", "items"), 256).alias("_digest"))
    names = _names(docs) if keep else ["n_words", "n_hit", "n_items", "items_sha256"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_slices(batch.column(1), PUNCTUATION):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(words.counts())],
                                                 names=["_count_row", "_n_words"])

    counts = numbered.select(by_name(row).alias("row"), text.alias("text")).mapInArrow(
        count, "_count_row long, _n_words long")
    joined = (numbered.join(counts, by_name(row) == F.col("_count_row"))
              .join(per_row, by_name(row) == F.col("_hit_row"), "left"))
    kept = [by_name(c) for c in docs.columns] if keep else [by_name(id_col).alias("id")]
    out = joined.select(*kept, F.col("_n_words").alias(names[0]),
                        F.coalesce("_n_hit", F.lit(0)).cast("long").alias(names[1]),
                        F.coalesce("_n_items", F.lit(0)).cast("long").alias(names[2]),
                        F.coalesce("_digest", F.sha2(F.lit("").cast("binary"), 256)).alias(names[3]))
    return _verdict(out, docs, id_col, keep, names)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW_WORDS,
                 broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` with the byte ranges of occurring windows cut from ``text_col``, all else untouched.

    A run of hit words goes with the separators between them. Raises ``ValueError`` beyond the
    broadcast bound: drop whole documents by ``contamination`` there.
    """
    rows = benchmark_windows(benchmark, item_col, item_text_col, window).limit(broadcast_windows + 1).collect()
    if len(rows) > broadcast_windows:
        raise ValueError("too many benchmark windows to broadcast; use contamination()")
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        known = _window_set(shared)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(at))
            texts = batch.column(at).to_pylist()
            for low, _, words in word_slices(batch.column(at), PUNCTUATION):
                bounds = words.bounds()
                for r, mask, _ in known.scan(words):
                    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
                    base, begin = offsets[low], offsets[low + r] - offsets[low]
                    kept, last = [], begin
                    for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                        kept.append(raw[base + last:base + words.start[bounds[r] + i]].tobytes())
                        last = words.end[bounds[r] + j - 1]
                    kept.append(raw[base + last:offsets[low + r + 1]].tobytes())
                    texts[low + r] = b"".join(kept).decode()
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(docs, run, [])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns unchanged."""
    found = contamination(docs, benchmark, text_col=text_col, keep=True, **options)
    return found.filter(~by_name(found.columns[-1])).select(*map(by_name, docs.columns))
