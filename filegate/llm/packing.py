"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

A document of more words than a bin holds gives full pieces, each a bin of its own, and a
remainder. Remainders (and shorter documents) are packed by best fit, longest first, in cells of
about ``CELL_ROWS`` documents that are dealt by a hash of the row, so that a hot source or group of
copies spreads evenly over all cells. In a cell the open bins are ordered by residual; each
carries a bitmap of its sources and one of its duplicate clusters. The successor search starts
at the smallest residual that fits and goes on until a bin shares neither bit: the tightest
compatible bin. A new bin is opened when there is none.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.llm.staging import by_name, shuffle_width, stage
from filegate.llm.text import BLANKS, mix, word_slices

CAPACITY = 1024
CELL_ROWS = 4096


class Cell:
    """Open bins of one cell, ordered by residual."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []       # (residual, bin)
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.used: list[int] = []
        self.slots: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int, int]:
        """(bin, slot, words before it) of a piece; ``source`` and ``cluster`` are bits, 0 for none."""
        at = bisect_left(self.order, (length, -1))
        while at < len(self.order):
            b = self.order[at][1]
            if not (self.sources[b] & source or self.clusters[b] & cluster):
                del self.order[at]
                break
            at += 1
        else:
            b = len(self.used)
            for bits in (self.sources, self.clusters, self.used, self.slots):
                bits.append(0)
        before, slot = self.used[b], self.slots[b]
        self.sources[b] |= source
        self.clusters[b] |= cluster
        self.used[b] += length
        self.slots[b] += 1
        insort(self.order, (self.capacity - self.used[b], b))
        return b, slot, before


def pack_cell(rows: list[tuple[int, str | None, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(row, piece, start, length, bin, slot) of every piece of (length, source, cluster) rows."""
    order = sorted(range(len(rows)), key=lambda i: -(rows[i][0] % capacity))
    repeated = Counter(r[2] for r in rows)
    source_bits: dict[str, int] = {}
    cluster_bits: dict[int, int] = {}
    cell, out = Cell(capacity), []
    for i in order:
        length, source, cluster = rows[i]
        s = 0 if source is None else source_bits.setdefault(source, 1 << len(source_bits))
        c = cluster_bits.setdefault(cluster, 1 << len(cluster_bits)) if repeated[cluster] > 1 else 0
        full, rest = divmod(length, capacity)
        if rest or not full:
            b, slot, _ = cell.place(rest, s, c)
            out.append((i, full, full * capacity, rest, b, slot))
    bins = len(cell.used)
    for i in order:
        for piece in range(rows[i][0] // capacity):
            out.append((i, piece, piece * capacity, capacity, bins, 0))
            bins += 1
    return out


def measure(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, length, cluster, uid): words of each text, and a hash of its lower-cased words.

    Texts of equal word sequences are one duplicate cluster.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_slices(batch.column(3), BLANKS):
                hashes, bounds = words.hashes(), words.bounds()
                place = np.arange(len(hashes), dtype=np.uint64) - bounds[words.row].astype(np.uint64)
                terms = mix(hashes + mix(place))  # a word and its place; their sum stands for the sequence
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
                cluster = mix(sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.int64)
                head = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*head.columns[:3], pa.array(np.diff(bounds)), pa.array(cluster)], names=names)

    names = ["id", "source", "uid", "length", "cluster"]
    narrow = docs.select(by_name(id_col).alias("id"), by_name(source_col).cast("string").alias("source"),
                         F.monotonically_increasing_id().alias("uid"), by_name(text_col).cast("string").alias("text"))
    kinds = [narrow.schema["id"].dataType, T.StringType(), T.LongType(), T.LongType(), T.LongType()]
    return narrow.mapInArrow(run, T.StructType(list(map(T.StructField, names, kinds))))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         capacity: int = CAPACITY, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(id, piece, start, n_words, bin, slot): where each piece of each document stands.

    No bin holds more than ``capacity`` words, two pieces of one source, or two documents of one
    duplicate cluster (full pieces have bins of their own). ``start`` counts the document's words
    before the piece. A null or empty text is one piece of 0 words; a null source conflicts with
    none; null ids and repeated rows are kept (repeated rows are one cluster); an empty table
    gives no rows; extra columns are not read. Bin numbers are unique, not gapless.
    """
    rows = stage(measure(docs, id_col, text_col, source_col), "packing-rows")
    cells = max(1, -(-rows.count() // cell_rows))
    dealt = (rows.withColumn("cell", F.pmod(F.xxhash64("uid"), F.lit(cells)))
             .repartition(max(1, min(cells, 8 * shuffle_width(docs.sparkSession))), "cell")
             .sortWithinPartitions("cell", "uid")
             .select("cell", "id", "source", "length", "cluster"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            cell = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for low, high in zip(edges, edges[1:], strict=False):
                if high <= low:
                    continue
                if current is not None and cell[low] != current:
                    yield from packed(current, held)
                    held = []
                current = int(cell[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield from packed(current, held)

    def packed(cell: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        found = pack_cell(list(zip(*(table.column(i).to_pylist() for i in (3, 2, 4)), strict=True)), capacity)
        for low in range(0, len(found), 10_000):
            part = found[low:low + 10_000]
            row, piece, start, length, b, slot = (np.array(x, dtype=np.int64) for x in zip(*part, strict=True))
            yield pa.RecordBatch.from_arrays(
                [table.column(1).take(pa.array(row)).combine_chunks(), pa.array(piece), pa.array(start),
                 pa.array(length), pa.array(b + (cell << 32)), pa.array(slot)], names=names)

    names = ["id", "piece", "start", "n_words", "bin", "slot"]
    kinds = [rows.schema["id"].dataType, *[T.LongType()] * 5]
    out = dealt.mapInArrow(run, T.StructType(list(map(T.StructField, names, kinds))))
    return out.withColumnRenamed("id", id_col)
