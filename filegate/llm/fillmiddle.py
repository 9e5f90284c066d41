"""Fill-in-the-middle texts: two cuts per document, found in a Fenwick tree over fixed text blocks.

A text is a run of units ``[A-Za-z]+|[^A-Za-z]``. Its UTF-8 bytes are dealt into blocks of
``BLOCK`` bytes; one vectorised pass counts the units and the code points that begin in each block, and
a Fenwick tree holds both counts. A cut after ``k`` units descends the tree by binary lifting to the
block where unit ``k`` begins, and reads only that block to find the byte. The cuts and the form
follow from the SHA-256 of a seed and the document's id, so a rerun after a lost executor repeats them.

``fill_in_middle`` returns the texts themselves; ``restored`` rebuilds a text from its output and form.

Rows, one for each input row: a null text counts as empty (form ``plain``, output empty); a null
id hashes as the empty text; repeated rows repeat their result; extra columns are not read. A
text that holds one of the markers stays plain, so an output can always be undone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.llm.staging import by_name
from filegate.llm.text import SLICE_BYTES, slices, text_buffer

#: Bytes of a block.
BLOCK = 256
#: Markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = True
_LETTER[97:123] = True
_POINT = (np.arange(256) & 0xC0) != 0x80

CUT_SCHEMA = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType(), False)])


def _begins(data: np.ndarray, low: int, high: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the bytes ``low`` to ``high`` at which units and code points begin; the text begins at ``first``."""
    part = data[low:high]
    points = _POINT[part]
    letters = _LETTER[part]
    units = points.copy()
    units[1:] &= ~(letters[1:] & letters[:-1])
    if low > first and len(part) and letters[0] and _LETTER[data[low - 1]]:
        units[0] = False
    return units, points


def block_counts(data: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Units and code points that begin in each block of the text in ``data[start:end]``.

    Counted a megabyte at a time, so the flags of a long text never stand in memory whole.
    """
    units, points = [], []
    for low in range(start, end, SLICE_BYTES):
        high = min(low + SLICE_BYTES, end)
        at = np.arange(0, high - low, BLOCK)
        for flags, out in zip(_begins(data, low, high, start), (units, points), strict=True):
            out.append(np.add.reduceat(flags, at, dtype=np.int64))
    if not units:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(units), np.concatenate(points)


class BlockTree:
    """Fenwick tree of the unit and code-point counts of a text's blocks."""

    def __init__(self, data: np.ndarray, start: int, end: int):
        self.data, self.start, self.end = data, start, end
        units, points = block_counts(data, start, end)
        self.blocks = len(units)
        self.n_units, self.n_points = int(units.sum()), int(points.sum())
        node = np.arange(1, self.blocks + 1)
        below = node - (node & -node)  # a node holds the blocks after this one up to its own
        totals = [np.concatenate(([0], np.cumsum(c))) for c in (units, points)]
        self.units, self.points = ((t[node] - t[below]).tolist() for t in totals)

    def cut(self, k: int) -> tuple[int, int]:
        """Byte at which unit ``k`` begins (the end of the text for the last), and the code points before it."""
        if k >= self.n_units:
            return self.end, self.n_points
        block, left, points = 0, k, 0
        step = 1 << (self.blocks.bit_length() - 1)
        while step:
            node = block + step
            if node <= self.blocks and self.units[node - 1] <= left:
                block = node
                left -= self.units[node - 1]
                points += self.points[node - 1]
            step >>= 1
        low = self.start + block * BLOCK
        units, flags = _begins(self.data, low, min(low + BLOCK, self.end), self.start)
        inside = int(np.flatnonzero(units)[left])
        return low + inside, points + int(np.count_nonzero(flags[:inside]))


def _hash_number(seed: str, id_col: str, group: int) -> Column:
    """The ``group``-th eight hex digits of the SHA-256 of ``seed:id`` as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(by_name(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _form(text: Column, h3: Column, h4: Column, plain_from: int, spm_below: int) -> Column:
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (h3 % 100 >= plain_from)
    return F.when(plain, F.lit(PLAIN)).when(h4 % 100 < spm_below, F.lit(SPM)).otherwise(F.lit(PSM))


def _cut_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Columns (row key, text, form, h1, h2) -> row key, form and the cut text."""
    data, offsets = text_buffer(batch.column(1))
    form = batch.column(2).to_pylist()
    h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
    n = np.zeros(len(form), dtype=np.int64)
    prefix, middle, pieces = [None] * len(form), [None] * len(form), []
    for i, kind in enumerate(form):
        start, end = int(offsets[i]), int(offsets[i + 1])
        tree = BlockTree(data, start, end)
        n[i] = tree.n_units
        if kind == PLAIN:
            pieces.append(data[start:end].tobytes())
            continue
        first, second = sorted((int(h1[i]) % (tree.n_units + 1), int(h2[i]) % (tree.n_units + 1)))
        (a, before), (b, upto) = tree.cut(first), tree.cut(second)
        prefix[i], middle[i] = before, upto - before
        head, body, tail = (data[x:y].tobytes() for x, y in ((start, a), (a, b), (b, end)))
        p, s, m = PREFIX.encode() + head, SUFFIX.encode() + tail, MIDDLE.encode() + body
        pieces.append(p + s + m if kind == PSM else s + p + m)
    output = pa.array(pieces, pa.binary()).cast(pa.string())
    columns = [batch.column(0), batch.column(2), pa.array(n), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
               output]
    return pa.RecordBatch.from_arrays(columns, names=["key", "form", *CUT_SCHEMA.fieldNames()])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets = text_buffer(batch.column(1))
        for low, high in slices(offsets):
            yield _cut_batch(batch.slice(low, high - low))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1",
                   plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output``: the rearranged text of every row.

    ``h1`` to ``h4`` are the first groups of eight hex digits of the hash of ``seed:id``. The prefix ends
    after the smaller of ``h1`` and ``h2`` modulo ``n + 1`` units, the middle after the larger. ``h3``
    percent from ``plain_from`` on stays plain; ``h4`` percent below ``spm_below`` puts the suffix first.
    """
    text = F.coalesce(by_name(text_col).cast("string"), F.lit(""))
    h1, h2, h3, h4 = (_hash_number(seed, id_col, g) for g in range(4))
    rows = docs.select(by_name(id_col).alias("key"), text.alias("text"),
                       _form(text, h3, h4, plain_from, spm_below).alias("form"), h1.alias("h1"), h2.alias("h2"))
    schema = T.StructType([T.StructField("key", docs.select(by_name(id_col)).schema[0].dataType),
                           T.StructField("form", T.StringType(), False), *CUT_SCHEMA.fields])
    return rows.mapInArrow(_cut, schema).withColumnRenamed("key", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text before the rearrangement. No marker stands in a part, so the first one found is the one put in."""

    def after(part: Column, marker: str) -> Column:
        return F.substr(part, F.length(F.substring_index(part, marker, 1)) + F.lit(len(marker) + 1))

    def undone(one: str, two: str, prefix_first: bool) -> Column:
        body = after(output, one)
        first, rest = F.substring_index(body, two, 1), after(body, two)
        second, middle = F.substring_index(rest, MIDDLE, 1), after(rest, MIDDLE)
        return F.concat(first, middle, second) if prefix_first else F.concat(second, middle, first)

    return (F.when(form == PSM, undone(PREFIX, SUFFIX, True)).when(form == SPM, undone(SUFFIX, PREFIX, False))
            .otherwise(output))


def fill_report(docs: DataFrame, **options) -> DataFrame:
    """Digests of ``fill_in_middle``: of each output, and of the text rebuilt from it."""
    rows = fill_in_middle(docs, **options)
    key = by_name(rows.columns[0])
    return rows.select(key, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
