"""Document fingerprints from closed syncmers.

A k-mer of the text's UTF-8 bytes is a closed syncmer when the smallest (by hash) of its inner
s-mers stands at its first or last place. The choice depends on the k-mer alone, so equal
passages give equal anchors wherever they stand, and in any k - s consecutive k-mers at least
one is chosen. That bounds the gap between anchors, so an anchor takes six bytes: 40 bits of
k-mer hash and the distance from the anchor before. A fingerprint is the base64 of all anchors
in order (eight characters each); nothing is cut off, whatever the length.

A text without any syncmer (shorter than k, or between two choices) has one anchor: the hash of
the whole text, with the distance byte 255. An empty text has the empty fingerprint.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filegate.llm.staging import shuffle_width
from filegate.llm.text import mix, slices, text_buffer

K = 24
S = 9
SLICE_BYTES = 1 << 18
WHOLE_TEXT = 255
#: Splits of the id range, and documents of one bucket between them.
SPLITS = 1024
BUCKET_ROWS = 20_000


def _rolling(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values, by doubling."""
    base = 0x9E3779B97F4A7C15
    out, done, power = codes, 1, base
    parts: list[tuple[np.ndarray, int]] = []
    rest = width
    while rest:
        if rest & 1:
            parts.append((out, done))
        rest >>= 1
        if rest:
            out = out[:-done] * np.uint64(power) + out[done:]
            power = power * power % (1 << 64)
            done *= 2
    n = len(codes) - width + 1
    total, at = np.zeros(n, dtype=np.uint64), 0
    for part, size in reversed(parts):
        total = total * np.uint64(pow(base, size, 1 << 64)) + part[at:at + n]
        at += size
    return total


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of all closed syncmers of the concatenated texts, none across two texts."""
    n = len(data)
    if n < k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    codes = data.astype(np.uint64) + np.uint64(1)
    inner = mix(_rolling(codes, s))
    least = _least(inner, k - s + 1)
    m = n - k + 1
    chosen = (inner[:m] == least[:m]) | (inner[k - s:k - s + m] == least[:m])
    at = np.flatnonzero(chosen)
    end = offsets[np.searchsorted(offsets, at, side="right")]
    at = at[at + k <= end]
    return at, mix(_rolling(codes, k)[at])


def fingerprints(data: np.ndarray, offsets: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Six-byte anchors of all texts, and the range of anchors of each text."""
    at, hashes = anchors(data, offsets, k, s)
    low = np.searchsorted(at, offsets[:-1])
    high = np.searchsorted(at, offsets[1:])
    packed = np.zeros((len(at), 6), dtype=np.uint8)
    if len(at):
        gap = np.diff(at, prepend=0)
        firsts = low[high > low]
        gap[firsts] = at[firsts] - offsets[:-1][high > low]
        packed[:, :5] = (hashes >> np.uint64(24)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
        packed[:, 5] = gap
    bare = np.flatnonzero((high == low) & (np.diff(offsets) > 0))
    if not len(bare):
        return packed, np.stack((low, high))
    extra = np.zeros((len(bare), 6), dtype=np.uint8)
    for i, r in enumerate(bare):
        codes = data[offsets[r]:offsets[r + 1]].astype(np.uint64) + np.uint64(1)
        whole = int(mix(_rolling(codes, len(codes)))[0]) ^ len(codes)
        extra[i] = [*(whole >> 24).to_bytes(5, "big"), WHOLE_TEXT]
    low[bare] = len(at) + np.arange(len(bare))
    high[bare] = low[bare] + 1
    return np.concatenate((packed, extra)), np.stack((low, high))


def positions(fingerprint: str) -> list[tuple[int, int]]:
    """(byte position, hash) of each anchor; a whole-text anchor has position 0."""
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 6)
    gaps = np.where(raw[:, 5] == WHOLE_TEXT, 0, raw[:, 5]).astype(np.int64)
    return [(int(p), int.from_bytes(h.tobytes(), "big")) for p, h in zip(np.cumsum(gaps), raw[:, :5], strict=True)]


def match_positions(first: str, second: str) -> list[tuple[int, int]]:
    """Byte positions of anchors that stand once in either text and are common to both."""
    def once(fingerprint: str) -> dict[int, int]:
        found: dict[int, list[int]] = {}
        for p, h in positions(fingerprint):
            found.setdefault(h, []).append(p)
        return {h: p[0] for h, p in found.items() if len(p) == 1}

    a, b = once(first), once(second)
    return sorted((a[h], b[h]) for h in a.keys() & b.keys())


def likeness(first: np.ndarray, second: np.ndarray) -> float:
    """Common anchors (with repeats) over all anchors of the two, times two; 1.0 for two empty texts.

    Takes sorted anchor hashes.
    """
    if not len(first) or not len(second):
        return float(len(first) == len(second))
    if len(first) == len(second) and np.array_equal(first, second):
        return 1.0
    a, na = np.unique(first, return_counts=True)
    b, nb = np.unique(second, return_counts=True)
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return 2.0 * float(np.minimum(na[ia], nb[ib]).sum()) / (len(first) + len(second))


def _anchor_hashes(packed: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(packed), 8), dtype=np.uint8)
    wide[:, 3:] = packed[:, :5]
    return np.sort(wide.view(">u8").reshape(-1).astype(np.uint64))


def fingerprint_column(column: pa.Array, k: int = K, s: int = S) -> list[str]:
    """Fingerprint of every text of an Arrow column."""
    data, offsets = text_buffer(column)
    out = []
    for low, high in slices(offsets, SLICE_BYTES):
        part = offsets[low:high + 1]
        packed, (lo, hi) = fingerprints(data[part[0]:part[-1]], part - part[0], k, s)
        out += [base64.b64encode(packed[i:j].tobytes()).decode() for i, j in zip(lo, hi, strict=True)]
    return out


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                          s: int = S) -> DataFrame:
    """(id, fingerprint) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(fingerprint_column(part.column(1), k, s), pa.string())],
                    names=["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next_text): each row with the text of its successor by id; the last is followed by the first.

    Rows meet in buckets of the id range: quantiles of the id cut it, and each part is cut
    evenly further, so a bucket holds about ``BUCKET_ROWS`` rows at any size. A bucket's first row is
    copied to the end of the bucket before it, and the rest is a window within buckets: the
    texts are moved once. Null ids come first; equal ids follow by text.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("double").alias("x"))
    spread = ids.agg(F.count("*").alias("n"),
                     F.percentile_approx("x", [i / SPLITS for i in range(SPLITS + 1)], 20_000).alias("q")).collect()[0]
    cuts = sorted(set(spread["q"] or []))
    wanted = max(8 * shuffle_width(spark), spread["n"] // BUCKET_ROWS)
    bucket = _bucket(F.col(id_col).cast("double"), cuts, -(-wanted // SPLITS))
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    rows = docs.select(F.col(id_col).alias("id"), text, bucket.alias("bucket"))

    heads = rows.groupBy("bucket").agg(F.min(F.coalesce(F.col("id").cast("double"), F.lit(-1e308))).alias("head"))
    order = Window.orderBy("bucket")  # one row per bucket
    heads = heads.select("head", "bucket", F.lag("bucket").over(order).alias("back"),
                         F.last("bucket").over(order.rowsBetween(Window.unboundedPreceding,
                                                                 Window.unboundedFollowing)).alias("end"))
    heads = heads.select("head", F.coalesce("back", "end").alias("ghost"))
    # at most max(8 * shuffle partitions, rows / 20,000) rows of two numbers
    marked = rows.join(F.broadcast(heads),
                       F.coalesce(F.col("id").cast("double"), F.lit(-1e308)) == F.col("head"), "left")
    places = F.when(F.col("ghost").isNull(), F.array(F.struct(F.col("bucket").alias("at"), F.lit(0).alias("copy"))))
    places = places.otherwise(F.array(F.struct(F.col("bucket").alias("at"), F.lit(0).alias("copy")),
                                      F.struct(F.col("ghost").alias("at"), F.lit(1).alias("copy"))))
    dealt = marked.select("id", "text", F.explode(places).alias("p")).select("id", "text", "p.at", "p.copy")
    within = Window.partitionBy("at").orderBy("copy", "id", "text")
    return dealt.withColumn("next_text", F.lead("text").over(within)).filter("copy = 0").select(
        "id", "text", F.coalesce("next_text", "text").alias("next_text"))


def _bucket(x: Column, cuts: list[float], fan: int) -> Column:
    """Number of the id's bucket, rising with the id: two levels of cuts, then even parts between two cuts."""
    if not cuts:
        return F.lit(0).cast("long")
    step = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    numbers = lambda values: F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")
    count = lambda array: F.size(F.filter(array, lambda c: x >= c))
    outer = F.greatest(count(numbers([g[0] for g in groups])) - 1, F.lit(0))
    inner = F.split(F.element_at(F.split(F.lit(";".join(",".join(map(repr, g)) for g in groups)), ";"), outer + 1),
                    ",").cast("array<double>")
    place = outer * step + count(inner) - 1  # -1: below all cuts
    bounds = numbers([*cuts, cuts[-1]])
    low = F.element_at(bounds, F.greatest(place, F.lit(0)) + 1)
    high = F.element_at(bounds, F.greatest(place, F.lit(0)) + 2)
    part = F.floor((x - low) / F.when(high > low, high - low).otherwise(F.lit(1.0)) * fan)
    part = F.greatest(F.lit(0), F.least(F.lit(fan - 1), part))
    return F.coalesce((place + 1) * fan + F.when(place >= 0, part).otherwise(F.lit(0)), F.lit(-1)).cast("long")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                   s: int = S) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likenesses.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many
    (or all) of the next text by ascending id (after the last: the first; one row alone is
    followed by itself). Returns (id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next). A null text counts as empty, null ids sort first, equal ids follow by
    text, repeated rows stay, extra columns are not read, an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pairs = with_next(docs, id_col, text_col)
    n, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    sides = pairs.select("id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_text")
    sides = sides.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256)).select(
        "id", "n_chars", "edited_sha256", "text", "edited", "next_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [text_buffer(batch.column(i)) for i in (3, 4, 5)]
            for low, high in slices(columns[0][1], SLICE_BYTES):
                packs = []
                for data, offsets in columns:
                    part = offsets[low:high + 1]
                    packs.append(fingerprints(data[part[0]:part[-1]], part - part[0], k, s))
                prints: list[list[str]] = [[], []]
                near: list[list[float]] = [[], []]
                for r in range(high - low):
                    own = [p[lo[r]:hi[r]] for p, (lo, hi) in packs]
                    for out, p in zip(prints, own[:2], strict=True):
                        out.append(base64.b64encode(p.tobytes()).decode())
                    hashes = [_anchor_hashes(p) for p in own]
                    near[0].append(likeness(hashes[0], hashes[1]))
                    near[1].append(likeness(hashes[0], hashes[2]))
                head = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*head.columns[:3], *(pa.array(p, pa.string()) for p in prints),
                     *(pa.array(x, pa.float64()) for x in near)], names=names)

    schema = (f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [f.split()[0] for f in schema.split(", ")]
    return sides.mapInArrow(run, schema).withColumnRenamed("id", id_col)
