"""MinHash near-duplicates with an LSH forest.

Texts with equal shingle sets are one class from the start. Each class has ``trees`` labels of
``DEPTH`` MinHash values. In every tree the classes stand in the order of their labels, and the
candidates are those that share the longest prefixes: a region of classes with a common prefix of
``ROOT`` values is one group while it is small; a dense region is parted by its full labels and,
where these are still dense, into blocks, and once more into blocks across the labels. So every group
has about ``GROUP`` members at most, whatever the size of a region.

In a group, pairs whose signatures and sizes allow the similarity are candidates; a group of many gives
a spanning forest of the likeliest first. Each class is tested against its likeliest partner, then the pairs that
still stand between two components. In a second
round the groups of other than dense regions that are not in one component yet meet again with their members' whole sets, and
every candidate pair between two components is tested in place, so pairs that fail are never
rows. Last, the members of the dense regions that are not in one component yet meet by their rarest
shingles (a prefix filter on the whole sets that bounds a partner's size by the place of the shared shingle, which parts
texts that share only a template and near copies that have too many own shingles), in groups and block pairs of a
bounded size, so no candidate pair of a region is left out by its blocks. Each link is confirmed on the full shingle sets. Components spread as smallest labels with pointer jumping.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.llm.staging import by_name, fresh, shuffle_width, stage
from filegate.llm.sums import sum_arrays
from filegate.llm.text import BLANKS, Words, mix, shingle_hashes, word_slices

ROOT, DEPTH = 4, 6
GROUP = 64
#: A pair at the threshold shares a root prefix in no tree with at most this probability.
MISS = 1e-6
#: Standard errors of the signature estimate that a candidate may lie below the threshold.
DEVIATIONS = 5
#: Pairs a group gives for each member before the rest is left to the second round.
FIRST_PAIRS = 8
#: Turns in which each class is tested against its likeliest partner alone.
LIKELIEST = 3
#: Counters of shingles that order those of a dense region by frequency.
BUCKETS = 1 << 18
#: Sets of a class of the sweep differ in size by less than this factor.
SIZE_STEP = 1.05
#: Ids that are broadcast to pick or drop documents, at most (16 bytes each).
BROADCAST_IDS = 1_000_000


def tree_count(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROOT))


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted by row and hash (52 bits), and the bounds of each row."""
    runs, row = shingle_hashes(words.hashes(), words.bounds(), width)
    keys = np.sort((row.astype(np.uint64) << np.uint64(52)) | (runs >> np.uint64(12)))
    if len(keys):
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    bounds = np.searchsorted(keys, np.arange(words.rows + 1, dtype=np.uint64) << np.uint64(52))
    return keys & np.uint64((1 << 52) - 1), bounds


def set_keys(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal for equal sets only, but for chance."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ np.uint64(salt)), dtype=np.uint64)))
        out.append((sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.int64))
    return out[0], out[1]


def signatures(shingles: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of 16 bits for every row with shingles (0 for a row without)."""
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(0, 1 << 62, count, dtype=np.uint64)
    out = np.zeros((len(bounds) - 1, count), dtype=np.uint16)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        spread = mix(shingles)
        for i in range(count):
            least = np.minimum.reduceat((spread ^ masks[i]) * factors[i], bounds[:-1][full])
            out[full, i] = (least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    return out


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(by_name(text_col).cast("string"), F.lit("")))


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for start in range(0, len(column), 4000):  # a row's number takes 12 bits of a sort key
        for low, high, words in word_slices(column.slice(start, 4000), BLANKS):
            yield start + low, start + high, *shingle_sets(words, width)


def signature_rows(docs: DataFrame, id_col: str, text_col: str, width: int, count: int) -> DataFrame:
    """(id, h, n, k1, k2, sig) of every row; ``h`` is a hash of the text, which tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, shingles, bounds in _sets(batch.column(2), width):
                k1, k2 = set_keys(shingles, bounds)
                sig = signatures(shingles, bounds, count)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns[:2], pa.array(np.diff(bounds)), pa.array(k1), pa.array(k2),
                     pa.array([s.tobytes() for s in sig], pa.binary())], names=names)

    names = ["id", "h", "n", "k1", "k2", "sig"]
    narrow = docs.select(by_name(id_col).alias("id"), _text_hash(text_col).alias("h"),
                         by_name(text_col).cast("string").alias("text"))
    kinds = [narrow.schema["id"].dataType, *[T.LongType()] * 4, T.BinaryType()]
    return narrow.mapInArrow(run, T.StructType(list(map(T.StructField, names, kinds))))


def forest_groups(classes: DataFrame, trees: int) -> tuple[DataFrame, DataFrame]:
    """(g, cid, dense): groups of at least two classes that stand together in some tree; and (root, cid, size) of
    the dense regions, whose groups (``dense``) are only parts of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                sig = _matrix(part.column(1)).reshape(part.num_rows, trees, DEPTH).astype(np.uint64)
                root = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), sig.shape[:2])
                for d in range(DEPTH):
                    if d == ROOT:
                        short = root
                    root = mix(root * np.uint64(0x100000001B3) + sig[:, :, d])
                cid = np.repeat(part.column(0).to_numpy(), trees)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid), pa.array(short.reshape(-1).astype(np.int64)),
                     pa.array(root.reshape(-1).astype(np.int64))], names=["cid", "root", "full"])

    rows = stage(classes.select("cid", "sig").mapInArrow(run, "cid long, root long, full long"), "neardup-labels")
    sizes = rows.groupBy("root").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stage(rows.join(stage(sizes, "neardup-sizes"), "root"), "neardup-shared")
    sparse = shared.filter(F.col("size") <= GROUP).select(F.col("root").alias("g"), "cid")
    dense = shared.filter(F.col("size") > GROUP)
    blocks = lambda size, salt: F.pmod(F.xxhash64("cid", "root", F.lit(salt)),
                                       F.ceil(F.col(size) / GROUP))
    deeper = dense.groupBy("full").agg(F.count("*").alias("here")).filter("here > 1")
    within = dense.join(stage(deeper, "neardup-deeper"), "full").select(
        F.xxhash64("full", F.lit("within"), blocks("here", 1)).alias("g"), "cid")
    across = dense.select(F.xxhash64("root", F.lit("across"), blocks("size", 2)).alias("g"), "cid")
    parts = within.unionByName(across).withColumn("dense", F.lit(True))
    return sparse.withColumn("dense", F.lit(False)).unionByName(parts), dense.select("root", "cid", "size")


def region_members(dense: DataFrame, labels: DataFrame) -> DataFrame:
    """(cid, label) of all members of the dense regions that are not in one component yet."""
    named = stage(dense.select("root", "cid").join(labels, "cid", "left").withColumn(
        "label", F.coalesce("label", "cid")), "neardup-dense")
    apart = named.groupBy("root").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    apart = stage(apart.filter("low <> high").select("root"), "neardup-regions")
    return named.join(apart, "root", "left_semi").select("cid", "label").distinct()


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(BUCKETS - 1)).astype(np.int64)


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many sets have a shingle of each bucket (never fewer than have one shingle of it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in batch.column(0).slice(low, 500)]
                total += np.bincount(_buckets(np.concatenate(part)), minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["value"])

    return sum_arrays(sets.select("shingles").mapInArrow(run, "value binary"), BUCKETS).astype(np.int64)


def prefix_length(n: int, percent: int) -> int:
    """How many of the rarest shingles of a set of ``n`` can be the first it shares with a similar set.

    They have at least percent / 100 of ``n`` in common.
    """
    return n + percent * n // -100 + 1


def largest_partners(n: int, places: np.ndarray, percent: int) -> np.ndarray:
    """The size of the largest set that can be similar to one of ``n`` if their first common shingle stands at a place.

    They have no more than ``n - place`` in common, and at least percent / (100 + percent) of both sizes together.
    """
    return np.minimum((100 + percent) * (n - places) // percent - n, 100 * n // percent)


def prefix_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, cid, label, n, most): the rarest shingles of each set of ``n``, as many as it may lack in a similar one and
    one more, each with the size of the largest set that it can be the first common shingle with.

    All sets are ordered alike, so two similar sets share a key: the first of their common shingles. There neither is
    larger than the other's ``most``. A shingle that no other set has is no key.
    """
    shared = sets.sparkSession.sparkContext.broadcast(shingle_counts(sets))
    names = ["key", "cid", "label", "n", "most"]

    def batch_of(held: list[tuple[np.ndarray, int, int, int, np.ndarray]]) -> pa.RecordBatch:
        key, cid, label, n, most = zip(*held, strict=True)
        rows = list(map(len, key))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(key).astype(np.int64)), pa.array(np.repeat(cid, rows)),
             pa.array(np.repeat(label, rows)), pa.array(np.repeat(n, rows).astype(np.int32)),
             pa.array(np.concatenate(most).astype(np.int32))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = shared.value, [], 0
        for batch in batches:
            for cid, label, value in zip(*batch.columns, strict=True):
                shingles = np.frombuffer(value.as_buffer(), dtype=np.uint64)
                often, n = counts[_buckets(shingles)], len(shingles)
                first = np.argsort(often, kind="stable")[:prefix_length(n, percent)]
                most = largest_partners(n, np.arange(len(first)), percent)
                first, most = first[often[first] > 1], most[often[first] > 1]
                if len(first):
                    held.append((shingles[first], cid.as_py(), label.as_py(), n, most))
                    size += len(first)
                if size > 100_000:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    return sets.select("cid", "label", "shingles").mapInArrow(run, "key long, cid long, label long, n int, most int")


def _once(rows: DataFrame, name: str, many_apart: bool = False) -> DataFrame:
    """``rows`` (g, cid, label, head, ...) with the ``size`` of the group, for the groups of two labels that have a head.

    Of groups with the same rows one stays; with ``many_apart`` that holds for those of at most GROUP rows.
    """
    held = rows.groupBy("g").agg(
        F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.count_if("head").alias("heads"),
        *[F.bit_xor(F.xxhash64("cid", "head", F.lit(salt))).alias(f"who{salt}") for salt in (1, 2)]
    ).filter("low <> high and heads > 0")
    own = F.when(F.col("size") > GROUP, F.col("g")) if many_apart else F.lit(None).cast("long")
    one = held.groupBy("size", "who1", "who2", own.alias("own")).agg(F.min("g").alias("g")).select("g", "size")
    return stage(rows.join(stage(one, "neardup-once"), "g"), name)


def size_classes(many: DataFrame) -> DataFrame:
    """(g, cid, label, head): the sets of a key that can be similar by their sizes and the key's places in them.

    Sets of like size are one class; a group holds the sets of two classes that may have a partner of another label
    in the other class, neither larger than the other's ``most``. Of two similar sets the smaller one is a ``head``.
    ``many`` has (g, cid, label, n, most).
    """
    many = many.withColumn("class", F.floor(F.log("n") / math.log(SIZE_STEP)).cast("int"))
    shares = stage(many.groupBy("g", "label", "class").agg(
        F.count("*").alias("rows"), F.min("n").alias("least"), F.max("most").alias("most")), "neardup-shares")
    main = shares.groupBy("g", "label").agg(F.sum("rows").alias("rows")).groupBy("g").agg(
        F.max(F.struct("rows", "label")).alias("top")).select("g", F.col("top.label").alias("main"))
    is_main = F.col("label") == F.col("main")
    there = shares.join(main, "g").groupBy("g", "main", "class").agg(
        F.min("least").alias("least"), F.max(F.when(is_main, F.col("most"))).alias("of_main"),
        F.max(F.when(~is_main, F.col("most"))).alias("of_others"))
    there = stage(there.groupBy("g", "main").agg(
        F.collect_list(F.struct("class", "least", "of_main", "of_others")).alias("there")), "neardup-classes-there")
    may_meet = lambda c: (c["least"] <= F.col("most")) & (F.col("n") <= F.when(
        is_main, c["of_others"]).otherwise(F.greatest(c["of_main"], c["of_others"])))
    rows = many.join(there, "g").withColumn("other", F.explode(F.filter("there", may_meet))).withColumn(
        "other", F.col("other.class"))
    head = F.when(F.col("class") == F.col("other"), F.col("most") >= F.col("n")).otherwise(F.col("class") < F.col("other"))
    return rows.select(F.xxhash64("g", F.least("class", "other"), F.greatest("class", "other")).alias("g"), "cid", "label",
                       head.alias("head"))


def sweep_groups(sets: DataFrame, percent: int) -> DataFrame:
    """(g, cid, label): groups of about 2 * GROUP at most in which every two similar sets with different labels meet.

    The sets that share a key are one group while they are few; a key that is a head of none (the first common shingle
    with a set that is no smaller) makes no group. Many are parted by their sizes and places first. Where a group is
    still of many, the heads outside of the largest component are dealt into blocks, and so are all others: each block of
    those heads meets every block. Besides, the blocks of what is no head outside of the largest component meet those of
    the heads in it. Groups with the same sets are one.
    """
    keys = prefix_keys(sets, percent).withColumnRenamed("key", "g").withColumn("head", F.col("most") >= F.col("n"))
    members = _once(stage(keys, "neardup-keys"), "neardup-members", many_apart=True)
    small = members.filter(F.col("size") <= GROUP).select("g", "cid", "label")
    many = members.filter(F.col("size") > GROUP)
    if not many.limit(1).count():
        return small
    members = _once(stage(size_classes(many.select("g", "cid", "label", "n", "most")), "neardup-sized"), "neardup-members")
    small = small.unionByName(members.filter(F.col("size") <= GROUP).select("g", "cid", "label"))
    many = members.filter(F.col("size") > GROUP)
    shares = many.groupBy("g", "label").agg(F.count("*").alias("n"), F.count_if("head").alias("heads"))
    main = shares.groupBy("g").agg(F.max(F.struct("n", "label", "heads")).alias("top"), F.sum("n").alias("all"),
                                   F.sum("heads").alias("heads"))
    other_heads = F.col("heads") - F.col("top.heads")
    sizes = {"leaders": other_heads, "rest": F.col("all") - other_heads, "mains": F.col("top.heads"),
             "late": F.col("all") - F.col("top.n") - other_heads}
    main = stage(main.select("g", F.col("top.label").alias("main"),
                             *[F.ceil(n / GROUP).cast("int").alias(kind) for kind, n in sizes.items()]), "neardup-main")
    dealt = many.join(main, "g")
    is_main = F.col("label") == F.col("main")
    own = lambda kind: F.pmod(F.xxhash64("cid", "g", F.lit(kind)), F.greatest(kind, F.lit(1))).cast("int")
    name = lambda kind, i, j: F.xxhash64("g", F.lit(kind), i, j)

    def each(kind: str, to_name: Callable[[Column], Column]) -> Column:
        return F.when(F.col(kind) > 0, F.transform(F.sequence(F.lit(0), F.col(kind) - 1), to_name)).otherwise(
            F.array().cast("array<bigint>"))

    me = own("leaders")
    leader = F.concat(each("leaders", lambda j: name("leaders", F.least(me, j), F.greatest(me, j))),
                      each("rest", lambda j: name("rest", me, j)))
    with_leaders = each("leaders", lambda i: name("rest", i, own("rest")))
    with_late = each("late", lambda i: name("late", i, own("mains")))
    with_mains = each("mains", lambda j: name("late", own("late"), j))
    met = F.when(F.col("head") & ~is_main, leader).when(F.col("head"), F.concat(with_leaders, with_late)).when(
        is_main, with_leaders).otherwise(F.concat(with_leaders, with_mains))
    return small.unionByName(dealt.select(F.explode(met).alias("block"), "cid", "label").withColumnRenamed("block", "g"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.uint16).reshape(len(values), -1)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(group, its rows) from batches that are sorted by their first column."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        g = rows.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist()]
        for low, high in zip(edges, edges[1:], strict=False):
            yield int(g[low]), rows.slice(low, high - low)
        held = rows.slice(edges[-1]) if len(g) else held
    if held is not None and held.num_rows:
        yield held.column(0)[0].as_py(), held


def _forest(n: int, pairs: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Positions of the pairs that join two trees, taking the likeliest first."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i in np.argsort(-near, kind="stable"):
        a, b = find(int(pairs[0, i])), find(int(pairs[1, i]))
        if a != b:
            parent[b] = a
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def least_matches(percent: int, count: int) -> int:
    """Equal signature values that a pair at the threshold has, but for chance."""
    p = percent / 100
    return math.floor(count * (p - DEVIATIONS * math.sqrt(p * (1 - p) / count)))


def _near_pairs(size: np.ndarray, sig: np.ndarray, label: np.ndarray, percent: int, least: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, equal values) of the pairs of a group that sizes and signatures allow, between two labels."""
    a, b = np.triu_indices(len(size), 1)
    ok = (100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])) & (label[a] != label[b])
    a, b = a[ok], b[ok]
    near = np.concatenate([(sig[a[i:i + 4096]] == sig[b[i:i + 4096]]).sum(axis=1)
                           for i in range(0, len(a), 4096)] or [np.zeros(0, np.int64)])
    ok = near >= least
    return a[ok], b[ok], near[ok]


def candidate_pairs(grouped: DataFrame, percent: int, count: int) -> DataFrame:
    """(a, b, near) with a < b, and (g, null, null) for each group that left pairs to the second round.

    ``near`` counts the equal signature values. ``grouped`` has (g, cid, n, sig), sorted by g and cid within partitions.
    """
    least, most = least_matches(percent, count), FIRST_PAIRS

    def batch_of(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b, near = (np.concatenate(x) for x in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=b < 0), pa.array(near.astype(np.int32), mask=b < 0)],
                                          names=["a", "b", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for g, rows in _members(batches):
            cid = rows.column(1).to_numpy()
            a, b, near = _near_pairs(rows.column(2).to_numpy(), _matrix(rows.column(3).combine_chunks()), cid,
                                     percent, least)
            if not len(a):
                continue
            if len(a) > most * len(cid):
                kept = _forest(len(cid), np.stack((a, b)), near)
                held.append((np.array([g]), np.array([-1]), np.array([0])))
                a, b, near = a[kept], b[kept], near[kept]
            held.append((np.minimum(cid[a], cid[b]), np.maximum(cid[a], cid[b]), near))
            size += len(a)
            if size > 50_000:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    return grouped.select("g", "cid", "n", "sig").mapInArrow(run, "a long, b long, near int")


def likeliest_pairs(pairs: DataFrame) -> DataFrame:
    """(a, b): for each class the pair of the most equal signature values, then of the smallest partner."""
    ends = F.explode(F.array(*[F.struct(F.col(x).alias("me"), F.col(y).alias("you")) for x, y in (("a", "b"), ("b", "a"))]))
    best = pairs.select(ends.alias("e"), "near").groupBy("e.me").agg(
        F.max(F.struct("near", (-F.col("e.you")).alias("you"))).alias("best"))
    you = -F.col("best.you")
    return best.select(F.least("me", you).alias("a"), F.greatest("me", you).alias("b")).distinct()


def crossing_members(grouped: DataFrame, percent: int, count: int) -> DataFrame:
    """(g, cid, label) of the members with a candidate of another label in their group: only their sets need to meet.

    ``grouped`` has (g, cid, label, n, sig), sorted by g within partitions.
    """
    least = least_matches(percent, count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _members(batches):
            a, b, _ = _near_pairs(rows.column(3).to_numpy(), _matrix(rows.column(4).combine_chunks()),
                                  rows.column(2).to_numpy(), percent, least)
            if len(a):
                yield from rows.select([0, 1, 2]).take(pa.array(np.union1d(a, b))).to_batches()

    return grouped.select("g", "cid", "label", "n", "sig").mapInArrow(run, "g long, cid long, label long")


def links_within(grouped: DataFrame, percent: int, count: int) -> DataFrame:
    """(a, b): links between members of a group that carry different labels, until each pair of
    components is linked or every candidate pair between them is refuted.

    ``grouped`` has (g, cid, label, n, sig, shingles), sorted by g within partitions.
    """
    least = least_matches(percent, count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _members(batches):
            cid, label = rows.column(1).to_numpy(), rows.column(2).to_numpy()
            a, b, near = _near_pairs(rows.column(3).to_numpy(), _matrix(rows.column(4).combine_chunks()), label,
                                     percent, least)
            if not len(a):
                continue
            sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in rows.column(5)]
            size, common = np.array(list(map(len, sets))), common_counts(sets)[a, b]
            linked = 100 * common >= percent * (size[a] + size[b] - common)
            a, b, near = a[linked], b[linked], near[linked]
            parent = {x: x for x in label.tolist()}

            def find(x: int, parent=parent) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            found = []
            for i in np.argsort(-near, kind="stable"):
                x, y = int(a[i]), int(b[i])
                p, q = find(int(label[x])), find(int(label[y]))
                if p != q:
                    parent[p] = q
                    found.append((min(cid[x], cid[y]), max(cid[x], cid[y])))
            if found:
                yield _pair_batch(*[[np.array(c)] for c in zip(*found, strict=True)])

    return grouped.select("g", "cid", "label", "n", "sig", "shingles").mapInArrow(run, "a long, b long")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets of a group have in common: bits of the shingles that stand in more than one of
    them, counted some columns at a time."""
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    order = np.argsort(every, kind="stable")
    every, row = every[order], row[order]
    new = np.concatenate(([True], every[1:] != every[:-1]))
    shared = ~(new & np.concatenate((new[1:], [True])))
    column, row = np.cumsum(new[shared]) - 1, row[shared]
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    width = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, width, 8192):
        i, j = np.searchsorted(column, (low, low + 8192))
        part = np.zeros((len(sets), -(-min(8192, width - low) // 64) * 64), dtype=bool)
        part[row[i:j], column[i:j] - low] = True
        bits = np.packbits(part, axis=1).view(np.uint64)
        for k in range(len(sets)):
            out[k] += np.bitwise_count(bits & bits[k]).sum(axis=1, dtype=np.int64)
    return out


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct shingles."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _pair_batch(first: list[np.ndarray], second: list[np.ndarray]) -> pa.RecordBatch:
    b = np.concatenate(second).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(first).astype(np.int64)), pa.array(b, mask=b < 0)], names=["a", "b"])


def class_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, id_col: str, text_col: str,
               width: int) -> DataFrame:
    """(cid, shingles) of the wanted classes, from the text of each class's first document."""
    chosen = stage(classes.join(wanted, "cid", "left_semi").select("cid", "k1", "k2", F.col("first.id").alias("rep")),
                   "neardup-wanted")
    few = chosen.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = chosen.select("rep")
    rows = docs.select(by_name(id_col).alias("id"), by_name(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(ids) if few else ids, F.col("id").eqNullSafe(F.col("rep")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, shingles, bounds in _sets(batch.column(0), width):
                k1, k2 = set_keys(shingles, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1), pa.array(k2),
                     pa.array([shingles[i:j].tobytes() for i, j in zip(bounds, bounds[1:], strict=False)],
                              pa.binary())], names=["k1", "k2", "shingles"])

    sets = rows.select("text").mapInArrow(run, "k1 long, k2 long, shingles binary")
    keys = chosen.select("k1", "k2", "cid")
    # repeated ids may bring a set twice: one row per class stays
    return sets.join(keys, ["k1", "k2"]).select("cid", "shingles").dropDuplicates(["cid"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(similar(*(np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y)), percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(cid, label): the smallest class id reachable from each class that has an edge."""
    both = stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "neardup-edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("cid"), F.least("a", "m").alias("label")), "neardup-components")
    while True:
        told = both.join(labels, F.col("b") == F.col("cid")).groupBy("a").agg(F.min("label").alias("m"))
        stepped = stage(labels.join(stage(told, "neardup-told").withColumnRenamed("a", "cid"), "cid").select(
            "cid", F.least("label", "m").alias("label"), F.col("label").alias("was")), "neardup-components")
        up = stepped.select(F.col("cid").alias("label"), F.col("label").alias("up"))
        jumped = stage(stepped.join(up, "label").select("cid", F.col("up").alias("label"), "was"),
                       "neardup-components")
        moved = jumped.filter("label != was").limit(1).count()
        labels = jumped.select("cid", "label")
        if not moved:
            return labels


def _linked(docs: DataFrame, classes: DataFrame, trees: int, percent: int, id_col: str, text_col: str,
            width: int) -> DataFrame:
    """(cid, label) of all classes with a confirmed link."""
    count = trees * DEPTH
    groups, dense = forest_groups(classes, trees)
    groups = stage(groups, "neardup-groups")
    sets_of = lambda cids: class_sets(docs, classes, cids.distinct(), id_col, text_col, width)
    facts = classes.select("cid", "n", "sig")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(shuffle_width(docs.sparkSession), "g").sortWithinPartitions("g", "cid")

    first = stage(candidate_pairs(dealt(groups.join(facts, "cid")), percent, count), "neardup-first")
    pairs = stage(first.filter("b is not null").groupBy("a", "b").agg(F.max("near").alias("near")), "neardup-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cid"))
    sets = stage(sets_of(ends), "neardup-sets")
    # each class meets its likeliest partner, a few times among the pairs that still stand between two components; then
    # all that are left: copies are one by then, and their sets need not travel again
    label_of = lambda end: labels.select(F.col("cid").alias(end), F.col("label").alias(f"label_{end}"))
    edges, labels = None, None
    for turn in range(LIKELIEST + 1):
        chosen = stage(likeliest_pairs(pairs), "neardup-likely") if turn < LIKELIEST else pairs.select("a", "b")
        found = stage(confirm(chosen, sets, percent), "neardup-confirmed")
        edges = found if edges is None else edges.unionByName(found)
        if turn == 0 or found.limit(1).count():
            labels = components(edges)
        if turn == LIKELIEST:
            break
        rest = pairs.join(chosen, ["a", "b"], "left_anti").join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
        pairs = stage(rest.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b", "near"),
                      "neardup-pairs")
        if not pairs.limit(1).count():
            break
    later = first.filter("b is null").select(F.col("a").alias("g")).distinct()
    # dense regions are swept below as wholes; what is left here are the groups of regions that are not dense
    left = groups.filter("not dense").drop("dense").join(later, "g", "left_semi").join(labels, "cid", "left").withColumn(
        "label", F.coalesce("label", "cid"))
    left = stage(left, "neardup-left")
    apart = left.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = stage(left.join(apart.filter("low <> high").select("g"), "g", "left_semi"), "neardup-apart")

    def linked_further(members: DataFrame, sets: Callable, edges: DataFrame, labels: DataFrame
                       ) -> tuple[DataFrame, DataFrame]:
        """Edges and labels with the links that the groups of ``members`` (g, cid, label) still hold.

        Signatures meet first; the sets (``sets`` of some cids) follow for members with a candidate alone.
        """
        crossing = stage(crossing_members(dealt(members.join(facts, "cid")), percent, count), "neardup-crossing")
        whole = crossing.join(facts.join(sets(crossing.select("cid")), "cid"), "cid")
        more = stage(links_within(dealt(whole), percent, count).distinct(), "neardup-more")
        if not more.limit(1).count():
            return edges, labels
        edges = edges.unionByName(more)
        return edges, components(edges)

    if left.limit(1).count():
        edges, labels = linked_further(left, sets_of, edges, labels)
    members = stage(region_members(dense, labels), "neardup-region-members")
    if members.limit(1).count():
        sets = stage(sets_of(members.select("cid")), "neardup-region-sets")
        groups = stage(sweep_groups(sets.join(members, "cid"), percent), "neardup-sweep")
        if groups.limit(1).count():
            _, labels = linked_further(groups, lambda cids: sets.join(cids.distinct(), "cid"), edges, labels)
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, h, n_shingles, component_id, keeper) of every row.

    Documents are linked when 100 * intersection >= percent * union of their sets of ``width``-word
    shingles (a shorter text: its whole word sequence). ``component_id`` is the smallest id
    reachable; ``keeper`` marks the row that stays of a component: of the smallest id, then text
    hash ``h`` (all of it, where the row is repeated). Null and empty texts have no shingles, are linked
    with nothing and kept; a null id counts as larger than any; repeated rows are linked with
    each other; an empty table gives no rows; extra columns are not read.
    """
    trees = tree_count(percent)
    rows = stage(signature_rows(docs, id_col, text_col, width, trees * DEPTH).withColumn(
        "uid", F.monotonically_increasing_id()), "neardup-rows")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("h"))
    classes = stage(rows.filter("n > 0").groupBy("k1", "k2", "n").agg(
        F.min("uid").alias("cid"), F.min(first).alias("first"), F.first("sig").alias("sig")), "neardup-classes")
    labels = _linked(docs, classes, trees, percent, id_col, text_col, width)
    named = classes.select("cid", "first").join(labels, "cid")
    heads = stage(named.groupBy("label").agg(F.min("first").alias("head")), "neardup-heads")
    linked = stage(labels.join(heads, "label").select("cid", "head"), "neardup-linked")
    known = stage(classes.select("k1", "k2", "cid", "first").join(linked, "cid", "left").select(
        "k1", "k2", F.coalesce("head", "first").alias("head")), "neardup-known")
    out = rows.select("id", "h", "n", "k1", "k2").join(known, ["k1", "k2"], "left")
    alone = F.col("n") == 0
    head = F.col("id").eqNullSafe(F.col("head.id")) & (F.col("h") == F.col("head.h"))
    return out.select(F.col("id").alias(id_col), "h", F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
                      (alone | head).alias("keeper"))


def component_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                     percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; kept: the id is its component's."""
    found = near_duplicates(docs, id_col, text_col, width, percent)
    return found.select(id_col, "n_shingles", "component_id",
                        F.coalesce(by_name(id_col) == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                         percent: int = 80) -> DataFrame:
    """One row of each component of near duplicates, with the columns of ``docs`` unchanged.

    The texts are read again and not copied: rows are told apart by id and text hash. Rows that
    repeat both are reduced to one in a branch of their own (rows without words stay).
    """
    key, text_hash = fresh(docs, "_neardup_id"), fresh(docs, "_neardup_h")
    found = stage(near_duplicates(docs, id_col, text_col, width, percent).select(
        by_name(id_col).alias(key), F.col("h").alias(text_hash), "n_shingles", "keeper"), "neardup-found")
    gone = found.filter("not keeper").select(key, text_hash)
    again = stage(found.filter("keeper and n_shingles > 0").groupBy(key, text_hash).agg(
        F.count("*").alias("rows")).filter("rows > 1").drop("rows"), "neardup-repeated")
    same = by_name(id_col).eqNullSafe(F.col(key)) & (_text_hash(text_col) == F.col(text_hash))
    few = lambda keys: F.broadcast(keys) if keys.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else keys
    kept = docs.join(few(gone), same, "left_anti")
    if not again.limit(1).count():
        return kept
    once = kept.join(few(again), same, "left_semi").withColumn(text_hash, _text_hash(text_col))
    return kept.join(few(again), same, "left_anti").unionByName(
        once.dropDuplicates([id_col, text_hash]).select(*map(by_name, docs.columns)))
