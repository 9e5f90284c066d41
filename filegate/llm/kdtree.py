"""Sharding by a k-d tree over document metadata (DataFrame functions only).

Every node splits along its widest metadata dimension at the distributed weighted median (weight:
bytes), until a leaf holds the target bytes. A median is found by narrowing histograms: each
pass groups the rows still in question into bins per node and sums their bytes, so all nodes of
a level share a pass, a pass returns at most ``nodes * BINS`` rows, and no task holds a node.

Rows equal in the dimension follow by text hash, id and row number. Where the cut would fall into
a group of equal texts that weighs little, it moves to the group's nearer edge, so copies stay
in one shard; a heavy group is split, which keeps sizes near equal under any skew.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filegate.llm.staging import by_name, stage

BINS = 512
#: A group of equal texts up to this share of a leaf's bytes is not split.
WHOLE_GROUP = 0.01
#: Values that order a node's rows: dimension, text hash, id, row number.
ORDER_KEYS = 4
#: Rows of one numbering window.
SLOT_ROWS = 50_000


@dataclass
class Node:
    leaves: int
    first_leaf: int
    weight: int = 0
    dim: int = 0
    target: float = 0.0
    key: int = 0                      # position in the order keys that is being narrowed
    fixed: list = field(default_factory=list)
    low: float | None = None
    high: float | None = None
    base: float = 0.0                 # bytes before the rows in question
    cut: tuple | None = None          # (values, inclusive)


def _coordinate(df: DataFrame, name: str) -> Column:
    """A dimension as a double: numbers as they are, texts by their first six bytes, nulls lowest."""
    kind = df.schema[name].dataType.typeName()
    col = by_name(name)
    if kind in ("string", "binary"):
        six = F.rpad(F.substring(F.hex(F.encode(col.cast("string"), "UTF-8")), 1, 12), 12, "0")
        value = F.conv(six, 16, 10).cast("double")
    else:
        value = col.cast("double")
    finite = F.greatest(F.least(F.nanvl(value, F.lit(None).cast("double")), F.lit(1e300)), F.lit(-1e300))
    return F.when(value.isNull() | F.isnan(value), F.lit(-1.0)).otherwise(finite)


def kd_shards(docs: DataFrame, dims: list[str | Column], shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``size`` is the text's UTF-8 bytes plus 1 (null: as empty). Give ``shards``, or
    ``target_bytes`` to let the tree grow until leaves reach it. Law ``bytes``: leaf sizes are
    near equal. Null dimensions sort lowest, null ids are kept, repeated rows are told apart by a
    row number, an empty table gives no rows, extra columns are not read. ``slot`` numbers each
    shard's rows from 0 without gaps.
    """
    text = F.coalesce(by_name(text_col), F.lit(""))
    coords = [(_coordinate(docs, d) if isinstance(d, str) else d).alias(f"d{i}") for i, d in enumerate(dims)]
    narrow = docs.select(
        by_name(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.shiftright(F.xxhash64(text), 12).cast("double").alias("h"),
        F.coalesce(by_name(id_col).cast("double"), F.lit(-1.0)).alias("idk"),
        F.monotonically_increasing_id().alias("uid"), *coords)
    # the root's number is a stored column: joins on it are hash joins from the first level on
    narrow = stage(narrow.select("*", F.col("uid").cast("double").alias("u"), F.lit(0).alias("node")), "kdtree-rows")

    spans = narrow.agg(F.sum("size").alias("w"), F.count("*").alias("n"),
                       *[f(f"d{i}").alias(f"{f.__name__}{i}") for i in range(len(dims)) for f in (F.min, F.max)]
                       ).collect()[0]
    total, rows = spans["w"] or 0, spans["n"]
    leaves = shards or max(1, -(-total // int(target_bytes)))
    extent = [max((spans[f"max{i}"] or 0.0) - (spans[f"min{i}"] or 0.0), 1e-12) for i in range(len(dims))]
    tolerance = WHOLE_GROUP * total / leaves

    at, nodes = narrow, {0: Node(leaves, 0, total)}
    if rows:
        at, nodes = _grow(at, nodes, extent, tolerance, len(dims))
    shard = F.coalesce(*[F.when(F.col("node") == i, F.lit(n.first_leaf)) for i, n in nodes.items()])

    placed = at.select("id", "size", "crc", "uid", shard.cast("int").alias("shard"))
    subs = max(16, -(-rows // (leaves * SLOT_ROWS)))
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("uid"), F.lit(subs)))
    counts = placed.groupBy("shard", "sub").count()
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "sub", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "sub").orderBy("uid")
    return (placed.withColumn("nth", F.row_number().over(within))
            .join(F.broadcast(offsets), ["shard", "sub"])  # leaves * subs rows: one per 50,000 documents
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.col("nth") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def _grow(at: DataFrame, nodes: dict[int, Node], extent: list[float], tolerance: float,
          n_dims: int) -> tuple[DataFrame, dict[int, Node]]:
    """Split level by level; returns the rows with their node, and the leaves by node number."""
    level = 0
    while any(n.leaves > 1 for n in nodes.values()):
        level += 1
        if level % 5 == 0:  # keeps the plan of a deep tree short
            at = stage(at, "kdtree-level")
        spans = at.groupBy("node").agg(
            F.sum("size").alias("w"),
            *[f(f"d{i}").alias(f"{f.__name__}{i}") for i in range(n_dims) for f in (F.min, F.max)]).collect()
        for row in spans:
            n = nodes[row["node"]]
            n.weight = row["w"]
            n.target = n.weight * (n.leaves // 2) / n.leaves
            wide = [(row[f"max{i}"] - row[f"min{i}"]) / extent[i] for i in range(n_dims)]
            n.dim = max(range(n_dims), key=lambda i: (wide[i], -i))
            n.low, n.high = row[f"min{n.dim}"], row[f"max{n.dim}"]
        present = {row["node"] for row in spans}
        splitting = {i: n for i, n in nodes.items() if n.leaves > 1 and i in present}
        while pending := {i: n for i, n in splitting.items() if n.cut is None}:
            _narrow(at, pending, tolerance, n_dims)
        cuts, children = [], {}
        for i, n in nodes.items():
            if n.leaves == 1:
                children[2 * i] = n
                continue
            half = n.leaves // 2
            children[2 * i] = Node(half, n.first_leaf)
            children[2 * i + 1] = Node(n.leaves - half, n.first_leaf + half)
            if n.cut is not None:
                cuts.append(f"({i}, {n.dim}, {_array(n.cut[0])}, {str(n.cut[1]).lower()})")
        rules = at.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(cuts)} AS t(node, dim, cut, inclusive)")
        place = F.slice(_order(n_dims), F.lit(1), F.size("cut"))
        right = F.when(F.col("inclusive"), place > F.col("cut")).otherwise(place >= F.col("cut"))
        moved = at.join(F.broadcast(rules), "node", "left")  # one row per node
        at = moved.withColumn("node", 2 * F.col("node") + F.coalesce(right.cast("int"), F.lit(0))).select(at.columns)
        nodes = children
    return at, nodes


def _array(values: tuple | list) -> str:
    return "cast(array(" + ", ".join(f"{v!r}D" for v in values) + ") as array<double>)"


def _order(n_dims: int) -> Column:
    """The values by which a node's rows are ordered: its dimension, then text hash, id and row number."""
    dims = F.array(*[F.col(f"d{i}") for i in range(n_dims)])
    return F.array(F.element_at(dims, F.col("dim") + 1), F.col("h"), F.col("idk"), F.col("u"))


def _narrow(at: DataFrame, pending: dict[int, Node], tolerance: float, n_dims: int) -> None:
    """One pass: bins of the rows in question of every pending node, then one step for each node.

    The lowest and highest value in question always fall into different bins, so every pass
    either narrows the range or ends at one value.
    """
    questions = ", ".join(
        f"({i}, {n.dim}, {n.key}, {_array(n.fixed)}, {n.low is None}, {n.low or 0.0!r}D, {n.high or 0.0!r}D)"
        for i, n in pending.items())
    asked = at.sparkSession.sql(
        f"SELECT * FROM VALUES {questions} AS t(node, dim, key, fixed, open, low, high)")
    order = _order(n_dims)
    rows = at.join(F.broadcast(asked), "node").select(  # one row per node that is being split
        "node", "size", "fixed", "open", "low", "high", "key", order.alias("order"))
    rows = rows.withColumn("k", F.element_at("order", F.col("key") + 1)).filter(
        (F.slice("order", F.lit(1), F.col("key")) == F.col("fixed"))
        & (F.col("open") | F.col("k").between(F.col("low"), F.col("high"))))
    span = F.col("high") - F.col("low")
    place = (F.col("k") - F.col("low")) / F.when(span > 0, span).otherwise(F.lit(1.0)) * BINS
    binned = rows.select("node", "size", "k", F.when(F.col("open"), F.lit(0)).otherwise(
        F.least(F.lit(BINS - 1), F.floor(place).cast("int"))).alias("bin"))
    got: dict[int, list] = {}
    for row in (binned.groupBy("node", "bin")
                .agg(F.sum("size").alias("w"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()):
        got.setdefault(row["node"], []).append((row["lo"], row["hi"], row["w"]))
    for i, n in pending.items():
        bins = sorted(got[i])
        before = n.base
        for k, (low, high, w) in enumerate(bins):
            if before + w >= n.target or k == len(bins) - 1:
                break
            before += w
        n.base = before
        if low < high:
            n.low, n.high = low, high
            continue
        n.fixed.append(low)
        if len(n.fixed) == ORDER_KEYS:
            n.cut = (tuple(n.fixed), True)
        elif len(n.fixed) == 2 and w <= tolerance:  # a group of equal texts: cut at its nearer edge
            n.cut = (tuple(n.fixed), n.target - before > before + w - n.target)
        else:
            n.key, n.low, n.high = n.key + 1, None, None
