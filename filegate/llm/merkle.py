"""Merkle manifest of a dataset: one digest per row, a witness per row, one root.

Every row is a leaf. The leaves of a group (a source here) ascend by id; while several nodes remain, runs of
``ARITY`` consecutive ones become the hash of their digests. What remains is the group's subroot, and the
subroots, ordered by group, make the root in the same way.

Witnesses are built incrementally. ``Appender`` takes nodes in order. A node's witness starts empty; when the run
of an open subtree closes, the witnesses of all nodes below it are extended by the run's other digests, and the
run's hash is appended one level up. Leaves are dealt into aligned blocks of ``BLOCK`` (three
levels), each streamed through an appender of its own; the block roots are appended in the next round, and so on
until one node per group is left. On the way down, each block's own witness meets its nodes as one
extra row of the same shuffle, never as a copy per node.

Positions come from a range partitioning on (group, id, digest) and the counts per partition and group, so
no task holds a group. A task holds one block. The number of rounds is the logarithm of the largest group to base
4,096; the driver sees a flag per round.

Rows, one for each input row: a null field is ``-``; a null group comes first; null ids stand first in their
group; rows equal in group and id follow by digest, equal rows in any order; a lone leaf is its group's
subroot and an only subroot the root (the witness is empty); an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from filegate.llm.staging import by_name, stage

ARITY = 16
#: Levels and nodes of a block.
LEVELS = 3
BLOCK = ARITY ** LEVELS
#: Hex digits of a digest.
DIGITS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WITNESS = T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("siblings", T.StringType())]))
_UPPER = [T.StructField("witness", WITNESS), T.StructField("subroot", T.StringType()),
          T.StructField("root", T.StringType())]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Appender:
    """A tree that grows by appends in order; ``witness[i]`` is the (place, siblings) list of the ``i``-th node so far."""

    def __init__(self):
        self.witness: list[list[tuple[int, str]]] = []
        self.runs: list[list[tuple[str, list[int]]]] = [[]]  # open run of each level: digest, nodes below

    def append(self, node: str) -> None:
        self.witness.append([])
        self._add(0, node, [len(self.witness) - 1])

    def _add(self, level: int, node: str, below: list[int]) -> None:
        if level == len(self.runs):
            self.runs.append([])
        self.runs[level].append((node, below))
        if len(self.runs[level]) == ARITY:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        digests = [node for node, _ in run]
        for place, (_, below) in enumerate(run):
            siblings = "".join(digests[:place] + digests[place + 1:])
            for i in below:
                self.witness[i].append((place, siblings))
        self._add(level + 1, digest("".join(digests)), [i for _, below in run for i in below])

    def finish(self, levels: int | None = None) -> str:
        """Close the open runs from below, up to ``levels`` or until one node remains; returns that node."""
        level = 0
        while level < (len(self.runs) if levels is None else levels):
            alone = levels is None and len(self.runs[level]) == 1 and not any(self.runs[level + 1:])
            if self.runs[level] and not alone:
                self._close(level)
            level += 1
        return next(run[0][0] for run in reversed(self.runs) if run)


def field(column: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def folded(node: Column, witness: Column) -> Column:
    """The root that a node and its witness give."""
    return F.aggregate(witness, node, lambda h, w: F.sha2(F.concat(
        F.substr(w["siblings"], F.lit(1), DIGITS * w["place"]), h,
        F.substr(w["siblings"], DIGITS * w["place"] + 1)), 256))


def proof(witness: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda w: w["siblings"]), ""), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within its ``tree`` by ``order``, and the tree's ``total``."""
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = stage(dealt.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    runs = dealt.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # one row per partition and tree: as many as partitions and trees together
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("part", "tree", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("n").over(tree).alias("total"))
    return dealt.join(runs, ["part", "tree"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "total")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block, whole and in order."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, block in groupby(rows, key=lambda r: (r["tree"], r["block"])):
        yield list(block)


def _grow(rows: list[dict]) -> tuple[Appender, str]:
    """An appender over a block's nodes: a tree of one block ends at one node, others at the block's level."""
    grown = Appender()
    for row in rows:
        grown.append(row["digest"])
    return grown, grown.finish(LEVELS if rows[0]["total"] > BLOCK else None)


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _blocks(batches):
        _, root = _grow(rows)
        columns = [[rows[0]["tree"]], [rows[0]["block"]], [-(-rows[0]["total"] // BLOCK)], [root]]
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                         names=["tree", "pos", "total", "digest"])


def climb(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, pos, total, digest, ...), then the block roots of each round, until every tree has one.

    A tree leaves with the round in which its ``total`` becomes one.
    """
    rounds, go = [nodes], True
    while go:
        open_nodes = rounds[-1] if len(rounds) == 1 else rounds[-1].where("total > 1")
        placed = open_nodes.select("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "total", "digest")
        roots = _in_blocks(placed).mapInArrow(_climb, "tree string, pos bigint, total bigint, digest string")
        rounds.append(stage(roots, "merkle-round"))
        go = bool(rounds[-1].where("total > 1").limit(1).count())
    return rounds


def _witness_column(witnesses: list[list[tuple[int, str]]], kind: pa.DataType) -> pa.Array:
    offsets = [0]
    for w in witnesses:
        offsets.append(offsets[-1] + len(w))
    flat = [step for w in witnesses for step in w]
    steps = pa.StructArray.from_arrays([pa.array([p for p, _ in flat], pa.int32()), pa.array([s for _, s in flat], pa.string())],
                                       fields=list(kind.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps, type=kind)


def _descend(schema: pa.Schema):
    """Blocks of (one row with the block's own witness, then its nodes) -> nodes with their witnesses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            above, nodes = rows[0], rows[1:]
            upper = [(w["place"], w["siblings"]) for w in above["witness"]]
            grown, _ = _grow(nodes)
            for low in range(0, len(nodes), 1024):
                part = nodes[low:low + 1024]
                witness = [w + upper for w in grown.witness[low:low + 1024]]
                columns = []
                for f in schema:
                    if f.name == "witness":
                        columns.append(_witness_column(witness, f.type))
                    elif f.name in ("subroot", "root"):
                        columns.append(pa.array([above[f.name]] * len(part), f.type))
                    else:
                        columns.append(pa.array([r[f.name] for r in part], f.type))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def descend(rounds: list[DataFrame], upper: DataFrame) -> DataFrame:
    """The nodes of ``rounds[0]`` with ``witness, subroot, root``; ``upper`` has them for each tree."""
    below = None  # witnessed block roots of the round above
    for r in range(len(rounds) - 2, -1, -1):
        nodes = (rounds[r] if r == 0 else rounds[r].where("total > 1")).withColumn("block", F.floor(F.col("pos") / BLOCK))
        ends = rounds[r + 1].where("total = 1").select("tree", F.lit(0).cast("long").alias("block"))
        above = ends.join(upper, "tree")
        if below is not None:
            above = above.unionByName(below.select("tree", F.col("pos").alias("block"), "witness", "subroot", "root"))
        carried = [f for f in rounds[r].schema.fields if f.name not in ("tree", "pos")]
        schema = T.StructType([*[rounds[r].schema[c] for c in ("tree", "pos")], *carried, *_UPPER])
        both = nodes.unionByName(above.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        below = _in_blocks(both).mapInArrow(_descend(to_arrow_schema(schema)), schema)
    return below


def manifest(leaves: DataFrame) -> DataFrame:
    """Leaves (``tree`` text, ``id``, ``digest``, any more columns) with ``pos, total, witness, subroot, root``.

    ``tree`` orders the groups bytewise. A witness lists (place among the siblings, their digests) from the leaf to the
    root; ``folded(digest, witness)`` gives the root.
    """
    placed = numbered(leaves.withColumn("row", F.monotonically_increasing_id()), ["id", "digest", "row"]).drop("row")
    rounds = climb(stage(placed, "merkle-leaves"))
    ends = [r.where("total = 1").select("tree", "digest") for r in rounds[1:]]
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.unionByName(more)
    groups = climb(stage(numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest"),
                                  ["group"]), "merkle-groups"))
    top = groups[-1].where("total = 1").select(
        "tree", F.array().cast(WITNESS).alias("witness"), F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"))
    upper = descend(groups, top).select(F.col("group").alias("tree"), "witness", F.col("digest").alias("subroot"), "root")
    return descend(rounds, stage(upper, "merkle-upper"))


def leaf_rows(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
              altered: dict[str, Column] | None = None, altered_where: Column | None = None) -> DataFrame:
    """``tree, id, digest`` of every row; ``altered`` is the digest after changes of columns where the rule holds."""
    columns = [by_name(c) for c in fields]
    tree = F.coalesce(F.concat(F.lit("s"), by_name(group_col).cast("string")), F.lit("n"))
    out = [tree.alias("tree"), by_name(id_col).alias("id"), leaf(columns).alias("digest")]
    if altered:
        changed = leaf([altered.get(c, by_name(c)) for c in fields])
        out.append(F.when(altered_where, changed).alias("altered"))
    return docs.select(*out)


def tamper_report(docs: DataFrame, one_in: int = 5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The manifest of the documents, checked against a copy in which one document in ``one_in`` was lower-cased.

    The rule is ``one_in`` divides the crc32 of the decimal id (never for a null id); a null text stays null.
    """
    lower = F.translate(by_name(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(by_name(id_col).cast("string")) % one_in == 0
    leaves = stage(leaf_rows(docs, altered={text_col: lower}, altered_where=hit), "merkle-digests")
    rows = manifest(leaves)
    found = rows.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root",
                        proof(F.col("witness")).alias("proof_sha256"),
                        folded(F.coalesce("altered", "digest"), F.col("witness")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
