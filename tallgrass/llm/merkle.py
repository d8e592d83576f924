"""Merkle manifest of a table: one tree per group, one tree over the groups, a witness per row.

A node with up to three children is the hash of their digests.  Leaves are appended in order to
open subtrees.  Each open subtree knows the leaves below it, and each leaf holds a partial
witness: its siblings so far.  When a run of siblings is complete, the witnesses of all
leaves below it are extended by one step and the run becomes one node of the next level.

A group is cut into aligned blocks of 3^height leaves, each grown in a task.  The roots of the
blocks are then appended in the same way, level by level, so no task holds more than one
block, whatever share of the rows a group has.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.plans.lineage import cut_lineage
from tallgrass.plans.ordering import row_index

#: Children of a node.
FANOUT = 3
#: Levels of a block: 6,561 leaves.
HEIGHT = 8
_STEPS = "array<struct<before: binary, after: binary>>"
_GROWN = f"tree string, block long, pos long, digest binary, steps {_STEPS}"


class OpenTree:
    """Nodes waiting for their siblings, by level, and the witness of every leaf so far."""

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.witness: list[list[tuple[bytes, bytes]]] = []

    def append(self, digest: bytes) -> None:
        leaf = len(self.witness)
        self.witness.append([])
        self._add(0, (digest, leaf, leaf + 1))

    def _add(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _, _ in run]
        for at, (_, first, end) in enumerate(run):
            step = (b"".join(digests[:at]), b"".join(digests[at + 1 :]))
            for leaf in range(first, end):
                self.witness[leaf].append(step)
        parent = hashlib.sha256(b"".join(digests).hex().encode()).digest()
        self._add(level + 1, (parent, run[0][1], run[-1][2]))

    def close(self, height: int | None = None) -> bytes:
        """The root: on level ``height``, or on the first level with a single node."""
        level = 0
        while height is None or level < height:
            if height is None and len(self.open[level]) == 1 and not any(self.open[level + 1 :]):
                break
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def _grow_block(height: int):
    """Witnesses and root of one block: its rows, and one row without a position for the root."""

    def grow(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("pos").to_numpy(), kind="stable")))
        tree, block = table.column("tree")[0].as_py(), table.column("block")[0].as_py()
        grown = OpenTree()
        for digest in table.column("digest").to_pylist():
            grown.append(digest)
        root = grown.close(height if table.column("size")[0].as_py() > FANOUT**height else None)
        rows = table.num_rows
        ends = np.cumsum([0, *(len(w) for w in grown.witness), 0]).astype(np.int32)
        flat = [step for witness in grown.witness for step in witness]
        steps = pa.StructArray.from_arrays(
            [pa.array([s[0] for s in flat], pa.binary()), pa.array([s[1] for s in flat], pa.binary())], names=["before", "after"]
        )
        return pa.table({
            "tree": pa.array([tree] * (rows + 1), pa.string()),
            "block": pa.array([block] * (rows + 1), pa.int64()),
            "pos": pa.array([*table.column("pos").to_pylist(), None], pa.int64()),
            "digest": pa.array([None] * rows + [root], pa.binary()),
            "steps": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps),
        })

    return grow


def _grow(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """Of nodes (tree, pos, size, digest): (tree, pos, steps to the root), and (tree, root)."""
    width = FANOUT**height
    largest = nodes.agg(F.max("size")).first()[0] or 0
    blocks = nodes.withColumn("block", F.expr(f"pos div {width}"))
    grown = cut_lineage(blocks.groupBy("tree", "block").applyInArrow(_grow_block(height), _GROWN))
    leaves = grown.where("pos IS NOT NULL").select("tree", "block", "pos", "steps")
    tops = grown.where("pos IS NULL").select("tree", F.col("block").alias("pos"), "digest")
    if largest <= width:
        return leaves.drop("block"), tops.select("tree", F.col("digest").alias("root"))
    # the roots of blocks are the next appends; a tree of one block ends here
    sizes = tops.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
    above, roots = _grow(cut_lineage(tops.join(sizes, "tree")), height)
    above = above.select("tree", F.col("pos").alias("block"), F.col("steps").alias("_above"))
    whole = leaves.join(above, ["tree", "block"]).select("tree", "pos", F.concat("steps", "_above").alias("steps"))
    return whole, roots


def _placed(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Rows with ``pos`` inside their ``tree`` under the order, and the ``size`` of the tree."""
    indexed = row_index(rows, "tree", *order, name="_index")
    spans = indexed.groupBy("tree").agg(F.min("_index").alias("_first"), F.count(F.lit(1)).alias("size"))
    return indexed.join(spans, "tree").withColumn("pos", F.col("_index") - F.col("_first")).drop("_index", "_first")


def field_text(column: Column | str) -> Column:
    """``-`` for NULL, else the byte count of the value's text, a colon and the text."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*columns: Column | str) -> Column:
    """Lowercase hex sha256 over the fields of a row."""
    return F.sha2(F.concat(*[field_text(c) for c in columns]).cast("binary"), 256)


def manifest(rows: DataFrame, leaf: Column, tree: str, key: str, keep: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """(key, tree, leaf, *keep, steps, subroot, root), one row per row.

    ``leaf`` is the hex digest of a row.  Rows of equal ``tree`` make one tree, ascending by
    ``key`` (NULL first, equal keys by digest); the roots of the trees, ascending by
    ``tree`` (NULL first, by bytes), make the last one.  ``steps`` are the siblings of a row on
    each level, before and after its own node, as raw digests; a single row has none.
    ``keep`` names columns to carry along.  Rows that repeat all values are leaves of their own.
    No rows give no rows.
    """
    if height < 1:
        raise ValueError("height must be at least 1")
    keep = keep or {}
    # one text that is never NULL and sorts as the group does
    group = F.coalesce(F.concat(F.lit("="), F.col(tree)), F.lit(""))
    kept = [value.alias(f"_keep_{name}") for name, value in keep.items()]
    leaves = cut_lineage(rows.select(
        group.alias("tree"), F.col(key).alias("_key"), F.unhex(leaf).alias("digest"), *kept,
        F.monotonically_increasing_id().alias("_row"),
    ))
    placed = cut_lineage(_placed(leaves, F.asc_nulls_first("_key"), "digest", "_row").drop("_row"))
    steps, subroots = _grow(placed.select("tree", "pos", "size", "digest"), height)
    subroots = cut_lineage(subroots)
    one = row_index(subroots, "tree", name="pos").select(
        F.lit("").alias("tree"), "pos", F.col("root").alias("digest"), F.col("tree").alias("_group")
    )
    top = cut_lineage(one)
    # the number of trees and the root of all: two values
    upper, roots = _grow(top.drop("_group").withColumn("size", F.lit(top.count())), height)
    found = roots.first()
    root = hex_text(F.lit(bytes(found["root"]))) if found else F.lit(None).cast("string")
    per_group = top.select(F.col("_group").alias("tree"), F.col("digest").alias("subroot"), "pos").join(
        upper.select("pos", F.col("steps").alias("_upper")), "pos"
    )
    joined = placed.drop("size").join(steps, ["tree", "pos"]).join(per_group.drop("pos"), "tree")
    return joined.select(
        F.col("_key").alias(key), F.expr("CASE WHEN tree <> '' THEN substr(tree, 2) END").alias(tree),
        hex_text("digest").alias("leaf"), *[F.col(f"_keep_{n}").alias(n) for n in keep],
        F.concat("steps", "_upper").alias("steps"), hex_text("subroot").alias("subroot"), root.alias("root"),
    )


def hex_text(column: Column | str) -> Column:
    return F.lower(F.hex(column))


def folded(leaf: Column | str, steps: Column | str) -> Column:
    """The root that a leaf digest and the siblings of a witness lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf

    def up(node: Column, step: Column) -> Column:
        return F.sha2(F.concat(hex_text(step["before"]), node, hex_text(step["after"])).cast("binary"), 256)

    return F.aggregate(steps, start, up)


def proof_digest(steps: Column | str) -> Column:
    """One digest over all siblings of a witness, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: hex_text(F.concat(s["before"], s["after"]))), "").cast("binary"), 256)
