"""A Merkle manifest of a dataset, by checkpoint and recompute.

Every row is a leaf; the leaves of a language form a tree in the order of their ids, and
the subroots of the languages form the top tree. Of all levels only every ``LEVELS``-th
is stored. What lies between two stored levels is an aligned subtree over at most
``2**LEVELS`` stored nodes: a proof needs its interior nodes, which are made again from
the stored nodes below, give the siblings, and are dropped.

1. Leaves are hashed where the texts are; only hashes and ids move on. They are numbered
   within their language by ranges of (language, id), so a language with a third of all
   rows fills many tasks.
2. Each aligned subtree is reduced to its root, which gives the next stored level, until
   every language has one node. The subroots form a tree in the same way.
3. Proofs go from the top down: a node's steps to the root are added to the nodes of
   its subtree together with their siblings there.

A task holds one subtree at a time. Shuffles carry rows of some hundred bytes, never
texts. Everything stored is a Parquet table below one folder, so a later session can
extract proofs again.

A null value is the field ``-``, so it differs from an empty text. Texts of any length
are hashed whole. Rows without an id come first, and rows of one id are ordered by their
hash; rows that are equal in all fields are leaves of their own with proofs of their
own. Columns beyond the five fields are not looked at, whatever their names. An empty
table has no root and no proofs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import map_arrow, numbered
from paystrata.session import new_folder

LEVELS = 10  # levels from one stored level to the next
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# How a step to the parent hashes: with a sibling before or after the node, or alone.
BEFORE, AFTER, ALONE = "<", ">", "="


def field(value: Column) -> Column:
    """A value with its length, so that fields cannot run into each other."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf(altered: dict[str, Column] | None = None) -> Column:
    """The hash of a row, some of its columns replaced."""
    values = {name: F.col(name) for name in FIELDS} | (altered or {})
    return F.sha2(F.concat(*[field(values[name]) for name in FIELDS]).cast("binary"), 256)


def tree_name() -> Column:
    """The language as a text that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit(":"), F.col("lang")), F.lit("-"))


def parents(nodes: list[str]) -> list[str]:
    pairs = ("".join(nodes[i : i + 2]) for i in range(0, len(nodes), 2))
    return [sha256(pair.encode()).hexdigest() for pair in pairs]


def height(n: int, levels: int) -> int:
    """Levels of an aligned subtree of a tree that has ``n`` nodes on the stored level."""
    return min(levels, (n - 1).bit_length())


def interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The subtree's levels from the stored nodes to its root."""
    made = [nodes]
    for _ in range(levels):
        made.append(parents(made[-1]))
    return made


def steps_of(made: list[list[str]], place: int) -> list[str]:
    """How the node at ``place`` comes to the subtree's root."""
    steps = []
    for level in made[:-1]:
        other = place ^ 1
        if other >= len(level):
            steps.append(ALONE)
        else:
            steps.append((BEFORE if other < place else AFTER) + level[other])
        place >>= 1
    return steps


def fold(node: str, steps: list[str]) -> str:
    """The root that a node and its steps give."""
    for step in steps:
        side, other = step[0], step[1:]
        node = sha256((other + node if side == BEFORE else node + other).encode()).hexdigest()
    return node


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in order of (tree, block) as tables of whole blocks, with the blocks' edges.

    Only the last block of a batch waits for the next batch.
    """
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        table = table.combine_chunks()
        if len(table) < 2:
            waiting = table
            continue
        new = np.zeros(len(table) - 1, dtype=bool)
        for name in ("tree", "block"):
            column = table.column(name)
            changed = pc.not_equal(column.slice(1), column.slice(0, len(table) - 1))
            new |= changed.to_numpy(zero_copy_only=False)
        edges = np.concatenate(([0], np.flatnonzero(new) + 1))
        last = int(edges[-1])
        if last:
            yield table.slice(0, last), edges
        waiting = table.slice(last)
    if waiting is not None and len(waiting):
        yield waiting, np.array([0, len(waiting)])


def _lift(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """The root of each subtree."""
    for table, edges in _subtrees(batches):
        first = pa.array(edges[:-1])
        nodes, n = table.column("node").to_pylist(), table.column("n").take(first).to_pylist()
        roots = [
            interior(nodes[a:b], height(count, levels))[-1][0]
            for a, b, count in zip(edges[:-1].tolist(), edges[1:].tolist(), n)
        ]
        yield pa.RecordBatch.from_arrays(
            [table.column("tree").take(first).combine_chunks(),
             table.column("block").take(first).combine_chunks(),
             pa.array([-(-count >> levels) for count in n], pa.int64()), pa.array(roots, pa.string())],
            ["tree", "pos", "n", "node"],
        )


def _regenerated(
    batches: Iterator[pa.RecordBatch], levels: int
) -> Iterator[tuple[pa.Table, list[int], list[list[str]], list[str | None]]]:
    """Per table of subtrees: its node rows, their steps to the root, and their subroot.

    The first row of a subtree is its root's own way up; the others are its stored nodes.
    """
    for table, edges in _subtrees(batches):
        nodes, n = table.column("node").to_pylist(), table.column("n").to_pylist()
        first = pa.array(edges[:-1])
        above = table.column("steps").take(first).to_pylist()
        subroots = table.column("subroot").take(first).to_pylist()
        rows, steps, roots = [], [], []
        for a, b, up, root in zip(edges[:-1].tolist(), edges[1:].tolist(), above, subroots):
            made = interior(nodes[a + 1 : b], height(n[a + 1], levels))
            for place in range(b - a - 1):
                rows.append(a + 1 + place)
                steps.append(steps_of(made, place) + up)
                roots.append(root)
        yield table, rows, steps, roots


def _descend(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Each node's own way up, for the subtree below it."""
    for table, rows, steps, roots in _regenerated(batches, levels):
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [table.column("tree").take(take).combine_chunks(),
             table.column("pos").take(take).combine_chunks(),
             pa.array(steps, pa.list_(pa.string())), pa.array(roots, pa.string())],
            ["tree", "block", "steps", "subroot"],
        )


def _proofs(
    batches: Iterator[pa.RecordBatch], levels: int, with_steps: bool
) -> Iterator[pa.RecordBatch]:
    for table, rows, steps, roots in _regenerated(batches, levels):
        take = pa.array(rows, pa.int64())
        names = ["doc_id", "node", "claimed"]
        columns = [table.column(name).take(take).combine_chunks() for name in names]
        claimed = columns[-1].to_pylist()
        proofs = [sha256("".join([s[1:] for s in way]).encode()).hexdigest() for way in steps]
        folded = [fold(node, way) for node, way in zip(claimed, steps)]
        columns += [pa.array(roots, pa.string()), pa.array(proofs, pa.string()),
                    pa.array(folded, pa.string())]
        names += ["subroot", "proof_sha256", "folded_root"]
        if with_steps:
            columns.append(pa.array(steps, pa.list_(pa.string())))
            names.append("steps")
        yield pa.RecordBatch.from_arrays(columns, names)


_NODE = "tree string, pos bigint, n bigint, node string"
_WAY = "tree string, block bigint, steps array<string>, subroot string"


class Manifest:
    """The stored levels of the languages' trees and of the top tree below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, levels: int = LEVELS):
        self.spark, self.folder, self.levels = spark, folder.rstrip("/"), levels
        self._heights: dict[str, int] = {}

    def _path(self, part: str, level: int) -> str:
        return f"{self.folder}/{part}/level_{level}"

    def _store(self, frame: DataFrame, part: str, level: int) -> DataFrame:
        frame.write.parquet(self._path(part, level))
        return self.stored(part, level)

    def stored(self, part: str, level: int) -> DataFrame:
        """A stored level of the ``languages`` or of the ``top``."""
        return self.spark.read.parquet(self._path(part, level))

    def _dealt(self, nodes: DataFrame) -> DataFrame:
        """Rows by subtree and place; ways, which have no place, come first."""
        return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def _blocks(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.shiftright("pos", self.levels))

    def build(self, rows: DataFrame, part: str) -> DataFrame:
        """Store the levels over numbered ``rows``; gives the roots of the trees."""
        nodes, level = self._store(rows, part, 0), 0
        # trees that are done pass through, so that all roots are on the last level
        while nodes.where("n > 1").limit(1).count():
            level += self.levels
            dealt = self._dealt(self._blocks(nodes.select("tree", "pos", "n", "node")))
            nodes = self._store(
                map_arrow(dealt, partial(_lift, levels=self.levels), _NODE), part, level
            )
        return nodes

    def height(self, part: str) -> int:
        """The last stored level."""
        if part not in self._heights:
            largest = self.stored(part, 0).agg(F.max("n")).first()[0] or 1
            self._heights[part] = -(-height(largest, 64) // self.levels) * self.levels
        return self._heights[part]

    def root(self) -> str | None:
        row = self.stored("top", self.height("top")).first()
        return row["node"] if row else None

    def _with_ways(self, part: str, level: int, ways: DataFrame) -> DataFrame:
        nodes = self._blocks(self.stored(part, level))
        return self._dealt(nodes.unionByName(ways, allowMissingColumns=True))

    def _down(self, part: str, ways: DataFrame) -> DataFrame:
        """The ways of the nodes on the lowest stored level above the leaves."""
        for level in range(self.height(part) - self.levels, 0, -self.levels):
            ways = map_arrow(
                self._with_ways(part, level, ways), partial(_descend, levels=self.levels), _WAY
            )
        return ways

    def proofs(self, with_steps: bool = True) -> DataFrame:
        """Per leaf its hash, subroot, proof and the root that the claimed row gives.

        ``steps`` has the siblings from the leaf to the root, each after a mark of its side.
        """
        nothing = F.array().cast("array<string>").alias("steps")
        ways = self.stored("top", self.height("top")).select(
            "tree", F.col("pos").alias("block"), nothing, F.lit(None).cast("string").alias("subroot")
        )
        top = map_arrow(
            self._with_ways("top", 0, self._down("top", ways)),
            partial(_descend, levels=self.levels), _WAY,
        )
        languages = self.stored("top", 0).select(
            F.col("pos").alias("block"), F.col("name").alias("tree"), F.col("node").alias("subroot")
        )
        ways = top.drop("tree", "subroot").join(languages, "block").select(
            "tree", F.lit(0).cast("long").alias("block"), "steps", "subroot"
        )
        kind = self.stored("languages", 0).schema["doc_id"].dataType.simpleString()
        schema = (
            f"doc_id {kind}, node string, claimed string, subroot string, "
            "proof_sha256 string, folded_root string" + (", steps array<string>" if with_steps else "")
        )
        return map_arrow(
            self._with_ways("languages", 0, self._down("languages", ways)),
            partial(_proofs, levels=self.levels, with_steps=with_steps), schema,
        )


def build(
    documents: DataFrame, altered: dict[str, Column] | None = None, folder: str | None = None,
    levels: int = LEVELS,
) -> Manifest:
    """The manifest of ``documents``.

    ``altered`` gives columns as a party to be checked claims them: each leaf is stored
    with the hash of the claimed row beside its own.
    """
    spark = documents.sparkSession
    manifest = Manifest(spark, folder or new_folder(spark, "merkle"), levels)
    leaves = documents.select(
        tree_name().alias("tree"), "doc_id", leaf().alias("node"), leaf(altered).alias("claimed")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("claimed")]
    roots = manifest.build(numbered(leaves, ["tree"], order, "merkle-leaves"), "languages")
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    manifest.build(numbered(tops, ["tree"], [F.col("name")], "merkle-subroots"), "top")
    return manifest


def tampered() -> dict[str, Column]:
    """One more character claimed where 7 divides the CRC of the id; null stays."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    return {"n_chars": F.when(chosen, more).otherwise(F.col("n_chars").cast("string"))}


def audit(documents: DataFrame) -> DataFrame:
    """Per row its leaf, roots and proof, and whether the tampered table still verifies."""
    manifest = build(documents, tampered())
    root = F.lit(manifest.root()).cast("string")
    return manifest.proofs(with_steps=False).select(
        "doc_id", F.col("node").alias("leaf"), "subroot", root.alias("root"), "proof_sha256",
        "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
