"""N-gram Jaccard join: links of 75 % or more, and the groups that they make.

The documents' sets of five-word shingles are the rows of a sparse matrix, the
shingles its columns. Texts with equal sets are one row, a class.

1. Columns are dealt into blocks by their hash, and each block is multiplied with
   its own transpose only as far as the diagonal needs: for each class it counts the
   shingles that no other class has. A partner at 75 % shares at least three quarters
   of a class's shingles, so a class with more than a quarter unshared can have no
   partner and is discarded. First half of the columns, chosen by hash alike for all
   classes, carry this bound (leaving columns out only weakens it), then, over the
   remaining classes, all of them. The counts also bound every overlap below.
2. The second pass also gives the number of classes that hold each column. A class's
   shared columns are put in order, rarest first; its prefix is so many of them that
   what follows is less than three quarters of the class. Two classes at 75 % meet in
   a column of both prefixes, and columns that many texts have in common come last, so
   that few classes still have them in the prefix.
3. In each column the class with the least share unshared, which near copies have
   most in common with, is the pivot, and its products with all others are verified
   exactly. This is linear in a column and joins near copies into components, also
   where thousands share a column.
4. Only classes that meet in a column and are still in different components remain.
   Their pairs are bounded by size and by place in the order, and verified exactly.

Pairs inside a component need no product, because it cannot change the groups; no
link between different components is left out, so the groups are exact.

Defined results: a text without words has an empty set, is linked with nothing and
is its own group; a text of fewer than five words has one shingle; equal texts, also
rows repeated under one id, have equal sets and are one group; a null id takes part
and its group takes the least id that is not null, if there is one; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import cut, map_arrow
from paystrata.llm.components import components
from paystrata.llm.texthash import chunks, mix, shingles, word_hashes

SIZE = 5
PERCENT = 75
ENTRIES_PER_BLOCK = 2_000_000
MIN_BLOCKS = 32
HALF = np.uint64(1 << 63)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for a, b in chunks(texts):
        words, begins = word_hashes(texts[a:b])
        for start, end in zip(begins[:-1], begins[1:]):
            yield np.unique(shingles(words[start:end], SIZE))


def _class_of(values: np.ndarray) -> tuple[int, int]:
    """Two numbers that stand for a set."""
    with np.errstate(over="ignore"):
        first = int(mix(values).sum(dtype=np.uint64))
        second = int(np.bitwise_xor.reduce(mix(values * np.uint64(0x9E3779B97F4A7C15))))
    return first, second


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _node(values: np.ndarray) -> int:
    first, second = _class_of(values)
    mixed = mix(np.array([first], dtype=np.uint64) ^ np.uint64(second))
    return _signed(int(mixed[0] ^ np.uint64(len(values))))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes = [], []
        for values in _sets(_texts(batch)):
            sizes.append(len(values))
            nodes.append(_node(values) if len(values) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
             pa.array(nodes, pa.int64())],
            ["doc_id", "text_key", "n_shingles", "node"],
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(_sets(_texts(batch)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([_node(v) for v in sets], pa.int64()),
             pa.array([len(v) for v in sets], pa.int32()),
             pa.array([v.view(np.int64) for v in sets], pa.list_(pa.int64()))],
            ["node", "n", "shingles"],
        )


def classes(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, node): every row with its class."""
    kind = dict(documents.dtypes)["doc_id"]
    return map_arrow(
        documents.select("doc_id", "text", F.xxhash64("text").alias("text_key")),
        _class_rows, f"doc_id {kind}, text_key bigint, n_shingles bigint, node bigint"
    )


def _entries(blocks: int, nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (block, nodes, owners, columns): one batch's entries in each block of columns."""
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(v) for v in sets])
    column = np.concatenate([*sets, np.empty(0, np.uint64)])
    # blocks by other bits than those that choose the half
    block = (column & np.uint64(0xFFFFFFFF)) * np.uint64(blocks) >> np.uint64(32)
    order = np.argsort(block, kind="stable")
    cuts = np.searchsorted(block[order], np.arange(blocks + 1))
    node_array = np.array(nodes, dtype=np.int64)
    rows = []
    for b in range(blocks):
        part = order[cuts[b] : cuts[b + 1]]
        if len(part):
            own, local = np.unique(owner[part], return_inverse=True)
            rows.append((b, node_array[own].tobytes(), local.astype(np.int32).tobytes(),
                         column[part].tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32())]
        + [pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)],
        ["block", "nodes", "owners", "columns"],
    )


ENTRY_TYPE = "block int, nodes binary, owners binary, columns binary"


def _half_entries(blocks: int):
    """Entries of the texts in the lower half of the columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}  # a copy within the batch adds nothing to its class
            for values in _sets(_texts(batch)):
                if len(values):
                    found.setdefault(_node(values), values[values < HALF])
            yield _entries(blocks, list(found), list(found.values()))

    return run


def _all_entries(blocks: int):
    """Entries of stored sets in all columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.asarray(v.values).view(np.uint64) for v in batch.column("shingles")]
            yield _entries(blocks, batch.column("node").to_pylist(), sets)

    return run


def _distinct_entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, column, holders) of one block's entries by column, copies counted once.

    ``holders`` is the number of classes that have the entry's column.
    """
    nodes, columns = [], []
    for own, local, column in zip(*(table.column(c).to_pylist() for c in ("nodes", "owners", "columns"))):
        nodes.append(np.frombuffer(own, np.int64)[np.frombuffer(local, np.int32)])
        columns.append(np.frombuffer(column, np.uint64))
    node, column = np.concatenate(nodes), np.concatenate(columns)
    order = np.lexsort((node, column))
    node, column = node[order], column[order]
    fresh_column = np.concatenate(([True], column[1:] != column[:-1]))
    fresh = fresh_column | np.concatenate(([True], node[1:] != node[:-1]))
    node, column = node[fresh], column[fresh]
    edges = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1], [True])))
    holders = np.diff(edges)
    return node, column, np.repeat(holders, holders)


def _unshared(key: tuple, table: pa.Table) -> pa.Table:
    """(node, unshared) of one block: its entries in columns that no other class has."""
    node, _, holders = _distinct_entries(table)
    lonely, count = np.unique(node[holders == 1], return_counts=True)
    return pa.table({"node": pa.array(lonely, pa.int64()), "unshared": pa.array(count, pa.int64())})


def _weighed(key: tuple, table: pa.Table) -> pa.Table:
    """(node, unshared, shared) of one block, the shared columns with their holders."""
    node, column, holders = _distinct_entries(table)
    order = np.argsort(node, kind="stable")
    node, column, holders = node[order], column[order], holders[order]
    begins = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    shared = holders > 1
    sizes = np.add.reduceat(shared.astype(np.int32), begins)
    entries = np.diff(np.append(begins, len(node)))
    columns = pa.StructArray.from_arrays(
        [pa.array(holders[shared], pa.int32()), pa.array(column[shared].view(np.int64))],
        ["holders", "column"],
    )
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pa.table({
        "node": pa.array(node[begins], pa.int64()),
        "unshared": pa.array(entries - sizes, pa.int32()),
        "shared": pa.ListArray.from_arrays(offsets, columns),
    })


WEIGHED_TYPE = "node bigint, unshared int, shared array<struct<holders: int, column: bigint>>"


def _may_link(unshared: Column, n: Column) -> Column:
    return 100 * unshared <= (100 - PERCENT) * n


def _blocks_for(entries: int) -> int:
    return max(MIN_BLOCKS, entries // ENTRIES_PER_BLOCK + 1)


def hopeful(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, n): classes that half of the columns do not rule out."""
    blocks = _blocks_for((rows.agg(F.sum("n_shingles")).first()[0] or 0) // 2)
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("n_shingles").cast("int").alias("n")
    )
    entries = map_arrow(documents.select("text"), _half_entries(blocks), ENTRY_TYPE)
    lonely = (
        entries.repartition(blocks, "block").groupBy("block")
        .applyInArrow(_unshared, "node bigint, unshared bigint")
        .groupBy("node").agg(F.sum("unshared").alias("unshared"))
    )
    unshared = F.coalesce("unshared", F.lit(0))
    return nodes.join(lonely, "node", "left").where(_may_link(unshared, F.col("n"))).select("node", "n")


def prefixes(sets: DataFrame) -> DataFrame:
    """(node, n, unshared, left, column): the prefix of each class that no column rules out.

    ``left`` is the number of the class's shared columns from this one on, and so the
    most that it can have in common with a class that it meets here first.
    """
    blocks = _blocks_for(sets.agg(F.sum("n")).first()[0] or 0)
    entries = map_arrow(sets.select("node", "shingles"), _all_entries(blocks), ENTRY_TYPE)
    whole = (
        entries.repartition(blocks, "block").groupBy("block").applyInArrow(_weighed, WEIGHED_TYPE)
        .groupBy("node").agg(
            F.sum("unshared").cast("int").alias("unshared"),
            F.array_sort(F.flatten(F.collect_list("shared"))).alias("shared"),
        )
        .withColumn("n", F.col("unshared") + F.size("shared"))
        .where(_may_link(F.col("unshared"), F.col("n")))
    )
    least = F.ceil(F.col("n") * PERCENT / 100).cast("int")
    return whole.select(
        "node", "n", "unshared", F.size("shared").alias("size"),
        F.posexplode(F.slice("shared", F.lit(1), F.size("shared") - least + 1)).alias("place", "entry"),
    ).select("node", "n", "unshared", (F.col("size") - F.col("place")).alias("left"), "entry.column")


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def products(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes with their overlap and whether they link."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    linked = 100 * F.col("overlap") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("overlap"))
    return (
        pairs.select("a", "b").join(two, "b").join(one, "a").withColumn("overlap", both)
        .select("a", "b", "overlap", linked.alias("linked"))
    )


def _pivots(entries: DataFrame) -> DataFrame:
    """(column, pivot, pivot_n): the class with the least share unshared, where classes meet."""
    order = F.struct((F.col("unshared") / F.col("n")).alias("share"), "node", "n")
    return (
        entries.groupBy("column").agg(F.min(order).alias("p"), F.count(F.lit(1)).alias("classes"))
        .where("classes > 1")
        .select("column", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"))
    )


def _pivot_pairs(entries: DataFrame, pivots: DataFrame) -> DataFrame:
    """The classes of each column against its pivot."""
    return (
        entries.join(pivots, "column").where(F.col("node") != F.col("pivot"))
        .where(_sizes_fit(F.col("n"), F.col("pivot_n")))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    )


def _cross_pairs(entries: DataFrame, pivots: DataFrame, groups: DataFrame) -> DataFrame:
    """All other pairs of a column between different components that can still link.

    In the first column that two classes share, neither can have more in common with
    the other than it has ``left``. Classes of the pivot's own component meet only
    those of others, so near copies of one text do not meet each other.
    """
    own = groups.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    whole = (
        entries.join(groups, "node", "left").join(pivots.select("column", "pivot"), "column")
        .where(F.col("node") != F.col("pivot")).join(own, "pivot", "left")
        .select(
            "column", "node", "n", "left", F.coalesce("component", "node").alias("component"),
            F.coalesce("pivot_component", "pivot").alias("pivot_component"),
        )
    )
    met = whole.groupBy("column").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where(F.col("low") != F.col("high")).select("column")
    some = cut(whole.join(met, "column"), "cross-entries")
    names = ("node", "n", "left", "component")
    apart = F.col("component") != F.col("pivot_component")
    a = some.where(apart).select("column", *[F.col(c).alias(f"a_{c}") for c in names])
    b = some.select("column", apart.alias("b_apart"), *[F.col(c).alias(f"b_{c}") for c in names])
    reaches = (100 + PERCENT) * F.least("a_left", "b_left") >= PERCENT * (F.col("a_n") + F.col("b_n"))
    return (
        a.join(b, "column").where(F.col("a_component") != F.col("b_component"))
        .where(~F.col("b_apart") | (F.col("a_node") < F.col("b_node")))
        .where(reaches & _sizes_fit(F.col("a_n"), F.col("b_n")))
        .select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
        .distinct()
    )


def class_groups(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, component) of the classes that link with another class."""
    left = cut(hopeful(documents, rows), "hopeful")
    one_row = rows.join(left.select("node"), "node", "left_semi").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key")).alias("r")
    ).select(F.col("r.doc_id").alias("_id"), F.col("r.text_key").alias("_key")).distinct()
    keyed = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    chosen = keyed.join(
        one_row.hint("shuffle_hash"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi",
    )
    sets = cut(
        map_arrow(chosen.select("text"), _set_rows, "node bigint, n int, shingles array<bigint>")
        .dropDuplicates(["node"]),
        "shingle-sets",
    )
    entries = cut(prefixes(sets), "prefix-entries")
    pivots = cut(_pivots(entries), "pivots")
    known = cut(products(_pivot_pairs(entries, pivots), sets), "products")
    links = known.where("linked").select("a", "b")
    groups = cut(components(links), "class-groups")
    found = products(_cross_pairs(entries, pivots, groups), sets)
    return components(links.union(found.where("linked").select("a", "b")))


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, with class and text key."""
    rows = cut(classes(documents), "shingle-classes")
    groups = cut(class_groups(documents, rows), "class-groups")
    whole = rows.join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = whole.where(F.col("node").isNotNull()).groupBy("component").agg(
        F.min("doc_id").alias("least")
    )
    return whole.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"),
        "text_key", F.col("node").alias("class"),
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each group, the one with the least id, with its own columns.

    Rows that share that id and group are told apart by their text and then by all
    other columns; of fully equal rows one stays.
    """
    rows = cut(classes(documents), "shingle-classes")
    groups = cut(class_groups(documents, rows), "class-groups")
    group = F.coalesce("component", "node")
    chosen = (
        rows.join(groups, "node", "left").where(F.col("node").isNotNull())
        .groupBy(group.alias("group"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_key")).alias("r"))
        .select(F.col("r.doc_id").alias("_j_id"), F.col("r.text_key").alias("_j_key")).distinct()
    )
    empty = rows.where(F.col("node").isNull()).select(
        F.col("doc_id").alias("_j_id"), F.col("text_key").alias("_j_key")
    ).distinct()
    keyed = documents.withColumn("_j_text", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_j_id")) & (F.col("_j_text") == F.col("_j_key"))
    kept = keyed.join(chosen.unionByName(empty).hint("shuffle_hash"), same, "left_semi")
    # equal ids and texts may stand on several rows: one of them stays
    return kept.dropDuplicates(["doc_id", "_j_text"]).drop("_j_text")
