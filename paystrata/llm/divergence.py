"""How far the sources of a language use its terms differently, by K-squared quadtrees.

A term is a run of letters, only A-Z lowered. A language keeps the terms of at least
``LEAST_DOCUMENTS`` of its documents. Each (language, source) group gives each kept term
the weight ``p = 1 + SCALE * (count + 1) // (N + V)`` for its N kept occurrences and the
V kept terms, and the divergence at a term is ``(p - q) ** 2 // q``. Everything is exact.

1. Tasks count terms per group, up to ``ENTRIES`` different ones at a time, so that a
   frequent term or a hot source sends one row for many texts.
2. The nonzero counts of a language are cells of a matrix of groups by terms. It is cut
   into tiles of ``ROWS`` groups, in order of their size, by about ``COLUMNS`` terms, which
   a hash deals and the task orders by the number of their cells, so that most of a tile's
   area is empty squares. Two tiles of the same terms meet in a task.
3. There each tile is a K-squared quadtree: a square that holds a cell is cut into
   ``K * K`` squares, level by level, down to cells. The trees of two tiles are traversed
   together: where the quadrants of both row blocks are empty, all their pairs get the
   divergence of the two weights of count zero once per term, by number; the others go
   on, and cells are compared one by one in both directions.
4. Terms that no group of either tile has are priced by number as well, at the end.

No task holds more than the cells of two tiles; a language with a third of all texts is
many tiles. The result has one row per ordered pair of a language's sources, so it is
quadratic in them by nature; the work on cells is not, but where both have cells.

Null text, language and source are taken as empty texts, and groups without terms take
part. Without kept terms all pairs have the value 0 and there are no term rows. Texts of
any length are read whole. Ties are ordered by item. An empty table gives an empty
result. Columns beyond ``text``, ``lang`` and ``source`` are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paystrata.llm.common import cut, map_arrow, numbered, tell_workers

LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TERM_RANKS = 200
K = 4
ROWS, COLUMNS = 32, 1024
FRONTIER = 1 << 20  # squares that are opened at a time
ENTRIES = 400_000  # counts that a task holds before it passes them on
FEW_GROUPS = 50_000

# Bytes of terms, A-Z lowered; all others become a space.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of many texts at a time."""
    counts: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.binary())):
            total, documents = counts.setdefault((lang, source), (Counter(), Counter()))
            size -= len(total)
            found = terms(text.as_py())
            total.update(found)
            documents.update(set(found))
            size += len(total)
            if size > ENTRIES:
                yield from _counted(counts)
                counts, size = {}, 0
    yield from _counted(counts)


def _counted(counts: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (total, documents) in counts.items():
        size = len(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
             pa.array(list(total), pa.binary()).cast(pa.string()),
             pa.array(list(total.values()), pa.int64()),
             pa.array([documents[term] for term in total], pa.int64())],
            ["lang", "source", "term", "count", "docs"],
        )


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
          for name in ("lang", "source", "text")]
    )


def kept_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, count, in_lang, leads): the nonzero counts of kept terms.

    ``in_lang`` counts the whole language, and one row of each (lang, term) leads. The
    tasks have summed most up already, so rows are dealt by term before the rest is.
    """
    counts = map_arrow(
        _plain(documents), _count_rows,
        "lang string, source string, term string, count bigint, docs bigint",
    )
    counts = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )
    of_term = Window.partitionBy("lang", "term")
    return counts.select(
        "lang", "source", "term", "count", F.sum("count").over(of_term).alias("in_lang"),
        F.sum("docs").over(of_term).alias("docs"),
        (F.min("source").over(of_term) == F.col("source")).alias("leads"),
    ).where(F.col("docs") >= LEAST_DOCUMENTS).drop("docs")


def weight(count: Column, n: Column, v: Column) -> Column:
    """The weight of a count, in integers of any size."""
    wide = (count.cast("decimal(27,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", wide, (n + v).cast("decimal(38,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Tree:
    """The K-squared quadtree of a tile: per level the squares that hold a cell, sorted.

    A square's code is its row block times the level's column blocks plus its column block.
    """

    def __init__(
        self, row: np.ndarray, column: np.ndarray, weight: np.ndarray, width: int
    ) -> None:
        self.depth, side = 0, 1
        while side < max(ROWS, width):
            self.depth, side = self.depth + 1, side * K
        self.squares = []
        for level in range(self.depth + 1):
            edge = K ** (self.depth - level)
            self.squares.append(np.unique((row // edge) * K**level + column // edge))
        code = row * K**self.depth + column
        order = np.argsort(code)
        self.weights = weight[order]

    def find(self, level: int, row: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the level's squares, and whether the square is there."""
        known, code = self.squares[level], row * K**level + column
        at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
        return at, known[at] == code if len(known) else np.zeros(len(code), dtype=bool)


def price_pairs(
    left: Tree, right: Tree, zero_left: np.ndarray, zero_right: np.ndarray, width: int, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Divergences of each group of ``left`` from each of ``right``, and the other way.

    ``zero_left`` and ``zero_right`` are the weights of a count of zero, one per group,
    and ``width`` is the number of terms of the tiles. With ``same`` both are one tile,
    and only pairs in ascending order are met.
    """
    shape = len(zero_left), len(zero_right)
    forth, back = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
    empty = np.zeros(shape, dtype=np.int64)  # terms of empty quadrants, per pair
    child = np.stack(np.meshgrid(*[np.arange(K)] * 3, indexing="ij")).reshape(3, -1)
    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b, c = stack.pop()
        at_left, in_left = left.find(level, a, c)
        at_right, in_right = right.find(level, b, c)
        edge = K ** (left.depth - level)
        none = ~(in_left | in_right)
        if none.any():
            blocks = -(-shape[0] // edge), -(-shape[1] // edge)
            terms_of = np.zeros(blocks, dtype=np.int64)
            columns = np.minimum(c[none] * edge + edge, width) - c[none] * edge
            np.add.at(terms_of, (a[none], b[none]), columns)
            empty += np.repeat(np.repeat(terms_of, edge, 0)[: shape[0]], edge, 1)[:, : shape[1]]
            going = ~none
            a, b, c = a[going], b[going], c[going]
            at_left, in_left, at_right, in_right = (
                x[going] for x in (at_left, in_left, at_right, in_right)
            )
        if level == left.depth:
            p, q = zero_left[a], zero_right[b]
            p[in_left] = left.weights[at_left[in_left]]
            q[in_right] = right.weights[at_right[in_right]]
            square = (p - q) * (p - q)
            np.add.at(forth, (a, b), square // q)
            np.add.at(back, (a, b), square // p)
            continue
        step = max(1, FRONTIER // child.shape[1])
        edge //= K
        for begin in range(0, len(a), step):
            x, y, z = (
                (v[begin : begin + step, None] * K + child[k]).ravel() for k, v in enumerate((a, b, c))
            )
            inside = (x * edge < shape[0]) & (y * edge < shape[1]) & (z * edge < width)
            if same:
                inside &= x <= y
            stack.append((level + 1, x[inside], y[inside], z[inside]))
    gap = zero_left[:, None] - zero_right[None, :]
    forth += empty * (gap * gap // zero_right[None, :])
    back += empty * (gap * gap // zero_left[:, None])
    return forth, back


_PAIR = "lang string, a bigint, b bigint, forth bigint, back bigint, terms bigint"


def _price_table(key: tuple, table: pa.Table) -> pa.Table:
    """All pairs of groups of two tiles. Rows without a term give a group's weight of zero."""
    lang, _, i, j = (k.as_py() for k in key)
    group, weight = table.column("g").to_numpy(), table.column("p").to_numpy()
    term = table.column("term").combine_chunks()
    head = term.is_null().to_numpy(zero_copy_only=False)
    coded = term.filter(pa.array(~head)).dictionary_encode()
    code = coded.indices.to_numpy()
    # terms that most groups have come first
    order = np.argsort(-np.bincount(code, minlength=len(coded.dictionary)), kind="stable")
    column = np.empty(len(order), dtype=np.int64)
    column[order] = np.arange(len(order))
    column, width = column[code], len(order)
    cell_group, cell_weight = group[~head], weight[~head]
    trees, zeros, groups = [], [], []
    for block in (i,) if i == j else (i, j):
        here = head & (group // ROWS == block)
        by_group = np.argsort(group[here])
        groups.append(group[here][by_group])
        zeros.append(weight[here][by_group])
        cell = cell_group // ROWS == block
        trees.append(Tree(cell_group[cell] - block * ROWS, column[cell], cell_weight[cell], width))
    if i == j:
        trees, zeros, groups = trees * 2, zeros * 2, groups * 2
    forth, back = price_pairs(*trees, *zeros, width, i == j)
    a, b = np.repeat(groups[0], len(groups[1])), np.tile(groups[1], len(groups[0]))
    ascending = a < b
    values = [a, b, forth.ravel(), back.ravel(), np.full(len(a), width)]
    return pa.table(
        [pa.array([lang] * int(ascending.sum()), pa.string())]
        + [pa.array(v[ascending].astype(np.int64)) for v in values],
        names=["lang", "a", "b", "forth", "back", "terms"],
    )


def _groups(documents: DataFrame, counts: DataFrame) -> DataFrame:
    """A row per (lang, source): its place by size, its size, its language's size, terms and
    groups, and its weight of zero."""
    sizes = counts.groupBy("lang", "source").agg(F.sum("count").alias("size"))
    langs = counts.groupBy("lang").agg(
        F.sum("count").alias("total"), F.sum(F.col("leads").cast("long")).alias("v")
    )
    groups = (
        _plain(documents).select("lang", "source").distinct()
        .join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        .fillna(0, ["size", "total", "v"])
    )
    rows = numbered(groups, ["lang"], [F.desc("size"), F.col("source")], "term-groups")
    zero = F.when(F.col("v") > 0, weight(F.lit(0), F.col("size"), F.col("v")))
    return rows.select(
        "lang", "source", F.col("pos").alias("g"), "size", "total", F.col("n").alias("groups"),
        "v", zero.alias("p0"),
    )


def _tile_pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, forth, back, terms) for a < b, a row per pair of tiles with a cell."""
    blocks = F.ceil(F.col("groups") / ROWS).cast("long")
    tiles = F.ceil(F.col("v") / COLUMNS).cast("long")
    own, other = F.floor(F.col("g") / ROWS), F.col("other")
    placed = cells.select(
        "lang", F.pmod(F.xxhash64("term"), tiles).alias("tile"), "g", "term", "p",
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"),
    ).select(
        "lang", "tile", F.least(own, other).alias("i"), F.greatest(own, other).alias("j"),
        "g", "term", "p",
    )
    # every tile and pair of blocks gets the weights of zero of its groups
    heads = groups.where("v > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("tile"),
    ).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"),
    ).select(
        "lang", "tile", F.least(own, other).alias("i"), F.greatest(own, other).alias("j"),
        "g", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"),
    )
    tell_workers(cells)
    return placed.unionByName(heads).groupBy("lang", "tile", "i", "j").applyInArrow(
        _price_table, _PAIR
    )


def audit(documents: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): divergences between sources, and terms."""
    counts = cut(kept_counts(documents), "term-counts")
    groups = cut(_groups(documents, counts), "sized-groups")
    # the groups go to all tasks only while they are known to be few
    few = F.broadcast(groups) if groups.count() <= FEW_GROUPS else groups
    cells = counts.join(few, ["lang", "source"]).select(
        "lang", "source", "g", "groups", "v", "term",
        weight(F.col("count"), F.col("size"), F.col("v")).alias("p"),
        weight(F.col("in_lang"), F.col("total"), F.col("v")).alias("q"),
    )
    return _pair_rows(cells, groups).unionByName(_term_rows(cells))


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if most:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _pair_rows(cells: DataFrame, groups: DataFrame) -> DataFrame:
    priced = _tile_pairs(cells, groups).groupBy("lang", "a", "b").agg(
        *[F.sum(name).alias(name) for name in ("forth", "back", "terms")]
    )
    names = ("source", "g", "p0")
    one = groups.select("lang", "v", *[F.col(n).alias(f"{n}_a") for n in names])
    two = groups.select("lang", *[F.col(n).alias(f"{n}_b") for n in names])
    pairs = one.join(two, "lang").where("g_a < g_b").join(
        priced.withColumnsRenamed({"a": "g_a", "b": "g_b"}), ["lang", "g_a", "g_b"], "left"
    ).fillna(0, ["forth", "back", "terms"])
    # the terms that neither has, beyond those of the tiles they met in
    rest = F.col("v") - F.col("terms")

    def row(source: str, item: str, met: str, p: str, q: str) -> Column:
        blank = F.coalesce(divergence(F.col(p), F.col(q)), F.lit(0))
        value = (F.col(met) + rest * blank).cast("long")
        return F.struct(
            F.col(source).alias("source"), F.col(item).alias("item"), value.alias("value")
        )

    both = F.array(
        row("source_a", "source_b", "forth", "p0_a", "p0_b"),
        row("source_b", "source_a", "back", "p0_b", "p0_a"),
    )
    return _ranked(pairs.select("lang", F.inline(both)), "pair")


def _term_rows(cells: DataFrame) -> DataFrame:
    """Terms that a group uses more than its language does."""
    rows = cells.where("p > q").select(
        "lang", "source", F.col("term").alias("item"),
        divergence(F.col("p"), F.col("q")).alias("value"),
    )
    return _ranked(rows, "term", TERM_RANKS)
