"""Removal of long byte strings that stand more than once, by bucket refinement.

Every byte is removed that is covered by a string of ``WIDTH`` bytes which also
starts somewhere else, in the same text or another. The suffixes are sorted only
as far as that question needs, and only where it is open:

1. Initial buckets. Every text gives the hashes of its q-grams of ``Q`` bytes at the
   places where one is least in a string of ``WIDTH`` bytes. Such anchors depend on
   the string alone, so two equal strings have an anchor at the same place in them,
   and suffixes of one q-gram bucket are the only ones that can agree. An anchor
   whose bucket has no other member is done.
2. Anchors with equal surroundings, as wide as any string around them reaches, are
   repeated for all these strings; only one of them goes on for comparison.
3. Refinement. What is left in a bucket is sorted by the identifiers of blocks at
   later (and earlier) offsets: all strings whose start lies in a range of offsets
   share a core and lie in a full block. A core without an equal ends the range, an
   equal full block settles it as repeated, and otherwise the range is halved and
   the refined buckets are sorted again, down to single strings.

A bucket with more than ``HOT`` different surroundings is not collected: it is split
by the cores of its halves in Spark, as often as needed, before the rest is refined
in tasks. At a single string nothing is left to refine, and a count settles it. Before
that, anchors get what is known of their bucket without being gathered by it if the
bucket is large: a run of one byte has an anchor of the same bucket at every place.

Strings are taken as equal by 64 bits of BLAKE2 within a bucket; the sums that choose the
buckets settle nothing.

Texts are taken as UTF-8, null as empty, and nothing crosses from one text into
another. Repeated rows are texts of their own, so their strings are repeated. Rows
are told apart by id and text hash only; equal ones share one result. An empty table
gives an empty result. Spans are half-open byte ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import cut, map_arrow, tell_workers
from paystrata.llm.texthash import digests, mix, prefix_sums, substring_hashes

WIDTH = 400
Q = 100
REACH = WIDTH - Q  # bytes that a string may have before its anchor
AROUND = REACH + WIDTH  # bytes of an anchor's surroundings
EDGE = 0xFF  # no byte of UTF-8: stands for what is beyond a text
HOT = 50_000  # at most so many different surroundings of a bucket go to one task
LARGE = 10_000  # buckets with more than one in so many rows are not dealt by key
ROWS_PER_TASK = 20_000
STEP = 4096  # rows that are refined at a time, unless one bucket has more


def sliding(values: np.ndarray, width: int, take: np.ufunc) -> np.ndarray:
    """take.reduce over each run of ``width`` values."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    identity = np.iinfo(np.uint64).max if take is np.minimum else 0
    padded = np.full(blocks * width, identity, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    forward = take.accumulate(table, axis=1).ravel()
    backward = take.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return take(backward[:count], forward[width - 1 : width - 1 + count])


def surroundings(data: np.ndarray) -> np.ndarray:
    """A text with edges, so that an anchor's surroundings begin at its own place."""
    edges = np.full(len(data) + 2 * REACH, EDGE, dtype=np.uint8)
    edges[REACH : REACH + len(data)] = data
    return edges


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, q-gram hashes, hashes of the surroundings) of a text's anchors."""
    if len(data) < WIDTH:
        none = np.empty(0, dtype=np.uint64)
        return none.astype(np.int64), none, none
    whole = surroundings(data)
    sums = prefix_sums(whole)
    starts = np.arange(len(data) - Q + 1)
    grams = substring_hashes(sums, starts + REACH, starts + REACH + Q)
    least = sliding(grams, REACH + 1, np.minimum)
    # a place is an anchor if its hash is the least of some string around it
    sides = np.zeros(REACH, dtype=np.uint64)
    greatest = sliding(np.concatenate((sides, least, sides)), REACH + 1, np.maximum)
    places = np.flatnonzero(greatest == grams)
    return places, grams[places], digests(whole.tobytes(), places, places + AROUND)


def _bytes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py() or b"", dtype=np.uint8)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_key", "place", "gram", "around"]
    for batch in batches:
        columns = [batch.column("doc_id"), batch.column("text_key")]
        rows, found = [], []
        for i, text in enumerate(batch.column("text").cast(pa.binary())):
            found.append(anchors(_bytes(text)))
            rows.append(np.full(len(found[-1][0]), i))
        if not rows:
            continue
        row = pa.array(np.concatenate(rows), pa.int64())
        place, gram, around = (np.concatenate([f[k] for f in found]) for k in range(3))
        yield pa.RecordBatch.from_arrays(
            [c.take(row) for c in columns]
            + [pa.array(place.astype(np.int32)), pa.array(gram.view(np.int64)),
               pa.array(around.view(np.int64))],
            names,
        )


def _surrounding_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings of each listed anchor, from its text."""
    for batch in batches:
        listed = batch.column("anchors")
        lengths = np.diff(listed.offsets.to_numpy())
        flat = listed.flatten()
        row = np.repeat(np.arange(len(batch)), lengths)
        place = flat.field("place").to_numpy()
        parts, at = [], 0
        for text, count in zip(batch.column("text").cast(pa.binary()), lengths):
            whole = surroundings(_bytes(text)).tobytes()
            parts += [whole[p : p + AROUND] for p in place[at : at + count].tolist()]
            at += count
        take = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("text_key").take(take),
             flat.field("place"), flat.field("gram"), flat.field("many"),
             pa.array(parts, pa.binary())],
            ["doc_id", "text_key", "place", "gram", "many", "bytes"],
        )


class Blocks:
    """Hashes of blocks of a table of surroundings."""

    def __init__(self, table: np.ndarray) -> None:
        self.data, self.width = table.tobytes(), table.shape[1]

    def hashes(self, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        first = row * self.width
        return digests(self.data, first + start, first + end)

    def cores(self, bucket: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """What all strings of a range share, within the row's bucket."""
        found = self.hashes(row, REACH - low, REACH - high + WIDTH)
        return found ^ mix(bucket[row] + (low * 1000 + high).astype(np.uint64))

    def wholes(self, bucket: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """All that the strings of a range cover, within the row's bucket."""
        found = self.hashes(row, REACH - high, REACH - low + WIDTH)
        return found ^ mix(bucket[row] + (low * 1000 + high).astype(np.uint64))


def _members(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket number of each key, and the size of each bucket."""
    _, number, size = np.unique(keys, return_inverse=True, return_counts=True)
    return number, size


def refine(
    bucket: np.ndarray, surround: np.ndarray, settled: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, low, high): ranges of start offsets whose strings are repeated.

    ``bucket`` is the current bucket of each row, ``low`` to ``high`` the range of
    offsets before the anchor that is open, and ``settled`` marks rows that are
    known to be repeated and serve for comparison only.
    """
    blocks = Blocks(surround)
    row = np.arange(len(bucket))
    known, out = settled.copy(), ([], [], [])
    while len(row):
        core = blocks.cores(bucket, row, low, high)
        number, size = _members(core)
        open_rows = np.bincount(number, ~known, minlength=len(size))
        going = (size[number] > 1) & (open_rows[number] > 0)
        row, low, high, known = (x[going] for x in (row, low, high, known))
        if not len(row):
            break
        full = blocks.wholes(bucket, row, low, high)
        _, first, number, size = np.unique(
            full, return_index=True, return_inverse=True, return_counts=True
        )
        found = (size[number] > 1) & ~known
        for column, values in zip(out, (row, low, high)):
            column.append(values[found])
        # one of equal blocks goes on, for others to be compared with
        keep = np.zeros(len(row), dtype=bool)
        keep[first] = True
        known = known | found
        keep &= low < high
        row, low, high, known = (x[keep] for x in (row, low, high, known))
        middle = (low + high) // 2
        row, known = np.tile(row, 2), np.tile(known, 2)
        low, high = np.concatenate((low, middle + 1)), np.concatenate((middle, high))
    return tuple(np.concatenate(c) if c else np.empty(0, np.int64) for c in out)


def _table_bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, AROUND)


def _refine_table(key: tuple, table: pa.Table) -> pa.Table:
    """Refines the buckets of one task, some thousand rows at a time, bucket by bucket."""
    table = table.sort_by("bucket")
    bucket = table.column("bucket").to_numpy().view(np.uint64)
    edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    out, begin = [], 0
    while begin < len(edges) - 1:
        end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + STEP, "right")) - 1)
        a, b = int(edges[begin]), int(edges[end])
        part = table.slice(a, b - a)
        row, low, high = refine(
            bucket[a:b], _table_bytes(part.column("bytes")),
            part.column("many").to_numpy(zero_copy_only=False).astype(bool),
            part.column("low").to_numpy().astype(np.int64),
            part.column("high").to_numpy().astype(np.int64),
        )
        chosen = part.select(["doc_id", "text_key", "place"]).take(pa.array(row))
        out.append(
            chosen.append_column("low", pa.array(low.astype(np.int32)))
            .append_column("high", pa.array(high.astype(np.int32)))
        )
        begin = end
    return pa.concat_tables(out)


def _split_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both halves of each row's range, with their new bucket and the hash of the whole."""
    for batch in batches:
        for at in range(0, len(batch), STEP):
            part = batch.slice(at, STEP)
            blocks = Blocks(_table_bytes(part.column("bytes")))
            row = np.arange(len(part))
            low, high = (np.asarray(part.column(c)).astype(np.int64) for c in ("low", "high"))
            parent = np.asarray(part.column("bucket")).view(np.uint64)
            middle = (low + high) // 2
            for half in ((low, middle), (middle + 1, high)):
                fresh = {
                    "bucket": blocks.cores(parent, row, *half).view(np.int64),
                    "low": half[0].astype(np.int32), "high": half[1].astype(np.int32),
                    "whole": blocks.wholes(parent, row, *half).view(np.int64),
                }
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fresh[c]) if c in fresh else part.column(c) for c in ROW_COLUMNS],
                    list(ROW_COLUMNS),
                )


ROW_COLUMNS = ("bucket", "doc_id", "text_key", "place", "many", "low", "high", "bytes", "whole")
ROW_KEY = ("doc_id", "text_key", "place", "low", "high")


def _refined_once(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that stay open, settled ranges) after one look at cores and whole blocks.

    As in ``refine``: a core without an equal, or with settled ones only, ends; equal
    whole blocks are settled, and one of them goes on for comparison.
    """
    open_cores = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum((~F.col("many")).cast("long")).alias("open")
    ).where("n > 1 and open > 0").select("bucket")
    equal = rows.groupBy("bucket", "whole").agg(
        F.count(F.lit(1)).alias("equals"), F.min(F.struct(*ROW_KEY)).alias("first")
    )
    seen = rows.join(open_cores, "bucket").join(equal, ["bucket", "whole"])
    settled = seen.where("equals > 1 and not many").select(*ROW_KEY)
    going = seen.where((F.struct(*ROW_KEY) == F.col("first")) & (F.col("low") < F.col("high")))
    return going.withColumn("many", F.col("many") | (F.col("equals") > 1)).select(*ROW_COLUMNS), settled


def _split_hot(rows: DataFrame, schema: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose buckets fit a task, settled ranges): hot buckets halved until they fit."""
    ready, settled = None, None
    while True:
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
        hot = cut(sizes.where(F.col("size") > HOT).select("bucket"), "hot-buckets")
        if hot.isEmpty():
            return rows if ready is None else ready.unionByName(rows), settled
        fits = rows.join(hot, "bucket", "left_anti")
        ready = fits if ready is None else ready.unionByName(fits)
        halves = cut(map_arrow(rows.join(hot, "bucket").select(*ROW_COLUMNS), _split_rows, schema), "halves")
        going, done = _refined_once(halves)
        rows = cut(going, "refined-halves")
        settled = done if settled is None else settled.unionByName(done)


def _of_buckets(rows: DataFrame, buckets: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` that have a bucket, with its columns but ``size``.

    Fewer than ``LARGE`` buckets have more than one in ``LARGE`` rows. These are sent to
    the rows, which stay dealt as they are; all others meet their bucket by key.
    """
    large = F.col("size") > rows.count() // LARGE
    sent = F.broadcast(buckets.where(large).drop("size"))
    others = rows.join(F.broadcast(buckets.where(large).select(*key)), key, "left_anti")
    return rows.join(sent, key).unionByName(others.join(buckets.where(~large).drop("size"), key))


def repeated_ranges(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, place, low, high): strings that start low..high before the place."""
    kind = dict(documents.dtypes)["doc_id"]
    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    row_type = f"doc_id {kind}, text_key bigint, place int"
    found = cut(
        map_arrow(keyed, _anchor_rows, f"{row_type}, gram bigint, around bigint"), "anchors"
    )
    # 1. buckets with more than one member, and whether their surroundings differ
    buckets = found.groupBy("gram").agg(
        F.count(F.lit(1)).alias("size"),
        (F.min("around") != F.max("around")).alias("mixed"),
    ).where("size > 1")
    shared = cut(_of_buckets(found, cut(buckets, "shared-grams"), ["gram"]), "shared-anchors")
    # 2. one of equal surroundings goes on
    mixed = shared.where("mixed").groupBy("gram", "around").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("doc_id", "text_key", "place")).alias("r"),
    ).withColumn("many", F.col("size") > 1)
    mixed = cut(mixed.select("gram", "around", "size", "many", "r.*"), "surroundings")
    equals = mixed.where("many").select("gram", "around", "size")
    equal = _of_buckets(shared, equals, ["gram", "around"])
    whole = shared.where("not mixed").unionByName(equal).select(
        "doc_id", "text_key", "place", F.lit(0).alias("low"), F.lit(REACH).alias("high")
    )
    # 3. the others are refined, with their bytes
    wanted = mixed.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_list(F.struct("place", "gram", "many")).alias("anchors")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    # a text on several rows is read once
    texts = keyed.join(wanted.hint("shuffle_hash"), same).select("doc_id", "text_key", "text", "anchors")
    rows = map_arrow(
        texts, _surrounding_rows, f"{row_type}, gram bigint, many boolean, bytes binary"
    ).select(
        F.col("gram").alias("bucket"), "doc_id", "text_key", "place", "many",
        F.lit(0).alias("low"), F.lit(REACH).alias("high"), "bytes", F.lit(0).cast("long").alias("whole"),
    )
    settled = None
    largest = mixed.groupBy("gram").count().agg(F.max("count")).first()[0] or 0
    if largest > HOT:
        schema = (
            f"bucket bigint, {row_type}, many boolean, low int, high int, bytes binary, whole bigint"
        )
        rows, settled = _split_hot(cut(rows, "open-anchors"), schema)
    tasks = max(8, mixed.count() // ROWS_PER_TASK + 1)
    tell_workers(documents)
    refined = (
        rows.drop("whole").withColumn("task", F.pmod(F.xxhash64("bucket"), F.lit(tasks)))
        .repartition(tasks, "task").groupBy("task")
        .applyInArrow(_refine_table, f"{row_type}, low int, high int")
    )
    result = whole.unionByName(refined)
    return result.unionByName(settled) if settled is not None else result


def spans_of(size: int, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Maximal removed runs of a text of ``size`` bytes."""
    # strings that reach beyond the text are no strings of it
    high = np.minimum(high, place)
    low = np.maximum(low, place + WIDTH - size)
    inside = low <= high
    start, end = (place - high)[inside], (place - low + WIDTH)[inside]
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate(([True], start[1:] > end[:-1]))
    last = np.concatenate((first[1:], [True]))
    return list(zip(start[first].tolist(), end[last].tolist()))


def _result_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, ranges in zip(batch.column("text").cast(pa.binary()), batch.column("ranges")):
            data, spans = text.as_py() or b"", []
            if ranges.is_valid and len(ranges):
                values = ranges.values
                spans = spans_of(
                    len(data), *(values.field(k).to_numpy().astype(np.int64) for k in ("place", "low", "high"))
                )
            kept, at = [], 0
            for start, end in spans:
                kept.append(data[at:start])
                at = end
            kept.append(data[at:])
            removed = sum(end - start for start, end in spans)
            left = b"".join(kept)
            rows.append((len(data), removed, len(spans), hashlib.sha256(left).hexdigest(), left, spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")] + [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            + [pa.array([r[3] for r in rows], pa.string()), pa.array([r[4] for r in rows], pa.binary()),
               pa.array([[{"start": a, "end": b} for a, b in r[5]] for r in rows],
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"],
        )


def deduplicate(documents: DataFrame) -> DataFrame:
    """Per document: its sizes, the removed spans, and the bytes that stay with their SHA-256."""
    kind = dict(documents.dtypes)["doc_id"]
    ranges = repeated_ranges(documents).groupBy(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
    ).agg(F.collect_list(F.struct("place", "low", "high")).alias("ranges"))
    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    joined = keyed.join(ranges.hint("shuffle_hash"), same, "left").select("doc_id", "text", "ranges")
    return map_arrow(
        joined, _result_rows,
        f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "kept binary, spans array<struct<start:bigint,end:bigint>>",
    )


def digest(documents: DataFrame) -> DataFrame:
    """The sizes, the SHA-256 of what is kept, and the removed spans as ``start:end,...``."""
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return deduplicate(documents).drop("kept").withColumn("spans", F.array_join(spans, ","))
