"""Removal of word passages that a document with a smaller id has, by difference-cover anchors.

A window is ``WINDOW`` consecutive words. A word is removed if a window over it also
starts in a document with a smaller ``doc_id``. Every document is anchored at its word
positions whose remainder modulo ``PERIOD`` is in ``COVER``. The remainders are a
difference cover: for any two positions there is a shift below the period that brings both
to anchors. So two equal windows, wherever they stand, share an anchor of
``WINDOW - PERIOD + 1`` words at the same place in both, and nothing else need be looked at.

1. Each anchor is hashed, and apart from it its context: all words of the windows around
   it. Where a context is also in a smaller document, all windows around the anchor are
   settled as repeated. What a batch of texts can settle by itself goes no further, so a
   group of copies sends one row per batch and context, not one per copy.
2. The others meet by anchor, in order of context and document. Equal contexts
   settle all but the smallest document; anchors with several contexts in several
   documents stay open, and the rest ends here.
3. Extension. The windows around open anchors, less those that are settled, meet by the
   128-bit hash of all their words; all but the smallest document are settled.

Rows with many partners are never collected: tasks read them in sorted order and
remember one row, or the places in one document. A batch that meets one anchor in more
than ``OWN_CONTEXTS`` contexts passes on so many of them, and opens the rest at once.

A false match needs two equal 64-bit hashes of BLAKE2 (anchor and context), or an equal
128-bit one. Texts of any length are taken whole, null as empty. An id that is null is
neither smaller nor larger than another, so such rows keep all words and take none away;
rows of equal id take nothing from one another, and rows of equal id and text share one
result. An empty table gives an empty result. Columns beyond ``doc_id`` and ``text`` are
not looked at, whatever their names. Spans are half-open ranges of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import cut, map_arrow
from paystrata.llm.texthash import chunks

WINDOW = 50
# A difference cover; the differences of its members give 1 to 30 modulo 31.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
ANCHOR = WINDOW - PERIOD + 1
REACH = WINDOW - ANCHOR  # words of a window before its anchor, at most
OWN_CONTEXTS = 64
CHUNK = 8 << 20  # bytes of text that are settled among themselves
PIECE = 1 << 17  # hashes that are made at a time

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_IS_COVER = np.isin(np.arange(PERIOD), COVER)


class Words:
    """The words of some texts, one space after each."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        space = _SPACE[data]
        keep = ~space
        keep[1:] |= keep[:-1].copy()  # a word and the one separator after it
        ends = np.flatnonzero(space & keep)
        plain = data[keep]
        plain[space[keep]] = 0x20
        self.bytes = plain.tobytes()
        self.end = np.flatnonzero(space[keep])  # of each word
        self.start = np.concatenate(([0], self.end[:-1] + 1)) if len(self.end) else self.end
        offsets = np.cumsum([0] + [len(text) + 1 for text in texts])
        self.first = np.searchsorted(ends, offsets)  # word of each text

    def digests(self, begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the words begin..end-1, ``size`` bytes each."""
        parts = []
        for at in range(0, len(begin), PIECE):
            a = self.start[begin[at : at + PIECE]].tolist()
            z = self.end[end[at : at + PIECE] - 1].tolist()
            text = self.bytes
            parts.append(b"".join(
                [blake2b(text[i:j], digest_size=size).digest() for i, j in zip(a, z)]
            ))
        found = np.frombuffer(b"".join(parts), dtype=np.int64)
        return found if size == 8 else found.reshape(-1, size // 8)

    def kept(self, text: int, spans: list[tuple[int, int]]) -> bytes:
        """A text's words outside the spans, joined by one space."""
        first, last = int(self.first[text]), int(self.first[text + 1])
        parts, at = [], first
        for a, z in [*spans, (last - first, last - first)]:
            if at < first + a:
                parts.append(self.bytes[self.start[at] : self.end[first + a - 1]])
            at = first + z
        return b" ".join(parts)


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, anchor hash, context hash) of texts that have a window."""
    rows, places = [], []
    for i, count in enumerate(np.diff(words.first).tolist()):
        if count >= WINDOW:
            place = np.arange(count - ANCHOR + 1)
            places.append(place[_IS_COVER[place % PERIOD]])
            rows.append(np.full(len(places[-1]), i))
    if not rows:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    row, place = np.concatenate(rows), np.concatenate(places)
    first, count = words.first[row], np.diff(words.first)[row]
    low, high = np.maximum(place - REACH, 0), np.minimum(place + WINDOW, count)
    anchor = words.digests(first + place, first + place + ANCHOR, 8)
    context = words.digests(first + low, first + high, 8)
    # the anchor's place in a context that a text's edge cuts
    return row, place, anchor, context ^ ((place - low) * np.int64(0x2545F4914F6CDD1D))


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first row does."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new) > 1:
        new[1:] = False
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
    return new


def runs(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of each row that touch or overlap, joined."""
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order], high[order]
    if not len(row):
        return row, low, high
    # ranges are in one line of numbers, so that a running maximum stays within its row
    span = int(high.max()) - int(low.min()) + 3
    shift = (row - row[0]) * np.int64(span) - int(low.min())
    reach = np.maximum.accumulate(high + shift)
    new = np.ones(len(row), dtype=bool)
    new[1:] = low[1:] + shift[1:] > reach[:-1] + 1
    last = np.concatenate((new[1:], [True]))
    return row[new], low[new], (reach - shift)[last]


CANDIDATE, SETTLED, OPEN = 0, 1, 2
_COLUMNS = ["a", "b", "doc_id", "text_key", "low", "high", "kind"]
_MEET = "a bigint, b bigint, doc_id bigint, text_key bigint, low int, high int, kind tinyint"
_FOUND = "doc_id bigint, text_key bigint, low int, high int, settled boolean"


def _batch(doc, key, low, high, kind: int, a=None, b=None) -> pa.RecordBatch:
    """Rows to meet by ``a``; those that need not meet are spread by their text."""
    a = key if a is None else a
    b = np.zeros(len(doc), dtype=np.int64) if b is None else b
    values = [a, b, doc, key, low.astype(np.int32), high.astype(np.int32),
              np.full(len(doc), kind, dtype=np.int8)]
    return pa.RecordBatch.from_arrays([pa.array(v) for v in values], _COLUMNS)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts, some megabytes or one text at a time."""
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        for begin, end in chunks(texts, CHUNK):
            yield batch.slice(begin, end - begin), texts[begin:end]


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()


def _ranged(row, low, high, doc, key, kind: int) -> pa.RecordBatch:
    row, low, high = runs(row, low, high)
    return _batch(doc[row], key[row], low, high, kind)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors to meet others, and the ranges of window starts that need not."""
    for batch, texts in _texts(batches):
        ids, keys = _ids(batch)
        row, place, anchor, context = anchors(Words(texts))
        if not len(row):
            continue
        order = np.lexsort((place, keys[row], ids[row], context, anchor))
        row, place, anchor, context = (x[order] for x in (row, place, anchor, context))
        doc, key = ids[row], keys[row]
        first = np.flatnonzero(changes(anchor, context))
        least = np.repeat(doc[first], np.diff(np.append(first, len(doc))))
        settled = doc > least
        yield _ranged(row[settled], place[settled] - REACH, place[settled], ids, keys, SETTLED)
        # one row for rows of equal id and text
        going = ~settled & changes(anchor, context, doc, key, place)
        row, place, anchor, context, doc, key = (
            x[going] for x in (row, place, anchor, context, doc, key)
        )
        new = changes(anchor)
        group = np.flatnonzero(new)
        size = np.diff(np.append(group, len(doc)))
        number = np.cumsum(changes(anchor, context))
        rank = number - np.repeat(number[group], size)
        # the least and the greatest document go on, so that two documents stay two
        outer = (doc == np.repeat(np.minimum.reduceat(doc, group), size)) | (
            doc == np.repeat(np.maximum.reduceat(doc, group), size)
        )
        many = (rank >= OWN_CONTEXTS) & ~outer
        yield _ranged(row[many], place[many] - REACH, place[many], ids, keys, OPEN)
        one = ~many
        yield _batch(
            doc[one], key[one], place[one] - REACH, place[one], CANDIDATE, anchor[one], context[one]
        )


def _found(doc, key, low, high, settled: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(key), pa.array(low), pa.array(high),
         pa.array(np.full(len(doc), settled))],
        ["doc_id", "text_key", "low", "high", "settled"],
    )


def _meet(batches: Iterator[pa.RecordBatch], windows: bool) -> Iterator[pa.RecordBatch]:
    """Settled and open ranges from candidates in order of (a, b, document).

    Rows of equal ``a`` and ``b`` are equal passages: all but the least document are
    settled. With ``windows`` that is all. Otherwise the least documents stay open where
    an ``a`` has several ``b`` and several documents. Of a group that goes on in the next
    batch, only rows of one document wait, or one row to compare with.
    """
    waiting, ghost, mixed_before, two_before = None, 0, False, False
    for batch in batches:
        columns = [batch.column(name).to_numpy() for name in _COLUMNS]
        done = columns[-1] != CANDIDATE
        for kind in (SETTLED, OPEN):
            here = columns[-1] == kind
            if here.any():
                yield _found(*[x[here] for x in columns[2:6]], kind == SETTLED)
        columns = [x[~done] for x in columns[:6]]
        if not len(columns[0]):
            continue
        carried = 0
        if waiting is not None:
            carried = len(waiting[0])
            columns = [np.concatenate(pair) for pair in zip(waiting, columns)]
        a, b, doc, key, low, high = columns
        known = np.zeros(len(a), dtype=bool)
        known[:ghost] = True
        new = changes(a, b)
        first = np.flatnonzero(new)
        least = np.repeat(doc[first], np.diff(np.append(first, len(a))))
        settled = doc > least
        yield _found(doc[settled], key[settled], low[settled], high[settled], True)
        if windows:
            last = first[-1]
            waiting, ghost = [x[last : last + 1] for x in columns], 1
            continue
        group = np.flatnonzero(changes(a))
        size = np.diff(np.append(group, len(a)))
        two = np.minimum.reduceat(doc, group) != np.maximum.reduceat(doc, group)
        several = np.add.reduceat(new.astype(np.int64), group) > 1
        if carried:  # the first group goes on from the batch before
            two[0] |= two_before
            several[0] |= mixed_before
        mixed = two & several
        shown = np.repeat(mixed, size) & ~settled & ~known
        yield _found(doc[shown], key[shown], low[shown], high[shown], False)
        begin = group[-1]
        two_before, mixed_before = bool(two[-1]), bool(mixed[-1])
        if mixed_before:
            last = first[-1]
            waiting, ghost = [x[last : last + 1] for x in columns], 1
        else:
            rest = begin + np.flatnonzero(~settled[begin:])
            waiting, ghost = [x[rest] for x in columns], 0


def starts_of(ranges: pa.Scalar, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the settled and of the open window starts of a text of ``count`` words."""
    settled, opened = (np.zeros(max(count - WINDOW + 1, 0) + 1, dtype=np.int64) for _ in range(2))
    if len(settled) > 1 and ranges.is_valid and len(ranges):
        values = ranges.values
        low = np.maximum(values.field("low").to_numpy(), 0)
        high = np.minimum(values.field("high").to_numpy(), count - WINDOW)
        kind = values.field("settled").to_numpy(zero_copy_only=False)
        for flags, chosen in ((settled, kind), (opened, ~kind)):
            chosen = chosen & (low <= high)
            np.add.at(flags, low[chosen], 1)
            np.add.at(flags, high[chosen] + 1, -1)
    return tuple(np.cumsum(flags)[:-1] > 0 for flags in (settled, opened))


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows around open anchors that no context has settled."""
    for batch, texts in _texts(batches):
        ids, keys = _ids(batch)
        words = Words(texts)
        counts = np.diff(words.first)
        rows, places = [], []
        for i, ranges in enumerate(batch.column("ranges")):
            settled, opened = starts_of(ranges, int(counts[i]))
            places.append(np.flatnonzero(opened & ~settled))
            rows.append(np.full(len(places[-1]), i))
        row, place = np.concatenate(rows), np.concatenate(places)
        for at in range(0, len(row), 1 << 20):
            yield from _hashed_windows(
                words, ids, keys, row[at : at + (1 << 20)], place[at : at + (1 << 20)]
            )


def _hashed_windows(words: Words, ids, keys, row, place) -> Iterator[pa.RecordBatch]:
    begin = words.first[row] + place
    a, b = words.digests(begin, begin + WINDOW, 16).T
    order = np.lexsort((place, keys[row], ids[row], b, a))
    row, place, a, b = (x[order] for x in (row, place, a, b))
    doc, key = ids[row], keys[row]
    first = np.flatnonzero(changes(a, b))
    least = np.repeat(doc[first], np.diff(np.append(first, len(doc))))
    settled = doc > least
    yield _ranged(row[settled], place[settled], place[settled], ids, keys, SETTLED)
    going = ~settled
    yield _batch(doc[going], key[going], place[going], place[going], CANDIDATE, a[going], b[going])


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("a").sortWithinPartitions("a", "b", "doc_id", "text_key", "low")


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )


def _per_text(ranges: DataFrame) -> DataFrame:
    """The distinct ranges of each (id, text)."""
    return ranges.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_set(F.struct("low", "high", "settled")).alias("ranges"),
        F.min("settled").alias("all_settled"),
    )


def _same_text() -> Column:
    return (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key"))


def repeated_starts(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, low, high): windows that also start in a smaller document."""
    texts = _keyed(documents).where("doc_id is not null and text is not null")
    met = _in_order(map_arrow(texts, _anchor_rows, _MEET))
    ranges = cut(map_arrow(met, partial(_meet, windows=False), _FOUND), "cover-ranges")
    some_open = _per_text(ranges).where("not all_settled").drop("all_settled")
    opened = texts.join(some_open, _same_text()).select("doc_id", "text_key", "text", "ranges")
    windows = _in_order(map_arrow(opened, _window_rows, _MEET))
    found = cut(map_arrow(windows, partial(_meet, windows=True), _FOUND), "cover-windows")
    return ranges.where("settled").unionByName(found)


def _results(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch, texts in _texts(batches):
        words = Words(texts)
        counts = np.diff(words.first).tolist()
        rows = []
        for i, (count, ranges) in enumerate(zip(counts, batch.column("ranges"))):
            start = np.flatnonzero(starts_of(ranges, count)[0])
            _, low, high = runs(np.zeros(len(start), dtype=np.int64), start, start + WINDOW - 1)
            spans = list(zip(low.tolist(), (high + 1).tolist()))
            kept = words.kept(i, spans)
            rows.append((count, sum(z - a for a, z in spans), sha256(kept).hexdigest(), kept, spans))
        columns = [
            batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()),
        ]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            columns.append(pa.array([r[3] for r in rows], pa.binary()).cast(pa.string()))
            columns.append(pa.array([[{"start": a, "end": z} for a, z in r[4]] for r in rows], pa.list_(span)))
            names += ["kept", "spans"]
        yield pa.RecordBatch.from_arrays(columns, names)


def deduplicate(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """Per document its words, how many are removed, what is kept, and the removed spans."""
    ranges = _per_text(repeated_starts(documents)).drop("all_settled")
    joined = _keyed(documents).join(ranges, _same_text(), "left").select("doc_id", "text", "ranges")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    if with_text:
        schema += ", kept string, spans array<struct<start:bigint,end:bigint>>"
    return map_arrow(joined, partial(_results, with_text=with_text), schema)


def digest(documents: DataFrame) -> DataFrame:
    return deduplicate(documents, with_text=False)
