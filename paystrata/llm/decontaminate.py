"""Benchmark decontamination with item-sized windows.

Texts and items are read as lowered words, ASCII punctuation and white space
apart, and as shingles of five words. A window has as many words as an item. Its
64-bit SimHash, weighted by the shingles' counts, is looked up in a multi-index:
the fingerprint is cut into RADIUS + 1 blocks, and two fingerprints within RADIUS
agree on one block at least, so no fingerprint within the radius is missed.
Candidates are verified by the exact weighted Jaccard similarity of shingles.

A window of similarity above zero shares a shingle with the item, so windows are
only laid where a shingle of an item stands, at every alignment that such a
shingle gives; windows elsewhere cannot pass. Between shifted alignments of one
item the window is also slid word by word over the span of its hits.

The items are grouped into index blocks of ``ITEMS_PER_BLOCK`` and every block is
sent to all tasks on its own, so what is sent at once has a fixed bound however
many items there are; documents are read once per block.

Defined results: null and empty texts have no words and no contamination; items
without words match nothing; an item of fewer than five words is one shingle;
repeated rows get the same result each; an empty table on either side gives no
contamination. Column names that begin with ``_d_`` are reserved.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import cut, map_arrow
from paystrata.llm.texthash import chunks, mix, shingles, word_hashes

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 24
ITEMS_PER_BLOCK = 20_000
FILTER_BITS = 22


def _shingle_bits(values: np.ndarray) -> np.ndarray:
    """The bits of shingle hashes as +1 and -1."""
    spread = mix(values ^ np.uint64(0x5BF0A8B1457695D3))
    bits = np.unpackbits(spread.view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def simhash(values: np.ndarray) -> np.ndarray:
    """The 64 bits of a shingle sequence; repeated shingles weigh by their count."""
    return _shingle_bits(values).sum(axis=0, dtype=np.int64) >= 0


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle sequences."""
    keys, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    count_a = np.bincount(inverse[: len(a)], minlength=len(keys))
    count_b = np.bincount(inverse[len(a) :], minlength=len(keys))
    return float(np.minimum(count_a, count_b).sum() / np.maximum(count_a, count_b).sum())


class Index:
    """Items by shingle and by blocks of their fingerprints."""

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        self.ids: list[int] = []
        self.shingles: list[np.ndarray] = []
        self.sizes: list[int] = []
        for item_id, text in items:
            words, _ = word_hashes([text], punctuation_splits=True)
            if len(words):
                self.ids.append(item_id)
                self.sizes.append(len(words))
                self.shingles.append(shingles(words, SHINGLE))
        self.prints = np.array([simhash(s) for s in self.shingles], dtype=bool).reshape(-1, 64)
        self.bounds = np.linspace(0, 64, RADIUS + 2).astype(int)
        self.blocks: dict[tuple[int, bytes], list[int]] = {}
        for item, bits in enumerate(self.prints):
            for key in self._keys(bits):
                self.blocks.setdefault(key, []).append(item)
        # every place of a shingle in an item, sorted by shingle; short items apart
        flat = [(h, i, at) for i, s in enumerate(self.shingles) for at, h in enumerate(s.tolist())]
        flat.sort()
        self.keys = np.array([h for h, _, _ in flat], dtype=np.uint64)
        self.item = np.array([i for _, i, _ in flat], dtype=np.int64)
        self.at = np.array([at for _, _, at in flat], dtype=np.int64)
        self.seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.seen[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.short = sorted({n for n in self.sizes if n < SHINGLE})

    def _keys(self, bits: np.ndarray) -> Iterator[tuple[int, bytes]]:
        for block, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            yield block, bits[a:b].tobytes()

    def near(self, bits: np.ndarray) -> set[int]:
        """Items whose fingerprint is within the radius."""
        candidates = {i for key in self._keys(bits) for i in self.blocks.get(key, ())}
        if not candidates:
            return candidates
        found = np.fromiter(candidates, dtype=np.int64)
        distance = (self.prints[found] != bits).sum(axis=1)
        return set(found[distance <= RADIUS].tolist())

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, item, place in item) of every equal shingle."""
        places = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(self.keys, hashes[places], "left")
        count = np.searchsorted(self.keys, hashes[places], "right") - low
        entry = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(places, count), self.item[entry], self.at[entry]


def find(index: Index, words: np.ndarray) -> dict[int, tuple[float, int, int]]:
    """Item number -> (similarity, first word, words) of the best window in one text."""
    found: dict[int, tuple[float, int, int]] = {}
    tried: set[tuple[int, int]] = set()
    for size in (*index.short, SHINGLE):
        if len(words) < size:
            continue
        whole = shingles(words, size)
        places, items, offsets = index.hits(whole)
        for item in np.unique(items).tolist():
            length = index.sizes[item]
            if min(length, SHINGLE) != size:
                continue
            of_item = items == item
            starts = np.unique(places[of_item] - offsets[of_item])
            # alignments that differ by less than an item are bridged word by word
            gaps = np.flatnonzero(np.diff(starts) > length)
            for part in np.split(starts, gaps + 1):
                for start in range(int(part[0]), int(part[-1]) + 1):
                    start = min(max(start, 0), max(len(words) - length, 0))
                    if (start, length) in tried:
                        continue
                    tried.add((start, length))
                    inside = whole[start : start + max(length - size + 1, 1)]
                    for near in index.near(simhash(inside)):
                        if index.sizes[near] != length:
                            continue
                        value = similarity(inside, index.shingles[near])
                        best = found.get(near)
                        if value >= SIMILARITY and (best is None or value > best[0]):
                            found[near] = value, start, length
    return found


def _search(items: list[tuple[int, bytes]], id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            out: list[tuple[int, int, float, int, int]] = []
            for a, b in chunks(texts):
                words, begins = word_hashes(texts[a:b], punctuation_splits=True)
                if not len(words) or not len(index.keys):
                    continue
                hit = np.zeros(len(words), dtype=bool)
                for size in (*index.short, SHINGLE):
                    if len(words) >= size:
                        hit[np.unique(index.hits(shingles(words, size))[0])] = True
                for doc in np.unique(np.searchsorted(begins, np.flatnonzero(hit), "right") - 1):
                    own = words[begins[doc] : begins[doc + 1]]
                    for item, (value, start, size) in find(index, own).items():
                        out.append((a + int(doc), index.ids[item], value, start, size))
            rows = pa.array([row[0] for row in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows), batch.column("_d_text").take(rows),
                    pa.array([row[1] for row in out], id_type),
                    pa.array([row[2] for row in out], pa.float64()),
                    pa.array([row[3] for row in out], pa.int32()),
                    pa.array([row[4] for row in out], pa.int32()),
                ],
                ["doc_id", "_d_text", "item_id", "similarity", "first_word", "n_words"],
            )

    return run


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """Distinct items in blocks of a fixed number; one block is in memory at a time."""
    block: list[tuple[int, bytes]] = []
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    for row in items.select("item_id", "text").distinct().toLocalIterator():
        block.append((row["item_id"], row["text"].encode()))
        if len(block) == ITEMS_PER_BLOCK:
            yield block
            block = []
    if block:
        yield block


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text hash, item_id, similarity, first_word, n_words) of contaminations."""
    doc_type = dict(documents.dtypes)["doc_id"]
    item_type = dict(benchmark.dtypes)["item_id"]
    id_type = pa.int64() if item_type == "bigint" else pa.int32() if item_type == "int" else pa.string()
    source = documents.select("doc_id", "text", F.xxhash64("text").alias("_d_text"))
    schema = (
        f"doc_id {doc_type}, _d_text bigint, item_id {item_type}, similarity double, "
        "first_word int, n_words int"
    )
    parts = [
        map_arrow(source, _search(block, id_type), schema) for block in _item_blocks(benchmark)
    ]
    if not parts:
        return documents.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def judge(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its contaminating items and the greatest similarity."""
    found = cut(matches(documents, benchmark), "contaminations").dropDuplicates(
        ["doc_id", "_d_text", "item_id"]
    )
    by_doc = found.groupBy(F.col("doc_id").alias("_d_id"), "_d_text").agg(
        F.array_sort(F.collect_list("item_id")).alias("items"),
        F.max("similarity").alias("similarity"),
    )
    keys = documents.select("doc_id", F.xxhash64("text").alias("_d_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_d_id")) & (F.col("_d_key") == F.col("_d_text"))
    return keys.join(by_doc, same, "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast(by_doc.schema["items"].dataType)).alias("items"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def remove(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without contamination, with their own columns."""
    found = cut(matches(documents, benchmark), "contaminations").select(
        F.col("doc_id").alias("_d_id"), F.col("_d_text")
    ).distinct()
    keyed = documents.withColumn("_d_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_d_id")) & (F.col("_d_key") == F.col("_d_text"))
    return keyed.join(found, same, "left_anti").drop("_d_key")
