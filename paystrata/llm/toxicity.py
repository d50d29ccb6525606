"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives. The unlabelled texts are drawn from all documents
but the held-out ones, whatever their label, so they hold toxic ones in the share of
the whole; labels of harmless texts count for the prior at most. With class prior p, the risk of a linear classifier is

    p * R(positive as 1) + max(0, R(unlabelled as 0) - p * R(positive as 0)),

and where the second part turns negative the step goes the other way, so that the
classifier cannot profit from fitting the unlabelled texts too closely. Features
are hashed words, present or not, and beginnings of words that several different words of a
text share; of these those are used whose presence differs clearly between the two
samples (chi-square). Training is numpy on the driver over at most
``MAX_POSITIVE`` and ``MAX_UNLABELLED`` texts, chosen by a hash of their id;
scoring covers every whole text in parallel, without a shuffle. The sample reaches the
driver as slots of words in Arrow buffers, never as texts.

Defined results: a null or empty text scores by the bias alone; without positives
every score is 0; repeated rows get the same score each and count once in training; an
empty table gives an empty result. Very long texts are scored whole, in time linear in
their length; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import map_arrow
from paystrata.llm.texthash import chunks, mix, run_hashes, word_places

BITS = 18
MAX_POSITIVE = 6000
MAX_UNLABELLED = 18000
PREDICT_AT = 0.3
TELLING = 25.0
STEPS = 800
RATE = 0.03
BATCH = 512
DECAY = 3e-5
STEMS = (4, 6, 8)  # bytes of a word's beginning
SHARED_BY = (2, 5)  # different words of a text that must begin so


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _counted(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one of each distinct pair, how often the pair occurs)."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(fresh)
    return order[first], np.diff(np.append(first, len(order)))


def features(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the distinct slots of its words and of the beginnings they share."""
    data, starts, ends, begins = word_places(texts, punctuation_splits=True)
    words = run_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    one, _ = _counted(owner, words)
    found = [(owner[one], words[one])]
    for size in STEMS:
        longer = one[(ends - starts)[one] > size]
        stems = run_hashes(data, starts[longer], starts[longer] + size)
        at, count = _counted(owner[longer], stems)
        for least in SHARED_BY:
            several = at[count >= least]
            found.append((owner[longer[several]], mix(stems[several] + np.uint64(least))))
    text = np.concatenate([t for t, _ in found])
    slots = np.concatenate([(mix(h) >> np.uint64(64 - BITS)).astype(np.int64) for _, h in found])
    pairs = np.unique(text << BITS | slots)
    borders = np.searchsorted(pairs >> BITS, np.arange(1, len(texts)))
    return np.split(pairs & ((1 << BITS) - 1), borders)


def _as_bytes(column: pa.Array) -> list[bytes]:
    return [v if v is not None else b"" for v in column.cast(pa.binary()).to_pylist()]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, rows = _as_bytes(batch.column("text")), []
        for a, b in chunks(texts):
            rows += [r.astype(np.int32) for r in features(texts[a:b])]
        rows += [np.empty(0, np.int32)] * (len(texts) - len(rows))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("toxic"),
                pa.array(rows, pa.list_(pa.int32())),
            ],
            ["doc_id", "toxic", "slots"],
        )


def _scores(rows: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.empty(0, np.int64)])
    owner = np.repeat(np.arange(len(rows)), sizes)
    return np.bincount(owner, weights[flat], minlength=len(rows)) + bias


def telling_slots(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Slots whose share among the positives differs: chi-square at ``TELLING`` or more."""
    def share(rows: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate([*rows, np.empty(0, np.int64)]), minlength=1 << BITS)

    a, b, n, m = share(positive), share(unlabelled), len(positive), len(unlabelled)
    both = np.maximum(a + b, 1)
    chi = (a * (m - b) - b * (n - a)) ** 2.0 * (n + m) / (
        both * np.maximum(n + m - a - b, 1) * float(n) * m
    )
    return np.flatnonzero(chi >= TELLING)


def train(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights per slot and bias, by stochastic steps (Adam) on the non-negative risk."""
    chosen = telling_slots(positive, unlabelled)
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    positive, unlabelled = (
        [k[k >= 0] for k in (place[r] for r in rows)] for rows in (positive, unlabelled)
    )
    weights, bias = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(weights.size + 1), np.zeros(weights.size + 1)
    random = np.random.Generator(np.random.PCG64(seed))
    share = max(1, min(BATCH, len(positive)))
    for step in range(1, STEPS + 1):
        u = [unlabelled[i] for i in random.integers(0, len(unlabelled), min(BATCH, len(unlabelled)))]
        p = [positive[i] for i in random.integers(0, len(positive), share)]
        sp, su = _scores(p, weights, bias), _scores(u, weights, bias)
        # logistic loss: its slope is sigmoid(s) - 1 for label 1 and sigmoid(s) for label 0
        fp, fu = 1 / (1 + np.exp(-sp)), 1 / (1 + np.exp(-su))
        negative_risk = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        if negative_risk >= 0:
            gp, gu = prior * (fp - 1) - prior * fp, fu
        else:
            gp, gu = prior * fp, -fu
        gradient = np.zeros(weights.size + 1)
        for rows, slope in ((p, gp / len(p)), (u, gu / len(u))):
            sizes = [len(r) for r in rows]
            if sum(sizes):
                gradient[:-1] += np.bincount(
                    np.concatenate(rows), np.repeat(slope, sizes), minlength=weights.size
                )
            gradient[-1] += slope.sum()
        gradient[:-1] += DECAY * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    whole = np.zeros(1 << BITS)
    whole[chosen] = weights
    return whole, bias


def sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic (1 for positives, 0 for unlabelled) and slots of the training texts.

    Both kinds are the first by a hash of the id, at most so many as the bounds say.
    """
    def first(ids: DataFrame, toxic: int, most: int) -> DataFrame:
        order = F.xxhash64("doc_id")
        some = ids.select("doc_id", order.alias("order")).distinct().orderBy("order", "doc_id")
        return some.limit(most).select("doc_id", F.lit(toxic).alias("toxic"))

    usable = ~is_held_out(F.col("doc_id"))
    ids = first(labels.where(usable & (F.col("toxic") == 1)), 1, MAX_POSITIVE).union(
        first(documents.where(usable), 0, MAX_UNLABELLED)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    kind = dict(documents.dtypes)["doc_id"]
    rows = map_arrow(texts, _feature_rows, f"doc_id {kind}, toxic int, slots array<int>")
    return rows.dropDuplicates(["doc_id", "toxic"])


def fit(
    documents: DataFrame, labels: DataFrame, prior: float | None = None
) -> tuple[np.ndarray, float] | None:
    """The classifier, from labels that are not held out; null without positives.

    ``prior`` is the share of toxic texts among the documents; by default that
    among the labelled rows, which must then hold harmless ones too.
    """
    known = labels.where(~is_held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not counts["toxic"]:
        return None
    # in a fixed order, since training takes random places
    rows = sample(documents, labels).orderBy("toxic", F.xxhash64("doc_id"), "doc_id").toArrow()
    toxic = rows.column("toxic").to_numpy() == 1
    if not toxic.any():
        return None
    lists = rows.column("slots").combine_chunks()
    places = lists.offsets.to_numpy()
    slots = np.split(lists.values.to_numpy(), places[1:-1])
    if prior is None:
        prior = min(max(counts["toxic"] / counts["n"], 0.001), 0.9)
    return train(
        [s for s, t in zip(slots, toxic) if t], [s for s, t in zip(slots, toxic) if not t], prior
    )


def _score_rows(model: tuple[np.ndarray, float] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model if model else (np.zeros(1 << BITS), 0.0)
        for batch in batches:
            texts, parts = _as_bytes(batch.column("text")), []
            for a, b in chunks(texts):
                parts.append(_scores(features(texts[a:b]), weights, bias))
            raw = np.concatenate(parts) if parts else np.full(len(texts), bias)
            score = 1 / (1 + np.exp(-np.clip(raw, -50, 50))) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"]
            )

    return run


def score(documents: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    """doc_id and score of every document."""
    if model:
        weights, bias = model
        weights = weights.astype(np.float32)  # 1 MB, whatever the corpus
        model = weights, bias
    kind = dict(documents.dtypes)["doc_id"]
    return map_arrow(
        documents.select("doc_id", "text"), _score_rows(model), f"doc_id {kind}, score double"
    )


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score(documents, fit(documents, labels))
    return scored.select(
        "doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
