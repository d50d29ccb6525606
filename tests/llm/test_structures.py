"""Manifest, passage removal and source divergence against plain Python."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paystrata.llm import cover_dedup, divergence, merkle
from paystrata.session import new_folder
from tests.llm import brute


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda row: [(v is not None, v) for v in row])


def check_manifest(frame):
    rows = [tuple(r) for r in frame.select(*("doc_id", "source", "lang", "n_chars", "text")).collect()]
    result = merkle.audit(frame).collect()
    assert in_order(result) == in_order(brute.manifest(rows))
    return result


def test_manifest(documents):
    result = check_manifest(documents)
    assert {r["verified"] for r in result} == {True, False}


def test_manifest_of_odd_documents(odd, nothing, spark):
    check_manifest(odd)
    check_manifest(odd.withColumns({"pos": F.lit(1), "node": F.lit("x"), "tree": F.lit("y")}))
    check_manifest(odd.limit(1))
    assert merkle.audit(nothing).count() == 0
    assert merkle.build(nothing).root() is None
    one_each = spark.range(70).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("l"), "id").alias("lang"),
        F.lit(2**63 - 1).alias("n_chars"), F.lit("t").alias("text"),
    )
    check_manifest(one_each)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_only_every_few_levels_are_stored(spark, documents, levels):
    rows = [tuple(r) for r in documents.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    expected = {r[0]: r for r in brute.manifest(rows)}
    folder = new_folder(spark, "manifest")
    built = merkle.build(documents, merkle.tampered(), folder, levels)
    again = merkle.Manifest(spark, folder, levels)
    assert again.root() == built.root() == expected[0][3]
    largest = max(Counter(r[2] for r in rows).values())
    depth = (largest - 1).bit_length()
    for level in range(0, depth + levels):
        if level % levels:
            with pytest.raises(Exception, match="PATH_NOT_FOUND"):
                again.stored("languages", level)
    sizes = Counter(r[2] for r in rows)
    assert again.stored("languages", levels).count() == sum(-(-n >> levels) for n in sizes.values())
    for row in again.proofs().collect():
        _, leaf, subroot, root, proof, folded, _ = expected[row["doc_id"]]
        assert (row["node"], row["subroot"], row["proof_sha256"], row["folded_root"]) == (
            leaf, subroot, proof, folded,
        )
        assert merkle.fold(row["node"], row["steps"]) == root


def test_subtrees_come_whole_however_batches_fall():
    rows = [("a", 0)] * 5 + [("a", 1)] * 3 + [("b", 1)] + [("c", 0)] * 4
    for size in (1, 2, 3, 5, 13):
        batches = [
            pa.RecordBatch.from_pylist([{"tree": t, "block": b} for t, b in rows[i : i + size]])
            for i in range(0, len(rows), size)
        ]
        found = []
        for table, edges in merkle._subtrees(iter(batches)):
            keys = list(zip(table.column("tree").to_pylist(), table.column("block").to_pylist()))
            found += [tuple(keys[a:b]) for a, b in zip(edges, edges[1:])]
        assert [len(f) for f in found] == [5, 3, 1, 4] and all(len(set(f)) == 1 for f in found)


def test_cover_is_a_difference_cover():
    differences = {(a - b) % cover_dedup.PERIOD for a in cover_dedup.COVER for b in cover_dedup.COVER}
    assert differences == set(range(cover_dedup.PERIOD))


def check_passages(frame):
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    result = cover_dedup.digest(frame).collect()
    assert in_order(result) == in_order(brute.passages(rows))
    return result


def test_passages(documents):
    result = check_passages(documents)
    assert sum(r["n_removed"] > 0 for r in result) > 50


def test_passages_of_odd_documents(odd, nothing):
    check_passages(odd)
    check_passages(odd.withColumns({"a": F.lit(1), "text_key": F.lit("x"), "ranges": F.lit(2)}))
    assert cover_dedup.digest(nothing).count() == 0


def test_passages_at_every_place(spark):
    """Passages of 40 to 60 words at random places, in many documents, cut by edges and edits."""
    random.seed(3)
    shared = [[f"s{k}_{i}" for i in range(random.randrange(40, 61))] for k in range(6)]
    texts = []
    for d in range(300):
        words = [f"w{d}_{i}" for i in range(random.randrange(0, 70))]
        for passage in random.sample(shared, 3):
            at = random.randrange(len(words) + 1)
            words[at:at] = passage
        if d % 3 == 0:
            words[random.randrange(len(words))] = "edit"
        if d % 5 == 0:
            words = words[random.randrange(45):]
        texts.append((d, " ".join(words)))
    texts += [(d % 40, t) for d, t in texts[:60]] + [(None, texts[0][1])] * 3
    check_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(7))


def test_passages_of_few_words(spark):
    """Periodic texts: every anchor occurs at many places of a document, and of others."""
    random.seed(4)
    texts = [(0, "a " * 500), (1, "a " * 49), (2, "a " * 50), (3, "b " + "a " * 60)]
    texts += [(d, " ".join(random.choices("ab", weights=(40, 1), k=200))) for d in range(4, 40)]
    check_passages(spark.createDataFrame(texts, "doc_id long, text string"))


def test_a_long_text(spark):
    random.seed(5)
    words = [str(random.randrange(10**6)) for _ in range(400_000)]
    texts = [(1, " ".join(words[200_000:200_300])), (2, "  ".join(words)), (3, "\n".join(words[:100]))]
    rows = {r["doc_id"]: r for r in cover_dedup.deduplicate(
        spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [rows[d]["n_removed"] for d in (1, 2, 3)] == [0, 300, 100]
    assert [tuple(s) for s in rows[2]["spans"]] == [(200_000, 200_300)]
    assert rows[3]["kept"] == "" and rows[1]["kept"] == texts[0][1]


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_meeting_does_not_depend_on_batches(size):
    random.seed(size)
    rows = sorted({
        (random.randrange(12), random.randrange(3), random.randrange(4), 0, random.randrange(9))
        for _ in range(400)
    })
    columns = [np.array(c, dtype=np.int64) for c in zip(*rows)]
    a, b, doc, key, low = columns
    batches = (
        cover_dedup._batch(*(x[i : i + size] for x in (doc, key, low, low)), cover_dedup.CANDIDATE,
                           a[i : i + size], b[i : i + size])
        for i in range(0, len(rows), size)
    )
    found = sorted(
        (d, p, s) for batch in cover_dedup._meet(batches, windows=False)
        for d, p, s in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "low", "settled")))
    )
    expected = []
    for x, y, d, _, p in rows:
        group = [r for r in rows if r[0] == x]
        if d > min(r[2] for r in group if r[1] == y):
            expected.append((d, p, True))
        elif len({r[1] for r in group}) > 1 and len({r[2] for r in group}) > 1:
            expected.append((d, p, False))
    assert found == sorted(expected)


def test_anchors_in_many_contexts_of_a_batch_stay_open():
    """More contexts than a batch passes on: the rest is open, and two documents are two."""
    shared = " ".join(f"s{i}" for i in range(20))
    ids = list(range(200))
    texts = [" ".join([*(f"l{d}_{i}" for i in range(31)), shared, *(f"r{d}_{i}" for i in range(31))]) for d in ids]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(ids), pa.array(texts)], ["doc_id", "text_key", "text"]
    )
    rows = pa.Table.from_batches(list(cover_dedup._anchor_rows(iter([batch])))).to_pylist()
    opened = {r["doc_id"] for r in rows if r["kind"] == cover_dedup.OPEN}
    hot = Counter(r["a"] for r in rows if r["kind"] == cover_dedup.CANDIDATE).most_common(1)[0]
    assert 64 <= hot[1] <= 66 and len(opened) == 200 - hot[1]
    meeting = {r["doc_id"] for r in rows if r["a"] == hot[0]}
    assert meeting | opened == set(ids) and {0, 199} <= meeting


def check_divergence(frame):
    rows = [tuple(r) for r in frame.select("lang", "source", "text").collect()]
    result = divergence.audit(frame).collect()
    assert in_order(result) == in_order(brute.divergences(rows))
    return result


def test_divergence(documents):
    result = check_divergence(documents)
    assert {r["part"] for r in result} == {"pair", "term"}


def test_divergence_of_odd_documents(odd, nothing):
    check_divergence(odd)
    check_divergence(odd.withColumns({"g": F.lit(1), "term": F.lit("x"), "count": F.lit(2)}))
    assert divergence.audit(nothing).count() == 0


def test_divergence_of_many_sources_and_terms(spark):
    """More sources than a tile has rows, and more terms than it has columns."""
    random.seed(6)
    rows = []
    for d in range(600):
        source = f"s{int(random.expovariate(0.05))}"
        picked = [f"t{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{chr(97 + n // 676)}"
                  for n in (int(random.paretovariate(0.5)) % 3000 for _ in range(120))]
        rows.append(("xy"[d % 2], source, " ".join(picked)))
    rows += [("x", "empty", ""), ("z", "only", "one"), ("z", "other", None), (None, None, "a a")]
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    result = check_divergence(frame)
    assert len({r["source"] for r in result if r["lang"] == "x"}) > divergence.ROWS


@pytest.mark.parametrize("filled", [0.0, 0.01, 0.3, 1.0])
@pytest.mark.parametrize("same", [True, False])
def test_joint_traversal(filled, same):
    generator = np.random.default_rng(8)
    width = 700
    sides = []
    for size in (9, 9 if same else 5):
        zero = generator.integers(1, 1000, size)
        weights = np.repeat(zero[:, None], width, 1)
        row, column = np.nonzero(generator.random((size, width)) < filled)
        weights[row, column] = generator.integers(1, 10**9, len(row))
        sides.append((divergence.Tree(row, column, weights[row, column], width), zero, weights))
    if same:
        sides[1] = sides[0]
    (left, zero_left, p), (right, zero_right, q) = sides
    forth, back = divergence.price_pairs(left, right, zero_left, zero_right, width, same)
    for i in range(len(p)):
        for j in range(len(q)):
            if not same or i < j:
                square = (p[i] - q[j]) ** 2
                assert forth[i, j] == (square // q[j]).sum() and back[i, j] == (square // p[i]).sum()


def test_empty_quadrants_are_not_opened():
    """The squares of a level are those that hold a cell, not the tile's area."""
    tree = divergence.Tree(np.array([0, 0, 31]), np.array([0, 1, 1023]), np.array([5, 6, 7]), 1024)
    assert [len(s) for s in tree.squares] == [1, 2, 2, 2, 2, 3]
