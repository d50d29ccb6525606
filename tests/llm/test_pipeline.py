"""The pipeline, stage by stage, against plain Python."""

import corpus_pipeline
from paystrata.llm import pii
from tests.llm import brute
from tests.llm.test_free import library


def stages(spark, frame, folder):
    results = []
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, folder)
        results.append(frame)
    return results


def test_stages_against_plain_python(spark, documents, folder):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    first, second, third, fourth, last = stages(spark, documents, folder)

    def failed(text):
        n, _, _, _, repeated = brute.quality(text)
        return n < 50 or 100 * repeated > 50 * n

    passed = [(d, t) for d, t in rows.items() if not failed(t)]
    assert {r["doc_id"] for r in first.collect()} == {d for d, _ in passed}
    single = {c for _, c in brute.groups(passed).values()}
    assert {r["doc_id"] for r in second.collect()} == single
    clean = {d for d in single if not brute.leaks(rows[d], items)}
    assert {r["doc_id"] for r in third.collect()} == clean
    private = {r["doc_id"]: r["text"] for r in fourth.collect()}
    assert set(private) == clean
    assert any(private[d] != rows[d] for d in clean)
    ids, decoded = library(list(private.values()))
    result = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(result) == clean
    for d, i, t in zip(private, ids, decoded):
        assert result[d]["ids"] == i and result[d]["n_tokens"] == len(i)
        assert result[d]["decoded_sha256"] == brute.sha(t) and t == private[d]
    for frame in (first, second, third, fourth):
        assert frame.columns == documents.columns


def test_stages_take_odd_documents(spark, odd, nothing, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0
        stage(spark, odd, folder).collect()


def test_pii_stage_changes_private_values_only(spark, folder):
    frame = spark.createDataFrame([(1, "write x.1@mail1.example.com now", 99)], "doc_id long, text string, n_chars long")
    row = pii.pseudonymise(frame).first()
    assert "x.1@" not in row["text"] and row["n_chars"] == len(row["text"])
