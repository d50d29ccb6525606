"""Derived forms are sized by their rows, kept compressed, and equal each other."""

import pytest
from pyspark.sql import functions as F

from paystrata.plans import registry, views
from paystrata.schema import PAYMENT_SCHEMA
from paystrata.session import MIB, SCAN_BYTES, STATE_STORE, bytes_at, new_folder, scans_of
from paystrata.sinks import keyed_table
from paystrata.sinks.keyed_table import Batch, KeyedTable
from paystrata.sinks.layouts import write_sorted
from paystrata.sources import files, testdata, topics
from paystrata.streaming import jobs


@pytest.fixture
def sizes(monkeypatch):
    """Forms written anew, and the sizes that their numbers of files are taken from."""
    seen, plain = [], testdata.partitions_for
    monkeypatch.setattr(testdata, "_written", {})
    monkeypatch.setattr(
        testdata, "partitions_for", lambda spark, size: seen.append(size) or plain(spark, size)
    )
    return seen


@pytest.mark.parametrize(
    ("path_of", "shares"),
    [(testdata.payments_path, [1]), (testdata.csv_path, [1]), (testdata.topics_root, [0.5, 0.5])],
)
def test_files_follow_the_rows_not_the_compressed_input(spark, folder, sizes, path_of, shares):
    path_of(spark, folder)
    n = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    assert sizes == [n * testdata.ROW_BYTES * share for share in shares]


def test_text_forms_are_compressed(spark, folder):
    lines = files.read_lines(spark, testdata.csv_path(spark, folder)).count()
    assert bytes_at(spark, testdata.csv_path(spark, folder)) < 60 * lines
    assert bytes_at(spark, testdata.topics_root(spark, folder)) < 60 * lines


def test_documents_are_compressed_and_written_within_a_bounded_scan(spark, folder, monkeypatch):
    seen, plain = [], testdata.scans_of
    testdata.payments_path(spark, folder)
    monkeypatch.setattr(testdata, "_written", {k: v for k, v in testdata._written.items() if k[1] != "documents"})
    monkeypatch.setattr(
        testdata, "scans_of", lambda spark, stored, size: seen.append((stored, size)) or plain(spark, stored, size)
    )
    path = testdata.documents_path(spark, folder)
    rows = testdata.payments(spark, folder)
    assert bytes_at(spark, path) < 60 * rows.count()
    assert seen == [(bytes_at(spark, testdata.payments_path(spark, folder)), rows.count() * testdata.ROW_BYTES)]
    read = files.bind(files.read_documents(spark, path))
    assert read.count() == rows.count() and read.exceptAll(rows).count() == 0


def test_topics_hold_the_lines_of_the_delimited_copy_in_its_order(spark, folder):
    def in_order(lines):
        rows = lines.select("value", "_metadata.file_path", F.monotonically_increasing_id().alias("n"))
        return [r["value"] for r in rows.orderBy("file_path", "n").collect()]

    csv = in_order(spark.read.text(testdata.csv_path(spark, folder)))
    csv = [line for line in csv if not line.startswith("Change_Type")]
    root, found = testdata.topics_root(spark, folder), []
    for topic in testdata.TOPICS:
        reader = spark.read.option("recursiveFileLookup", True)
        messages = in_order(reader.text(f"{root}/{topic}"))
        chosen = set(messages)
        assert messages == [line for line in csv if line in chosen]
        found += messages
    assert sorted(found) == sorted(csv)


def test_what_is_made_after_the_shuffle_is_sorted_too(spark, tmp_path):
    path = str(tmp_path / "sorted")
    write_sorted(
        spark.range(1000), path, ["key"], partitions=4, places={"key": F.lpad(F.col("id"), 4, "0")},
        made=lambda rows: rows.select(F.lpad(F.col("id"), 4, "0").alias("key")),
    )
    read = spark.read.parquet(path).select("key", "_metadata.file_path", F.monotonically_increasing_id().alias("n"))
    assert [r["key"] for r in read.orderBy("file_path", "n").collect()] == [f"{n:04d}" for n in range(1000)]


def upserted(spark, payments):
    table = KeyedTable(spark, new_folder(spark, "narrow")).create()
    table.upsert(payments.limit(500), "r0", 0)
    table.upsert(payments.limit(300).withColumn("amount", F.lit(1.0)), "r0", 1)
    return table


def test_current_rows_carry_only_the_columns_asked_for(spark, payments):
    table, names = upserted(spark, payments), ["payer", "amount"]
    narrow, whole = table.current(columns=names), table.current().select(*names)
    assert narrow.exceptAll(whole).count() == 0 and narrow.count() == whole.count()
    assert "recipient_city" not in narrow._jdf.queryExecution().executedPlan().toString()


def test_the_changes_of_a_batch_are_one_pass_over_the_log_in_its_range(spark, payments):
    table = upserted(spark, payments)
    changes = table.changes(Batch("r0", 1), ["payer", "amount"])
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(_id" in plan
    signed = changes.groupBy("_sign").agg(F.count("*"), F.sum("amount")).orderBy("_sign").collect()
    n = payments.limit(300).select("_id").distinct().count()
    assert [r[0] for r in signed] == [-1, 1] and [r[1] for r in signed] == [n, n] and signed[1][2] == n
    with pytest.raises(ValueError, match="last"):
        table.changes(Batch("r0", 0), ["payer"])


def test_micro_batches_do_not_grow_with_the_files(spark, folder, monkeypatch):
    monkeypatch.setattr(testdata, "_written", {})
    monkeypatch.setattr(testdata, "partitions_for", lambda _spark, _size: 40)
    assert registry._files_per_batch(spark, folder) == 10
    monkeypatch.setattr(testdata, "_written", {})
    monkeypatch.setattr(testdata, "partitions_for", lambda _spark, _size: 8)
    assert registry._files_per_batch(spark, folder) == registry.FILES_PER_BATCH


def test_report_state_is_on_disk_and_the_session_keeps_its_own(spark, folder):
    checkpoint, before = new_folder(spark, "checkpoint"), spark.conf.get(STATE_STORE, None)
    table = jobs.report_table(spark, new_folder(spark, "report")).create()
    stream = topics.folder_stream(spark, testdata.topics_root(spark, folder), testdata.TOPICS[0])
    jobs.refresh_report(stream, table, "r0", checkpoint, True).awaitTermination()
    names = table._names_in(f"{checkpoint}/state/0/0")
    assert any(n.endswith((".zip", ".changelog")) for n in names)
    assert not any(n.endswith(".delta") for n in names)
    assert spark.conf.get(STATE_STORE, None) == before


def tied(spark):
    """One key twice in a batch without ``_seq``: the greater payer wins, with the less amount."""
    table = KeyedTable(spark, new_folder(spark, "tied")).create()
    data = [("k", "1", "d", payer, amount, name, *[None] * 9) for payer, amount, name in
            [("b", 1.0, "s"), ("a", 9.0, "t")]]
    table.upsert(spark.createDataFrame(data, PAYMENT_SCHEMA), "r0", 0)
    return table


def test_the_same_row_wins_whatever_columns_are_asked_for(spark):
    table, names = tied(spark), ["physician_specialty", "amount"]
    assert [tuple(r) for r in table.current(columns=names).collect()] == [("s", 1.0)]
    assert [tuple(r) for r in spark.sql(f"SELECT * FROM {table.sql(names)}").collect()] == [("s", 1.0)]
    assert [tuple(r) for r in table.changes(Batch("r0", 0), names).collect()] == [("s", 1.0, 1)]


def test_a_stored_view_moves_only_the_columns_that_it_reads(spark, payments):
    table = upserted(spark, payments)
    views.create_stored_views(spark, table.path, "narrow_views")
    views.create_session_views(spark, table.current())
    for name in views.VIEWS:
        stored, plain = spark.table(f"narrow_views.{name}"), spark.table(name)
        assert stored.columns == plain.columns
        if name in views.VIEW_COLUMNS:
            stored, plain = ([(*r[:-1], round(r[-1], 2)) for r in f.collect()] for f in (stored, plain))
            assert sorted(stored, key=repr) == sorted(plain, key=repr)
        else:
            assert stored.exceptAll(plain).count() == 0 and stored.count() == plain.count()
    frame = spark.table("narrow_views.physicians_by_specialty_revenue")
    assert "recipient_city" not in frame._jdf.queryExecution().executedPlan().toString()


def test_a_scan_is_cut_by_its_rows_and_the_session_keeps_its_own(spark, folder):
    path, before = testdata.joined_path(spark, folder), spark.conf.get(SCAN_BYTES)
    stored = bytes_at(spark, path)
    with scans_of(spark, stored, 128 * stored, MIB * 256):
        assert spark.conf.get(SCAN_BYTES) == str(max(MIB, 2 * MIB * stored // stored))
    with scans_of(spark, stored, stored // 100):
        assert spark.conf.get(SCAN_BYTES).rstrip("b") == before.rstrip("b")
    assert spark.conf.get(SCAN_BYTES) == before


def test_derived_tables_are_small(spark, folder, payments):
    path = testdata.payments_path(spark, folder)
    assert all(".zstd." in name for name in spark.read.parquet(path).inputFiles())
    table = upserted(spark, payments)
    table.fold()
    table.upsert(payments.limit(5), "r1", 0)
    for rows in (table.log(table.batches()), table.base()):
        assert all(".zstd." in name for name in rows.inputFiles())


def test_forms_are_sorted_within_a_bounded_scan(spark, folder, monkeypatch):
    seen, plain = [], testdata.write_sorted
    monkeypatch.setattr(testdata, "_written", {})
    monkeypatch.setattr(
        testdata, "write_sorted",
        lambda *args, **more: seen.append(int(spark.conf.get(SCAN_BYTES).rstrip("b"))) or plain(*args, **more),
    )
    testdata.payments_path(spark, folder)
    assert seen[0] < 128 * MIB


def test_a_log_is_compared_in_tasks_of_few_rows(spark, monkeypatch):
    """However small the rows are stored: one file here, which one task would read."""
    monkeypatch.setattr(keyed_table, "SMALL_LOG", 0)
    table, n, own = KeyedTable(spark, new_folder(spark, "few")).create(), 700_000, spark.conf.get(SCAN_BYTES)
    values = {"_id": F.md5(F.col("id").cast("string")), "amount": F.col("id").cast("double")}
    rows = spark.range(n, numPartitions=1).select(
        *[values.get(f.name, F.lit("same")).cast(f.dataType).alias(f.name) for f in PAYMENT_SCHEMA]
    )
    table.upsert(rows, "r0")
    spark.conf.set("spark.sql.files.minPartitionNum", 1)
    try:
        held = table._compared(table.batches())
        counts = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
        current = table.current()
        assert current.count() == n and current.sparkSession is spark and held.sparkSession is spark
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sum(counts) == n and max(counts) <= 2 * keyed_table.ROWS_TOGETHER and len(counts) > 1
    assert spark.conf.get(SCAN_BYTES) == own


def test_the_runs_of_a_pass_go_on_side_by_side(spark, folder, monkeypatch):
    """And where one fails, the others are stopped."""
    table = KeyedTable(spark, new_folder(spark, "side-by-side")).create()
    events, plain = [], jobs.upsert_parsed

    class Run:
        def __init__(self, query, fails):
            self.query, self.fails = query, fails

        def awaitTermination(self):  # noqa: N802
            events.append("awaited")
            if self.fails:
                raise RuntimeError("lost")
            self.query.awaitTermination()

        def stop(self):
            self.query.stop()

    def started(fails):
        def start(*args, **more):
            events.append(args[2])
            return Run(plain(*args, **more), fails)

        return start

    monkeypatch.setattr(jobs, "upsert_parsed", started(False))
    registry._stream_into(spark, folder, table, 0)
    assert events == ["pass0-0", "pass0-1", "awaited", "awaited"]
    assert table.current().count() == testdata.payments(spark, folder).select("_id").distinct().count()
    assert {b.run_id for b in table.batches()} == {"pass0-0", "pass0-1"}
    monkeypatch.setattr(jobs, "upsert_parsed", started(True))
    with pytest.raises(RuntimeError, match="lost"):
        registry._stream_into(spark, folder, table, 1)
    assert spark.streams.active == []
