"""Loads that name their bad rows, finds that count while they write, and what runs tell."""

import pytest
from pyspark.sql import functions as F

from paystrata import __main__ as cli
from paystrata.operators.find import find_count, write_found
from paystrata.plans.questions import QUESTIONS, ask, values_of
from paystrata.plans.views import create_stored_views, using
from paystrata.schema import CSV_COLUMNS, PAYMENT_SCHEMA
from paystrata.session import new_folder
from paystrata.sinks import loading
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sinks.layouts import write_with_filters
from paystrata.sinks.messages import publish_to_folder
from paystrata.sources import files, topics
from paystrata.streaming import jobs
from paystrata.streaming.lifecycle import RunLog
from tests.test_fields import line
from tests.test_keyed_table import scanned


def row(record, amount, physician="7"):
    return line(physician_id=physician, date_payment="02/17/2016", record_id=record, payer="p", amount=amount)


@pytest.fixture
def table(spark):
    return KeyedTable(spark, new_folder(spark, "loaded")).create()


def write(tmp_path, *rows):
    path = tmp_path / "payments.csv"
    path.write_text("\n".join([",".join(CSV_COLUMNS), *rows]) + "\n")
    return str(path)


def test_all_bad_rows_are_named_and_nothing_is_written(spark, tmp_path, table):
    rejects = str(tmp_path / "rejects")
    file = write(tmp_path, row("1", "5"), row("2", "n/a"), row("3", ""), ",".join(["x"] * 40), row("4", "6"))
    with pytest.raises(loading.BadRows) as caught:
        loading.load(spark, file, table, "r0", rejects)
    assert caught.value.n == 3 and "record 2: 'n/a' not an amount" in str(caught.value)
    assert table.batches() == [] and table.current().count() == 0
    listed = {(r.record_id, r.why) for r in spark.read.parquet(f"{rejects}/r0").collect()}
    assert listed == {("2", "not an amount"), ("3", "not an amount"), (None, "too few columns")}


def test_many_bad_rows_are_counted_and_the_first_named(spark, tmp_path, table):
    file = write(tmp_path, *[row(f"{n:03d}", "bad") for n in range(50)])
    with pytest.raises(loading.BadRows, match="50 bad rows.*record 019.*and 30 more"):
        loading.load(spark, file, table, "r0", str(tmp_path / "rejects"))


def test_rows_that_lack_only_unused_columns_are_loaded(spark, tmp_path, table):
    short = ",".join(row("2", "6").split(",")[:50])
    loading.load(spark, write(tmp_path, row("1", "5"), short), table, "r0", str(tmp_path / "rejects"))
    assert sorted(r.amount for r in table.current().collect()) == [5.0, 6.0]


def test_a_find_counts_what_it_writes(spark, table):
    data = [(f"k{n}", None, None, "p", float(n), *[None] * 10) for n in range(100)]
    table.upsert(spark.createDataFrame(data, PAYMENT_SCHEMA), "r0")
    where = {"$ge": {"amount": 40}}
    path = new_folder(spark, "found")
    n = write_found(table.current(), path, where, "_id,amount")
    assert n == spark.read.text(path).count() == find_count(table.current(), where).first().n_found == 60
    assert write_found(table.current(), new_folder(spark, "found"), where, limit=7) == 7
    assert write_found(table.current(), new_folder(spark, "found"), {"$ge": {"amount": 999}}) == 0


def executions(spark):
    """Plans of the SQL executions so far."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [found.apply(i).physicalPlanDescription() for i in range(found.size())]


def test_a_find_reads_its_table_once(spark, tmp_path, table, capsys):
    data = [(f"k{n}", None, None, "p", float(n), *[None] * 10) for n in range(100)]
    table.upsert(spark.createDataFrame(data, PAYMENT_SCHEMA), "r0")
    table.fold()
    before = len(executions(spark))
    cli.main(["find", "--table", table.path, "--where", '{"$ge": {"amount": 40}}', "--fields", "_id,amount"], spark)
    shown = capsys.readouterr().out
    assert "60 found in" in shown and shown.count('"amount"') == 60
    plans = [p for p in executions(spark)[before:] if "paystrata_bases" in p and "Scan parquet" in p]
    assert len(plans) == 1 and plans[0].count("ReadSchema") == 1
    assert "ReadSchema: struct<_id:string,amount:double>" in plans[0]
    assert "GreaterThanOrEqual(amount,40.0)" in plans[0]


def test_filters_skip_row_groups_of_an_unsorted_copy(spark):
    """Each payer and key stands in one of eight files, whose ranges of values overlap.

    Payers are few, so their dictionaries already tell; keys outgrow the dictionary.
    """
    frame = spark.range(400_000, numPartitions=8).select(
        F.concat(F.lit("k"), F.md5(F.col("id").cast("string"))).alias("_id"),
        F.concat(F.lit("payer"), F.md5((F.col("id") / 500).cast("int").cast("string"))).alias("payer"),
        F.col("id").cast("double").alias("amount"),
    )
    plain, filtered = new_folder(spark, "plain"), new_folder(spark, "filtered")
    frame.write.parquet(plain)
    write_with_filters(frame, filtered, distinct=50_000)
    read = {}
    for column in ("payer", "_id"):
        value = frame.where("amount = 200000").first()[column]
        for path in (plain, filtered):
            found = spark.read.parquet(path).where(F.col(column) == value)
            read[column, path] = scanned(found)[1]
            assert found.count() == (500 if column == "payer" else 1)
    assert read["payer", plain] == read["payer", filtered] == 50_000
    assert read["_id", plain] == 400_000 and read["_id", filtered] == 50_000


def test_a_quote_in_a_value_is_a_character(spark):
    data = [("O'Hara_02/1_1", "O'Hara", "02/01/2016", "p", 1.0, *[None] * 10),
            ("x_02/1_1", "x", "02/01/2016", "p", 2.0, *[None] * 10)]
    spark.createDataFrame(data, PAYMENT_SCHEMA).createOrReplaceTempView("quoted")
    assert [r.physician_id for r in ask(spark, "physician", "quoted", physician="O'H").collect()] == ["O'Hara"]
    assert ask(spark, "physician", "quoted", physician="' OR '1'='1").count() == 0
    assert ask(spark, "month", "quoted", month="02").count() == 2
    assert ask(spark, "natures", "quoted", limit=1).count() == 1
    with pytest.raises(ValueError, match="takes"):
        ask(spark, "month", "quoted", day="02")
    assert values_of("above", {"floor": "5", "limit": "2"}) == {"floor": 5.0}
    for name in QUESTIONS:
        ask(spark, name, "quoted").collect()


def test_views_are_kept_in_the_chosen_namespace(spark, table):
    before = spark.catalog.currentDatabase()
    names = create_stored_views(spark, table.path, "chosen_views")
    assert spark.catalog.currentDatabase() == before
    assert all(spark.catalog.tableExists(name) for name in names)
    with pytest.raises(ZeroDivisionError), using(spark, "other_views"):
        assert spark.catalog.currentDatabase() == "other_views"
        1 / 0
    assert spark.catalog.currentDatabase() == before


def publish(spark, root, *texts):
    publish_to_folder(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), f"{root}/t")


def test_a_run_that_is_stopped_tells_its_batches(spark):
    root, lines = new_folder(spark, "topics"), []
    publish(spark, root, row("1", "1"), row("2", "2"))
    with RunLog(lines.append).on(spark) as log:
        query = jobs.store_parsed(
            topics.folder_stream(spark, root, "t"), new_folder(spark, "parsed"),
            new_folder(spark, "checkpoint"), interval="100 milliseconds",
        )
        try:
            query.processAllAvailable()
            publish(spark, root, row("3", "3"))
            query.processAllAvailable()
        finally:
            query.stop()
        run = log.of(query)
    assert [batch[1:] for batch in run.batches] == [(2, 2), (1, 3)] and run.total == 3
    assert run.reason == "ended"
    assert lines[0].endswith("started") and "1 messages, 3 in all" in lines[2]
    assert lines[-1].endswith("ended after 3 messages")
    assert [r.total_messages for r in log.frame(spark).orderBy("batch_id").collect()] == [2, 3]


def test_a_run_that_fails_tells_why(spark):
    root = new_folder(spark, "topics")
    publish(spark, root, row("1", "1"))

    def fail(_batch, _batch_id):
        raise ValueError("no space left")

    with RunLog().on(spark) as log:
        query = topics.folder_stream(spark, root, "t").writeStream.trigger(availableNow=True).option(
            "checkpointLocation", new_folder(spark, "checkpoint")).foreachBatch(fail).start()
        with pytest.raises(Exception, match="no space left"):
            query.awaitTermination()
        assert log.of(query).reason.startswith("failed: ")


def test_counts_are_the_same_however_messages_are_passed_on(spark, capsys):
    root = new_folder(spark, "topics")
    publish(spark, root, *[row(str(n), "1") for n in range(5)])
    publish(spark, root, *[row(str(n), "1") for n in range(3)])
    for options in ({"show": 0}, {"show": None}, {"show": 2}, {"to": new_folder(spark, "passed-on")}):
        path = new_folder(spark, "counts")
        jobs.count_messages(
            topics.folder_stream(spark, root, "t", 1), path, new_folder(spark, "checkpoint"), True, **options
        ).awaitTermination()
        rows = jobs.message_counts(spark, path).orderBy("batch_id").collect()
        assert [(r.batch_messages, r.total_messages) for r in rows] == [(5, 5), (3, 8)]
    assert spark.read.option("recursiveFileLookup", True).text(options["to"]).count() == 8


def test_peek_keeps_the_lines_it_cannot_parse(spark):
    root, rejects = new_folder(spark, "topics"), new_folder(spark, "rejects")
    publish(spark, root, row("1", "1"), "short,line")
    jobs.peek(
        topics.folder_stream(spark, root, "t"), new_folder(spark, "peek"), new_folder(spark, "checkpoint"),
        available_now=True, rejects=rejects,
    ).awaitTermination()
    lost = spark.read.option("recursiveFileLookup", True).parquet(rejects)
    assert [r.value for r in lost.collect()] == ["short,line"]


def test_corrupt_rows_are_seen_whatever_columns_are_asked_for(spark, tmp_path):
    file = write(tmp_path, row("1", "5"), "too,short")
    source = files.read_csv(spark, file, with_corrupt=True)
    assert [tuple(r) for r in source.select("Record_ID", "_corrupt_record").collect()] == [
        ("1", None), (None, "too,short"),
    ]
