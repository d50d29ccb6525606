"""Streams over topic folders, run to the end of what is there."""

import pytest
from pyspark.sql import functions as F

from paystrata.operators import etl, report
from paystrata.session import new_folder
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sinks.messages import publish_to_folder
from paystrata.sources import testdata, topics
from paystrata.streaming import jobs
from tests.test_fields import line


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)


def record(key, amount):
    return line(physician_id=key, date_payment="02/12/2016", record_id="1", amount=str(amount))


def amounts(table):
    return {r.physician_id: r.amount for r in table.current().collect()}


def ingest(spark, root, table, run_id, checkpoint, names="t"):
    query = jobs.upsert_parsed(
        topics.folder_stream(spark, root, names), table, run_id, checkpoint, available_now=True
    )
    query.awaitTermination()
    return query


def test_topic_names():
    assert topics.topic_names("a,b,a,,c") == ["a", "b", "c"]


def test_kafka_options():
    options = topics.kafka_options("a,b,a", "host:1", group="g", max_offsets_per_trigger=9)
    assert options["maxOffsetsPerTrigger"] == "9"
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest"
    assert options["groupIdPrefix"] == "g" and options["kafkaConsumer.pollTimeoutMs"] == "5000"


def test_ingest_resume_and_replay(spark):
    root, checkpoint = new_folder(spark, "topics"), new_folder(spark, "checkpoint")
    table = KeyedTable(spark, new_folder(spark, "table")).create()
    publish_to_folder(messages(spark, record("a", 1), record("b", 2), "bad,line"), f"{root}/t")
    ingest(spark, root, table, "r0", checkpoint)
    assert amounts(table) == {"a": 1.0, "b": 2.0}

    query = ingest(spark, root, table, "r0", checkpoint)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 0

    publish_to_folder(messages(spark, record("b", 5), record("c", 3)), f"{root}/t")
    ingest(spark, root, table, "r0", checkpoint)
    assert amounts(table) == {"a": 1.0, "b": 5.0, "c": 3.0}

    ingest(spark, root, table, "r1", new_folder(spark, "checkpoint"))
    assert amounts(table) == {"a": 1.0, "b": 5.0, "c": 3.0}


def test_timed_run_picks_up_new_messages_until_stopped(spark):
    root, path = new_folder(spark, "topics"), new_folder(spark, "parsed")
    publish_to_folder(messages(spark, record("a", 1)), f"{root}/t")
    query = jobs.store_parsed(
        topics.folder_stream(spark, root, "t"), path, new_folder(spark, "checkpoint"),
        interval="200 milliseconds",
    )
    try:
        query.processAllAvailable()
        publish_to_folder(messages(spark, record("b", 2)), f"{root}/t")
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.physician_id for r in spark.read.parquet(path).collect()) == ["a", "b"]
    assert not query.isActive


def test_later_line_of_a_file_wins(spark):
    root = new_folder(spark, "topics")
    table = KeyedTable(spark, new_folder(spark, "table")).create()
    texts = [record("a", n) for n in (3, 9, 2, 7, 5)]
    publish_to_folder(messages(spark, *texts), f"{root}/t")
    ingest(spark, root, table, "r0", new_folder(spark, "checkpoint"))
    assert amounts(table) == {"a": 5.0}


def test_counts_over_several_batches(spark):
    root, path = new_folder(spark, "topics"), new_folder(spark, "counts")
    for n in (2, 3, 4):
        publish_to_folder(messages(spark, *["x"] * n), f"{root}/t")
    stream = topics.folder_stream(spark, root, "t", max_files_per_trigger=1)
    jobs.count_messages(stream, path, new_folder(spark, "checkpoint"), True).awaitTermination()
    rows = jobs.message_counts(spark, path).orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2]
    assert sorted(r.batch_messages for r in rows) == [2, 3, 4]
    totals = [r.total_messages for r in rows]
    assert totals[-1] == 9 and totals == [sum(r.batch_messages for r in rows[:i + 1]) for i in range(3)]


def test_two_topics_named_twice(spark):
    root = new_folder(spark, "topics")
    publish_to_folder(messages(spark, record("a", 1)), f"{root}/t")
    publish_to_folder(messages(spark, record("b", 2)), f"{root}/u")
    path = new_folder(spark, "parsed")
    jobs.store_parsed(
        topics.folder_stream(spark, root, "t,u,t"), path, new_folder(spark, "checkpoint"), True
    ).awaitTermination()
    assert sorted(r.physician_id for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_peek_keeps_ten(spark):
    root, path = new_folder(spark, "topics"), new_folder(spark, "peek")
    publish_to_folder(messages(spark, *[record(f"p{n}", n) for n in range(25)]), f"{root}/t")
    stream = topics.folder_stream(spark, root, "t")
    jobs.peek(stream, path, new_folder(spark, "checkpoint"), available_now=True).awaitTermination()
    assert spark.read.parquet(path).count() == 10


def test_report_refresh_over_batches_equals_the_batch_report(spark, folder):
    root = testdata.topics_root(spark, folder)
    table = jobs.report_table(spark, new_folder(spark, "report")).create()
    stream = topics.folder_stream(spark, root, ",".join(testdata.TOPICS), max_files_per_trigger=3)
    query = jobs.refresh_report(stream, table, "r0", new_folder(spark, "checkpoint"), True)
    query.awaitTermination()
    assert len(query.recentProgress) > 1
    cents = F.round("us_dollars", 2).alias("us_dollars")
    live = table.current().withColumn("us_dollars", cents)
    batch = report.open_payments(testdata.payments(spark, folder)).withColumn("us_dollars", cents)
    assert live.exceptAll(batch).count() == 0 and live.count() == batch.count()


def test_stream_equals_batch(spark, folder):
    root = testdata.topics_root(spark, folder)
    path = new_folder(spark, "parsed")
    stream = topics.folder_stream(spark, root, ",".join(testdata.TOPICS))
    jobs.store_parsed(stream, path, new_folder(spark, "checkpoint"), True).awaitTermination()
    batch = etl.parse_lines(spark.read.option("recursiveFileLookup", True).text(root))
    live = spark.read.schema(batch.schema).parquet(path)
    assert live.exceptAll(batch).count() == 0 and live.count() == batch.count()


def test_kafka_records_are_ordered_by_offset(spark):
    text = {n: record("a", n) for n in (4, 8, 6)}
    records = spark.createDataFrame(
        [(None, bytearray(text[n], "utf8"), "t", 0, offset) for offset, n in enumerate(text)],
        "key binary, value binary, topic string, partition int, offset bigint",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    table = KeyedTable(spark, new_folder(spark, "table")).create()
    batch = topics.kafka_messages(records)
    assert batch.columns == ["value", "topic", topics.SEQUENCE]
    table.upsert(etl.parse_lines(batch, carry=[topics.SEQUENCE]), "r0")
    assert amounts(table) == {"a": 6.0}


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="kafka"):
        topics.kafka_stream(spark, "a", "host:1")
