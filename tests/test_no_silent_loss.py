"""Nothing is dropped without trace, and the later row wins."""

import pytest
from pyspark.sql import functions as F

from paystrata import __main__ as cli
from paystrata.functions.measures import whole_dollars
from paystrata.operators import etl
from paystrata.schema import CSV_COLUMNS, SOURCE_POSITIONS
from paystrata.sources import files, topics


def line(**values):
    cells = [""] * len(CSV_COLUMNS)
    for name, text in values.items():
        cells[SOURCE_POSITIONS[name]] = text
    return ",".join(cells)


def payment(payer, amount, record="1"):
    return line(physician_id="7", date_payment="02/17/2016", record_id=record, payer=payer, amount=amount)


def test_short_lines_are_no_records_in_standard_mode(spark):
    lines = spark.createDataFrame([("short,line",), ("another,short,one",), (payment("a", "1"),)], "value string")
    assert etl.parse_standard_csv(lines).count() == 1
    assert etl.rejected_lines(lines).count() == 2


def test_stream_keeps_rejects(spark, tmp_path):
    topic = tmp_path / "topics" / "t"
    topic.mkdir(parents=True)
    (topic / "one.txt").write_text(payment("a", "1") + "\nshort,line\n" + payment("b", "2", "2") + "\n")
    table = str(tmp_path / "table")
    cli.main(["create", "--table", table], spark)
    cli.main(["stream", "--table", table, "--root", str(tmp_path / "topics"), "--topics", "t", "--once",
              "--run", "r0", "--checkpoint", str(tmp_path / "c")], spark)
    rejects = spark.read.option("recursiveFileLookup", True).parquet(f"{table}-rejects")
    assert [r["value"] for r in rejects.collect()] == ["short,line"]
    assert cli.KeyedTable(spark, table).current().count() == 2


def test_the_later_row_of_a_file_wins(spark, tmp_path):
    file, table = tmp_path / "payments.csv", str(tmp_path / "table")
    file.write_text("\n".join([",".join(CSV_COLUMNS), payment("Zeta", "100"), payment("Alpha", "50")]) + "\n")
    cli.main(["create", "--table", table], spark)
    cli.main(["load", "--table", table, "--file", str(file), "--run", "r0"], spark)
    row = cli.KeyedTable(spark, table).current().first()
    assert (row["payer"], row["amount"]) == ("Alpha", 50.0)


def test_kafka_offset_beats_the_clock(spark):
    records = spark.createDataFrame(
        [(payment("early", "1").encode(), "t", 0, 1, "2024-01-02"), (payment("late", "2").encode(), "t", 0, 2, "2024-01-01")],
        "value binary, topic string, partition int, offset long, at string",
    ).withColumn("timestamp", F.col("at").cast("timestamp"))
    last = topics.kafka_messages(records).orderBy(F.col("_seq").desc()).first()
    assert "late" in last["value"]


def test_produce_fills_every_topic(spark, tmp_path):
    file = tmp_path / "payments.csv"
    file.write_text("\n".join([",".join(CSV_COLUMNS), payment("p", "1")]) + "\n")
    cli.main(["produce", "--file", str(file), "--root", str(tmp_path / "r"), "--topics", "a,b"], spark)
    assert [spark.read.text(str(tmp_path / "r" / t)).count() for t in "ab"] == [1, 1]


def test_every_document_found_is_written(spark, tmp_path):
    file, table = tmp_path / "payments.csv", str(tmp_path / "table")
    rows = [payment("p", "20000", str(i)) for i in range(50)]
    file.write_text("\n".join([",".join(CSV_COLUMNS), *rows]) + "\n")
    cli.main(["create", "--table", table], spark)
    cli.main(["load", "--table", table, "--file", str(file), "--run", "r0"], spark)
    cli.main(["find", "--table", table, "--where", "large", "--to", str(tmp_path / "found")], spark)
    assert spark.read.text(str(tmp_path / "found")).count() == 50


def test_no_whole_dollars_in_nan(spark):
    frame = spark.createDataFrame([(float("nan"),), (float("inf"),), (12.75,), (None,)], "x double")
    assert [r[0] for r in frame.select(whole_dollars(F.col("x"))).collect()] == [None, None, 12, None]


def test_missing_column_is_an_error(spark, tmp_path):
    path = str(tmp_path / "partial")
    spark.createDataFrame([("1", 2.0)], "_id string, amount double").write.parquet(path)
    with pytest.raises(ValueError, match="payer"):
        files.read_payments(spark, path)
