"""Measures, the map report and the views."""

import pytest
from pyspark.sql import functions as F

from paystrata.functions.measures import attribute, clamp, rounded_total, whole_dollars
from paystrata.operators import coded, report
from paystrata.plans import views
from paystrata.plans.registry import QUERIES
from paystrata.schema import PAYMENT_SCHEMA, REPORT_DIMENSIONS
from paystrata.session import new_folder
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sources import testdata
from paystrata.sources.files import path_sql


def test_attribute(spark):
    frame = spark.createDataFrame(
        [("one", "x"), ("one", "x"), ("two", "x"), ("two", "y"), ("none", None),
         ("mixed", "x"), ("mixed", None)],
        "g string, v string",
    )
    found = {r.g: r.a for r in frame.groupBy("g").agg(attribute(F.col("v")).alias("a")).collect()}
    assert found == {"one": "x", "two": "*", "none": None, "mixed": "x"}


def test_rounded_total_is_half_even(spark):
    frame = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "a double")
    assert frame.agg(rounded_total(F.col("a"))).first()[0] == 4.0


def test_whole_dollars_truncate_before_the_sum(spark):
    frame = spark.createDataFrame([(10.9,), (10.9,), (12344.999999999998,)], "a double")
    assert [r[0] for r in frame.select(whole_dollars(F.col("a"))).collect()] == [10, 10, 12345]


def test_clamp(spark):
    frame = spark.createDataFrame([(-5,), (0,), (7,), (40000,), (99999,)], "a bigint")
    assert [r[0] for r in frame.select(clamp(F.col("a"))).collect()] == [1, 1, 7, 40000, 40000]


def test_totals_agree(payments):
    totals = report.open_payments(payments)
    whole = payments.agg(F.round(F.sum("amount"), 2)).first()[0]
    assert totals.agg(F.round(F.sum("us_dollars"), 2)).first()[0] == pytest.approx(whole, abs=0.01)
    a = report.map_by_payer(totals).agg(F.sum("us_dollars")).first()[0]
    b = report.map_by_nature(totals).agg(F.sum("us_dollars")).first()[0]
    assert a == b


def test_exclusion_treats_null_as_a_value(spark):
    keys = "payer string, physician_specialty string, recipient_zip string"
    rows = spark.createDataFrame([("p", None, "1"), ("p", "s", "1"), ("q", None, "1")], keys)
    members = spark.createDataFrame([("p", None, "1"), ("p", None, "1")], keys)
    left = {tuple(r) for r in report.exclude_members(rows, members).collect()}
    assert left == {("p", "s", "1"), ("q", None, "1")}


def test_stored_views(spark, folder, payments):
    path = testdata.payments_path(spark, folder)
    names = views.create_stored_views(spark, path, "test_views")
    assert len(names) == 4
    assert spark.table("test_views.aca_open_payments_all").count() == payments.count()
    assert spark.table("test_views.aca_open_payments").columns == [*REPORT_DIMENSIONS, "us_dollars"]


def test_stored_views_of_a_keyed_table(spark):
    table = KeyedTable(spark, new_folder(spark, "viewed")).create()
    row = ("a", *[None] * 3, 1.0, *[None] * 10)

    def write(amount, run_id, batch_id, into):
        data = [(*row[:4], amount, *row[5:])]
        into.upsert(spark.createDataFrame(data, PAYMENT_SCHEMA), run_id, batch_id)

    def seen():
        return [r.amount for r in spark.table("test_views.aca_open_payments_all").collect()]

    write(1.0, "7", 9, table)
    write(2.0, "7", 10, table)
    views.create_stored_views(spark, table.path, "test_views")
    assert seen() == [2.0]
    write(3.0, "7", 11, table)
    assert seen() == [3.0]
    compacted = table.compact(new_folder(spark, "viewed-compact"))
    views.create_stored_views(spark, compacted.path, "test_views")
    assert seen() == [3.0]
    write(4.0, "8", 0, compacted)
    assert seen() == [4.0]
    assert spark.table("test_views.physicians_by_revenue").first().revenue == 4.0
    with pytest.raises(ValueError, match="keyed table"):
        path_sql(spark, table.path)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, pushed", [
    ("filter_amount_gt_1000", "GreaterThan(amount,1000.0)"),
    ("find_amount_ge_10000", "GreaterThanOrEqual(amount,10000.0)"),
    ("id_prefix_lookup", "StringStartsWith(_id,98)"),
    ("payer_index_lookup", "EqualTo(payer,Supplier#000000042)"),
    ("payments_payer_contains", "StringContains(payer,00004)"),
    ("feb_exact", "StringContains(_id,_02/)"),
    ("physician_exact", "EqualTo(physician_id,214)"),
])
def test_filters_reach_the_scan(spark, folder, name, pushed):
    assert pushed in plan(QUERIES[name](spark, folder))


def test_scan_reads_only_what_is_used(spark, folder):
    text = plan(QUERIES["top5_nature_by_total"](spark, folder))
    assert "ReadSchema: struct<amount:double,nature_of_payment:string>" in text
    assert "TakeOrderedAndProject" in text and "partial_sum" in text


@pytest.mark.parametrize("few", [100_000, 3])
def test_coded_attributes_are_the_same(spark, payments, monkeypatch, few):
    """With dictionaries that are broadcast, and with some that are too large for it."""
    monkeypatch.setattr(coded, "FEW_VALUES", few)
    dictionaries = [
        coded.Dictionary.write(payments, column, new_folder(spark, "codes"))
        for column in ("nature_of_payment", "physician_specialty")
    ]
    totals = report.open_payments(payments)
    found, expected = coded.map_by_payer(totals, dictionaries), report.map_by_payer(totals)
    assert found.columns == expected.columns and found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0
    text = plan(found)
    assert "SortAggregate" not in text and "partial_min" in text
    assert "SortAggregate" in plan(expected)


def test_coded_attributes_of_few_rows(spark):
    rows = spark.createDataFrame(
        [("p", "1", "a", "x", 1.0), ("p", "1", "b", None, 2.0), ("q", "1", None, None, 3.0)],
        "payer string, recipient_zip string, nature_of_payment string, physician_specialty string, us_dollars double",
    )
    dictionaries = [
        coded.Dictionary.write(rows, c, new_folder(spark, "codes"))
        for c in ("nature_of_payment", "physician_specialty")
    ]
    assert sorted(map(tuple, coded.map_by_payer(rows, dictionaries).collect())) == [
        ("p", "1", 3, "*", "x"), ("q", "1", 3, None, None),
    ]
