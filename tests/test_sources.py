"""File readers."""

import json

import pytest
from pyspark.sql import functions as F

from paystrata.operators import etl
from paystrata.schema import CSV_COLUMNS, NARROW_SCHEMA
from paystrata.sources import files
from tests.test_fields import SAMPLE


@pytest.fixture
def two_files(tmp_path):
    """One plain header, one quoted header."""
    plain, quoted = ",".join(CSV_COLUMNS), ",".join(f'"{c}"' for c in CSV_COLUMNS)
    (tmp_path / "a.csv").write_text(f"{plain}\n{SAMPLE}\n")
    (tmp_path / "b.csv").write_text(f"{quoted}\n{SAMPLE}\n{SAMPLE}\n")
    return str(tmp_path)


def test_lines_without_headers(spark, two_files):
    assert [r.value for r in files.read_lines(spark, two_files).collect()] == [SAMPLE] * 3
    assert files.read_lines(spark, two_files, header=None).count() == 5


def test_batch_path_equals_line_path(spark, two_files):
    by_csv = etl.csv_to_payments(files.read_csv(spark, two_files))
    by_line = etl.parse_lines(files.read_lines(spark, two_files))
    assert by_csv.exceptAll(by_line).count() == 0 and by_csv.count() == 3


def test_names_from_the_header(spark, tmp_path):
    names = ["extra", *reversed(CSV_COLUMNS)]
    cells = dict.fromkeys(names, "")
    cells["Physician_Profile_ID"], cells["Total_Amount_of_Payment_USDollars"] = "7", "2.5"
    (tmp_path / "c.csv").write_text(",".join(names) + "\n" + ",".join(cells.values()) + "\n")
    row = etl.csv_to_payments(files.read_csv(spark, str(tmp_path), schema=None)).collect()[0]
    assert (row.physician_id, row.amount, row._id) == ("7", 2.5, "7__")
    with pytest.raises(Exception, match="header does not conform"):
        files.read_csv(spark, str(tmp_path)).select("Record_ID").collect()


def test_quoted_newline_needs_multi_line(spark, tmp_path):
    row = SAMPLE.replace('"Ilka"', '"Il\nka"')
    (tmp_path / "d.csv").write_text(",".join(CSV_COLUMNS) + "\n" + row + "\n")
    whole = etl.csv_to_payments(files.read_csv(spark, str(tmp_path), multi_line=True)).collect()
    assert [r.physician_name_first for r in whole] == ["Il\nka"]
    cut = files.read_lines(spark, str(tmp_path))
    assert cut.count() == 2
    assert etl.parse_lines(cut).filter("physician_id = '77310'").count() == 0


def test_narrow_read_of_a_wide_table(spark, tmp_path, payments):
    path = str(tmp_path / "wide")
    payments.withColumn("more", F.lit(1)).write.parquet(path)
    narrow = files.read_payments(spark, path, NARROW_SCHEMA)
    assert narrow.columns == NARROW_SCHEMA.names
    assert files.read_payments(spark, path).columns == payments.columns


def test_names_match_without_regard_to_case(payments):
    assert payments.groupBy("Nature_of_payment").count().count() == 25


def test_document_forms(spark, payments):
    one = payments.filter("physician_specialty IS NULL").limit(1)
    flat = etl.to_document(one).first().document
    pretty = etl.to_document(one, pretty=True).first().document
    assert "\n" not in flat and "\n" in pretty
    assert json.loads(flat) == json.loads(pretty) and "physician_specialty" not in json.loads(flat)


def test_result_line_has_the_clients_form(spark):
    result = spark.createDataFrame([("s", 1.5), (None, 1.25e9)], "g string, total double")
    texts = [r.json for r in etl.result_as_json(result, "g", "total").collect()]
    assert texts == ['{"g": "s", "total": 1.5}', '{"g": "null", "total": 1.25E9}']
