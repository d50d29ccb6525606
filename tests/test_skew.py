"""Tables in which one key holds a third of all rows, with broadcast joins off."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from paystrata.sources import testdata
from tests import oracle
from tests.test_keyed_table import file_rows

SOURCE = "/root/testdata/sf0.001"
NAMES = [
    "aca_open_payments", "attr_agg", "batch_etl", "compact_table", "distinct_payers",
    "exclude_members", "filtered_lookup", "find_written", "fold_table", "key_lookup",
    "live_report_current", "load_checked", "map_by_payer", "map_by_payer_coded",
    "payer_index_lookup", "physicians_by_revenue", "question_payers",
    "scan_payments", "stream_report", "stream_upsert", "top5_physician_revenue", "upsert_batch",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """One order line, one payer, one part and one physician each have a third."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    with duckdb.connect() as duck:
        for name in testdata.TABLES:
            duck.execute(
                f"CREATE TABLE {name} AS SELECT row_number() OVER () AS rn, * "
                f"FROM '{SOURCE}/{name}.parquet'"
            )
        duck.execute("UPDATE orders SET o_custkey = 98 WHERE rn % 3 = 0")
        order = duck.execute("SELECT min(o_orderkey) FROM orders WHERE o_custkey = 98").fetchone()[0]
        duck.execute(f"UPDATE lineitem SET l_orderkey = {order}, l_linenumber = 1 WHERE rn % 3 = 0")
        duck.execute("UPDATE lineitem SET l_suppkey = 4, l_extendedprice = 95000.5 WHERE rn % 3 = 1")
        duck.execute("UPDATE lineitem SET l_partkey = 7 WHERE rn % 6 = 3")
        for name in testdata.TABLES:
            duck.execute(
                f"COPY (SELECT * EXCLUDE rn FROM {name}) TO '{folder}/{name}.parquet' (FORMAT parquet)"
            )
    return folder


@pytest.fixture(scope="module", autouse=True)
def shuffled_joins_and_eight_files(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(testdata, "partitions_for", lambda _spark, _size: 8)
        yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables_match(spark, skewed, name):
    frame = entry_point.queries()[name](spark, skewed)
    _, expected = oracle.duck_rows(oracle.connect(skewed), entry_point.oracle_sql()[name])
    assert oracle.spark_rows(frame) == expected


@pytest.mark.parametrize("path_of", [testdata.payments_path, testdata.payer_copy_path])
def test_stored_copies_are_balanced(spark, skewed, path_of):
    sizes = file_rows(spark, path_of(spark, skewed))
    assert max(sizes) < sum(sizes) / 4


def test_changed_input_makes_a_new_copy(spark, skewed, tmp_path):
    folder = str(tmp_path)
    with duckdb.connect() as duck:
        for name in testdata.TABLES:
            duck.execute(f"COPY (FROM '{skewed}/{name}.parquet') TO '{folder}/{name}.parquet'")
        before = testdata.payments(spark, folder).count()
        duck.execute(
            f"COPY (FROM '{skewed}/lineitem.parquet' LIMIT 100) TO '{folder}/lineitem.parquet'"
        )
    assert before > 100 and testdata.payments(spark, folder).count() == 100
