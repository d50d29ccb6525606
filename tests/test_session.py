"""Session settings, derived tables and the command line."""

import pytest
from pyspark.sql import functions as F

from paystrata import __main__ as cli
from paystrata import session
from paystrata.schema import CSV_COLUMNS, PAYMENT_SCHEMA, SOURCE_POSITIONS
from paystrata.sources import files, testdata
from tests.test_fields import SAMPLE


def test_shared_folder_is_the_named_one(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


class NoFolder:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(_key, default):
            return default

    class sparkContext:
        master = "yarn"


def test_cluster_must_name_a_folder():
    with pytest.raises(ValueError):
        session.shared_folder(NoFolder)


def test_shuffle_partitions_follow_the_input():
    small, large = session.scale_conf(10, 8), session.scale_conf(100 * 10**12, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) == session.MOST_PARTITIONS


def test_settings_of_a_running_session(spark, tmp_path):
    spark.createDataFrame([(1,)], "x int").write.parquet(str(tmp_path / "t"))
    assert session.bytes_at(spark, str(tmp_path / "t")) > 0
    assert session.bytes_at(spark, str(tmp_path / "none")) == 0
    key, given = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    store = "spark.sql.streaming.stateStore.providerClass"
    before, kept = spark.conf.get(key), spark.conf.get(store)
    try:
        session.apply_scale(spark, 10**12)
        assert spark.conf.get(key) == str(128 * session.MIB)
        assert spark.conf.get(given) == "8"  # named when the session was made
    finally:
        spark.conf.set(key, before)
        spark.conf.set(store, kept)


def test_write_tasks_follow_the_input(spark):
    cores = spark.sparkContext.defaultParallelism
    found = [session.partitions_for(spark, n * session.MIB) for n in (0, 0.5, 100, 128_000)]
    assert found == [1, 2, cores, 1000]


def test_fixture_shape(spark, folder, payments):
    assert payments.schema == PAYMENT_SCHEMA
    assert payments.count() == spark.read.parquet(f"{folder}/lineitem.parquet").count()
    assert testdata.payments_path(spark, folder) == testdata.payments_path(spark, folder)


def test_bind_fails_on_a_missing_column(payments):
    with pytest.raises(ValueError, match="payer"):
        files.bind(payments.drop("payer"))


def test_documents_ignore_unknown_fields(spark):
    text = '{"_id": "a", "amount": 1.5, "more": {"x": [1]}}'
    row = files.parse_documents(spark.createDataFrame([(text,)], "value string")).collect()[0]
    assert (row._id, row.amount, row.payer) == ("a", 1.5, None) and len(row) == 15


def test_command_line(spark, tmp_path, capsys):
    file, root = tmp_path / "payments.csv", tmp_path / "topics"
    file.write_text(",".join(CSV_COLUMNS) + "\n" + SAMPLE + "\n")
    table, common = str(tmp_path / "table"), ["--root", str(root), "--topics", "t"]

    def run(*args):
        cli.main([*args, "--table", table], spark)
        return capsys.readouterr().out

    run("create")
    run("produce", "--file", str(file), *common)
    shown = run("consume", *common, "--once", "--checkpoint", str(tmp_path / "c0"))
    assert "|             1|" in shown and SAMPLE[:60] in shown
    run("peek", *common, "--once", "--checkpoint", str(tmp_path / "c2"))
    run("stream", *common, "--once", "--checkpoint", str(tmp_path / "c1"), "--run", "r0")
    assert "77310_02/09/2015" in run("load", "--file", str(file), "--run", "r1")
    shown = run("query", "--question", "physician", "--set", "physician=773")
    assert "77310_02/09/2015_5512" in shown and "physician = '773'" in shown
    assert "Royalty" in run("query", "--set", "physician=it's")
    with pytest.raises(ValueError, match="takes"):
        run("query", "--set", "doctor=1")
    assert "1 found in" in run("find", "--where", "february", "--fields", "_id,amount")
    assert "0 found in" in run("find", "--where", "large", "--limit", "5")
    assert "77310" in run("find", "--where", '{"$eq": {"payer": "Beryl & Sons, Ltd"}}')
    assert "aca_open_payments_all" in run("views")
    assert '"total": 1250.75}' in run("top")
    assert "04321-0007" in run("report")
    run("views", "--namespace", "kept")
    assert spark.table("kept.aca_open_payments_all").count() == 1
    live = ["--once", "--checkpoint", str(tmp_path / "c3"), "--run", "r0"]
    assert "1250.75" in run("live-report", *common, *live)
    again = ["--once", "--checkpoint", str(tmp_path / "c4"), "--run", "r0"]
    assert "1250.75" in run("message-report", *common, *again)
    assert "batches folded" in run("fold") and "batches deleted" in run("vacuum")
    assert "1 found in" in run("find", "--where", "february")
    run("index", "--to", str(tmp_path / "by_payer"))
    run("compact", "--to", str(tmp_path / "compacted"))
    assert spark.read.parquet(str(tmp_path / "by_payer")).agg(F.sum("amount")).first()[0] == 1250.75
    assert SOURCE_POSITIONS["amount"] == 30
