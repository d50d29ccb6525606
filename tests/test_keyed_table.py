"""Upserts, replays, compaction and sorted copies."""

from random import Random

import pytest
from pyspark.sql import functions as F

from paystrata.schema import PAYMENT_SCHEMA, REPORT_DIMENSIONS
from paystrata.session import new_folder
from paystrata.sinks import keyed_table
from paystrata.sinks.keyed_table import Batch, KeyedTable, Layout
from paystrata.sinks.layouts import write_by_id, write_by_payer
from paystrata.sources.topics import SEQUENCE, SEQUENCE_TYPE
from paystrata.streaming import jobs


def rows(spark, *pairs):
    data = [(key, *[None] * 3, amount, *[None] * 10) for key, amount in pairs]
    return spark.createDataFrame(data, PAYMENT_SCHEMA)


def content(table):
    return sorted((r._id, r.amount) for r in table.current().collect())


@pytest.fixture
def table(spark):
    return KeyedTable(spark, new_folder(spark, "keyed")).create()


def test_later_batch_wins_and_repeats_change_nothing(spark, table):
    table.upsert(rows(spark, ("a", 1.0), ("b", 2.0)), "r0", 0)
    table.upsert(rows(spark, ("b", 5.0), ("c", 3.0)), "r0", 1)
    expected = [("a", 1.0), ("b", 5.0), ("c", 3.0)]
    assert content(table) == expected
    table.upsert(rows(spark, ("b", 5.0), ("c", 3.0)), "r0", 1)
    assert content(table) == expected
    table.upsert(rows(spark, ("a", 1.0), ("b", 2.0)), "r1", 0)
    table.upsert(rows(spark, ("b", 5.0), ("c", 3.0)), "r1", 1)
    assert content(table) == expected


def test_random_batches_equal_a_dictionary(spark, table):
    random, model = Random(7), {}
    for run in range(2):
        for batch in range(3):
            pairs = {f"k{random.randrange(12)}": float(random.randrange(100)) for _ in range(8)}
            table.upsert(rows(spark, *pairs.items()), f"r{run}", batch)
            model.update(pairs)
        if run == 0:
            table = table.compact(new_folder(spark, "compacted"), partitions=2)
    assert content(table) == sorted(model.items())


def test_ten_follows_nine(spark, table):
    table.upsert(rows(spark, ("a", 10.0)), "r0", 10)
    table.upsert(rows(spark, ("a", 9.0)), "r0", 9)
    assert content(table) == [("a", 10.0)]


def test_sequence_orders_a_batch(spark, table):
    place = F.when(F.col("amount") == 1.0, 7).otherwise(3)
    sequence = F.struct(
        F.lit(None).cast("timestamp").alias("at"), F.lit("s").alias("source"),
        F.lit(0).cast("bigint").alias("block"), place.cast("bigint").alias("position"),
    ).cast(SEQUENCE_TYPE)
    batch = rows(spark, ("a", 9.0), ("a", 1.0)).withColumn(SEQUENCE, sequence)
    table.upsert(batch, "r0")
    assert content(table) == [("a", 1.0)]


def test_null_key_is_one_key(spark, table):
    table.upsert(rows(spark, (None, 1.0)), "r0", 0)
    table = table.compact(new_folder(spark, "compacted"))
    table.upsert(rows(spark, (None, 2.0)), "r1", 0)
    assert content(table) == [(None, 2.0)]


def test_compaction_keeps_the_rows_and_takes_more(spark, table):
    table.upsert(rows(spark, ("a", 1.0), ("b", 2.0)), "r0", 0)
    table.upsert(rows(spark, ("b", 5.0)), "r0", 1)
    compacted = table.compact(new_folder(spark, "compacted"), partitions=2)
    assert content(compacted) == [("a", 1.0), ("b", 5.0)]
    compacted.upsert(rows(spark, ("a", 8.0), ("d", 4.0)), "r0", 2)
    assert content(compacted) == [("a", 8.0), ("b", 5.0), ("d", 4.0)]
    assert content(table) == [("a", 1.0), ("b", 5.0)]


def test_writing_needs_an_existing_table(spark):
    missing = KeyedTable(spark, new_folder(spark, "missing"))
    with pytest.raises(FileNotFoundError):
        missing.upsert(rows(spark, ("a", 1.0)), "r0")
    with pytest.raises(FileNotFoundError):
        missing.current()
    with pytest.raises(Exception, match="already exists"):
        KeyedTable(spark, new_folder(spark, "twice")).create().create()
    with pytest.raises(FileNotFoundError):
        jobs.upsert_parsed(None, missing, "r0", "unused")


def test_run_id_must_be_a_folder_name(spark, table):
    with pytest.raises(ValueError):
        table.upsert(rows(spark, ("a", 1.0)), "a/b")


def test_upsert_does_not_shuffle_and_reading_combines_first(spark, table, payments):
    table.upsert(payments, "r0")
    plan = table.newest(table.log(table.batches()))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")


def test_compacted_base_is_scanned_with_filter_and_few_columns(spark, table, payments):
    table.upsert(payments, "r0")
    compacted = table.compact(new_folder(spark, "compacted"))
    frame = compacted.current().filter("amount > 1000").select("_id", "amount")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(amount,1000.0)" in plan
    assert "ReadSchema: struct<_id:string,amount:double>" in plan
    assert compacted.current().count() == payments.select("_id").distinct().count()


def test_report_keys_may_be_null(spark):
    table = jobs.report_table(spark, new_folder(spark, "report")).create()
    group = ("US", "CA", None, "92123", "p", "n")
    for batch, total in enumerate((1.0, 3.0)):
        frame = spark.createDataFrame([(*group, total)], jobs.REPORT_SCHEMA)
        table.upsert(frame, "r0", batch)
    found = table.current().collect()
    assert [tuple(r) for r in found] == [(*group, 3.0)] and len(REPORT_DIMENSIONS) == 6


def file_rows(spark, path):
    return [
        r["count"] for r in
        spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    ]


def test_hot_payer_is_spread_over_files(spark):
    path = new_folder(spark, "hot")
    hot = spark.range(30_000).select(
        F.concat(F.lit("k"), "id").alias("_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("p"), "id")).otherwise(F.lit("hot")).alias("payer"),
    )
    write_by_payer(hot, path, partitions=6)
    sizes = file_rows(spark, path)
    assert sum(sizes) == 30_000 and max(sizes) < 10_000


def test_hot_id_is_spread_over_files(spark):
    path = new_folder(spark, "hot")
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), "id")).otherwise(F.lit("hot")).alias("_id"),
        F.col("id").alias("n"),
    )
    write_by_id(hot, path, partitions=6)
    sizes = file_rows(spark, path)
    assert sum(sizes) == 30_000 and max(sizes) < 10_000


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def executed(frame):
    """The plan as it ran, adaptive stages included."""
    frame.write.format("noop").mode("overwrite").save()
    query = frame._jdf.queryExecution()
    frame.collect()
    return query.executedPlan().toString()


def many(spark, start, end, amount):
    return rows(spark, *[(f"k{n:05d}", amount) for n in range(start, end)])


@pytest.mark.parametrize("buckets", [3, 8, 20])
def test_base_is_not_shuffled_and_the_log_is_read_once(spark, table, no_broadcast, buckets):
    table.upsert(many(spark, 0, 3000, 1.0), "r0", 0)
    table = table.compact(new_folder(spark, "compacted"), partitions=buckets)
    table.upsert(many(spark, 100, 400, 2.0), "r0", 1)
    frame = table.current().where("amount > 0")
    text = executed(frame).split("== Initial Plan ==")[0]
    join = text[text.index("LeftAnti"):]
    base = join[:join.index("FileScan parquet spark_catalog.paystrata_bases")]
    assert "Bucketed: true" in join
    # the first side of the join comes down to the scan without a shuffle
    assert "Exchange" not in base and "ShuffleQueryStage" not in base
    assert text.count("Location: InMemoryFileIndex") == 1 and "ReusedExchange" in text
    assert sorted((r.amount for r in frame.collect())) == [1.0] * 2700 + [2.0] * 300


def test_fold_rewrites_only_touched_slices(spark, table):
    table.upsert(many(spark, 0, 4000, 1.0), "r0", 0)
    table = table.compact(new_folder(spark, "compacted"), partitions=2, slices=4)
    layout = table._layout()
    assert len(layout.lows) == 3

    def files():
        return {
            name: table._names_in(f"{table.path}/base/{name}")
            for name in table._names_in(f"{table.path}/base") if name.startswith("slice=")
        }

    before = files()
    assert len(before) == 4 and max(map(len, before.values())) <= 2
    table.upsert(many(spark, 3990, 4010, 5.0), "r1", 0)
    table.upsert(many(spark, 3995, 4000, 6.0), "r1", 1)
    expected = content(table)
    assert table.fold() == [Batch("r1", 0), Batch("r1", 1)]
    after = files()
    assert [name for name in after if after[name] != before[name]] == ["slice=3"]
    assert content(table) == expected and table.batches() == [] and table.fold() == []
    assert table.vacuum() == [Batch("r1", 0), Batch("r1", 1)]
    assert content(table) == expected
    table.upsert(rows(spark, ("k00000", 9.0), ("new", 3.0)), "r1", 2)
    assert dict(content(table))["k00000"] == 9.0 and len(content(table)) == len(expected) + 1


def test_random_batches_and_folds_equal_a_dictionary(spark, table):
    random, model = Random(11), {}
    for batch in range(8):
        pairs = {random.choice([None, *map(str, range(9))]): float(random.randrange(100)) for _ in range(5)}
        table.upsert(rows(spark, *pairs.items()), "r0", batch)
        model.update(pairs)
        if batch % 3 == 1:
            table.fold(buckets=2, slices=3)
        if batch == 5:
            table.vacuum()
        key = lambda x: (x[0] is not None, x[0] or "")
        found = sorted(((r._id, r.amount) for r in table.current().collect()), key=key)
        assert found == sorted(model.items(), key=key)
    for name, amount in [*model.items(), ("none", None)]:
        assert [r.amount for r in table.find_key(name).collect()] == ([amount] if name in model else [])


def test_a_batch_written_again_after_a_fold_counts(spark, table):
    table.upsert(rows(spark, ("a", 1.0), ("b", 1.0)), "r0", 0)
    table.fold()
    table.upsert(rows(spark, ("b", 2.0), ("c", 2.0)), "r0", 0)
    assert content(table) == [("a", 1.0), ("b", 2.0), ("c", 2.0)]
    assert table.vacuum() == [] and table.batches() == [Batch("r0", 0)]


def test_a_fold_that_broke_off_is_finished(spark, table, monkeypatch):
    table.upsert(many(spark, 0, 200, 1.0), "r0", 0)
    table.fold(buckets=2, slices=2)
    table.upsert(many(spark, 100, 300, 2.0), "r0", 1)
    expected = content(table)
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_move", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.fold()
    assert content(table) == expected and table.batches() == [Batch("r0", 1)]
    assert table.fold() == [] and table.batches() == []
    assert content(table) == expected


def test_the_first_fold_moves_whole_rows_once_and_stages_nothing(spark, table):
    table.upsert(many(spark, 0, 300, 1.0), "r0", 0)
    table.upsert(many(spark, 100, 400, 2.0), "r0", 1)
    expected, log = content(table), table.log(table.batches())
    rows = table._newest_in_place(log, [], Layout(4, [("k00150",)]), 8)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert table.fold(buckets=3, slices=3) == [Batch("r0", 0), Batch("r0", 1)]
    assert table._names_in(f"{table.path}/stage") == [] and table.batches() == []
    assert content(table) == expected and len(expected) == 400


def test_rows_of_hot_keys_are_combined_before_they_move(spark, table, monkeypatch):
    monkeypatch.setattr(keyed_table, "ROWS_TOGETHER", 50)
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), "id")).otherwise(F.lit("hot")).alias("_id"),
        F.col("id").cast("double").alias("amount"),
    )
    names = [F.col(f.name) if f.name in hot.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in PAYMENT_SCHEMA]
    table.upsert(hot.select(*names), "r0", 0)
    expected, log = content(table), table.log(table.batches())
    n, bins = table._hot_bins(log)
    assert n == 3000 and bins == [log.where("_id = 'hot'").select(table._bin()).first()[0]]
    plan = table._newest_in_place(log, bins, Layout(2, []), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.index("partial_max") < plan.rindex("hashpartitioning")
    table.fold(buckets=2, slices=3)
    assert content(table) == expected and len(expected) == 1001 and table.find_key("hot").first().amount == 2999.0


@pytest.mark.parametrize("step", ["_take", "_done"])
def test_a_first_fold_that_broke_off_is_finished(spark, table, monkeypatch, step):
    table.upsert(many(spark, 0, 200, 1.0), "r0", 0)
    table.upsert(many(spark, 100, 300, 2.0), "r0", 1)
    expected = content(table)
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.fold(buckets=2, slices=2)
    assert content(table) == expected and len(table.batches()) == 2
    table.upsert(many(spark, 0, 10, 7.0), "r1", 0)
    expected = content(table)
    table.fold()
    assert content(table) == expected and table.batches() == []


def test_another_session_reads_the_base(spark, table):
    table.upsert(many(spark, 0, 300, 1.0), "r0", 0)
    table.fold(buckets=3, slices=3)
    for stored in spark.catalog.listTables("paystrata_bases"):
        if not stored.isTemporary:
            spark.sql(f"DROP TABLE paystrata_bases.{stored.name}")
    again = KeyedTable(spark, table.path)
    assert len(content(again)) == 300


def test_state_before_a_batch(spark, table):
    table.upsert(rows(spark, ("a", 1.0)), "r0", 0)
    table.upsert(rows(spark, ("a", 2.0), ("b", 2.0)), "r0", 1)
    table.upsert(rows(spark, ("a", 3.0)), "r1", 0)

    def before(*batch):
        return sorted((r._id, r.amount) for r in table.current(Batch(*batch)).collect())

    assert before("r0", 0) == [] and before("r0", 1) == [("a", 1.0)]
    assert before("r1", 0) == [("a", 2.0), ("b", 2.0)] and len(before("r2", 0)) == 2


def scanned(frame):
    """(files, rows) that the scans of a frame read."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return tuple(
        sum(m.apply(name).value() for m in metrics if m.contains(name))
        for name in ("numFiles", "numOutputRows")
    )


def test_a_key_is_found_in_its_bucket_and_slice(spark, table):
    table.upsert(many(spark, 0, 4000, 1.0), "r0", 0)
    table = table.compact(new_folder(spark, "compacted"), partitions=5, slices=4)
    frame = table.find_key("k00077")
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slice" in text
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        text = table.find_key("k00077")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 5" in text
    stored = table.base().where("_id = 'k00077'")
    assert scanned(stored)[0] > 1 and frame.first().amount == 1.0


def test_slices_follow_the_key(spark, table):
    table.upsert(many(spark, 0, 1000, 1.0), "r0", 0)
    table = table.compact(new_folder(spark, "compacted"), partitions=2, slices=7)
    ranges = table.base().groupBy("slice").agg(F.min("_id").alias("a"), F.max("_id").alias("z")).orderBy("slice").collect()
    assert [r.slice for r in ranges] == list(range(len(ranges))) and len(ranges) > 4
    assert all(x.z < y.a for x, y in zip(ranges, ranges[1:]))


def test_keys_of_several_columns_with_nulls(spark):
    table = jobs.report_table(spark, new_folder(spark, "report")).create()
    model = {}
    random = Random(5)
    for batch in range(4):
        data = {}
        for _ in range(12):
            data[tuple(random.choice([None, "x", "y"]) for _ in REPORT_DIMENSIONS)] = float(batch)
        model.update(data)
        table.upsert(spark.createDataFrame([(*k, v) for k, v in data.items()], jobs.REPORT_SCHEMA), "r0", batch)
        if batch % 2 == 0:
            table.fold(buckets=3, slices=3)
    assert {tuple(r)[:-1]: r[-1] for r in table.current().collect()} == model
    assert table.current().count() == len(model)
