"""Every query by name: a function of the session and the tables' folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions import fields
from paystrata.functions.measures import attribute
from paystrata.operators import coded, etl, queries as q, report
from paystrata.operators.find import AMOUNT_AT_LEAST_10000, find, find_count, write_found
from paystrata.plans import views
from paystrata.plans.questions import ask
from paystrata.schema import NARROW_SCHEMA, REPORT_DIMENSIONS, SOURCE_NAMES, SOURCE_POSITIONS
from paystrata.session import new_folder
from paystrata.sinks import loading
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sinks.layouts import write_with_filters
from paystrata.sinks.ledger import Ledger
from paystrata.sinks.messages import publish_to_folder
from paystrata.sources import files, testdata, topics
from paystrata.streaming import jobs
from paystrata.streaming.lifecycle import RunLog

Query = Callable[[SparkSession, str], DataFrame]

ID_PREFIX = "98"
PHYSICIAN = "214"
PAYER = "Supplier#000000042"
PAYER_PATTERN = "%00004%"
LARGE_AMOUNT = 90000
# The registered queries keep their views apart from those of the session's user.
VIEWS_NAMESPACE = "paystrata_queries"


def _cents(frame: DataFrame, *names: str) -> DataFrame:
    """Floating sums to the cent: their last digits depend on the order of addition."""
    return frame.withColumns({name: F.round(name, 2) for name in names})


def _on_payments(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: query(testdata.payments(spark, folder))


def _on_lines(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: query(
        files.read_lines(spark, testdata.csv_path(spark, folder))
    )


def _on_view(text: str) -> Query:
    """SQL text over the session view ``payments``."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        views.session_view(testdata.payments(spark, folder))
        return spark.sql(text)

    return run


def _stored_view(name: str, *money: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        views.create_session_views(spark, testdata.payments(spark, folder))
        return _cents(spark.table(name), *money)

    return run


# Sources

def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    rows = files.read_csv(spark, testdata.csv_path(spark, folder))
    return rows.select(*SOURCE_NAMES.values(), "Change_Type", "Physician_License_State_code5")


def scan_payments_narrow(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_payments(spark, testdata.payments_path(spark, folder), NARROW_SCHEMA)


def scan_json_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    return files.bind(files.read_documents(spark, testdata.documents_path(spark, folder)))


def sql_on_path(spark: SparkSession, folder: str) -> DataFrame:
    table = files.path_sql(spark, testdata.payments_path(spark, folder))
    return spark.sql(
        "SELECT physician_specialty, round(sum(amount), 2) AS total "
        f"FROM {table} GROUP BY physician_specialty"
    )


# Record transforms

def amount_lenient(payments: DataFrame) -> DataFrame:
    text = (
        F.when(F.col("nature_of_payment") == "Brand#11", F.concat(F.lit('"'), "amount", F.lit('"')))
        .when(F.col("payer").endswith("7"), F.lit("n/a"))
        .when(F.col("payer").endswith("8"), F.lit(""))
        .otherwise(F.col("amount").cast("string"))
    )
    return payments.select("_id", "payer", fields.lenient_amount(text).alias("amount"))


def amount_strict(spark: SparkSession, folder: str) -> DataFrame:
    rows = etl.with_amount(files.read_csv(spark, testdata.csv_path(spark, folder)))
    return rows.select("Record_ID", "amount")


def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    rows = files.read_csv(spark, testdata.csv_path(spark, folder))
    return etl.project_payment(etl.with_amount(rows))


def _held(rows: DataFrame, table: DataFrame, group: list[str]) -> DataFrame:
    """Per group the number of rows, and how many of them the table holds."""
    names = table.columns
    copies = rows.groupBy(*group, *names).agg(F.count("*").alias("n")).alias("copies")
    same = [F.col(f"copies.{c}").eqNullSafe(F.col(f"held.{c}")) for c in names]
    hits = table.alias("held").join(copies, same).select("copies.*").distinct()
    counted = rows.groupBy(*group).agg(F.count("*").alias("n_rows"))
    found = hits.groupBy(*group).agg(F.sum("n").alias("n_found"))
    return counted.join(found, group, "left").fillna(0, ["n_found"])


def first_row(payments: DataFrame) -> DataFrame:
    """Some one row: which it is, is not defined, but the table must hold it."""
    first = payments.limit(1).withColumn("request", F.lit(1).cast("bigint"))
    return _held(first, payments, ["request"])


def build_id(spark: SparkSession, folder: str) -> DataFrame:
    return etl.add_key(project_rename(spark, folder)).select("_id", "physician_id", "date_payment")


def reject_lines(lines: DataFrame) -> DataFrame:
    """Lines without a specialty are cut after 20 fields, which is too short."""
    rows = etl.split_lines(lines)
    cut = F.array_join(F.slice("_fields", 1, 20), ",")
    whole = etl.raw_field("physician_specialty") != ""
    damaged = rows.select(F.when(whole, F.col("value")).otherwise(cut).alias("value"))
    return etl.rejected_lines(damaged).groupBy("n_fields").agg(F.count("*").alias("n_lines"))


def batch_etl(spark: SparkSession, folder: str) -> DataFrame:
    """The last row of a key in the files stays."""
    table = KeyedTable(spark, new_folder(spark, "batch-etl")).create()
    source = files.in_file_order(files.read_csv(spark, testdata.csv_path(spark, folder)))
    table.upsert(etl.csv_to_payments(source, carry=[topics.SEQUENCE]), run_id="load")
    return table.current()


# Sinks

def publish_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "published")
    publish_to_folder(files.read_lines(spark, testdata.csv_path(spark, folder), in_order=True), path)
    return etl.parse_lines(files.read_lines(spark, path, header=None)).select("_id", "payer", "amount")


def _upserted(spark: SparkSession, folder: str) -> KeyedTable:
    """Payers ending in 0-4 are loaded first, then the others: the second batch wins."""
    rows = testdata.payments(spark, folder)
    low = F.right("payer", F.lit(1)) < "5"
    table = KeyedTable(spark, new_folder(spark, "upsert")).create()
    table.upsert(rows.filter(low), run_id="load", batch_id=0)
    table.upsert(rows.filter(~low), run_id="load", batch_id=1)
    return table


def upsert_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _upserted(spark, folder).current()


def _keyed_view(name: str, *money: str) -> Query:
    """A stored view over a keyed table that holds superseded rows."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        views.create_stored_views(spark, _upserted(spark, folder).path, VIEWS_NAMESPACE)
        return _cents(spark.table(f"{VIEWS_NAMESPACE}.{name}"), *money)

    return run


def compact_table(spark: SparkSession, folder: str) -> DataFrame:
    return _upserted(spark, folder).compact(new_folder(spark, "compacted")).current()


def _question(name: str, **values) -> Query:
    """A named question over a session view."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        views.session_view(testdata.payments(spark, folder), "asked_payments")
        return ask(spark, name, "asked_payments", **values)

    return run


def result_as_json(payments: DataFrame) -> DataFrame:
    top = q.total_by(payments, q.SPECIALTY, limit=10)
    exact = top.withColumn("total", F.round("total", 2).cast("decimal(38,2)"))
    return etl.result_as_json(exact, q.SPECIALTY, "total")


def cache_count(spark: SparkSession, folder: str) -> DataFrame:
    payments = testdata.payments(spark, folder)
    rows = q.count_cached(payments)
    payments.unpersist()
    return spark.createDataFrame([(rows,)], "n_rows bigint")


def find_written(spark: SparkSession, folder: str) -> DataFrame:
    """What a find counts while it writes, and what is there afterwards."""
    path = new_folder(spark, "found")
    where = {"$ge": {"amount": LARGE_AMOUNT}}
    found = write_found(_upserted(spark, folder).current(), path, where, "_id,amount")
    written = files.read_documents(spark, path).agg(F.count("amount").alias("n_written"))
    return written.withColumn("n_found", F.lit(found).cast("bigint"))


def load_checked(spark: SparkSession, folder: str) -> DataFrame:
    """A load that looks for bad rows first: those it names, and the rows it writes without them."""
    csv, rejects = testdata.csv_path(spark, folder), new_folder(spark, "bad-rows")
    table = KeyedTable(spark, new_folder(spark, "checked")).create()
    loading.load(spark, csv, table, "good", rejects)
    damaged, amount = new_folder(spark, "damaged"), F.col(SOURCE_NAMES["amount"])
    large = amount.cast("double") >= LARGE_AMOUNT
    rows = files.read_csv(spark, csv)
    rows = rows.withColumn(SOURCE_NAMES["amount"], F.when(large, F.lit("n/a")).otherwise(amount))
    rows.write.options(header=True, escape='"', **testdata.TEXT_OPTIONS).csv(damaged)
    named = 0
    try:
        loading.load(spark, damaged, table, "bad", rejects)
    except loading.BadRows as error:
        named = error.n
    rows_now = table.log(table.batches()).agg(F.count("*").alias("n_loaded"))
    return rows_now.withColumn("n_bad", F.lit(named).cast("bigint"))


def filtered_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """A payer in an unsorted copy that has Bloom filters."""
    path = new_folder(spark, "with-filters")
    write_with_filters(testdata.payments(spark, folder), path)
    return find(files.read_payments(spark, path), {"$eq": {"payer": PAYER}}, "_id,payer,amount")


def payer_index_lookup(spark: SparkSession, folder: str) -> DataFrame:
    copy = files.read_payments(spark, testdata.payer_copy_path(spark, folder))
    return find(copy, {"$eq": {"payer": PAYER}}, "_id,payer,amount,nature_of_payment")


# Report

def exclude_members(payments: DataFrame) -> DataFrame:
    """Payments outside every combination that has a very large payment."""
    members = q.amount_above(payments, LARGE_AMOUNT)
    return report.exclude_members(payments, members).select("_id", *report.EXCLUSION_KEYS, "amount")


def map_by_payer_coded(spark: SparkSession, folder: str) -> DataFrame:
    payments = testdata.payments(spark, folder)
    dictionaries = [
        coded.Dictionary.write(payments, column, new_folder(spark, f"codes-{column}"))
        for column in (q.NATURE, q.SPECIALTY)
    ]
    return coded.map_by_payer(report.open_payments(payments), dictionaries)


def attr_agg(payments: DataFrame) -> DataFrame:
    return payments.groupBy("physician_id").agg(
        *[attribute(F.col(c)).alias(c) for c in ("recipient_state", "payer", "physician_name_middle")]
    )


# Streams

def _messages(spark: SparkSession, folder: str, names: str, **options) -> DataFrame:
    return topics.folder_stream(spark, testdata.topics_root(spark, folder), names, **options)


BOTH_TOPICS = ",".join(testdata.TOPICS)
# Small enough that the topics come in several micro-batches.
FILES_PER_BATCH = 4
# Each micro-batch costs a commit, and some a look at the whole log: their number must not
# grow with the files.
MOST_BATCHES = 4


def _files_per_batch(spark: SparkSession, folder: str) -> int:
    """``FILES_PER_BATCH``, or more where a topic would come in over ``MOST_BATCHES``."""
    root = testdata.topics_root(spark, folder)
    counts = [files.count_files(spark, f"{root}/{topic}") for topic in testdata.TOPICS]
    return max(FILES_PER_BATCH, -(-max(counts) // MOST_BATCHES))


def stream_multi_source(spark: SparkSession, folder: str) -> DataFrame:
    """Both topics, the first of them named twice."""
    path = new_folder(spark, "stream-multi")
    messages = _messages(spark, folder, f"{BOTH_TOPICS},{testdata.TOPICS[0]}")
    parsed = etl.parse_lines(messages, carry=["topic"]).select("topic", "_id", "amount")
    writer = parsed.writeStream.option("checkpointLocation", new_folder(spark, "checkpoint"))
    writer.trigger(availableNow=True).format("parquet").start(path).awaitTermination()
    return spark.read.schema(parsed.schema).parquet(path)


def stream_parse(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stream-parse")
    jobs.store_parsed(
        _messages(spark, folder, BOTH_TOPICS), path, new_folder(spark, "checkpoint"), True
    ).awaitTermination()
    return files.read_payments(spark, path)


def stream_message_count(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stream-count")
    jobs.count_messages(
        _messages(spark, folder, BOTH_TOPICS), path, new_folder(spark, "checkpoint"), True
    ).awaitTermination()
    return jobs.message_counts(spark, path)


def fold_table(spark: SparkSession, folder: str) -> DataFrame:
    """The first batch as the base, the second taken into the slices that it touches."""
    rows = testdata.payments(spark, folder)
    low = F.right("payer", F.lit(1)) < "5"
    table = KeyedTable(spark, new_folder(spark, "folded")).create()
    table.upsert(rows.filter(low), run_id="load", batch_id=0)
    table.fold()
    table.upsert(rows.filter(~low), run_id="load", batch_id=1)
    table.fold()
    return table.current()


def key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The current row of the least key, by its bucket and slice, beside the log."""
    table = _upserted(spark, folder)
    table.fold()
    table.upsert(table.current().where("amount > 100000"), run_id="load", batch_id=2)
    least = table.current().agg(F.min("_id").alias("_id")).first()["_id"]
    return table.find_key(least)


def stream_peek(spark: SparkSession, folder: str) -> DataFrame:
    """Rows kept of each micro-batch, and how many of them the table holds."""
    path = new_folder(spark, "stream-peek")
    jobs.peek(
        _messages(spark, folder, BOTH_TOPICS), path, new_folder(spark, "checkpoint"),
        available_now=True,
    ).awaitTermination()
    payments = testdata.payments(spark, folder)
    batches = f"batch_id bigint, {payments.schema.toDDL()}"
    return _held(spark.read.schema(batches).parquet(path), payments, ["batch_id"])


def stream_timed(spark: SparkSession, folder: str) -> DataFrame:
    """A run with the two-second trigger, stopped when it has read what is there."""
    path = new_folder(spark, "stream-timed")
    query = jobs.store_parsed(
        _messages(spark, folder, BOTH_TOPICS), path, new_folder(spark, "checkpoint")
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return files.read_payments(spark, path)


def _stream_into(spark: SparkSession, folder: str, table: KeyedTable, pass_no: int) -> None:
    """One run per topic, so that the second topic wins where both have a key.

    Within a topic the last message of a key in the order of the files wins. The runs go on
    side by side, each with its own batches: their ids, not their times, say which wins.
    """
    at_once = _files_per_batch(spark, folder)
    runs = []
    try:
        for n, topic in enumerate(testdata.TOPICS):
            messages = _messages(spark, folder, topic, max_files_per_trigger=at_once)
            runs.append(jobs.upsert_parsed(
                messages, table, f"pass{pass_no}-{n}", new_folder(spark, "checkpoint"), available_now=True
            ))
        for run in runs:
            run.awaitTermination()
    finally:
        for run in runs:  # where one has failed, the others too
            run.stop()


def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    table = KeyedTable(spark, new_folder(spark, "stream-upsert")).create()
    _stream_into(spark, folder, table, 0)
    return table.current()


def stream_replay_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The same table after everything is read again from the start."""
    table = KeyedTable(spark, new_folder(spark, "stream-replay")).create()
    _stream_into(spark, folder, table, 0)
    _stream_into(spark, folder, table, 1)
    return table.current()


def stream_report(spark: SparkSession, folder: str) -> DataFrame:
    table = jobs.report_table(spark, new_folder(spark, "stream-report")).create()
    jobs.refresh_report(
        _messages(spark, folder, BOTH_TOPICS), table, "pass0", new_folder(spark, "checkpoint"),
        available_now=True,
    ).awaitTermination()
    return _cents(table.current(), "us_dollars")


def stream_report_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """The report read again from the keyed table that a stream has filled."""
    table = KeyedTable(spark, new_folder(spark, "stream-keyed")).create()
    _stream_into(spark, folder, table, 0)
    rows = table.current(columns=[*REPORT_DIMENSIONS, "amount"])
    return _cents(report.open_payments(rows), "us_dollars")


def live_report_current(spark: SparkSession, folder: str) -> DataFrame:
    """The report that signed differences keep while both topics are read, twice."""
    table = KeyedTable(spark, new_folder(spark, "live-table")).create()
    ledger = Ledger(table, new_folder(spark, "live-ledger"))
    for pass_no in range(2):
        for n, topic in enumerate(testdata.TOPICS):
            jobs.refresh_current(
                _messages(spark, folder, topic, max_files_per_trigger=_files_per_batch(spark, folder)), ledger,
                f"pass{pass_no}-{n}", new_folder(spark, "checkpoint"), available_now=True,
                fold_every=2,
            ).awaitTermination()
    return _cents(ledger.report(), "us_dollars")


def stream_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """What the listener has seen of a run with a trigger that was stopped at the end of the topics."""
    with RunLog().on(spark) as log:
        query = jobs.store_parsed(
            _messages(spark, folder, BOTH_TOPICS, max_files_per_trigger=_files_per_batch(spark, folder)),
            new_folder(spark, "followed"), new_folder(spark, "checkpoint"), interval="0 seconds",
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        log.of(query)
        rows = log.frame(spark)
    return rows.groupBy("reason").agg(
        F.sum("batch_messages").alias("n_messages"), F.max("total_messages").alias("running_total")
    )


def live_report_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What became of the messages of a report, lines without a specialty cut short."""
    cut = fields.cut_where_blank(F.col("value"), SOURCE_POSITIONS["physician_specialty"])
    damaged = _messages(spark, folder, BOTH_TOPICS).select(cut.alias("value"), topics.SEQUENCE)
    table = KeyedTable(spark, new_folder(spark, "rejecting-table")).create()
    ledger = Ledger(table, new_folder(spark, "rejecting-ledger"))
    rejects = new_folder(spark, "rejecting-rejects")
    jobs.refresh_current(
        damaged, ledger, "r0", new_folder(spark, "checkpoint"), available_now=True, rejects=rejects
    ).awaitTermination()
    kept = table.log(table.batches()).agg(F.count("*").alias("n_records"))
    lost = spark.read.schema("value string, n_fields int").option("recursiveFileLookup", True).parquet(rejects)
    return kept.crossJoin(lost.agg(F.count("*").alias("n_rejects")))


QUERIES: dict[str, Query] = {
    # Sources
    "scan_csv": scan_csv,
    "scan_lines": _on_lines(lambda lines: lines),
    "scan_payments": testdata.payments,
    "scan_payments_narrow": scan_payments_narrow,
    "scan_json_tolerant": scan_json_tolerant,
    "sql_on_path": sql_on_path,
    # Record transforms
    "parse_lines": _on_lines(etl.parse_lines),
    "parse_lines_standard": _on_lines(etl.parse_standard_csv),
    "reject_lines": _on_lines(reject_lines),
    "amount_lenient": _on_payments(amount_lenient),
    "amount_strict": amount_strict,
    "project_rename": project_rename,
    "build_id": build_id,
    "to_document": _on_payments(etl.to_document),
    "batch_etl": batch_etl,
    # Sinks
    "publish_lines": publish_lines,
    "upsert_batch": upsert_batch,
    "compact_table": compact_table,
    "fold_table": fold_table,
    "key_lookup": key_lookup,
    "result_as_json": _on_payments(result_as_json),
    "view_payments": _on_view("SELECT _id, payer, amount FROM payments"),
    "cache_count": cache_count,
    "payer_index_lookup": payer_index_lookup,
    "filtered_lookup": filtered_lookup,
    "find_written": find_written,
    "load_checked": load_checked,
    "id_prefix_lookup": _on_payments(
        lambda p: find(p, {"$like": {"_id": f"{ID_PREFIX}%"}}, "_id,amount")
    ),
    # Projections
    "select_id_physician": _on_payments(lambda p: p.select("_id", "physician_id")),
    "select_id_physician_amount": _on_payments(lambda p: p.select("_id", "physician_id", "amount")),
    "amount_by_id_prefix": _on_payments(lambda p: q.by_id_prefix(p, ID_PREFIX).select("amount")),
    "first_row": _on_payments(first_row),
    # Filters
    "filter_amount_gt_2000": _on_payments(lambda p: q.amount_above(p, 2000)),
    "filter_amount_gt_1000": _on_payments(lambda p: q.amount_above(p, 1000)),
    "find_amount_ge_10000": _on_payments(
        lambda p: find(p, AMOUNT_AT_LEAST_10000, "_id,nature_of_payment,amount")
    ),
    "physician_prefix_df": _on_payments(
        lambda p: q.by_id_prefix(p, ID_PREFIX).select("_id", "physician_specialty", "amount")
    ),
    "physician_prefix_sql": _on_view(
        f"SELECT _id, physician_id, amount FROM payments WHERE _id LIKE '{ID_PREFIX}%'"
    ),
    "feb_wildcard_df": _on_payments(
        lambda p: q.in_february(p).select("_id", "physician_specialty", "amount")
    ),
    "feb_wildcard_sql": _on_view(
        "SELECT _id, physician_id, amount FROM payments WHERE _id LIKE '%_02/%'"
    ),
    "feb_exact": _on_payments(
        lambda p: q.in_february(p, exact=True).select("_id", "nature_of_payment", "amount")
    ),
    "payments_by_payer": _on_payments(
        lambda p: q.by_payer(p, PAYER).select("_id", "amount", "payer")
    ),
    "payments_payer_contains": _on_payments(
        lambda p: q.payer_like(p, PAYER_PATTERN).select("_id", "amount", "payer")
    ),
    "physician_exact": _on_payments(lambda p: q.by_physician(p, PHYSICIAN)),
    "find_documents": _on_payments(
        lambda p: find(p, f'{{"$eq": {{"payer": "{PAYER}"}}}}', "_id,payer,amount,nature_of_payment")
    ),
    "find_documents_february": _on_payments(
        lambda p: find(p, '{"$like": {"_id": "%_02/%"}}', "_id,amount")
    ),
    "find_limit_5": _on_payments(
        lambda p: find(p, limit=5, order_by=["_id", "payer", "amount", "nature_of_payment"])
    ),
    "find_count": _on_payments(lambda p: find_count(p, AMOUNT_AT_LEAST_10000)),
    "find_count_february": _on_payments(
        lambda p: find_count(p, {"$like": {"_id": "%[_]02/%"}})
    ),
    "exclude_members": _on_payments(exclude_members),
    # Aggregates
    "nature_count": _on_payments(q.count_by),
    "top5_nature_by_count": _on_payments(lambda p: q.count_by(p, limit=5)),
    "nature_count_gt_1000": _on_payments(lambda p: q.count_by(q.amount_above(p, 1000))),
    "top5_nature_by_total": _on_payments(lambda p: q.rounded_total_by(p, q.NATURE, limit=5)),
    "top5_specialty_count_total": _on_payments(
        lambda p: q.rounded_total_by(p, q.SPECIALTY, limit=5, with_count=True, drop_null_group=True)
    ),
    "top5_specialty_total": _on_payments(
        lambda p: q.rounded_total_by(p, q.SPECIALTY, limit=5, drop_null_group=True)
    ),
    "specialty_count_total": _on_payments(
        lambda p: _cents(q.total_by(p, q.SPECIALTY, with_count=True), "total")
    ),
    "top10_specialty_total": _on_payments(
        lambda p: _cents(q.total_by(p, q.SPECIALTY, limit=10), "total")
    ),
    "top5_physician_revenue": _on_payments(
        lambda p: _cents(q.total_by(p, "physician_id", limit=5, name="revenue"), "revenue")
    ),
    "top5_nature_total_raw": _on_payments(
        lambda p: _cents(q.total_by(p, q.NATURE, limit=5), "total")
    ),
    "distinct_payers": _on_payments(q.distinct_payers),
    # Views
    "physicians_by_revenue": _stored_view("physicians_by_revenue", "revenue"),
    "physicians_by_specialty_revenue": _stored_view("physicians_by_specialty_revenue", "total"),
    "aca_open_payments": _stored_view("aca_open_payments", "us_dollars"),
    "aca_open_payments_all": _stored_view("aca_open_payments_all"),
    "keyed_physicians_by_revenue": _keyed_view("physicians_by_revenue", "revenue"),
    "keyed_physicians_by_specialty_revenue": _keyed_view("physicians_by_specialty_revenue", "total"),
    "keyed_open_payments": _keyed_view("aca_open_payments", "us_dollars"),
    "keyed_open_payments_all": _keyed_view("aca_open_payments_all"),
    # Questions with parameters
    "question_natures": _question("natures", limit=7),
    "question_payers": _question("payers", payer=PAYER_PATTERN),
    "question_above": _question("above", floor=float(LARGE_AMOUNT)),
    "question_physician": _question("physician", physician=ID_PREFIX),
    "question_month": _question("month", month="02"),
    # Report
    "map_by_payer": _on_payments(lambda p: report.map_by_payer(report.open_payments(p))),
    "map_by_payer_coded": map_by_payer_coded,
    "map_by_nature": _on_payments(lambda p: report.map_by_nature(report.open_payments(p))),
    "clamped_measure": _on_payments(
        lambda p: report.with_mark_size(report.map_by_payer(report.open_payments(p))).select(
            *report.PLACE, "mark_size"
        )
    ),
    "attr_agg": _on_payments(attr_agg),
    "number_of_records": _on_payments(lambda p: report.number_of_records(report.open_payments(p))),
    "default_summary": _on_payments(
        lambda p: _cents(report.default_summary(report.open_payments(p)), "us_dollars")
    ),
    # Streams
    "stream_multi_source": stream_multi_source,
    "stream_parse": stream_parse,
    "stream_message_count": stream_message_count,
    "stream_peek": stream_peek,
    "stream_timed": stream_timed,
    "stream_upsert": stream_upsert,
    "stream_replay_idempotent": stream_replay_idempotent,
    "stream_report": stream_report,
    "stream_report_keyed": stream_report_keyed,
    "stream_lifecycle": stream_lifecycle,
    "live_report_current": live_report_current,
    "live_report_rejects": live_report_rejects,
}
