"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Query times are
medians of warm runs over the stored payments table; ``setup`` is its build.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.operators import coded, etl, queries as q, report
from paystrata.operators.find import find
from paystrata.plans import registry
from paystrata.session import apply_scale, bytes_at, new_folder
from paystrata.sinks import loading
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sinks.ledger import Ledger
from paystrata.sources import files, testdata, topics
from paystrata.streaming import jobs

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    apply_scale(spark, sum(bytes_at(spark, f"{FOLDER}/{n}.parquet") for n in testdata.TABLES))
    return spark


def drain(frame: DataFrame) -> None:
    """Compute every row and column, and keep nothing."""
    frame.write.format("noop").mode("overwrite").save()


def timed(run, runs: int = RUNS, warm: int = 1) -> float:
    for _ in range(warm):
        run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    table_path = testdata.payments_path(spark, FOLDER)
    setup = time.perf_counter() - start
    start = time.perf_counter()
    payer_path = testdata.payer_copy_path(spark, FOLDER)
    csv = testdata.csv_path(spark, FOLDER)
    root = testdata.topics_root(spark, FOLDER)
    copies = time.perf_counter() - start
    payments = files.read_payments(spark, table_path)
    by_payer = files.read_payments(spark, payer_path)
    unsorted = new_folder(spark, "unsorted")
    testdata.payments_from_tables(spark, FOLDER).drop("_row").write.parquet(unsorted)
    plain = files.read_payments(spark, unsorted)
    rows = payments.count()

    payer_where = {"$eq": {"payer": registry.PAYER}}
    prefix_where = {"$like": {"_id": f"{registry.ID_PREFIX}%"}}
    open_report = report.open_payments(payments)
    dictionaries = [
        coded.Dictionary.write(payments, column, new_folder(spark, "bench-codes"))
        for column in (q.NATURE, q.SPECIALTY)
    ]
    frames = {
        "nature_count": q.count_by(payments),
        "top5_nature_by_total": q.rounded_total_by(payments, q.NATURE, limit=5),
        "top5_specialty_count_total": q.rounded_total_by(
            payments, q.SPECIALTY, limit=5, with_count=True, drop_null_group=True
        ),
        "top10_specialty_total": q.total_by(payments, q.SPECIALTY, limit=10),
        "top5_physician_revenue": q.total_by(payments, "physician_id", limit=5, name="revenue"),
        "aca_open_payments": open_report,
        "distinct_payers": q.distinct_payers(payments),
        "map_by_payer": report.map_by_payer(open_report),
        "map_by_payer_coded": coded.map_by_payer(open_report, dictionaries),
        "attr_agg": registry.attr_agg(payments),
        "exclude_members": registry.exclude_members(payments),
        "find_amount_ge_10000": find(
            payments, {"$ge": {"amount": 10000}}, "_id,nature_of_payment,amount"
        ),
        "feb_exact": q.in_february(payments, exact=True).select("_id", "amount"),
        "feb_wildcard": q.in_february(payments).select("_id", "amount"),
        "id_prefix_sorted": find(payments, prefix_where, "_id,amount"),
        "id_prefix_unsorted": find(plain, prefix_where, "_id,amount"),
        "payer_lookup_sorted": find(by_payer, payer_where, "_id,payer,amount,nature_of_payment"),
        "payer_lookup_unsorted": find(plain, payer_where, "_id,payer,amount,nature_of_payment"),
        "parse_lines": etl.parse_lines(files.read_lines(spark, csv)),
        "parse_lines_standard": etl.parse_standard_csv(files.read_lines(spark, csv)),
    }
    results = {name: timed(lambda f=frame: drain(f)) for name, frame in frames.items()}

    def load() -> KeyedTable:
        table = KeyedTable(spark, new_folder(spark, "bench-load")).create()
        loading.load(spark, csv, table, "load", new_folder(spark, "bench-rejects"))
        return table

    results["batch_etl"] = timed(load, runs=2)
    loaded = load()
    results["keyed_current"] = timed(lambda: drain(loaded.current()), runs=2)

    def ingest() -> None:
        table = KeyedTable(spark, new_folder(spark, "bench-stream")).create()
        jobs.upsert_parsed(
            topics.folder_stream(spark, root, registry.BOTH_TOPICS), table, "run0",
            new_folder(spark, "checkpoint"), available_now=True,
        ).awaitTermination()

    results["stream_ingest"] = timed(ingest, runs=2)

    # a base that a log of a hundredth of it corrects
    folded = load()
    folded.fold()
    log = payments.where("pmod(xxhash64(_id), 100) = 0").withColumn("amount", F.col("amount") + 1)
    folded.upsert(log, "log")
    results["keyed_current_folded"] = timed(lambda: drain(folded.current()), runs=3)
    results["keyed_find_key"] = timed(lambda: drain(folded.find_key(payments.first()["_id"])), runs=3)

    def live() -> None:
        table = KeyedTable(spark, new_folder(spark, "bench-live")).create()
        jobs.refresh_current(
            topics.folder_stream(spark, root, registry.BOTH_TOPICS),
            Ledger(table, new_folder(spark, "bench-ledger")), "run0",
            new_folder(spark, "checkpoint"), available_now=True,
        ).awaitTermination()

    results["live_report"] = timed(live, runs=2)
    spark.stop()

    results = {name: round(value, 4) for name, value in results.items()}
    rates = {
        name: round(rows / results[name])
        for name in ("parse_lines", "parse_lines_standard", "batch_etl", "stream_ingest")
    }
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(FOLDER.rstrip("/")),
        "cpus": CPUS,
        "rows": rows,
        "setup_sec": round(setup, 3),
        "copies_sec": round(copies, 3),
        "rows_per_sec": rates,
    }))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
