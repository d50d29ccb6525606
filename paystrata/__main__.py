"""The jobs from the command line: ``python -m paystrata <job> ...``.

The master comes from the submitter (``spark-submit --master``); topics are
folders of text files unless ``--brokers`` names a Kafka cluster.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from paystrata.functions.patterns import FEBRUARY_EXACT
from paystrata.operators import etl, queries as q, report
from paystrata.operators.find import AMOUNT_AT_LEAST_10000, write_found
from paystrata.plans.questions import QUESTIONS, ask, parameters, values_of
from paystrata.plans.views import create_session_views, create_stored_views, session_view
from paystrata.session import apply_scale, build_session, bytes_at, new_folder, partitions_for
from paystrata.sinks import loading
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sinks.layouts import write_by_payer
from paystrata.sinks.ledger import Ledger
from paystrata.sinks.messages import publish_to_folder, publish_to_kafka
from paystrata.sources import files, topics
from paystrata.streaming import jobs
from paystrata.streaming.lifecycle import RunLog

FILE, ROOT, TOPIC, TABLE = "./data/payments.csv", "./data/topics", "payments", "./data/tables/payments"


def _show(title: str, frame: DataFrame, rows: int = 20, truncate: bool = True) -> None:
    print(title)
    frame.show(rows, truncate)


def _messages(spark: SparkSession, args) -> DataFrame:
    if args.brokers:
        return topics.kafka_stream(
            spark, args.topics, args.brokers, max_offsets_per_trigger=args.backlog
        )
    return topics.folder_stream(spark, args.root, args.topics, args.backlog)


def _current(spark: SparkSession, args) -> DataFrame:
    return KeyedTable(spark, args.table).current()


def _rejects(args) -> str:
    return args.rejects or f"{args.table.rstrip('/')}-rejects"


def _follow(spark: SparkSession, *queries: StreamingQuery) -> None:
    for query in queries:
        query.awaitTermination()


def create(spark: SparkSession, args) -> None:
    KeyedTable(spark, args.table).create()


def produce(spark: SparkSession, args) -> None:
    """Publish a file's lines in their order, its header left out."""
    if args.brokers:
        publish_to_kafka(files.read_lines(spark, args.file), args.topics, args.brokers)
        return
    lines = files.read_lines(spark, args.file, in_order=True)
    for path in topics.paths(args.root, args.topics):
        publish_to_folder(lines, path)


def consume(spark: SparkSession, args) -> None:
    """Print messages, or write them to ``--to``, and count them per micro-batch and in all."""
    path = f"{args.checkpoint}/counts"
    with RunLog(print).on(spark) as log:
        query = jobs.count_messages(
            _messages(spark, args), path, f"{args.checkpoint}/offsets", args.once,
            show=args.limit, to=args.to,
        )
        _follow(spark, query)
        log.of(query)
    _show("messages read", jobs.message_counts(spark, path).orderBy("batch_id"))


def peek(spark: SparkSession, args) -> None:
    """Parsed records of each micro-batch on the console."""
    _follow(spark, jobs.peek(
        _messages(spark, args), None, args.checkpoint, args.limit or 10, available_now=args.once,
        rejects=_rejects(args),
    ))


def stream(spark: SparkSession, args) -> None:
    """Topics to keyed table, until stopped."""
    with RunLog(print).on(spark) as log:
        query = jobs.upsert_parsed(
            _messages(spark, args), KeyedTable(spark, args.table), args.run, args.checkpoint,
            args.once, rejects=_rejects(args),
        )
        _follow(spark, query)
        log.of(query)


def load(spark: SparkSession, args) -> None:
    """File to keyed table: every row, or none and a list of the bad ones."""
    table = KeyedTable(spark, args.table)
    loading.load(spark, args.file, table, args.run, _rejects(args))
    _show("payments", table.current())


def query(spark: SparkSession, args) -> None:
    """Answer the named questions, each with the given values that it takes."""
    given = dict(text.split("=", 1) for text in args.set or [])
    unknown = set(given) - {key for name in QUESTIONS for key in parameters(name)}
    if unknown:
        raise ValueError(f"no question takes {sorted(unknown)}")
    session_view(_current(spark, args))
    for name in args.question or QUESTIONS:
        values = values_of(name, given)
        title = ", ".join([name, *(f"{key} = {value!r}" for key, value in values.items())])
        _show(title, ask(spark, name, **values), truncate=False)


def find_documents(spark: SparkSession, args) -> None:
    """All documents found as JSON text, their number and the time taken.

    They are written once, to ``--to`` or a folder of the job's own, and printed from there
    one partition at a time without ``--to``. ``--limit`` asks for some of them only.
    """
    start = time.perf_counter()
    path = args.to or new_folder(spark, "found")
    total = write_found(_current(spark, args), path, args.where, args.fields, args.limit)
    if not args.to:
        for document in spark.read.text(path).toLocalIterator():
            print(document["value"])
    print(f"{total} found in {round((time.perf_counter() - start) * 1000)} ms")


def views(spark: SparkSession, args) -> None:
    """The four views: of this session, or with ``--namespace`` kept in the catalog."""
    if args.namespace:
        names = create_stored_views(spark, args.table, args.namespace)
    else:
        names = create_session_views(spark, _current(spark, args))
    for name in names:
        _show(name, spark.table(name))


def top_specialties(spark: SparkSession, args) -> None:
    top = q.total_by(KeyedTable(spark, args.table).current(), q.SPECIALTY, limit=10)
    _show("top 10 specialties", etl.result_as_json(top, q.SPECIALTY, "total"), truncate=False)


def map_report(spark: SparkSession, args) -> None:
    totals = report.open_payments(KeyedTable(spark, args.table).current())
    _show("by payer and zip", report.with_mark_size(report.map_by_payer(totals)))


def live_report(spark: SparkSession, args) -> None:
    """Topics to keyed table, and the totals over its current rows beside it."""
    ledger = Ledger(KeyedTable(spark, args.table), args.to or f"{args.table.rstrip('/')}-ledger")
    _follow(spark, jobs.refresh_current(
        _messages(spark, args), ledger, args.run, args.checkpoint, args.once,
        rejects=_rejects(args), fold_every=args.fold_every,
    ))
    _show("totals", ledger.report())


def message_report(spark: SparkSession, args) -> None:
    """Totals over all messages, superseded ones included, in a keyed table of their own."""
    table = jobs.report_table(spark, args.to or f"{args.table.rstrip('/')}-report")
    if not table.exists():
        table.create()
    _follow(
        spark,
        jobs.refresh_report(_messages(spark, args), table, args.run, args.checkpoint, args.once),
        jobs.store_rejects(
            _messages(spark, args), f"{_rejects(args)}/{args.run}", f"{args.checkpoint}-rejects", args.once
        ),
    )
    _show("totals", table.current())


def _files(spark: SparkSession, args) -> int:
    return partitions_for(spark, bytes_at(spark, args.table))


def index(spark: SparkSession, args) -> None:
    write_by_payer(KeyedTable(spark, args.table).current(), args.to, _files(spark, args))


def compact(spark: SparkSession, args) -> None:
    """The current rows as a new table."""
    KeyedTable(spark, args.table).compact(args.to, _files(spark, args))


def fold(spark: SparkSession, args) -> None:
    """The log's batches into the base, in place."""
    batches = KeyedTable(spark, args.table).fold()
    print(f"{len(batches)} batches folded")


def vacuum(spark: SparkSession, args) -> None:
    """Delete the batches that the base holds."""
    batches = KeyedTable(spark, args.table).vacuum()
    print(f"{len(batches)} batches deleted")


JOBS = {
    "create": create, "produce": produce, "consume": consume, "peek": peek, "stream": stream,
    "load": load, "query": query, "find": find_documents, "views": views, "top": top_specialties,
    "report": map_report, "live-report": live_report, "message-report": message_report,
    "index": index, "compact": compact, "fold": fold, "vacuum": vacuum,
}
STREAMS = ("consume", "peek", "stream", "live-report", "message-report")
WHERE = {
    "large": AMOUNT_AT_LEAST_10000,
    "february": {"$like": {"_id": FEBRUARY_EXACT}},
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="paystrata", description=__doc__)
    out.add_argument("job", choices=JOBS)
    out.add_argument("--file", default=FILE)
    out.add_argument("--root", default=ROOT, help="folder of the topic folders")
    out.add_argument("--topics", default=TOPIC, help="names separated by commas")
    out.add_argument("--brokers", help="Kafka bootstrap servers")
    out.add_argument("--table", default=TABLE)
    out.add_argument("--to", help="path of the copy to write")
    out.add_argument("--checkpoint", default="./data/checkpoint")
    out.add_argument("--namespace", help="catalog schema of the stored views")
    out.add_argument("--rejects", help="folder of unparsed lines; beside the table if not given")
    out.add_argument("--backlog", type=int, help="offsets, or files, of one micro-batch at most")
    out.add_argument("--run", default=time.strftime("%Y%m%dT%H%M%S"), help="later runs win")
    out.add_argument("--once", action="store_true", help="stop when everything is read")
    out.add_argument("--fold-every", type=int, help="micro-batches between two folds of the table")
    out.add_argument("--question", action="append", choices=QUESTIONS, help="all if not given")
    out.add_argument("--set", action="append", help="name=value, a parameter of the questions")
    out.add_argument("--where", help="JSON condition, or one of: " + ", ".join(WHERE))
    out.add_argument("--fields")
    out.add_argument("--limit", type=int, help="documents or messages to print, if not all")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.where = WHERE.get(args.where, args.where)
    if spark is None:
        spark = build_session(f"paystrata-{args.job}")
        inputs = {
            "produce": [args.file], "load": [args.file, args.table],
            **dict.fromkeys(STREAMS, [] if args.brokers else topics.paths(args.root, args.topics)),
        }.get(args.job, [args.table])
        apply_scale(spark, sum(bytes_at(spark, path) for path in inputs))
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
