"""The payments table and its other forms, derived from the star-schema tables.

Each form is written once per process and state of the input, into the shared
folder, by a Spark job over the whole tables; queries then scan it.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.fields import null_to_blank, payment_key, strip_quotes
from paystrata.operators.etl import KEY_PARTS
from paystrata.schema import CSV_COLUMNS, PAYMENT_COLUMNS, SOURCE_NAMES
from paystrata.session import TABLE_OPTIONS, bytes_at, new_folder, partitions_for, scans_of
from paystrata.sinks.layouts import write_by_payer, write_sorted
from paystrata.sinks.messages import write_publication
from paystrata.sources.files import read_payments

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
# Order of the rows of one key in the delimited copy: (column, falling).
FILE_ORDER = (
    ("amount", True), ("payer", False), ("physician_specialty", False),
    ("nature_of_payment", False),
)
# Of the joined tables, what a payment is made from.
JOINED_COLUMNS = (
    "o_custkey", "o_orderdate", "l_orderkey", "l_linenumber", "s_name", "l_extendedprice",
    "c_mktsegment", "p_type", "p_brand", "c_name", "c_nationkey", "n_name", "r_name",
)
TOPICS = ("payments_low", "payments_high")
# About what a payment takes as a line, and as a row that is sorted. The tables hold far
# less, compressed and without the text that the joins repeat.
ROW_BYTES = 256
# Lines repeat much, so the delimited copy, the topics and the documents are kept compressed:
# their files, which then cannot be split, are many instead.
TEXT_OPTIONS = {"compression": "gzip"}

_written: dict[tuple, str] = {}
_lock = threading.RLock()


def join_tables(spark: SparkSession, folder: str) -> DataFrame:
    """One narrow row per line item, plus ``_row``, its place in the line item file.

    The line items meet part and supplier while their rows are still narrow, and
    the wide order side last. No join is forced to broadcast: sizes decide, and
    adaptive execution splits hot keys.
    """
    table = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in TABLES}
    people = (
        table["customer"]
        .join(table["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = table["orders"].join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderdate", "c_name", "c_nationkey", "n_name",
        "r_name", "c_mktsegment",
    )
    lines = (
        table["lineitem"]
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
            F.col("_metadata.row_index").alias("_row"),
        )
        .join(table["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(table["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *JOINED_COLUMNS, "_row"
    )


def _fields_of_joined() -> dict[str, Column]:
    """The record's fields in terms of a joined row."""
    customer = F.col("o_custkey")
    found = {
        "physician_id": customer.cast("string"),
        "date_payment": F.date_format("o_orderdate", "MM/dd/yyyy"),
        "record_id": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
        "payer": F.col("s_name"),
        "amount": F.col("l_extendedprice"),
        "physician_specialty": F.when(
            F.col("p_type") != "PROMO", F.concat_ws("|", "c_mktsegment", "p_type")
        ),
        "nature_of_payment": F.col("p_brand"),
        "physician_name_first": F.split_part("c_name", F.lit("#"), F.lit(1)),
        "physician_name_middle": F.lit(None).cast("string"),
        "physician_name_last": F.split_part("c_name", F.lit("#"), F.lit(2)),
        "physician_name_suffix": F.lit(None).cast("string"),
        "recipient_city": F.concat(F.lit("City "), (customer % 50).cast("string")),
        "recipient_state": F.col("n_name"),
        "recipient_zip": F.lpad(
            (F.col("c_nationkey") * 100 + customer % 100).cast("string"), 5, "0"
        ),
        "recipient_country": F.col("r_name"),
    }
    key = payment_key(*[found.pop(part) if part == "record_id" else found[part] for part in KEY_PARTS])
    return {"_id": key, **found}


def as_payments(joined: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The payment of each joined row."""
    fields = _fields_of_joined()
    return joined.select(*[fields[name].alias(name) for name in PAYMENT_COLUMNS], *carry)


def payments_from_tables(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per line item, plus ``_row``, its place in the line item file."""
    return as_payments(join_tables(spark, folder), ["_row"])


def _file_system(spark: SparkSession, name: str):
    """A Hadoop path and the file system it is on."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def _stamp(spark: SparkSession, folder: str) -> tuple:
    """A value that changes when a file of the input tables does."""
    marks = []
    for name in TABLES:
        path, system = _file_system(spark, f"{folder}/{name}.parquet")
        summary = system.getContentSummary(path)
        changed = system.getFileStatus(path).getModificationTime()
        marks.append((summary.getLength(), summary.getFileCount(), changed))
    return tuple(marks)


def _derived(
    spark: SparkSession, folder: str, form: str, write: Callable[[str, int], None]
) -> str:
    """Path of a written form; ``write(path, row_bytes)`` makes it when it is new."""
    key = (folder, form, _stamp(spark, folder))
    with _lock:
        if key in _written:
            path, system = _file_system(spark, _written[key])
            if system.exists(path):
                return _written[key]
        target = new_folder(spark, form)
        write(target, spark.read.parquet(f"{folder}/lineitem.parquet").count() * ROW_BYTES)
        _written[key] = target
        return target


def joined_path(spark: SparkSession, folder: str) -> str:
    """The joined rows in no order: the other forms sort them, and none joins again.

    Sorting looks at its rows twice, first for a sample. What it moves are these rows; the
    text of the record is made from them afterwards.
    """

    def write(path: str, size: int) -> None:
        with scans_of(spark, bytes_at(spark, f"{folder}/lineitem.parquet"), size):
            join_tables(spark, folder).write.options(**TABLE_OPTIONS).parquet(path)

    return _derived(spark, folder, "joined", write)


@contextmanager
def _joined(spark: SparkSession, folder: str, size: int) -> Iterator[DataFrame]:
    """The joined rows for a form to be written within, which sorts ``size`` bytes of them."""
    path = joined_path(spark, folder)
    with scans_of(spark, bytes_at(spark, path), size):
        yield spark.read.parquet(path)


def payments_path(spark: SparkSession, folder: str) -> str:
    """The main copy, in key order."""

    def write(path: str, size: int) -> None:
        n = partitions_for(spark, size)
        with _joined(spark, folder, size) as rows:
            write_sorted(
                rows, path, ["_id"], spread=["_row"], partitions=n,
                made=as_payments, places={"_id": _fields_of_joined()["_id"]},
            )

    return _derived(spark, folder, "payments", write)


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return read_payments(spark, payments_path(spark, folder))


def payer_copy_path(spark: SparkSession, folder: str) -> str:
    """The second copy, in payer order."""

    def write(path: str, size: int) -> None:
        write_by_payer(payments(spark, folder), path, partitions_for(spark, size))

    return _derived(spark, folder, "payments-by-payer", write)


def source_rows(records: DataFrame) -> DataFrame:
    """Records back in the 75-column source form, with text that needs quoting."""
    values = {
        source: F.split_part("_id", F.lit("_"), F.lit(3)) if field == "record_id"
        else F.col(field).cast("string")
        for field, source in SOURCE_NAMES.items()
    }
    values["Change_Type"] = F.lit("NEW")
    values["Recipient_Primary_Business_Street_Address_Line1"] = F.concat(
        F.lit('Suite "'), "recipient_city", F.lit('", Floor 1')
    )
    values["Submitting_Applicable_Manufacturer_or_Applicable_GPO_Name"] = F.concat(
        "payer", F.lit(", Inc")
    )
    return records.select(
        *[values.get(c, F.lit(None).cast("string")).alias(c) for c in CSV_COLUMNS]
    )


def _in_file_order(spark: SparkSession, joined: DataFrame, size: int) -> DataFrame:
    """Their payments in key order and ``FILE_ORDER``, over all tasks and within each."""
    order = [("_id", False), *FILE_ORDER]
    fields = _fields_of_joined()
    places = [fields[c].desc() if falls else fields[c].asc() for c, falls in order]
    ranged = joined.repartitionByRange(partitions_for(spark, size), *places)
    return as_payments(ranged).sortWithinPartitions(
        *[F.desc(c) if falls else F.asc(c) for c, falls in order]
    )


def csv_path(spark: SparkSession, folder: str) -> str:
    """The delimited source files, each with its header, in key order and ``FILE_ORDER``."""

    def write(path: str, size: int) -> None:
        with _joined(spark, folder, size) as joined:
            rows = source_rows(_in_file_order(spark, joined, size))
            rows.write.options(header=True, escape='"', **TEXT_OPTIONS).csv(path)

    return _derived(spark, folder, "csv", write)


def topics_root(spark: SparkSession, folder: str) -> str:
    """Two topics, published in file order: payers ending in 0-4, and the others.

    The messages are the lines of the delimited copy, made from the same rows in the same
    order, so that no line has to be split again to learn its payer.
    """

    def write(path: str, size: int) -> None:
        payer = strip_quotes(null_to_blank(_fields_of_joined()["payer"]))
        low = F.right(payer, F.lit(1)) < "5"
        with _joined(spark, folder, size) as rows:
            for topic, chosen in zip(TOPICS, (low, ~low)):
                source = source_rows(_in_file_order(spark, rows.filter(chosen), size // len(TOPICS)))
                line = F.to_csv(F.struct(*source.columns), {"escape": '"'})
                write_publication(source.select(line.alias("value")), f"{path}/{topic}", **TEXT_OPTIONS)

    return _derived(spark, folder, "topics", write)


def documents_path(spark: SparkSession, folder: str) -> str:
    """JSON documents with a field that the record does not have."""

    def write(path: str, size: int) -> None:
        stored = payments_path(spark, folder)
        with scans_of(spark, bytes_at(spark, stored), size):
            rows = read_payments(spark, stored).withColumn("source", F.lit("generated"))
            documents = rows.select(F.to_json(F.struct("*")).alias("value"))
            documents.write.options(**TEXT_OPTIONS).text(path)

    return _derived(spark, folder, "documents", write)
