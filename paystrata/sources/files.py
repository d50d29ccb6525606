"""Batch readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.schema import CORRUPT, CSV_COLUMNS, CSV_SCHEMA, PAYMENT_SCHEMA
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sources.topics import sequence


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = CSV_SCHEMA,
    multi_line: bool = False,
    with_corrupt: bool = False,
) -> DataFrame:
    """Delimited file with a header; every column is a string.

    With a schema nothing is read ahead, the parser only builds the columns a
    query uses, and a header that differs is an error. Without one the names
    come from the header line. ``with_corrupt`` adds the text of rows that have more or
    fewer columns than the schema; all columns are then parsed.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is not None:
        if with_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def in_file_order(source: DataFrame) -> DataFrame:
    """``source``, just read from files, with each row's place, so that later rows win.

    Files are ordered by path and their blocks by offset; the keyed write numbers the
    rows of a block. Modification times are left out: parallel writers do not finish
    in the order of their parts.
    """
    place = sequence(
        F.lit(None), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.lit(None)
    )
    return source.select("*", place)


def read_lines(
    spark: SparkSession, path: str, header: Sequence[str] | None = tuple(CSV_COLUMNS),
    in_order: bool = False,
) -> DataFrame:
    """Raw lines. The header is dropped by its text, quoted or not, from every file.

    With ``in_order`` each line carries its file and block.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    lines = in_file_order(lines) if in_order else lines
    if header is None:
        return lines
    quoted = [f'"{name}"' for name in header]
    return lines.filter(~F.col("value").isin(",".join(header), ",".join(quoted)))


def count_files(spark: SparkSession, path: str) -> int:
    """Data files below a path; marker files do not count."""
    reader = spark.read.option("recursiveFileLookup", True)
    return len(reader.text(path).inputFiles())


def read_payments(
    spark: SparkSession, path: str, schema: T.StructType = PAYMENT_SCHEMA
) -> DataFrame:
    """Stored records under an enforced schema; columns outside it are ignored.

    A column that the files do not have at all is an error, not NULL.
    """
    bind(spark.read.parquet(path), schema)
    return spark.read.schema(schema).parquet(path)


def bind(frame: DataFrame, schema: T.StructType = PAYMENT_SCHEMA) -> DataFrame:
    """Pick and cast the contract's columns by name; a missing one is an error."""
    present = {name.lower() for name in frame.columns}
    missing = [field.name for field in schema if field.name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return frame.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType = PAYMENT_SCHEMA
) -> DataFrame:
    """JSON documents, one per line; unknown fields are ignored."""
    return parse_documents(spark.read.text(path), schema)


def parse_documents(
    lines: DataFrame, schema: T.StructType = PAYMENT_SCHEMA, column: str = "value"
) -> DataFrame:
    return lines.select(F.from_json(column, schema).alias("document")).select("document.*")


def path_sql(spark: SparkSession, path: str) -> str:
    """How SQL text names a Parquet folder.

    A keyed table is an error, because its folder also holds superseded rows: use
    its ``sql()``.
    """
    if KeyedTable(spark, path).exists():
        raise ValueError(f"{path} is a keyed table: its sql() gives the current rows")
    return f"parquet.`{path}`"
