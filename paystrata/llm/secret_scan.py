"""Secret scan over a ledger of content-addressed blobs.

Every text is addressed by its SHA-256. Only pairs of blob and rule version that
the ledger does not hold are scanned, each blob once however many paths carry it,
and the findings are joined back to all paths. A ledger is a Parquet folder of
(blob, rule_version, findings); ``scan`` appends what it scanned. The version is
a hash of the rules, so a changed rule scans every blob again and old entries stay
for old versions. The registered query keeps its ledger in the folder that the session
names in ``spark.paystrata.secrets.ledger``: a later call, also of another application,
scans only texts that no call has seen. Without that setting every call begins a ledger of
its own in the shared folder and scans every distinct blob. Two calls at once may both scan
a new blob; a blob's entries of one version are taken once when read.

Findings are (kind, start, end) in code points, end exclusive, leftmost and
non-overlapping per kind, ordered by start and then by the order of ``KINDS``.

Defined results: a null text is the empty blob without findings; repeated rows get
the same findings each; an empty table gives an empty result. Very long texts are
scanned whole. Column names that begin with ``_s_`` are reserved; a column ``blob`` of
the documents is replaced by the address.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import let, matches, sha256_hex, text_or_empty
from paystrata.session import new_folder

# Kind, pattern, and the group and least length that a match must have.
BASE_KINDS = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
ADDED_KINDS = (
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x0A\x0D\x20]*-----END [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("hosted", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})", 0, 0),
    ("url_login", r"[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@[^\s/@]+", 0, 0),
)
KINDS = BASE_KINDS + ADDED_KINDS
SCANNER = "1"  # to be raised when the way spans are found changes
LEDGER_SETTING = "spark.paystrata.secrets.ledger"
RULE_VERSION = hashlib.sha256(repr((SCANNER, KINDS)).encode()).hexdigest()[:16]
ENTRY = "blob string, rule_version string, findings array<struct<start:int,rank:int,end:int>>"


def kind_spans(text: Column, rank: int, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind: (start, rank, end), found between the pieces of a split."""
    def place(found: Column, pieces: Column) -> Column:
        sizes = F.zip_with(
            pieces, found, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m"))
        )
        empty = F.array().cast("array<struct<start:int,rank:int,end:int>>")
        state = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["p"]
            span = F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), (start + x["m"]).alias("end")
            )
            return F.struct(
                (start + F.coalesce(x["m"], F.lit(0))).alias("at"),
                F.when(x["m"].isNull(), acc["spans"])
                .otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"),
            )

        return F.aggregate(sizes, state, step, lambda acc: acc["spans"])

    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")

    def checked(found: Column) -> Column:
        spans = place(found, F.split(text, pattern, -1))
        if least == 0 or group == 0 and f"{{{least}," in pattern:
            return spans
        long_enough = F.zip_with(
            spans, matches(text, pattern, group),
            lambda span, value: F.when(F.length(value) >= least, span),
        )
        return F.filter(long_enough, lambda span: span.isNotNull())

    return let(
        matches(text, pattern),
        lambda found: F.when(F.size(found) == 0, none).otherwise(checked(found)),
    )


def findings(text: Column) -> Column:
    """All findings of a text in order, as structs of start, rank and end."""
    spans = [kind_spans(text, rank, *kind[1:]) for rank, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*spans))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The entries of a ledger folder, or null if there is no such folder yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(ENTRY).parquet(path)


def scan(
    documents: DataFrame, ledger: DataFrame | None = None, ledger_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(paths with their blob, ledger after the scan).

    ``ledger`` is what earlier scans left. The result's ledger is computed once if
    ``ledger_path`` is given: new entries are appended there and read back.
    """
    spark = documents.sparkSession
    versions = documents.withColumn("_s_text", text_or_empty()).withColumn(
        "blob", sha256_hex(F.col("_s_text"))
    )
    unseen = versions.select("blob", F.col("_s_text").alias("text"))
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == RULE_VERSION).select("blob")
        unseen = unseen.join(known, "blob", "left_anti")
    scanned = unseen.dropDuplicates(["blob"]).select(
        "blob", F.lit(RULE_VERSION).alias("rule_version"), findings(F.col("text")).alias("findings")
    )
    if ledger_path is not None:
        scanned.write.mode("append").parquet(ledger_path)
        after = spark.read.schema(ENTRY).parquet(ledger_path)
        if ledger is not None:
            # the caller may keep older entries elsewhere
            after = after.unionByName(ledger.select(*scanned.columns)).dropDuplicates(
                ["blob", "rule_version"]
            )
    else:
        after = scanned if ledger is None else scanned.unionByName(ledger.select(*scanned.columns))
    return versions.drop("_s_text"), after


def scan_into(documents: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """``scan`` with the one ledger at ``path``, which begins empty."""
    spark = documents.sparkSession
    paths, _ = scan(documents, read_ledger(spark, path), path)
    return paths, spark.read.schema(ENTRY).parquet(path)


def own_ledger(spark: SparkSession) -> str:
    """The ledger that the session names, or a new one below the shared folder."""
    return spark.conf.get(LEDGER_SETTING, None) or new_folder(spark, "secret-ledger")


def with_findings(
    documents: DataFrame, ledger: DataFrame | None = None, path: str | None = None
) -> DataFrame:
    """Every path with ``blob`` and its ``findings``; the ledger is a frame or kept at ``path``."""
    paths, after = scan_into(documents, path) if path else scan(documents, ledger)
    current = after.where(F.col("rule_version") == RULE_VERSION).select("blob", "findings")
    return paths.join(current.dropDuplicates(["blob"]), "blob", "left")


def digest(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, the counts of the base kinds, and all spans as text."""
    found = with_findings(documents.select("doc_id", "text"), path=path).select("doc_id", "findings")
    names = F.array(*[F.lit(kind[0]) for kind in KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    def count(rank: int) -> Column:
        return F.size(F.filter("findings", lambda s: s["rank"] == rank)).cast("long")

    base = F.filter("findings", lambda s: s["rank"] < len(BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(rank).alias(f"n_{kind[0]}") for rank, kind in enumerate(BASE_KINDS)],
        sha256_hex(listed(base)).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
    )
