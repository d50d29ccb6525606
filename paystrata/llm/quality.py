"""Quality rules per document, and verdicts per host drawn from their failures.

Every document is measured by column expressions alone. Failures are counted by
host, and each host's rate is shrunk towards the rate of all hosts with a beta
prior whose two parameters come from the hosts' own rates (method of moments).
A host whose shrunk rate reaches ``host_reject`` takes its documents with it.

Defined results: a null text has no words and so fails; a null host is a host of
its own; repeated rows count as often as they stand; an empty table gives an
empty result; other columns are passed through untouched by ``apply_rules``.
Column names that begin with ``_q_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import SPACES, cut, let, text_or_empty, words

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HOST_REJECT = 0.9
WINDOW = 3


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text.

    Windows are sorted by their hash, so equal ones become neighbours; the work
    is n log n in the words of one text, also where all of them repeat.
    """
    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        )

    def covered(starts: Column) -> Column:
        spread = F.transform(starts, lambda i: F.array(*[i + k for k in range(WINDOW)]))
        return F.size(F.array_distinct(F.flatten(spread)))

    def count(hashes: Column) -> Column:
        def same(s: Column, x: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

        ordered = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        twice = let(
            ordered, lambda s: F.filter(s, lambda x, k: same(s, x, k - 1) | same(s, x, k + 1))
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            covered(F.transform(twice, lambda x: x["i"]))
        )

    return let(
        tokens,
        lambda w: F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(let(windows(w), count)),
    ).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """The counts that the rules use, by name."""
    def without(characters: str) -> Column:
        return F.length(F.translate(text, characters, ""))

    tokens = words(text)
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": without(SPACES).cast("long"),
        "n_symbols": (F.length(text) - without(SYMBOLS)).cast("long"),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(tokens),
    }


def failed(n_words: Column, n_repeat_words: Column) -> Column:
    """The base rules: too short, or mostly repeated."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def host_rates(judged: DataFrame, host: str, failure: str) -> DataFrame:
    """(host, n, n_failed, rate): failure rates shrunk by the beta prior of all hosts.

    Counts combine on the map side, so a host with a third of all rows costs one
    row per task. The prior is two numbers from one row of sums. With one host,
    or hosts of equal rates, the prior is as strong as ``n`` documents.
    """
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(failure).cast("long")).alias("n_failed"),
    )
    hosts = cut(hosts.withColumn("raw", F.col("n_failed") / F.col("n")), "host-counts")
    sums = hosts.agg(
        F.sum("n").alias("n"), F.sum("n_failed").alias("f"),
        F.count(F.lit(1)).alias("k"), F.var_samp("raw").alias("v"),
    ).first()
    total, bad, n_hosts = sums["n"] or 0, sums["f"] or 0, sums["k"]
    mean = (bad + 1.0) / (total + 2.0)
    spread = sums["v"] if n_hosts > 1 else None
    strength = mean * (1 - mean) / spread - 1 if spread else float(max(total, 1))
    strength = min(max(strength, 2.0), float(max(total, 2)))
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.select("host", "n", "n_failed", rate.alias("rate"))


def with_host_verdict(
    judged: DataFrame, host: str, failure: str, host_reject: float = HOST_REJECT
) -> DataFrame:
    """``judged`` with ``_q_kept``: the row passed, and its host was not rejected.

    Only rejected hosts are joined. Spark broadcasts them if their files are small
    and otherwise shuffles, where adaptive execution splits a hot host.
    """
    rejected = host_rates(judged, host, failure).where(F.col("rate") >= host_reject).select(
        F.col("host").alias("_q_host"), F.lit(True).alias("_q_rejected")
    )
    return (
        judged.join(rejected, F.col(host).eqNullSafe(F.col("_q_host")), "left")
        .withColumn("_q_kept", ~F.col(failure) & F.col("_q_rejected").isNull())
        .drop("_q_host", "_q_rejected")
    )


def judge(documents: DataFrame) -> DataFrame:
    """One row per document: its measures, ``base_failed`` and ``kept``."""
    measured = documents.select(
        "doc_id", "source",
        *[c.alias(name) for name, c in measures(text_or_empty()).items()],
    ).withColumn("base_failed", failed(F.col("n_words"), F.col("n_repeat_words")))
    verdicts = with_host_verdict(cut(measured, "quality"), "source", "base_failed")
    return verdicts.withColumnRenamed("_q_kept", "kept")


def apply_rules(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    def base(tokens: Column) -> Column:
        return failed(F.size(tokens), repeated_words(tokens))

    marked = documents.withColumn("_q_failed", let(words(text_or_empty()), base))
    verdicts = with_host_verdict(cut(marked, "quality"), "source", "_q_failed")
    return verdicts.where("_q_kept").select(*[F.col(f"`{c}`") for c in documents.columns])
