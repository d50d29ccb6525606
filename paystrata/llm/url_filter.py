"""URL filter: listed rules first, then a tree of path templates per host.

A rule is a host and a path prefix. It fits its host and all subdomains, and the
longest fitting rule decides. The rules' verdicts also serve as labels for the
rest: per host, paths become templates whose variable segments are wildcards,
branches whose labelled share does not differ from their siblings' are merged into ``*``,
and a template is rejected when its labelled share of blocked URLs, smoothed
towards one half, reaches ``REJECT``. Branches without labels cannot be told apart: below
a node they are one template that ends in ``?``, and it is allowed. How many siblings a
branch has, and how deep a path goes, decides nothing.

The tree is built level by level on distinct templates with counts, never on single
URLs, and a host with a third of all rows is combined on the map side. A level is
settled only where labelled paths still go on and more than one shape is left, so
a long path costs no levels of its own.

Defined results: a null URL, or one without ``://``, has an empty host and path and
falls under the template of that empty host; repeated rows count as often as they
stand; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import cut

# The rules of the registered query, as (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
SAME_Z2 = 3.84
PRIOR_WEIGHT = 2.0
REJECT = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lowered, and the path without query and fragment."""
    url = F.coalesce(url, F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def segment_shape(segment: Column) -> Column:
    """Segments that vary by form: numbers, dates and hex strings."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(stem.rlike(r"^[0-9][0-9._-]*$"), F.lit("{n}"))
        .when(stem.rlike(r"^(?=[^-]*[0-9])[0-9a-fA-F-]{8,}$"), F.lit("{h}"))
        .otherwise(segment)
    )


def shaped_path(path: Column) -> Column:
    """The segments in general form."""
    return F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""), segment_shape)


def _level(tree: DataFrame, level: int) -> DataFrame:
    """Settles the segment at ``level`` of the templates that are still open.

    ``done`` holds the segments already settled. A labelled child is merged with its
    siblings when the squared z score of its blocked share against theirs stays below
    ``SAME_Z2``. One without labels ends the template, and so does a node with a single
    shape, whose other segments can only be alike.
    """
    child = F.get("shape", F.lit(level))
    opened = tree.where("open")
    branches = opened.groupBy("host", "done", child.alias("child")).agg(
        F.sum("n_labelled").alias("c_n"), F.sum("n_blocked").alias("c_b"),
        F.count(F.lit(1)).alias("shapes"),
    )
    nodes = branches.groupBy("host", "done").agg(
        F.sum("c_n").alias("all_n"), F.sum("c_b").alias("all_b"),
        F.sum("shapes").alias("all_shapes"),
    )
    share = F.col("all_b") / F.col("all_n")
    gap = F.col("c_b") - F.col("c_n") * share
    z2 = gap * gap / (F.col("c_n") * share * (1 - share))
    alike = (F.col("all_b") == 0) | (F.col("all_b") == F.col("all_n")) | (z2 < SAME_Z2)
    kept = F.when(F.col("c_n") == 0, F.lit("?")).when(alike, F.lit("*")).otherwise(F.col("child"))
    verdicts = branches.join(nodes, ["host", "done"]).select(
        F.col("host").alias("_host"), F.col("done").alias("_done"), F.col("child").alias("_child"),
        F.when(F.col("child").isNull(), F.col("done")).otherwise(F.concat_ws("/", "done", kept))
        .alias("_settled"),
        (F.col("child").isNotNull() & (F.col("c_n") > 0)).alias("_goes_on"),
        (F.col("all_shapes") == 1).alias("_single"),
    )
    same = (
        (F.col("host") == F.col("_host")) & (F.col("done") == F.col("_done"))
        & F.col("_now").eqNullSafe(F.col("_child"))
    )
    last = F.col("_single") & F.col("_goes_on")
    rest = F.repeat(F.lit("/*"), F.size("shape") - (level + 1))
    settled = opened.withColumn("_now", child).join(verdicts, same).select(
        "host", "shape",
        F.when(last, F.concat("_settled", rest)).otherwise(F.col("_settled")).alias("done"),
        "n_labelled", "n_blocked",
        (F.col("_goes_on") & ~F.col("_single") & (F.size("shape") > level + 1)).alias("open"),
    )
    return tree.where("not open").unionByName(settled)


def template_verdicts(judged: DataFrame) -> DataFrame:
    """(host, shape, template, blocked_share, template_verdict) per distinct shape.

    ``judged`` has host, shape, and label: the rule's verdict or null.
    """
    tree = cut(
        judged.groupBy("host", "shape").agg(
            F.count("label").alias("n_labelled"),
            F.sum((F.coalesce(F.col("label"), F.lit("")) == "block").cast("long"))
            .alias("n_blocked"),
        ),
        "url-shapes",
    )
    tree = tree.withColumns({"done": F.lit(""), "open": F.size("shape") > 0})
    level = 0
    while tree.where("open").limit(1).count():
        tree, level = cut(_level(tree, level), f"url-level-{level}"), level + 1
    templates = tree.groupBy("host", "done").agg(
        F.sum("n_labelled").alias("t_n"), F.sum("n_blocked").alias("t_b")
    )
    share = (F.col("t_b") + PRIOR_WEIGHT / 2) / (F.col("t_n") + PRIOR_WEIGHT)
    return tree.join(templates, ["host", "done"]).select(
        "host", "shape", F.col("done").alias("template"), share.alias("blocked_share"),
        F.when(share >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
        .alias("template_verdict"),
    )


def judge(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, template and blocked_share of every URL."""
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = fitting_rule(F.col("host"), F.col("path"))
    judged = judged.select(
        "*", rule.alias("rule"), says.alias("label"), shaped_path(F.col("path")).alias("shape")
    )
    verdicts = cut(template_verdicts(judged.select("host", "shape", "label")), "url-templates")
    return judged.join(verdicts, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("label", "template_verdict").alias("verdict"), "template", "blocked_share",
    )
