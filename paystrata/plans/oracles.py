"""ANSI SQL for DuckDB that gives the same rows as the registered queries."""

from __future__ import annotations

from paystrata.plans.registry import ID_PREFIX, LARGE_AMOUNT, PAYER, PAYER_PATTERN, PHYSICIAN
from paystrata.schema import (
    CSV_COLUMNS,
    PAYMENT_COLUMNS,
    REPORT_DIMENSIONS,
    SOURCE_NAMES,
    SOURCE_POSITIONS,
)
from paystrata.sources.testdata import FILE_ORDER

_PAYMENTS = """WITH payments AS (
  SELECT concat(CAST(o_custkey AS VARCHAR), '_', strftime(o_orderdate, '%m/%d/%Y'), '_',
                CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)) AS _id,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS record_id,
         CAST(o_custkey AS VARCHAR) AS physician_id,
         strftime(o_orderdate, '%m/%d/%Y') AS date_payment,
         s_name AS payer,
         l_extendedprice AS amount,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat(c_mktsegment, '|', p_type) END
           AS physician_specialty,
         p_brand AS nature_of_payment,
         split_part(c_name, '#', 1) AS physician_name_first,
         CAST(NULL AS VARCHAR) AS physician_name_middle,
         split_part(c_name, '#', 2) AS physician_name_last,
         CAST(NULL AS VARCHAR) AS physician_name_suffix,
         concat('City ', CAST(c_custkey % 50 AS VARCHAR)) AS recipient_city,
         n_name AS recipient_state,
         lpad(CAST(c_nationkey * 100 + c_custkey % 100 AS VARCHAR), 5, '0') AS recipient_zip,
         r_name AS recipient_country
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_ALL = ", ".join(PAYMENT_COLUMNS)
_DIMS = ", ".join(REPORT_DIMENSIONS)
_FEBRUARY = "_id LIKE '%#_02/%' ESCAPE '#'"
_LOW_PAYER = "right(payer, 1) < '5'"
_LATER = f"CASE WHEN {_LOW_PAYER} THEN 0 ELSE 1 END"

_REPORT = f""", report AS (
  SELECT {_DIMS}, sum(amount) AS us_dollars FROM payments GROUP BY {_DIMS}
)"""


def _attribute(column: str) -> str:
    return (
        f"CASE WHEN min({column}) = max({column}) THEN min({column}) "
        f"WHEN min({column}) IS NOT NULL THEN '*' END"
    )


_MARKS = f"""{_REPORT}, marks AS (
  SELECT payer, recipient_zip,
         CAST(sum(CAST(trunc(round(us_dollars, 2)) AS BIGINT)) AS BIGINT) AS us_dollars,
         {_attribute("nature_of_payment")} AS nature_of_payment,
         {_attribute("physician_specialty")} AS physician_specialty
  FROM report GROUP BY payer, recipient_zip
)"""


def _latest(batch: str, columns: str = _ALL, rest: str = "") -> str:
    """The winning row per key: the later batch, then the greater row."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in PAYMENT_COLUMNS if c != "_id")
    return f"""{_PAYMENTS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY _id ORDER BY {batch} DESC, {order}) AS place
  FROM payments
) SELECT {columns} FROM ranked WHERE place = 1 {rest}""".rstrip()


def _last_in_file(columns: str = _ALL, rest: str = "", batch: str = "0") -> str:
    """The winning row per key of the delimited files: of the later batch, then by FILE_ORDER."""
    order = ", ".join(
        f"{name} {'ASC NULLS FIRST' if falls else 'DESC NULLS LAST'}" for name, falls in FILE_ORDER
    )
    return f"""{_PAYMENTS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY _id ORDER BY {batch} DESC, {order}) AS place
  FROM payments
) SELECT {columns} FROM ranked WHERE place = 1 {rest}""".rstrip()


def _source_value(name: str) -> str:
    """A source column of the delimited form."""
    by_source = {source: field for field, source in SOURCE_NAMES.items()}
    if name in by_source:
        return f"CAST({by_source[name]} AS VARCHAR)"
    if name == "Change_Type":
        return "'NEW'"
    return "CAST(NULL AS VARCHAR)"


def _line() -> str:
    values = [f"coalesce({_source_value(c)}, '')" for c in CSV_COLUMNS]
    values[CSV_COLUMNS.index("Recipient_Primary_Business_Street_Address_Line1")] = (
        "concat('\"Suite \"\"', recipient_city, '\"\", Floor 1\"')"
    )
    values[CSV_COLUMNS.index("Submitting_Applicable_Manufacturer_or_Applicable_GPO_Name")] = (
        "concat('\"', payer, ', Inc\"')"
    )
    return f"concat_ws(',', {', '.join(values)})"


def _document() -> str:
    parts = []
    for name in PAYMENT_COLUMNS:
        quote = "" if name == "amount" else '"'
        text = f"""'"{name}":{quote}' || CAST({name} AS VARCHAR) || '{quote}'"""
        parts.append(f"CASE WHEN {name} IS NULL THEN NULL ELSE {text} END")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _select(columns: str, rest: str = "") -> str:
    return f"{_PAYMENTS} SELECT {columns} FROM payments {rest}".rstrip()


def _top(group: str, measures: str, order: str, limit: int | None = None, where: str = "") -> str:
    cut = f" LIMIT {limit}" if limit else ""
    return _select(
        f"{group}, {measures}",
        f"{where} GROUP BY {group} ORDER BY {order} DESC NULLS LAST, {group} NULLS FIRST{cut}",
    )


_NOT_NULL = "WHERE physician_specialty IS NOT NULL"
_EVEN_TOTAL = "sum(round_even(amount, 0)) AS total"
_CENTS_TOTAL = "round(sum(amount), 2) AS total"
_BY_PAYER = f"WHERE payer = '{PAYER}'"
_BY_PREFIX = f"WHERE _id LIKE '{ID_PREFIX}%'"

_CURRENT_REPORT = _last_in_file(
    f"{_DIMS}, round(sum(amount), 2) AS us_dollars", f"GROUP BY {_DIMS}", _LATER
)

ORACLES: dict[str, str] = {
    # Sources
    "scan_csv": _select(
        ", ".join(
            f"{_source_value(c)} AS {c}"
            for c in [*SOURCE_NAMES.values(), "Change_Type", "Physician_License_State_code5"]
        )
    ),
    "scan_lines": _select(f"{_line()} AS value"),
    "scan_payments": _select(_ALL),
    "scan_payments_narrow": _select(", ".join(PAYMENT_COLUMNS[:7])),
    "scan_json_tolerant": _select(_ALL),
    "sql_on_path": _select(f"physician_specialty, {_CENTS_TOTAL}", "GROUP BY physician_specialty"),
    # Record transforms
    "parse_lines": _select(_ALL),
    "parse_lines_standard": _select(_ALL),
    "reject_lines": _select(
        "CAST(20 AS INTEGER) AS n_fields, count(*) AS n_lines", "WHERE physician_specialty IS NULL"
    ),
    "amount_lenient": _select(
        "_id, payer, CASE WHEN nature_of_payment = 'Brand#11' OR right(payer, 1) IN ('7', '8') "
        "THEN 0.0 ELSE amount END AS amount"
    ),
    "amount_strict": _select('record_id AS "Record_ID", amount'),
    "project_rename": _select(", ".join(SOURCE_POSITIONS)),
    "build_id": _select("_id, physician_id, date_payment"),
    "to_document": _select(f"_id, {_document()} AS document"),
    "batch_etl": _last_in_file(),
    # Sinks
    "publish_lines": _select("_id, payer, amount"),
    "upsert_batch": _latest(_LATER),
    "compact_table": _latest(_LATER),
    "fold_table": _latest(_LATER),
    "key_lookup": _latest(_LATER, rest="AND _id = (SELECT min(_id) FROM payments)"),
    "result_as_json": f"""{_PAYMENTS}, top AS (
  SELECT physician_specialty, CAST(round(sum(amount), 2) AS DECIMAL(38, 2)) AS total
  FROM payments GROUP BY physician_specialty
  ORDER BY sum(amount) DESC NULLS LAST, physician_specialty NULLS FIRST LIMIT 10
) SELECT '{{"physician_specialty": "' || coalesce(physician_specialty, 'null') || '", "total": '
       || CAST(total AS VARCHAR) || '}}' AS json FROM top""",
    "view_payments": _select("_id, payer, amount"),
    "cache_count": _select("count(*) AS n_rows"),
    "payer_index_lookup": _select("_id, payer, amount, nature_of_payment", _BY_PAYER),
    "filtered_lookup": _select("_id, payer, amount", _BY_PAYER),
    "find_written": _latest(
        _LATER, "count(*) AS n_written, count(*) AS n_found", f"AND amount >= {LARGE_AMOUNT}"
    ),
    "load_checked": _select(
        f"count(*) AS n_loaded, count(*) FILTER (WHERE amount >= {LARGE_AMOUNT}) AS n_bad"
    ),
    "id_prefix_lookup": _select("_id, amount", _BY_PREFIX),
    # Projections
    "select_id_physician": _select("_id, physician_id"),
    "select_id_physician_amount": _select("_id, physician_id, amount"),
    "amount_by_id_prefix": _select("amount", _BY_PREFIX),
    # Filters
    "filter_amount_gt_2000": _select(_ALL, "WHERE amount > 2000"),
    "filter_amount_gt_1000": _select(_ALL, "WHERE amount > 1000"),
    "find_amount_ge_10000": _select("_id, nature_of_payment, amount", "WHERE amount >= 10000"),
    "physician_prefix_df": _select("_id, physician_specialty, amount", _BY_PREFIX),
    "physician_prefix_sql": _select("_id, physician_id, amount", _BY_PREFIX),
    "feb_wildcard_df": _select("_id, physician_specialty, amount", "WHERE _id LIKE '%_02/%'"),
    "feb_wildcard_sql": _select("_id, physician_id, amount", "WHERE _id LIKE '%_02/%'"),
    "feb_exact": _select("_id, nature_of_payment, amount", f"WHERE {_FEBRUARY}"),
    "payments_by_payer": _select("_id, amount, payer", _BY_PAYER),
    "payments_payer_contains": _select("_id, amount, payer", f"WHERE payer LIKE '{PAYER_PATTERN}'"),
    "physician_exact": _select(_ALL, f"WHERE physician_id = '{PHYSICIAN}'"),
    "first_row": _select(
        "CAST(1 AS BIGINT) AS request, least(count(*), 1) AS n_rows, "
        "least(count(*), 1) AS n_found"
    ),
    "find_documents": _select("_id, payer, amount, nature_of_payment", _BY_PAYER),
    "find_documents_february": _select("_id, amount", "WHERE _id LIKE '%_02/%'"),
    "find_limit_5": _select(_ALL, "ORDER BY _id, payer, amount, nature_of_payment LIMIT 5"),
    "find_count": _select("count(*) AS n_found", "WHERE amount >= 10000"),
    "find_count_february": _select("count(*) AS n_found", f"WHERE {_FEBRUARY}"),
    "exclude_members": f"""{_PAYMENTS} SELECT _id, payer, physician_specialty, recipient_zip, amount
FROM payments p WHERE NOT EXISTS (
  SELECT 1 FROM payments m WHERE m.amount > {LARGE_AMOUNT} AND m.payer = p.payer
    AND m.physician_specialty IS NOT DISTINCT FROM p.physician_specialty
    AND m.recipient_zip = p.recipient_zip)""",
    # Aggregates
    "nature_count": _top("nature_of_payment", 'count(*) AS "count"', "count(*)"),
    "top5_nature_by_count": _top("nature_of_payment", 'count(*) AS "count"', "count(*)", 5),
    "nature_count_gt_1000": _top(
        "nature_of_payment", 'count(*) AS "count"', "count(*)", where="WHERE amount > 1000"
    ),
    "top5_nature_by_total": _top("nature_of_payment", _EVEN_TOTAL, "total", 5),
    "top5_specialty_count_total": _top(
        "physician_specialty", f"count(*) AS cnt, {_EVEN_TOTAL}", "total", 5, _NOT_NULL
    ),
    "top5_specialty_total": _top("physician_specialty", _EVEN_TOTAL, "total", 5, _NOT_NULL),
    "specialty_count_total": _top(
        "physician_specialty", f"count(*) AS cnt, {_CENTS_TOTAL}", "sum(amount)"
    ),
    "top10_specialty_total": _top("physician_specialty", _CENTS_TOTAL, "sum(amount)", 10),
    "top5_physician_revenue": _top(
        "physician_id", "round(sum(amount), 2) AS revenue", "sum(amount)", 5
    ),
    "top5_nature_total_raw": _top("nature_of_payment", _CENTS_TOTAL, "sum(amount)", 5),
    "distinct_payers": _select("DISTINCT payer"),
    # Views
    "physicians_by_revenue": _select(
        "physician_id, round(sum(amount), 2) AS revenue", "GROUP BY physician_id"
    ),
    "physicians_by_specialty_revenue": _select(
        f"physician_specialty, {_CENTS_TOTAL}", "GROUP BY physician_specialty"
    ),
    "aca_open_payments": _select(
        f"{_DIMS}, round(sum(amount), 2) AS us_dollars", f"GROUP BY {_DIMS}"
    ),
    "aca_open_payments_all": _select(_ALL),
    "keyed_physicians_by_revenue": _latest(
        _LATER, "physician_id, round(sum(amount), 2) AS revenue", "GROUP BY physician_id"
    ),
    "keyed_physicians_by_specialty_revenue": _latest(
        _LATER, f"physician_specialty, {_CENTS_TOTAL}", "GROUP BY physician_specialty"
    ),
    "keyed_open_payments": _latest(
        _LATER, f"{_DIMS}, round(sum(amount), 2) AS us_dollars", f"GROUP BY {_DIMS}"
    ),
    "keyed_open_payments_all": _latest(_LATER),
    # Questions with parameters
    "question_natures": _top("nature_of_payment", f"count(*) AS cnt, {_EVEN_TOTAL}", "total", 7),
    "question_payers": _top(
        "payer", f"count(*) AS cnt, {_EVEN_TOTAL}", "total", 20, f"WHERE payer LIKE '{PAYER_PATTERN}'"
    ),
    "question_above": _top(
        "nature_of_payment", "count(*) AS cnt", "cnt", where=f"WHERE amount > {LARGE_AMOUNT}"
    ),
    "question_physician": _select("_id, physician_id, physician_specialty, amount", _BY_PREFIX),
    "question_month": _select("_id, physician_specialty, amount", f"WHERE {_FEBRUARY}"),
    # Report
    "map_by_payer": f"{_PAYMENTS}{_MARKS} SELECT * FROM marks",
    "map_by_payer_coded": f"{_PAYMENTS}{_MARKS} SELECT * FROM marks",
    "map_by_nature": f"{_PAYMENTS}{_MARKS} SELECT nature_of_payment AS series, payer, "
                     "recipient_zip, us_dollars, physician_specialty FROM marks",
    "clamped_measure": f"{_PAYMENTS}{_MARKS} SELECT payer, recipient_zip, "
                       "greatest(1, least(40000, us_dollars)) AS mark_size FROM marks",
    "attr_agg": _select(
        f"physician_id, {_attribute('recipient_state')} AS recipient_state, "
        f"{_attribute('payer')} AS payer, "
        f"{_attribute('physician_name_middle')} AS physician_name_middle",
        "GROUP BY physician_id",
    ),
    "number_of_records": f"{_PAYMENTS}{_REPORT} SELECT count(*) AS number_of_records FROM report",
    "default_summary": f"{_PAYMENTS}{_REPORT} SELECT "
                       + ", ".join(f"count({d}) AS n_{d}" for d in REPORT_DIMENSIONS)
                       + ", round(sum(us_dollars), 2) AS us_dollars FROM report",
    # Streams
    "stream_multi_source": _select(
        f"CASE WHEN {_LOW_PAYER} THEN 'payments_low' ELSE 'payments_high' END AS topic, _id, amount"
    ),
    "stream_parse": _select(_ALL),
    "stream_message_count": _select(
        "CAST(0 AS BIGINT) AS batch_id, count(*) AS batch_messages, "
        "CAST(count(*) AS BIGINT) AS total_messages"
    ),
    "stream_peek": _select(
        "CAST(0 AS BIGINT) AS batch_id, least(count(*), 10) AS n_rows, "
        "least(count(*), 10) AS n_found"
    ),
    "stream_timed": _select(_ALL),
    "stream_upsert": _last_in_file(batch=_LATER),
    "stream_replay_idempotent": _last_in_file(batch=_LATER),
    "stream_report_keyed": _CURRENT_REPORT,
    "stream_lifecycle": _select(
        "'ended' AS reason, CAST(count(*) AS BIGINT) AS n_messages, count(*) AS running_total"
    ),
    "live_report_current": _CURRENT_REPORT,
    "live_report_rejects": _select(
        "count(physician_specialty) AS n_records, count(*) - count(physician_specialty) AS n_rejects"
    ),
    "stream_report": _select(
        f"{_DIMS}, round(sum(amount), 2) AS us_dollars", f"GROUP BY {_DIMS}"
    ),
}
