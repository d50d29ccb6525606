"""Line splitting, field cleaning and amounts on hand-made rows."""

import math
import re
from random import Random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paystrata.functions import fields as f
from paystrata.operators import etl
from paystrata.schema import CSV_COLUMNS, MIN_FIELDS, PAYMENT_COLUMNS, SOURCE_POSITIONS

# A row that needs every kind of care: commas and doubled quotes inside cells, an amount
# without quotes, blanks in the middle and at the end.
SAMPLE_CELLS = {
    "Change_Type": "CHANGED",
    "Teaching_Hospital_Name": "Harbour, Hill and Vale Hospital",
    "Physician_Profile_ID": "77310",
    "Physician_First_Name": "Ilka",
    "Physician_Last_Name": "Vantheur",
    "Physician_Name_Suffix": "III",
    "Recipient_City": "Lowport",
    "Recipient_Zip_Code": "04321-0007",
    "Recipient_Province": "West",
    "Physician_Specialty": "Made Up Trade|Bench Work",
    "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name": "Beryl & Sons, Ltd",
    "Total_Amount_of_Payment_USDollars": "1250.75",
    "Date_of_Payment": "02/09/2015",
    "Nature_of_Payment_or_Transfer_of_Value": "Royalty",
    "City_of_Travel": "Ostwick",
    "Contextual_Information": 'called "final", twice',
    "Record_ID": "5512",
    "Program_Year": "2015",
}


def csv_cell(name: str, text: str) -> str:
    plain = not text or name == "Total_Amount_of_Payment_USDollars"
    return text if plain else '"' + text.replace('"', '""') + '"'


SAMPLE = ",".join(csv_cell(name, SAMPLE_CELLS.get(name, "")) for name in CSV_COLUMNS)


def line(**values) -> str:
    """A source line with some record fields set."""
    cells = [""] * len(CSV_COLUMNS)
    for name, text in values.items():
        cells[SOURCE_POSITIONS[name]] = text
    return ",".join(cells)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def parse_one(spark, text, **options):
    return etl.parse_lines(lines(spark, text), **options).collect()[0]


def expected_split(text: str) -> list[str]:
    """A comma separates when an even number of quotes follows it."""
    out, start = [], 0
    for found in re.finditer(",", text):
        if text.count('"', found.start()) % 2 == 0:
            out.append(text[start:found.start()])
            start = found.end()
    return [*out, text[start:]]


def test_positions():
    assert len(CSV_COLUMNS) == 75
    assert SOURCE_POSITIONS == {
        "physician_id": 5, "date_payment": 31, "record_id": 45, "payer": 27, "amount": 30,
        "physician_specialty": 19, "nature_of_payment": 34, "physician_name_first": 6,
        "physician_name_middle": 7, "physician_name_last": 8, "physician_name_suffix": 9,
        "recipient_city": 12, "recipient_state": 13, "recipient_zip": 14, "recipient_country": 15,
    }
    assert MIN_FIELDS == 46


def test_sample_row(spark):
    row = parse_one(spark, SAMPLE)
    assert row._id == "77310_02/09/2015_5512"
    assert (row.amount, row.payer, row.recipient_zip) == (1250.75, "Beryl & Sons, Ltd", "04321-0007")
    assert (row.physician_specialty, row.recipient_state) == ("Made Up Trade|Bench Work", None)
    assert list(row.asDict()) == PAYMENT_COLUMNS


def test_quoted_comma_and_doubled_quotes(spark):
    row = parse_one(
        spark, line(physician_name_last='"B, Jr"', payer='"x ""q"" y"', amount="1.5")
    )
    assert (row.physician_name_last, row.payer, row.amount) == ("B, Jr", "x q y", 1.5)


def test_quoted_amount_counts_as_zero(spark):
    text = line(amount='"12.5"')
    assert parse_one(spark, text).amount == 0.0
    assert parse_one(spark, text, strip_amount_quotes=True).amount == 12.5


def test_thousands_separator_is_not_a_number(spark):
    assert parse_one(spark, line(amount='"1,000"'), strip_amount_quotes=True).amount == 0.0


def test_blanks(spark):
    text = line(date_payment="02/17/2016", record_id="7", amount="1")
    assert parse_one(spark, text).physician_specialty is None
    raw = parse_one(spark, text, raw_blanks=True)
    assert raw.physician_specialty == "" and raw._id == "_02/17/2016_7"


def test_short_lines_are_rejected_not_failed(spark):
    frame = lines(spark, "short,line", "", ",".join(["x"] * 45), ",".join(["x"] * 46), SAMPLE)
    assert etl.parse_lines(frame).count() == 2
    rejects = {(r.value, r.n_fields) for r in etl.rejected_lines(frame).collect()}
    assert {n for _, n in rejects} == {2, 1, 45}


def test_blank_tail_is_kept(spark):
    whole = line(physician_id="5", record_id="9", amount="2")
    cut = ",".join(whole.split(",")[:46])
    a, b = etl.parse_lines(lines(spark, whole, cut)).collect()
    assert a == b


AMOUNTS = {
    "12.5": 12.5, "abc": 0.0, "": 0.0, "1d": 1.0, " 1 ": 1.0, "0x1p3": 8.0, "-3": -3.0,
    "1e3": 1000.0, "NaN": math.nan, "nan": 0.0, "Infinity": math.inf, "-Infinity": -math.inf,
    "inf": 0.0, "+inf": 0.0, "INFINITY": 0.0, "1e999": math.inf, None: 0.0,
}


def test_lenient_amounts(spark):
    frame = spark.createDataFrame([(t,) for t in AMOUNTS], "t string")
    found = {r.t: r.n for r in frame.select("t", f.lenient_amount(F.col("t")).alias("n")).collect()}
    for text, number in AMOUNTS.items():
        assert found[text] == number or (math.isnan(found[text]) and math.isnan(number)), text


@pytest.mark.parametrize("text", ["abc", "", None, "1,000"])
def test_strict_amount_fails(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(PySparkException):
        frame.select(f.strict_amount(F.col("t"))).collect()


def test_strict_amount(spark):
    frame = spark.createDataFrame([("12.5",)], "t string")
    assert frame.select(f.strict_amount(F.col("t"))).first()[0] == 12.5


def test_key_with_missing_part(spark):
    frame = spark.createDataFrame([(None, "02/17/2016", "1")], "p string, d string, r string")
    key = f.payment_key(F.col("p"), F.col("d"), F.col("r"))
    assert frame.select(key).first()[0] == "_02/17/2016_1"


def test_standard_mode_unquotes_the_amount(spark):
    text = line(physician_id="5", date_payment="02/17/2016", record_id="9", amount='"12.5"',
                payer='"x ""q"" y"')
    row = etl.parse_standard_csv(lines(spark, text)).collect()[0]
    assert (row._id, row.amount, row.payer) == ("5_02/17/2016_9", 12.5, 'x "q" y')


ODD_LINES = [
    'a,b"c,d', '"', ',', ',,', '"a,b",c', 'a"b,c"d,e', '"a","b,c,"', '""",', 'x"', '",",",', "",
    "a\u0001b,c", '"\u0001,",\u0001',
]


def check_split(spark, texts):
    frame = lines(spark, *texts).select("value", f.split_fields(F.col("value")).alias("s"))
    for row in frame.collect():
        assert row.s == expected_split(row.value), row.value


def check_pick(spark, texts, positions):
    picked = f.pick_fields(F.col("value"), positions).alias("p")
    for row in lines(spark, *texts).select("value", picked).collect():
        whole = expected_split(row.value)
        if len(whole) > positions[-1]:
            assert row.p == [whole[i] for i in positions], row.value
        else:
            assert len(row.p) == 1, row.value


def test_split_of_odd_lines(spark):
    check_split(spark, ODD_LINES)
    check_pick(spark, ODD_LINES, [0, 2])
    check_pick(spark, ODD_LINES, [1, 3])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet='a",\u0001\n', max_size=14), min_size=30, max_size=60))
def test_split_equals_the_rule(spark, texts):
    check_split(spark, texts)
    check_pick(spark, texts, [1, 2, 4])


def test_many_quotes_do_not_exhaust_the_stack(spark):
    text = '"",' * 40 + '""' * 50_000 + ',"x"' * 10
    assert etl.parse_lines(lines(spark, text)).count() == 1
    assert etl.rejected_lines(lines(spark, '""' * 50_000)).first().n_fields == 1


ODD_LINES = [
    SAMPLE, line(physician_specialty="s"), line(), "", ",", ",,,", '"', 'a,"b', 'a,b,"c,d,', '",",,', ",,\n,",
    'a,"b,c",,d', '"a""b",,"', "a,b,,", "a,b,", "a,b", '"x,y",z,,\n"q', ",".join(["x"] * 46), ",".join(["x"] * 45) + '"',
]


def test_least_fields_and_cuts_are_those_of_the_split(spark):
    signs, random = 'ab,,,"" \n', Random(3)
    texts = ODD_LINES + ["".join(random.choices(signs, k=random.randint(0, 30))) for _ in range(2000)]
    value, split = F.col("value"), f.split_fields(F.col("value"))
    for place in (1, 2, 5, 19):
        short = F.when(F.get(split, F.lit(place)) != "", value).otherwise(
            F.array_join(F.slice(split, 1, place + 1), ",")
        )
        wrong = lines(spark, *texts).where(
            (f.splits_into(value, place + 1) != (F.size(split) >= place + 1))
            | (f.cut_where_blank(value, place) != short)
        )
        assert wrong.collect() == []


def test_only_short_lines_are_split_for_the_rejects(spark):
    frame = etl.rejected_lines(lines(spark, *ODD_LINES, None))
    split = etl.split_lines(lines(spark, *ODD_LINES)).select("value", F.size("_fields").alias("n"))
    assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, split.where(F.col("n") < MIN_FIELDS).collect()))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("RLIKE")
