"""LIKE patterns, JSON conditions and finds."""

import pytest
from pyspark.sql import functions as F

from paystrata.functions.patterns import condition, february_exact, february_wildcard, matches
from paystrata.operators.find import find, find_count
from paystrata.operators import queries as q

KEYS = ["1_02/12/2016_9", "1_03/02/2016_9", "_02/02/2016_9", "98485_01/01/2016_1", "984851_01/01/2016_1"]


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(k, k.split("_")[0], float(n)) for n, k in enumerate(KEYS)]
    return spark.createDataFrame(rows, "_id string, physician_id string, amount double")


def keys(frame):
    return sorted(r._id for r in frame.collect())


def test_february_wildcard_takes_day_two_as_well(keyed):
    assert keys(keyed.filter(february_wildcard(F.col("_id")))) == sorted(KEYS[:3])


def test_february_exact(keyed):
    exact = keyed.filter(february_exact(F.col("_id")))
    assert keys(exact) == sorted([KEYS[0], KEYS[2]])
    assert exact.exceptAll(q.in_february(keyed)).count() == 0


def test_prefix_against_exact_physician(keyed):
    assert keys(q.by_id_prefix(keyed, "98485")) == sorted(KEYS[3:])
    assert keys(q.by_physician(keyed, "98485")) == [KEYS[3]]


@pytest.mark.parametrize("pattern, texts", [
    ("a%", {"a", "ab", "a%b", "a_b", "a#b"}),
    ("%b", {"ab", "a%b", "a_b", "a#b", "xb"}),
    ("%#%", {"a#b"}),
    ("a[_]b", {"a_b"}),
    ("a[%]%", {"a%b"}),
    ("a_b", {"a%b", "a_b", "a#b"}),
    ("ab", {"ab"}),
    ("%", {"a", "ab", "a%b", "a_b", "a#b", "xb", ""}),
    ("", {""}),
    ("_", {"a"}),
])
def test_matches(spark, pattern, texts):
    everything = ["a", "ab", "a%b", "a_b", "a#b", "xb", ""]
    frame = spark.createDataFrame([(t,) for t in everything], "t string")
    assert {r.t for r in frame.filter(matches(F.col("t"), pattern)).collect()} == texts


def test_longer_class_is_refused():
    with pytest.raises(ValueError):
        matches(F.col("t"), "a[bc]")


def test_condition(keyed):
    both = {"$ge": {"amount": 1}, "$like": {"_id": "%[_]02/%"}}
    assert keys(keyed.filter(condition(both))) == [KEYS[2]]
    assert keys(find(keyed, '{"$eq": {"physician_id": "1"}}', "_id, amount")) == sorted(KEYS[:2])
    assert find_count(keyed, {"$ge": {"amount": 3}}).first().n_found == 2
    assert find(keyed, limit=2, order_by=["_id"]).count() == 2


@pytest.mark.parametrize("where", [{}, {"$gt": {"amount": 1}}])
def test_bad_condition(where):
    with pytest.raises(ValueError):
        condition(where)
