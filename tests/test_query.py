"""Conditions against a row-by-row reading of the same rules, and the query builder."""

import itertools
import operator
from decimal import Decimal as D
from decimal import InvalidOperation

import pytest
from pyspark.sql import functions as F

from tests.rows import frame, records, row
from tradelake.operators.predicates import FieldTest, QueryError
from tradelake.operators.query import Query

AMOUNTS = [None, "0", "0.1", "5", "5.5", "12345.678901234"]


@pytest.fixture(scope="module")
def t(spark):
    rows = [
        row(1 + i % 3, i % 2, 2018 + i % 4, "XM"[i % 2], ["TOTAL", "01", "0101"][i % 3], i,
            trade_value_fob_value=None if v is None else D(v),
            partner2_code=[None, 0, 7][i % 3], is_original_classification=[None, True, False][i % 3])
        for i, v in enumerate(AMOUNTS * 2)
    ]
    return frame(spark, rows).cache()


OPS = {"eq": operator.eq, "ne": operator.ne, "lt": operator.lt, "le": operator.le,
       "gt": operator.gt, "ge": operator.ge}


def by_hand(op, actual, expected):
    try:
        return bool(OPS[op](actual, expected))
    except (TypeError, InvalidOperation):
        return False


CASES = {
    "fob_value": [None, 5, 5.5, 0.1, D("0.1"), D("12345.678901234"), "5", True, False,
                  float("inf"), float("-inf"), float("nan"), 10**30, -(10**30), -0.5],
    "reporter_code": [None, 1, 2.0, 2.5, D("2"), "2", True, 10**12, -(10**12)],
    "partner2_code": [None, 0, 7, "7", False],
    "period": [None, "2019", 2019, "", "20190"],
    "is_original_classification": [None, True, False, 1, 0, 0.5, "True"],
}


@pytest.mark.parametrize("field", CASES)
def test_comparisons_follow_two_valued_logic(t, field):
    tests = {
        f"c{i}": FieldTest(field, op, value)
        for i, (op, value) in enumerate(itertools.product(OPS, CASES[field]))
    }
    column = {"fob_value": "trade_value_fob_value"}.get(field, field)
    marked = t.select(
        F.col(column).alias("actual"),
        *[c.column(t).alias(n) for n, c in tests.items()],
        *[(~c).column(t).alias(f"not_{n}") for n, c in tests.items()],
    )
    for r in records(marked):
        for name, test in tests.items():
            want = by_hand(test.operator, r["actual"], test.value)
            assert r[name] is want, (test, r["actual"])
            assert r[f"not_{name}"] is (not want), (test, r["actual"])


@pytest.mark.parametrize(
    "field, values",
    [
        ("reporter_code", [1, 2.0, "3", None]),
        ("reporter_code", []),
        ("fob_value", [5, 0.1, None, "x"]),
        ("period", ["2019", 2020]),
        ("partner2_code", {0, None}),
        ("is_original_classification", [1, None]),
    ],
)
def test_membership(t, field, values):
    column = {"fob_value": "trade_value_fob_value"}.get(field, field)
    made = t.select(
        F.col(column).alias("actual"),
        FieldTest(field, "in", values).column(t).alias("yes"),
        FieldTest(field, "not_in", values).column(t).alias("no"),
    )
    for r in records(made):
        assert r["yes"] is (r["actual"] in values) and r["no"] is (r["actual"] not in values)


def test_errors(t):
    for bad in (
        lambda: FieldTest("weight", "eq", 1).column(t),
        lambda: FieldTest("", "eq", 1),
        lambda: FieldTest("period", "like", "2"),
        lambda: FieldTest("period", "in", "2019"),
        lambda: Query(t).filter(),
        lambda: Query(t).exclude(),
        lambda: Query(t).filter(FieldTest("period", "eq", "2019"), reporter_code=1),
        lambda: Query(t).limit(-1),
        lambda: Query(t).offset("3"),
        lambda: Query(t).sort(),
        lambda: Query(t).group_by("weight"),
        lambda: Query(t).summarize("period"),
    ):
        with pytest.raises(QueryError):
            bad()


def seqs(q):
    return [r["_seq"] for r in q.frame().collect()]


def test_order_steps(t):
    q = Query(t)
    assert seqs(q.sort("primary_value").limit(3)) == [0, 1, 2]
    assert seqs(q.sort("primary_value", descending=True).limit(2)) == [11, 10]
    # Equal keys keep reading order, also when descending.
    assert seqs(q.sort("flow_code").limit(3)) == [1, 3, 5]
    assert seqs(q.sort("flow_code", descending=True).limit(3)) == [0, 2, 4]
    assert seqs(q.sort("flow_code").reverse().limit(3)) == [10, 8, 6]
    assert seqs(q.reverse().reverse().limit(2)) == [11, 10]
    assert seqs(q.limit(2)) == [0, 1] and seqs(q.limit(0)) == []
    assert seqs(q.offset(10)) == [10, 11]
    assert seqs(q.sort("primary_value").offset(9).limit(2)) == [9, 10]
    assert seqs(q.sort("primary_value").reverse().offset(9)) == [2, 1, 0]
    assert seqs(q.offset(3).offset(None).limit(1)) == [0]


def test_offset_keeps_equal_rows(spark):
    same = frame(spark, [row(1, 0, 2020, "X", "27", 5)] * 7, numbered=False)
    assert Query(same).sort("primary_value").offset(3).count() == 4


def test_grouping_comes_after_the_limit(t):
    q = Query(t).sort("primary_value").limit(5).group_by("flow.flow_code")
    assert records(q.groups()) == [
        {"flow_code": "M", "record_count": 2},
        {"flow_code": "X", "record_count": 3},
    ]
    assert [r["_seq"] for r in q.members().collect()] == [1, 3, 0, 2, 4]
    assert Query(t).groups().count() == 0


def test_filter_and_exclude(t):
    both = Query(t).filter(reporter_code=1, flow_code="X").count()
    rest = Query(t).exclude(reporter_code=1, flow_code="X").count()
    assert both and both + rest == t.count()
    test = FieldTest("fob_value", "gt", 1)
    assert Query(t).exclude(test).count() == Query(t).filter(~test).count()
    assert Query(t).exclude(test, reporter_code=99).count() == Query(t).exclude(test).count()
    assert Query(t).filter(F.col("reporter_code") == 1).count() == 4


def test_summaries(t):
    (s,) = records(Query(t).filter(reporter_code=99).summarize("fob_value"))
    assert s == {"sum": None, "count": 0, "average": None, "minimum": None, "maximum": None}
    rows = records(Query(t).group_by("flow_code").summarize("primary_value"))
    assert rows[0]["flow_code"] == "M" and rows[0]["sum"] == 36 and rows[0]["average"] == 6.0
    (a,) = records(Query(t).aggregate(n=("count", "fob_value"), top=("maximum", "fob_value")))
    assert a == {"n": 10, "top": D("12345.678901234")}
