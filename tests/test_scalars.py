"""Column functions on hand-made edge rows."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ledgerlake.functions import scalars as s
from pyspark.sql import functions as F


def apply(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*(c().alias(n) for n, c in columns.items())).collect()]


def test_money(spark):
    texts = [None, "", "$-1,234.50", "abc", "$0.005", "12", "$1,2,3", " $7.1 ", "$99999999999999999.00", "$-0.00", "USD 3"]
    got = apply(spark, [(t,) for t in texts], "t string", m=lambda: s.money("t", 15, 2))
    want = [None, None, D("-1234.50"), None, D("0.01"), D("12.00"), D("123.00"), D("7.10"), None, D("0.00"), None]
    assert [g[0] for g in got] == want


def test_credit_limit_reads_more_than_money(spark):
    texts = [None, "", "USD 1,200.50", "$-5", "1-2", "n/a", "$24,295.00"]
    got = apply(
        spark, [(t,) for t in texts], "t string", a=lambda: s.credit_limit("t"), b=lambda: s.money("t", 12, 2)
    )
    assert [g[0] for g in got] == [None, None, D("1200.50"), D("-5.00"), None, None, D("24295.00")]
    assert [g[1] for g in got] == [None, None, None, D("-5.00"), None, None, D("24295.00")]


def test_month_and_year(spark):
    texts = [None, "", "1/2020", "12/1900", "13/2020", "0/2020", "1/1899", "01/2100", "1/2101", "1/20", "2020/1", "1-2020"]
    got = apply(spark, [(t,) for t in texts], "t string", m=lambda: s.month_of("t"), y=lambda: s.year_of("t"))
    assert got == [
        (None, None), (None, None), (1, 2020), (12, 1900), (None, 2020), (None, 2020), (1, None), (1, 2100),
        (1, None), (None, None), (None, None), (None, None),
    ]


def test_expired_is_three_valued(spark):
    rows = [(2024, 6), (2024, 5), (2023, 12), (2025, 1), (2024, 7), (None, 1), (2000, None)]
    got = apply(spark, rows, "y int, m int", e=lambda: s.expired("y", "m", "2024-06-15"))
    assert [g[0] for g in got] == [False, True, True, False, False, None, None]


def test_bands_put_unknown_on_top(spark):
    got = apply(spark, [(a,) for a in (None, 17, 18, 34, 35, 49, 50, 64, 65)], "a int", g=lambda: s.age_group("a"))
    assert [g[0] for g in got] == ["65+", "Under 18", "18-34", "18-34", "35-49", "35-49", "50-64", "50-64", "65+"]
    money = [None, D("29999.99"), D("30000"), D("69999.99"), D("70000"), D("-1")]
    got = apply(spark, [(m,) for m in money], "m decimal(15,2)", g=lambda: s.income_group("m"))
    assert [g[0] for g in got] == [
        "High Income", "Low Income", "Middle Income", "Middle Income", "High Income", "Low Income",
    ]


def test_flags_are_never_null(spark):
    texts = [None, "", "Yes", "yes", "YES", "No"]
    got = apply(
        spark,
        [(t,) for t in texts],
        "t string",
        chip=lambda: s.chip_flag("t"),
        web=lambda: s.dark_web_flag("t"),
        fraud=lambda: s.fraud_flag("t"),
        lenient=lambda: s.fraud_flag("t", "Yes"),
        error=lambda: s.error_flag("t"),
    )
    assert got == [
        (False, False, False, False, False),
        (False, False, False, False, True),
        (True, True, False, True, True),
        (True, False, False, False, True),
        (False, False, True, False, True),
        (False, False, False, False, True),
    ]


def test_spending_ratio(spark):
    rows = [
        (D("50"), D("200")), (D("-1"), D("3")), (D("1"), D("0")), (D("1"), D("-5")), (D("1"), None), (None, D("5")),
        (D("99999999999999"), D("0.01")), (D("0.00005"), D("1")),
    ]
    got = apply(spark, rows, "a decimal(18,4), l decimal(12,2)", r=lambda: s.spending_ratio("a", "l"))
    assert [g[0] for g in got] == [
        D("0.2500"), D("-0.3333"), D("0.0000"), D("0.0000"), D("0.0000"), None, None, D("0.0001"),
    ]


def test_typed_text(spark):
    rows = [(None,), ("",), ("7",), ("x",), ("2020-02-30",), ("2020-02-28 13:05:00",)]
    got = apply(spark, rows, "t string", n=lambda: s.typed("t", "int"), m=lambda: s.typed("t", "timestamp"))
    assert [g[0] for g in got] == [None, None, 7, None, None, None]
    assert got[5][1] == dt.datetime(2020, 2, 28, 13, 5) and got[4][1] is None


def test_json(spark):
    rows = [('{"op":"c","ts_ms":17}',), ("broken",), (None,), ('{"op":null,"ts_ms":"x"}',), ('{"ts_ms":1.5}',)]
    got = apply(spark, rows, "j string", op=lambda: s.json_text("j", "$.op"), ts=lambda: s.json_long("j", "$.ts_ms"))
    assert got[:4] == [("c", 17), (None, None), (None, None), (None, None)]


def test_whole_units_cut_towards_zero(spark):
    got = apply(spark, [(D("5.99"),), (D("-5.99"),), (None,)], "d decimal(15,2)", w=lambda: s.whole_units("d"))
    assert [g[0] for g in got] == [5, -5, None]


def test_base_name_and_parts(spark):
    rows = [("file:///a/b/c.json", dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2024, 2, 29, 23))]
    got = apply(
        spark,
        rows,
        "p string, t timestamp, u timestamp",
        n=lambda: s.base_name("p"),
        m=lambda: s.month_start("t"),
        a=lambda: s.age_at(F.col("t"), F.lit(1980)),
        z=lambda: s.or_zero(F.lit(None).cast("int")),
    )
    assert got == [("c.json", dt.date(2024, 2, 1), 44, 0)]


def test_surrogate_key_is_stable(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    first = df.select(s.surrogate_key("a", "b").alias("k"))
    again = df.repartition(7).select(s.surrogate_key("a", "b").alias("k"))
    assert first.distinct().count() == 100
    assert first.exceptAll(again).isEmpty()


@pytest.mark.parametrize("name", ["total_txn", "total_txn_pos", "prev_1d_cnt", "error_txn_cnt"])
def test_count_columns(name):
    from ledgerlake.schemas import is_count, widened

    assert is_count(name) and not is_count("total_txn_amt") and not is_count("peak_hour")
    assert widened({name: "int", "peak_hour": "int"}) == {name: "bigint", "peak_hour": "int"}
