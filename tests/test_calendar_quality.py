"""Date windows, window filters and constraint reports."""

import datetime as dt

import pytest

from ledgerlake.functions.calendar import date_window_filter, fixed_windows, month_windows, widen_to_months
from ledgerlake.operators import quality
from ledgerlake.operators.history import calendar_lags
from ledgerlake.operators.top import top_per_group
from pyspark.sql import functions as F

D = dt.date


def bounds(spark, *pairs):
    return spark.createDataFrame(list(pairs), "start_date date, end_date date")


def windows_by_hand(start, end, days):
    out = []
    while start <= end:
        stop = min(start + dt.timedelta(days - 1), end)
        out.append((start, stop))
        start = stop + dt.timedelta(1)
    return out


@pytest.mark.parametrize(
    "start,end,days",
    [
        (D(2019, 2, 1), D(2019, 3, 7), 7),
        (D(2019, 2, 1), D(2019, 2, 1), 7),
        (D(2019, 2, 1), D(2019, 2, 7), 7),
        (D(2020, 2, 27), D(2020, 3, 2), 1),
        (D(2020, 3, 2), D(2020, 3, 1), 3),
    ],
)
def test_fixed_windows(spark, start, end, days):
    got = [tuple(r) for r in fixed_windows(bounds(spark, (start, end)), days).orderBy("window_start").collect()]
    assert got == windows_by_hand(start, end, days)


def test_month_windows(spark):
    got = [tuple(r) for r in month_windows(bounds(spark, (D(2019, 11, 20), D(2020, 2, 10)))).collect()]
    assert got == [
        (D(2019, 11, 1), D(2019, 11, 30)), (D(2019, 12, 1), D(2019, 12, 31)),
        (D(2020, 1, 1), D(2020, 1, 31)), (D(2020, 2, 1), D(2020, 2, 10)),
    ]
    assert month_windows(bounds(spark, (D(2020, 1, 2), D(2020, 1, 1)))).isEmpty()


def test_widen_to_months():
    assert widen_to_months("2019-02-10", "2019-12-05") == (D(2019, 2, 1), D(2019, 12, 31))
    assert widen_to_months("2020-02-29", "2020-02-29") == (D(2020, 2, 1), D(2020, 2, 29))


MOMENTS = [
    dt.datetime(2018, 12, 31, 23, 59, 59), dt.datetime(2019, 1, 1), dt.datetime(2019, 1, 31, 23, 59, 59, 999999),
    dt.datetime(2019, 2, 1), dt.datetime(2020, 1, 15), None,
]


def parted(spark, path):
    df = spark.createDataFrame([(m,) for m in MOMENTS], "ts timestamp")
    df = df.withColumns({"y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts")})
    df.write.partitionBy("y", "m", "d").parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("parts", [(), ("y",), ("y", "m"), ("y", "m", "d")])
@pytest.mark.parametrize("start,end", [("2019-01-01", "2019-01-31"), (None, "2019-01-01"), ("2018-12-31", "2020-01-15")])
def test_date_window_filter(spark, tmp_path, parts, start, end):
    got = date_window_filter(parted(spark, tmp_path / "t"), "ts", start, end, parts)
    want = {
        m for m in MOMENTS if m and (start is None or str(m.date()) >= start) and str(m.date()) <= end
    }
    assert {r.ts for r in got.collect()} == want


def test_window_filter_reaches_scan_and_partitions(spark, tmp_path):
    df = date_window_filter(parted(spark, tmp_path / "t"), "ts", "2019-01-01", "2019-01-31", ("y", "m", "d"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    scan = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x][0]
    assert "GreaterThanOrEqual(ts,2019-01-01" in scan and "LessThan(ts,2019-02-01" in scan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    partition_filters = scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "20190131" in partition_filters and "20190101" in partition_filters


def test_window_audit(spark):
    df = spark.createDataFrame([(m,) for m in MOMENTS], "ts timestamp")
    got = quality.window_audit(df, "ts", "2019-01-01", "2019-02-03", 7)
    assert {tuple(r) for r in got.collect()} == {
        (D(2019, 1, 1), D(2019, 1, 7), 1), (D(2019, 1, 29), D(2019, 2, 3), 2), (None, None, 3),
    }


def test_repeated_keys_and_orphans(spark):
    child = spark.createDataFrame([(1, 5), (1, 6), (None, 7), (2, None), (3, 9), (4, 9)], "a int, b int")
    parent = spark.createDataFrame([(5,), (6,), (6,)], "id int")
    assert {tuple(r) for r in quality.repeated_keys(child, ["a"]).collect()} == {(1, 2), (None, 1)}
    assert {tuple(r) for r in quality.repeated_keys(child, ["a", "b"]).collect()} == {(None, 7, 1), (2, None, 1)}
    assert {tuple(r) for r in quality.orphans(child, "b", parent, "id").collect()} == {(7, 1), (9, 2)}


def test_rules_count_false_only(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "a int")
    got = quality.rule_violations(df, {"positive": F.col("a") > 0, "present": F.col("a").isNotNull()})
    assert {tuple(r) for r in got.collect()} == {("positive", 1), ("present", 1)}


def test_top_breaks_ties_by_smallest_key_and_unknown_last(spark):
    rows = [("t", 3), ("t", 2), ("t", None), ("n", None), ("n", None), ("n", 1), (None, 8), ("z", 0), ("z", -1)]
    got = top_per_group(spark.createDataFrame(rows, "g string, k int"), ["g"], "k", F.count(F.lit(1)), ("top", "n"))
    assert {tuple(r) for r in got.collect()} == {("t", 2, 1), ("n", None, 2), (None, 8, 1), ("z", -1, 1)}


def test_calendar_lag_is_not_the_previous_row(spark):
    rows = [(D(2019, 1, 1), 1), (D(2019, 1, 2), 2), (D(2019, 1, 4), 4), (D(2019, 1, 8), None)]
    got = calendar_lags(spark.createDataFrame(rows, "day date, v int"), "day", (1, 7), {"v": "v_{}"})
    assert {tuple(r) for r in got.collect()} == {
        (D(2019, 1, 1), 1, None, None), (D(2019, 1, 2), 2, 1, None), (D(2019, 1, 4), 4, None, None),
        (D(2019, 1, 8), None, None, 1),
    }


def test_shuffle_size_follows_the_input():
    from ledgerlake.settings import initial_partitions

    assert initial_partitions(10**9) == 200
    assert initial_partitions(10**12) == 932
    assert initial_partitions(100 * 10**12) == 50_000
