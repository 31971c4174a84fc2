"""Gold summaries against row-by-row computation, for windows that cut months and days."""

import datetime as dt
from decimal import Decimal

import facts
import pytest

from ledgerlake.operators.history import first_seen
from ledgerlake.plans import latest, market, merchant, user
from ledgerlake.schemas import GOLD_MARKET_DAILY, GOLD_MERCHANT_MONTHLY, GOLD_USER_DETAIL

WINDOWS = [
    (dt.date(2019, 1, 1), dt.date(2019, 12, 31)),
    (dt.date(2019, 2, 10), dt.date(2019, 4, 13)),
    (dt.date(2019, 3, 1), dt.date(2019, 3, 31)),
    (dt.date(2019, 4, 2), dt.date(2019, 4, 2)),
]


@pytest.fixture(scope="module", params=[11, 12])
def rows(request):
    return facts.random_fact(request.param)


def keyed(df, *key):
    records = [r.asDict() for r in df.collect()]
    found = {}
    for r in records:
        k = tuple(r[c] for c in key) if len(key) > 1 else r[key[0]]
        assert k not in found
        found[k] = r
    return found


def check(got, want):
    assert set(got) == set(want)
    for key, record in want.items():
        assert {name: got[key][name] for name in record} == record, key


@pytest.mark.parametrize("start,end", WINDOWS)
def test_market(spark, rows, start, end):
    df = market.market_daily_summary(facts.frame(spark, rows), start, end)
    assert dict(df.dtypes) == GOLD_MARKET_DAILY
    check(keyed(df, "period_date"), facts.market_daily(rows, start, end))


@pytest.mark.parametrize("start,end", WINDOWS)
def test_merchant(spark, rows, start, end):
    df = merchant.merchant_monthly_performance(facts.frame(spark, rows), start, end)
    assert dict(df.dtypes) == GOLD_MERCHANT_MONTHLY
    check(keyed(df, "merchant_id", "period_month"), facts.merchant_monthly(rows, start, end))


def test_day_windows_add_up_to_one_pass(spark, rows):
    fact = facts.frame(spark, rows)
    whole = market.market_daily_summary(fact, *WINDOWS[1]).drop("updated_at")
    first, last = WINDOWS[1]
    parts = None
    while first <= last:
        stop = min(first + dt.timedelta(days=27), last)
        part = market.market_daily_summary(fact, first, stop).drop("updated_at")
        parts = part if parts is None else parts.unionByName(part)
        first = stop + dt.timedelta(days=1)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_kept_first_dates_give_the_same(spark, rows):
    fact, window = facts.frame(spark, rows), WINDOWS[1]
    kept = first_seen(fact, "client_id", "txn_date_time")
    got = market.new_clients(fact, *window, first_dates=kept)
    assert sorted(got.collect()) == sorted(market.new_clients(fact, *window).collect())


def test_kept_pairs_give_the_same(spark, rows):
    fact, window = facts.frame(spark, rows), WINDOWS[2]
    kept = merchant.pairs_before(fact, window[0])
    assert not kept.isEmpty()
    got = merchant.merchant_monthly_performance(fact, *window, earlier=kept)
    check(keyed(got, "merchant_id", "period_month"), facts.merchant_monthly(rows, *window))


def test_wide_counts(spark, rows):
    df = market.market_daily_summary(facts.frame(spark, rows), *WINDOWS[1], wide=True)
    kinds = dict(df.dtypes)
    assert kinds["txn_total_cnt"] == "bigint" and kinds["peak_hour"] == "int"


USERS = (
    "client_id int, client_key bigint, birth_year int, birth_month int, retirement_age int, gender string, "
    "per_capita_income decimal(15,2), yearly_income decimal(15,2), total_debt decimal(15,2), credit_score int, "
    "is_current boolean"
)


def test_user(spark, rows):
    people = [
        (k, k * 10, None if k == 2 else 1980, 5, 65, "Male", Decimal("5.99"), None, Decimal("-7.50"), 700, True)
        for k in [1, 2, 3, 99]
    ] + [(1, 11, 1980, 5, 65, "Male", None, None, None, 1, False)]
    df = user.user_detail(spark.createDataFrame(people, USERS), facts.frame(spark, rows), "2024-06-15")
    assert dict(df.dtypes) == GOLD_USER_DETAIL
    got = keyed(df, "client_id")
    lifetime = facts.user_lifetime(rows)
    assert set(got) == {1, 2, 3, 99}
    check({k: got[k] for k in (1, 2, 3)}, {k: lifetime[k] for k in (1, 2, 3)})
    quiet = got[99]
    assert (quiet["total_txn"], quiet["total_txn_amt"], quiet["merchant_top_id"], quiet["lifetime_days"]) == (0, 0, 0, 0)
    assert quiet["lifetime_first_date"] is None
    assert (quiet["income_per_capita"], quiet["income_yearly"], quiet["debt_total"]) == (5, None, -7)
    assert (got[1]["age_current"], got[2]["age_current"]) == (44, None)


def test_latest_day(spark, rows):
    from pyspark.sql import functions as F

    brand = F.when(F.col("client_id") > 3, "VISA")
    fact = facts.frame(spark, rows).withColumns(
        {"card_brand": brand, "card_type": F.lit("DEBIT"), "txn_use_chip": F.col("is_error")}
    )
    last = max(map(facts.day, rows))
    want = {}
    for r in rows:
        if facts.day(r) == last:
            key = ("VISA" if (r.client_id or 0) > 3 else None, r.is_error)
            amount, n = want.get(key, (None, 0))
            if r.txn_amount is not None:
                amount = (amount or 0) + r.txn_amount
            want[key] = (amount, n + (r.transaction_id is not None))
    got = latest.latest_day_summary(fact).collect()
    assert {(r.card_brand, r.txn_use_chip): (r.total_amount, r.total_txn) for r in got} == want
    assert {r.txn_date for r in got} == {last}


def test_mean_is_rounded_from_eight_decimals(spark):
    """The mean 0.00499975 is 0.00; rounding to six decimals on the way would make it 0.01."""
    values = [Decimal("0.0050")] * 399 + [Decimal("0.0049")]
    rows = [
        facts.Row(
            transaction_id=i, client_id=1, merchant_id=1, merchant_city="x", merchant_state="s", mcc=1,
            txn_amount=v, txn_date_time=dt.datetime(2019, 1, 3), is_fraud=False, is_error=False,
        )
        for i, v in enumerate(values)
    ]
    got = market.market_daily_summary(facts.frame(spark, rows), "2019-01-01", "2019-01-31").first()
    want = facts.frame(spark, rows).selectExpr("cast(avg(txn_amount) as decimal(12,2))").first()[0]
    assert got.txn_avg_amt == want == Decimal("0.00")


def test_gap_month_is_not_the_previous_month(spark):
    rows = [
        facts.Row(
            transaction_id=i, client_id=1, merchant_id=1, merchant_city="x", merchant_state="s", mcc=1,
            txn_amount=Decimal("5.0000"), txn_date_time=dt.datetime(2019, m, 3), is_fraud=False, is_error=False,
        )
        for i, m in enumerate([1, 2, 4])
    ]
    got = merchant.merchant_monthly_performance(facts.frame(spark, rows), "2019-01-01", "2019-04-30")
    by_month = {r.month: (r.prev_txn_total_cnt, r.new_client_cnt, r.returning_client_cnt) for r in got.collect()}
    assert by_month == {1: (0, 1, 0), 2: (1, 0, 1), 4: (0, 0, 1)}
