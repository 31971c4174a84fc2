"""Silver and detail: invariants, odd keys, backfill, and the shape of the plans."""

import contextlib
import datetime as dt
import re
from decimal import Decimal

import facts
import pytest

from ledgerlake import schemas
from ledgerlake.checks.inputs import Lake
from ledgerlake.checks.queries import QUERIES, Layers
from ledgerlake.plans import market, merchant, silver, user
from ledgerlake.plans.detail import transaction_detail
from ledgerlake.sinks import tables
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def lake(spark):
    return Layers(spark, SF_DIR)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_schemas(lake):
    assert dict(lake.silver_users.dtypes) == schemas.SILVER_USERS
    assert dict(lake.silver_cards.dtypes) == schemas.SILVER_CARDS
    assert dict(lake.silver_transactions.dtypes) == schemas.SILVER_TRANSACTIONS
    assert dict(lake.detail.dtypes) == schemas.GOLD_TRANSACTION_DETAIL


def test_joins_keep_every_transaction(lake):
    n = lake.transactions.count()
    assert lake.silver_transactions.count() == n == lake.detail.count()


def test_daily_totals_add_up_to_the_fact(lake):
    days = market.daily_totals(lake.detail)
    want = lake.detail.agg(F.sum("txn_amount"), F.count("transaction_id")).first()
    assert tuple(days.agg(F.sum("txn_total_amt"), F.sum("txn_total_cnt")).first()) == tuple(want)


def small_detail(spark, transactions, labels, codes):
    users = spark.createDataFrame(
        [(10, 1, 1990, "a"), (11, 1, 1991, "b"), (None, 2, 1970, "c")],
        "client_key bigint, client_id int, birth_year int, address string",
    ).withColumns({c: F.lit(1) for c in ("latitude", "longitude", "credit_score", "num_credit_cards")})
    cards = spark.createDataFrame(
        [(20, 5, "V", Decimal("100.00"), "Yes"), (21, 6, "M", None, None)],
        "card_key bigint, card_id int, card_brand string, credit_limit decimal(12,2), card_on_dark_web string",
    ).withColumns({"card_type": F.lit("D"), "acct_open_year": F.lit(2000), "expires_year": F.lit(2030)})
    columns = "transaction_id int, client_id int, client_key bigint, card_id int, card_key bigint, amount decimal(18,4), mcc int"
    txns = spark.createDataFrame(transactions, columns).withColumns(
        {
            "date_time": F.lit(dt.datetime(2019, 5, 6, 7)),
            **{c: F.lit(None).cast("string") for c in ("merchant_city", "merchant_state", "zip")},
            "use_chip": F.lit(True), "is_error": F.lit(False), "merchant_id": F.lit(1),
            "year": F.lit(2019), "month": F.lit(5),
        }
    )
    return transaction_detail(
        txns, users, cards,
        spark.createDataFrame(codes, "mcc_code int, description string"),
        spark.createDataFrame(labels, "transaction_id int, is_fraud string"),
        "2019-01-01", "2019-12-31",
    )


def test_detail_key_rules(spark):
    got = small_detail(
        spark,
        [
            (1, 1, 11, 5, 20, Decimal("50"), 7),
            (2, 2, None, 6, 21, Decimal("50"), None),
            (3, 1, 99, None, None, None, 8),
        ],
        [(1, "YES"), (2, "Yes")],
        [(7, "seven")],
    )
    by_id = {r.transaction_id: r for r in got.collect()}
    one, two, three = by_id[1], by_id[2], by_id[3]
    assert (one.client_age, one.txn_spending_ratio, one.is_fraud, one.mcc_description) == (28, Decimal("0.5000"), True, "seven")
    assert one.card_on_dark_web is True and one.txn_hour == 7
    # A NULL key never matches, not even a NULL key.
    assert two.client_age is None and two.txn_spending_ratio == 0 and two.is_fraud is False
    assert two.card_brand == "M" and two.card_on_dark_web is False and two.mcc_description is None
    # The right client with a foreign key is no match either.
    assert three.client_age is None and three.card_brand is None and three.txn_amount is None


def test_repeated_labels_and_codes_multiply_rows(spark):
    got = small_detail(
        spark, [(1, 1, 10, 5, 20, Decimal("1"), 7)], [(1, "YES"), (1, "No")], [(7, "a"), (7, "b"), (7, "c")]
    )
    assert got.count() == 6


def test_window_filter_and_month_partition(lake):
    part = silver.silver_transactions(
        lake.transactions, lake.silver_users, lake.silver_cards, "1996-03-05", "1996-04-10"
    )
    want = lake.silver_transactions.where(F.to_date("date_time").between("1996-03-05", "1996-04-10"))
    clock = "updated_at"
    assert part.count() > 0
    assert part.drop(clock).exceptAll(want.drop(clock)).isEmpty()
    assert want.drop(clock).exceptAll(part.drop(clock)).isEmpty()


def test_window_by_window_backfill_equals_one_write(spark, tmp_path):
    """Merchant months rewritten one month at a time, one of them twice, against a single pass."""
    fact = facts.frame(spark, facts.random_fact(21, n=200))
    name = "backfill_merchants"
    tables.create_declared(spark, "gold.merchant_monthly_performance", name, str(tmp_path / "t"))
    try:
        months = [("2019-02-01", "2019-02-28"), ("2019-03-01", "2019-03-31"), ("2019-02-01", "2019-02-28")]
        for start, end in months:
            tables.replace_partitions(merchant.merchant_monthly_performance(fact, start, end), name, ["year", "month"])
        want = merchant.merchant_monthly_performance(fact, "2019-02-01", "2019-03-31").drop("updated_at")
        got = spark.table(name).drop("updated_at")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", plan)


def hot_transactions(spark, n=60_000):
    """A third of all rows belong to one client."""
    lake = Lake(spark, SF_DIR)
    base = lake.transactions.limit(1).drop("id", "client_id")
    rows = spark.range(0, n, 1, 8).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).cast("int").alias("client_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("zip_text"),
    )
    fixed = [
        F.lit(v).cast(schemas.BRONZE_TRANSACTIONS[k]).alias(k) for k, v in base.first().asDict().items() if k != "zip"
    ]
    return rows.select("id", "client_id", F.col("zip_text").alias("zip"), *fixed)


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
}


def test_hot_client_is_split_in_the_key_join(spark, lake):
    with settings(spark, **SKEW):
        df = silver.silver_transactions(hot_transactions(spark), lake.silver_users, lake.silver_cards)
        plan = final_plan(df)
        assert "skew=true" in plan
        assert df.count() == 60_000


def test_hot_load_is_split_when_versions_are_closed(spark):
    """One (id, load) holds a third of the rows; the join back splits it."""
    from ledgerlake.operators.versions import close_versions

    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int").alias("id"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.lit(dt.datetime(2020, 1, 1)).alias("load_at"),
    )
    with settings(spark, **SKEW):
        df = close_versions(rows, "id", "load_at")
        assert "skew=true" in final_plan(df)
        assert df.count() == 60_000
        assert df.where("id = -1 AND is_current").count() == 1


def test_summaries_combine_before_the_shuffle(spark):
    """Below every exchange stands a partial aggregate, or the union of two combined frames."""
    fact = facts.frame(spark, facts.random_fact(1, n=50))
    for df in (
        market.daily_totals(fact),
        market.daily_actives(fact),
        market.new_clients(fact),
        merchant.merchant_months(merchant.client_months(fact)),
        merchant.merchant_reach(fact),
        user.user_totals(fact),
        user.user_reach(fact),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
        below = [after for line, after in zip(plan, plan[1:]) if "Exchange hashpartitioning" in line]
        assert below and all("partial_" in line or "Union" in line or "keys=" in line for line in below), below
