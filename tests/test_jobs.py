"""All jobs on catalog tables, end to end and repeated."""

import datetime as dt
import json

import pytest

from ledgerlake.checks.queries import AS_OF, Layers
from ledgerlake.jobs import Lakehouse
from ledgerlake.plans import seen
from ledgerlake.plans.market import market_daily_summary
from ledgerlake.plans.merchant import merchant_monthly_performance
from ledgerlake.plans.source import type_transactions
from ledgerlake.schemas import TABLES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
CLOCK = {"updated_at", "created_at", "load_at", "valid_from", "valid_to"}
KEYS = {"client_key", "card_key"}


@pytest.fixture(scope="module")
def lake(spark):
    return Layers(spark, SF_DIR)


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory, lake):
    folder = tmp_path_factory.mktemp("house")
    house = Lakehouse(spark, "t_bronze", "t_silver", "t_gold", str(folder))
    house.prepare()
    house.prepare()
    (folder / "mcc.json").write_text(json.dumps({str(r.mcc_code): r.description for r in lake.mcc_codes.collect()}))
    labels = {str(r.transaction_id): r.is_fraud for r in lake.labels.collect()}
    (folder / "labels.json").write_text(json.dumps({"target": labels}))

    latest_users = lake.users.where("load_at = '2020-01-01'").drop("load_at")
    latest_cards = lake.cards.where("load_at = '2020-01-01'").drop("load_at")
    assert house.ingest("users", latest_users) == latest_users.count()
    assert house.ingest("cards", latest_cards) == latest_cards.count()
    assert house.ingest("transactions", type_transactions(lake.staged_transactions)) == lake.transactions.count()
    assert house.ingest_mcc(str(folder / "mcc.json")) == lake.mcc_codes.count()
    assert house.ingest_labels(str(folder / "labels.json")) == len(labels)
    yield house
    for name in ("t_gold", "t_silver", "t_bronze"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def content(house, table):
    df = house.read(table)
    return sorted(map(str, df.drop(*(CLOCK | KEYS)).collect()))


def test_end_to_end_and_again(house, lake):
    window = (dt.date(1995, 1, 1), dt.date(1997, 6, 10))
    jobs = [
        ("silver.users", lambda: house.build_users(AS_OF)),
        ("silver.cards", lambda: house.build_cards(AS_OF)),
        ("silver.transactions", lambda: house.build_transactions(*window)),
        ("gold.transaction_detail", lambda: house.build_detail(*window)),
        ("gold.market_daily_summary", lambda: house.build_market(*window)),
        ("gold.merchant_monthly_performance", lambda: house.build_merchants(*window)),
        ("gold.user_detail", lambda: house.build_user_detail(AS_OF)),
    ]
    first = {}
    for table, job in jobs:
        rows = job()
        first[table] = content(house, table)
        assert rows == len(first[table]) > 0
    # Months are rewritten whole, the fact by day.
    by_month = lake.transactions.where("date_time < '1997-07-01'").count()
    by_day = lake.transactions.where("date_time < '1997-06-11'").count()
    assert len(first["silver.transactions"]) == by_month > by_day == len(first["gold.transaction_detail"])

    for table, job in jobs:
        job()
        assert content(house, table) == first[table]
    # A later window leaves the earlier one in place; a rewrite inside it changes nothing.
    house.build_transactions("1997-07-01", "1997-07-31")
    house.build_detail("1997-06-11", "1997-07-31")
    house.build_detail("1996-02-03", "1996-02-09")
    assert house.read("gold.transaction_detail").count() == lake.transactions.where("date_time < '1997-08-01'").count()
    house.build_market("1996-02-03", "1996-02-09")
    assert content(house, "gold.market_daily_summary") == first["gold.market_daily_summary"]

    # After these reruns the history tables and a summary built from them are as one pass over the whole fact gives them.
    assert house.build_transactions("1980-01-01", "1980-12-31") == house.build_detail("1980-01-01", "1980-12-31") == 0
    fact = house.read("gold.transaction_detail")
    assert content(house, "gold.client_months") == sorted(map(str, seen.client_months(fact).collect()))
    assert content(house, "gold.merchant_client_months") == sorted(map(str, seen.merchant_client_months(fact).collect()))
    house.build_market("1997-07-01", "1997-07-31")
    july = house.read("gold.market_daily_summary").where("year = 1997 and month = 7").drop("updated_at")
    whole = market_daily_summary(fact, "1997-07-01", "1997-07-31").drop("updated_at")
    assert sorted(map(str, july.select(whole.columns).collect())) == sorted(map(str, whole.collect()))

    house.create_latest_day_view()
    last = house.read("gold.transaction_detail").agg(F.max(F.to_date("txn_date_time"))).first()[0]
    view = house.spark.table("t_gold.vw_transaction_summary").collect()
    assert {r.txn_date for r in view} == {last}


def test_tables_keep_their_declared_schema(house):
    for table, (columns, _) in TABLES.items():
        assert dict(house.read(table).dtypes) == columns


def test_each_topic_lands_in_its_own_table(spark, house, tmp_path):
    schema = "key binary, value binary, offset bigint, timestamp timestamp"
    for k, table in enumerate(("users", "cards", "transactions")):
        rows = [(b"k", b'{"op": "c", "ts_ms": 5}', i, dt.datetime(2024, 1, 1)) for i in range(k + 1)]
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / table))
        for _ in range(2):  # a restart adds nothing
            house.land(table, spark.readStream.schema(schema).parquet(str(tmp_path / table)), str(tmp_path / f"at_{table}"), once=True)
    assert [house.read(f"bronze.cdc_{t}").count() for t in ("users", "cards", "transactions")] == [1, 2, 3]
    with pytest.raises(ValueError, match="no change records"):
        house.land("other", None, "")


def test_history_tables_spare_the_scan_of_the_fact(house):
    """With them, every scan of the fact is bounded by the window and its look-back."""
    known = seen.first_dates(house.read("gold.client_months"), "1996-03-31")
    older = seen.earlier_pairs(house.read("gold.merchant_client_months"), "1996-03-01")
    fact = house.read("gold.transaction_detail")
    for df in (
        market_daily_summary(fact, "1996-03-01", "1996-03-31", first_dates=known),
        merchant_monthly_performance(fact, "1996-03-01", "1996-03-31", earlier=older),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan" in line and "txn_date_time" in line]
        assert scans and all(line.split("PartitionFilters")[1].count("txn_year") >= 2 for line in scans)
