"""Card-shaped bronze tables derived from the given tables, row for row, at any scale.

Every row of ``customer``, ``part``, ``orders`` and ``events`` is used. Odd values (unreadable money, unknown keys,
blank texts) come from arithmetic on the keys, and one merchant takes a third of all transactions.
The ``in_*`` steps of ``checks.sql`` state the same tables as SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_CARDS, BRONZE_TRANSACTIONS, BRONZE_USERS, conform

HOT_MERCHANT = 7


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _money(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def _rows(df: DataFrame) -> Column:
    """Row count of a table as a scalar subquery, so that derived key ranges grow with the data."""
    return df.agg(F.count(F.lit(1))).scalar()


def _new_year(year: Column) -> Column:
    return F.make_timestamp(year.cast("int"), *(F.lit(v) for v in (1, 1, 0, 0, 0)))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three yearly versions per customer."""
    k = F.col("c_custkey")
    extra = F.when(k % 9 == 0, 2).when(k % 3 == 0, 1).otherwise(0)
    versions = given(spark, sf_dir, "customer").select("*", F.explode(F.sequence(F.lit(0), extra)).alias("v"))
    v, balance = F.col("v"), F.col("c_acctbal")
    birth_year = F.when(k % 41 != 5, 1935 + k % 80)
    income = F.when(k % 50 == 8, "n/a").when(k % 50 != 7, _money(F.abs(balance) * 10 + v * 1000))
    return conform(
        versions,
        BRONZE_USERS,
        {
            "id": k,
            "current_age": F.when(k % 67 != 9, 2020 + v - (1935 + k % 80)),
            "retirement_age": 60 + k % 10,
            "birth_year": birth_year,
            "birth_month": 1 + k % 12,
            "gender": F.when(k % 101 == 3, "Unknown").when(k % 2 == 0, "Male").otherwise("Female"),
            "address": F.col("c_name"),
            "latitude": F.col("c_nationkey") * F.lit(1.5).cast("decimal(3,1)"),
            "longitude": F.col("c_nationkey") * F.lit(-2.5).cast("decimal(3,1)"),
            "per_capita_income": _money(F.abs(balance)),
            "yearly_income": income,
            "total_debt": _money(balance),
            "credit_score": 300 + k % 551,
            "num_credit_cards": 1 + k % 5,
            "load_at": _new_year(2020 + v),
        },
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One or two versions per part; some owners do not exist."""
    k = F.col("p_partkey")
    extra = F.when(k % 4 == 0, 1).otherwise(0)
    versions = given(spark, sf_dir, "part").select("*", F.explode(F.sequence(F.lit(0), extra)).alias("v"))
    v = F.col("v")
    clients = _rows(given(spark, sf_dir, "customer"))
    limit = _money(F.col("p_retailprice") * (v + 1))
    return conform(
        versions,
        BRONZE_CARDS,
        {
            "id": k,
            "client_id": k % F.floor(clients * 11 / 10),
            "card_brand": F.lower("p_brand"),
            "card_type": F.col("p_type"),
            "card_number": F.lpad(k.cast("string"), 16, "4"),
            "expires": F.when(k % 37 == 5, "unknown").otherwise(
                F.concat((k % 14).cast("string"), F.lit("/"), (1995 + F.col("p_size")).cast("string"))
            ),
            "CVV": F.lpad((k % 1000).cast("string"), 3, "0"),
            "has_chip": F.when(k % 2 == 0, "YES").otherwise("NO"),
            "num_cards_issued": 1 + k % 3,
            "credit_limit": F.when(k % 40 == 3, "")
            .when(k % 40 == 4, F.concat(F.lit("USD "), limit))
            .when(k % 40 == 5, "$0.00")
            .otherwise(limit),
            "acct_open_date": F.concat((k % 12 + 1).cast("string"), F.lit("/"), (1890 + k % 130).cast("string")),
            "year_pin_last_changed": 2000 + k % 20,
            "card_on_dark_web": F.when(k % 10 == 0, "Yes").when(k % 10 != 1, "No"),
            "load_at": _new_year(2020 + v),
        },
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    places = given(spark, sf_dir, "nation").join(
        given(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = given(spark, sf_dir, "orders").join(places, F.col("n_nationkey") == (k + c) % 25)
    plastic = _rows(given(spark, sf_dir, "part"))
    sellers = _rows(given(spark, sf_dir, "supplier"))
    price = F.col("o_totalprice")
    moment = F.timestamp_add("HOUR", (k * 13 + c) % 24, F.col("o_orderdate").cast("timestamp"))
    return conform(
        rows,
        BRONZE_TRANSACTIONS,
        {
            "id": k,
            "date_time": moment,
            "client_id": F.when(k % 97 == 11, None).when(k % 25 == 24, -1 - c).otherwise(c),
            "card_id": k % F.floor(plastic * 11 / 10),
            "amount": F.when(k % 211 == 7, "abc")
            .when(k % 53 == 5, "$0.00")
            .when(k % 211 != 8, _money(F.when(F.col("o_orderstatus") == "F", -price).otherwise(price))),
            "use_chip": F.when(F.col("o_orderpriority") == "1-URGENT", "Yes")
            .when(F.col("o_orderpriority") == "2-HIGH", "yes")
            .when(F.col("o_orderpriority") != "3-MEDIUM", "No"),
            "merchant_id": F.when(k % 101 == 13, None).when(k % 3 == 0, HOT_MERCHANT).otherwise((k * 3 + c) % sellers),
            "merchant_city": F.when(k % 31 != 4, F.col("n_name")),
            "merchant_state": F.col("r_name"),
            "zip": F.when(k % 5 != 0, (k % 1000).cast("string")),
            "mcc": F.when(k % 89 != 3, 5000 + (k * 7) % 55),
            "errors": F.when(k % 40 == 0, "Bad PIN").when(k % 40 == 1, ""),
            "load_at": _new_year(F.lit(2020)),
            "date_partition": F.date_format(moment, "yyyy-MM"),
        },
    )


def staged_transactions(typed: DataFrame) -> DataFrame:
    """The transactions as a CSV export holds them: all text."""
    return typed.select(
        F.col("id").cast("string"),
        F.date_format("date_time", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        *(
            F.col(name).cast("string")
            for name in (
                "client_id", "card_id", "amount", "use_chip", "merchant_id", "merchant_city",
                "merchant_state", "zip", "mcc", "errors",
            )
        ),
    )


def mcc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code per part size; five of the codes in use stay unknown."""
    return (
        given(spark, sf_dir, "part")
        .groupBy((5000 + F.col("p_size")).cast("int").alias("mcc_code"))
        .agg(F.concat_ws(", ", F.min("p_name"), F.max("p_name")).alias("description"))
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label per order, a third of them for unknown transactions."""
    k = F.col("o_orderkey")
    return given(spark, sf_dir, "orders").select(
        F.when(k % 3 == 0, -1 - k).otherwise(k).cast("int").alias("transaction_id"),
        F.when(k % 17 == 0, "YES").when(k % 17 == 1, "Yes").otherwise("No").alias("is_fraud"),
    )


def cdc_records(events: DataFrame) -> DataFrame:
    """Topic records from events, batch or streaming; one payload in 97 is not JSON."""
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .when(F.col("event_type") == "purchase", "r")
        .otherwise("u")
    )
    stamp = (F.lit(1700000000000) + F.col("event_id")).cast("string")
    text = F.concat(
        F.lit('{"op":"'), op, F.lit('","ts_ms":'), stamp, F.lit(',"after":'), F.col("props"), F.lit("}")
    )
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_id") % 97 == 1, F.concat(F.lit("broken "), op)).otherwise(text).cast("binary").alias("value"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@dataclass(frozen=True)
class Lake:
    """All bronze inputs of one data folder; each frame is declared once."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def users(self) -> DataFrame:
        return users(self.spark, self.sf_dir)

    @cached_property
    def cards(self) -> DataFrame:
        return cards(self.spark, self.sf_dir)

    @cached_property
    def transactions(self) -> DataFrame:
        return transactions(self.spark, self.sf_dir)

    @cached_property
    def staged_transactions(self) -> DataFrame:
        return staged_transactions(self.transactions)

    @cached_property
    def mcc_codes(self) -> DataFrame:
        return mcc_codes(self.spark, self.sf_dir)

    @cached_property
    def labels(self) -> DataFrame:
        return labels(self.spark, self.sf_dir)

    @cached_property
    def cdc(self) -> DataFrame:
        return cdc_records(given(self.spark, self.sf_dir, "events"))
