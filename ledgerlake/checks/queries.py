"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.calendar import date_window_filter, fixed_windows, month_windows, widen_to_months
from ..jobs import Lakehouse, layer_digests, merge_load
from ..operators import quality
from ..operators.reconcile import differing_rows, reconcile
from ..operators.top import top_per_group
from ..plans import bronze, detail, latest, market, merchant, seen, silver, source, user
from ..schemas import GOLD_DAILY_ACTIVES, SILVER_TRANSACTIONS, ddl
from ..sinks import tables
from ..sources.files import CSV_WRITE
from ..streaming.cdc import BatchWriter, envelope, land_batches, land_cdc, landed_batches
from ..workspace import drop_at_end, shared_folder
from .inputs import Lake, cdc_records, given

AS_OF = dt.date(2024, 6, 15)
# Windows inside the data, which cut months on both sides and leave history before them.
START, END = dt.date(1995, 3, 15), dt.date(1996, 5, 20)

Query = Callable[[SparkSession, str], DataFrame]


def _load_time() -> Column:
    return F.make_timestamp(*(F.lit(v) for v in (2024, 6, 15, 0, 0, 0)))


# ------------------------------------------------------------------ layers


class Layers(Lake):
    """The tables above bronze, as of a fixed day."""

    @cached_property
    def silver_users(self) -> DataFrame:
        return silver.silver_users(self.users, AS_OF)

    @cached_property
    def silver_cards(self) -> DataFrame:
        return silver.silver_cards(self.cards, AS_OF)

    @cached_property
    def silver_transactions(self) -> DataFrame:
        return self.silver_window()

    def silver_window(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        return silver.silver_transactions(self.transactions, self.silver_users, self.silver_cards, start, end)

    @cached_property
    def detail(self) -> DataFrame:
        return detail.transaction_detail(
            self.silver_transactions, self.silver_users, self.silver_cards, self.mcc_codes, self.labels
        )


@lru_cache(maxsize=4)
def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Lazy frames only; sharing them saves declaring the same plan for every query."""
    return Layers(spark, sf_dir)


def _comparable_silver(df: DataFrame) -> DataFrame:
    """Surrogate keys as "present" flags, clock columns left out."""
    return df.select(
        "*", F.col("client_key").isNotNull().alias("has_client_key"), F.col("card_key").isNotNull().alias("has_card_key")
    ).drop("client_key", "card_key", "updated_at")


# ------------------------------------------------------------------ scalar functions


def money_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("per_capita_income", "yearly_income", "total_debt")
    return layers(spark, sf_dir).users.select("id", "load_at", *(s.money(c, 15, 2).alias(c) for c in columns))


def amount_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).transactions.select(
        "id", F.col("amount").alias("amount_text"), s.money("amount", 18, 4).alias("amount")
    )


def credit_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).cards.select(
        "id",
        "load_at",
        s.credit_limit(s.blank_to_null("credit_limit")).alias("credit_limit"),
        s.money("credit_limit", 12, 2).alias("strict_limit"),
    )


def month_year_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).cards.select(
        "id",
        "load_at",
        F.upper("card_brand").alias("card_brand"),
        s.month_of("expires").alias("expires_month"),
        s.year_of("expires").alias("expires_year"),
        s.month_of("acct_open_date").alias("open_month"),
        s.year_of("acct_open_date").alias("open_year"),
    )


def card_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = s.expired(s.year_of("expires"), s.month_of("expires"), AS_OF)
    return layers(spark, sf_dir).cards.select("id", "load_at", "expires", flag.alias("is_expires"))


def age_income_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    age, income = s.age_at(AS_OF, "birth_year"), s.money("yearly_income", 15, 2)
    return layers(spark, sf_dir).users.select(
        F.col("id").alias("client_id"),
        F.col("load_at").alias("valid_from"),
        age.alias("current_age"),
        s.age_group(age).alias("age_group"),
        income.alias("yearly_income"),
        s.income_group(income).alias("income_group"),
    )


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = "date_time"
    return layers(spark, sf_dir).transactions.select(
        "id",
        F.year(moment).alias("year"),
        F.month(moment).alias("month"),
        F.dayofmonth(moment).alias("day"),
        F.hour(moment).alias("hour"),
        F.to_date(moment).alias("date"),
        s.month_start(moment).alias("month_start"),
        F.date_format(moment, "yyyy-MM").alias("date_partition"),
        F.date_add(F.to_date(moment), 30).alias("in_30_days"),
        F.datediff(F.to_date(moment), s.month_start(moment)).alias("days_into_month"),
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = layers(spark, sf_dir)
    marks = lake.labels.withColumnRenamed("transaction_id", "id")
    return lake.transactions.join(marks, "id", "left").select(
        F.col("id").alias("transaction_id"),
        s.chip_flag("use_chip").alias("use_chip"),
        s.error_flag("errors").alias("is_error"),
        s.fraud_flag("is_fraud").alias("is_fraud"),
    )


def spending_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).detail.select(
        "transaction_id", "txn_amount", "card_credit_limit", "txn_spending_ratio"
    )


# ------------------------------------------------------------------ sources and bronze


def staged_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.type_transactions(layers(spark, sf_dir).staged_transactions)


def ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.ingest_table(staged_typing(spark, sf_dir), "transactions", _load_time())


def _exported(df: DataFrame) -> str:
    """The table as CSV files in a folder of its own."""
    path = shared_folder(df.sparkSession)
    df.write.options(**CSV_WRITE).csv(path)
    return path


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.load_transactions(spark, _exported(layers(spark, sf_dir).staged_transactions))


def csv_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.load_users(spark, _exported(layers(spark, sf_dir).users.drop("load_at")))


def csv_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.load_cards(spark, _exported(layers(spark, sf_dir).cards.drop("load_at")))


def mcc_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code list as one JSON object in one file; its size is set by the number of part sizes."""
    path = shared_folder(spark)
    entries = F.collect_list(F.struct(F.col("mcc_code").cast("string"), "description"))
    document = layers(spark, sf_dir).mcc_codes.agg(F.to_json(F.map_from_entries(entries)).alias("value"))
    document.write.text(path)
    return bronze.ingest_mcc(spark, path, _load_time()).select(
        "mcc_code", "description", F.col("file_name").startswith("part-").alias("has_file")
    )


LABELS_PER_FILE = 100_000


def label_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as nested JSON objects, one file per range of ids, read back by many tasks."""
    path = shared_folder(spark)
    entries = F.map_from_entries(F.collect_list(F.struct(F.col("transaction_id").cast("string"), "is_fraud")))
    documents = (
        layers(spark, sf_dir)
        .labels.groupBy(F.floor(F.col("transaction_id") / LABELS_PER_FILE).alias("id_range"))
        .agg(F.to_json(F.struct(entries.alias("target"))).alias("value"))
    )
    documents.write.partitionBy("id_range").text(path)
    return bronze.ingest_labels(spark, path, _load_time()).select("transaction_id", "is_fraud")


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    layers(spark, sf_dir).labels.write.json(path)
    return bronze.ingest_labels(spark, path, _load_time(), layout="lines").select("transaction_id", "is_fraud")


# ------------------------------------------------------------------ change data capture


def cdc_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(layers(spark, sf_dir).cdc).drop("ingestion_time", "ingestion_date")


def cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, landed once, read back. A pattern stands for the table, be it a file or a folder."""
    folder = shared_folder(spark)
    events = spark.readStream.schema(given(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/{{events.parquet}}")
    land_cdc(cdc_records(events), f"{folder}/table", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/table").drop("ingestion_time", "ingestion_date")


# ------------------------------------------------------------------ silver and detail


def scd2_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).silver_users.drop("client_key")


def scd2_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).silver_cards.drop("card_key")


def scd2_key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = layers(spark, sf_dir)

    def report(df: DataFrame, name: str, entity: str, key: str) -> DataFrame:
        per_key = df.groupBy(entity, key).agg(
            F.count(F.lit(1)).alias("n"), F.count_if("is_current").alias("open")
        )
        per_entity = per_key.groupBy(entity).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.sum("open").alias("open")
        )
        return per_entity.agg(
            F.sum("n").alias("versions"),
            F.sum("keys").alias("keys"),
            F.sum("open").alias("open_versions"),
            F.count(F.lit(1)).alias("entities"),
        ).select(F.lit(name).alias("dimension"), "*")

    return report(lake.silver_users, "users", "client_id", "client_key").unionByName(
        report(lake.silver_cards, "cards", "card_id", "card_key")
    )


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable_silver(layers(spark, sf_dir).silver_transactions)


def transaction_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).detail.drop("client_key", "card_key", "created_at")


# ------------------------------------------------------------------ market


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = layers(spark, sf_dir).detail
    totals = market.daily_totals(fact).join(market.daily_actives(fact), "period_date", "left")
    return totals.select(
        "period_date",
        *(F.col(f"txn_{part}_amt").cast("decimal(20,2)").alias(f"txn_{part}_amt") for part in ("total", "pos", "neg")),
        F.col("txn_avg_amt").cast("decimal(12,2)").alias("txn_avg_amt"),
        *(
            F.col(c).cast("int").alias(c)
            for c in (
                "txn_total_cnt", "txn_pos_cnt", "txn_neg_cnt", "txn_fraud_cnt", "txn_error_cnt",
                "client_unique_cnt", "merchant_active_cnt",
            )
        ),
    )


def daily_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = market.with_lags(market.daily_totals(layers(spark, sf_dir).detail))
    amounts = [s.or_zero(f"prev_{k}d_amt").cast("decimal(20,2)").alias(f"prev_{k}d_amt") for k in market.LAGS]
    counts = [s.or_zero(f"prev_{k}d_cnt").cast("int").alias(f"prev_{k}d_cnt") for k in market.LAGS]
    return days.select("period_date", *amounts, *counts)


def peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = market.daily_totals(layers(spark, sf_dir).detail)
    return totals.select("period_date", "peak_hour", "peak_hour_cnt")


def top_mcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.daily_top_category(layers(spark, sf_dir).detail)


def top_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("merchant_top_id", "merchant_top_txn_cnt")
    return top_per_group(layers(spark, sf_dir).detail, ["client_id"], "merchant_id", F.count(F.lit(1)), names)


def new_clients_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.new_clients(layers(spark, sf_dir).detail)


def market_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.market_daily_summary(layers(spark, sf_dir).detail).drop("updated_at")


def history_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten days of history, the look at the data before the summary is built."""
    totals = market.daily_totals(layers(spark, sf_dir).detail)
    return (
        totals.select(
            F.col("period_date").alias("hist_date"),
            F.col("txn_total_amt").alias("hist_amt"),
            F.col("txn_total_cnt").alias("hist_cnt"),
        )
        .orderBy("hist_date")
        .limit(10)
    )


# ------------------------------------------------------------------ merchants and users

MONTH_COUNTS = (
    "active_city_cnt", "active_state_cnt", "active_mcc_cnt", "txn_total_cnt", "txn_positive_cnt",
    "txn_negative_cnt", "fraud_txn_cnt", "error_txn_cnt", "unique_client_cnt",
)
MONTH_AMOUNTS = ("rev_total", "rev_positive", "rev_negative", "txn_total_amt")


def merchant_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = layers(spark, sf_dir).detail
    months = merchant.merchant_months(merchant.client_months(fact))
    reach = merchant.merchant_reach(fact)
    joined = months.join(
        reach,
        F.col("merchant_id").eqNullSafe(F.col("reach_id")) & (F.col("period_month") == F.col("reach_month")),
        "left",
    )
    return joined.select(
        "merchant_id",
        "period_month",
        *(s.or_zero(c).cast("decimal(18,2)").alias(c) for c in MONTH_AMOUNTS),
        *(s.or_zero(c).cast("int").alias(c) for c in MONTH_COUNTS),
    )


def merchant_prev_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = merchant.merchant_months(merchant.client_months(layers(spark, sf_dir).detail))
    before = merchant.previous_month_values(months, "merchant_id", "period_month", merchant.PREVIOUS)
    kinds = {"prev_rev_total": "decimal(18,2)", "prev_rev_positive": "decimal(18,2)"}
    return before.select(
        "merchant_id",
        "period_month",
        *(s.or_zero(c).cast(kinds.get(c, "int")).alias(c) for c in merchant.PREVIOUS.values()),
    )


def merchant_client_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = merchant.merchant_months(merchant.client_months(layers(spark, sf_dir).detail))
    return months.where("merchant_id IS NOT NULL").select(
        "merchant_id", "period_month", "new_client_cnt", "returning_client_cnt"
    )


def merchant_monthly_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchant.merchant_monthly_performance(layers(spark, sf_dir).detail).drop("updated_at")


def user_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = user.user_totals(layers(spark, sf_dir).detail)
    amounts = ("total_txn_amt", "total_pos_amt", "total_neg_amt")
    counts = ("total_txn", "total_txn_pos", "total_txn_neg", "total_txn_fraud", "total_txn_error", "merchant_unique_cnt")
    return totals.select(
        "client_id",
        *(s.or_zero(c).cast("decimal(18,2)").alias(c) for c in amounts),
        *(F.col(c).cast("int").alias(c) for c in counts),
        "lifetime_first_date",
        "lifetime_last_date",
    )


def user_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = layers(spark, sf_dir)
    return user.user_detail(lake.silver_users, lake.detail, AS_OF).drop("client_key", "updated_at")


def latest_day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_day_summary(layers(spark, sf_dir).detail)


def _stored_detail(spark: SparkSession, rows: DataFrame) -> str:
    """The fact as the jobs store it, by day; the name stays in the catalog until the session ends."""
    name = _table_name("detail")
    tables.create_declared(spark, "gold.transaction_detail", name, shared_folder(spark))
    drop_at_end(spark, f"TABLE {name}")
    tables.replace_partitions(rows, name, market.FACT_PARTITIONS)
    return name


@lru_cache(maxsize=4)
def _kept_detail(spark: SparkSession, sf_dir: str) -> str:
    """One stored fact for all queries that only read it."""
    return _stored_detail(spark, layers(spark, sf_dir).detail)


def latest_day_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a catalog view over a stored fact, which is evaluated by whoever reads the result."""
    name, view = _kept_detail(spark, sf_dir), _table_name("vw")
    latest.create_latest_day_view(spark, view, name)
    drop_at_end(spark, f"VIEW {view}")
    return spark.table(view)


def latest_day_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the stored fact's list of partitions."""
    name = _kept_detail(spark, sf_dir)
    return latest.latest_day_summary(spark.table(name), tables.last_date(spark, name, market.FACT_PARTITIONS))


def active_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct clients and merchants per month, and over all months, from bitmaps kept by day."""
    path = shared_folder(spark)
    market.active_bitmaps(layers(spark, sf_dir).detail).write.partitionBy("year", "month").parquet(path)
    kept = spark.read.schema(ddl(GOLD_DAILY_ACTIVES)).parquet(path)
    whole = market.active_counts(kept).select(F.lit(None).cast("date").alias("period_date"), *market.ACTIVES)
    return market.active_counts(kept, "month").unionByName(whole)


def _tampered(detail: DataFrame) -> DataFrame:
    """A fact that lost some rows on the way and has some twice."""
    return detail.where("transaction_id % 1013 <> 7").unionByName(detail.where("transaction_id % 1009 = 5"))


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three layers by month; the last one lost some rows and has others twice."""
    lake = layers(spark, sf_dir)
    rows = {"bronze": lake.transactions, "silver": lake.silver_transactions, "gold": _tampered(lake.detail)}
    return reconcile({name: layer_digests(df, name) for name, df in rows.items()})


def differing_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows behind the differences."""
    detail = layers(spark, sf_dir).detail
    return differing_rows(detail, _tampered(detail), ["transaction_id", "txn_date_time"])


# ------------------------------------------------------------------ windows that cut


def detail_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = layers(spark, sf_dir)
    silver_rows = lake.silver_window(*widen_to_months(START, END))
    rows = detail.transaction_detail(silver_rows, lake.silver_users, lake.silver_cards, lake.mcc_codes, lake.labels, START, END)
    return rows.drop("client_key", "card_key", "created_at")


def market_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags look back before the window, and a client is new only if it was never seen before."""
    return market.market_daily_summary(layers(spark, sf_dir).detail, START, END).drop("updated_at")


def new_clients_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.new_clients(layers(spark, sf_dir).detail, START, END)


def merchant_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the first of the first month, compared with the full month before; the last month is cut at the end."""
    return merchant.merchant_monthly_performance(layers(spark, sf_dir).detail, START, END).drop("updated_at")


def market_kept_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same window with first dates from the table kept by month; the fact is read from 30 days before only."""
    fact = layers(spark, sf_dir).detail
    known = seen.first_dates(seen.client_months(fact), END)
    return market.market_daily_summary(fact, START, END, first_dates=known).drop("updated_at")


def merchant_kept_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = layers(spark, sf_dir).detail
    older = seen.earlier_pairs(seen.merchant_client_months(fact), START)
    return merchant.merchant_monthly_performance(fact, START, END, earlier=older).drop("updated_at")


# ------------------------------------------------------------------ calendar, quality, sets


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.to_date("date_time")
    return layers(spark, sf_dir).transactions.agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"))


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a year, counted one by one. Those that begin in an even year fail at first and are done by the second run."""
    house = Lakehouse(spark, gold=_table_name("gold"), root=shared_folder(spark))
    tables.create_database(spark, house.gold, f"{house.root}/gold")
    drop_at_end(spark, f"DATABASE {house.gold} CASCADE")
    tables.create_declared(spark, "gold.run_ledger", house.name("gold.run_ledger"))
    rows, windows = layers(spark, sf_dir).transactions, fixed_windows(_bounds(spark, sf_dir), 365)

    def build(start: dt.date, end: dt.date, poisoned: bool = False) -> int:
        if poisoned and start.year % 2 == 0:
            raise ValueError("poisoned window")
        return date_window_filter(rows, "date_time", start, end).count()

    house.run_windows("count", lambda start, end: build(start, end, poisoned=True), windows)
    return house.run_windows("count", build, windows).drop("message", "recorded_at")


def calendar_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_windows(_bounds(spark, sf_dir), 7)


def calendar_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_windows(_bounds(spark, sf_dir))


def window_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = _bounds(spark, sf_dir)
    start, end = bounds.select("start_date").scalar(), bounds.select("end_date").scalar()
    return quality.window_audit(layers(spark, sf_dir).transactions, "date_time", start, end, 7)


def _source(spark: SparkSession, sf_dir: str) -> source.Source:
    lake = layers(spark, sf_dir)
    return source.Source(lake.users, lake.cards, lake.transactions)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir).row_counts()


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir).repeated_keys()


def pk_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir).orphans()


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir).rule_violations()


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).transactions.select("merchant_id", "client_id").distinct()


# ------------------------------------------------------------------ sinks


def _table_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all months, rewrite some of them, read back: the table must equal a single write."""
    lake, name, path = layers(spark, sf_dir), _table_name("silver_transactions"), shared_folder(spark)
    tables.create_declared(spark, "silver.transactions", name, path)
    partitions = ["year", "month"]
    tables.replace_partitions(lake.silver_transactions, name, partitions)
    again = lake.silver_window(*widen_to_months("1997-03-10", "1997-05-05"))
    tables.replace_partitions(again, name, partitions)
    spark.sql(f"DROP TABLE {name}")
    return _comparable_silver(spark.read.schema(ddl(SILVER_TRANSACTIONS)).parquet(path))


def window_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact by day, and a rerun of a window whose input has lost every second day since: those days are gone."""
    fact = layers(spark, sf_dir).detail
    name = _stored_detail(spark, fact)
    again = date_window_filter(fact, "txn_date_time", START, END).where("txn_day % 2 = 1")
    tables.replace_window(again, name, market.FACT_PARTITIONS, tables.between(market.FACT_PARTITIONS, START, END))
    return spark.table(name).drop("client_key", "card_key", "created_at")


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User versions merged load by load, out of order, one load twice."""
    name, users = _table_name("user_versions"), layers(spark, sf_dir).users
    tables.create_declared(spark, "silver.user_versions", name, shared_folder(spark))
    drop_at_end(spark, f"TABLE {name}")
    for year in (2021, 2020, 2022, 2021):
        merge_load(spark, name, users.where(F.year("load_at") == year))
    return silver.shape_users(spark.table(name), AS_OF).drop("client_key")


def cdc_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of one file each; the second one fails after it was written and is repeated after a restart."""
    folder = shared_folder(spark)
    events = given(spark, sf_dir, "events")
    events.repartition(4, "event_id").write.parquet(f"{folder}/topic")
    files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    write = BatchWriter(f"{folder}/landed")

    def failing(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after writing")

    for sink in (failing, write):
        stream = land_batches(cdc_records(files.parquet(f"{folder}/topic")), sink, write.path, f"{folder}/checkpoint", once=True)
        try:
            stream.awaitTermination()
        except StreamingQueryException:
            if sink is write:
                raise
    return landed_batches(spark, write.path).drop("ingestion_time", "ingestion_date", "batch_id")


def append_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the users appended to one bronze table."""
    lake, name, path = layers(spark, sf_dir), _table_name("bronze_users"), shared_folder(spark)
    tables.create_declared(spark, "bronze.users", name, path)
    tables.append(lake.users, name)
    tables.append(bronze.ingest_table(lake.users.drop("load_at"), "users", _load_time()), name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


def detail_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide fact from declared tables, bucketed by transaction: neither facts nor labels move for their join."""
    lake, path = layers(spark, sf_dir), shared_folder(spark)
    names = {table: _table_name("bucketed") for table in ("silver.transactions", "bronze.train_fraud_labels")}
    for table, name in names.items():
        tables.create_declared(spark, table, name, f"{path}/{table}", buckets=16)
        drop_at_end(spark, f"TABLE {name}")
    facts, marks = names.values()
    tables.replace_partitions(lake.silver_transactions, facts, ["year", "month"])
    nothing = F.lit(None)
    tables.overwrite_rows(lake.labels.withColumns({"file_name": nothing.cast("string"), "load_at": nothing.cast("timestamp")}), marks)
    rows = detail.transaction_detail(spark.table(facts), lake.silver_users, lake.silver_cards, lake.mcc_codes, spark.table(marks))
    return rows.drop("client_key", "card_key", "created_at")


def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions and labels in equal buckets of the transaction id: the join of two large sides needs no exchange.

    The id has no hot value, which is what a bucket column must be like.
    """
    lake, path = layers(spark, sf_dir), shared_folder(spark)
    left, right = _table_name("txn"), _table_name("lab")
    buckets = 16
    facts = lake.transactions.select(F.col("id").alias("transaction_id"), "client_id", "amount")
    tables.write_bucketed(facts, left, buckets, "transaction_id", f"{path}/txn")
    tables.write_bucketed(lake.labels, right, buckets, "transaction_id", f"{path}/lab")
    # Both stay in the catalog, which knows about the buckets when the result is read, until the session ends.
    drop_at_end(spark, f"TABLE {left}", f"TABLE {right}")
    return spark.table(left).join(spark.table(right), "transaction_id", "left")


QUERIES: dict[str, Query] = {
    f"q_{function.__name__}": function
    for function in (
        money_parse, amount_parse, credit_limit, month_year_split, card_expired, age_income_groups, date_parts,
        flags, spending_ratio, staged_typing, ingest_bronze, csv_roundtrip, csv_users, csv_cards, mcc_explode,
        label_explode, jsonl_roundtrip, cdc_envelope, cdc_stream, scd2_users, scd2_cards, scd2_key_unique,
        silver_transactions, transaction_detail, daily_totals, daily_lags, peak_hour, top_mcc, top_merchant,
        new_clients_daily, market_daily_summary, history_head, merchant_month, merchant_prev_month,
        merchant_client_split, merchant_monthly_performance, user_totals, user_detail, latest_day_summary, latest_day_view,
        calendar_windows, calendar_months, window_audit, row_counts, pk_violations, pk_lineitem, fk_violations,
        rule_violations, distinct_pairs, partition_overwrite, append_then_read, bucketed_join,
        detail_window, market_window, new_clients_window, merchant_window,
        market_kept_history, merchant_kept_history,
        latest_day_listed, active_counts, reconciliation, differing_transactions, run_ledger, window_replacement,
        scd2_merge, cdc_replay, detail_bucketed,
    )
}
