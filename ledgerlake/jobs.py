"""Build the catalog tables: read what a table needs, run its plan, write it, report the number of rows.

Every job may be repeated. Dimensions and the user summary are rewritten as a whole, or merged load by load; facts and the
dated summaries become, in the partitions of their window, what a fresh build gives: partitions without rows go, too. The
window is widened to whole months where a partition is a month. Each job is one pass over its inputs, whatever the
length of the window; `run_windows` builds window by window instead, where a window that fails must not hold up the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .functions.calendar import as_date, widen_to_months
from .functions.scalars import DateLike, date_lit
from .operators.reconcile import reconcile, window_digests
from .operators.versions import merge_versions
from .plans import bronze, latest, ledger, market, seen
from .plans.detail import transaction_detail
from .plans.market import market_daily_summary
from .plans.merchant import merchant_monthly_performance
from .plans.silver import shape_cards, shape_users, silver_cards, silver_transactions, silver_users
from .plans.user import user_detail
from .schemas import TABLES
from .sinks import tables
from .sources.jdbc import measured_split, read_jdbc
from .sources.topics import read_topic
from .streaming.cdc import SOURCE_TABLES, land_cdc

KEY_BUCKETS = 16
OPEN = "open"
#: Columns whose value counts help Spark estimate joins.
JOIN_KEYS = {
    "bronze.mcc_codes": ("mcc_code",),
    "bronze.train_fraud_labels": ("transaction_id",),
    "silver.users": ("client_id", "client_key", "is_current"),
    "silver.cards": ("card_id", "card_key", "is_current"),
}
#: What bronze, silver and gold transactions share: window column and row columns of each.
SHARED = {
    "bronze": ("date_time", ("id", "date_time", "client_id", "card_id", "merchant_id", "mcc")),
    "silver": ("date_time", ("transaction_id", "date_time", "client_id", "card_id", "merchant_id", "mcc")),
    "gold": ("txn_date_time", ("transaction_id", "txn_date_time", "client_id", "card_id", "merchant_id", "mcc")),
}


def layer_digests(rows: DataFrame, layer: str) -> DataFrame:
    """``window_digests`` by month of the columns that a transaction keeps from bronze to gold."""
    moment, columns = SHARED[layer]
    kinds = ("long", "timestamp", "long", "long", "long", "long")
    shared = [F.col(c).cast(k) for c, k in zip(columns, kinds, strict=True)]
    return window_digests(rows, F.trunc(F.to_date(moment), "month"), shared)


def with_place(versions: DataFrame, key: str = "id") -> DataFrame:
    """Versions with the partition columns of their kept table."""
    closed = F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit(OPEN))
    return versions.withColumns({"closed": closed, "key_bucket": _key_bucket(key)})


def _key_bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(KEY_BUCKETS)).cast("int")


@dataclass(frozen=True)
class Lakehouse:
    """Database names of the three layers, and a folder for their tables if not the warehouse default.

    ``wide`` declares 64-bit ids and counts, ``buckets`` the tables of ``schemas.BUCKETED_BY`` with that many buckets, so
    that facts and labels are joined where they lie; choose it by ``tables.bucket_count``. ``measured`` stores sizes and
    key counts of the small tables after each write.
    """

    spark: SparkSession
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    root: str | None = None
    wide: bool = False
    buckets: int | None = None
    measured: bool = False
    now: Callable[[], Column] = field(default=F.current_timestamp)

    def name(self, table: str) -> str:
        layer, short = table.split(".")
        return f"{getattr(self, layer)}.{short}"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def prepare(self) -> None:
        """Declare the databases and every table that does not exist yet."""
        for layer in ("bronze", "silver", "gold"):
            place = f"{self.root}/{layer}" if self.root else None
            tables.create_database(self.spark, getattr(self, layer), place, f"{layer} layer")
        for table in TABLES:
            tables.create_declared(self.spark, table, self.name(table), wide=self.wide, buckets=self.buckets)

    def _rewrite(self, df: DataFrame, table: str) -> int:
        watched, watch = tables.counted(df)
        tables.overwrite_rows(watched, self.name(table))
        if self.measured and table in JOIN_KEYS:
            tables.measure(self.spark, self.name(table), JOIN_KEYS[table])
        return tables.row_count(watch)

    def _replace(self, df: DataFrame, table: str, start: DateLike, end: DateLike) -> int:
        partitions = TABLES[table][1]
        return tables.replace_window(df, self.name(table), partitions, tables.between(partitions, start, end))

    # -------------------------------------------------------------- bronze

    def ingest(self, table: str, source: DataFrame) -> int:
        """Append one load of ``users``, ``cards`` or ``transactions``."""
        watched, watch = tables.counted(bronze.ingest_table(source, table, wide=self.wide))
        name, partitions = self.name(f"bronze.{table}"), TABLES[f"bronze.{table}"][1]
        tables.append(tables.laid_out(watched, name, partitions), name, partitions)
        return tables.row_count(watch)

    def ingest_jdbc(
        self, table: str, url: str, properties: Mapping[str, str], source: str | None = None, parts: int | None = None
    ) -> int:
        """Append one load of a database table, read by ``parts`` tasks cut between the lowest and highest id."""
        place = source or table
        split = measured_split(self.spark, url, place, properties, "id", parts) if parts else None
        return self.ingest(table, read_jdbc(self.spark, url, place, properties, split))

    def ingest_mcc(self, path: str) -> int:
        return self._rewrite(bronze.ingest_mcc(self.spark, path), "bronze.mcc_codes")

    def ingest_labels(self, path: str, layout: str = "flat") -> int:
        labels = bronze.ingest_labels(self.spark, path, layout=layout, wide=self.wide)
        return self._rewrite(labels if self.buckets else tables.balanced(labels), "bronze.train_fraud_labels")

    def land_topic(self, table: str, servers: str, topic: str, checkpoint: str, once: bool = False) -> StreamingQuery:
        """Land a change-data-capture topic; see ``land``."""
        return self.land(table, read_topic(self.spark, servers, topic), checkpoint, once)

    def land(self, table: str, records: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        """Land the change records of ``users``, ``cards`` or ``transactions`` in a table of their own."""
        if table not in SOURCE_TABLES:
            raise ValueError(f"no change records of {table}")
        name = self.name(f"bronze.cdc_{table}")
        place = self.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
        query = land_cdc(records, place, checkpoint, once=once)
        if once:
            query.awaitTermination()
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return query

    # -------------------------------------------------------------- silver

    def build_users(self, as_of: DateLike) -> int:
        return self._rewrite(silver_users(self.read("bronze.users"), as_of, self.wide), "silver.users")

    def build_cards(self, as_of: DateLike) -> int:
        return self._rewrite(silver_cards(self.read("bronze.cards"), as_of, self.wide), "silver.cards")

    def merge_users(self, loads: DataFrame, as_of: DateLike) -> int:
        """Bring rows of ``bronze.users`` (whole loads) into the kept versions and rebuild ``silver.users`` from them."""
        merge_load(self.spark, self.name("silver.user_versions"), loads)
        return self._rewrite(shape_users(self.read("silver.user_versions"), as_of, self.wide), "silver.users")

    def merge_cards(self, loads: DataFrame, as_of: DateLike) -> int:
        """The same for cards."""
        merge_load(self.spark, self.name("silver.card_versions"), loads)
        return self._rewrite(shape_cards(self.read("silver.card_versions"), as_of, self.wide), "silver.cards")

    def build_transactions(self, start: DateLike, end: DateLike) -> int:
        months = widen_to_months(start, end)
        rows = silver_transactions(
            self.read("bronze.transactions"),
            self.read("silver.users"),
            self.read("silver.cards"),
            *months,
            updated_at=self.now(),
            wide=self.wide,
        )
        return self._replace(rows, "silver.transactions", *months)

    # -------------------------------------------------------------- gold

    def build_detail(self, start: DateLike, end: DateLike) -> int:
        rows = transaction_detail(
            self.read("silver.transactions"),
            self.read("silver.users"),
            self.read("silver.cards"),
            self.read("bronze.mcc_codes"),
            self.read("bronze.train_fraud_labels"),
            start,
            end,
            created_at=self.now(),
            wide=self.wide,
        )
        written = self._replace(rows, "gold.transaction_detail", start, end)
        # What later comparisons with history read instead of the fact, for the months just changed.
        fact, months = self.read("gold.transaction_detail"), widen_to_months(start, end)
        self._replace(seen.client_months(fact, *months, self.wide), "gold.client_months", *months)
        self._replace(seen.merchant_client_months(fact, *months, self.wide), "gold.merchant_client_months", *months)
        self._replace(market.active_bitmaps(fact, *months), "gold.daily_actives", *months)
        return written

    def build_market(self, start: DateLike, end: DateLike) -> int:
        first, last = widen_to_months(start, end)
        known = seen.first_dates(self.read("gold.client_months"), last)
        summary = market_daily_summary(
            self.read("gold.transaction_detail"), first, last, self.now(), known, self.wide, self.read("gold.daily_actives")
        )
        return self._replace(summary, "gold.market_daily_summary", first, last)

    def build_merchants(self, start: DateLike, end: DateLike) -> int:
        first, last = widen_to_months(start, end)
        older = seen.earlier_pairs(self.read("gold.merchant_client_months"), first)
        summary = merchant_monthly_performance(self.read("gold.transaction_detail"), first, last, self.now(), older, self.wide)
        return self._replace(summary, "gold.merchant_monthly_performance", first, last)

    def build_user_detail(self, as_of: DateLike) -> int:
        summary = user_detail(
            self.read("silver.users"), self.read("gold.transaction_detail"), as_of, self.now(), self.wide
        )
        return self._rewrite(summary, "gold.user_detail")

    def active_counts(self, period: str | None = None, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        """Exact distinct clients and merchants per day, month, year or in all; the fact isn't read."""
        return market.active_counts(self.read("gold.daily_actives"), period, start, end)

    def latest_day_summary(self) -> DataFrame:
        """Summary of the latest day, which the list of partitions tells."""
        fact = "gold.transaction_detail"
        last = tables.last_date(self.spark, self.name(fact), TABLES[fact][1])
        return latest.latest_day_summary(self.read(fact), last)

    def create_latest_day_view(self) -> None:
        latest.create_latest_day_view(
            self.spark, f"{self.gold}.vw_transaction_summary", self.name("gold.transaction_detail")
        )

    # -------------------------------------------------------------- windows and checks

    def reconcile(self, start: DateLike, end: DateLike) -> DataFrame:
        """Per month of the closed window: rows of bronze, silver and gold, and what was lost, doubled or changed."""
        names = {"bronze": "bronze.transactions", "silver": "silver.transactions", "gold": "gold.transaction_detail"}

        def window(layer: str) -> DataFrame:
            date = F.to_date(SHARED[layer][0])
            rows = self.read(names[layer]).where(date.between(date_lit(as_date(start)), date_lit(as_date(end))))
            return layer_digests(rows, layer)

        return reconcile({layer: window(layer) for layer in names})

    def run_windows(self, job: str, build: Callable[[dt.date, dt.date], int], windows: DataFrame) -> DataFrame:
        """Build the windows (``window_start``, ``window_end``) that the ledger doesn't have as done, oldest first.

        A window that fails is recorded with its message and the others go on; the next call takes up those that failed.
        Returns the ledger's last state of the job's windows.
        """
        name = self.name("gold.run_ledger")
        for window in ledger.pending(windows, self.read("gold.run_ledger"), job).orderBy("window_start").collect():
            try:
                state, rows, message = ledger.DONE, build(window.window_start, window.window_end), None
            except (PySparkException, ValueError) as error:
                state, rows, message = ledger.FAILED, None, str(error)[:500]
            one = self.spark.createDataFrame([window], "window_start date, window_end date")
            told = ledger.records(one, job, F.lit(state), F.lit(rows), F.lit(message), self.now())
            tables.append(told, name)
        return ledger.latest_state(self.read("gold.run_ledger").where(F.col("job") == job))


def merge_load(spark: SparkSession, name: str, loads: DataFrame, key: str = "id", loaded_at: str = "load_at") -> int:
    """Merge loads into a kept table of versions, reading and rewriting only the partitions they can change.

    These are the buckets of their keys, of versions that are open or were closed on or after the day of the first load.
    Returns the number of rows written.
    """
    reach = loads.agg(
        F.collect_set(_key_bucket(key)).alias("buckets"), F.min(F.to_date(loaded_at)).alias("first"), F.count_if(F.col(loaded_at).isNull()).alias("unknown")
    ).first()
    if not reach["buckets"]:
        return 0
    first = "" if reach["unknown"] else f"{reach['first']}"

    def inside(partition: tables.Partition) -> bool:
        closed = partition["closed"]
        return int(partition["key_bucket"]) in reach["buckets"] and (closed == OPEN or closed >= first)

    closed = F.col("closed")
    stored = spark.table(name).where(F.col("key_bucket").isin(*reach["buckets"]) & ((closed == OPEN) | (closed >= first)))
    merged = with_place(merge_versions(stored.drop("closed", "key_bucket"), loads, key, loaded_at), key)
    return tables.replace_window(merged, name, ["closed", "key_bucket"], inside)
