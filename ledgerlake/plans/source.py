"""Source tables from CSV exports."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, typed
from ..operators import quality
from ..schemas import SOURCE_CARDS, SOURCE_TRANSACTIONS, SOURCE_USERS, STAGED_TRANSACTIONS, conform, widened
from ..sources.files import read_csv


def type_transactions(staged: DataFrame, wide: bool = False) -> DataFrame:
    """Staged text to typed columns; rows without an id are left out."""
    numbers = ("id", "client_id", "card_id", "merchant_id", "mcc")
    texts = ("amount", "use_chip", "merchant_city", "merchant_state", "zip", "errors")
    moment = typed("date_time", "timestamp")
    columns = widened(SOURCE_TRANSACTIONS) if wide else SOURCE_TRANSACTIONS
    return conform(
        staged.where("id IS NOT NULL AND id != ''"),
        columns,
        {name: typed(name, columns[name]) for name in numbers}
        | {name: blank_to_null(name) for name in texts}
        | {"date_time": moment, "date": F.to_date(moment)},
    )


@dataclass(frozen=True)
class Source:
    users: DataFrame
    cards: DataFrame
    transactions: DataFrame

    def row_counts(self) -> DataFrame:
        return quality.row_counts({"users": self.users, "cards": self.cards, "transactions": self.transactions})

    def repeated_keys(self) -> DataFrame:
        """Primary keys that are not unique."""
        return _stack(
            {
                name: quality.repeated_keys(df, ["id"]).withColumnRenamed("id", "key")
                for name, df in self._tables().items()
            }
        )

    def orphans(self) -> DataFrame:
        """Foreign keys without a parent."""
        users, cards, txns = self.users, self.cards, self.transactions
        return _stack(
            {
                "cards.client_id": quality.orphans(cards, "client_id", users, "id"),
                "transactions.client_id": quality.orphans(txns, "client_id", users, "id"),
                "transactions.card_id": quality.orphans(txns, "card_id", cards, "id"),
            }
        )

    def rule_violations(self) -> DataFrame:
        """Rows that break a NOT NULL or CHECK rule."""
        return (
            quality.rule_violations(self.users, quality.user_rules())
            .unionByName(quality.rule_violations(self.cards, quality.card_rules()))
            .unionByName(quality.rule_violations(self.transactions, quality.transaction_rules()))
        )

    def _tables(self) -> dict[str, DataFrame]:
        return {"users": self.users, "cards": self.cards, "transactions": self.transactions}


def _stack(parts: Mapping[str, DataFrame]) -> DataFrame:
    labelled = [df.select(F.lit(name).alias("relation"), "key", "row_count") for name, df in parts.items()]
    result = labelled[0]
    for df in labelled[1:]:
        result = result.unionByName(df)
    return result


def load_source(spark: SparkSession, users: str, cards: str, transactions: str, wide: bool = False) -> Source:
    """Read the three CSV exports. Nothing is checked until a report of the result is asked for."""
    return Source(
        load_users(spark, users, wide), load_cards(spark, cards, wide), load_transactions(spark, transactions, wide)
    )


def load_users(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    return read_csv(spark, path, widened(SOURCE_USERS) if wide else SOURCE_USERS)


def load_cards(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    return read_csv(spark, path, widened(SOURCE_CARDS) if wide else SOURCE_CARDS)


def load_transactions(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    return type_transactions(read_csv(spark, path, STAGED_TRANSACTIONS), wide)
