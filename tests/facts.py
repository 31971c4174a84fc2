"""A small random fact, and the summaries computed row by row in plain Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

SCHEMA = (
    "transaction_id bigint, client_id int, merchant_id int, merchant_city string, merchant_state string, mcc int, "
    "txn_amount decimal(18,4), txn_date_time timestamp, is_fraud boolean, is_error boolean"
)
NAMES = [entry.split()[0] for entry in SCHEMA.split(", ")]


class Row(dict):
    __getattr__ = dict.__getitem__


def random_fact(seed: int, n: int = 400, days: int = 130) -> list[Row]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        rows.append(
            Row(
                transaction_id=rng.choice([i, i, i, None]),
                client_id=rng.choice([None, 1, 2, 3, 4, 5, 6]),
                merchant_id=7 if hot else rng.choice([None, 1, 2, 3, 4]),
                merchant_city=rng.choice(["x", "y", None]),
                merchant_state=rng.choice(["s", None]),
                mcc=rng.choice([None, 10, 20, 30]),
                txn_amount=rng.choice([None, Decimal("0.0000"), Decimal(rng.randint(-500000, 500000)) / 10000]),
                # Days are bunched so that some are empty and months have gaps for some merchants.
                txn_date_time=dt.datetime(2019, 1, 20)
                + dt.timedelta(days=rng.choice([rng.randrange(days), rng.randrange(0, days, 7)]), hours=rng.randrange(24)),
                is_fraud=rng.random() < 0.2,
                is_error=rng.random() < 0.2,
            )
        )
    return rows


def frame(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], SCHEMA)
    return df.withColumns(
        {
            "txn_hour": F.hour("txn_date_time"),
            "txn_year": F.year("txn_date_time"),
            "txn_month": F.month("txn_date_time"),
            "txn_day": F.dayofmonth("txn_date_time"),
        }
    )


def day(row) -> dt.date:
    return row.txn_date_time.date()


def month(row) -> dt.date:
    return day(row).replace(day=1)


def cents(value) -> Decimal:
    return Decimal(value).quantize(Decimal("0.01"), ROUND_HALF_UP)


def amounts(rows) -> list[Decimal]:
    return [r.txn_amount for r in rows if r.txn_amount is not None]


def total(values) -> Decimal:
    return cents(sum(values, Decimal(0)))


def distinct(rows, name) -> int:
    return len({r[name] for r in rows if r[name] is not None})


def top(rows, name, counted=None):
    counts = defaultdict(int)
    for r in rows:
        counts[r[name]] += 1 if counted is None or r[counted] is not None else 0
    return min(((-n, k is None, k if k is not None else 0), k) for k, n in counts.items())[0]


def grouped(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return groups


def market_daily(rows, start, end):
    by_day = grouped(rows, day)
    first = {}
    for r in rows:
        if r.client_id is not None:
            first[r.client_id] = min(first.get(r.client_id, day(r)), day(r))
    out = {}
    for date, group in by_day.items():
        if not start <= date <= end:
            continue
        values = amounts(group)
        record = {
            "txn_total_amt": total(values),
            "txn_pos_amt": total(v for v in values if v >= 0),
            "txn_neg_amt": total(-v for v in values if v < 0),
            "txn_avg_amt": cents((sum(values) / len(values)).quantize(Decimal("1e-8"), ROUND_HALF_UP)) if values else cents(0),
            "txn_total_cnt": sum(r.transaction_id is not None for r in group),
            "txn_pos_cnt": sum(v >= 0 for v in values),
            "txn_neg_cnt": sum(v < 0 for v in values),
            "txn_fraud_cnt": sum(r.is_fraud for r in group),
            "txn_error_cnt": sum(r.is_error for r in group),
            "client_unique_cnt": distinct(group, "client_id"),
            "merchant_active_cnt": distinct(group, "merchant_id"),
            "client_new_cnt": sum(f == date for f in first.values()),
        }
        for k in (1, 7, 30):
            before = by_day.get(date - dt.timedelta(days=k), [])
            record[f"prev_{k}d_amt"] = total(amounts(before))
            record[f"prev_{k}d_cnt"] = sum(r.transaction_id is not None for r in before)
        n, unknown, key = top(group, "mcc", "transaction_id")
        record["merchant_top_mcc"], record["merchant_top_mcc_cnt"] = 0 if unknown else key, -n
        hours = [Row(r, hour=r.txn_date_time.hour) for r in group]
        n, _, key = top(hours, "hour", "transaction_id")
        record["peak_hour"], record["peak_hour_cnt"] = key, -n
        out[date] = record
    return out


def merchant_monthly(rows, start, end):
    """Month by month, as a run per month would do it."""
    out = {}
    month_start = start.replace(day=1)
    while month_start <= end:
        following = (month_start + dt.timedelta(days=31)).replace(day=1)
        month_end = min(following - dt.timedelta(days=1), end)
        previous = (month_start - dt.timedelta(days=1)).replace(day=1)
        history = {(r.merchant_id, r.client_id) for r in rows if day(r) < month_start}
        inside = [r for r in rows if month_start <= day(r) <= month_end]
        for merchant, group in grouped(inside, lambda r: r.merchant_id).items():
            values = amounts(group)
            before = [r for r in rows if previous <= day(r) < month_start and r.merchant_id == merchant]
            before = [] if merchant is None else before
            clients = {r.client_id for r in group} if merchant is not None else set()
            seen = {c for c in clients if c is not None and (merchant, c) in history}
            out[(0 if merchant is None else merchant, month_start)] = {
                "active_city_cnt": distinct(group, "merchant_city"),
                "active_state_cnt": distinct(group, "merchant_state"),
                "active_mcc_cnt": distinct(group, "mcc"),
                "rev_total": total(values),
                "rev_positive": total(v for v in values if v > 0),
                "rev_negative": total(-v for v in values if v < 0),
                "txn_total_amt": total(abs(v) for v in values),
                "txn_total_cnt": len(group),
                "txn_positive_cnt": sum(v > 0 for v in values),
                "txn_negative_cnt": sum(v < 0 for v in values),
                "prev_rev_total": total(amounts(before)),
                "prev_rev_positive": total(v for v in amounts(before) if v > 0),
                "prev_txn_total_cnt": len(before),
                "prev_txn_positive_cnt": sum(v > 0 for v in amounts(before)),
                "fraud_txn_cnt": sum(r.is_fraud for r in group),
                "error_txn_cnt": sum(r.is_error for r in group),
                "unique_client_cnt": distinct(group, "client_id"),
                "new_client_cnt": len(clients - seen),
                "returning_client_cnt": len(seen),
            }
        month_start = following
    return out


def user_lifetime(rows):
    out = {}
    for client, group in grouped(rows, lambda r: r.client_id).items():
        values = amounts(group)
        n, unknown, key = top(group, "merchant_id")
        first, last = min(map(day, group)), max(map(day, group))
        out[client] = {
            "total_txn_amt": total(values),
            "total_pos_amt": total(v for v in values if v > 0),
            "total_neg_amt": total(-v for v in values if v < 0),
            "total_txn": len(group),
            "total_txn_pos": sum(v > 0 for v in values),
            "total_txn_neg": sum(v < 0 for v in values),
            "total_txn_fraud": sum(r.is_fraud for r in group),
            "total_txn_error": sum(r.is_error for r in group),
            "lifetime_first_date": first,
            "lifetime_last_date": last,
            "lifetime_days": (last - first).days,
            "merchant_unique_cnt": distinct(group, "merchant_id"),
            "merchant_top_id": 0 if unknown else key,
            "merchant_top_txn_cnt": -n,
            "mcc_unique_cnt": distinct(group, "mcc"),
            "city_unique_cnt": distinct(group, "merchant_city"),
            "state_unique_cnt": distinct(group, "merchant_state"),
        }
    return out
