"""Version closing against a row-by-row rule, with ties and identical copies."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from ledgerlake.operators import versions
from ledgerlake.operators.versions import close_versions
from pyspark.sql import functions as F

DAY = dt.datetime(2020, 1, 1)
SCHEMA = "id int, name string, load_at timestamp"


def rows_for(seed):
    rng = random.Random(seed)
    rows = []
    for key in [None, 1, 2, 3, 4]:
        for _ in range(rng.randint(1, 12)):
            rows.append((key, rng.choice(["a", "b", None]), rng.choice([DAY + dt.timedelta(rng.randint(0, 4)), None])))
    # One key holds a third of the rows, most of them identical copies.
    rows += [(9, "hot", DAY)] * 20 + [(9, "hot", DAY + dt.timedelta(1))]
    return rows


def expected(rows, fingerprint):
    """Per key in (load, fingerprint) order: each row closes at the load time of the next."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = Counter()
    for group in groups.values():
        group.sort(key=lambda r: (r[2] is not None, r[2] or DAY, fingerprint[r[1]]))
        for row, following in zip(group, [*group[1:], None]):
            valid_to = following[2] if following else None
            out[(*row, valid_to, valid_to is None)] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_row_by_row_rule(spark, seed, monkeypatch):
    monkeypatch.setattr(versions, "COPIES_PER_TASK", 3)
    rows = rows_for(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    prints = {r[0]: r[1] for r in df.select("name", F.xxhash64("name", F.isnull("name"))).distinct().collect()}
    got = close_versions(df, "id", "load_at")
    seen = Counter(tuple(r) for r in got.select("id", "name", "load_at", "valid_to", "is_current").collect())
    assert seen == expected(rows, prints)


def test_one_current_row_per_key_and_no_overlap(spark):
    rows = [r for r in rows_for(5) if r[2] is not None]
    got = close_versions(spark.createDataFrame(rows, SCHEMA), "id", "load_at")
    per_key = got.groupBy("id").agg(F.count_if("is_current").alias("n"), F.count("*").alias("rows"))
    assert {r.n for r in per_key.collect()} == {1}
    assert got.count() == len(rows)
    assert got.where("valid_to < valid_from").isEmpty()


def test_current_key_is_not_shared(spark):
    """A fact joins on (id, key) of the current row; no other row may carry the same pair."""
    rows = [r for r in rows_for(7) if r[2] is not None]
    got = close_versions(spark.createDataFrame(rows, SCHEMA), "id", "load_at")
    current = got.where("is_current").select("id", "version_key")
    shared = got.join(current, ["id", "version_key"]).groupBy("id", "version_key").count().where("count > 1")
    assert shared.isEmpty()


def test_hot_key_is_reduced_before_the_window(spark):
    """The window input must hold one row per load, not the rows of the key."""
    df = spark.createDataFrame(rows_for(1), SCHEMA)
    plan = close_versions(df, "id", "load_at")._jdf.queryExecution().optimizedPlan().toString()
    window = plan.split("Window", 1)[1].split("\n", 2)[1]
    assert "Aggregate" in window


def test_where_a_null_stands_tells_rows_apart(spark):
    """Two rows of one load that differ only in which column is NULL: one of them is closed."""
    rows = [(1, None, "5", "2020-01-01"), (1, "5", None, "2020-01-01"), (2, None, None, "2020-01-01")]
    df = spark.createDataFrame(rows, "id int, a string, b string, load_at string").withColumn("load_at", F.to_timestamp("load_at"))
    got = close_versions(df, "id", "load_at")
    assert sorted((r.id, r.n) for r in got.groupBy("id").agg(F.count_if("is_current").alias("n")).collect()) == [(1, 1), (2, 1)]
    assert got.select("id", "version_key").distinct().count() == 3
