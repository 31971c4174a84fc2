"""Readers and writers on files in a temporary folder."""

import datetime as dt
import json

import pytest

from ledgerlake import schemas
from ledgerlake.plans import bronze, latest, source
from ledgerlake.schemas import TABLES, ddl
from ledgerlake.sinks import tables
from ledgerlake.sources import files, jdbc
from ledgerlake.workspace import shared_folder
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

STAMP = dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture()
def database(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}"
    tables.create_database(spark, name, str(tmp_path / "db"), "for a test")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


# ------------------------------------------------------------------ files


def test_csv_tells_empty_text_from_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        'id,date_time,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors\n'
        '1,2010-01-01 00:01:00,5,6,$-77.00,Swipe,59935,"Beulah, ""ND""",ND,58523.0,5499,\n'
        '"",2010-01-01 00:02:00,5,6,$1.00,Swipe,1,x,ND,1,1,\n'
        ',2010-01-01 00:02:00,5,6,$1.00,Swipe,1,x,ND,1,1,\n'
        '2,,x,,"","",,"",,,oops,"Bad PIN,"\n'
    )
    staged = files.read_csv(spark, str(tmp_path / "t.csv"), schemas.STAGED_TRANSACTIONS)
    assert [r.id for r in staged.collect()] == ["1", "", None, "2"]
    got = source.type_transactions(staged)
    assert dict(got.dtypes) == schemas.SOURCE_TRANSACTIONS
    first, second = (r.asDict() for r in got.orderBy("id").collect())
    assert first["merchant_city"] == 'Beulah, "ND"' and first["errors"] is None and first["zip"] == "58523.0"
    assert first["date"] == dt.date(2010, 1, 1) and first["date_time"] == dt.datetime(2010, 1, 1, 0, 1)
    assert second == {name: None for name in second} | {"id": 2, "errors": "Bad PIN,"}


def test_load_source_reports(spark, tmp_path):
    (tmp_path / "u.csv").write_text(
        ",".join(schemas.SOURCE_USERS) + "\n"
        "1,33,66,1990,1,Male,a,34.15,-117.76,$29278,$59696,$127613,787,5\n"
        "1,,66,1990,1,Other,a,,,,,,,\n"
        "2,40,66,1990,1,,a,,,,,,,\n"
    )
    (tmp_path / "c.csv").write_text(
        ",".join(schemas.SOURCE_CARDS) + "\n"
        "10,1,Visa,Debit,1,12/2022,1,YES,2,$24295,09/2002,2008,No\n"
        "11,9,Visa,Debit,1,12/2022,1,YES,2,,09/2002,2008,No\n"
        "12,,Visa,Debit,1,12/2022,1,YES,2,,09/2002,2008,No\n"
    )
    (tmp_path / "t.csv").write_text(
        ",".join(schemas.STAGED_TRANSACTIONS) + "\n"
        "100,2010-01-01 00:01:00,1,10,$1,,,,,,,\n101,,9,77,$1,,,,,,,\n102,2010-01-01 00:01:00,9,,$1,,,,,,,\n"
    )
    loaded = source.load_source(spark, *(str(tmp_path / f"{n}.csv") for n in "uct"))
    rows = lambda df: {tuple(r) for r in df.collect()}
    assert rows(loaded.row_counts()) == {("users", 3), ("cards", 3), ("transactions", 3)}
    assert rows(loaded.repeated_keys()) == {("users", 1, 2)}
    assert rows(loaded.orphans()) == {
        ("cards.client_id", 9, 1), ("transactions.client_id", 9, 2), ("transactions.card_id", 77, 1),
    }
    assert rows(loaded.rule_violations()) == {
        ("users_age_present", 1), ("users_gender_known", 1), ("cards_client_present", 1),
        ("transactions_time_present", 1), ("transactions_client_present", 0), ("transactions_card_present", 1),
    }


def test_mcc_object(spark, tmp_path):
    path = tmp_path / "mcc_codes.json"
    path.write_text(json.dumps({"5812": "Eating, \"Places\"", "4829": "Money Transfer"}, indent=2))
    got = bronze.ingest_mcc(spark, str(path), F.lit(STAMP))
    assert dict(got.dtypes) == schemas.BRONZE_MCC_CODES
    assert {tuple(r) for r in got.collect()} == {
        (5812, 'Eating, "Places"', "mcc_codes.json", STAMP), (4829, "Money Transfer", "mcc_codes.json", STAMP),
    }


@pytest.mark.parametrize("indent", [None, 1])
def test_label_layouts_agree(spark, tmp_path, indent):
    labels = {str(k): "Yes" if k % 7 == 0 else "No" for k in range(1, 3000)}
    path = tmp_path / "labels.json"
    path.write_text(json.dumps({"target": labels}, indent=indent) + "\n")
    lines = tmp_path / "labels.jsonl"
    lines.write_text("\n".join(json.dumps({"transaction_id": int(k), "is_fraud": v}) for k, v in labels.items()))
    # Small splits, so that the one object is cut between many tasks.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        flat = bronze.ingest_labels(spark, str(path), F.lit(STAMP))
        assert flat.rdd.getNumPartitions() > 4
        want = {(int(k), v, "labels.json", STAMP) for k, v in labels.items()}
        assert {tuple(r) for r in flat.collect()} == want and flat.count() == len(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    nested = bronze.ingest_labels(spark, str(path), F.lit(STAMP), layout="object")
    assert {tuple(r) for r in nested.collect()} == want
    from_lines = bronze.ingest_labels(spark, str(lines), F.lit(STAMP), layout="lines")
    assert {tuple(r)[:2] for r in from_lines.collect()} == {w[:2] for w in want}
    assert {r.file_name for r in from_lines.collect()} == {"labels.jsonl"}


@pytest.mark.parametrize("text", ['{"target": {}}', "{}", ' { "target" : { } } \n'])
def test_no_labels(spark, tmp_path, text):
    path = tmp_path / "labels.json"
    path.write_text(text)
    assert bronze.ingest_labels(spark, str(path)).isEmpty()
    assert bronze.ingest_labels(spark, str(path), layout="object").isEmpty()


@pytest.mark.parametrize(
    "text",
    [
        '{"target": {"1": "a\\"b", "2": "No"}}',
        '{"target": {"1": null, "2": "No"}}',
        '{"meta": {"1": "No"}, "target": {"2": "No"}}',
        '{"target": {"1": "No" , "2": "No"}}',
        '{"target": {"1": {"x": "No"}}}',
    ],
)
def test_unusual_label_object_stops_the_flat_reader(spark, tmp_path, text):
    path = tmp_path / "labels.json"
    path.write_text(text)
    with pytest.raises(PySparkException, match="not a plain label entry"):
        bronze.ingest_labels(spark, str(path)).collect()
    assert not bronze.ingest_labels(spark, str(path), layout="object").isEmpty()


def test_missing_target_gives_no_rows(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text('{"other": {"1": "No"}}')
    assert bronze.ingest_labels(spark, str(path), layout="object").isEmpty()


def test_jdbc_options():
    split = jdbc.Split("id", 0, 1_000_000, 64)
    assert jdbc.scan_options(split) == {
        "fetchsize": "10000", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000000", "numPartitions": "64",
    }
    assert jdbc.scan_options(None) == {"fetchsize": "10000"}


def test_ingest_table(spark):
    row = (1, dt.datetime(2019, 12, 31, 23), dt.date(2019, 12, 31), 1, 2, "$1", None, 3, None, None, None, 4, None)
    typed = spark.createDataFrame([row], ddl(schemas.SOURCE_TRANSACTIONS))
    got = bronze.ingest_table(typed, "transactions", F.lit(STAMP))
    assert dict(got.dtypes) == schemas.BRONZE_TRANSACTIONS
    assert (got.first().date_partition, got.first().load_at) == ("2019-12", STAMP)


# ------------------------------------------------------------------ catalog tables


@pytest.mark.parametrize("table", sorted(TABLES))
def test_declared_tables(spark, database, table):
    name = f"{database}.{table.replace('.', '_')}"
    tables.create_declared(spark, table, name)
    tables.create_declared(spark, table, name)
    columns, partitions = TABLES[table]
    assert dict(spark.table(name).dtypes) == columns
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == partitions


def test_append_matches_by_name_and_overwrite_rows_by_declared_order(spark, database):
    name = f"{database}.codes"
    tables.create_table(spark, name, {"code": "int", "text": "string"})
    tables.append(spark.createDataFrame([("a", 1)], "text string, code int"), name)
    tables.append(spark.createDataFrame([("b", 2)], "text string, code int"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b")]
    tables.overwrite_rows(spark.createDataFrame([("c", 3)], "text string, code int"), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(3, "c")]
    tables.overwrite(spark.createDataFrame([(4,)], "other int"), name)
    assert spark.table(name).columns == ["other"]


def test_overwrite_at_a_location(spark, database, tmp_path):
    tables.overwrite(spark.range(3), f"{database}.placed", str(tmp_path / "placed"))
    assert spark.read.parquet(str(tmp_path / "placed")).count() == 3


def test_replace_partitions(spark, database):
    name, parts = f"{database}.days", ["year", "month"]
    tables.create_table(spark, name, {"v": "int", "year": "int", "month": "int"}, parts)
    before = spark.conf.get(tables.DYNAMIC)
    first = spark.createDataFrame([(1, 2019, 1), (2, 2019, 2), (3, 2020, 1)], "v int, year int, month int")
    tables.replace_partitions(first, name, parts)
    again = spark.createDataFrame([(2019, 2, 20), (2019, 2, 21), (2021, 5, 5)], "year int, month int, v int")
    for _ in range(2):
        watched, watch = tables.counted(again)
        tables.replace_partitions(watched, name, parts)
        assert watch.get["row_count"] == 3
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 3, 5, 20, 21]
    assert spark.conf.get(tables.DYNAMIC) == before


def test_a_hot_partition_is_written_as_several_files(spark, database, tmp_path):
    name = f"{database}.hot"
    tables.create_table(spark, name, {"v": "bigint", "day": "int"}, ["day"], str(tmp_path / "hot"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 120_000, 1, 8).select((F.rand(1) * 1e18).cast("bigint").alias("v"), F.lit(1).alias("day"))
        tables.replace_partitions(df, name, ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "day=1").glob("*.parquet"))) > 3
    assert spark.table(name).count() == 120_000


def test_bucketed_tables_join_without_exchange(spark, database):
    left, right = f"{database}.l", f"{database}.r"
    tables.write_bucketed(spark.range(100).withColumnRenamed("id", "k"), left, 4, "k")
    tables.write_bucketed(spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("one")), right, 4, "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(left).join(spark.table(right), "k", "left")
        assert joined.where("one = 1").count() == 50
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fixed_files_and_view(spark, tmp_path):
    tables.fixed_files(spark.range(100), 4).write.parquet(str(tmp_path / "four"))
    assert len(list((tmp_path / "four").glob("*.parquet"))) == 4
    tables.create_view(spark.range(2), "two_rows")
    assert spark.table("two_rows").count() == 2


def test_latest_day_view_follows_the_table(spark, database):
    import facts

    rows = facts.random_fact(3, n=60)
    fact = facts.frame(spark, rows).withColumns(
        {"card_brand": F.lit("V"), "card_type": F.lit("D"), "txn_use_chip": F.lit(True)}
    )
    tables.overwrite(fact, f"{database}.detail")
    latest.create_latest_day_view(spark, f"{database}.vw", f"{database}.detail")
    want = latest.latest_day_summary(fact).collect()
    assert spark.table(f"{database}.vw").collect() == want
    later = facts.Row(rows[0], txn_date_time=dt.datetime(2030, 1, 1), transaction_id=1)
    more = facts.frame(spark, [later]).select(*(c for c in facts.frame(spark, rows).columns))
    tables.append(more.withColumns({"card_brand": F.lit("V"), "card_type": F.lit("D"), "txn_use_chip": F.lit(True)}),
                  f"{database}.detail")
    assert [r.txn_date for r in spark.table(f"{database}.vw").collect()] == [dt.date(2030, 1, 1)]


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(base) and first != second


def _stops(df):
    with pytest.raises(Exception):  # noqa: B017, PT011
        df.collect()


def test_broken_files_stop_the_job(spark, tmp_path):
    def file(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    for name, text in (("cut.json", '{"5411": "Groc'), ("array.json", '[{"1": "a"}]'), ("words.json", "no json")):
        _stops(files.read_json_object(spark, file(name, text)))
    for name, text in (("cut_labels.json", '{"target": {"1": "Yes", "2": "No", "3": "N'), ("twice.json", '{"target": {"1": "Yes"}}{"target": {"2": "No"}}')):
        _stops(files.read_flat_label_object(spark, file(name, text)))
    columns = {"a": "int", "b": "string"}
    _stops(files.read_json_lines(spark, file("cut.jsonl", '{"a": 1, "b": "x"}\n{"a": 2, "b'), columns))
    _stops(files.read_csv(spark, file("word.csv", "a,b\n1,x\none,y\n"), columns))
    _stops(files.read_csv(spark, file("short.csv", "a,b\n1,x\n2\n"), columns))
    broken_line = file("line.csv", 'a,b\n1,"x\ny"\n')
    assert [tuple(r) for r in files.read_csv(spark, broken_line, columns, multi_line=True).collect()] == [(1, "x\ny")]


def test_empty_files_have_no_rows(spark, tmp_path):
    (tmp_path / "empty.json").write_text("\n")
    assert files.read_json_object(spark, str(tmp_path / "empty.json")).count() == 0
