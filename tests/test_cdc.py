"""Landing of change records: same rows as the batch projection, no repeats after a restart."""

import datetime as dt

import pytest

from ledgerlake.schemas import BRONZE_CDC
from ledgerlake.streaming.cdc import LandedRows, envelope, land_cdc

SCHEMA = "key binary, value binary, offset bigint, timestamp timestamp"


def records(start, n):
    good = [
        (
            str(i).encode(),
            f'{{"op":"u","ts_ms":{1000 + i},"after":{{"name":"Zoë"}}}}'.encode(),
            i,
            dt.datetime(2024, 1, 1, 0, 0, i % 60),
        )
        for i in range(start, start + n)
    ]
    return good + [(None, b"not json", start + n, None), (b"k", None, start + n + 1, None)]


def drop_file(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(str(folder))


BUSINESS = [c for c in BRONZE_CDC if not c.startswith("ingestion")]


def landed(spark, path):
    return sorted(map(str, spark.read.parquet(str(path)).select(*BUSINESS).collect()))


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    source, table, checkpoint = tmp_path / "topic", tmp_path / "table", tmp_path / "checkpoint"
    drop_file(spark, records(0, 50), source)
    watch = LandedRows()
    spark.streams.addListener(watch)

    def land():
        query = land_cdc(stream(spark, source), str(table), str(checkpoint), once=True)
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return watch.of(query)

    def batch():
        return sorted(map(str, envelope(spark.read.parquet(str(source))).select(*BUSINESS).collect()))

    assert land() == 52
    assert landed(spark, table) == batch()
    assert land() == 0
    assert landed(spark, table) == batch()
    drop_file(spark, records(100, 5), source)
    assert land() == 7
    assert landed(spark, table) == batch()
    assert len(list(table.glob("ingestion_date=*"))) >= 1
    spark.streams.removeListener(watch)


def test_rows_are_counted_over_more_batches_than_spark_reports(spark, tmp_path):
    for k in range(4):
        drop_file(spark, records(10 * k, 1), tmp_path / "topic")
    watch, kept = LandedRows(), spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.streams.addListener(watch)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "topic"))
        query = land_cdc(rows, str(tmp_path / "table"), str(tmp_path / "checkpoint"), once=True)
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        assert watch.of(query) == len(landed(spark, tmp_path / "table")) == 12
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
        spark.streams.removeListener(watch)


def test_envelope_values(spark):
    got = envelope(spark.createDataFrame(records(3, 1), SCHEMA))
    assert dict(got.dtypes) == BRONZE_CDC
    good, broken, empty = got.orderBy("kafka_offset").select(*BUSINESS).collect()
    assert (good.kafka_key, good.operation, good.cdc_timestamp) == ("3", "u", 1003)
    assert "Zoë" in good.cdc_payload
    assert (broken.cdc_payload, broken.operation, broken.cdc_timestamp) == ("not json", None, None)
    assert (empty.kafka_key, empty.cdc_payload, empty.operation) == ("k", None, None)


def test_landing_in_a_catalog_table(spark, tmp_path):
    drop_file(spark, records(0, 4), tmp_path / "topic")
    name = "cdc_landing_users"
    query = land_cdc(
        stream(spark, tmp_path / "topic"), str(tmp_path / "table"), str(tmp_path / "checkpoint"), table=name, once=True
    )
    query.awaitTermination()
    try:
        assert spark.table(name).count() == 6
        assert dict(spark.table(name).dtypes) == BRONZE_CDC
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_timed_trigger(spark, tmp_path):
    drop_file(spark, records(0, 4), tmp_path / "topic")
    query = land_cdc(
        stream(spark, tmp_path / "topic"), str(tmp_path / "table"), str(tmp_path / "checkpoint"), every="1 second"
    )
    try:
        query.processAllAvailable()
        assert len(landed(spark, tmp_path / "table")) == 6
    finally:
        query.stop()


def test_checkpoint_inside_the_table_is_refused(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    with pytest.raises(ValueError, match="outside"):
        land_cdc(stream(spark, tmp_path / "topic"), str(tmp_path / "t"), str(tmp_path / "t" / "_checkpoint"))


@pytest.mark.parametrize("spelling", ["{t}", "file://{t}", "file:{t}/", "{t}/x/.."])
def test_checkpoint_in_the_same_place_is_refused(spark, tmp_path, spelling):
    (tmp_path / "topic").mkdir()
    with pytest.raises(ValueError, match="outside"):
        land_cdc(stream(spark, tmp_path / "topic"), str(tmp_path / "t"), spelling.format(t=tmp_path / "t"))
