"""Streams give what tables give, and a replayed batch counts once."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from plumbline.sources.results import read_results
from plumbline.streaming.metrics import count_late_rows, drop_repeats, window_freshness, window_metrics
from plumbline.streaming.runs import quality_stream, stored_stream_scores
from plumbline.streaming.sinks import compact, latest_rows, stream_rows, table_stream, write_batch
from plumbline.streaming.sources import event_time, read_stream

SCHEMA = "id int, ts timestamp_ntz, v double"


def rows(minutes):
    start = dt.datetime(2024, 1, 1)
    return [(i, start + dt.timedelta(minutes=m), None if i % 3 == 0 else float(i)) for i, m in enumerate(minutes)]


def write(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def drain(spark, stream, mode, folder):
    name = "t" + uuid.uuid4().hex
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name), query


def test_complete_stream_equals_table(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, rows([1, 5, 30, 61, 62, 200]))
    stream = read_stream(spark, path, spark.read.parquet(path).schema)
    metrics = lambda df: window_metrics(df, "ts", ["v"], {"big": F.col("v") > 3})
    got, _ = drain(spark, metrics(stream), "complete", tmp_path)
    want = metrics(spark.read.parquet(path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3


def test_append_keeps_the_last_window_open(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, rows([1, 61, 135]))
    stream = read_stream(spark, path, spark.read.parquet(path).schema)
    got, _ = drain(spark, window_freshness(stream, "ts", "2024-01-11", window="1 hour"), "append", tmp_path)
    assert [(r.window_start.hour, r.age_days) for r in got.orderBy("window_start").collect()] == [(0, 10), (1, 10)]


def test_repeats_within_the_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, [(1, dt.datetime(2024, 1, 1, 0, m), 1.0) for m in (0, 1, 2)] + [(2, dt.datetime(2024, 1, 1), 1.0)])
    stream = read_stream(spark, path, spark.read.parquet(path).schema)
    got, _ = drain(spark, drop_repeats(stream, ["id"], "ts"), "append", tmp_path)
    assert sorted(r.id for r in got.collect()) == [1, 2]


def test_late_rows_are_counted(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, rows([1]))
    schema = spark.read.parquet(path).schema
    # Spark drops by the watermark of the batch before, so it needs one batch to move.
    for minute in (600, 601, 2, 602, 3, 603, 604, 605):
        write(spark, path, rows([minute]))
    stream = read_stream(spark, path, schema, max_files=1)
    # The query itself remembers two batches only.
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    late = count_late_rows(spark)
    try:
        _, query = drain(spark, window_metrics(stream, "ts", ["v"]), "append", tmp_path)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert late.of(query) == 2
    finally:
        spark.streams.removeListener(late)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_quality_per_batch(spark, tmp_path):
    path, store = str(tmp_path / "in"), str(tmp_path / "results")
    write(spark, path, rows([1, 2, 3]))
    stream = event_time(read_stream(spark, path, spark.read.parquet(path).schema), "ts")
    for _ in range(2):
        quality_stream(stream, "s", store, str(tmp_path / "ck"), "2024-01-02").awaitTermination()
    write(spark, path, rows([4]))
    quality_stream(stream, "s", store, str(tmp_path / "ck"), "2024-01-02").awaitTermination()
    # A run that lost its checkpoint replays everything into the first batch's partition.
    scores = stored_stream_scores(read_results(spark, store)).collect()
    assert [r.run_id for r in scores] == ["s-000000000000", "s-000000000001"]


def test_changed_windows_are_merged_and_replayed_batches_count_once(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for minutes in ([1, 5, 61], [30, 62], [2, 200], [63]):
        write(spark, path, rows(minutes))
    schema = spark.read.parquet(path).schema
    metrics = lambda df: window_metrics(df, "ts", ["v"], {"big": F.col("v") > 0}, delay="1 day")
    stream = metrics(read_stream(spark, path, schema, max_files=1))
    assert stream_rows(spark, out, stream.schema).count() == 0
    table_stream(stream, out, str(tmp_path / "ck"), "update").awaitTermination()
    keys = ["window_start", "window_end"]
    written = stream_rows(spark, out, stream.schema)
    want = sorted(map(tuple, metrics(spark.read.parquet(path)).collect()))
    assert sorted(map(tuple, latest_rows(written, keys).collect())) == want
    assert len({r.batch_id for r in written.collect()}) == 4 and written.count() > len(want) == 3
    # The last batch once more, as after a failure between its write and its commit.
    again = spark.createDataFrame(written.where("batch_id = 3").drop("batch_id").collect(), stream.schema)
    before = written.count()
    write_batch(again, 3, out)
    written = stream_rows(spark, out, stream.schema)
    assert written.count() == before and sorted(map(tuple, latest_rows(written, keys).collect())) == want
    compact(spark, out, keys, stream.schema, str(tmp_path / "small"))
    small = stream_rows(spark, str(tmp_path / "small"), stream.schema)
    assert sorted(map(tuple, small.drop("batch_id").collect())) == want


def test_format_is_checked(spark):
    with pytest.raises(ValueError):
        read_stream(spark, "x", SCHEMA, "csv")
