"""Queries over the events: windowed quality as a table and as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.shared import EVENTS_COLUMNS, table
from catalog.structured import quality_sql
from plumbline.session import checkpoint_dir
from plumbline.sources.results import read_results
from plumbline.streaming.metrics import drop_repeats, window_freshness, window_metrics
from plumbline.streaming.runs import quality_stream
from plumbline.streaming.sinks import latest_rows, stream_rows, table_stream
from plumbline.streaming.sources import event_time, read_stream


def _gaps(events):
    """The events with small values missing and times as instants."""
    return event_time(events, "ts").withColumn("value", F.expr("CASE WHEN value < 2 THEN NULL ELSE value END"))


def _metrics(events, **options):
    return window_metrics(
        _gaps(events), "ts", ["value", "user_id"], {"large_value": F.col("value") > 40}, window="6 hours", **options
    )


def _rounded(metrics):
    rates = [c for c in metrics.columns if c.endswith("_rate")]
    kept = [c for c in metrics.columns if c not in rates]
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c.startswith("window_") else F.col(c) for c in kept]
    return metrics.select(*shown, *[F.round(c, 6).alias(c) for c in rates])


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    files = read_stream(spark, f"{sf_dir}/[e]vents.parquet", schema)
    return files


def _drained(spark, stream, mode):
    """Run a stream to its end into a table in the shared folder and give its rows."""
    base = f"{checkpoint_dir(spark)}/drained-{uuid.uuid4().hex}"
    table_stream(stream, f"{base}/rows", f"{base}/checkpoint", mode).awaitTermination()
    return stream_rows(spark, f"{base}/rows", stream.schema)


def window_metrics_events(spark, sf_dir):
    return _rounded(_metrics(table(spark, sf_dir, "events"), keys=("event_type",)))


def sliding_metrics_events(spark, sf_dir):
    return _rounded(_metrics(table(spark, sf_dir, "events"), slide="3 hours"))


def window_freshness_events(spark, sf_dir):
    fresh = window_freshness(table(spark, sf_dir, "events"), "ts", "2024-02-15", keys=("event_type",))
    return fresh.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type",
        F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest"), "age_days",
    )


def stream_window_metrics(spark, sf_dir):
    """The same windows from a stream that has read everything."""
    metrics = _metrics(_event_stream(spark, sf_dir), keys=("event_type",))
    rows = _drained(spark, metrics, "update")
    return _rounded(latest_rows(rows, ["window_start", "window_end", "event_type"]))


def stream_without_repeats(spark, sf_dir):
    """How many of each event type are left; the watermark spans the whole history here."""
    unique = drop_repeats(_event_stream(spark, sf_dir), ["user_id", "event_type"], "ts", "400 days")
    return _drained(spark, unique, "append").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def stream_batches(spark, sf_dir):
    """The windows when the events come in four batches that change them one after another."""
    base = f"{checkpoint_dir(spark)}/daily-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    parts = F.pmod(F.hash("user_id"), F.lit(4))
    # A file for each fourth of the users; every window is changed by each of them.
    events.withColumn("part", parts).repartition(4, "part").write.partitionBy("part").parquet(f"{base}/in")
    files = read_stream(spark, f"{base}/in/part=*", events.schema, max_files=1)
    metrics = _metrics(files, keys=("event_type",), delay="400 days")
    table_stream(metrics, f"{base}/rows", f"{base}/checkpoint", "update").awaitTermination()
    rows = stream_rows(spark, f"{base}/rows", metrics.schema)
    return _rounded(latest_rows(rows, ["window_start", "window_end", "event_type"]))


def stream_quality_runs(spark, sf_dir):
    """A quality record per micro-batch, read back from the result table."""
    base = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    query = quality_stream(
        event_time(_event_stream(spark, sf_dir), "ts"), "events", f"{base}/results", f"{base}/checkpoint", "2024-03-15"
    )
    query.awaitTermination()
    return read_results(spark, f"{base}/results").select("dataset_name", "run_id", "overall_score")


_GAPS = """WITH e AS (
  SELECT ts, user_id, event_type, CASE WHEN value < 2 THEN NULL ELSE value END AS value FROM events)"""
_RATES = """count(*) AS row_count, round(1 - count(value) / count(*), 6) AS value_null_rate,
  round(1 - count(user_id) / count(*), 6) AS user_id_null_rate,
  round(count(CASE WHEN value > 40 THEN 1 END) / count(*), 6) AS large_value_rate"""
_TUMBLING = f"""{_GAPS}
SELECT strftime(time_bucket(INTERVAL '6 hours', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours', '%Y-%m-%d %H:%M:%S') AS window_end,
  event_type, {_RATES} FROM e GROUP BY ALL"""

QUERIES = {
    "window_metrics_events": window_metrics_events,
    "sliding_metrics_events": sliding_metrics_events,
    "window_freshness_events": window_freshness_events,
    "stream_window_metrics": stream_window_metrics,
    "stream_batches": stream_batches,
    "stream_without_repeats": stream_without_repeats,
    "stream_quality_runs": stream_quality_runs,
}

SQL = {
    "window_metrics_events": _TUMBLING,
    "sliding_metrics_events": f"""{_GAPS},
s AS (
  SELECT e.*, time_bucket(INTERVAL '3 hours', ts) - step * INTERVAL '3 hours' AS w FROM e, (VALUES (0), (1)) AS k(step))
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL '6 hours', '%Y-%m-%d %H:%M:%S') AS window_end,
  {_RATES} FROM s GROUP BY w""",
    "window_freshness_events": """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest,
  date_diff('day', max(CAST(ts AS DATE)), DATE '2024-02-15') AS age_days FROM events GROUP BY 1, 2""",
    "stream_window_metrics": _TUMBLING,
    "stream_batches": _TUMBLING,
    "stream_without_repeats": """
SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type""",
    "stream_quality_runs": "SELECT dataset_name, 'events-000000000000' AS run_id, overall_score FROM ("
    + quality_sql("events", "SELECT * FROM events", EVENTS_COLUMNS, "2024-03-15")
    + ")",
}
