"""Quality metrics per event-time window. Each works on a stream and on a table alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.streaming import StreamingQueryListener

from plumbline.config import as_of_column
from plumbline.operators.columns import nullable_value
from plumbline.streaming.sources import event_time


def _windowed(df: DataFrame, ts: str, window: str, delay: str | None, keys: tuple[str, ...], slide: str | None):
    timed = event_time(df, ts)
    if df.isStreaming and delay is not None:
        timed = timed.withWatermark(ts, delay)
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    return timed.groupBy(span, *keys)


def _unpacked(aggregated: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    rest = [c for c in aggregated.columns if c != "window" and c not in keys]
    return aggregated.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *rest
    )


def window_metrics(
    df: DataFrame,
    ts: str,
    columns: list[str],
    bad: dict[str, Column] | None = None,
    window: str = "1 hour",
    delay: str | None = "10 minutes",
    keys: tuple[str, ...] = (),
    slide: str | None = None,
) -> DataFrame:
    """Row count, null rate of each column and rate of each ``bad`` condition per window.

    All are sums, so the state holds one small row per open window and key.
    """
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for c in columns:
        present = F.count(nullable_value(F.col(c), df.schema[c].dataType))
        aggregates.append((1 - present / F.count(F.lit(1))).alias(f"{c}_null_rate"))
    for name, condition in (bad or {}).items():
        aggregates.append((F.count_if(condition) / F.count(F.lit(1))).alias(f"{name}_rate"))
    return _unpacked(_windowed(df, ts, window, delay, keys, slide).agg(*aggregates), keys)


def window_freshness(
    df: DataFrame,
    ts: str,
    as_of=None,
    window: str = "1 day",
    delay: str | None = "10 minutes",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Newest event of each window and its age in whole days."""
    newest = _windowed(df, ts, window, delay, keys, None).agg(F.max(ts).alias("latest"))
    return _unpacked(newest, keys).withColumn(
        "age_days", F.datediff(F.to_date(as_of_column(as_of)), F.to_date("latest")).cast("bigint")
    )


def drop_repeats(df: DataFrame, keys: list[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """The stream without rows whose keys were seen within the watermark; state expires with it."""
    timed = event_time(df, ts)
    if not df.isStreaming:
        return timed.dropDuplicates(keys)
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


class LateRows(StreamingQueryListener):
    """Rows that queries drop behind their watermarks, summed over every batch.

    Progress kept on a query reaches back a limited number of batches; a
    listener sees each one. Register it before the queries start.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query) -> int:
        """Rows the query has dropped so far, over restarts in this session too."""
        return self.dropped.get(str(query.id), 0)


def count_late_rows(spark: SparkSession) -> LateRows:
    """A registered listener that counts late rows from now on."""
    listener = LateRows()
    spark.streams.addListener(listener)
    return listener
