"""Streams written to tables, every batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Put a batch in the partition of its id; one that is replayed replaces what it wrote before."""
    (
        batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def table_stream(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Start writing ``stream`` to a table with a partition per batch.

    In append mode the table holds the rows of the stream. In update mode a batch
    holds the windows that it changed, and :func:`latest_rows` gives each as it stands
    last. Nothing goes through the driver. ``trigger`` are the
    arguments of the writer's trigger, by default all that is available.
    """
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, path))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows of a table of :func:`table_stream`, with their ``batch_id``; none if nothing was written yet.

    ``schema`` is that of the stream.
    """
    # The folder exists, if empty, before the first batch.
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    fields = [*schema.fields, *spark.range(0).select(F.col("id").alias(BATCH)).schema.fields]
    return spark.read.schema(type(schema)(fields)).parquet(path)


def latest_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the row of the last batch that changed it; two are combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys and c != BATCH]
    last = F.max_by(F.struct(*rest), BATCH).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*").select(*[c for c in rows.columns if c != BATCH])


def compact(spark: SparkSession, path: str, keys: list[str], schema, target: str) -> None:
    """Write the latest row of each key as one batch to ``target``, for a table of many small batches."""
    rows = stream_rows(spark, path, schema)
    newest = rows.agg(F.coalesce(F.max(BATCH), F.lit(0))).first()[0]
    write_batch(latest_rows(rows, keys), newest, target)
