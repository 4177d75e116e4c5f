"""Stream ingest of files that keep arriving in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, format: str = "parquet", max_files: int = 100
) -> DataFrame:
    """A stream of new Parquet or JSON-lines files; the schema is given, never inferred."""
    if format not in ("parquet", "json"):
        raise ValueError(f"stream format must be 'parquet' or 'json', got {format!r}")
    return (
        spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", max_files).load(path)
    )


def event_time(df: DataFrame, column: str) -> DataFrame:
    """The column as TIMESTAMP, which a watermark needs; zone-less times are read in the session's zone."""
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return df.withColumn(column, F.col(column).cast("timestamp"))
    return df
