"""Result records: an append-only table partitioned by run, and JSON exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.paths import path_exists, require_path
from plumbline.types import CHECK_COLUMNS, CHECK_SCHEMA, RESULT_COLUMNS, RESULT_SCHEMA, assert_valid_results


def append_results(results: DataFrame, path: str) -> None:
    """Validate and append; each run is its own partition."""
    checked = assert_valid_results(results.select(*RESULT_COLUMNS))
    checked.write.mode("append").partitionBy("run_id").parquet(path)


def replace_run(results: DataFrame, path: str) -> None:
    """Write the runs of ``results`` in place of what their partitions held.

    Running it again after a failure leaves one copy.
    """
    checked = assert_valid_results(results.select(*RESULT_COLUMNS))
    (
        checked.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def checks_path(path: str) -> str:
    """Where the failed checks of records lie beside the result table."""
    return path.rstrip("/") + "_checks"


def replace_run_checks(checks: DataFrame, path: str) -> None:
    """Write the failed checks of runs in place of what their partitions held."""
    (
        checks.select(*CHECK_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(checks_path(path))
    )


def read_run_checks(spark: SparkSession, path: str) -> DataFrame:
    """Failed checks of records by run, whatever their number; order by dataset and the three order keys."""
    if not path_exists(spark, checks_path(path) + "/run_id=*"):
        return spark.createDataFrame([], CHECK_SCHEMA).select(*CHECK_COLUMNS)
    return spark.read.schema(CHECK_SCHEMA).parquet(checks_path(path)).select(*CHECK_COLUMNS)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The stored records; none while the table does not exist."""
    if not path_exists(spark, path.rstrip("/") + "/run_id=*"):
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(path).select(*RESULT_COLUMNS)


def read_result_json(spark: SparkSession, path: str, run_id: str = "") -> DataFrame:
    """Records from a JSON file: a bare list, or an object with the list under ``datasets``."""
    require_path(spark, path)
    document = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("document"))
    schema = F.schema_of_variant("document")
    listed = F.when(schema.startswith("ARRAY"), F.col("document")).otherwise(
        F.try_variant_get("document", "$.datasets", "variant")
    )
    records = F.when(
        F.schema_of_variant(listed).startswith("ARRAY"), listed
    ).otherwise(F.raise_error(F.lit("expected a JSON list or an object with a 'datasets' list")))
    rows = document.select(records.alias("records")).lateralJoin(
        spark.tvf.variant_explode(F.col("records").outer())
    )
    fields = ", ".join(part.strip() for part in RESULT_SCHEMA.split(", ") if not part.startswith("run_id"))
    parsed = rows.select(F.from_json(F.to_json("value"), fields).alias("r")).select("r.*")
    return parsed.withColumn("run_id", F.lit(run_id)).select(*RESULT_COLUMNS)


def write_result_json(results: DataFrame, path: str) -> None:
    """Records as JSON lines, replacing what was there."""
    results.write.mode("overwrite").json(path)


def write_scored_run(scored: DataFrame, summary: DataFrame, path: str) -> None:
    """A scored run: the labelled records and the one-row summary, replacing the last."""
    base = path.rstrip("/")
    scored.write.mode("overwrite").parquet(f"{base}/datasets")
    summary.write.mode("overwrite").parquet(f"{base}/summary")
