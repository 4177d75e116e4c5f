"""Schemas shared by every data type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DATA_TYPES, DIMENSIONS

CHECK_TYPE = (
    "struct<check:string,column:string,expected:string,actual:string,severity:string>"
)
DIMENSIONS_TYPE = "struct<" + ",".join(f"{d}:double" for d in DIMENSIONS) + ">"

RESULT_SCHEMA = (
    "run_id string, dataset_name string, data_type string, overall_score double, "
    f"dimensions {DIMENSIONS_TYPE}, failed_checks array<{CHECK_TYPE}>, "
    "metadata map<string,string>, passed boolean, run_timestamp timestamp, "
    "source_path string"
)
RESULT_COLUMNS = [
    "run_id",
    "dataset_name",
    "data_type",
    "overall_score",
    "dimensions",
    "failed_checks",
    "metadata",
    "passed",
    "run_timestamp",
    "source_path",
]
# A failed check of a run as a row of its own; the three keys before ``dimension`` give report order.
CHECK_COLUMNS = [
    "run_id",
    "dataset_name",
    "dimension_order",
    "position",
    "seq",
    "dimension",
    "check",
    "column",
    "expected",
    "actual",
    "severity",
]
CHECK_SCHEMA = (
    "run_id string, dataset_name string, dimension_order int, position string, seq int, dimension string, "
    "`check` string, `column` string, expected string, actual string, severity string"
)


def check_struct(check: str, column, expected, actual, severity) -> Column:
    """One failed check as a struct of strings."""

    def text(value):
        return value if isinstance(value, Column) else F.lit(value)

    return F.struct(
        F.lit(check).alias("check"),
        text(column).alias("column"),
        text(expected).alias("expected"),
        text(actual).alias("actual"),
        text(severity).alias("severity"),
    )


def present(*candidates: Column) -> Column:
    """Array of the candidates that are not null, in the given order."""
    return F.filter(F.array(*candidates), lambda c: c.isNotNull())


def assert_valid_results(results: DataFrame) -> DataFrame:
    """Fail the job on a record with an unknown data type or a score outside 0..100."""
    bad_type = ~F.col("data_type").isin(*DATA_TYPES) | F.col("data_type").isNull()
    bad_score = ~F.col("overall_score").between(0, 100) | F.col("overall_score").isNull()
    checked = (
        F.when(
            bad_type,
            F.raise_error(F.concat(F.lit("invalid data_type: "), F.coalesce("data_type", F.lit("null")))),
        )
        .when(
            bad_score,
            F.raise_error(
                F.concat(
                    F.lit("overall_score outside 0..100: "),
                    F.coalesce(F.col("overall_score").cast("string"), F.lit("null")),
                )
            ),
        )
        .otherwise(F.col("data_type"))
    )
    return results.withColumn("data_type", checked)
