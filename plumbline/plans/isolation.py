"""When a check fails to run: the other dimensions, and the other documents, keep their scores.

The plan of all dimensions together is tried first, as it scans least. Only when
it fails is each dimension a plan of its own, without what the others need; the
one that fails again scores zero and says why.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, QualityConfig, as_of_column
from plumbline.plans.results import result_record
from plumbline.session import settled
from plumbline.types import CHECK_TYPE, check_struct

log = logging.getLogger(__name__)

RANKED_SCHEMA = f"dimension_order int, position string, seq int, dimension string, failed {CHECK_TYPE}"
EXPECTED = "check to complete without error"


def reason_of(error: Exception) -> str:
    """The first line of an error that says something."""
    lines = [line for line in str(error).splitlines() if line.strip()]
    return lines[0] if lines else type(error).__name__


def by_dimension(
    spark: SparkSession, part: Callable[[str], tuple[DataFrame, DataFrame]]
) -> tuple[DataFrame, DataFrame]:
    """Scores and failed checks of a data set, each dimension computed apart from the others.

    ``part`` gives for a dimension one row with its score, named as the dimension is, and
    ``metadata``, and the ranked checks as rows. The result is one row with six scores and the
    metadata together, and all ranked checks as rows. Where all six fail the last error is raised.
    """
    scores = checks = None
    failures = 0
    for dimension in DIMENSIONS:
        try:
            scored, ranked = part(dimension)
            scored = settled(
                scored.select(
                    F.lit(dimension).alias("dimension"), F.col(dimension).cast("double").alias("score"), "metadata"
                )
            )
            ranked = settled(ranked)
        except Exception as error:  # noqa: BLE001 - reported as the result of this dimension
            failures += 1
            if failures == len(DIMENSIONS):
                # Nothing could be checked, so the data set itself cannot be read.
                raise
            log.exception("%s failed", dimension)
            scored = spark.createDataFrame(
                [(dimension, 0.0, {})], "dimension string, score double, metadata map<string,string>"
            )
            failed = (dimension, "dataset", EXPECTED, reason_of(error), "error")
            ranked = spark.createDataFrame([(DIMENSIONS.index(dimension), "", 0, dimension, failed)], RANKED_SCHEMA)
        scores = scored if scores is None else scores.unionByName(scored)
        checks = ranked if checks is None else checks.unionByName(ranked)
    one = scores.agg(
        *[F.max(F.when(F.col("dimension") == d, F.col("score"))).alias(d) for d in DIMENSIONS],
        F.map_from_entries(F.flatten(F.collect_list(F.map_entries("metadata")))).alias("metadata"),
    )
    return one, checks


def failing_dimensions(part: Callable[[str], DataFrame]) -> dict[str, str]:
    """Dimensions whose plan does not run to its end, with the reason."""
    failing = {}
    for dimension in DIMENSIONS:
        try:
            part(dimension).write.format("noop").mode("overwrite").save()
        except Exception as error:  # noqa: BLE001 - reported as the result of this dimension
            log.exception("%s failed", dimension)
            failing[dimension] = reason_of(error)
    return failing


def failed_records(
    failed: DataFrame, data_type: str, config: QualityConfig, as_of=None, run_id: str = ""
) -> DataFrame:
    """Records of score zero for ``(dataset_name, source_path, reason)`` rows that could not be checked."""
    column = "document" if data_type == "text" else "dataset"
    failures = F.array(*[check_struct(d, column, EXPECTED, F.col("reason"), "error") for d in DIMENSIONS])
    scored = failed.select(
        "dataset_name",
        "source_path",
        *[F.lit(0.0).alias(d) for d in DIMENSIONS],
        failures.alias("failed_checks"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )
    return result_record(
        scored, data_type, config, F.col("dataset_name"), as_of_column(as_of), run_id, F.col("source_path")
    )
