"""Assembling ranked check rows and scores into result records."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, QualityConfig
from plumbline.functions.scoring import weighted_score
from plumbline.types import RESULT_COLUMNS, check_struct, present


def ranked_check(dimension, position, seq, when, check, column, expected, actual, severity) -> Column:
    """A failed check with the keys that put it into report order, null when it passes."""
    position = position if isinstance(position, Column) else F.lit(position)
    return F.when(
        when,
        F.struct(
            F.lit(DIMENSIONS.index(dimension)).alias("dimension_order"),
            position.cast("string").alias("position"),
            F.lit(seq).alias("seq"),
            F.lit(dimension).alias("dimension"),
            check_struct(check, column, expected, actual, severity).alias("failed"),
        ),
    )


def checks_of(dimensions: Iterable[str]) -> Callable[..., Column | None]:
    """:func:`ranked_check` for the checks of ``dimensions``, None for all others."""
    wanted = set(dimensions)

    def check(dimension, *rest) -> Column | None:
        return ranked_check(dimension, *rest) if dimension in wanted else None

    return check


def failed_alone(*candidates: Column | None) -> Column:
    """Array of the failed checks among the candidates, typed even where none was wanted."""
    never = ranked_check(DIMENSIONS[0], "", 0, F.lit(False), "", "", "", "", "")
    return present(never, *[c for c in candidates if c is not None])


def ordered_failures(ranked: Column) -> Column:
    """Ranked checks in report order, without their keys."""
    return F.transform(F.array_sort(ranked), lambda c: c["failed"])


def padded(position: Column) -> Column:
    """A position as text that sorts in number order."""
    return F.lpad(position.cast("string"), 10, "0")


def check_rows(ranked: DataFrame) -> DataFrame:
    """Long form ``(dimension, check, column, expected, actual, severity)``."""
    return ranked.select("dimension", "failed.*")


def result_record(
    scored: DataFrame,
    data_type: str,
    config: QualityConfig,
    dataset_name,
    as_of: Column,
    run_id: str = "",
    source_path="",
) -> DataFrame:
    """Turn rows of six scores, ``failed_checks`` and ``metadata`` into result records."""

    def value(v):
        return v if isinstance(v, Column) else F.lit(v)

    with_dims = scored.withColumn(
        "dimensions", F.struct(*[F.round(F.col(d), 2).cast("double").alias(d) for d in DIMENSIONS])
    )
    overall = weighted_score(config.weights)
    return (
        with_dims.withColumn("overall_score", overall)
        .withColumn("passed", F.col("overall_score") >= config.bands.pass_score)
        .withColumn("run_id", F.lit(run_id))
        .withColumn("dataset_name", value(dataset_name).cast("string"))
        .withColumn("data_type", F.lit(data_type))
        .withColumn("run_timestamp", as_of)
        .withColumn("source_path", value(source_path).cast("string"))
        .select(*RESULT_COLUMNS)
    )
