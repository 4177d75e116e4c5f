"""Scored runs, history and report tables, as queries over result records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from plumbline.config import DIMENSIONS, QualityConfig
from plumbline.functions.scoring import emphasis, label, trend_delta, trend_direction

NEWEST = ("run_timestamp", "run_id")


def score_results(results: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Add ``label`` and set ``passed`` to whether the label is PASS."""
    labelled = results.withColumn("label", label(F.coalesce("overall_score", F.lit(0.0)), config.bands))
    return labelled.withColumn("passed", F.col("label") == "PASS")


def run_summary(scored: DataFrame) -> DataFrame:
    """One row of counts, shares and score statistics; an empty run is an error."""
    total = F.count(F.lit(1))
    guarded = F.when(total == 0, F.raise_error(F.lit("no results to summarise"))).otherwise(total)
    aggregates = [guarded.cast("bigint").alias("total_datasets")]
    for name in ("PASS", "WARN", "FAIL"):
        aggregates.append(F.count_if(F.col("label") == name).alias(f"{name.lower()}_count"))
    for name in ("PASS", "WARN", "FAIL"):
        share = F.try_divide(F.count_if(F.col("label") == name) * 100, total)
        aggregates.append(F.round(share, 1).alias(f"{name.lower()}_pct"))
    return scored.agg(
        *aggregates,
        F.round(F.avg("overall_score"), 2).alias("mean_score"),
        F.round(F.min("overall_score"), 2).alias("min_score"),
        F.round(F.max("overall_score"), 2).alias("max_score"),
        (F.count_if(F.col("label") != "PASS") == 0).alias("pipeline_passed"),
    )


# -- history ------------------------------------------------------------------


def latest_per_dataset(results: DataFrame) -> DataFrame:
    """The newest record of each dataset; combined before the shuffle, never windowed."""
    newest = F.max_by(F.struct(*results.columns), F.struct(*NEWEST))
    return results.groupBy("dataset_name").agg(newest.alias("r")).select("r.*")


def latest_run(results: DataFrame) -> DataFrame:
    """All records of the newest run; no rows while there is none."""
    newest = results.agg(F.max_by("run_id", F.struct(*NEWEST)).alias("run_id")).scalar()
    return results.withColumn("_newest", newest).where(F.col("run_id") == F.col("_newest")).drop("_newest")


def dataset_result(results: DataFrame, dataset_name: str, newest: bool = True) -> DataFrame:
    """One dataset's record: the newest, or the oldest as a plain first match gives."""
    mine = results.where(F.col("dataset_name") == dataset_name)
    order = [F.desc(c) if newest else F.asc(c) for c in NEWEST]
    return mine.orderBy(*order).limit(1)


def dataset_score(results: DataFrame, dataset_name: str, newest: bool = True) -> DataFrame:
    return dataset_result(results, dataset_name, newest).select("dataset_name", "overall_score")


def history(results: DataFrame) -> DataFrame:
    """Every record, oldest first."""
    return results.orderBy(*NEWEST, "dataset_name")


def compare_runs(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Score change per dataset of the current run; vanished datasets are left out.

    A dataset recorded twice in the previous run counts with its last record.
    """
    before = previous.groupBy("dataset_name").agg(
        F.max_by("overall_score", F.struct(*NEWEST)).alias("previous_score")
    )
    joined = current.select("dataset_name", F.col("overall_score").alias("current_score")).join(
        before, "dataset_name", "left"
    )
    now, then = F.col("current_score"), F.col("previous_score")
    return joined.select(
        "dataset_name",
        "previous_score",
        "current_score",
        trend_delta(now, then).alias("delta"),
        trend_direction(now, then).alias("direction"),
    )


def score_history_deltas(results: DataFrame) -> DataFrame:
    """Every record with the change against the dataset's record before it.

    The lag runs within dataset and month; the first record of a month takes
    the last score of the dataset's month before. So a dataset with very many
    records is spread over its months instead of lying in one task.
    """
    month = F.date_trunc("month", "run_timestamp")
    records = results.select("dataset_name", "run_id", "run_timestamp", "overall_score", month.alias("month"))
    within = Window.partitionBy("dataset_name", "month").orderBy(*NEWEST)
    lagged = records.select(
        "*",
        F.lag("overall_score").over(within).alias("in_month"),
        F.row_number().over(within).alias("nth"),
    )
    closing = records.groupBy("dataset_name", "month").agg(
        F.max_by("overall_score", F.struct(*NEWEST)).alias("closing")
    )
    months = Window.partitionBy("dataset_name").orderBy("month")
    carried = closing.select(
        "dataset_name", "month", F.lit(1).alias("nth"), F.lag("closing").over(months).alias("carried")
    )
    joined = lagged.join(carried, ["dataset_name", "month", "nth"], "left")
    now, then = F.col("overall_score"), F.coalesce("in_month", "carried")
    return joined.select(
        "dataset_name",
        "run_id",
        "run_timestamp",
        "overall_score",
        then.alias("previous_score"),
        trend_delta(now, then).alias("delta"),
        trend_direction(now, then).alias("direction"),
    )


# -- report tables ------------------------------------------------------------


def failed_check_count() -> Column:
    return F.size(F.coalesce("failed_checks", F.array())).cast("bigint")


def dataset_table(scored: DataFrame) -> DataFrame:
    return scored.select(
        "dataset_name", "data_type", "overall_score", "label", failed_check_count().alias("failed_checks")
    )


def dimension_table(scored: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The six scores of each dataset, each with how much it should stand out."""
    cells = []
    for d in DIMENSIONS:
        score = F.coalesce(F.col(f"dimensions.{d}"), F.lit(0.0))
        cells += [score.alias(d), emphasis(score, config.bands).alias(f"{d}_emphasis")]
    return scored.select("dataset_name", *cells)


def failed_check_table(scored: DataFrame) -> DataFrame:
    """One row per failed check; ``rank`` puts errors first and keeps their order."""
    ranked = F.array_sort(
        F.transform(
            "failed_checks",
            lambda c, i: F.struct(
                F.when(c["severity"] == "error", 0).otherwise(1).alias("tier"), i.alias("order"), c.alias("failed")
            ),
        )
    )
    return (
        scored.where(F.size("failed_checks") > 0)
        .select("dataset_name", "label", F.posexplode(ranked))
        .select("dataset_name", "label", (F.col("pos") + 1).cast("bigint").alias("rank"), "col.failed.*")
    )


def with_failures(scored: DataFrame) -> DataFrame:
    return scored.where(failed_check_count() > 0)


def alerts(results: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Records whose score lies below the alert threshold."""
    return results.where(F.col("overall_score") < config.alert_below)


def as_json(results: DataFrame) -> DataFrame:
    """Each record as one JSON text with the nine contractual keys."""
    keys = [c for c in results.columns if c != "run_id"]
    return results.select(F.to_json(F.struct(*keys)).alias("record"))
