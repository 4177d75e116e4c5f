"""The six quality dimensions of a table.

``column_metrics`` gives one row per column; each rule is an expression on that
row, so the rules cost nothing next to the scans. The number of checks in a
result record is bounded by the width of the table.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, QualityConfig, StructuredRules, as_of_column
from plumbline.functions.scoring import percent, percent_text
from plumbline.operators.columns import column_metrics
from plumbline.operators.duplicates import duplicate_summary
from plumbline.plans.isolation import by_dimension
from plumbline.plans.results import check_rows, checks_of, failed_alone, ordered_failures, padded, result_record
from plumbline.session import settled

log = logging.getLogger(__name__)


def derived_metrics(metrics: DataFrame, as_of, rules: StructuredRules) -> DataFrame:
    """Add the ratios and flags the rules compare with their limits."""
    ratios = metrics.withColumn("as_of", as_of_column(as_of)).selectExpr(
        "*",
        "coalesce(null_count / nullif(row_count, 0), 0D) AS null_rate",
        "unique_count / nullif(row_count, 0) AS unique_ratio",
        "outlier_count / nullif(row_count - null_count, 0) AS outlier_rate",
        "greatest(numeric_parsed, datetime_parsed) / nullif(row_count - null_count, 0) AS parse_ratio",
        "coalesce(unique_count <= 1, false) AND (row_count > null_count OR row_count = 0) AS is_constant",
        "CASE WHEN is_date THEN datediff(to_date(as_of), to_date(latest)) END AS age_days",
        "CASE WHEN is_date THEN future_count ELSE 0 END AS future_cells",
    )
    return ratios.selectExpr(
        "*",
        f"kind = 'string' AND unique_count > 2 AND coalesce(unique_ratio < {rules.cardinality_ratio}D, false) "
        "AS is_low_cardinality",
        f"NOT is_constant AND kind = 'string' AND coalesce(parse_ratio > {rules.parse_ratio}D, false) AS is_mixed",
        f"coalesce(age_days > {rules.max_age_days}, false) AS is_stale",
    ).drop("as_of")


def _severity(is_error: Column) -> Column:
    return F.when(is_error, F.lit("error")).otherwise(F.lit("warning"))


def column_checks(as_of, rules: StructuredRules, dimensions: Iterable[str] = DIMENSIONS) -> Column:
    """Array of the failed checks of one metrics row."""
    check = checks_of(dimensions)
    position, column = padded(F.col("position")), F.col("column")
    today = F.date_format(as_of_column(as_of), "yyyy-MM-dd")
    parse_kind = F.when(F.col("numeric_parsed") >= F.col("datetime_parsed"), F.lit("numeric")).otherwise(
        F.lit("datetime")
    )
    has_rows = F.col("row_count") > 0
    return failed_alone(
        check(
            "completeness", position, 0, F.col("null_rate") > rules.null_warn,
            "null_rate", column,
            f"<= {percent_text(rules.null_warn)}",
            percent("null_rate"),
            _severity(F.col("null_rate") > rules.null_error),
        ),
        check(
            "accuracy", position, 0, F.col("is_low_cardinality"),
            "low_cardinality", column,
            f">= {percent_text(rules.cardinality_ratio, 1)} unique ratio",
            percent("unique_ratio"),
            "warning",
        ),
        check(
            "accuracy", position, 1, F.col("outlier_count") > 0,
            "numeric_outliers", column,
            f"Z-score <= {rules.z_limit}",
            F.format_string("%d outlier(s) (%s)", F.col("outlier_count"), percent("outlier_rate")),
            _severity(F.col("outlier_rate") >= rules.outlier_error_rate),
        ),
        check(
            "consistency", position, 0, F.col("is_constant"),
            "constant_column", column,
            "unique_count > 1",
            F.format_string("unique_count=%d", "unique_count"),
            "warning",
        ),
        check(
            "consistency", position, 1, F.col("is_mixed"),
            "mixed_type", column,
            "uniform dtype, not object",
            F.concat(percent("parse_ratio", 0), F.lit(" of values parseable as "), parse_kind),
            "warning",
        ),
        check(
            "freshness", position, 0, F.col("is_stale"),
            "stale_data", column,
            f"most recent date within {rules.max_age_days} days",
            F.format_string(
                "most recent date is %s (%d days ago)", F.to_date("latest").cast("string"), F.col("age_days")
            ),
            _severity(F.col("age_days") > rules.max_age_days * 2),
        ),
        check(
            "uniqueness", position, 1,
            has_rows & F.col("is_identifier") & (F.col("unique_count") < F.col("row_count")),
            "non_unique_identifier", column,
            F.format_string("all %d values unique", "row_count"),
            F.format_string("%d repeated value(s)", F.col("row_count") - F.col("unique_count")),
            "error",
        ),
        check(
            "validity", position, 0, F.col("negative_count") > 0,
            "negative_value", column,
            ">= 0",
            F.format_string("%d negative value(s)", "negative_count"),
            "error",
        ),
        check(
            "validity", position, 1, F.col("future_cells") > 0,
            "future_date", column,
            F.concat(F.lit("<= today ("), today, F.lit(")")),
            F.format_string("%d future date(s)", "future_cells"),
            "warning",
        ),
        check(
            "validity", position, 2, F.col("long_count") > 0,
            "excessive_string_length", column,
            f"string length <= {rules.max_string_length} characters",
            F.format_string("%d value(s) exceed %d characters", F.col("long_count"), F.lit(rules.max_string_length)),
            "warning",
        ),
    )


def dataset_checks(rules: StructuredRules, dimensions: Iterable[str] = DIMENSIONS) -> Column:
    """Array of the failed checks that concern the table, from its totals row."""
    check = checks_of(dimensions)
    return failed_alone(
        check(
            "freshness", "", 0, F.col("date_columns") == 0,
            "no_date_columns", "dataset",
            "at least one date/datetime column", "none found", "warning",
        ),
        check(
            "uniqueness", "", 0, F.col("duplicate_rate") > rules.duplicate_warn,
            "duplicate_rows", "dataset",
            f"duplicate_rate <= {percent_text(rules.duplicate_warn)}",
            percent("duplicate_rate"),
            _severity(F.col("duplicate_rate") > rules.duplicate_error),
        ),
    )


def _totals(
    metrics: DataFrame, duplicates: DataFrame, as_of, rules: StructuredRules, dimensions: Iterable[str] = DIMENSIONS
) -> DataFrame:
    """One row: what the scores need, plus the column checks in one array."""
    per_column = derived_metrics(metrics, as_of, rules).withColumn("checks", column_checks(as_of, rules, dimensions))
    invalid = F.col("negative_count") + F.col("future_cells") + F.col("long_count")
    totals = per_column.agg(
        F.count(F.lit(1)).alias("column_count"),
        F.max("row_count").alias("row_count"),
        F.avg(1 - F.col("null_rate")).alias("filled_share"),
        F.sum("outlier_count").alias("outlier_cells"),
        F.count_if("is_low_cardinality").alias("low_cardinality_columns"),
        F.count_if(F.col("is_constant") | F.col("is_mixed")).alias("flagged_columns"),
        F.count_if("is_date").alias("date_columns"),
        F.max(F.when(F.col("is_stale"), F.col("age_days"))).alias("worst_age"),
        F.sum(invalid).alias("invalid_cells"),
        F.flatten(F.collect_list("checks")).alias("column_failures"),
    )
    rate = duplicates.select("duplicate_rate").scalar()
    return totals.withColumn("duplicate_rate", rate)


def _scores(totals: DataFrame, rules: StructuredRules) -> DataFrame:
    cells = F.col("row_count") * F.col("column_count")
    no_rows = F.col("row_count") == 0

    def share_left(bad: Column) -> Column:
        return (1 - F.coalesce(F.try_divide(bad, cells), F.lit(0.0))) * 100

    accuracy = share_left(F.col("outlier_cells")) - rules.cardinality_penalty * F.col("low_cardinality_columns")
    worst = F.coalesce(F.col("worst_age"), F.lit(0))
    return totals.select(
        "*",
        (F.col("filled_share") * 100).alias("completeness"),
        F.when(no_rows, F.lit(100.0)).otherwise(F.greatest(F.lit(0.0), accuracy)).alias("accuracy"),
        ((1 - F.col("flagged_columns") / F.col("column_count")) * 100).alias("consistency"),
        F.greatest(F.lit(0.0), 100.0 - worst / F.lit(float(rules.max_age_days)) * 100).alias("freshness"),
        ((1 - F.col("duplicate_rate")) * 100).alias("uniqueness"),
        F.when(no_rows, F.lit(100.0)).otherwise(share_left(F.col("invalid_cells"))).alias("validity"),
    )


def structured_scores(
    df: DataFrame, as_of=None, config: QualityConfig = QualityConfig(), distinct: str = "rules"
) -> DataFrame:
    """One row with the six dimension scores and the totals behind them."""
    rules = config.structured
    metrics = column_metrics(df, as_of, rules, distinct)
    totals = _totals(metrics, duplicate_summary(df), as_of, rules)
    return _scores(totals, rules)


def structured_checks(
    df: DataFrame, as_of=None, config: QualityConfig = QualityConfig(), distinct: str = "rules"
) -> DataFrame:
    """Every failed check of the table as a row."""
    rules = config.structured
    metrics = column_metrics(df, as_of, rules, distinct)
    totals = _totals(metrics, duplicate_summary(df), as_of, rules)
    every = F.concat(F.col("column_failures"), dataset_checks(rules))
    return check_rows(totals.select(F.inline(every)))


def dimension_part(
    df: DataFrame, dimension: str, as_of=None, config: QualityConfig = QualityConfig(), distinct: str = "rules"
) -> tuple[DataFrame, DataFrame]:
    """Score and metadata of one dimension, and its failed checks, from no more than it reads."""
    rules, only = config.structured, (dimension,)
    metrics = column_metrics(df, as_of, rules, distinct, only)
    totals = _totals(metrics, duplicate_summary(df), as_of, rules, only)
    known = {
        "completeness": (("row_count", F.col("row_count")), ("column_count", F.col("column_count"))),
        "uniqueness": (("duplicate_rate", F.round("duplicate_rate", 6)),),
    }.get(dimension, ())
    metadata = F.create_map(*[x for key, value in known for x in (F.lit(key), value.cast("string"))])
    every = F.concat(F.col("column_failures"), dataset_checks(rules, only))
    scored = _scores(totals, rules).select(dimension, metadata.cast("map<string,string>").alias("metadata"))
    return scored, totals.select(F.inline(every))


def validate_structured(
    df: DataFrame,
    dataset_name: str,
    as_of=None,
    config: QualityConfig = QualityConfig(),
    distinct: str = "rules",
    run_id: str = "",
    source_path: str = "",
    isolate: bool = False,
) -> DataFrame:
    """All six dimensions, the failed checks and the weighted score as one result record.

    With ``isolate`` the record is computed now; should that fail, each dimension is computed
    alone, and one that fails again scores zero with the reason while the others keep theirs.
    """
    rules = config.structured
    if not df.columns:
        raise ValueError("a table without columns has no quality to score")

    def together() -> DataFrame:
        scored = structured_scores(df, as_of, config, distinct)
        every = F.concat(F.col("column_failures"), dataset_checks(rules))
        finished = scored.withColumn("failed_checks", ordered_failures(every)).withColumn(
            "metadata",
            F.create_map(
                F.lit("row_count"), F.col("row_count").cast("string"),
                F.lit("column_count"), F.col("column_count").cast("string"),
                F.lit("duplicate_rate"), F.round("duplicate_rate", 6).cast("string"),
            ),
        )
        return record(finished)

    def record(finished: DataFrame) -> DataFrame:
        return result_record(
            finished, "structured", config, dataset_name, as_of_column(as_of), run_id, source_path
        )

    if not isolate:
        return together()
    try:
        return settled(together())
    except Exception:  # noqa: BLE001 - each dimension reports its own failure below
        log.exception("data set failed as a whole")
    scored, ranked = by_dimension(
        df.sparkSession, lambda dimension: dimension_part(df, dimension, as_of, config, distinct)
    )
    # As many checks as the table has columns, times a constant.
    gathered = ranked.agg(F.collect_list(F.struct(*ranked.columns)).alias("ranked")).scalar()
    finished = scored.withColumn("ranked", gathered).withColumn("failed_checks", ordered_failures(F.col("ranked")))
    return settled(record(finished))
