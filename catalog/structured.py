"""Queries over tables: profile, duplicates, outliers, checks and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.shared import (
    DIRTY_ORDERS_COLUMNS,
    DIRTY_ORDERS_SQL,
    EVENTS_COLUMNS,
    LINEITEM_COLUMNS,
    ORDERS_AS_OF,
    dirty_orders,
    table,
)
from plumbline.config import DIMENSIONS, StructuredRules
from plumbline.functions.names import IDENTIFIER_TOKENS, NON_NEGATIVE_TOKENS, name_has
from plumbline.operators.columns import (
    approx_distinct_counts,
    column_metrics,
    column_profile,
    distinct_counts,
    outlier_counts,
    sample_values,
)
from plumbline.operators.duplicates import duplicate_summary, mark_duplicates, row_groups
from plumbline.operators.selection import selected_quantiles
from plumbline.plans.structured import derived_metrics, structured_checks, validate_structured

NUMBER_SQL = r"'^[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?)$'"
QUANTILES = (0.05, 0.5, 0.95)
DATE_SQL = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]|$)'"


# -- queries ------------------------------------------------------------------


def profile_dirty_orders(spark, sf_dir):
    return _rounded(column_profile(dirty_orders(spark, sf_dir)))


def profile_lineitem(spark, sf_dir):
    return _rounded(column_profile(table(spark, sf_dir, "lineitem")))


def _rounded(profile):
    return profile.select(
        "column", "dtype", "row_count", "null_count", F.round("null_rate", 4).alias("null_rate"), "unique_count",
        *[F.round(c, 3).alias(c) for c in ("min", "max", "mean", "median", "std")],
    )


def selected_quantiles_lineitem(spark, sf_dir):
    chosen = selected_quantiles(table(spark, sf_dir, "lineitem"), QUANTILES)
    return chosen.select("column", "probability", F.round("value", 3).alias("value"))


def rule_metrics_dirty_orders(spark, sf_dir):
    metrics = column_metrics(dirty_orders(spark, sf_dir), ORDERS_AS_OF)
    derived = derived_metrics(metrics, ORDERS_AS_OF, StructuredRules())
    return derived.select(
        "column", "kind", "is_identifier", "unique_count", "outlier_count", "numeric_parsed", "datetime_parsed",
        "future_cells", "negative_count", "long_count", "is_date", "is_constant", "is_mixed", "is_low_cardinality",
        F.col("age_days").cast("bigint").alias("age_days"),
    )


def distinct_lineitem(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    names = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(f"c{i}"), F.lit(c))])
    return distinct_counts(df).select(F.element_at(names, F.col("ref")).alias("column"), "unique_count")


def approx_distinct_within_error(spark, sf_dir):
    """Whether each estimate lies within ten per cent of the exact count."""
    df = table(spark, sf_dir, "lineitem")
    names = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(f"c{i}"), F.lit(c))])
    estimate = approx_distinct_counts(df).withColumnRenamed("unique_count", "estimate")
    close = F.abs(F.col("estimate") - F.col("unique_count")) <= 0.1 * F.col("unique_count")
    return distinct_counts(df).join(estimate, "ref").select(
        F.element_at(names, F.col("ref")).alias("column"), close.alias("is_close")
    )


def outliers_events(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    wide = outlier_counts(df)
    renamed = wide.select(*[F.col(f"outliers_{df.columns.index(c)}").alias(c) for c in ("event_id", "user_id", "value")])
    return renamed.unpivot([], renamed.columns, "column", "outlier_count")


DUPLICATE_COLUMNS = ("o_custkey", "o_orderstatus", "o_orderpriority")


def duplicate_rate_orders(spark, sf_dir):
    summary = duplicate_summary(table(spark, sf_dir, "orders").select(*DUPLICATE_COLUMNS))
    return summary.withColumn("duplicate_rate", F.round("duplicate_rate", 6))


def duplicate_groups_events(spark, sf_dir):
    groups = row_groups(table(spark, sf_dir, "events").select("user_id", "event_type"))
    return groups.select(F.col("c0").alias("user_id"), F.col("c1").alias("event_type"), "n")


def duplicate_marks_orders(spark, sf_dir):
    return mark_duplicates(table(spark, sf_dir, "orders").select("o_orderkey", *DUPLICATE_COLUMNS), "o_orderkey")


def sample_values_dirty_orders(spark, sf_dir):
    return sample_values(dirty_orders(spark, sf_dir).select("order_id", "priority", "status", "placed_on"), "order_id").select(
        "column", "rank", "value"
    )


def checks_dirty_orders(spark, sf_dir):
    return structured_checks(dirty_orders(spark, sf_dir), ORDERS_AS_OF)


def _flat(result):
    return result.select(
        "dataset_name", "data_type", "overall_score", "passed",
        *[F.col(f"dimensions.{d}").alias(d) for d in DIMENSIONS],
        F.size("failed_checks").cast("bigint").alias("failed_checks"),
    )


def quality_dirty_orders(spark, sf_dir):
    return _flat(validate_structured(dirty_orders(spark, sf_dir), "dirty_orders", ORDERS_AS_OF))


def quality_lineitem(spark, sf_dir):
    return _flat(validate_structured(table(spark, sf_dir, "lineitem"), "lineitem", ORDERS_AS_OF))


def quality_events(spark, sf_dir):
    return _flat(validate_structured(table(spark, sf_dir, "events"), "events", "2024-03-15"))


# -- SQL ----------------------------------------------------------------------


def profile_sql(source: str, columns) -> str:
    parts = []
    for name, kind, dtype in columns:
        if kind == "numeric":
            moments = (
                f'round(CAST(min({name}) AS DOUBLE), 3) AS "min", round(CAST(max({name}) AS DOUBLE), 3) AS "max", '
                f'round(avg({name}), 3) AS mean, round(quantile_cont(CAST({name} AS DOUBLE), 0.5), 3) AS median, '
                f'round(stddev_samp({name}), 3) AS std'
            )
        else:
            nothing = "CAST(NULL AS DOUBLE)"
            moments = f'{nothing} AS "min", {nothing} AS "max", {nothing} AS mean, {nothing} AS median, {nothing} AS std'
        parts.append(
            f"SELECT '{name}' AS \"column\", '{dtype}' AS dtype, count(*) AS row_count, "
            f"count(*) - count({name}) AS null_count, "
            f"round((count(*) - count({name})) / count(*), 4) AS null_rate, "
            f"count(DISTINCT {name}) AS unique_count, {moments} FROM src"
        )
    return f"WITH src AS ({source}) " + " UNION ALL ".join(parts)


def metrics_cte(source: str, columns, as_of: str) -> str:
    """CTEs ``src`` and ``m``: the rule metrics of each column."""
    parts = []
    for i, (name, kind, _) in enumerate(columns):
        identifier = name_has(name, IDENTIFIER_TOKENS)
        numeric = kind == "numeric"
        outliers = (
            f"(SELECT count(*) FROM src, (SELECT avg({name}) AS mu, stddev_samp({name}) AS sd FROM src) "
            f"WHERE sd > 0 AND abs(({name} - mu) / sd) > 3)"
            if numeric
            else "0"
        )
        stamp = {"temporal": name, "string": f"CASE WHEN regexp_matches(trim({name}), {DATE_SQL}) THEN try_cast(trim({name}) AS TIMESTAMP) END"}.get(kind)
        parsed_number = f"count(CASE WHEN regexp_matches(trim({name}), {NUMBER_SQL}) THEN 1 END)" if kind == "string" else "0"
        parsed_date = f"count({stamp})" if kind == "string" else "0"
        negative = f"count(CASE WHEN {name} < 0 THEN 1 END)" if numeric and name_has(name, NON_NEGATIVE_TOKENS) else "0"
        latest = f"max({stamp})" if stamp else "NULL"
        future = f"count(CASE WHEN {stamp} > TIMESTAMP '{as_of}' THEN 1 END)" if stamp else "0"
        too_long = f"count(CASE WHEN length({name}) > 1000 THEN 1 END)" if kind == "string" else "0"
        parts.append(
            f"SELECT {i} AS position, '{name}' AS \"column\", '{kind}' AS kind, {str(identifier).lower()} AS is_identifier, "
            f"count(*) AS row_count, count({name}) AS filled, count(DISTINCT {name}) AS unique_count, "
            f"{outliers} AS outlier_count, {parsed_number} AS numeric_parsed, {parsed_date} AS datetime_parsed, "
            f"CAST({latest} AS TIMESTAMP) AS latest, {future} AS future_count, {negative} AS negative_count, "
            f"{too_long} AS long_count FROM src"
        )
    return f"""WITH src AS ({source}),
raw AS ({' UNION ALL '.join(parts)}),
dated AS (
  SELECT *, (row_count - filled) / row_count AS null_rate, unique_count / row_count AS unique_ratio,
    kind = 'temporal' OR (kind = 'string' AND filled > 0 AND datetime_parsed >= 0.8 * filled) AS is_date,
    unique_count <= 1 AND filled > 0 AS is_constant,
    greatest(numeric_parsed, datetime_parsed) / nullif(filled, 0) AS parse_ratio
  FROM raw),
m AS (
  SELECT *, NOT is_constant AND kind = 'string' AND coalesce(parse_ratio > 0.1, false) AS is_mixed,
    kind = 'string' AND unique_count > 2 AND unique_ratio < 0.01 AS is_low_cardinality,
    CASE WHEN is_date THEN date_diff('day', CAST(latest AS DATE), DATE '{as_of}') END AS age_days,
    CASE WHEN is_date THEN future_count ELSE 0 END AS future_cells
  FROM dated)"""


RULE_METRICS_SQL = (
    metrics_cte(DIRTY_ORDERS_SQL, DIRTY_ORDERS_COLUMNS, ORDERS_AS_OF)
    + """ SELECT "column", kind, is_identifier, unique_count, outlier_count, numeric_parsed, datetime_parsed,
  future_cells, negative_count, long_count, is_date, is_constant, is_mixed, is_low_cardinality, age_days FROM m"""
)


def checks_sql(as_of: str) -> str:
    """Rows of failed checks from ``m``, without the duplicate check."""
    return f"""
SELECT 'completeness' AS dimension, 'null_rate' AS "check", "column", '<= 5%' AS expected,
  printf('%.2f%%', null_rate * 100) AS actual, CASE WHEN null_rate > 0.2 THEN 'error' ELSE 'warning' END AS severity
FROM m WHERE null_rate > 0.05
UNION ALL SELECT 'accuracy', 'low_cardinality', "column", '>= 1.0% unique ratio', printf('%.2f%%', unique_ratio * 100), 'warning'
FROM m WHERE is_low_cardinality
UNION ALL SELECT 'accuracy', 'numeric_outliers', "column", 'Z-score <= 3.0',
  printf('%d outlier(s) (%.2f%%)', outlier_count, outlier_count / filled * 100),
  CASE WHEN outlier_count / filled >= 0.05 THEN 'error' ELSE 'warning' END
FROM m WHERE outlier_count > 0
UNION ALL SELECT 'consistency', 'constant_column', "column", 'unique_count > 1', 'unique_count=' || unique_count, 'warning'
FROM m WHERE is_constant
UNION ALL SELECT 'consistency', 'mixed_type', "column", 'uniform dtype, not object',
  printf('%.0f%%', parse_ratio * 100) || ' of values parseable as ' ||
  CASE WHEN numeric_parsed >= datetime_parsed THEN 'numeric' ELSE 'datetime' END, 'warning'
FROM m WHERE is_mixed
UNION ALL SELECT 'freshness', 'stale_data', "column", 'most recent date within 30 days',
  'most recent date is ' || CAST(CAST(latest AS DATE) AS VARCHAR) || ' (' || age_days || ' days ago)',
  CASE WHEN age_days > 60 THEN 'error' ELSE 'warning' END
FROM m WHERE age_days > 30
UNION ALL SELECT 'freshness', 'no_date_columns', 'dataset', 'at least one date/datetime column', 'none found', 'warning'
FROM (SELECT count(CASE WHEN is_date THEN 1 END) AS n FROM m) WHERE n = 0
UNION ALL SELECT 'uniqueness', 'duplicate_rows', 'dataset', 'duplicate_rate <= 1%', printf('%.2f%%', duplicate_rate * 100),
  CASE WHEN duplicate_rate > 0.1 THEN 'error' ELSE 'warning' END
FROM dup WHERE duplicate_rate > 0.01
UNION ALL SELECT 'uniqueness', 'non_unique_identifier', "column", 'all ' || row_count || ' values unique',
  (row_count - unique_count) || ' repeated value(s)', 'error'
FROM m WHERE is_identifier AND unique_count < row_count
UNION ALL SELECT 'validity', 'negative_value', "column", '>= 0', negative_count || ' negative value(s)', 'error'
FROM m WHERE negative_count > 0
UNION ALL SELECT 'validity', 'future_date', "column", '<= today ({as_of})', future_cells || ' future date(s)', 'warning'
FROM m WHERE future_cells > 0
UNION ALL SELECT 'validity', 'excessive_string_length', "column", 'string length <= 1000 characters',
  long_count || ' value(s) exceed 1000 characters', 'warning'
FROM m WHERE long_count > 0"""


DUP_CTE = """, dup AS (
  SELECT 1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) / (SELECT count(*) FROM src) AS duplicate_rate)"""


def checks_query(source: str, columns, as_of: str) -> str:
    return metrics_cte(source, columns, as_of) + DUP_CTE + checks_sql(as_of)


def quality_sql(name: str, source: str, columns, as_of: str) -> str:
    return (
        metrics_cte(source, columns, as_of)
        + DUP_CTE
        + f""", failed AS ({checks_sql(as_of)}),
t AS (
  SELECT count(*) AS cols, max(row_count) AS n, avg(1 - null_rate) AS filled_share, sum(outlier_count) AS outliers,
    count(CASE WHEN is_low_cardinality THEN 1 END) AS low, count(CASE WHEN is_constant OR is_mixed THEN 1 END) AS flagged,
    coalesce(max(CASE WHEN age_days > 30 THEN age_days END), 0) AS worst,
    sum(negative_count + future_cells + long_count) AS invalid
  FROM m),
d AS (
  SELECT round(filled_share * 100, 2) AS completeness,
    round(greatest(0.0, (1 - outliers / (n * cols)) * 100 - 5.0 * low), 2) AS accuracy,
    round((1 - flagged / cols) * 100, 2) AS consistency,
    round(greatest(0.0, 100 - worst / 30.0 * 100), 2) AS freshness,
    round((1 - duplicate_rate) * 100, 2) AS uniqueness,
    round((1 - invalid / (n * cols)) * 100, 2) AS validity
  FROM t, dup)
SELECT '{name}' AS dataset_name, 'structured' AS data_type, overall_score, overall_score >= 80 AS passed,
  completeness, accuracy, consistency, freshness, uniqueness, validity,
  (SELECT count(*) FROM failed) AS failed_checks
FROM (SELECT *, round(completeness * 0.25 + accuracy * 0.25 + consistency * 0.15 + freshness * 0.15
  + uniqueness * 0.1 + validity * 0.1, 2) AS overall_score FROM d)"""
    )


def _samples_sql() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", row_number() OVER (ORDER BY order_id) AS rank, CAST({c} AS VARCHAR) AS value "
        f"FROM src WHERE {c} IS NOT NULL QUALIFY rank <= 5"
        for c in ("order_id", "priority", "status", "placed_on")
    ]
    return f"WITH src AS ({DIRTY_ORDERS_SQL}) " + " UNION ALL ".join(f"({p})" for p in parts)


_keys = ", ".join(DUPLICATE_COLUMNS)
_lineitem_counts = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_count FROM lineitem" for c, _, _ in LINEITEM_COLUMNS
)

QUERIES = {
    "profile_dirty_orders": profile_dirty_orders,
    "profile_lineitem": profile_lineitem,
    "selected_quantiles_lineitem": selected_quantiles_lineitem,
    "rule_metrics_dirty_orders": rule_metrics_dirty_orders,
    "distinct_lineitem": distinct_lineitem,
    "approx_distinct_within_error": approx_distinct_within_error,
    "outliers_events": outliers_events,
    "duplicate_rate_orders": duplicate_rate_orders,
    "duplicate_groups_events": duplicate_groups_events,
    "duplicate_marks_orders": duplicate_marks_orders,
    "sample_values_dirty_orders": sample_values_dirty_orders,
    "checks_dirty_orders": checks_dirty_orders,
    "quality_dirty_orders": quality_dirty_orders,
    "quality_lineitem": quality_lineitem,
    "quality_events": quality_events,
}

SQL = {
    "profile_dirty_orders": profile_sql(DIRTY_ORDERS_SQL, DIRTY_ORDERS_COLUMNS),
    "profile_lineitem": profile_sql("SELECT * FROM lineitem", LINEITEM_COLUMNS),
    "selected_quantiles_lineitem": " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", CAST({p} AS DOUBLE) AS probability, "
        f"round(quantile_cont(CAST({name} AS DOUBLE), {p}), 3) AS value FROM lineitem"
        for name, kind, _ in LINEITEM_COLUMNS
        if kind == "numeric"
        for p in QUANTILES
    ),
    "rule_metrics_dirty_orders": RULE_METRICS_SQL,
    "distinct_lineitem": _lineitem_counts,
    "approx_distinct_within_error": f'SELECT "column", true AS is_close FROM ({_lineitem_counts})',
    "outliers_events": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS outlier_count FROM events, "
        f"(SELECT avg({c}) AS mu, stddev_samp({c}) AS sd FROM events) WHERE abs(({c} - mu) / sd) > 3"
        for c in ("event_id", "user_id", "value")
    ),
    "duplicate_rate_orders": f"""
WITH g AS (SELECT {_keys}, count(*) AS n FROM orders GROUP BY {_keys})
SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
  round(sum(n - 1) / sum(n), 6) AS duplicate_rate FROM g""",
    "duplicate_groups_events": "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type",
    "duplicate_marks_orders": f"""
SELECT o_orderkey, {_keys}, row_number() OVER (PARTITION BY {_keys} ORDER BY o_orderkey) > 1 AS is_duplicate FROM orders""",
    "sample_values_dirty_orders": _samples_sql(),
    "checks_dirty_orders": checks_query(DIRTY_ORDERS_SQL, DIRTY_ORDERS_COLUMNS, ORDERS_AS_OF),
    "quality_dirty_orders": quality_sql("dirty_orders", DIRTY_ORDERS_SQL, DIRTY_ORDERS_COLUMNS, ORDERS_AS_OF),
    "quality_lineitem": quality_sql("lineitem", "SELECT * FROM lineitem", LINEITEM_COLUMNS, ORDERS_AS_OF),
    "quality_events": quality_sql("events", "SELECT * FROM events", EVENTS_COLUMNS, "2024-03-15"),
}
