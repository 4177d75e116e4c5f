"""Queries over result records: labels, summary, report tables, history and trend."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.shared import (
    DIRTY_ORDERS_COLUMNS,
    DIRTY_ORDERS_SQL,
    EVENTS_COLUMNS,
    ORDERS_AS_OF,
    dirty_orders,
    table,
)
from catalog.structured import quality_sql
from catalog.text import TEXT_AS_OF, checks_union, dirty_documents, scored_cte
from plumbline.config import DIMENSIONS, QualityConfig
from plumbline.plans.scoring import (
    alerts,
    compare_runs,
    dataset_result,
    dataset_score,
    dataset_table,
    dimension_table,
    failed_check_table,
    history,
    latest_per_dataset,
    latest_run,
    run_summary,
    score_history_deltas,
    score_results,
    with_failures,
)
from plumbline.plans.structured import validate_structured
from plumbline.plans.text import validate_documents
from plumbline.types import RESULT_COLUMNS

# -- one run: every document a data set ----------------------------------------


def document_results(spark, sf_dir):
    docs = dirty_documents(spark, sf_dir).select("doc_id", "text", "modified_at")
    return validate_documents(docs, as_of=TEXT_AS_OF, modified_at="modified_at")


def labels_documents(spark, sf_dir):
    return score_results(document_results(spark, sf_dir)).select("dataset_name", "overall_score", "label", "passed")


def summary_documents(spark, sf_dir):
    return run_summary(score_results(document_results(spark, sf_dir)))


def dataset_table_documents(spark, sf_dir):
    return dataset_table(score_results(document_results(spark, sf_dir)))


def dimension_table_documents(spark, sf_dir):
    return dimension_table(score_results(document_results(spark, sf_dir)))


def failed_check_table_documents(spark, sf_dir):
    table_ = failed_check_table(score_results(document_results(spark, sf_dir)))
    return table_.select("dataset_name", "label", "rank", "check", "severity", "actual")


def alerts_documents(spark, sf_dir):
    return alerts(document_results(spark, sf_dir), QualityConfig(alert_below=90)).select("dataset_name", "overall_score")


def failing_documents(spark, sf_dir):
    return with_failures(document_results(spark, sf_dir)).select("dataset_name", F.size("failed_checks").cast("bigint").alias("n"))


def combined_results(spark, sf_dir):
    """Records of two tables and all documents in one run."""
    results = (
        validate_structured(dirty_orders(spark, sf_dir), "dirty_orders", ORDERS_AS_OF)
        .unionByName(validate_structured(table(spark, sf_dir, "events"), "events", "2024-03-15"))
        .unionByName(document_results(spark, sf_dir))
    )
    return score_results(results).select("dataset_name", "data_type", "overall_score", "label")


# -- many runs: each event type scored daily ------------------------------------


def event_history(spark, sf_dir):
    """A result record per event type and day: the share of its values in range."""
    daily = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.round(F.avg(F.when(F.col("value") < 20, 1.0).otherwise(0.0)) * 100, 2).alias("score")
    )
    records = daily.select(
        F.date_format("day", "yyyy-MM-dd").alias("run_id"),
        F.col("event_type").alias("dataset_name"),
        F.lit("structured").alias("data_type"),
        F.col("score").alias("overall_score"),
        F.struct(*[F.col("score").alias(d) for d in DIMENSIONS]).alias("dimensions"),
        F.expr("array()").cast("array<struct<check:string,column:string,expected:string,actual:string,severity:string>>").alias("failed_checks"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        (F.col("score") >= 80).alias("passed"),
        F.col("day").cast("timestamp").alias("run_timestamp"),
        F.lit("events").alias("source_path"),
    )
    return records.select(*RESULT_COLUMNS)


def history_events(spark, sf_dir):
    return history(event_history(spark, sf_dir)).select("dataset_name", "run_id", "overall_score")


def history_deltas_events(spark, sf_dir):
    return score_history_deltas(event_history(spark, sf_dir)).select(
        "dataset_name", "run_id", "overall_score", "previous_score", "delta", "direction"
    )


def latest_per_event_type(spark, sf_dir):
    return latest_per_dataset(event_history(spark, sf_dir)).select("dataset_name", "run_id", "overall_score")


def latest_run_events(spark, sf_dir):
    return latest_run(event_history(spark, sf_dir)).select("dataset_name", "run_id", "overall_score")


def trend_events(spark, sf_dir):
    """The last day of each event type against the days before it; ``error`` has none kept."""
    records = event_history(spark, sf_dir)
    current = latest_per_dataset(records)
    newest = current.select("dataset_name", F.col("run_id").alias("newest"))
    earlier = records.where("dataset_name <> 'error'").join(newest, "dataset_name").where("run_id < newest")
    return compare_runs(current, earlier.drop("newest"))


def result_of_click(spark, sf_dir):
    return dataset_result(event_history(spark, sf_dir), "click").select("dataset_name", "run_id", "overall_score")


def oldest_score_of_click(spark, sf_dir):
    return dataset_score(event_history(spark, sf_dir), "click", newest=False)


# -- SQL ----------------------------------------------------------------------

_LABEL = "CASE WHEN overall_score >= 80 THEN 'PASS' WHEN overall_score >= 65 THEN 'WARN' ELSE 'FAIL' END"
_DOCS = (
    scored_cte()
    + f""", checks AS ({checks_union()}),
counts AS (SELECT doc_id, count(*) AS n FROM checks GROUP BY doc_id),
res AS (
  SELECT t.*, CAST(t.doc_id AS VARCHAR) AS dataset_name, {_LABEL} AS label, coalesce(n, 0) AS failed_checks
  FROM totals t LEFT JOIN counts USING (doc_id)) """
)
_EMPHASIS = ", ".join(
    f"{d}, CASE WHEN {d} < 32.5 THEN 'critical' WHEN {d} < 65 THEN 'warning' ELSE 'normal' END AS {d}_emphasis"
    for d in DIMENSIONS
)
_HISTORY = """WITH h AS (
  SELECT event_type AS dataset_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
    round(avg(CASE WHEN value < 20 THEN 1.0 ELSE 0.0 END) * 100, 2) AS overall_score
  FROM events GROUP BY 1, 2),
last AS (SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY run_id DESC) AS r FROM h) """
_DIRECTION = """CASE WHEN previous_score IS NULL THEN 'new' WHEN current_score - previous_score > 0.001 THEN 'up'
  WHEN current_score - previous_score < -0.001 THEN 'down' ELSE 'flat' END AS direction"""
_DELTA = "round(current_score - previous_score, 2) AS delta"

QUERIES = {
    "labels_documents": labels_documents,
    "summary_documents": summary_documents,
    "dataset_table_documents": dataset_table_documents,
    "dimension_table_documents": dimension_table_documents,
    "failed_check_table_documents": failed_check_table_documents,
    "alerts_documents": alerts_documents,
    "failing_documents": failing_documents,
    "combined_results": combined_results,
    "history_events": history_events,
    "history_deltas_events": history_deltas_events,
    "latest_per_event_type": latest_per_event_type,
    "latest_run_events": latest_run_events,
    "trend_events": trend_events,
    "result_of_click": result_of_click,
    "oldest_score_of_click": oldest_score_of_click,
}

SQL = {
    "labels_documents": _DOCS + "SELECT dataset_name, overall_score, label, label = 'PASS' AS passed FROM res",
    "summary_documents": _DOCS
    + """SELECT count(*) AS total_datasets,
  count(CASE WHEN label = 'PASS' THEN 1 END) AS pass_count, count(CASE WHEN label = 'WARN' THEN 1 END) AS warn_count,
  count(CASE WHEN label = 'FAIL' THEN 1 END) AS fail_count,
  round(count(CASE WHEN label = 'PASS' THEN 1 END) / count(*) * 100, 1) AS pass_pct,
  round(count(CASE WHEN label = 'WARN' THEN 1 END) / count(*) * 100, 1) AS warn_pct,
  round(count(CASE WHEN label = 'FAIL' THEN 1 END) / count(*) * 100, 1) AS fail_pct,
  round(avg(overall_score), 2) AS mean_score, round(min(overall_score), 2) AS min_score, round(max(overall_score), 2) AS max_score,
  count(CASE WHEN label <> 'PASS' THEN 1 END) = 0 AS pipeline_passed FROM res""",
    "dataset_table_documents": _DOCS
    + "SELECT dataset_name, 'text' AS data_type, overall_score, label, failed_checks FROM res",
    "dimension_table_documents": _DOCS + f"SELECT dataset_name, {_EMPHASIS} FROM res",
    "failed_check_table_documents": _DOCS
    + """SELECT dataset_name, label,
  row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN severity = 'error' THEN 0 ELSE 1 END, ord) AS rank,
  "check", severity, actual FROM checks JOIN res USING (doc_id)""",
    "alerts_documents": _DOCS + "SELECT dataset_name, overall_score FROM res WHERE overall_score < 90",
    "failing_documents": _DOCS + "SELECT dataset_name, failed_checks AS n FROM res WHERE failed_checks > 0",
    "combined_results": f"""
SELECT dataset_name, data_type, overall_score, {_LABEL} AS label FROM (
  SELECT dataset_name, data_type, overall_score FROM ({quality_sql("dirty_orders", DIRTY_ORDERS_SQL, DIRTY_ORDERS_COLUMNS, ORDERS_AS_OF)})
  UNION ALL SELECT dataset_name, data_type, overall_score FROM ({quality_sql("events", "SELECT * FROM events", EVENTS_COLUMNS, "2024-03-15")})
  UNION ALL SELECT dataset_name, 'text', overall_score FROM ({_DOCS} SELECT dataset_name, overall_score FROM res))""",
    "history_events": _HISTORY + "SELECT dataset_name, run_id, overall_score FROM h",
    "history_deltas_events": _HISTORY
    + f""", d AS (
  SELECT dataset_name, run_id, overall_score AS current_score,
    lag(overall_score) OVER (PARTITION BY dataset_name ORDER BY run_id) AS previous_score FROM h)
SELECT dataset_name, run_id, current_score AS overall_score, previous_score, {_DELTA}, {_DIRECTION} FROM d""",
    "latest_per_event_type": _HISTORY + "SELECT dataset_name, run_id, overall_score FROM last WHERE r = 1",
    "latest_run_events": _HISTORY
    + "SELECT dataset_name, run_id, overall_score FROM h WHERE run_id = (SELECT max(run_id) FROM h)",
    "trend_events": _HISTORY
    + f""", j AS (
  SELECT c.dataset_name, p.overall_score AS previous_score, c.overall_score AS current_score
  FROM last c LEFT JOIN last p ON c.dataset_name = p.dataset_name AND p.r = 2 AND p.dataset_name <> 'error' WHERE c.r = 1)
SELECT dataset_name, previous_score, current_score, {_DELTA}, {_DIRECTION} FROM j""",
    "result_of_click": _HISTORY + "SELECT dataset_name, run_id, overall_score FROM last WHERE r = 1 AND dataset_name = 'click'",
    "oldest_score_of_click": _HISTORY
    + "SELECT dataset_name, overall_score FROM h WHERE dataset_name = 'click' ORDER BY run_id LIMIT 1",
}
