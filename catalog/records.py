"""Queries over semi-structured records: JSON text derived from the tables, and ``events.props``."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.shared import spread, table
from plumbline.config import DIMENSIONS
from plumbline.functions.jsontext import is_whole_json, nesting_depth, parse_whole_json
from plumbline.operators.records import (
    duplicate_records,
    field_metrics,
    field_profile,
    flatten_records,
    flatten_struct,
    max_nesting_depth,
    typed_field_metrics,
)
from plumbline.plans.records import record_checks, record_scores, validate_records
from plumbline.sources.inventory import match_raw_sources, with_routes
from plumbline.sources.records import log_record

RECORDS_AS_OF = "2001-10-05"

# JSON records of the orders: nested, with fields that are absent, null, of
# mixed type, badly named or badly formed, and with copies once the order key
# is left out. Valid in Spark and in DuckDB alike.
ORDER_JSON = """
'{"customer":{"key":' || o_custkey || ',"profile_url":"' ||
  CASE WHEN o_orderstatus = 'P' THEN 'ftp://' ELSE 'https://' END || o_custkey ||
  '","contact_email":"' || CASE WHEN o_orderpriority = '2-HIGH' THEN 'nobody' ELSE 'c@example.com' END ||
  '"},"created_at":"' || CAST(CAST(o_orderdate AS DATE) AS {text}) ||
  '","priority":' || CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE '"' || o_orderpriority || '"' END ||
  ',"total":' || CASE WHEN o_orderstatus = 'F' THEN '"' || o_orderpriority || '"' ELSE CAST(o_custkey AS {text}) END ||
  CASE WHEN o_totalprice > 490000 THEN ',"rare":{"debug flag":true}' ELSE '' END ||
  CASE WHEN o_totalprice < 5000 THEN ',"path":{"a":{"b":{"c":[{"d":[1]}]}}}' ELSE ',"path":null' END ||
  ',"tags":["x",' || length(o_orderpriority) || ']}'
"""
ORDER_JSON_SPARK = ORDER_JSON.replace("{text}", "STRING")
ORDER_JSON_SQL = ORDER_JSON.replace("{text}", "VARCHAR")


def order_records(spark, sf_dir):
    columns = ("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
    texts = spread(table(spark, sf_dir, "orders").select(*columns)).select(F.expr(ORDER_JSON_SPARK).alias("text"))
    return texts.select(F.parse_json("text").alias("v"))


def _profile(fields):
    return field_profile(fields).select(
        "path", "record_count", "non_null", F.round("null_pct", 4).alias("null_pct"), "type_consistent",
        "is_unexpected",
    )


def field_profile_orders(spark, sf_dir):
    return _profile(field_metrics(order_records(spark, sf_dir)))


def type_mix_orders(spark, sf_dir):
    fields = field_metrics(order_records(spark, sf_dir))
    return fields.where("non_null > 0").select("path", "majority_type", "majority_count", "minority_types")


def field_profile_props(spark, sf_dir):
    props = table(spark, sf_dir, "events").select(F.parse_json("props").alias("v"))
    return _profile(field_metrics(props))


def flattened_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("v"))
    return flatten_records(events).select("event_id", "path", F.col("node").cast("string").alias("value"))


def typed_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        F.struct("conv_id", "turn").alias("key"),
        F.struct(F.col("role"), F.expr("nullif(role, 'assistant')").alias("speaker_email")).alias("who"),
        F.expr("CASE WHEN length(text) > 200 THEN text END").alias("long_text"),
    )


def flat_conversations(spark, sf_dir):
    flat = flatten_struct(typed_conversations(spark, sf_dir))
    return flat.select(
        F.col("`key.conv_id`").alias("conv_id"), F.col("`key.turn`").alias("turn"), F.col("`who.role`").alias("role"),
        F.length("long_text").cast("bigint").alias("chars"),
    )


def typed_profile_conversations(spark, sf_dir):
    return _profile(typed_field_metrics(typed_conversations(spark, sf_dir)))


def nesting_depth_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", nesting_depth(F.expr(ORDER_JSON_SPARK)).cast("bigint").alias("depth"))


def max_depth_orders(spark, sf_dir):
    return max_nesting_depth(order_records(spark, sf_dir))


def duplicate_records_orders(spark, sf_dir):
    summary = duplicate_records(order_records(spark, sf_dir))
    return summary.withColumn("duplicate_rate", F.round("duplicate_rate", 6))


def checks_order_records(spark, sf_dir):
    return record_checks(order_records(spark, sf_dir), RECORDS_AS_OF)


def scores_order_records(spark, sf_dir):
    scores = record_scores(order_records(spark, sf_dir), RECORDS_AS_OF)
    return scores.select(*[F.round(d, 4).alias(d) for d in DIMENSIONS])


def quality_order_records(spark, sf_dir):
    result = validate_records(order_records(spark, sf_dir), "order_records", RECORDS_AS_OF)
    return result.select(
        "dataset_name", "data_type", "overall_score", "passed", F.size("failed_checks").cast("bigint").alias("failed_checks")
    )


def log_lines(spark, sf_dir):
    """Log lines, JSON and raw: the payload of each event, wrapped or cut short."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.expr(
            "CASE WHEN event_type = 'error' THEN 'ERROR ' || props WHEN event_type = 'click' THEN props || ' x' "
            "WHEN event_type = 'view' THEN CAST(user_id AS STRING) ELSE props END"
        ).alias("line"),
    )


def log_kinds(spark, sf_dir):
    parsed = log_lines(spark, sf_dir).withColumn("parsed", parse_whole_json(F.col("line")))
    record = parsed.select("event_id", log_record(F.col("line"), F.col("parsed")).alias("v"))
    return record.select(
        "event_id",
        F.try_variant_get("v", "$.raw_line", "string").alias("raw_line"),
        F.try_variant_get("v", "$.value", "bigint").alias("value"),
        F.try_variant_get("v", "$.k", "bigint").alias("k"),
    )


def malformed_log_lines(spark, sf_dir):
    lines = log_lines(spark, sf_dir)
    return lines.agg(
        F.count(F.lit(1)).alias("line_count"), F.count_if(~is_whole_json(F.col("line"))).alias("malformed_count")
    )


def routed_pages(spark, sf_dir):
    """Page addresses routed as if they were files."""
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in (".csv", ".JSON", ".txt", ".bin", "")]),
        (F.pmod(F.length("html"), F.lit(5)) + 1).cast("int"),
    )
    files = table(spark, sf_dir, "pages").select(F.concat(F.lit("in/"), "page_id", suffix).alias("path"))
    return with_routes(files)


def matched_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    raw = with_routes(docs.where("lang <> 'fr'").select(F.concat(F.lit("raw/"), "doc_id", F.lit(".json")).alias("path")))
    extracted = with_routes(docs.select(F.concat(F.lit("out/"), "doc_id", F.lit("_extracted.csv")).alias("path")))
    return match_raw_sources(extracted, raw)


# -- SQL ----------------------------------------------------------------------

# Each record's fields as (path, type, text) rows, computed from the columns.
FIELDS_CTE = """WITH r AS (SELECT * FROM orders),
leaf AS (
  SELECT 'customer.key' AS path, 'int' AS type, CAST(o_custkey AS VARCHAR) AS value FROM r
  UNION ALL SELECT 'customer.profile_url', 'str', CASE WHEN o_orderstatus = 'P' THEN 'ftp://' ELSE 'https://' END FROM r
  UNION ALL SELECT 'customer.contact_email', 'str', CASE WHEN o_orderpriority = '2-HIGH' THEN 'nobody' ELSE 'c@example.com' END FROM r
  UNION ALL SELECT 'created_at', 'str', CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM r
  UNION ALL SELECT 'priority', CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE 'str' END, o_orderpriority FROM r
  UNION ALL SELECT 'total', CASE WHEN o_orderstatus = 'F' THEN 'str' ELSE 'int' END, '' FROM r
  UNION ALL SELECT 'rare.debug flag', 'bool', 'true' FROM r WHERE o_totalprice > 490000
  UNION ALL SELECT 'path.a.b.c', 'list', '' FROM r WHERE o_totalprice < 5000
  UNION ALL SELECT 'path', 'null', '' FROM r WHERE o_totalprice >= 5000
  UNION ALL SELECT 'tags', 'list', '' FROM r),
n AS (SELECT count(*) AS record_count FROM r),
by_type AS (SELECT path, type, count(*) AS c FROM leaf WHERE type <> 'null' GROUP BY path, type),
top AS (
  SELECT path, max(c) AS majority_count, arg_min(type, (-c, type)) AS majority_type, count(*) AS type_count FROM by_type GROUP BY path),
f AS (
  SELECT l.path, any_value(record_count) AS record_count, count(CASE WHEN type <> 'null' THEN 1 END) AS non_null,
    coalesce(any_value(majority_count), 0) AS majority_count, any_value(majority_type) AS majority_type,
    coalesce(any_value(type_count), 0) AS type_count,
    count(CASE WHEN l.path LIKE '%\\_url' ESCAPE '\\' AND value NOT LIKE 'http%' THEN 1 END) AS bad_urls,
    count(CASE WHEN l.path LIKE '%\\_email' ESCAPE '\\' AND value NOT LIKE '%@%.%' THEN 1 END) AS bad_emails,
    max(CASE WHEN l.path = 'created_at' THEN value END) AS latest
  FROM leaf l CROSS JOIN n LEFT JOIN top t ON l.path = t.path GROUP BY l.path)"""

_PROFILE_SQL = """SELECT path, record_count, non_null, round((record_count - non_null) / record_count * 100, 4) AS null_pct,
  type_count <= 1 AS type_consistent, non_null < 0.1 * record_count AS is_unexpected FROM f"""

DEPTH_SQL = "CASE WHEN o_totalprice < 5000 THEN 7 ELSE 2 END"

_DUP = f"""dup AS (
  SELECT count(*) AS row_count, count(*) - count(DISTINCT replace(j, ',"path":null', '')) AS duplicate_count
  FROM (SELECT {ORDER_JSON_SQL} AS j FROM orders))"""

_DERIVED = (
    FIELDS_CTE
    + f""", {_DUP},
e AS (
  SELECT *, (record_count - non_null) / record_count AS null_rate,
    coalesce((non_null - majority_count) / nullif(non_null, 0), 0) AS mix_rate,
    date_diff('day', CAST(latest AS DATE), DATE '{RECORDS_AS_OF}') AS age_days
  FROM f),
depth AS (SELECT max({DEPTH_SQL}) AS d FROM orders)"""
)

_RECORD_CHECKS = """
SELECT 'completeness' AS dimension, 'null_rate' AS "check", path AS "column", 'null_rate <= 10%' AS expected,
  printf('%.2f%%', null_rate * 100) AS actual, CASE WHEN null_rate > 0.5 THEN 'error' ELSE 'warning' END AS severity
FROM e WHERE null_rate > 0.1
UNION ALL SELECT 'accuracy', 'type_inconsistency', path, '<= 5% minority-type values',
  printf('%.1f%%', mix_rate * 100) || ' of values are ' || CASE WHEN majority_type = 'str' THEN 'int' ELSE 'str' END ||
  ' (majority: ' || majority_type || ')', CASE WHEN mix_rate > 0.25 THEN 'error' ELSE 'warning' END
FROM e WHERE mix_rate > 0.05
UNION ALL SELECT 'consistency', 'unexpected_key', path, 'field present in >= 10% of records',
  'field present in < 10% of records', 'warning' FROM e WHERE non_null < 0.1 * record_count
UNION ALL SELECT 'consistency', 'invalid_field_name', path, 'field name with only letters, digits, _ or .',
  'contains invalid character(s): '' ''', 'error' FROM e WHERE path LIKE '% %'
UNION ALL SELECT 'freshness', 'stale_data', path, 'most recent value within 30 days',
  'most recent value is ' || latest || ' (' || age_days || ' days ago)',
  CASE WHEN age_days >= 90 THEN 'error' ELSE 'warning' END FROM e WHERE age_days > 30
UNION ALL SELECT 'uniqueness', 'duplicate_records', 'dataset', 'duplicate_rate <= 1%',
  printf('%.2f%% (%d record(s))', duplicate_count / row_count * 100, duplicate_count),
  CASE WHEN duplicate_count / row_count > 0.1 THEN 'error' ELSE 'warning' END
FROM dup WHERE duplicate_count / row_count > 0.01
UNION ALL SELECT 'validity', 'excessive_nesting_depth', 'dataset', 'max_nesting_depth <= 5', 'max_nesting_depth = ' || d, 'error'
FROM depth WHERE d > 5
UNION ALL SELECT 'validity', 'invalid_url', path, 'values starting with http:// or https://',
  bad_urls || ' value(s) do not start with http', CASE WHEN bad_urls / non_null < 0.25 THEN 'warning' ELSE 'error' END
FROM e WHERE bad_urls > 0
UNION ALL SELECT 'validity', 'invalid_email', path, 'values matching <local>@<domain>.<tld>',
  bad_emails || ' value(s) do not match email pattern', CASE WHEN bad_emails / non_null < 0.25 THEN 'warning' ELSE 'error' END
FROM e WHERE bad_emails > 0"""

_RECORD_SCORES = """s AS (
  SELECT avg(1 - null_rate) * 100 AS completeness,
    (1 - count(CASE WHEN mix_rate > 0.05 THEN 1 END) / count(*)) * 100 AS accuracy,
    greatest(0.0, 100.0 - 10 * count(CASE WHEN non_null < 0.1 * record_count THEN 1 END)
      - 10 * count(CASE WHEN path LIKE '% %' THEN 1 END)) AS consistency,
    CASE WHEN coalesce(max(age_days), 0) <= 30 THEN 100.0 WHEN max(age_days) >= 90 THEN 0.0
      ELSE 100 - (max(age_days) - 30) / 60 * 100 END AS freshness,
    (1 - any_value(duplicate_count) / any_value(row_count)) * 100 AS uniqueness,
    (1 + 2 - count(CASE WHEN bad_urls + bad_emails > 0 THEN 1 END) - CASE WHEN any_value(d) > 5 THEN 1 ELSE 0 END) / 3 * 100 AS validity
  FROM e, dup, depth)"""

_LOG_LINE = (
    "CASE WHEN event_type = 'error' THEN 'ERROR ' || props WHEN event_type = 'click' THEN props || ' x' "
    "WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) ELSE props END"
)

QUERIES = {
    "field_profile_orders": field_profile_orders,
    "type_mix_orders": type_mix_orders,
    "field_profile_props": field_profile_props,
    "flattened_props": flattened_props,
    "flat_conversations": flat_conversations,
    "typed_profile_conversations": typed_profile_conversations,
    "nesting_depth_orders": nesting_depth_orders,
    "max_depth_orders": max_depth_orders,
    "duplicate_records_orders": duplicate_records_orders,
    "checks_order_records": checks_order_records,
    "scores_order_records": scores_order_records,
    "quality_order_records": quality_order_records,
    "log_kinds": log_kinds,
    "malformed_log_lines": malformed_log_lines,
    "routed_pages": routed_pages,
    "matched_sources": matched_sources,
}

SQL = {
    "field_profile_orders": FIELDS_CTE + _PROFILE_SQL,
    "type_mix_orders": FIELDS_CTE
    + """ SELECT path, majority_type, majority_count,
  CASE WHEN type_count < 2 THEN '' WHEN majority_type = 'str' THEN 'int' ELSE 'str' END AS minority_types FROM f WHERE non_null > 0""",
    "field_profile_props": """
SELECT 'k' AS path, count(*) AS record_count, count(json_extract(props, '$.k')) AS non_null,
  round((count(*) - count(json_extract(props, '$.k'))) / count(*) * 100, 4) AS null_pct, true AS type_consistent,
  count(json_extract(props, '$.k')) < 0.1 * count(*) AS is_unexpected FROM events""",
    "flattened_props": "SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS value FROM events",
    "flat_conversations": """
SELECT conv_id, turn, role, CASE WHEN length(text) > 200 THEN length(text) END AS chars FROM conversations""",
    "typed_profile_conversations": " UNION ALL ".join(
        f"SELECT '{path}' AS path, count(*) AS record_count, count({c}) AS non_null, "
        f"round((count(*) - count({c})) / count(*) * 100, 4) AS null_pct, true AS type_consistent, "
        f"count({c}) < 0.1 * count(*) AS is_unexpected FROM conversations"
        for path, c in (
            ("key.conv_id", "conv_id"),
            ("key.turn", "turn"),
            ("who.role", "role"),
            ("who.speaker_email", "nullif(role, 'assistant')"),
            ("long_text", "CASE WHEN length(text) > 200 THEN text END"),
        )
    ),
    "nesting_depth_orders": f"SELECT o_orderkey, {DEPTH_SQL} AS depth FROM orders",
    "max_depth_orders": f"SELECT max({DEPTH_SQL}) AS max_nesting_depth FROM orders",
    "duplicate_records_orders": f"""
WITH {_DUP} SELECT row_count, duplicate_count, round(duplicate_count / row_count, 6) AS duplicate_rate FROM dup""",
    "checks_order_records": _DERIVED + _RECORD_CHECKS,
    "scores_order_records": _DERIVED
    + ", "
    + _RECORD_SCORES
    + " SELECT "
    + ", ".join(f"round({d}, 4) AS {d}" for d in DIMENSIONS)
    + " FROM s",
    "quality_order_records": _DERIVED
    + ", "
    + _RECORD_SCORES
    + f""", failed AS ({_RECORD_CHECKS}),
o AS (SELECT round(round(completeness, 2) * 0.25 + round(accuracy, 2) * 0.25 + round(consistency, 2) * 0.15
  + round(freshness, 2) * 0.15 + round(uniqueness, 2) * 0.1 + round(validity, 2) * 0.1, 2) AS overall_score FROM s)
SELECT 'order_records' AS dataset_name, 'semi_structured' AS data_type, overall_score, overall_score >= 80 AS passed,
  (SELECT count(*) FROM failed) AS failed_checks FROM o""",
    "log_kinds": f"""
WITH l AS (SELECT event_id, event_type, {_LOG_LINE} AS line FROM events)
SELECT event_id, CASE WHEN NOT json_valid(line) THEN line END AS raw_line,
  CASE WHEN event_type = 'view' THEN CAST(line AS BIGINT) END AS value,
  CASE WHEN json_valid(line) AND event_type <> 'view' THEN CAST(json_extract(line, '$.k') AS BIGINT) END AS k FROM l""",
    "malformed_log_lines": f"""
SELECT count(*) AS line_count, count(CASE WHEN NOT json_valid({_LOG_LINE}) THEN 1 END) AS malformed_count FROM events""",
    "routed_pages": """
WITH p AS (SELECT page_id, (['.csv', '.JSON', '.txt', '.bin', ''])[length(html) % 5 + 1] AS s FROM pages)
SELECT 'in/' || page_id || s AS path, CAST(page_id AS VARCHAR) AS stem, lower(s) AS suffix,
  CASE lower(s) WHEN '.csv' THEN 'structured' WHEN '.json' THEN 'semi_structured' WHEN '.txt' THEN 'text' END AS data_type
FROM p""",
    "matched_sources": """
SELECT CAST(doc_id AS VARCHAR) AS stem, 'out/' || doc_id || '_extracted.csv' AS extracted_path,
  CASE WHEN lang <> 'fr' THEN 'raw/' || doc_id || '.json' END AS raw_path FROM documents""",
}
