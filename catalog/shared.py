"""Inputs with defects, written once for Spark and once for SQL.

The given tables are clean, so each query derives nulls, wrong signs, mixed
types and copies from the values themselves, over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDERS_AS_OF = "2001-08-20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows in partitions of even size, as many as the planner finds fit.

    A file of a few large row groups is read by as many tasks. What computes long on
    each row is worth a shuffle of the columns that it needs; select those first.
    """
    return df.hint("rebalance")


# Valid in Spark and in DuckDB alike.
DIRTY_ORDERS_SELECT = """
SELECT
  o_orderkey AS order_id,
  o_custkey AS customer_id,
  nullif(o_orderpriority, '5-LOW') AS priority,
  CASE WHEN o_totalprice < 25000 THEN NULL
       WHEN o_totalprice > 480000 THEN -o_totalprice
       ELSE o_totalprice END AS price,
  CASE WHEN o_totalprice > 499000 THEN o_totalprice * 100 ELSE o_totalprice END AS amount,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS {text}) ELSE o_orderstatus END AS status,
  'EUR' AS currency,
  CAST(CAST(o_orderdate AS DATE) AS {text}) AS placed_on,
  CASE WHEN o_orderpriority = '1-URGENT' THEN repeat(o_orderpriority, 150) ELSE o_orderpriority END AS note,
  o_orderdate AS created_at
FROM {orders}
"""


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    select = DIRTY_ORDERS_SELECT.format(text="STRING", orders="{orders}")
    return spark.sql(select, orders=table(spark, sf_dir, "orders"))


DIRTY_ORDERS_SQL = DIRTY_ORDERS_SELECT.format(text="VARCHAR", orders="orders")

# (name, kind, Spark type) of each column above.
DIRTY_ORDERS_COLUMNS = [
    ("order_id", "numeric", "bigint"),
    ("customer_id", "numeric", "bigint"),
    ("priority", "string", "string"),
    ("price", "numeric", "double"),
    ("amount", "numeric", "double"),
    ("status", "string", "string"),
    ("currency", "string", "string"),
    ("placed_on", "string", "string"),
    ("note", "string", "string"),
    ("created_at", "temporal", "timestamp_ntz"),
]

LINEITEM_COLUMNS = [
    ("l_orderkey", "numeric", "bigint"),
    ("l_partkey", "numeric", "bigint"),
    ("l_suppkey", "numeric", "bigint"),
    ("l_linenumber", "numeric", "int"),
    ("l_quantity", "numeric", "double"),
    ("l_extendedprice", "numeric", "double"),
    ("l_discount", "numeric", "double"),
    ("l_tax", "numeric", "double"),
    ("l_returnflag", "string", "string"),
    ("l_linestatus", "string", "string"),
    ("l_shipdate", "temporal", "timestamp_ntz"),
]
EVENTS_COLUMNS = [
    ("event_id", "numeric", "bigint"),
    ("ts", "temporal", "timestamp_ntz"),
    ("user_id", "numeric", "bigint"),
    ("event_type", "string", "string"),
    ("value", "numeric", "double"),
    ("props", "string", "string"),
]
