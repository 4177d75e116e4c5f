"""Field metrics of semi-structured records.

Records come as one VARIANT column ``v``. A chain of generators walks them to
``(path, node)`` leaves inside the scan stage; the leaves are grouped by path
and type straight away, so what leaves a map task is one row per path and type.
Records whose schema is known take the typed route instead: struct fields are
selected by name and measured in one wide aggregate, without any explosion.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import RecordRules
from plumbline.functions import names
from plumbline.functions.dates import parse_datetime
from plumbline.functions.jsontext import (
    EMAIL_PATTERN,
    brackets,
    folded,
    leaf_text,
    type_name,
)
from plumbline.operators.columns import group_value, nullable_value
from plumbline.operators.duplicates import duplicate_summary
from plumbline.session import settled

# Levels of nesting that one plan walks.
STAGE_LEVELS = 16


def max_nesting_depth(records: DataFrame) -> DataFrame:
    """One row ``max_nesting_depth``, read off the brackets of the JSON text, each different sequence once."""
    shapes = records.select(brackets(F.to_json("v")).alias("shape")).distinct()
    depth = folded(F.col("shape"))["deepest"]
    return shapes.agg(F.coalesce(F.max(depth), F.lit(0)).cast("bigint").alias("max_nesting_depth"))


def measured_levels(records: DataFrame) -> int:
    """Deepest nesting as a number on the driver; it sizes the walk."""
    return max_nesting_depth(records).first()[0]


def flatten_records(records: DataFrame, levels: int | None = None) -> DataFrame:
    """Leaves ``(…, path, node, shape)`` of the records; other columns ride along.

    Objects open to dot paths, arrays stay leaves, empty objects vanish.
    Without ``levels`` the depth is measured first, so the walk always reaches
    the bottom; with it, an object left below the last level fails the job
    rather than going missing. A plan holds ``STAGE_LEVELS`` levels; nodes that
    lie deeper are settled and walked on, so one deep record costs small jobs.
    """
    walked = _walked(records, levels)
    leaf = "path IS NOT NULL AND NOT (node IS NOT NULL AND startswith(shape, 'OBJECT'))"
    return walked.where(leaf).select(*[names.quoted(c) for c in records.columns if c != "v"], "path", "node", "shape")


def _walked(records: DataFrame, levels: int | None = None, trails: bool = False) -> DataFrame:
    """All ends of the walk ``(…, path, node, shape)``: leaves, empty objects, and records that are no object.

    With ``trails`` a hash of the keys on the way, one by one, stands in ``trail``; dots in
    keys do not count there. Every record comes up at least once.
    """
    if levels is None:
        levels = measured_levels(records)
    spark = records.sparkSession
    others = [c for c in records.columns if c != "v"]
    begun = ["CAST(NULL AS BIGINT) AS trail"] if trails else []
    followed = ["CASE WHEN key IS NOT NULL THEN xxhash64(trail, key) ELSE trail END AS trail"] if trails else []
    # The type of a node is read once, when the node comes up; a leaf only
    # passes through the levels below it.
    nodes = records.selectExpr(
        *[f"`{c}`" for c in others], *begun, "CAST(NULL AS STRING) AS path", "v AS node", "schema_of_variant(v) AS shape"
    )
    left, parts = max(levels, 1), []
    while True:
        for _ in range(min(left, STAGE_LEVELS)):
            opened = nodes.withColumn("open", F.expr("CASE WHEN startswith(shape, 'OBJECT') THEN node END"))
            children = opened.lateralJoin(spark.tvf.variant_explode_outer(F.col("open").outer()))
            # An empty object that opens gives one row without a key: it ends there.
            nodes = children.selectExpr(
                *[f"`{c}`" for c in others],
                *followed,
                "CASE WHEN key IS NOT NULL THEN concat_ws('.', path, key) ELSE path END AS path",
                "CASE WHEN key IS NOT NULL THEN value ELSE node END AS node",
                "CASE WHEN key IS NOT NULL THEN schema_of_variant(value) ELSE shape END AS shape",
            )
        left -= STAGE_LEVELS
        if left <= 0:
            break
        # The few nodes that still open go on in a plan of their own.
        is_open = F.expr("node IS NOT NULL AND coalesce(startswith(shape, 'OBJECT') AND shape <> 'OBJECT<>', false)")
        parts.append(nodes.where(~is_open))
        nodes = settled(nodes.where(is_open))
    # An empty object below the last level is no leaf; any other object there is unfinished.
    parts.append(
        nodes.withColumn(
            "node",
            F.expr(
                "CASE WHEN startswith(shape, 'OBJECT') AND to_json(node) <> '{}' THEN "
                f"raise_error('records nest deeper than {levels} levels; measure the depth first') ELSE node END"
            ),
        )
    )
    return reduce(DataFrame.unionByName, parts)


def flatten_struct(df: DataFrame) -> DataFrame:
    """Struct fields as flat columns under their dot paths; arrays and maps stay whole."""

    def walk(fields, prefix, ref):
        for f in fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            column = names.quoted(f.name) if ref is None else ref.getField(f.name)
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType.fields, path, column)
            else:
                yield column.alias(path)

    return df.select(*walk(df.schema.fields, "", None))


# -- field metrics ------------------------------------------------------------


def _numeric_only(types: Column) -> Column:
    return F.size(F.array_except(types, F.array(F.lit("int"), F.lit("float")))) == 0


def _with_type_mix(fields: DataFrame) -> DataFrame:
    """Derive the type columns from ``type_counts: array<struct<type, n>>`` without nulls.

    Whole and broken numbers in one field are one numeric type, unless another
    type joins them. Equal counts go to the type first in name order.
    """
    all_types = F.array_sort(F.transform("type_counts", lambda t: t["type"]))
    merged = F.size("all_types") == 2
    by_count = F.array_sort(
        F.transform(
            "type_counts",
            lambda t: F.struct((-t["n"]).alias("rank"), t["type"].alias("type"), t["n"].alias("n")),
        )
    )
    numeric = fields.withColumn("all_types", all_types).withColumn(
        "one_number", _numeric_only(F.col("all_types")) & merged
    )
    top = numeric.withColumn("top", F.get(by_count, F.lit(0)))
    return (
        top.withColumn(
            "majority_type", F.when(F.col("one_number"), F.lit("float")).otherwise(F.col("top.type"))
        )
        .withColumn(
            "majority_count", F.when(F.col("one_number"), F.col("non_null")).otherwise(F.coalesce("top.n", F.lit(0)))
        )
        .withColumn(
            "type_count",
            F.when(F.col("one_number"), F.lit(1)).otherwise(F.size("all_types")).cast("bigint"),
        )
        .withColumn(
            "minority_types",
            F.when(F.col("one_number"), F.lit("")).otherwise(
                F.array_join(F.array_except("all_types", F.array("majority_type")), ", ")
            ),
        )
        .drop("all_types", "one_number", "top", "type_counts")
    )


def field_metrics(records: DataFrame, levels: int | None = None) -> DataFrame:
    """One row per path, from VARIANT records."""
    leaves = flatten_records(records.select("v"), levels)
    kind = type_name(F.col("shape"))
    text = F.col("node").cast("string")
    url = names.column_ends(F.col("path"), names.URL_SUFFIXES)
    email = names.column_ends(F.col("path"), (names.EMAIL_SUFFIX,))
    dated = names.column_has(F.col("path"), names.DATE_TOKENS)
    prepared = (
        leaves.select("path", kind.alias("type"), text.alias("text"))
        .withColumn("moment", F.when(dated & F.col("type").isin("str", "timestamp", "timestamp_ntz", "date"), parse_datetime("text")))
        .withColumn("bad_url", url & ~(F.col("text").startswith("http://") | F.col("text").startswith("https://")))
        .withColumn("bad_email", email & ~F.col("text").rlike(EMAIL_PATTERN))
    )
    filled = F.col("type") != "null"
    by_type = prepared.groupBy("path", "type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(filled & F.col("bad_url")).alias("bad_urls"),
        F.count_if(filled & F.col("bad_email")).alias("bad_emails"),
        F.count("moment").alias("dates"),
        F.max("moment").alias("latest"),
    )
    entry = F.when(filled, F.struct("type", "n"))
    fields = by_type.groupBy("path").agg(
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("non_null"),
        F.collect_list(entry).alias("type_counts"),
        F.sum("bad_urls").alias("bad_urls"),
        F.sum("bad_emails").alias("bad_emails"),
        F.sum("dates").alias("dates"),
        F.max("latest").alias("latest"),
    )
    total = records.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _with_type_mix(fields).withColumn("record_count", total)


# JSON type names of Spark types.
_TYPED_NAMES = (
    (T.IntegralType, "int"),
    (T.BooleanType, "bool"),
    ((T.DoubleType, T.FloatType, T.DecimalType), "float"),
    (T.StringType, "str"),
    (T.ArrayType, "list"),
    (T.MapType, "dict"),
    (T.DateType, "date"),
    ((T.TimestampType, T.TimestampNTZType), "timestamp"),
)


def typed_field_metrics(df: DataFrame) -> DataFrame:
    """The same table for records with a known schema: one scan, one wide aggregate."""
    flat = flatten_struct(df)
    fields = flat.schema.fields
    values = flat.select(
        *[nullable_value(names.quoted(f.name), f.dataType).alias(f"c{i}") for i, f in enumerate(fields)]
    )
    moments, aggregates = [], [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        kind = names.kind_of(f.dataType)
        c, lowered = F.col(f"c{i}"), f.name.lower()
        if kind == names.TEMPORAL:
            moments.append(c.cast("timestamp").alias(f"ts{i}"))
        elif kind == names.STRING and names.name_has(f.name, names.DATE_TOKENS):
            moments.append(parse_datetime(f"c{i}").alias(f"ts{i}"))
        aggregates.append(F.count(c).alias(f"present{i}"))
        text = c.cast("string")
        if lowered.endswith(names.URL_SUFFIXES):
            bad = ~(text.startswith("http://") | text.startswith("https://"))
            aggregates.append(F.count_if(bad).alias(f"url{i}"))
        if lowered.endswith(names.EMAIL_SUFFIX):
            aggregates.append(F.count_if(~text.rlike(EMAIL_PATTERN)).alias(f"email{i}"))
    parsed = values.select("*", *moments)
    for i in range(len(fields)):
        if f"ts{i}" in parsed.columns:
            aggregates += [F.count(f"ts{i}").alias(f"dates{i}"), F.max(f"ts{i}").alias(f"latest{i}")]
    wide = parsed.agg(*aggregates)

    def pick(name: str, kind: str, default=0) -> Column:
        return (F.col(name) if name in wide.columns else F.lit(default)).cast(kind)

    rows = []
    for i, f in enumerate(fields):
        json_type = next((n for t, n in _TYPED_NAMES if isinstance(f.dataType, t)), f.dataType.simpleString())
        present = F.col(f"present{i}")
        filled = present > 0
        rows.append(
            F.struct(
                F.lit(f.name).alias("path"),
                present.alias("non_null"),
                pick(f"url{i}", "bigint").alias("bad_urls"),
                pick(f"email{i}", "bigint").alias("bad_emails"),
                pick(f"dates{i}", "bigint").alias("dates"),
                pick(f"latest{i}", "timestamp", None).alias("latest"),
                F.when(filled, F.lit(json_type)).alias("majority_type"),
                present.alias("majority_count"),
                filled.cast("bigint").alias("type_count"),
                F.lit("").alias("minority_types"),
                F.col("rows").alias("record_count"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def field_profile(fields: DataFrame, rules: RecordRules = RecordRules()) -> DataFrame:
    """Null percentage, type consistency and sparseness of each path."""
    nulls = F.col("record_count") - F.col("non_null")
    return fields.select(
        "path",
        "record_count",
        "non_null",
        F.coalesce(F.try_divide(nulls, F.col("record_count")) * 100, F.lit(0.0)).alias("null_pct"),
        (F.col("type_count") <= 1).alias("type_consistent"),
        (F.col("non_null") < rules.sparse_share * F.col("record_count")).alias("is_unexpected"),
        "majority_type",
    )


# -- duplicates ---------------------------------------------------------------


def record_digests(records: DataFrame, levels: int | None = None) -> DataFrame:
    """``(d0, d1, d2, d3)`` of every VARIANT record: equal exactly when the same non-null fields are.

    A record's digest is the sum, over its leaves, of two 64-bit hashes of keys and
    value, so their order does not matter and the leaves of a record combine in the task that
    walked them; 32 bytes of each record are shuffled. Null fields and empty objects add
    nothing. Sums are kept of 32 bits each, which cannot overflow.
    """
    if levels is None:
        levels = measured_levels(records)
    numbered = records.select(F.monotonically_increasing_id().alias("record"), "v")
    if levels > STAGE_LEVELS:
        # Walked in several jobs, which must agree on the numbers.
        numbered = settled(numbered)
    ends = _walked(numbered, levels, trails=True)
    empty = F.is_variant_null("node") & F.col("trail").isNotNull() | F.col("shape").startswith("OBJECT")
    text = F.when(F.col("node").isNull(), F.lit("missing")).when(~empty, leaf_text(F.col("node"), F.col("shape")))
    hashed = ends.select("record", "trail", text.alias("text")).select(
        "record",
        F.when(F.col("text").isNotNull(), F.xxhash64("trail", "text")).alias("a"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text", F.lit(1), "trail")).alias("b"),
    )
    halves = [half for c in "ab" for half in (F.col(c).bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(c, 32))]
    sums = [F.coalesce(F.sum(half), F.lit(0)).alias(f"d{i}") for i, half in enumerate(halves)]
    return hashed.groupBy("record").agg(*sums).drop("record")


def duplicate_records(records: DataFrame, levels: int | None = None) -> DataFrame:
    """Copies after the first among VARIANT records; an absent field equals a null one."""
    return duplicate_summary(record_digests(records.select("v"), levels))


def typed_duplicate_records(df: DataFrame) -> DataFrame:
    flat = flatten_struct(df)
    return duplicate_summary(
        flat.select(
            *[group_value(names.quoted(f.name), f.dataType).alias(f"c{i}") for i, f in enumerate(flat.schema.fields)]
        )
    )
