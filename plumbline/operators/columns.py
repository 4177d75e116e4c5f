"""Column metrics of a table: one row per column, a few scans, no driver loop.

Everything that needs no exchange of values (null counts, moments, parse
ratios, range counts) is one global aggregate over one scan. Outliers take a
second scan because they compare cells with the finished moments. Exact
distinct counts take a shuffle, which partial aggregation keeps to one row per
distinct value and map task, whatever the skew. The pieces meet through scalar
subqueries, whose size is the number of columns.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from plumbline.config import DIMENSIONS, StructuredRules, as_of_column
from plumbline.functions import names
from plumbline.functions.dates import parse_datetime, parse_number
from plumbline.operators.selection import selected_quantiles
from plumbline.session import settled


@dataclass(frozen=True)
class ColumnInfo:
    position: int
    name: str
    dtype: T.DataType
    kind: str

    @property
    def ref(self) -> str:
        """Positional alias, safe whatever the real name holds."""
        return f"c{self.position}"


def describe(df: DataFrame) -> list[ColumnInfo]:
    return [
        ColumnInfo(i, f.name, f.dataType, names.kind_of(f.dataType))
        for i, f in enumerate(df.schema.fields)
    ]


def nullable_value(column: Column, dtype: T.DataType) -> Column:
    """The value with NaN read as null."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return column


def positional(df: DataFrame, infos: Iterable[ColumnInfo] | None = None) -> DataFrame:
    """The columns under their positional aliases, NaN read as null."""
    infos = describe(df) if infos is None else infos
    return df.select(
        *[nullable_value(names.quoted(c.name), c.dtype).alias(c.ref) for c in infos]
    )


def group_value(column: Column, dtype: T.DataType) -> Column:
    """A form of the value that GROUP BY accepts: maps and variants made canonical."""
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(column))
    if isinstance(dtype, T.VariantType):
        return F.to_json(column)
    return nullable_value(column, dtype)


def text_value(column: Column, dtype: T.DataType) -> Column:
    """A text form that is equal exactly when the values are equal."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        column = nullable_value(column, dtype)
        return F.when(column == 0, F.lit("0.0")).otherwise(column.cast("string"))
    if isinstance(dtype, T.BinaryType):
        return F.base64(column)
    if isinstance(dtype, (T.MapType, T.ArrayType, T.StructType, T.VariantType)):
        canonical = group_value(column, dtype)
        return canonical if isinstance(dtype, T.VariantType) else F.to_json(canonical)
    return column.cast("string")


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# -- moments and range counts -------------------------------------------------

# What each dimension reads, so that one can be computed without what the others need.
METRICS_OF = {
    "completeness": ("present",),
    "accuracy": ("present", "single", "min", "max", "mean", "std"),
    "consistency": ("present", "single", "numeric", "dates"),
    "freshness": ("present", "dates", "latest"),
    "uniqueness": ("present", "single"),
    "validity": ("present", "dates", "negative", "future", "long"),
}
COUNT_DISTINCT = ("accuracy", "consistency", "uniqueness")


def range_metrics(
    df: DataFrame, as_of, rules: StructuredRules, dimensions: Iterable[str] = DIMENSIONS
) -> DataFrame:
    """One row holding every scan-only metric of ``dimensions``, as ``rows`` and ``<metric>_<position>``."""
    infos = describe(df)
    values = positional(df, infos)
    parsed = [F.col(c.ref) for c in infos]
    for c in infos:
        if c.kind == names.STRING:
            parsed.append(parse_number(c.ref).alias(f"{c.ref}_num"))
            parsed.append(parse_datetime(c.ref).alias(f"{c.ref}_ts"))
        elif c.kind == names.TEMPORAL:
            parsed.append(F.col(c.ref).cast("timestamp").alias(f"{c.ref}_ts"))
        elif c.kind == names.NUMERIC:
            parsed.append(F.col(c.ref).cast("double").alias(f"{c.ref}_x"))
    parsed.append(F.date_trunc("day", as_of_column(as_of)).alias("midnight"))
    # Written as SQL text: a wide table has hundreds of these, and one string
    # costs a fraction of the calls that as many column objects would.
    aggregates = ["count(1) AS rows"]
    for c in infos:
        i, ref = c.position, c.ref
        aggregates.append(f"count({ref}) AS present_{i}")
        if c.kind in (names.NUMERIC, names.TEMPORAL):
            aggregates.append(f"min({ref}) = max({ref}) AS single_{i}")
        if c.kind == names.NUMERIC:
            aggregates += [
                f"min({ref}_x) AS min_{i}",
                f"max({ref}_x) AS max_{i}",
                f"avg({ref}_x) AS mean_{i}",
                f"stddev_samp({ref}_x) AS std_{i}",
            ]
            if names.name_has(c.name, names.NON_NEGATIVE_TOKENS, rules.strict_names):
                aggregates.append(f"count_if({ref}_x < 0) AS negative_{i}")
        if c.kind == names.STRING:
            aggregates += [
                f"count({ref}_num) AS numeric_{i}",
                f"count({ref}_ts) AS dates_{i}",
                f"count_if(length({ref}) > {rules.max_string_length}) AS long_{i}",
            ]
        if c.kind in (names.STRING, names.TEMPORAL):
            aggregates += [f"max({ref}_ts) AS latest_{i}", f"count_if({ref}_ts > midnight) AS future_{i}"]
    wanted = {"rows"}.union(*[METRICS_OF[d] for d in dimensions])
    kept = [a for a in aggregates if a.rsplit(" AS ", 1)[1].split("_")[0] in wanted]
    return values.select(*parsed).selectExpr(*kept)


def outlier_counts(df: DataFrame, z_limit: float = 3.0, ranges: DataFrame | None = None) -> DataFrame:
    """One row, ``outliers_<position>`` per numeric column.

    A cell is an outlier when it lies more than ``z_limit`` sample standard
    deviations from its column's mean. The moments reach the counting scan as
    a scalar subquery, from the row of :func:`range_metrics` where that is at
    hand; a column with one value or no spread counts none.
    """
    infos = [c for c in describe(df) if c.kind == names.NUMERIC]
    if not infos:
        return df.select().agg(F.count(F.lit(1)).alias("rows"))
    values = positional(df, infos).select(*[F.col(c.ref).cast("double").alias(c.ref) for c in infos])
    if ranges is None:
        ranges = values.agg(
            *[F.avg(c.ref).alias(f"mean_{c.position}") for c in infos],
            *[F.stddev_samp(c.ref).alias(f"std_{c.position}") for c in infos],
        )
    moments = ranges.select(
        F.struct(
            *[F.col(f"mean_{c.position}").alias(f"m_{c.position}") for c in infos],
            *[F.col(f"std_{c.position}").alias(f"s_{c.position}") for c in infos],
        )
    ).scalar()
    counts = [
        f"count_if(abs(({c.ref} - moments.m_{c.position}) / nullif(moments.s_{c.position}, 0)) > {z_limit}) "
        f"AS outliers_{c.position}"
        for c in infos
    ]
    return values.withColumn("moments", moments).selectExpr(*counts)


# -- distinct values ----------------------------------------------------------


def comparable(column: Column, dtype: T.DataType) -> tuple[str, Column]:
    """The narrowest common type that keeps the value's equality, and the value in it."""
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return "bigint", column.cast("bigint")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "double", nullable_value(column, dtype).cast("double")
    if isinstance(dtype, T.DateType):
        return "bigint", F.unix_date(column).cast("bigint")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return dtype.simpleString(), column
    # A long text travels as its digest, which is longer than any text that stays.
    text = text_value(column, dtype)
    return "string", F.when(F.octet_length(text) >= 64, F.sha2(text, 256)).otherwise(text)


def distinct_counts(df: DataFrame, infos: list[ColumnInfo] | None = None) -> DataFrame:
    """``(ref, unique_count)``: exact distinct non-null values of each column.

    Columns of one comparable type are unpivoted to (column, value) together,
    so numbers and instants shuffle in eight bytes and text in 64 at most. Both
    groupings combine inside the map task, so a value that fills a
    third of the table still travels as one row per task.
    """
    infos = describe(df) if infos is None else infos
    by_type: dict[str, list[Column]] = {}
    for c in infos:
        common, value = comparable(names.quoted(c.name), c.dtype)
        by_type.setdefault(common, []).append(value.alias(c.ref))
    counts = None
    for values in by_type.values():
        typed = df.select(*values)
        pairs = typed.unpivot([], typed.columns, "ref", "value").where(F.col("value").isNotNull())
        part = pairs.distinct().groupBy("ref").agg(F.count(F.lit(1)).alias("unique_count"))
        counts = part if counts is None else counts.unionByName(part)
    return counts


def approx_distinct_counts(df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """The same table from one HyperLogLog++ aggregate: one scan and no value shuffle."""
    infos = describe(df)
    values = df.select(*[comparable(names.quoted(c.name), c.dtype)[1].alias(c.ref) for c in infos])
    wide = values.agg(*[F.approx_count_distinct(c.ref, rsd).alias(c.ref) for c in infos])
    return wide.unpivot([], [c.ref for c in infos], "ref", "unique_count")


def value_map(counts: DataFrame, key: str, value: str) -> Column:
    """A small keyed table (one row per column) as a scalar map."""
    entries = F.collect_list(F.struct(F.col(key), F.col(value)))
    return counts.agg(F.map_from_entries(entries).alias("entries")).scalar()


def needs_distinct(c: ColumnInfo, strict_names: bool = False) -> bool:
    """Whether a rule compares this column's distinct count with anything but one.

    For the other numbers and instants "no more than one value" is known from
    the smallest and the largest.
    """
    if c.kind in (names.NUMERIC, names.TEMPORAL):
        return names.name_has(c.name, names.IDENTIFIER_TOKENS, strict_names)
    return True


def unique_count_map(df: DataFrame, mode: str = "exact", strict_names: bool = False) -> Column:
    """Column alias to distinct count.

    ``exact`` counts every column, ``rules`` only those a rule needs, and
    ``approx`` estimates all but the identifiers, whose rule compares against
    the exact row count.
    """
    infos = describe(df)
    if mode == "exact":
        counts = distinct_counts(df)
    elif mode == "rules":
        wanted = [c for c in infos if needs_distinct(c, strict_names)]
        if not wanted:
            return F.create_map().cast("map<string,bigint>")
        counts = distinct_counts(df, wanted)
    elif mode == "approx":
        counts = approx_distinct_counts(df)
        exact = [c for c in infos if names.name_has(c.name, names.IDENTIFIER_TOKENS, strict_names)]
        if exact:
            kept = counts.where(~F.col("ref").isin([c.ref for c in exact]))
            counts = kept.unionByName(distinct_counts(df, exact))
    else:
        raise ValueError(f"distinct mode must be 'exact', 'rules' or 'approx', got {mode!r}")
    return value_map(counts, "ref", "unique_count")


# -- median -------------------------------------------------------------------


def exact_medians(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """``(ref, median)`` with linear interpolation, exact, for each numeric column.

    Ranks are found by counting (:mod:`plumbline.operators.selection`); no task orders values.
    """
    chosen = selected_quantiles(df, (0.5,), accuracy=accuracy).where(F.col("value").isNotNull())
    return chosen.select(F.concat(F.lit("c"), F.col("position").cast("string")).alias("ref"), F.col("value").alias("median"))


def approx_medians(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """The same table straight from the quantile sketch."""
    infos = [c for c in describe(df) if c.kind == names.NUMERIC]
    values = positional(df, infos).select(*[F.col(c.ref).cast("double").alias(c.ref) for c in infos])
    wide = values.agg(*[F.percentile_approx(c.ref, 0.5, accuracy).alias(c.ref) for c in infos])
    return wide.unpivot([], [c.ref for c in infos], "ref", "median")


# -- sample values ------------------------------------------------------------


def sample_values(df: DataFrame, order_key: str, size: int = 5) -> DataFrame:
    """``(column, rank, value)``: the first non-null values of each column by ``order_key``.

    One scan gives (column, value) pairs; Spark keeps ``size`` of each column in
    every task before the shuffle, so nothing is sorted whole.
    """
    infos = describe(df)
    texts = [text_value(names.quoted(c.name), c.dtype).alias(c.ref) for c in infos]
    pairs = df.select(names.quoted(order_key).alias("order_key"), *texts)
    pairs = pairs.unpivot(["order_key"], [c.ref for c in infos], "ref", "value").where(F.col("value").isNotNull())
    rank = F.row_number().over(Window.partitionBy("ref").orderBy("order_key"))
    tops = pairs.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= size)
    known = F.create_map(*[F.lit(x) for c in infos for x in (c.ref, c.name)])
    position = F.substring("ref", 2, 10).cast("int").alias("position")
    return tops.select(position, F.element_at(known, F.col("ref")).alias("column"), "rank", "value")


# -- the joined profile -------------------------------------------------------


def column_metrics(
    df: DataFrame,
    as_of=None,
    rules: StructuredRules = StructuredRules(),
    distinct: str = "exact",
    dimensions: Iterable[str] = DIMENSIONS,
) -> DataFrame:
    """All metrics the quality rules of ``dimensions`` read, one row per column.

    With ``distinct="rules"`` the distinct count of a plain number or instant is
    null when it exceeds one.
    """
    infos, strict_names = describe(df), rules.strict_names
    # One row, computed once: the outlier scan takes its moments from it.
    wide = ranges = settled(range_metrics(df, as_of, rules, dimensions))
    available = set(wide.columns)
    counts = F.create_map().cast("map<string,bigint>")
    if set(dimensions) & set(COUNT_DISTINCT):
        counts = unique_count_map(df, distinct, strict_names)
    wide = wide.withColumn("unique_counts", counts)
    with_outliers = "accuracy" in dimensions and any(c.kind == names.NUMERIC for c in infos)
    if with_outliers:
        counts = outlier_counts(df, rules.z_limit, ranges)
        wide = wide.withColumn("outliers", counts.select(F.struct(*counts.columns)).scalar())

    def metric(name: str, i: int, kind: str) -> str:
        column = f"{name}_{i}"
        return f"CAST({column if column in available else 'NULL'} AS {kind})"

    def count(name: str, i: int) -> str:
        column = f"{name}_{i}"
        return f"CAST({column if column in available else 0} AS BIGINT)"

    def unique(c: ColumnInfo) -> str:
        if distinct == "rules" and not needs_distinct(c, strict_names) and f"single_{c.position}" in available:
            # Zero or one when known, null when there are more.
            return f"CASE WHEN present_{c.position} = 0 THEN 0 WHEN single_{c.position} THEN 1 END"
        return f"coalesce(element_at(unique_counts, '{c.ref}'), 0)"

    rows = []
    for c in infos:
        i = c.position
        outliers = f"outliers.outliers_{i}" if with_outliers and c.kind == names.NUMERIC else "0"
        fields = {
            "position": str(i),
            "column": sql_text(c.name),
            "dtype": sql_text(c.dtype.simpleString()),
            "kind": sql_text(c.kind),
            "is_identifier": str(names.name_has(c.name, names.IDENTIFIER_TOKENS, strict_names)).lower(),
            "row_count": "rows",
            "null_count": f"rows - present_{i}",
            "unique_count": f"CAST({unique(c)} AS BIGINT)",
            **{name: metric(name, i, "DOUBLE") for name in ("min", "max", "mean", "std")},
            "outlier_count": f"CAST({outliers} AS BIGINT)",
            "numeric_parsed": count("numeric", i),
            "datetime_parsed": count("dates", i),
            "latest": metric("latest", i, "TIMESTAMP"),
            "future_count": count("future", i),
            "negative_count": count("negative", i),
            "long_count": count("long", i),
        }
        rows.append("named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")")
    metrics = wide.selectExpr(f"inline(array({', '.join(rows)}))")
    present = F.col("row_count") - F.col("null_count")
    is_date = (F.col("kind") == names.TEMPORAL) | (
        (F.col("kind") == names.STRING)
        & (present > 0)
        & (F.col("datetime_parsed") >= rules.date_parse_ratio * present)
    )
    return metrics.withColumn("is_date", is_date)


def column_profile(
    df: DataFrame,
    distinct: str = "exact",
    median: str = "exact",
) -> DataFrame:
    """The descriptive profile: one row per column, rates and moments rounded to six places."""
    infos = describe(df)
    values = positional(df, infos)
    numeric = [c for c in infos if c.kind == names.NUMERIC]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for c in infos:
        aggregates.append(F.count(c.ref).alias(f"present_{c.position}"))
        if c in numeric:
            x = F.col(c.ref).cast("double")
            aggregates += [
                F.min(x).alias(f"min_{c.position}"),
                F.max(x).alias(f"max_{c.position}"),
                F.avg(x).alias(f"mean_{c.position}"),
                F.stddev_samp(x).alias(f"std_{c.position}"),
            ]
    wide = values.agg(*aggregates).withColumn("unique_counts", unique_count_map(df, distinct))
    if numeric:
        table = exact_medians(df) if median == "exact" else approx_medians(df)
        wide = wide.withColumn("medians", value_map(table, "ref", "median"))

    def moment(name: str, c: ColumnInfo) -> Column:
        value = F.col(f"{name}_{c.position}") if c in numeric else F.lit(None).cast("double")
        return F.round(value, 6).alias(name)

    rows = []
    for c in infos:
        nulls = F.col("rows") - F.col(f"present_{c.position}")
        middle = F.element_at("medians", F.lit(c.ref)) if c in numeric else F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(c.position).cast("bigint").alias("position"),
                F.lit(c.name).alias("column"),
                F.lit(c.dtype.simpleString()).alias("dtype"),
                F.col("rows").alias("row_count"),
                nulls.alias("null_count"),
                F.round(F.coalesce(F.try_divide(nulls, F.col("rows")), F.lit(0.0)), 6).alias("null_rate"),
                F.coalesce(F.element_at("unique_counts", F.lit(c.ref)), F.lit(0)).cast("bigint").alias("unique_count"),
                moment("min", c),
                moment("max", c),
                moment("mean", c),
                F.round(middle, 6).alias("median"),
                moment("std", c),
            )
        )
    return wide.select(F.inline(F.array(*rows)))
