"""Column metrics and duplicates on inline rows."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plumbline.config import StructuredRules
from plumbline.operators import columns as C
from plumbline.operators.duplicates import duplicate_summary, mark_duplicates
from plumbline.operators.skew import with_key_counts


def profile(df, **options):
    return {r["column"]: r for r in C.column_profile(df, **options).collect()}


def test_null_count_and_rate(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (None,), (5.0,)], "a double")
    row = profile(df)["a"]
    assert (row.null_count, row.null_rate, row.row_count) == (2, 0.4, 5)


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "a double")
    row = profile(df)["a"]
    assert (row.null_count, row.unique_count, row["mean"]) == (2, 1, 1.0)


def test_numeric_statistics(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 6)], "v double")
    row = profile(df)["v"]
    assert (row["min"], row["max"], row["mean"], row["median"]) == (1, 5, 3, 3)
    assert row["std"] == pytest.approx(math.sqrt(2.5), abs=1e-6)


def test_single_value_has_no_spread(spark):
    row = profile(spark.createDataFrame([(7,)], "v int"))["v"]
    assert row["std"] is None and row["median"] == 7


def test_booleans_are_numeric(spark):
    row = profile(spark.createDataFrame([(True,), (False,), (True,), (True,)], "b boolean"))["b"]
    assert (row["mean"], row["max"]) == (0.75, 1.0)


def test_distinct_ignores_null(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), ("z",), (None,)], "cat string")
    assert profile(df)["cat"].unique_count == 3


def test_distinct_of_every_type(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (0.0D, map('a', 1, 'b', 2), array(1), X'01', DATE'2024-01-01', TIMESTAMP_NTZ'2024-03-31 02:30:00', 1.10BD),
        (-0.0D, map('b', 2, 'a', 1), array(1), X'01', DATE'2024-01-01', TIMESTAMP_NTZ'2024-03-31 03:30:00', 1.1BD)
        AS t(d, m, a, b, day, ts, amount)"""
    )
    counts = {r.ref: r.unique_count for r in C.distinct_counts(df).collect()}
    assert counts == {"c0": 1, "c1": 1, "c2": 1, "c3": 1, "c4": 1, "c5": 2, "c6": 1}


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b string")
    row = profile(df)["a"]
    assert (row.row_count, row.null_rate, row.unique_count, row["median"]) == (0, 0.0, 0, None)
    assert duplicate_summary(df).first().duplicate_rate == 0.0


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c`d"])
    assert set(profile(df)) == {"a.b", "c`d"}


@pytest.mark.parametrize("size", [1, 2, 3, 10, 501, 1000])
def test_exact_median_against_brute_force(spark, size):
    rng = random.Random(size)
    rows = [(rng.choice([0.0, rng.gauss(0, 10)]), rng.randint(-3, 3)) for _ in range(size)]
    df = spark.createDataFrame(rows, "x double, k int")
    # A coarse sketch: the bracket is wide and must still hold the middle.
    got = {r.ref: r["median"] for r in C.exact_medians(df, accuracy=50).collect()}
    assert got["c0"] == pytest.approx(statistics.median(r[0] for r in rows))
    assert got["c1"] == pytest.approx(statistics.median(r[1] for r in rows))


def test_medians_with_one_hot_value(spark):
    df = spark.range(10_000).select(F.when(F.col("id") < 6000, 5.0).otherwise(F.col("id") * 1.0).alias("x"))
    assert C.exact_medians(df, accuracy=100).first()["median"] == 5.0


@pytest.mark.parametrize("others, expected", [(9, 0), (10, 1)])
def test_outliers_need_eleven_rows(spark, others, expected):
    # The largest z-score of n rows is (n - 1) / sqrt(n): above 3 from n = 11 on.
    df = spark.createDataFrame([(0.0,)] * others + [(1000.0,)], "v double")
    assert C.outlier_counts(df).first()["outliers_0"] == expected


def test_outliers_without_spread(spark):
    df = spark.createDataFrame([(5.0,)] * 20, "v double")
    assert C.outlier_counts(df).first()["outliers_0"] == 0


def test_parse_counts(spark):
    rows = [("12",), (" 3.5 ",), ("1e3",), ("x",), ("2024-01-02",), ("2024-01-02T03:04:05+02:00",), ("12/31/2023",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    row = C.column_metrics(df, "2024-06-01").first()
    assert (row.numeric_parsed, row.datetime_parsed) == (3, 3)
    assert str(row.latest) == "2024-01-02 01:04:05"
    assert not row.is_date


def test_rules_mode_knows_constants_without_counting(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (1, 3.0, "a")], "one int, two double, three string")
    rows = {r["column"]: r.unique_count for r in C.column_metrics(df, distinct="rules").collect()}
    assert rows == {"one": 1, "two": None, "three": 1}


def test_approximate_mode_keeps_identifiers_exact(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 100).alias("bucket"))
    rows = {r["column"]: r.unique_count for r in C.column_metrics(df, distinct="approx").collect()}
    assert rows["id"] == 5000 and abs(rows["bucket"] - 100) <= 10


def test_strict_names(spark):
    df = spark.createDataFrame([(1, 1, -1)], "paid int, order_id int, page int")
    loose = {r["column"]: (r.is_identifier, r.negative_count) for r in C.column_metrics(df).collect()}
    strict = {
        r["column"]: (r.is_identifier, r.negative_count)
        for r in C.column_metrics(df, rules=StructuredRules(strict_names=True)).collect()
    }
    assert loose == {"paid": (True, 0), "order_id": (True, 0), "page": (False, 1)}
    assert strict == {"paid": (False, 0), "order_id": (True, 0), "page": (False, 0)}


def test_sample_values(spark):
    df = spark.createDataFrame([(i, None if i % 2 else f"v{i}") for i in range(20)], "k int, s string")
    rows = C.sample_values(df, "k").where("column = 's'").orderBy("rank").collect()
    assert [r.value for r in rows] == ["v0", "v2", "v4", "v6", "v8"]


@pytest.mark.parametrize("values, rate", [([1, 1, 2, 3, 3], 0.4), ([1, 1, 1, 2], 0.5), ([1, 2], 0.0)])
def test_duplicate_rate(spark, values, rate):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert duplicate_summary(df).first().duplicate_rate == rate


def test_duplicates_treat_null_nan_and_collections_as_equal(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (double('nan'), array(1), map('a', 1, 'b', 2)), (double('nan'), array(1), map('b', 2, 'a', 1)) AS t(x, a, m)"
    )
    assert duplicate_summary(df).first().duplicate_count == 1


def test_duplicate_marks_keep_the_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "k int, v string")
    marks = {r.k: r.is_duplicate for r in mark_duplicates(df, "k").collect()}
    assert marks == {1: False, 3: True, 2: False, 4: False, 5: True}


def test_key_counts_with_hot_keys(spark):
    rng = random.Random(7)
    rows = [(i, 0 if rng.random() < 0.4 else rng.randint(1, 3000)) for i in range(6000)]
    counts = {}
    for _, k in rows:
        counts[k] = counts.get(k, 0) + 1
    got = with_key_counts(spark.createDataFrame(rows, "i int, k int"), ["k"], "n").collect()
    assert len(got) == len(rows)
    assert all(r.n == counts[r.k] for r in got)


def test_hot_keys_are_the_only_broadcast_side(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    plan = with_key_counts(df, ["k"], "n")._jdf.queryExecution().optimizedPlan().toString()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    assert "(_n#" in plan and f"* {partitions})" in plan
