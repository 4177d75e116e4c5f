"""The six dimensions of tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, QualityConfig, Weights, config_from_mapping, load_config
from plumbline.plans.structured import structured_checks, structured_scores, validate_structured

NOW = "2024-06-01"


def checks(df, as_of=NOW):
    return {(r["check"], r["column"]): r for r in structured_checks(df, as_of).collect()}


def scores(df, as_of=NOW):
    return structured_scores(df, as_of).first()


def clean(spark):
    rows = [
        (i, f"product {name}", price, quantity, dt.datetime(2024, 5, 20 + i))
        for i, (name, price, quantity) in enumerate(
            [("a", 9.5, 1), ("b", 19.5, 2), ("c", 5.0, 3), ("d", 7.25, 4), ("e", 3.0, 5)]
        )
    ]
    return spark.createDataFrame(rows, "order_id int, product string, price double, quantity int, created timestamp")


def test_clean_table_passes(spark):
    result = validate_structured(clean(spark), "orders", NOW).first()
    assert result.passed and result.overall_score == 100.0 and result.failed_checks == []
    assert result.metadata == {"row_count": "5", "column_count": "5", "duplicate_rate": "0.0"}


def test_dirty_table_scores_lower(spark):
    dirty = clean(spark).withColumn("price", F.expr("CASE WHEN order_id < 2 THEN NULL ELSE price END"))
    assert validate_structured(dirty, "d", NOW).first().overall_score < 100


@pytest.mark.parametrize("nulls, severity", [(3, "error"), (1, "warning"), (0, None)])
def test_null_rate_severity(spark, nulls, severity):
    df = spark.createDataFrame([(None if i < nulls else i,) for i in range(10)], "a int")
    found = checks(df).get(("null_rate", "a"))
    assert (found and found.severity) == severity


def test_completeness_formula(spark):
    df = spark.createDataFrame([(i, None if i < 2 else i) for i in range(5)], "col_a int, col_b int")
    assert scores(df).completeness == pytest.approx(80.0)


def test_every_null_column_is_listed(spark):
    df = spark.createDataFrame([(None if i < 5 else i, None if i < 3 else i, i) for i in range(10)], "x int, y int, z int")
    assert {c for k, c in checks(df) if k == "null_rate"} == {"x", "y"}


def test_low_cardinality_costs_five_points(spark):
    df = spark.range(1000).select(F.element_at(F.array(*[F.lit(c) for c in "abc"]), (F.col("id") % 3 + 1).cast("int")).alias("kind"))
    assert scores(df).accuracy == pytest.approx(95.0)
    assert checks(df)[("low_cardinality", "kind")].actual == "0.30%"


def test_outlier_check(spark):
    df = spark.createDataFrame([(float(i % 3),) for i in range(99)] + [(1e6,)], "v double")
    found = checks(df)[("numeric_outliers", "v")]
    assert (found.actual, found.expected, found.severity) == ("1 outlier(s) (1.00%)", "Z-score <= 3.0", "warning")
    assert scores(df).accuracy == pytest.approx(99.0)


def test_constant_and_mixed_columns(spark):
    df = spark.createDataFrame(
        [("EUR", "12" if i < 2 else "x" * (i + 1), None, "2024-01-01") for i in range(10)],
        "currency string, code string, empty string, day string",
    )
    found = checks(df)
    assert ("constant_column", "currency") in found and ("constant_column", "empty") not in found
    assert found[("mixed_type", "code")].actual == "20% of values parseable as numeric"
    # One repeated date is constant first, so its type is not looked at.
    assert ("constant_column", "day") in found and ("mixed_type", "day") not in found
    assert scores(df).consistency == pytest.approx(25.0)


@pytest.mark.parametrize(
    "day, score, severity", [("2024-05-02", 100.0, None), ("2024-05-01", 0.0, "warning"), ("2024-03-01", 0.0, "error")]
)
def test_freshness_is_all_or_nothing(spark, day, score, severity):
    df = spark.createDataFrame([(day,), ("2020-01-01",)], "d string").select(F.to_date("d").alias("d"))
    found = checks(df).get(("stale_data", "d"))
    assert (found and found.severity) == severity
    assert scores(df).freshness == score


def test_no_date_column_is_a_warning(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert ("no_date_columns", "dataset") in checks(df) and scores(df).freshness == 100.0


@pytest.mark.parametrize("rows, repeats, severity", [(4, 2, "error"), (20, 1, "warning"), (200, 1, None)])
def test_duplicate_rows(spark, rows, repeats, severity):
    df = spark.createDataFrame([(max(i - repeats, 0),) for i in range(rows)], "a int")
    found = checks(df).get(("duplicate_rows", "dataset"))
    assert (found and found.severity) == severity
    assert scores(df).uniqueness == pytest.approx((1 - repeats / rows) * 100)


def test_identifier_repeats_do_not_change_the_score(spark):
    df = spark.createDataFrame([(v, i) for i, v in enumerate([1, 1, 2, 3, 4])], "order_id int, n int")
    assert checks(df)[("non_unique_identifier", "order_id")].actual == "1 repeated value(s)"
    assert scores(df).uniqueness == 100.0


def test_other_repeats_are_no_identifiers(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "product string, price double")
    assert not [k for k in checks(df) if k[0] == "non_unique_identifier"]


def test_validity_counts_cells(spark):
    rows = [(-1.0 if i < 2 else 1.0, "x" * (1001 if i == 0 else 5), "2030-01-01" if i == 3 else "2024-05-30") for i in range(10)]
    df = spark.createDataFrame(rows, "price double, note string, due string")
    found = checks(df)
    assert found[("negative_value", "price")].severity == "error"
    assert found[("excessive_string_length", "note")].actual == "1 value(s) exceed 1000 characters"
    assert found[("future_date", "due")].expected == "<= today (2024-06-01)"
    assert scores(df).validity == pytest.approx((1 - 4 / 30) * 100)


def test_dates_with_offsets_are_compared_as_instants(spark):
    df = spark.createDataFrame([("2024-06-01T01:00:00+02:00",), ("2024-06-01T01:00:00-02:00",)], "at string")
    assert checks(df)[("future_date", "at")].actual == "1 future date(s)"


def test_empty_table_scores(spark):
    row = scores(spark.createDataFrame([], "a double"))
    assert [row[d] for d in ("completeness", "accuracy", "uniqueness", "validity")] == [100.0] * 4


def test_record_has_the_contractual_keys(spark):
    row = validate_structured(clean(spark), "orders", NOW, run_id="r", source_path="p").first().asDict(True)
    assert set(row) - {"run_id"} == {
        "dataset_name", "data_type", "overall_score", "dimensions", "failed_checks", "metadata", "passed",
        "run_timestamp", "source_path",
    }
    assert tuple(row["dimensions"]) == DIMENSIONS and row["data_type"] == "structured"


def test_missing_weights_count_as_zero(spark):
    config = config_from_mapping({"scoring_weights": {"completeness": 0.5}, "thresholds": {"pass_score": 40, "warn_score": 30, "fail_score": 29}})
    assert config.weights == Weights(0.5, 0, 0, 0, 0, 0) and config.bands.pass_score == 40
    assert validate_structured(clean(spark), "o", NOW, config).first().overall_score == 50.0


def test_config_file(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("thresholds:\n  pass_score: 90\nalerts:\n  alert_on_score_below: 70\n")
    config = load_config(str(path))
    assert (config.bands.pass_score, config.alert_below, config.weights) == (90, 70, QualityConfig().weights)
    path.write_text("- a\n")
    with pytest.raises(ValueError):
        load_config(str(path))
    with pytest.raises(FileNotFoundError):
        load_config(os.path.join(str(tmp_path), "absent.yaml"))


def test_plan_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("s"), F.rand().alias("v")).write.parquet(path)
    plan = structured_checks(spark.read.parquet(path).select("id", "v"), NOW)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "s:string" not in plan
