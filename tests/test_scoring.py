"""Labels, summary, history and report tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, Bands
from plumbline.functions.scoring import emphasis, fixed, label
from plumbline.plans import scoring as S
from plumbline.types import RESULT_SCHEMA, assert_valid_results

CHECKS = [("a", "c", "e", "x", "warning"), ("b", "c", "e", "x", "error"), ("c", "c", "e", "x", "warning"), ("d", "c", "e", "x", "error")]


def record(name, score, run="r1", day=1, checks=(), data_type="structured"):
    return (run, name, data_type, float(score), tuple([float(score)] * 6), list(checks), {}, score >= 80, dt.datetime(2024, 1, day), "p")


def results(spark, *records):
    return spark.createDataFrame(list(records), RESULT_SCHEMA)


@pytest.mark.parametrize("score, expected", [(92, "PASS"), (80, "PASS"), (79.99, "WARN"), (70, "WARN"), (65, "WARN"), (50, "FAIL")])
def test_labels(spark, score, expected):
    assert spark.range(1).select(label(F.lit(float(score)), Bands())).first()[0] == expected


@pytest.mark.parametrize("score, expected", [(32.4, "critical"), (32.5, "warning"), (64.9, "warning"), (65, "normal")])
def test_emphasis(spark, score, expected):
    assert spark.range(1).select(emphasis(F.lit(float(score)), Bands())).first()[0] == expected


def test_summary(spark):
    scored = S.score_results(results(spark, record("a", 90), record("b", 70), record("c", 20)))
    row = S.run_summary(scored).first().asDict()
    assert row == {
        "total_datasets": 3, "pass_count": 1, "warn_count": 1, "fail_count": 1, "pass_pct": 33.3, "warn_pct": 33.3,
        "fail_pct": 33.3, "mean_score": 60.0, "min_score": 20.0, "max_score": 90.0, "pipeline_passed": False,
    }
    assert S.run_summary(S.score_results(results(spark, record("a", 80)))).first().pipeline_passed


def test_summary_of_nothing_is_an_error(spark):
    with pytest.raises(Exception, match="no results"):
        S.run_summary(S.score_results(results(spark))).collect()


def test_trend_directions(spark):
    before = results(spark, record("up", 50), record("down", 90), record("flat", 70, "r0"), record("gone", 1),
                     record("twice", 10, "r0", 1), record("twice", 60, "r1", 2))
    now = results(spark, *[record(n, 70, "r2", 3) for n in ("up", "down", "flat", "fresh", "twice")])
    got = {r.dataset_name: (r.previous_score, r.delta, r.direction) for r in S.compare_runs(now, before).collect()}
    assert got == {
        "up": (50, 20, "up"), "down": (90, -20, "down"), "flat": (70, 0, "flat"), "fresh": (None, None, "new"),
        "twice": (60, 10, "up"),
    }


def test_deltas_cross_months_and_gaps(spark):
    days = [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6), dt.datetime(2024, 2, 1), dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)]
    rows = [record("a", 10 * i, f"r{i}")[:8] + (day, "p") for i, day in enumerate(days)]
    got = S.score_history_deltas(results(spark, *rows)).orderBy("run_timestamp").collect()
    assert [r.previous_score for r in got] == [None, 0, 10, 20, 30]


def test_latest_and_lookup(spark):
    stored = results(spark, record("a", 10, "r1", 1), record("a", 20, "r2", 2), record("b", 30, "r1", 1))
    assert {r.dataset_name: r.overall_score for r in S.latest_per_dataset(stored).collect()} == {"a": 20, "b": 30}
    assert [r.overall_score for r in S.latest_run(stored).collect()] == [20]
    assert S.dataset_result(stored, "a").first().overall_score == 20
    assert S.dataset_score(stored, "a", newest=False).first().overall_score == 10
    assert S.dataset_result(stored, "zzz").collect() == [] and S.latest_run(results(spark)).collect() == []
    assert [r.overall_score for r in S.history(stored).collect()] == [10, 30, 20]


def test_report_tables(spark):
    scored = S.score_results(results(spark, record("a", 60, checks=CHECKS), record("b", 90)))
    assert {(r.dataset_name, r.label, r.failed_checks) for r in S.dataset_table(scored).collect()} == {("a", "FAIL", 4), ("b", "PASS", 0)}
    dims = {r.dataset_name: r for r in S.dimension_table(scored).collect()}
    assert dims["a"].validity == 60 and dims["a"].validity_emphasis == "warning" and dims["b"].accuracy_emphasis == "normal"
    assert [r.check for r in S.failed_check_table(scored).orderBy("rank").collect()] == ["b", "d", "a", "c"]
    assert [r.dataset_name for r in S.with_failures(scored).collect()] == ["a"]
    assert [r.dataset_name for r in S.alerts(scored).collect()] == ["a"]


def test_json_record(spark):
    text = S.as_json(results(spark, record("a", 60, checks=CHECKS[:1]))).first().record
    parsed = json.loads(text)
    assert len(parsed) == 9 and parsed["dimensions"] == {d: 60.0 for d in DIMENSIONS} and parsed["failed_checks"][0]["check"] == "a"


@pytest.mark.parametrize("bad", [record("a", 101), record("a", -1), record("a", 50, data_type="tabular")])
def test_bad_records_are_rejected(spark, bad):
    with pytest.raises(Exception, match="invalid data_type|overall_score outside"):
        assert_valid_results(results(spark, bad)).collect()


@pytest.mark.parametrize("value", [0.0, 0.35005, 0.91035, 12.345, 2.675, 0.125, 0.5, 99.995, 33.333])
@pytest.mark.parametrize("places", [0, 1, 2, 4])
def test_fixed_rounds_like_python(spark, value, places):
    assert spark.range(1).select(fixed(f"{value!r}D", places)).first()[0] == f"{value:.{places}f}"
