"""A dimension, or a document, that cannot be checked leaves the others' scores as they are."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, QualityConfig, StructuredRules
from plumbline.plans import records as R
from plumbline.plans import structured as S
from plumbline.plans import text as X
from plumbline.sources.records import read_jsonl

AS_OF = "2024-06-01"
# Each dimension fails once and is kept once.
HALVES = [DIMENSIONS[::2], DIMENSIONS[1::2]]


def raising(scored, dimensions):
    for d in dimensions:
        scored = scored.withColumn(d, F.raise_error(F.lit(f"no {d} today")).cast("double"))
    return scored


def orders(spark):
    return spark.sql(
        "SELECT id AS order_id, IF(id % 7 = 0, NULL, id * 1.5) AS price, 'EUR' AS currency, "
        "CAST(date_sub(DATE'2024-05-01', CAST(id % 40 AS INT)) AS STRING) AS placed_on, IF(id = 3, -1, 1) AS amount "
        "FROM range(60) UNION ALL SELECT 5, 7.5, 'EUR', '2024-04-26', 1"
    )


def test_a_rule_that_divides_by_zero(spark):
    """Real, not patched: a freshness rule of zero days raises and takes nothing else with it."""
    sound = S.validate_structured(orders(spark), "o", AS_OF).first()
    config = dataclasses.replace(QualityConfig(), structured=StructuredRules(max_age_days=0))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        S.validate_structured(orders(spark), "o", AS_OF, config).collect()
    got = S.validate_structured(orders(spark), "o", AS_OF, config, isolate=True).collect()
    assert len(got) == 1
    row = got[0]
    assert row["dimensions"]["freshness"] == 0.0
    for d in DIMENSIONS:
        if d != "freshness":
            assert row["dimensions"][d] == sound["dimensions"][d]
    failed = [c for c in row["failed_checks"] if c["check"] == "freshness"]
    assert len(failed) == 1 and "DIVIDE_BY_ZERO" in failed[0]["actual"]
    assert row["metadata"] == sound["metadata"]
    others = lambda r: [c for c in r["failed_checks"] if c["check"] not in ("freshness", "stale_data")]
    assert others(row) == others(sound) != []


@pytest.mark.parametrize("failing", HALVES)
def test_each_dimension_of_a_table(spark, monkeypatch, failing):
    sound = S.validate_structured(orders(spark), "o", AS_OF).first()["dimensions"].asDict()
    scores = S._scores
    monkeypatch.setattr(S, "_scores", lambda totals, rules: raising(scores(totals, rules), failing))
    row = S.validate_structured(orders(spark), "o", AS_OF, isolate=True).first()
    assert row["dimensions"].asDict() == {**sound, **dict.fromkeys(failing, 0.0)}
    reasons = {c["check"]: c["actual"] for c in row["failed_checks"]}
    assert all(f"no {d} today" in reasons[d] for d in failing)


def lines(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    rows = ['{"id": %d, "site url": "ftp://x", "made_at": "2024-05-%02d", "n": %s}' % (i, i % 28 + 1, '"x"' if i % 5 else i) for i in range(30)]
    path.write_text("\n".join([*rows, rows[0]]))
    return read_jsonl(spark, str(path))


@pytest.mark.parametrize("failing", HALVES)
def test_each_dimension_of_records(spark, tmp_path, monkeypatch, failing):
    records = lines(spark, tmp_path)
    sound, checks = R.isolated_records(records, "r", AS_OF, format="jsonl")
    sound, checks = sound.first(), {tuple(c) for c in checks.collect()}
    scores = R.RecordPlan.scores
    monkeypatch.setattr(R.RecordPlan, "scores", lambda plan: raising(scores(plan), failing))
    row, found = R.isolated_records(records, "r", AS_OF, format="jsonl")
    row, found = row.first(), found.collect()
    assert row["dimensions"].asDict() == {**sound["dimensions"].asDict(), **dict.fromkeys(failing, 0.0)}
    assert {tuple(c) for c in found if c["dimension"] not in failing} == {c for c in checks if c[5] not in failing}
    assert {c["check"] for c in found if c["dimension"] in failing} == set(failing)
    assert row["metadata"]["format"] == "jsonl"


def docs(spark):
    rows = [("a", "One sentence of some words. And another one here.", None), ("b", "Second text, which stands alone.", None)]
    return spark.createDataFrame([*rows, ("c", None, "cannot be opened")], "doc_id string, text string, error string")


def test_a_bad_document_leaves_the_others(spark):
    alone = X.validate_documents(docs(spark).where("error IS NULL"), as_of=AS_OF)
    sound = {r["dataset_name"]: r for r in alone.collect()}
    got = {r["dataset_name"]: r for r in X.validate_documents(docs(spark), as_of=AS_OF, error="error").collect()}
    assert got.pop("c")["overall_score"] == 0.0
    assert got == sound and len(got) == 2


@pytest.mark.parametrize("failing", HALVES)
def test_each_dimension_of_documents(spark, monkeypatch, failing):
    good = docs(spark).where("error IS NULL")
    sound = {r["dataset_name"]: r["dimensions"].asDict() for r in X.validate_documents(good, as_of=AS_OF).collect()}
    scores = X.document_scores

    def patched(metrics, rules, known=X.NONE_FAILING):
        return raising(scores(metrics, rules, known), [d for d in failing if d not in known])

    monkeypatch.setattr(X, "document_scores", patched)
    for row in X.validate_documents(good, as_of=AS_OF, isolate=True).collect():
        assert row["dimensions"].asDict() == {**sound[row["dataset_name"]], **dict.fromkeys(failing, 0.0)}
        reasons = {c["check"]: c["actual"] for c in row["failed_checks"]}
        assert all(f"no {d} today" in reasons[d] for d in failing)
