"""Semi-structured records."""

import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.jsontext import is_whole_json, nesting_depth
from plumbline.operators.records import (
    duplicate_records,
    field_metrics,
    field_profile,
    flatten_records,
    flatten_struct,
    max_nesting_depth,
    record_digests,
)
from plumbline.plans.records import record_checks, record_scores, validate_records


def variants(spark, *texts):
    texts = [t if isinstance(t, str) else json.dumps(t) for t in texts]
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("v"))


def users():
    """Fifty records: five without e-mail, two with a stray field, three exact copies."""
    made = []
    for i in range(47):
        user = {
            "id": i,
            "name": f"n{i}",
            "address": {"street": "s", "city": "c", "country": "x"},
            "preferences": {"theme": "dark", "notifications": i % 2 == 0},
            "created_at": "2024-05-20T10:00:00",
            "is_active": True,
        }
        if i >= 5:
            user["email"] = f"u{i}@example.com"
        if i in (10, 11):
            user["temp_debug_field"] = "x"
        made.append(user)
    return made + [made[20], made[21], made[22]]


@pytest.fixture(scope="module")
def user_records(spark):
    return variants(spark, *users())


def fields_of(records):
    return {r.path: r for r in field_profile(field_metrics(records)).collect()}


@pytest.mark.parametrize(
    "text, depth",
    [('{"a":[{"b":{"c":3}}]}', 4), ("[]", 1), ("{}", 1), ('"x"', 0), ('{"a":1}', 1), ('{"a\\"}":"{[\\\\"}', 1), ("12", 0)],
)
def test_nesting_depth(spark, text, depth):
    assert spark.createDataFrame([(text,)], "t string").select(nesting_depth(F.col("t"))).first()[0] == depth


@pytest.mark.parametrize(
    "text, whole",
    [('{"a":1}', True), ('{"a":1} x', False), ('{"a":1}{"b":2}', False), ("[1] ", True), ("5 6", False), ("-1.5e3", True), ('"a" b', False), ('{"a":1},', False)],
)
def test_whole_json(spark, text, whole):
    assert spark.createDataFrame([(text,)], "t string").select(is_whole_json(F.col("t"))).first()[0] is whole


def test_flattening(spark):
    records = variants(spark, {"a": None, "b": {"c": {"d": 1}, "e": {}}, "f": [1, {"g": 2}]}, {"a": {"x": "y"}}, {})
    rows = {(r.path, r.value) for r in flatten_records(records).select("path", F.col("node").cast("string").alias("value")).collect()}
    assert rows == {("a", None), ("b.c.d", "1"), ("f", '[1,{"g":2}]'), ("a.x", "y")}


def test_very_deep_records_are_scored(spark):
    deep = {"k": 1}
    for _ in range(89):
        deep = {"n": deep}
    records = variants(spark, deep, {"k": 2, "created_at": "2024-05-30"})
    leaves = {r.path.count("."): r.j for r in flatten_records(records).selectExpr("path", "to_json(node) j").where("path <> 'created_at'").collect()}
    assert leaves == {89: "1", 0: "2"}
    found = [r.check for r in record_checks(records, "2024-06-01").collect()]
    assert "excessive_nesting_depth" in found


def test_deep_records_are_compared_whole(spark):
    def deep(leaf):
        for _ in range(19):
            leaf = {"n": leaf}
        return leaf

    same = [{"k": 1}, {"k": 1, "a": None}, {"a": {"b": {}}, "k": 1}, {"k": 1e0}]
    other = [{"k": 2}, {"k": 1, "a": [None, {}]}, {"k": 'x"{}:null,'}]
    records = variants(spark, *(deep(r) for r in same + other))
    assert len(set(record_digests(records).collect())) == 4
    shallow = variants(spark, *same, *other)
    assert len(set(record_digests(shallow).collect())) == 4
    # Copies forty levels down, next to shallow ones.
    nested = [deep(deep(r)) for r in same + other]
    assert duplicate_records(variants(spark, *nested, *same)).first().duplicate_count == 6


def test_digests_against_brute_force(spark):
    """Random records with nulls, empty objects, dots in keys, lists and swapped fields."""
    rng = random.Random(6)

    def value(depth):
        kind = rng.randrange(9 if depth else 6)
        if kind > 5:
            keys = rng.sample(["a", "b", "a.b", "c"], rng.randrange(4))
            return {k: value(depth - 1) for k in keys}
        return [None, 1, 2.5, "1", [1, None], True][kind]

    def bare(x):
        if not isinstance(x, dict):
            return json.dumps(x)
        return tuple(sorted((k, bare(v)) for k, v in x.items() if v is not None and bare(v) != ()))

    records = [{k: value(3) for k in rng.sample(["a", "b", "a.b"], rng.randrange(3))} for _ in range(400)]
    different = len({bare(r) for r in records})
    assert 50 < different < 350
    assert len(set(record_digests(variants(spark, *records)).collect())) == different
    assert duplicate_records(variants(spark, *records)).first().duplicate_count == 400 - different


def test_records_that_are_no_objects(spark):
    records = variants(spark, "[1]", "[1]", "1", "null", "null", "{}", '{"a":null}', '"null"')
    assert len(set(record_digests(records).collect())) == 5
    missing = spark.sql("SELECT parse_json(CAST(NULL AS STRING)) AS v UNION ALL SELECT parse_json('{}')")
    assert duplicate_records(missing).first().duplicate_count == 0


def test_deep_records_are_whole(spark):
    deep = {"k": 1}
    for _ in range(14):
        deep = {"n": deep}
    leaf = flatten_records(variants(spark, deep)).first()
    assert leaf.path == ".".join(["n"] * 14 + ["k"])
    with pytest.raises(Exception, match="nest deeper"):
        flatten_records(variants(spark, deep), levels=3).collect()


def test_struct_flattening(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'c', named_struct('d', 'x')) AS a, array(1) AS e")
    assert flatten_struct(df).columns == ["a.b", "a.c.d", "e"]


def test_user_profile(spark, user_records):
    fields = fields_of(user_records)
    assert len(fields) == 11
    assert fields["email"].null_pct == pytest.approx(10.0) and fields["temp_debug_field"].null_pct == pytest.approx(96.0)
    assert [p for p, r in fields.items() if r.is_unexpected] == ["temp_debug_field"]
    assert max_nesting_depth(user_records).first()[0] == 2
    assert duplicate_records(user_records).first().duplicate_count == 3


def test_user_quality(spark, user_records):
    result = validate_records(user_records, "users", "2024-06-01").first()
    assert (result.dimensions.completeness, result.dimensions.consistency, result.dimensions.uniqueness) == (90.36, 90.0, 94.0)
    assert [c.check for c in result.failed_checks] == ["null_rate", "unexpected_key", "duplicate_records"]
    assert result.metadata["field_count"] == "11" and result.data_type == "semi_structured"


def test_typed_route_agrees(spark, user_records, tmp_path):
    path = str(tmp_path / "u.jsonl")
    with open(path, "w") as handle:
        handle.writelines(json.dumps(u) + "\n" for u in users())
    typed = validate_records(spark.read.json(path), "users", "2024-06-01").first()
    untyped = validate_records(user_records, "users", "2024-06-01").first()
    assert typed.dimensions == untyped.dimensions and typed.failed_checks == untyped.failed_checks


def test_type_mix(spark):
    records = variants(spark, *[{"a": v, "n": n, "b": b} for v, n, b in [(1, 1, True), ("two", 2.5, True), (3, None, None), (4, 3, False)]])
    fields = fields_of(records)
    assert not fields["a"].type_consistent and fields["n"].type_consistent and fields["b"].type_consistent
    found = [r for r in record_checks(records, "2024-06-01").collect() if r.check == "type_inconsistency"]
    assert [(r.column, r.actual, r.severity) for r in found] == [("a", "25.0% of values are str (majority: int)", "warning")]
    assert record_scores(records).first().accuracy == pytest.approx(2 / 3 * 100)


def test_all_null_field_is_consistent(spark):
    assert fields_of(variants(spark, {"a": None}, {"a": None}))["a"].type_consistent


@pytest.mark.parametrize(
    "records, copies",
    [
        ([{"a": 1, "b": 2}, {"b": 2, "a": 1}], 1),
        ([{"a": 1, "b": None}, {"a": 1}], 1),
        ([{"a": {"b": None}}, {}], 1),
        (['{"a":1000}', '{"a":1e3}', '{"a":1000.0}'], 2),
        ([{"t": [1, 2]}, {"t": [1, 2]}, {"t": [2, 1]}], 1),
        ([{"a": 1}, {"a": "1"}], 0),
        ([{"a": "null"}, {}], 0),
    ],
)
def test_duplicates(spark, records, copies):
    assert duplicate_records(variants(spark, *records)).first().duplicate_count == copies


def test_field_names(spark):
    found = [r for r in record_checks(variants(spark, {"a b-c": 1, "naïve_1": 2}), "2024-06-01").collect() if r.check == "invalid_field_name"]
    assert [(r.column, r.actual) for r in found] == [("a b-c", "contains invalid character(s): ' ', '-'")]


@pytest.mark.parametrize("day, score, severity", [("2024-05-02", 100.0, None), ("2024-04-17", 75.0, "warning"), ("2024-01-01", 0.0, "error")])
def test_freshness_decays(spark, day, score, severity):
    records = variants(spark, {"created_at": day}, {"created_at": "2020-01-01"})
    found = [r.severity for r in record_checks(records, "2024-06-01").collect() if r.check == "stale_data"]
    assert found == ([severity] if severity else [])
    assert record_scores(records, "2024-06-01").first().freshness == pytest.approx(score)


def test_no_date_field_scores_half(spark):
    records = variants(spark, {"note": "2024-05-02"})
    assert record_scores(records, "2024-06-01").first().freshness == 50.0
    assert "no_date_fields" in [r.check for r in record_checks(records, "2024-06-01").collect()]


def test_links_and_addresses(spark):
    rows = [{"home_url": "ftp://x", "user_email": "nobody", "email": "not checked"}] + [
        {"home_url": "https://x", "user_email": "a@b.c", "email": "-"} for _ in range(4)
    ]
    found = {r.check: r for r in record_checks(variants(spark, *rows), "2024-06-01").collect()}
    assert found["invalid_url"].severity == "warning" and found["invalid_email"].actual.startswith("1 value(s)")
    assert record_scores(variants(spark, *rows)).first().validity == pytest.approx(100 / 3)


def test_depth_limit(spark):
    deep = {"a": {"b": {"c": {"d": {"e": {"f": 1}}}}}}
    found = [r.actual for r in record_checks(variants(spark, deep), "2024-06-01").collect() if r.check == "excessive_nesting_depth"]
    assert found == ["max_nesting_depth = 6"]


def test_no_records(spark):
    row = record_scores(variants(spark, {}).limit(0)).first()
    assert (row.completeness, row.accuracy, row.uniqueness, row.freshness) == (0.0, 100.0, 100.0, 50.0)
