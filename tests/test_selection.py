"""Selection of exact quantiles against sorting."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators import selection
from plumbline.operators.selection import key_of, order_keys, selected_quantiles, value_of

PROBABILITIES = (0.0, 0.05, 0.5, 0.95, 1.0)


def chosen(df, **kwargs):
    return {(r["column"], r["probability"]): r["value"] for r in selected_quantiles(df, PROBABILITIES, **kwargs).collect()}


def expected(values):
    numbers = sorted(v for v in values if v is not None and v == v)
    if not numbers:
        return dict.fromkeys(PROBABILITIES)
    return {p: float(np.quantile(np.array(numbers, dtype="float64"), p)) for p in PROBABILITIES}


def test_keys_keep_order_and_value(spark):
    rng = random.Random(5)
    doubles = [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(3000)]
    doubles = [d for d in doubles if d == d]
    doubles += [s * v for s in (1, -1) for e in range(-1074, 1024) for v in (2.0**e,)]
    doubles += [np.nextafter(2.0**e, 0) for e in range(-1000, 1024, 7)]
    doubles += [0.0, -0.0, float("inf"), float("-inf"), 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308]
    doubles = [float(d) for d in doubles]
    df = spark.createDataFrame([(d,) for d in doubles], "x double")
    rows = order_keys(df.select("x", F.col("x").alias("k"))).select("k").collect()
    rows = [{"x": x, "k": r["k"]} for x, r in zip(doubles, rows, strict=True)]
    assert all(key_of(r["x"], T.DoubleType()) == r["k"] for r in rows)
    assert all(value_of(r["k"], T.DoubleType()) == r["x"] for r in rows)
    by_key = sorted(rows, key=lambda r: r["k"])
    assert [r["x"] for r in by_key] == sorted(doubles)


@pytest.mark.parametrize("bits", [2, 12])
def test_quantiles_equal_sorting(spark, bits):
    rng = random.Random(bits)
    rows = []
    for i in range(700):
        rows.append(
            (
                rng.gauss(0, 1e6),
                7.5,
                rng.choice([1.0] * 50 + [rng.random()]),
                rng.randrange(-(2**62), 2**62),
                None if i % 3 else rng.random(),
                float("nan") if i % 2 else float(i),
                None,
                "text",
            )
        )
    names = ["wide", "constant", "skewed", "large", "sparse", "with nan", "empty", "t"]
    schema = "wide double, constant double, skewed double, large bigint, sparse double, `with nan` double, empty double, t string"
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = chosen(df, bits=bits, accuracy=100)
    for i, name in enumerate(names[:-1]):
        want = expected([r[i] for r in rows])
        for p in PROBABILITIES:
            value = got[name, p]
            assert value == want[p] or value == pytest.approx(want[p], rel=1e-12, abs=1e-12), (name, p)
    assert not any(column == "t" for column, _ in got)


def test_a_wrong_sketch_is_put_right(spark, monkeypatch):
    proposed = selection._proposed

    def astray(group, ref, low, high, brackets, bits):
        return proposed(group, ref, low, high, [(low, low)], bits)

    monkeypatch.setattr(selection, "_proposed", astray)
    df = spark.range(1001).select((F.col("id") * 1.5).alias("x"))
    assert chosen(df) == {("x", p): 1500 * p for p in PROBABILITIES}


def test_empty_tables_and_wrong_arguments(spark):
    empty = spark.createDataFrame([], "x double, s string")
    assert chosen(empty) == {("x", p): None for p in PROBABILITIES}
    assert selected_quantiles(spark.createDataFrame([("a",)], "s string")).collect() == []
    with pytest.raises(ValueError):
        selected_quantiles(empty, [1.5])
    with pytest.raises(ValueError):
        selected_quantiles(empty, columns=["s"])


def test_small_and_decimal_columns(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "a int, b int").select(
        "a", F.col("b").cast("decimal(12,2)").alias("b"), F.col("a").cast("tinyint").alias("c"), F.col("a").cast("float").alias("d")
    )
    got = chosen(df)
    assert got["a", 0.5] == got["c", 0.5] == got["d", 0.5] == 2 and got["b", 0.5] == 3
    assert got["a", 0.05] == pytest.approx(1.1)


def test_no_sort_of_values(spark):
    """Of the table's rows only counts by part reach an exchange or a sort."""
    keys = spark.range(10_000).select(F.col("id").alias("c0"))
    part = selection.Part(0, 0, "c0", 0, 9_999, selection._shift(0, 9_999, 4))
    counted = selection._counted(keys, [part])
    assert counted.count() <= 16
    assert counted.agg(F.sum("n")).first()[0] == 10_000
