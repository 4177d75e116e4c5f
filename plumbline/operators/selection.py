"""Exact quantiles by distributed selection: ranks are found by counting, no values are ordered.

Numbers are mapped to 64-bit integers that keep their order. A quantile sketch
proposes where each wanted rank lies; the proposed ranges are cut into
``2 ** bits`` parts, one scan counts the values of every part, and the part that
holds the rank is cut again until it holds one number only. Counts combine in the
map task, so a task hands on one row for each part it met, whatever the number of
rows or the skew. Between scans the driver holds one part for each column and
rank. Were the sketch wrong, the rank would be found in the stretch between the
proposed ranges, with further scans.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import names

FRACTION_BITS = 52
LEAST_EXPONENT = -1022
INFINITE_KEY = 2047 << FRACTION_BITS


def order_keys(numbers: DataFrame) -> DataFrame:
    """The columns as 64-bit integers, equal and ordered as the numbers are; NaN has none.

    A whole number is its own key. For others it is the sign times the bits of
    the magnitude as a double, so both zeros meet at 0. Names must be plain.
    """
    broken = [f.name for f in numbers.schema.fields if not isinstance(f.dataType, T.IntegralType)]
    whole = [F.col(c).cast("bigint").alias(c) for c in numbers.columns if c not in broken]
    power = lambda exponent: F.pow(F.lit(2.0), exponent)
    # In steps, so that each step's value is computed once for all its uses.
    steps = numbers.select(*whole, *[F.col(c).cast("double").alias(c) for c in broken])
    steps = steps.select("*", *[F.floor(F.least(F.log2(F.abs(c)), F.lit(1023.0))).alias(f"{c}_guess") for c in broken])
    # The logarithm may be off by one next to a power of two; the comparisons put that right.
    exact = [
        F.greatest(
            F.col(f"{c}_guess")
            - F.when(F.abs(c) < power(F.col(f"{c}_guess")), 1)
            .when(F.abs(c) >= power(F.col(f"{c}_guess") + 1), -1)
            .otherwise(0),
            F.lit(LEAST_EXPONENT),
        ).alias(f"{c}_exponent")
        for c in broken
    ]
    steps = steps.select(*numbers.columns, *exact)
    magnitudes = [
        F.when(F.col(c) == 0, F.lit(0))
        .when(F.abs(c) == float("inf"), F.lit(INFINITE_KEY))
        .when(
            ~F.isnan(c),
            F.shiftleft((F.col(f"{c}_exponent") - LEAST_EXPONENT).cast("bigint"), FRACTION_BITS)
            + (F.abs(c) / power(F.col(f"{c}_exponent")) * float(1 << FRACTION_BITS)).cast("bigint"),
        ).alias(f"{c}_size")
        for c in broken
    ]
    steps = steps.select(*numbers.columns, *magnitudes)
    keys = [F.when(F.col(c) < 0, -F.col(f"{c}_size")).otherwise(F.col(f"{c}_size")).alias(c) for c in broken]
    return steps.select(*[c for c in numbers.columns if c not in broken], *keys)


def key_of(value: float, dtype: T.DataType) -> int:
    """:func:`order_keys` of one number on the driver."""
    if isinstance(dtype, T.IntegralType):
        return int(value)
    magnitude = struct.unpack(">q", struct.pack(">d", abs(float(value))))[0]
    return -magnitude if value < 0 else magnitude


def value_of(key: int, dtype: T.DataType) -> float:
    """The number of a key, as a double."""
    if isinstance(dtype, T.IntegralType):
        return float(key)
    magnitude = struct.unpack(">d", struct.pack(">q", abs(key)))[0]
    return -magnitude if key < 0 else magnitude


@dataclass
class Part:
    """Keys ``low`` to ``high`` of a column, cut by ``shift`` bits; ``ranks`` count within ``group``."""

    group: int
    place: int
    ref: str
    low: int
    high: int
    shift: int
    ranks: list[int] = field(default_factory=list)


def _shift(low: int, high: int, bits: int) -> int:
    """How many low bits to leave out so that the keys fall into ``2 ** bits`` parts at most."""
    shift = 0
    while (high >> shift) - (low >> shift) >= 1 << bits:
        shift += 1
    return shift


def _proposed(group: int, ref: str, low: int, high: int, brackets: list[tuple[int, int]], bits: int) -> list[Part]:
    """The column's keys from end to end: brackets cut finely, each stretch between them as one part."""
    joined: list[list[int]] = []
    for start, end in sorted(brackets):
        if joined and start <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    parts, at = [], low
    for start, end in joined:
        if at < start:
            parts.append(Part(group, len(parts), ref, at, start - 1, 64))
        parts.append(Part(group, len(parts), ref, start, end, _shift(start, end, bits)))
        at = end + 1
    if at <= high:
        parts.append(Part(group, len(parts), ref, at, high, 64))
    return parts


def _counted(keys: DataFrame, parts: list[Part]) -> DataFrame:
    """``(group, place, piece, n, low, high)``: how many keys each piece holds, and the ends it really has."""
    of_column: dict[str, list[Part]] = {}
    for part in parts:
        of_column.setdefault(part.ref, []).append(part)
    cells = []
    for ref, own in of_column.items():
        # Parts of a column are disjoint, so a key falls into one at most.
        branches = []
        for p in own:
            piece = "0" if p.shift >= 64 else f"shiftright({ref}, {p.shift}) - {p.low >> p.shift}L"
            branches.append(
                f"WHEN {ref} BETWEEN {p.low}L AND {p.high}L THEN "
                f"named_struct('group', {p.group}, 'place', {p.place}, 'piece', CAST({piece} AS BIGINT), 'key', {ref})"
            )
        cells.append(f"CASE {' '.join(branches)} END")
    pieces = keys.selectExpr(f"inline(filter(array({', '.join(cells)}), c -> c IS NOT NULL))")
    return pieces.groupBy("group", "place", "piece").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    )


def _holders(keys: DataFrame, parts: list[Part]) -> list:
    """For each wanted (group, rank) the piece that holds it and how many keys of the group come before."""
    wanted = keys.sparkSession.createDataFrame(
        sorted({(p.group, rank) for p in parts for rank in p.ranks}), "group int, rank bigint"
    )
    # At most 2 ** bits rows for a part, however large the table.
    running = Window.partitionBy("group").orderBy("place", "piece").rowsBetween(Window.unboundedPreceding, 0)
    upto = _counted(keys, parts).withColumn("upto", F.sum("n").over(running))
    holds = (F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto"))
    return upto.join(F.broadcast(wanted), "group").where(holds).select(
        "group", "rank", (F.col("upto") - F.col("n")).alias("before"), "low", "high"
    ).collect()


def _selected(
    keys: DataFrame, parts: list[Part], bits: int
) -> dict[tuple[str, int], int]:
    """Key of each wanted (column, rank of the whole column)."""
    found: dict[tuple[str, int], int] = {}
    # Rank within the group to rank within the column.
    offset = {p.group: 0 for p in parts}
    while parts:
        ref_of = {p.group: p.ref for p in parts}
        opened: dict[tuple[str, int, int], Part] = {}
        offsets: dict[int, int] = {}
        for row in _holders(keys, parts):
            ref, low, high = ref_of[row["group"]], row["low"], row["high"]
            rank = offset[row["group"]] + row["rank"]
            if low == high:
                found[ref, rank] = low
                continue
            part = opened.setdefault(
                (ref, low, high), Part(len(opened), 0, ref, low, high, _shift(low, high, bits))
            )
            part.ranks.append(row["rank"] - row["before"])
            offsets[part.group] = offset[row["group"]] + row["before"]
        parts, offset = list(opened.values()), offsets
    return found


def selected_quantiles(
    df: DataFrame,
    probabilities: Sequence[float] = (0.5,),
    columns: Iterable[str] | None = None,
    bits: int = 12,
    accuracy: int = 10_000,
) -> DataFrame:
    """``(position, column, probability, value)``: exact quantiles of numeric columns, interpolated linearly.

    Null and NaN take no part; a column without numbers gives null. ``columns``
    names those wanted (default: all numeric ones). Decimals are compared as doubles. The table is scanned once for the sketch and once
    for each refinement (two or three as a rule, six at most beyond the sketch),
    so it must give the same rows each time. An empty table gives nulls.
    """
    for p in probabilities:
        if not 0 <= p <= 1:
            raise ValueError(f"a probability lies between 0 and 1, got {p!r}")
    wanted = None if columns is None else set(columns)
    fields = {
        f"c{i}": (i, f.name, f.dataType)
        for i, f in enumerate(df.schema.fields)
        if names.kind_of(f.dataType) == names.NUMERIC and (wanted is None or f.name in wanted)
    }
    if wanted is not None and wanted - {name for _, name, _ in fields.values()}:
        raise ValueError("quantiles need numeric columns")
    schema = "position bigint, column string, probability double, value double"
    spark = df.sparkSession
    if not fields or not probabilities:
        return spark.createDataFrame([], schema)
    numbers = df.select(*[names.quoted(name).alias(ref) for ref, (_, name, _) in fields.items()])
    keys = order_keys(numbers)

    slack = 3.0 / accuracy
    edges = [edge for p in probabilities for edge in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = keys.agg(
        *[
            F.struct(
                F.count(ref).alias("n"),
                F.min(ref).alias("low"),
                F.max(ref).alias("high"),
                F.percentile_approx(ref, edges, accuracy).alias("edges"),
            ).alias(ref)
            for ref in fields
        ]
    ).first()

    parts: list[Part] = []
    ranks: dict[tuple[str, float], tuple[int, int, float]] = {}
    for group, ref in enumerate(fields):
        seen = sketch[ref]
        if not seen["n"]:
            continue
        for p in probabilities:
            at = Fraction(str(p)) * (seen["n"] - 1)
            ranks[ref, p] = (math.floor(at) + 1, math.ceil(at) + 1, float(at - math.floor(at)))
        # Percentiles of large integers may be read through a double, hence the clamp.
        clamp = lambda key: min(max(int(key), seen["low"]), seen["high"])  # noqa: E731, B023
        pairs = [(clamp(a), clamp(b)) for a, b in zip(seen["edges"][::2], seen["edges"][1::2], strict=True)]
        own = _proposed(group, ref, seen["low"], seen["high"], [(min(p), max(p)) for p in pairs], bits)
        own[0].ranks = sorted({r for p in probabilities for r in ranks[ref, p][:2]})
        parts += own
    found = _selected(keys, parts, bits)

    rows = []
    for ref, (position, name, dtype) in fields.items():
        for p in probabilities:
            value = None
            if (ref, p) in ranks:
                first, second, share = ranks[ref, p]
                a, b = (value_of(found[ref, rank], dtype) for rank in (first, second))
                value = a if a == b or share == 0 else a * (1 - share) + b * share
            rows.append((position, name, float(p), value))
    return spark.createDataFrame(rows, schema)
