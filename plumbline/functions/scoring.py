"""Row-level score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, Bands, Weights


def weighted_score(weights: Weights, dimensions: str = "dimensions") -> Column:
    """Weighted sum of the six dimension scores, rounded to two places."""
    total = F.lit(0.0)
    for dim in DIMENSIONS:
        total = total + F.col(f"{dimensions}.{dim}") * F.lit(float(getattr(weights, dim)))
    return F.round(total, 2)


def label(score: Column, bands: Bands) -> Column:
    return (
        F.when(score >= bands.pass_score, F.lit("PASS"))
        .when(score >= bands.warn_score, F.lit("WARN"))
        .otherwise(F.lit("FAIL"))
    )


def emphasis(score: Column, bands: Bands) -> Column:
    """How much a score cell should stand out in a report."""
    return (
        F.when(score < bands.warn_score / 2, F.lit("critical"))
        .when(score < bands.warn_score, F.lit("warning"))
        .otherwise(F.lit("normal"))
    )


def trend_delta(current: Column, previous: Column) -> Column:
    return F.round(current - previous, 2)


def trend_direction(current: Column, previous: Column) -> Column:
    delta = trend_delta(current, previous)
    return (
        F.when(previous.isNull(), F.lit("new"))
        .when(delta > 0, F.lit("up"))
        .when(delta < 0, F.lit("down"))
        .otherwise(F.lit("flat"))
    )


def fixed(value: str, places: int) -> Column:
    """A non-negative SQL expression with so many decimals, rounded on its exact binary value.

    The formatter rounds the shortest decimal spelling and so makes 0.35005,
    which is a little less than that, 0.3501. Here the value is split into two
    halves whose products with the power of ten are exact, so the comparison
    with one half is exact too.
    """
    scale = f"{10**places}D"
    spread = f"(({value}) * 134217729D)"
    high = f"({spread} - ({spread} - ({value})))"
    low = f"(({value}) - {high})"
    whole = f"floor({high} * {scale})"
    beyond_half = f"(({high} * {scale} - {whole} - 0.5D) + {low} * {scale})"
    step = f"CASE WHEN {beyond_half} > 0 THEN 1 WHEN {beyond_half} < 0 THEN 0 ELSE {whole} % 2 END"
    return F.expr(f"format_string('%.{places}f', ({whole} + {step}) / {scale})")


def percent(value: str, places: int = 2) -> Column:
    """``0.1234`` as ``12.34%``."""
    return F.concat(fixed(f"({value}) * 100", places), F.lit("%"))


def percent_text(value: float, places: int = 0) -> str:
    return f"{value * 100:.{places}f}%"
