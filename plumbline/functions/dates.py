"""Date parsing and ageing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date spellings besides ISO 8601, each behind the shape
# a value must have before the (slower) formatter is tried.
DATE_FORMATS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
)
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]|$)"
NUMBER_SHAPE = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)$"


def parse_number(name: str) -> Column:
    """The text column ``name`` as double, null where it is no number.

    The shape test comes first because a failed cast costs an exception per value.
    """
    return F.expr(f"CASE WHEN trim({name}) RLIKE r'{NUMBER_SHAPE}' THEN try_cast(trim({name}) AS DOUBLE) END")


def parse_datetime(name: str) -> Column:
    """The text column ``name`` as TIMESTAMP, null where no declared format fits.

    The format is chosen per value, so the outcome does not depend on row order.
    """
    value = f"trim({name})"
    branches = [f"WHEN {value} RLIKE r'{ISO_SHAPE}' THEN try_cast({value} AS TIMESTAMP)"]
    branches += [
        f"WHEN {value} RLIKE r'{shape}' THEN CAST(try_to_timestamp({value}, '{pattern}') AS TIMESTAMP)"
        for shape, pattern in DATE_FORMATS
    ]
    return F.expr(f"CASE {' '.join(branches)} END")


def age_days(as_of: Column, column: Column) -> Column:
    """Whole days between two dates."""
    return F.datediff(F.to_date(as_of), F.to_date(column))


def age_days_exact(as_of: Column, column: Column) -> Column:
    """Fractional days between two instants."""
    micros = F.unix_micros(as_of) - F.unix_micros(column)
    return micros / F.lit(86_400_000_000.0)


def two_zone_decay(age: Column, recent: int, stale: int) -> Column:
    """100 up to ``recent`` days, 0 from ``stale`` days, linear in between."""
    falling = F.lit(100.0) - (age - recent) / F.lit(float(stale - recent)) * 100.0
    return (
        F.when(age <= recent, F.lit(100.0)).when(age >= stale, F.lit(0.0)).otherwise(falling)
    )
