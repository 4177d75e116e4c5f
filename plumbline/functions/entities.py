"""Entity counts by pattern, evaluated inside the scan stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label and pattern of each rule-tagged entity, with a substring
# that must occur before the pattern is worth trying.
ENTITY_PATTERNS = {
    "DATE": ("-", r"(?<!\d)\d{4}-\d{2}-\d{2}(?!\d)"),
    "EMAIL": ("@", r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "MONEY": (None, r"[$€£]\d+(?:[.,]\d+)*"),
    "PERCENT": ("%", r"\d%"),
    "URL": ("://", r"https?://[^\s<>\"]+"),
}


def entity_count(text: Column, label: str) -> Column:
    """Occurrences of one label's pattern."""
    marker, pattern = ENTITY_PATTERNS[label]
    count = F.regexp_count(text, F.lit(pattern))
    return count if marker is None else F.when(text.contains(marker), count).otherwise(F.lit(0))


def entity_map(counts: dict[str, Column]) -> Column:
    """``map<label, count>`` of the labels that occur."""
    found = F.array(*[F.struct(F.lit(label).alias("key"), n.alias("value")) for label, n in counts.items()])
    return F.map_from_entries(F.filter(found, lambda e: e["value"] > 0))
