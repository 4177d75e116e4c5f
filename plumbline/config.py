"""Thresholds, weights and their loader.

Every rule reads its limits from one of the frozen dataclasses below, so a
user changes behaviour with ``dataclasses.replace`` instead of subclassing.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six quality dimensions, in report order.
DIMENSIONS = (
    "completeness",
    "accuracy",
    "consistency",
    "freshness",
    "uniqueness",
    "validity",
)

# The legal data types of a result record.
DATA_TYPES = ("structured", "semi_structured", "text", "audio", "image", "video")


@dataclass(frozen=True)
class Weights:
    completeness: float = 0.25
    accuracy: float = 0.25
    consistency: float = 0.15
    freshness: float = 0.15
    uniqueness: float = 0.10
    validity: float = 0.10


@dataclass(frozen=True)
class Bands:
    pass_score: float = 80
    warn_score: float = 65


@dataclass(frozen=True)
class StructuredRules:
    null_warn: float = 0.05
    null_error: float = 0.20
    cardinality_ratio: float = 0.01
    cardinality_penalty: float = 5.0
    z_limit: float = 3.0
    outlier_error_rate: float = 0.05
    parse_ratio: float = 0.10
    date_parse_ratio: float = 0.80
    max_age_days: int = 30
    duplicate_warn: float = 0.01
    duplicate_error: float = 0.10
    max_string_length: int = 1000
    # Compare whole words of a column name instead of substrings.
    strict_names: bool = False


@dataclass(frozen=True)
class RecordRules:
    null_warn: float = 0.10
    null_error: float = 0.50
    type_mix_warn: float = 0.05
    type_mix_error: float = 0.25
    sparse_share: float = 0.10
    name_penalty: float = 10.0
    date_parse_ratio: float = 0.80
    recent_days: int = 30
    stale_days: int = 90
    no_date_score: float = 50.0
    duplicate_warn: float = 0.01
    duplicate_error: float = 0.10
    max_depth: int = 5
    bad_share_error: float = 0.25


@dataclass(frozen=True)
class TextRules:
    empty_words: int = 5
    warn_words: int = 20
    full_words: int = 50
    uppercase_limit: float = 0.5
    special_limit: float = 0.3
    whitespace_limit: float = 0.4
    recent_days: int = 30
    stale_days: int = 90
    languages: tuple[str, ...] = ("en", "fr", "ha", "ig", "pcm", "unknown", "yo")


@dataclass(frozen=True)
class QualityConfig:
    weights: Weights = field(default_factory=Weights)
    bands: Bands = field(default_factory=Bands)
    structured: StructuredRules = field(default_factory=StructuredRules)
    records: RecordRules = field(default_factory=RecordRules)
    text: TextRules = field(default_factory=TextRules)
    alert_below: float = 80


def config_from_mapping(raw: dict) -> QualityConfig:
    """Build a config from the ``thresholds`` / ``scoring_weights`` / ``alerts`` keys.

    A weight left out of ``scoring_weights`` counts as zero; weights are used
    as given, without normalising them.
    """
    cfg = {}
    if "scoring_weights" in raw:
        given = raw["scoring_weights"]
        cfg["weights"] = Weights(**{d: float(given.get(d, 0.0)) for d in DIMENSIONS})
    if "thresholds" in raw:
        known = {f.name for f in fields(Bands)}
        cfg["bands"] = Bands(**{k: v for k, v in raw["thresholds"].items() if k in known})
    below = (raw.get("alerts") or {}).get("alert_on_score_below")
    if below is not None:
        cfg["alert_below"] = float(below)
    return QualityConfig(**cfg)


def load_config(path: str) -> QualityConfig:
    """Read a YAML config file on the driver; the root must be a mapping."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"config file not found: {path}")
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover
        raise ImportError("reading a YAML config needs the pyyaml package") from exc
    with open(path, encoding="utf-8") as handle:
        raw = yaml.safe_load(handle)
    if not isinstance(raw, dict):
        raise ValueError(f"config root must be a mapping, got {type(raw).__name__}")
    return config_from_mapping(raw)


def as_of_column(as_of: dt.datetime | dt.date | str | None) -> Column:
    """The evaluation instant as a TIMESTAMP column; ``None`` means now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat()
    return F.lit(as_of).cast("timestamp")
