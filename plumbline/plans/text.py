"""The six quality dimensions of text documents, one document per row."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, QualityConfig, TextRules, as_of_column
from plumbline.functions.dates import age_days_exact, two_zone_decay
from plumbline.functions.scoring import fixed
from plumbline.operators.documents import text_features, with_likely_duplicates
from plumbline.plans.isolation import EXPECTED, failed_records, failing_dimensions
from plumbline.plans.results import result_record
from plumbline.session import settled
from plumbline.types import check_struct, present

log = logging.getLogger(__name__)
NONE_FAILING: Mapping[str, str] = {}


def document_metrics(features: DataFrame, as_of, modified_at: str | None, name: str, unique_names: bool) -> DataFrame:
    """Features plus ``duplicate_count`` and ``age_days`` (null when no time is known)."""
    age = F.lit(None).cast("double")
    if modified_at is not None:
        age = age_days_exact(as_of_column(as_of), F.col(modified_at).cast("timestamp"))
    return with_likely_duplicates(features, name, unique_names).withColumn("age_days", age)


def document_scores(metrics: DataFrame, rules: TextRules, failing: Mapping[str, str] = NONE_FAILING) -> DataFrame:
    """Add the six scores to every document; dimensions in ``failing`` score zero."""
    words = F.col("word_count")
    accuracy = (
        F.lit(100.0)
        - F.when(F.col("encoding_errors"), 30.0).otherwise(0.0)
        - F.when(F.col("uppercase_ratio") > rules.uppercase_limit, 20.0).otherwise(0.0)
        - F.when(F.col("special_char_ratio") > rules.special_limit, 20.0).otherwise(0.0)
    )
    consistency = F.when(F.col("language") == "unknown", 50.0).otherwise(100.0) - F.when(
        F.col("whitespace_ratio") > rules.whitespace_limit, 20.0
    ).otherwise(0.0)
    foreign = ~F.col("language").isin(*rules.languages)
    validity = (
        F.lit(100.0)
        - F.when(foreign, 50.0).otherwise(0.0)
        - F.when(F.col("sentence_count") < 1, 50.0).otherwise(0.0)
    )
    completeness = (
        F.when(F.col("is_empty"), 0.0)
        .when(words >= rules.full_words, 100.0)
        .otherwise(words / F.lit(float(rules.full_words)) * 100)
    )
    freshness = F.coalesce(two_zone_decay(F.col("age_days"), rules.recent_days, rules.stale_days), F.lit(0.0))
    scores = {
        "completeness": completeness,
        "accuracy": F.greatest(F.lit(0.0), accuracy),
        "consistency": consistency,
        "freshness": F.when(F.col("age_days").isNull(), 0.0).otherwise(freshness),
        "uniqueness": F.when(F.col("duplicate_count") > 0, 0.0).otherwise(100.0),
        "validity": validity,
    }
    scores.update({d: F.lit(0.0) for d in failing})
    return metrics.select("*", *[F.round(scores[d], 2).alias(d) for d in DIMENSIONS])


def document_checks(rules: TextRules, failing: Mapping[str, str] = NONE_FAILING) -> Column:
    """Array of the failed checks of one document, in dimension order; those in ``failing`` say why they did not run."""

    def when(condition, check, expected, actual, severity):
        return F.when(condition, check_struct(check, "document", expected, actual, severity))

    words = F.format_string("word_count = %d", "word_count")
    age = F.col("age_days")
    modified = F.format_string("file last modified %s days ago", fixed("age_days", 0))
    codes = ", ".join(f"'{c}'" for c in sorted(rules.languages))
    checks = {
        "completeness": [
            when(F.col("is_empty"), "is_empty", f"word_count >= {rules.empty_words}", words, "error"),
            when(
                ~F.col("is_empty") & (F.col("word_count") < rules.warn_words),
                "low_word_count", f"word_count >= {rules.warn_words}", words, "warning",
            ),
        ],
        "accuracy": [
            when(
                F.col("encoding_errors"), "encoding_errors",
                "no Unicode replacement characters (\\ufffd)", "replacement character \\ufffd detected", "error",
            ),
            when(
                F.col("uppercase_ratio") > rules.uppercase_limit, "excessive_uppercase",
                f"uppercase_ratio <= {rules.uppercase_limit}",
                F.format_string(
                    "uppercase_ratio = %s — possible OCR or formatting issue", fixed("uppercase_ratio", 4)
                ),
                "warning",
            ),
            when(
                F.col("special_char_ratio") > rules.special_limit, "excessive_special_chars",
                f"special_char_ratio <= {rules.special_limit}",
                F.format_string("special_char_ratio = %s", fixed("special_char_ratio", 4)),
                "warning",
            ),
        ],
        "consistency": [
            when(
                F.col("language") == "unknown", "language_undetected",
                "detectable language", "Language could not be detected", "warning",
            ),
            when(
                F.col("whitespace_ratio") > rules.whitespace_limit, "excessive_whitespace",
                f"whitespace_ratio <= {rules.whitespace_limit}",
                F.format_string("whitespace_ratio = %s — Excessive whitespace detected", fixed("whitespace_ratio", 4)),
                "warning",
            ),
        ],
        "freshness": [
            when(
                age >= rules.stale_days, "stale_file",
                f"file modified within {rules.stale_days} days", modified, "error",
            ),
            when(
                (age > rules.recent_days) & (age < rules.stale_days), "aging_file",
                f"file modified within {rules.recent_days} days", modified, "warning",
            ),
            when(
                age.isNull(), "freshness",
                "check to complete without error", "modification time is unknown", "error",
            ),
        ],
        "uniqueness": [
            when(
                F.col("duplicate_count") > 0, "likely_duplicate",
                "unique char_count and word_count combination",
                F.format_string(
                    "char_count=%d and word_count=%d matches %d other document(s)",
                    "char_count", "word_count", "duplicate_count",
                ),
                "warning",
            ),
        ],
        "validity": [
            when(
                ~F.col("language").isin(*rules.languages), "unexpected_language",
                f"language in [{codes}]",
                F.concat(F.lit("detected language = '"), F.col("language"), F.lit("'")),
                "error",
            ),
            when(
                F.col("sentence_count") < 1, "no_sentences",
                "sentence_count >= 1", F.format_string("sentence_count = %d", "sentence_count"), "warning",
            ),
        ],
    }
    for dimension, reason in failing.items():
        checks[dimension] = [check_struct(dimension, "document", EXPECTED, reason, "error")]
    return present(*[check for dimension in DIMENSIONS for check in checks[dimension]])


def score_documents(
    features: DataFrame,
    name: str,
    as_of=None,
    modified_at: str | None = None,
    config: QualityConfig = QualityConfig(),
    unique_names: bool = True,
    failing: Mapping[str, str] = NONE_FAILING,
) -> DataFrame:
    """Feature rows with their scores and ``failed_checks``."""
    metrics = document_metrics(features, as_of, modified_at, name, unique_names)
    scored = document_scores(metrics, config.text, failing)
    return scored.withColumn("failed_checks", document_checks(config.text, failing))


def validate_features(
    features: DataFrame,
    name: str,
    as_of=None,
    modified_at: str | None = None,
    config: QualityConfig = QualityConfig(),
    unique_names: bool = True,
    run_id: str = "",
    source_path: str | None = None,
    error: str | None = None,
    isolate: bool = False,
) -> DataFrame:
    """One result record per feature row.

    Rows whose ``error`` column is not null could not be read: they score zero with that reason and
    take no part in the search for likely duplicates. With ``isolate`` the records are computed now;
    should that fail, the dimensions that fail alone score zero with the reason in every document.
    """
    path = F.col(source_path) if source_path else F.lit("")
    broken = None
    if error is not None:
        reasons = features.where(F.col(error).isNotNull()).select(
            F.col(name).cast("string").alias("dataset_name"), path.alias("source_path"), F.col(error).alias("reason")
        )
        broken = failed_records(reasons, "text", config, as_of, run_id)
        features = features.where(F.col(error).isNull())

    def records(failing: Mapping[str, str] = NONE_FAILING) -> DataFrame:
        scored = score_documents(features, name, as_of, modified_at, config, unique_names, failing).withColumn(
            "metadata",
            F.create_map(
                F.lit("char_count"), F.col("char_count").cast("string"),
                F.lit("word_count"), F.col("word_count").cast("string"),
                F.lit("sentence_count"), F.col("sentence_count").cast("string"),
                F.lit("language"), F.col("language"),
            ),
        )
        done = result_record(scored, "text", config, F.col(name), as_of_column(as_of), run_id, path)
        return done if broken is None else done.unionByName(broken)

    def alone(dimension: str) -> DataFrame:
        others = {d: "" for d in DIMENSIONS if d != dimension}
        scored = score_documents(features, name, as_of, modified_at, config, unique_names, others)
        return scored.select(dimension, "failed_checks")

    if not isolate:
        return records()
    try:
        return settled(records())
    except Exception:  # noqa: BLE001 - each dimension reports its own failure below
        log.exception("documents failed as a whole")
    return settled(records(failing_dimensions(alone)))


def validate_documents(
    docs: DataFrame,
    name: str = "doc_id",
    text: str = "text",
    as_of=None,
    modified_at: str | None = None,
    config: QualityConfig = QualityConfig(),
    unique_names: bool = True,
    run_id: str = "",
    source_path: str | None = None,
    error: str | None = None,
    isolate: bool = False,
) -> DataFrame:
    """Features, six dimensions, failed checks and score of every document; ``error`` and ``isolate`` as in
    :func:`validate_features`."""
    features = text_features(docs, text, config.text)
    return validate_features(
        features, name, as_of, modified_at, config, unique_names, run_id, source_path, error, isolate
    )
