"""Document features: one row per document, computed inside the scan stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import TextRules
from plumbline.functions import language as lg
from plumbline.functions import text as tx
from plumbline.functions.entities import ENTITY_PATTERNS, entity_count, entity_map
from plumbline.operators.skew import with_key_counts

FEATURES = (
    "char_count", "word_count", "sentence_count", "avg_word_length",
    "language", "language_confidence",
    "special_char_ratio", "whitespace_ratio", "uppercase_ratio",
    "entities", "is_empty", "encoding_errors",
)


def text_features(
    docs: DataFrame, text: str = "text", rules: TextRules = TextRules()
) -> DataFrame:
    """Add the features to every document; the text itself is dropped.

    Columns ``language`` and ``language_confidence`` already present (say from
    trained profiles) are kept; otherwise function words decide.
    """
    given = "language" in docs.columns
    own = {text, "language", "language_confidence"}
    others = [c for c in docs.columns if c not in own]
    kept = [F.col("language"), F.col("language_confidence")] if given else []
    # Shared intermediate values are columns of their own, so that no later
    # projection repeats the pass over the text behind them.
    content = F.col("_text")
    read = docs.select(*others, *kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    counted = read.withColumn("_spaced", tx.spaced(content)).select(
        *others,
        *kept,
        *([] if given else [lg.function_words(content).alias("_words")]),
        tx.char_count(content).alias("char_count"),
        tx.word_count(F.col("_spaced")).alias("word_count"),
        tx.whitespace_count(F.col("_spaced")).alias("_ws"),
        tx.sentence_count(content).alias("sentence_count"),
        tx.letter_count(content).alias("_letters"),
        tx.number_count(content).alias("_numbers"),
        tx.uppercase_count(content).alias("_upper"),
        *[entity_count(content, label).alias(f"_ent_{label}") for label in ENTITY_PATTERNS],
        content.contains(tx.REPLACEMENT).alias("encoding_errors"),
    )
    if not given:
        hits = lg.hit_counts(F.col("_words"))
        named = {c: F.col(f"_hits_{c}") for c in lg.CODES}
        counted = (
            counted.select("*", *[h.alias(f"_hits_{c}") for c, h in hits.items()])
            .withColumn("language", lg.best_language(named))
            .withColumn("language_confidence", lg.confidence(named))
        )
    special = F.col("char_count") - F.col("_ws") - F.col("_letters") - F.col("_numbers")
    visible = F.col("char_count") - F.col("_ws")
    return counted.select(
        *others,
        "char_count",
        "word_count",
        "sentence_count",
        tx.ratio(visible, F.col("word_count"), 4).alias("avg_word_length"),
        "language",
        "language_confidence",
        tx.ratio(special, F.col("char_count"), 6).alias("special_char_ratio"),
        tx.ratio(F.col("_ws"), F.col("char_count"), 6).alias("whitespace_ratio"),
        tx.ratio(F.col("_upper"), F.col("_letters"), 6).alias("uppercase_ratio"),
        entity_map({label: F.col(f"_ent_{label}") for label in ENTITY_PATTERNS}).alias("entities"),
        (F.col("word_count") < rules.empty_words).alias("is_empty"),
        "encoding_errors",
    )


def with_likely_duplicates(features: DataFrame, name: str, unique_names: bool = True) -> DataFrame:
    """Add ``duplicate_count``: other-named documents with equal character and word counts.

    With unique names that is the size of the group less one. Otherwise the
    documents of the same name are counted and taken off as well.
    """
    keys = ["char_count", "word_count"]
    grouped = with_key_counts(features, keys, "_alike")
    if unique_names:
        return grouped.withColumn("duplicate_count", F.col("_alike") - 1).drop("_alike")
    named = with_key_counts(grouped, [*keys, name], "_same_name")
    return named.withColumn("duplicate_count", F.col("_alike") - F.col("_same_name")).drop("_alike", "_same_name")
