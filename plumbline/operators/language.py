"""Language identification by trained character trigrams.

Profiles are the most frequent trigrams of labelled text with a weight by rank
(after Cavnar and Trenkle, "N-Gram-Based Text Categorization", 1994). Their
size is fixed by the parameters, so they are broadcast whatever the corpus.
Trigrams are counted inside the scan, some texts at a time, and leave it as
counts; a row for each occurrence would outnumber the characters of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window


PROFILE_SIZE = 300
# Characters counted at once; a longer text is counted in pieces.
PIECE = 1 << 18
# A code point takes 21 bits.
POINT = np.int64(21)


def _letters(text: Column) -> Column:
    """The lower-cased letters, other runs as ``_``."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", "_")


def trigrams(text: Column) -> Column:
    """All overlapping trigrams of the lower-cased letters, other runs as ``_``.

    Three passes of non-overlapping matches at offsets 0, 1 and 2 make this
    linear, where cutting by position would rescan the text for each trigram.
    """
    letters = _letters(text)
    passes = [F.regexp_extract_all(F.substr(letters, F.lit(i)), F.lit("(...)"), F.lit(1)) for i in (1, 2, 3)]
    return F.concat(*passes)


def _pieces(texts: list[str | None], owners: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    """Texts and their owners, about ``PIECE`` characters at a time; pieces of a text share two characters."""
    some, whose, held = [], [], 0
    for text, owner in zip(texts, owners, strict=True):
        for at in range(0, len(text or "") - 2, PIECE):
            some.append(text[at : at + PIECE + 2])
            whose.append(owner)
            held += len(some[-1])
            if held >= PIECE:
                yield some, whose
                some, whose, held = [], [], 0
    if some:
        yield some, whose


def _counted(texts: list[str | None], owners: list[int]) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(owner, trigram, n) arrays: how often each trigram occurs in the texts of an owner, some texts at a time."""
    for some, whose in _pieces(texts, owners):
        # No text holds a zero, as it is not a letter.
        points = np.frombuffer("\0".join(some).encode("utf-32-le"), "<u4").astype(np.int64)
        gap = points == 0
        whole = ~(gap[:-2] | gap[1:-1] | gap[2:])
        grams = (points[:-2] << 2 * POINT | points[1:-1] << POINT | points[2:])[whole]
        owner = np.repeat(np.array(whose, np.int64), [len(text) - 2 for text in some])
        known, code = np.unique(grams, return_inverse=True)
        pairs, n = np.unique(owner * len(known) + code, return_counts=True)
        low = (1 << int(POINT)) - 1
        split = np.stack([known >> 2 * POINT, known >> POINT & low, known & low], axis=1).astype("<u4")
        names = pa.array(np.ascontiguousarray(split).view("<U3")[:, 0].tolist(), pa.string())
        yield pairs // len(known), names.take(pa.array(pairs % len(known))), n


def language_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """``(lang, gram, weight)``: the ``size`` most frequent trigrams of each language."""
    rows = labelled.select(F.col(lang).alias("lang"), _letters(F.col(text)).alias("letters"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, owners = batch.column(0), list(range(batch.num_rows))
            if not pa.types.is_nested(labels.type):
                encoded = labels.dictionary_encode(null_encoding="encode")
                labels, owners = encoded.dictionary, encoded.indices.to_pylist()
            for owner, gram, n in _counted(batch.column(1).to_pylist(), owners):
                yield pa.RecordBatch.from_arrays([labels.take(pa.array(owner)), gram, pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    schema = T.StructType([rows.schema["lang"], T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])
    counts = rows.mapInArrow(count, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return (
        counts.withColumn("rank", rank)
        .where(F.col("rank") <= size)
        .select("lang", "gram", (F.lit(size + 1) - F.col("rank")).cast("bigint").alias("weight"))
    )


def identify_language(docs: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, language, confidence, score)`` for every document.

    Trigrams are counted per document, meet the broadcast profiles in the scan
    stage and collapse there to one row per document and language; only those
    are shuffled. A document without any known trigram keeps a row and comes
    out as ``unknown``.
    """
    rows = docs.select(F.col(key), _letters(F.coalesce(F.col(text), F.lit(""))).alias("letters"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, size = batch.column(0), batch.num_rows
            yield pa.RecordBatch.from_arrays([keys, pa.nulls(size, pa.string()), pa.nulls(size, pa.int64())], names=[key, "gram", "n"])
            for owner, gram, n in _counted(batch.column(1).to_pylist(), list(range(size))):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner)), gram, pa.array(n, pa.int64())], names=[key, "gram", "n"])

    schema = T.StructType([rows.schema[0], T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])
    met = rows.mapInArrow(count, schema).join(F.broadcast(profiles), "gram", "left").where("gram is null or weight is not null")
    scored = met.groupBy(key, "lang").agg(F.sum(F.col("weight") * F.col("n")).alias("score"))
    best = F.max(F.when(F.col("lang").isNotNull(), F.struct("score", "lang")))
    return scored.groupBy(key).agg(
        F.coalesce(best["lang"], F.lit("unknown")).alias("language"),
        F.round(best["score"] / F.sum("score"), 4).alias("confidence"),
        best["score"].alias("score"),
    )
