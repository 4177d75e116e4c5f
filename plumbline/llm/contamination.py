"""Benchmark items inside long documents, by containment instead of resemblance.

An item of n shingles is found in a document that holds at least ``threshold`` of
them, however long the document is. MinHash signatures of whole documents would
have to grow with the documents to see that, so the signature is the item's:
items are partitioned by size, and the bottom sketch of an item, its smallest
hashes, is as long as the largest size of its partition calls for. If the item
is there, at most ``n - ceil(threshold * n)`` of its shingles are missing, so a sketch with one
more cannot be missing whole. A document offers each partition the hashes up to
the largest in that partition's sketches. Candidates are verified by the
shingles themselves. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import stored

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# What is broadcast has been measured and is no larger; else both sides are shuffled.
BROADCAST_BYTES = 8 << 20
BLANK = " \t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    """Lower-cased words in order; none for null or blank text."""
    inner = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(BLANK))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def _starts(column: str, width: int) -> Column:
    """Positions at which a run of ``width`` entries begins, from 0."""
    return F.when(F.size(column) >= width, F.sequence(F.lit(0), F.size(column) - width)).otherwise(F.array().cast("array<int>"))


def _shingles(column: str, width: int) -> Column:
    return F.transform(_starts(column, width), lambda at: F.array_join(F.slice(column, at + 1, width), " "))


def _hashes(column: str, width: int) -> Column:
    """A hash of each shingle, from the hashes of its words in ``column``."""
    return F.transform(_starts(column, width), lambda at: F.xxhash64(*[F.get(column, at + k) for k in range(width)]))


def _sized(df: DataFrame, row_bytes: Column) -> DataFrame:
    """``df`` marked for broadcast if its measured size allows it."""
    size = df.agg(F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _needed(n: Column, threshold: float) -> Column:
    # Rounded first, so that 0.8 of 5 is 4 and not a little more.
    return F.ceil(F.round(n * F.lit(threshold), 9))


def _indexed(benchmark: DataFrame, threshold: float, shingle_words: int, item_id: str, item_text: str) -> DataFrame:
    """item_id, width, shingle, hash, n_shingles and in_sketch of every different shingle of every item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), _words(F.col(item_text)).alias("words")).where(
        "item_id is not null and size(words) > 0"
    )
    items = items.withColumn("width", F.least(F.size("words"), F.lit(shingle_words)))
    items = items.withColumn("hashed", F.transform("words", lambda word: F.xxhash64(word)))
    each = [
        items.where(F.col("width") == width).select(
            "item_id", "width", F.explode(F.arrays_zip(_shingles("words", width).alias("shingle"), _hashes("hashed", width).alias("hash"))).alias("z")
        )
        for width in range(1, shingle_words + 1)
    ]
    parts = reduce(DataFrame.union, each).select("item_id", "width", "z.shingle", "z.hash").distinct()
    ranked = parts.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("hash", "width", "shingle"))).alias("parts"))
    ranked = ranked.withColumn("n_shingles", F.size("parts").cast("long")).withColumn("size_class", F.floor(F.log2("n_shingles")))
    largest = ranked.groupBy("size_class").agg(F.max("n_shingles").alias("largest"))
    ranked = ranked.join(F.broadcast(largest), "size_class")  # a row for each power of two
    length = F.col("largest") - _needed(F.col("largest"), threshold) + 1
    return ranked.select("item_id", "n_shingles", "size_class", length.alias("length"), F.posexplode("parts").alias("at", "part")).select(
        "item_id", "n_shingles", "size_class", "part.*", (F.col("at") < F.col("length")).alias("in_sketch")
    )


def found_items(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    shingle_words: int = SHINGLE_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_found and containment of each item found in a document.

    Words are runs without ASCII white space, lower-cased; shingles are the
    different runs of ``shingle_words`` words. An item with fewer words is one
    shingle of all its words; one without words is found nowhere, nor is anything in
    a null or empty text. Rows that share an id are one document, or one item;
    rows without an id are not judged. Empty tables give no rows. Other columns
    are not read. Texts are shuffled only if the candidates' ids outgrow
    ``BROADCAST_BYTES``.
    """
    index = stored(_indexed(benchmark, threshold, shingle_words, item_id, item_text), "items")
    sketch = index.where("in_sketch")
    # The largest hash that any partition of a shingle width looks at; a row for each width.
    tops = {row["width"]: row["top"] for row in sketch.groupBy("width").agg(F.max("hash").alias("top")).collect()}
    widths = sorted(tops) or [shingle_words]

    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null")
    hashed = docs.select("doc_id", F.transform(_words(F.col("text")), lambda word: F.xxhash64(word)).alias("hashed"))

    def small_hashes(width: int) -> DataFrame:
        small = F.filter(_hashes("hashed", width), lambda h: h <= tops.get(width, 0))
        return hashed.select("doc_id", F.lit(width).alias("width"), F.explode(small).alias("hash"))

    probes = [small_hashes(width) for width in widths]
    wanted = _sized(sketch.select("width", "hash").distinct(), F.lit(64))
    candidates = stored(reduce(DataFrame.union, probes).join(wanted, ["width", "hash"], "left_semi").select("doc_id").distinct(), "items-candidates")

    near = docs.join(_sized(candidates, F.lit(64)), "doc_id", "left_semi").select("doc_id", _words(F.col("text")).alias("words"))
    held = reduce(
        DataFrame.union,
        [near.select("doc_id", F.lit(w).alias("width"), F.explode(_shingles("words", w)).alias("shingle")) for w in widths],
    )
    listed = index.select("item_id", "n_shingles", "width", "shingle").distinct()
    shared = held.join(_sized(listed, F.octet_length("shingle") + 96), ["width", "shingle"])
    counted = shared.groupBy("doc_id", "item_id").agg(
        F.first("n_shingles").alias("n_shingles"), F.count_distinct("shingle").alias("n_found")
    )
    return counted.where(F.col("n_found") >= _needed(F.col("n_shingles"), threshold)).select(
        "doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")
    )


def clean_of(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` in which no item is found, with their own columns.

    Options are those of :func:`found_items`. Rows that share an id go together,
    rows without an id stay.
    """
    found = stored(found_items(documents, benchmark, doc_id=doc_id, text=text, **options).select("doc_id").distinct(), "items-found")
    found = _sized(found.withColumnRenamed("doc_id", "_found"), F.lit(64))
    return documents.join(found, F.col(f"`{doc_id}`") == F.col("_found"), "left_anti")
