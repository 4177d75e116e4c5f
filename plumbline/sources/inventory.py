"""Which files there are, and which module takes each: a listing, no file is opened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.paths import path_stem, path_suffix

# Data type of each suffix.
ROUTES = {
    "structured": (".csv", ".parquet", ".pq"),
    "semi_structured": (".json", ".jsonl", ".log"),
    "text": (".txt", ".pdf", ".eml"),
}
EXTRACTED = "_extracted"


def route(suffix: Column) -> Column:
    """Data type of a suffix, null when no module takes it."""
    choice = F.lit(None).cast("string")
    for data_type, suffixes in ROUTES.items():
        choice = F.when(suffix.isin(*suffixes), F.lit(data_type)).otherwise(choice)
    return choice


def with_routes(files: DataFrame, path: str = "path") -> DataFrame:
    """Add stem, suffix and data type to a table of paths."""
    suffix = path_suffix(F.col(path))
    return files.select(
        "*", path_stem(F.col(path)).alias("stem"), suffix.alias("suffix"), route(suffix).alias("data_type")
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified_at, stem, suffix, data_type`` of every file below a folder.

    The content column is not selected, so nothing but the listing is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listing = files.select("path", "length", F.col("modificationTime").alias("modified_at"))
    return with_routes(listing)


def sorted_files(inventory: DataFrame, data_type: str) -> DataFrame:
    """The files of one type in name order."""
    return inventory.where(F.col("data_type") == data_type).orderBy("path")


def match_raw_sources(extracted: DataFrame, raw: DataFrame) -> DataFrame:
    """Each extracted file with the raw file it came from, by stem; null when gone."""
    derived = extracted.where(F.col("stem").endswith(EXTRACTED)).select(
        F.col("path").alias("extracted_path"),
        F.regexp_replace("stem", f"{EXTRACTED}$", "").alias("stem"),
    )
    # One raw file per stem: the first suffix in name order.
    origin = raw.groupBy("stem").agg(F.min_by("path", "suffix").alias("raw_path"))
    return derived.join(origin, "stem", "left")
