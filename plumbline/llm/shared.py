"""What the operators share: tables, stored intermediates, word rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import checkpoint_dir

# A word is a run of anything but these characters.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage, survives lost executors, and gives the planner true sizes.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/plumbline-{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """Remainder of the crc32 of the id's decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def words(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased; no words for null or blank text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SPACE), lambda word: word != "")
