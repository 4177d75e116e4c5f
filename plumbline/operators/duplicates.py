"""Full-row duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import names
from plumbline.operators.columns import ColumnInfo, describe, group_value, text_value


def row_digest(infos: list[ColumnInfo]) -> Column:
    """A 256-bit digest of the row, equal exactly when the rows are equal; nulls and NaNs are alike."""
    texts = [text_value(names.quoted(c.name), c.dtype).alias(c.ref) for c in infos]
    return F.unhex(F.sha2(F.to_json(F.struct(*texts)), 256))


def row_groups(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies ``n``.

    Grouping treats nulls and NaNs as equal. Copies combine inside the map
    task, so a row repeated across a third of the table is no hot key.
    """
    infos = describe(df)
    keyed = df.select(*[group_value(names.quoted(c.name), c.dtype).alias(c.ref) for c in infos])
    return keyed.groupBy(*[c.ref for c in infos]).agg(F.count(F.lit(1)).alias("n"))


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: rows, copies after the first of each row, and their share.

    Rows are grouped by digest, so 32 bytes of each are shuffled, however wide it is.
    """
    infos = describe(df)
    groups = df.select(row_digest(infos).alias("digest") if infos else F.lit(b"").alias("digest"))
    totals = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
    )
    rate = F.coalesce(F.try_divide("duplicate_count", "row_count"), F.lit(0.0))
    return totals.withColumn("duplicate_rate", rate)


def mark_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Add ``is_duplicate``: true for every copy but the first by the unique column ``key``.

    Equality is judged on all other columns, by digest. The first key of each distinct row
    comes from a combinable ``min``; the mark is then an equi-join on the unique
    key, which cannot be skewed, where a window over the row itself would pull
    all copies of a frequent row into one task.
    """
    others = [c for c in describe(df) if c.name != key]
    digest = row_digest(others) if others else F.lit(b"")
    keyed = df.select(names.quoted(key).alias("first_key"), digest.alias("digest"))
    firsts = keyed.groupBy("digest").agg(F.min("first_key").alias("first_key")).select("first_key")
    marked = df.join(firsts, names.quoted(key) == F.col("first_key"), "left")
    return marked.withColumn("is_duplicate", F.col("first_key").isNull()).drop("first_key")
