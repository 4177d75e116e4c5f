"""Joining per-key counts back to rows when a few keys hold much of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import settled

SALTS = 1024


def with_key_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name``: how many rows share this row's (non-null) ``keys``.

    A window would send each key's rows to one task. Here the counts combine
    before the shuffle and come back by two joins. A key is hot when it holds
    more rows than a shuffle partition does on average, so hot keys are fewer
    than partitions and come by broadcast; the others by key. Rows of hot keys
    carry their position as a salt into that second join so that they spread
    instead of meeting in one task, rows that are equal in everything too.
    """
    # Counted, totalled and joined: evaluated once for all three.
    df = settled(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    shared = counts.withColumn("_total", total)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col("_n") * partitions > F.col("_total")
    hot = shared.where(is_hot).select(*keys, F.col("_n").alias("_hot"))
    cold = shared.where(~is_hot).select(*keys, F.lit(-1).alias("_salt"), F.col("_n").alias("_cold"))
    marked = df.join(F.broadcast(hot), keys, "left")
    # Any salt gives the same result, as rows of hot keys match nothing in the second join.
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    salted = marked.withColumn("_salt", F.when(F.col("_hot").isNotNull(), salt).otherwise(F.lit(-1)))
    joined = salted.join(cold, [*keys, "_salt"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns], F.coalesce("_hot", "_cold").alias(name)
    )

