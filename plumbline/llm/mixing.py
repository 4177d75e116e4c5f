"""Mixing sources to target weights by the cube method.

Every document is taken a whole number of times plus one more with a fractional
probability. Within a source the probabilities move along directions that change
neither the sum of words nor the number of documents, until all but two are 0 or
1; a small landing problem settles the rest. Blocks of documents fly in parallel,
what each leaves undecided flies again together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import cycle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import NOT_SPACE, stored

BLOCK_ROWS = 20_000
EDGE = 1e-9
# Documents that a landing settles together: it tries every subset.
LANDING_ROWS = 14


def targets(sizes: dict, weights: list[float], share: float, most: float) -> dict:
    """Words to take from each source: ``share`` of all, by weight, at most ``most`` times its size.

    Sources by code point, null last, take the weights in turn. What a capped
    source cannot take is shared anew by weight until none is above its cap.
    """
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = dict(zip(order, cycle(weights), strict=False))
    left, open_sources, found = share * sum(sizes.values()), list(order), {}
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        above = [s for s in open_sources if left * weight[s] / total > most * sizes[s]]
        if not above:
            found.update((s, left * weight[s] / total) for s in open_sources)
            break
        for s in above:
            found[s] = most * sizes[s]
        left -= sum(found[s] for s in above)
        open_sources = [s for s in open_sources if s not in found]
    return found


def _draw(seed: int, step: int) -> float:
    """A number from 0 to 1 that depends on its arguments only (splitmix64)."""
    x = (seed + step * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 27) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 31) / 2.0**64


def flight(sizes: list[float], probability: list[float], seed: int) -> list[float]:
    """Move ``probability`` until at most two are strictly between 0 and 1.

    Each step takes three undecided documents and a direction in the null space
    of their sizes and of their number, two documents where the sizes are equal.
    """
    p, held, step = list(probability), [], 0
    waiting = [i for i in range(len(p) - 1, -1, -1) if EDGE < p[i] < 1 - EDGE]
    while True:
        while waiting and len(held) < 3:
            held.append(waiting.pop())
        equal = next(((a, b) for k, a in enumerate(held) for b in held[k + 1 :] if sizes[a] == sizes[b]), None)
        if equal:
            move = [(equal[0], 1.0), (equal[1], -1.0)]
        elif len(held) == 3:
            a, b, c = held
            move = [(a, sizes[b] - sizes[c]), (b, sizes[c] - sizes[a]), (c, sizes[a] - sizes[b])]
            scale = max(abs(u) for _, u in move)
            move = [(i, u / scale) for i, u in move]
        else:
            break
        up = min((1 - p[i]) / u if u > 0 else p[i] / -u for i, u in move)
        down = min(p[i] / u if u > 0 else (1 - p[i]) / -u for i, u in move)
        go = up if _draw(seed, step) * (up + down) < down else -down
        step += 1
        for i, u in move:
            p[i] += go * u
        for i in held[:]:
            if p[i] <= EDGE or p[i] >= 1 - EDGE:
                p[i] = 0.0 if p[i] <= EDGE else 1.0
                held.remove(i)
    return p


def landing(sizes: list[float], begun: list[float], p: list[float]) -> list[float]:
    """Decide what a last flight left, two documents at most.

    They and some documents that were undecided when it ``begun``, spread over
    the sizes, are settled together: of all their subsets the one nearest to
    the words, then to the number, that their probabilities promise.
    """
    p, still = list(p), [i for i, x in enumerate(p) if EDGE < x < 1 - EDGE]
    if not still:
        return p
    others = sorted((i for i, x in enumerate(begun) if EDGE < x < 1 - EDGE and i not in still), key=lambda i: sizes[i])
    spare = min(len(others), LANDING_ROWS - len(still))
    chosen = still + [others[(2 * k + 1) * len(others) // (2 * spare)] for k in range(spare)]
    size, now = np.array([sizes[i] for i in chosen]), np.array([p[i] for i in chosen])
    picks = (np.arange(1 << len(chosen))[:, None] >> np.arange(len(chosen)) & 1).astype(float)
    cost = abs(picks @ size - now @ size) / max(1.0, size.mean()) + 0.1 * abs(picks.sum(axis=1) - now.sum())
    for i, x in zip(chosen, picks[int(cost.argmin())].tolist(), strict=True):
        p[i] = x
    return p


def numbered(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", extra: tuple[str, ...] = ()
) -> DataFrame:
    """uid, doc_id, source and size of every row; ``uid`` tells alike rows apart."""
    return documents.select(
        *extra,
        F.monotonically_increasing_id().alias("uid"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(NOT_SPACE)).cast("long").alias("size"),
    )


def dealt(rows: DataFrame, seed: int) -> DataFrame:
    """The :func:`numbered` rows with ``deal``, the number by which they are dealt to blocks.

    It depends on id and size, and on which copy a row is among those alike in these and in source, so a row
    repeated any number of times goes to all blocks in turn. Copies are numbered from the counts
    of each input partition, so no task holds more of them than one partition has.
    """
    alike = ["_id", "size", "_source", "_part"]
    rows = rows.withColumn("_id", F.coalesce("doc_id", "uid")).withColumn("_part", F.shiftright("uid", 33))
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    counts = rows.groupBy(*alike).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_id", "size", "_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*alike, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).where("_before > 0")
    copy = F.row_number().over(Window.partitionBy(*alike).orderBy("uid")) - 1 + F.coalesce("_before", F.lit(0))
    deal = F.pmod(F.xxhash64(F.lit(seed), "_id", "size"), F.lit(1 << 40)) + copy
    return rows.join(counts, alike, "left").withColumn("deal", deal).drop("_id", "_source", "_part", "_before")


def decide(
    rows: DataFrame,
    weights: list[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """How often the mix takes each of the stored :func:`numbered` rows."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    plan = targets({row["source"]: row["size"] for row in totals}, list(weights), share, most)
    settled = [
        (row["source"], row["size"], plan[row["source"]], plan[row["source"]] / row["size"] if row["size"] else 0.0, -(-row["n"] // block_rows))
        for row in totals
    ]
    per_source = rows.sparkSession.createDataFrame(
        settled, "of string, source_size long, target double, rate double, blocks long"
    )
    # Draws depend on ids and sizes alone; rows without an id have only their number to be dealt by.
    state = dealt(rows, seed).join(F.broadcast(per_source), F.col("source").eqNullSafe(F.col("of"))).select(
        "uid",
        F.col("doc_id").isNotNull().alias("has_id"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        F.floor("rate").alias("whole"),
        (F.col("rate") - F.floor("rate")).alias("p"),
        F.pmod("deal", F.col("blocks")).alias("block"),
    )
    done, round_number, n_blocks = None, 0, max([1, *(row[4] for row in settled)])
    while True:
        last = n_blocks == 1
        state = stored(_fly(state, seed + round_number, last), "mix-flight")
        decided = state.where("p = 0 or p = 1")
        done = decided if done is None else done.union(decided)
        if last:
            break
        n_blocks = -(-2 * n_blocks // block_rows)
        round_number += 1
        state = state.where("p > 0 and p < 1").withColumn("block", F.pmod(F.col("block"), F.lit(n_blocks)))
    times = (F.col("whole") + F.col("p")).cast("long")
    return done.select(
        "uid",
        F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        times.alias("times"),
        (times * F.col("size")).alias("taken"),
    )


def _fly(state: DataFrame, seed: int, last: bool) -> DataFrame:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Long documents first, so that short ones are what is left to land.
        rows = rows.sort_values(["size", "has_id", "doc_id", "uid"], ascending=[False, True, True, True], kind="stable")
        sizes = rows["size"].astype(float).tolist()
        p = flight(sizes, rows["p"].tolist(), seed * 1_000_003 + int(key[1]))
        if last:
            p = landing(sizes, rows["p"].tolist(), p)
        return rows.assign(p=[0.0 if x <= EDGE else 1.0 if x >= 1 - EDGE else x for x in p])

    return state.groupBy("source", "block").applyInPandas(run, state.schema)


def mix(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """doc_id, source, size, source_size, target, times and taken of every row.

    Options are those of :func:`decide`: ``weights`` in turn, ``share`` of all
    words, ``most`` times a document at most, ``seed``, ``block_rows``.
    ``times`` says how often the mix takes the row, ``taken`` is times x size. A null
    text has size 0. Null sources form one source, last in order. A source of
    size 0 has target 0 and gives nothing. Numbers are drawn by seed, id and
    size, so reruns agree; rows alike in these are interchangeable. An empty
    table gives no rows; other columns are not read. Only ids, sources and sizes
    are shuffled, never texts; a source is split into blocks of about
    ``block_rows`` rows, so one of any size is many tasks, and so are copies of one row. Rows
    without an id are dealt by position, so for them reruns agree over the same files only. One row per source
    comes to the driver: the sources of a mix are its configuration.
    """
    return decide(stored(numbered(documents, doc_id, text, source), "mix-sizes"), **options).drop("uid")


def mixed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``documents`` themselves, each as often as :func:`mix` takes it, columns as given."""
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    columns = [F.col(f"row.`{c}`").alias(name) for c, name in ((doc_id, "doc_id"), (text, "text"), (source, "source"))]
    rows = stored(numbered(documents.select(whole).select("row", *columns), extra=("row",)), "mix-rows")
    times = decide(rows.drop("row"), **options).where("times > 0").select("uid", "times")
    taken = rows.select("uid", "row").join(times, "uid")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
