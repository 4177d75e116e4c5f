"""Hard negatives for anchors, from exact integer products of vectors.

Rows are packed into blocks of bounded size. Every block of anchors meets every
block of candidates once for the positives and once for the negatives; a task
holds one of each at a time. Their int64 tile is multiplied by Strassen's recursion
("Gaussian Elimination is not Optimal", 1969), which is exact on integers. Tiles
leave heaps of a few rows for each anchor, which merge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import stored

# Below this size in any direction a product is not split further.
LEAF = 32
# Rows of a block, fewer if the vectors are long.
BLOCK_ROWS, BLOCK_BYTES = 2_048, 4 << 20
# Blocks of candidates that a task takes one after another for a block of anchors.
BLOCKS_A_TASK = 8
LOWEST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for int64 matrices, modulo 2**64 in between and so exact wherever the result fits."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    # Odd sizes are filled up with a row or column of zeros.
    a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def firsts(scores: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Mask of the first ``count`` allowed entries of each row: higher scores first, then the earlier column."""
    held = np.where(allowed, scores, LOWEST)
    width = held.shape[1]
    if width <= count:
        return allowed
    edge = np.partition(held, width - count, axis=1)[:, width - count, None]
    above = held > edge
    level = allowed & (held == edge)
    return above | level & (level.cumsum(axis=1) <= count - above.sum(axis=1, keepdims=True))


def scaled(flat: np.ndarray, length: int, scale: int) -> np.ndarray:
    """floor(scale x), held within what keeps an inner product of ``length`` such components in 64 bits."""
    most = math.isqrt((2**63 - 1) // max(length, 1))
    return np.clip(np.floor(scale * flat.astype(np.float64)), -most, most).astype(np.int64)


def _packer(scale: int, length: int):
    """Rows (id, label, embedding) to rows of a block: ids, labels and matrix as bytes, ordered by id."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(length, 1))))

    def block(ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        cells = [x[order].tobytes() for x in (ids, labels, values)]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["ids", "labels", "cells"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                column = part.column(2)
                sizes = column.value_lengths().to_numpy(zero_copy_only=False)
                values = np.zeros((part.num_rows, length), np.int64)
                # A shorter vector is filled up with zeros.
                values[np.arange(length) < sizes[:, None]] = scaled(column.flatten().to_numpy(zero_copy_only=False), length, scale)
                kept.append((part.column(0).to_numpy(), part.column(1).to_numpy(), values))
                held += part.num_rows
                while held >= rows:
                    ids, labels, cells = (np.concatenate(x) for x in zip(*kept, strict=True))
                    yield block(ids[:rows], labels[:rows], cells[:rows])
                    kept, held = [(ids[rows:], labels[rows:], cells[rows:])], held - rows
        if held:
            yield block(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    return pack


def _unpacked(row: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["cells"], np.int64).reshape(len(ids), length)


class Heaps:
    """The first ``count`` candidates of each of a number of slots, from any number of tiles."""

    def __init__(self, count: int):
        self.count = count
        self.slot, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        slot, ids, scores = np.concatenate([self.slot, slot]), np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, ~scores, slot))
        slot, ids, scores = slot[order], ids[order], scores[order]
        starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
        rank = np.arange(len(slot)) - np.repeat(starts, np.diff(np.append(starts, len(slot))))
        keep = rank < self.count
        self.slot, self.ids, self.scores = slot[keep], ids[keep], scores[keep]


def _positives(anchor, candidate, heaps: Heaps) -> None:
    """Rows of the anchors' own labels, label by label."""
    a_ids, a_labels, a = anchor[:3]
    ids, labels, b = candidate
    for label in np.intersect1d(a_labels, labels):
        mine, theirs = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
        scores = strassen(a[mine], np.ascontiguousarray(b[theirs].T))
        row, column = np.nonzero(firsts(scores, a_ids[mine][:, None] != ids[theirs], heaps.count))
        heaps.add(mine[row], ids[theirs][column], scores[row, column])


def _negatives(anchor, candidate, heaps: Heaps) -> None:
    """Rows of other labels within each window; slot k of anchor r is r * windows + k."""
    _, a_labels, a, lows, highs = anchor
    ids, labels, b = candidate
    scores = strassen(a, np.ascontiguousarray(b.T))
    other = a_labels[:, None] != labels
    for k in range(lows.shape[1]):
        inside = other & (scores >= lows[:, k, None]) & (scores <= highs[:, k, None])
        some = np.flatnonzero(inside.any(axis=1))
        row, column = np.nonzero(firsts(scores[some], inside[some], heaps.count))
        heaps.add(some[row] * lows.shape[1] + k, ids[column], scores[some[row], column])


def _tiles(length: int, count: int, windows: int):
    """Streams (anchor block first, then its candidate blocks) of sorted rows to heaps as rows."""

    def emitted(anchor, heaps: Heaps) -> pa.RecordBatch:
        slot = heaps.slot
        arrays = [anchor[0][slot // max(windows, 1)], slot % max(windows, 1), heaps.ids, heaps.scores]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["anchor_id", "window", "found_id", "found_score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = heaps = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["lows"] is not None:
                    if anchor is not None:
                        yield emitted(anchor, heaps)
                    limits = [np.frombuffer(row[x], np.int64).reshape(-1, max(windows, 1)) for x in ("lows", "highs")] if windows else []
                    anchor, heaps = (*_unpacked(row, length), *limits), Heaps(count)
                elif anchor is not None:
                    (_negatives if windows else _positives)(anchor, _unpacked(row, length), heaps)
        if anchor is not None:
            yield emitted(anchor, heaps)

    return run


def _packed_anchors(anchors: DataFrame, scale: int, length: int, windows: int) -> DataFrame:
    """Anchors in blocks by ``block``; a group holds about a block of different ids, as they were dealt by hash."""
    pack = _packer(scale, length)

    def run(frame: pa.Table) -> pa.Table:
        frame = frame.sort_by("vec_id").combine_chunks()
        (batch,) = frame.to_batches() or [None]
        # One block, however the hash deals; the packer's own limit is for streams.
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        cells = b"".join(one.column(2)[0].as_py() for one in pack(iter([batch.select(["vec_id", "label", "embedding"])])))
        limits = [b"", b""]
        if windows:
            limits = []
            for name in ("lows", "highs"):
                # Windows that an anchor lacks hold nothing: low above high.
                filler = 1 if name == "lows" else 0
                held = [(x or [])[:windows] + [filler] * (windows - len(x or [])) for x in batch.column(name).to_pylist()]
                limits.append(np.array(held, np.int64).tobytes())
        row = {"block": [batch.column("block")[0].as_py()], "ids": [ids.tobytes()], "labels": [labels.tobytes()], "cells": [cells], "lows": limits[:1], "highs": limits[1:]}
        return pa.table(row, schema=pa.schema([("block", pa.int64())] + [(x, pa.binary()) for x in ("ids", "labels", "cells", "lows", "highs")]))

    return anchors.groupBy("block").applyInArrow(run, "block long, ids binary, labels binary, cells binary, lows binary, highs binary")


def _heaped(anchors: DataFrame, blocks: DataFrame, n_anchor_blocks: int, n_blocks: int, tiles) -> DataFrame:
    """Every block of anchors against every block of candidates: the rows of all heaps."""
    groups = max(1, math.ceil(n_blocks / BLOCKS_A_TASK))
    left = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = blocks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_anchor_blocks - 1).cast("long"))).alias("block"),
        "ids", "labels", "cells", F.lit(None).cast("binary").alias("lows"), F.lit(None).cast("binary").alias("highs"),
        F.pmod("number", F.lit(groups)).cast("int").alias("part"),
    )
    dealt = left.unionByName(right).repartition(min(n_anchor_blocks * groups, 20_000), "block", "part")
    streams = dealt.sortWithinPartitions("block", "part", F.col("lows").isNull())
    return streams.mapInArrow(tiles, "anchor_id long, window long, found_id long, found_score long")


def _ranked(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("found_score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 3,
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (and positive_rank).

    The score of two rows is the inner product of floor(scale x) of their components.
    The positives of an anchor are the ``positives`` best other rows of its label; for
    each of them come the ``negatives`` best rows of other labels whose score is
    from half to 95 % of the positive's. Ties go to the smaller id.

    Rows without id, label or vector, or with a null or non-finite component, take
    no part; vectors of different lengths are compared as if filled up with zeros,
    an empty one scores 0 with all. Components beyond what keeps an inner product in
    64 bits (x of 1.4 million at 64 components) count as that bound. Repeated
    rows count as often as they occur; an id that is an anchor in several rows is one
    anchor, by its smallest label and vector, and never its own positive. A table without
    anchors or without partners gives no rows. Other columns are not read.
    """
    rows = embeddings.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col(embedding).cast("array<double>").alias("embedding"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    sizes = rows.agg(F.max(F.size("embedding")), F.count_distinct(F.when(F.col("is_anchor"), F.col("vec_id")))).first()
    length, n_anchors = sizes[0] or 0, sizes[1]
    block_rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(length, 1))))
    n_anchor_blocks = max(1, math.ceil(n_anchors / block_rows))
    smallest = F.min(F.struct("label", "embedding")).alias("row")
    anchors = stored(
        rows.where("is_anchor").groupBy("vec_id").agg(smallest).select("vec_id", "row.*", F.pmod(F.xxhash64("vec_id"), F.lit(n_anchor_blocks)).alias("block")),
        "negatives-anchors",
    )
    pack = _packer(scale, length)
    blocks = rows.select("vec_id", "label", "embedding").mapInArrow(pack, "ids binary, labels binary, cells binary")
    # Blocks are written once: a task that is run again finds the same ones.
    blocks = stored(blocks, "negatives-blocks").withColumn("number", F.xxhash64("ids", "labels"))
    n_blocks = blocks.count()

    packed = _packed_anchors(anchors, scale, length, 0)
    found = _ranked(_heaped(packed, blocks, n_anchor_blocks, n_blocks, _tiles(length, positives, 0)), ["anchor_id"], positives)
    best = stored(
        found.select("anchor_id", F.col("found_id").alias("positive_id"), F.col("found_score").alias("positive_score"), F.col("rank").alias("positive_rank")),
        "negatives-positives",
    )
    # 50 p <= 100 s <= 95 p as whole bounds on s, which cannot overflow.
    exact = F.col("positive_score").cast("decimal(38,0)")
    low = F.ceil(exact / 2).cast("long")
    high = F.floor(exact * 19 / 20).cast("long")
    windows = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("positive_rank", low.alias("low"), high.alias("high")))).alias("w"))
    windows = windows.select(F.col("anchor_id").alias("vec_id"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    packed = _packed_anchors(anchors.join(windows, "vec_id"), scale, length, positives)
    near = _heaped(packed, blocks, n_anchor_blocks, n_blocks, _tiles(length, negatives, positives))
    near = _ranked(near, ["anchor_id", "window"], negatives).withColumn("positive_rank", (F.col("window") + 1).cast("int"))
    return near.join(best, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"),
        "positive_score", F.col("found_score").alias("negative_score"), "positive_rank",
    )
