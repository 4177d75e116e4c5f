"""Near copies by shared shingles: every pair at or above a similarity, none below it.

Texts are sets of hashed word shingles. What SimHashes tell alone comes first: 64-bit fingerprints
that differ in two bits or fewer meet in the inverted index of :mod:`simhash`, which counts their
shared bytes and verifies their bits. The rest is found exactly. Two sets that have ``share`` of their union in
common share an element among their rarest n - ceil(share n) + 1 (the prefix filter
of Chaudhuri, Ganti and Kaushik, "A Primitive Operator for Similarity Joins", 2006), so an
inverted index over those elements misses no pair. How rare an element is says a
sketch of fixed size; any order would do, this one keeps postings short where many
texts share a passage. A posting leaves out what the first index has joined, drops pairs by size and by
the bits of 256-bit SimHashes and hands on a tree of the rest. The edges of both are verified on whole sets, and
what they leave apart inside a family is compared block by block; tasks give out trees, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.shared import stored
from plumbline.llm.simhash import linked, spanning, shingle_hashes, wide_fingerprint

# Counters of the sketch of how common shingles are, and those that one row of it holds.
SKETCH_SLOTS, SKETCH_PART = 1 << 22, 1 << 16
# Bits of 64 in which SimHashes differ that the inverted index over their bytes joins.
INDEXED = 2
# SimHash bits of 256 in which sets that share 0.8 differ: 39, give or take 6; up to 48 give or
# take 6 in sets of a few shingles. Unrelated ones differ in 128, give or take 8.
APART, TIGHT = 96, 26
# Members of a posting that one task compares with as many others.
BLOCK = 2_048
# Sets that one task compares with the same set.
VERIFIED_AT_ONCE = 256
# Shingles of a cell: two cells are compared in one task.
CELL = 400_000
COLUMNS_AT_ONCE, PAIRS_AT_ONCE = 4_096, 1 << 22


def needed(n: int, share: float) -> int:
    """Elements that a set of ``n`` has in common with any set it shares ``share`` of their union with."""
    return max(1, math.ceil(round(share * n, 9)))


def _commonness(rows: DataFrame, size: int) -> np.ndarray:
    """A byte for each slot of the sketch: how often shingles of that slot occur, in eighths of a power of two."""
    import zstandard

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(SKETCH_SLOTS, np.int64)
        for batch in batches:
            held = []
            for text in batch.column(0).to_pylist():
                held.append((shingle_hashes((text or "").encode("utf-8"), size) & np.uint64(SKETCH_SLOTS - 1)).astype(np.int64))
            if held:
                totals += np.bincount(np.concatenate(held), minlength=SKETCH_SLOTS)
        pack = zstandard.ZstdCompressor(level=1).compress
        for k in range(SKETCH_SLOTS // SKETCH_PART):
            part = totals[k * SKETCH_PART : (k + 1) * SKETCH_PART]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(part.tobytes())])], names=["part", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        total = sum(np.frombuffer(unpack(c), np.int64) for c in group["counts"])
        return pd.DataFrame({"part": group["part"].iloc[:1], "counts": [zstandard.ZstdCompressor(level=1).compress(total.tobytes())]})

    filled = rows.mapInArrow(count, "part int, counts binary").withColumn("task", F.pmod(F.spark_partition_id(), F.lit(64)))
    # Merged in two steps, so that no task reads the counters of all others.
    some = filled.groupBy("part", "task").applyInPandas(merge, "part int, counts binary")
    counts = np.zeros(SKETCH_SLOTS, np.int64)
    for row in some.groupBy("part").applyInPandas(merge, "part int, counts binary").collect():
        found = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row["counts"])), np.int64)
        counts[row["part"] * SKETCH_PART : (row["part"] + 1) * SKETCH_PART] = found
    return np.minimum(8 * np.log2(counts + 1), 255).astype(np.uint8)


def _prefix(hashes: np.ndarray, common: np.ndarray, share: float) -> np.ndarray:
    """The rarest elements of a set, as many as it takes to meet every partner."""
    if not len(hashes):
        return hashes
    order = np.lexsort((hashes, common[(hashes & np.uint64(len(common) - 1)).astype(np.int64)]))
    return hashes[order[: len(hashes) - needed(len(hashes), share) + 1]]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by posting, those of postings with two or more, passed on as they come."""
    last, held = None, None
    for batch in batches:
        posting, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(posting):
            continue
        same = posting[1:] == posting[:-1]
        many = np.concatenate([[posting[0] == last], same]) | np.concatenate([same, [False]])
        # The last row of a batch waits until the next shows whether it has company.
        waited = posting[0] == last and held is not None
        first = np.array([held] if waited else [], np.int64)
        last, held = posting[-1], None if many[-1] else int(kind[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([posting[: len(first)], posting[many]])), pa.array(np.concatenate([first, kind[many]]))],
            names=["posting", "kind"],
        )


def _placed(kinds: DataFrame) -> DataFrame:
    """(posting, kind, block, blocks) of every posting in which two or more sets meet."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            if prefixes:
                kind = np.repeat(batch.column(0).to_numpy(), [len(x) for x in prefixes])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(prefixes)), pa.array(kind)], names=["posting", "kind"])

    postings = kinds.select("kind", "prefix").mapInArrow(spread, "posting long, kind long")
    met = postings.repartition("posting").sortWithinPartitions("posting", "kind").mapInArrow(_shared, "posting long, kind long")
    met = stored(met, "similar-met")
    sizes = met.groupBy("posting").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    return met.join(sizes, "posting").withColumn("block", F.pmod(F.xxhash64("kind"), "blocks").cast("int"))


def _indexed(kinds: DataFrame) -> DataFrame:
    """(a, b) edges that span the kinds whose ``bits`` differ in ``INDEXED`` or fewer, by the inverted index over their bytes."""
    named = stored(kinds.groupBy("bits").agg(F.min("kind").alias("least")), "similar-bits")
    ends = linked(named.select(F.col("bits").alias("fp")), INDEXED)
    ends = ends.join(named.toDF("a", "first"), "a").join(named.toDF("b", "second"), "b").select("first", "second")
    equal = kinds.select("bits", "kind").join(named, "bits").where("kind <> least").select("least", "kind")
    return ends.union(equal).select(F.least("first", "second").alias("a"), F.greatest("first", "second").alias("b"))


def _proposed(placed: DataFrame, kinds: DataFrame, share: float) -> DataFrame:
    """(a, b) edges that span, in each posting, the pairs whose sizes and SimHashes allow ``share``.

    Kinds of the same ``group`` are connected already.
    """
    # A posting of any size is cut into blocks, and every pair of blocks is compared on its own.
    each = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    paired = each.select("posting", (F.least("block", "other") * 65536 + F.greatest("block", "other")).alias("pair"), "kind")
    full = paired.join(kinds.select("kind", "fp", "n", "group"), "kind").select("posting", "pair", "kind", "fp", "n", "group")

    def close(kind: np.ndarray, fps: np.ndarray, n: np.ndarray, group: np.ndarray) -> np.ndarray:
        group, least = np.unique(group, return_inverse=True)[1], share * n - 1e-9

        def near(limit: int):
            def at(k: int) -> np.ndarray:
                bits = np.bitwise_count(fps[k : k + 256, None] ^ fps[None, k:]).sum(axis=-1)
                return (bits <= limit) & (n[k : k + 256, None] >= least[None, k:]) & (n[None, k:] >= least[k : k + 256, None])

            return at

        # Close ones first: edges of the tree are then likelier to hold.
        return kind[np.array(spanning(len(kind), near(TIGHT), group) + spanning(len(kind), near(APART), group), np.int64).reshape(-1, 2)]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def settled() -> Iterator[np.ndarray]:
            if sum(len(h[0]) for h in held) > 1:
                yield close(*(np.concatenate(x) for x in zip(*held, strict=True)))

        for batch in batches:
            if not batch.num_rows:
                continue
            posting, pair, kind, n, group = (batch.column(k).to_numpy() for k in (0, 1, 2, 4, 5))
            fps = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u8").reshape(batch.num_rows, -1)
            starts = np.concatenate([[0], np.flatnonzero((posting[1:] != posting[:-1]) | (pair[1:] != pair[:-1])) + 1])
            found = []
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(kind)).tolist(), strict=True):
                if (posting[a], pair[a]) != current:
                    found += settled()
                    current, held = (posting[a], pair[a]), []
                held.append((kind[a:b], fps[a:b], n[a:b], group[a:b]))
            yield _edges(found)
        yield _edges(list(settled()))

    ordered = full.repartition("posting", "pair").sortWithinPartitions("posting", "pair", "kind")
    return ordered.mapInArrow(compare, "a long, b long").distinct()


def _edges(found: list[np.ndarray]) -> pa.RecordBatch:
    both = np.sort(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """The ``pairs`` of kinds that have ``share`` or more of their union in common."""
    # A set with many partners is compared with some at a time, and sent once to each of those tasks.
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(VERIFIED_AT_ONCE)).cast("int").alias("parts"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
    first = many.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    first = first.join(sets, F.col("a") == F.col("kind")).select("a", "part", F.lit(False).alias("other"), F.col("a").alias("b"), "hashes")
    others = dealt.join(sets, F.col("b") == F.col("kind")).select("a", "part", F.lit(True).alias("other"), "b", "hashes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for a, other, b, held in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                hashes = np.frombuffer(held, np.uint64)
                if not other:
                    mine = hashes
                    continue
                both = len(np.intersect1d(mine, hashes, assume_unique=True))
                if both and both >= round(share * (len(mine) + len(hashes) - both), 9):
                    found.append(np.array([[a, b]], np.int64))
            yield _edges(found)

    ordered = first.union(others).repartition("a", "part").sortWithinPartitions("a", "part", "other")
    return ordered.mapInArrow(compare, "a long, b long")


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``one`` has in common with each of ``two``.

    Elements in few sets are counted pair by pair, those in many by a matrix product.
    """
    total = np.zeros(len(one) * len(two), np.int64)
    both = np.intersect1d(np.concatenate(one), np.concatenate(two))
    sides = []
    for sets in (one, two):
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        keep = np.isin(flat, both)
        column = np.searchsorted(both, flat[keep])
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[keep][order]
        sides.append((column, row, np.searchsorted(column, np.arange(len(both) + 1))))
    (c1, r1, s1), (c2, r2, s2) = sides
    n1, n2 = np.diff(s1), np.diff(s2)
    dense = n1 * n2 * 50 > len(total)
    # Few: every entry on the one side with all entries of its element on the other.
    few = np.flatnonzero(~dense[c1])
    ends = np.cumsum(n2[c1[few]])
    for at in range(0, int(ends[-1]) if len(few) else 0, PAIRS_AT_ONCE):
        a, b = np.searchsorted(ends, [at, at + PAIRS_AT_ONCE], side="right")
        # Entries that end in this stretch, and the first that reaches beyond it, are taken whole.
        some = few[a:b]
        n = n2[c1[some]]
        left = np.repeat(r1[some], n)
        right = r2[np.repeat(s2[c1[some]], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)]
        total += np.bincount(left * len(two) + right, minlength=len(total))
    few_done = total.reshape(len(one), len(two))
    many = np.flatnonzero(dense)
    for at in range(0, len(many), COLUMNS_AT_ONCE):
        columns = many[at : at + COLUMNS_AT_ONCE]
        parts = []
        for column, row, size in ((c1, r1, len(one)), (c2, r2, len(two))):
            place = np.searchsorted(columns, column)
            hit = (place < len(columns)) & (columns[np.minimum(place, len(columns) - 1)] == column)
            part = np.zeros((size, len(columns)), np.float32)
            part[row[hit], place[hit]] = 1
            parts.append(part)
        few_done += (parts[0] @ parts[1].T).astype(np.int64)
    return few_done


def _compared(members: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """(a, b) edges that span the links between different groups of each family.

    ``members`` has kind, family, group and n. A family is dealt in cells of a bounded
    number of shingles, a group that fills cells in cells of its own; every two cells are
    compared in one task, but for two of the same group.
    """
    weight = F.sum(F.col("n") + 64)
    solo = members.groupBy("family", "group").agg(weight.alias("w")).where(F.col("w") >= CELL)
    placed = members.join(solo.select("family", "group", F.col("group").alias("own")), ["family", "group"], "left")
    placed = placed.withColumn("own", F.coalesce("own", F.lit(-1).cast("long")))
    cells = placed.groupBy("family", "own").agg(F.ceil(weight / F.lit(CELL)).cast("int").alias("cells"))
    placed = stored(
        placed.join(cells, ["family", "own"]).select(
            "family", "own", F.pmod(F.xxhash64("kind"), "cells").cast("int").alias("cell"), "kind", "group"
        ),
        "similar-cells",
    )
    each = placed.select("family", "own", "cell").distinct()
    other = each.toDF("family", "own2", "cell2")
    ordered = F.struct("own", "cell") <= F.struct("own2", "cell2")
    pairs = each.join(other, "family").where(ordered & ~((F.col("own") == F.col("own2")) & (F.col("own") >= 0)))
    pairs = pairs.withColumn("pair", F.xxhash64("family", "own", "cell", "own2", "cell2"))
    same = (F.col("own") == F.col("own2")) & (F.col("cell") == F.col("cell2"))
    first = pairs.select("family", "own", "cell", "pair", F.lit(0).alias("side"), same.alias("same"))
    second = pairs.where(~same).select("family", F.col("own2").alias("own"), F.col("cell2").alias("cell"), "pair", F.lit(1).alias("side"), F.lit(False).alias("same"))
    rows = first.union(second).join(placed, ["family", "own", "cell"]).join(sets, "kind")
    rows = rows.select("pair", "side", "same", "kind", "group", "hashes").repartition("pair").sortWithinPartitions("pair", "side", "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def close() -> np.ndarray:
            one = [h for h in held if not h[0]]
            two = one if held and held[0][1] else [h for h in held if h[0]]
            if not one or not two:
                return np.zeros((0, 2), np.int64)
            sizes = [np.array([len(h[4]) for h in side]) for side in (one, two)]
            both = overlaps([h[4] for h in one], [h[4] for h in two])
            union = sizes[0][:, None] + sizes[1] - both
            hit = (both > 0) & (both >= np.round(share * union, 9))
            kind = np.array([h[2] for h in one + two], np.int64)
            _, group = np.unique([h[3] for h in one + two], return_inverse=True)
            whole = np.zeros((len(kind), len(kind)), bool)
            whole[: len(one), len(one) :] = hit
            return kind[np.array(spanning(len(kind), lambda at: whole[at : at + 256, at:], group), np.int64).reshape(-1, 2)]

        for batch in batches:
            found = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if row[0] != current:
                    found.append(close())
                    current, held = row[0], []
                held.append((*row[1:5], np.frombuffer(row[5], np.uint64)))
            yield _edges(found)
        yield _edges([close()])

    return rows.mapInArrow(compare, "a long, b long").where("a <> b").distinct()


def near_sets(kinds: DataFrame, sets_of, share: float) -> DataFrame:
    """(node, component) of all ``kinds`` (kind, n, bits, fp, prefix) that share ``share`` with another, directly or not.

    ``sets_of`` gives (kind, hashes) of the kinds of a DataFrame: all elements, as sorted 64-bit numbers.
    """
    indexed = stored(_indexed(kinds), "similar-indexed")
    near = components(indexed, "similar").toDF("kind", "near")
    tied = kinds.select("kind", "fp", "n").join(near, "kind", "left").select("kind", "fp", "n", F.coalesce("near", "kind").alias("group"))
    # Edges of either kind only connect; a family in which one fails is compared whole below.
    proposed = stored(_proposed(_placed(kinds), tied, share).union(indexed).distinct(), "similar-proposed")
    families = stored(components(proposed, "similar").toDF("kind", "family"), "similar-families")
    sets = stored(sets_of(families.select("kind")), "similar-sets")
    good = stored(_verified(proposed, sets, share), "similar-good")
    grouped = components(good, "similar").toDF("kind", "group")
    members = families.join(grouped, "kind", "left").join(kinds.select("kind", "n"), "kind")
    members = stored(members.select("kind", "family", F.coalesce("group", "kind").alias("group"), "n"), "similar-members")
    # Where a proposed pair failed, any other pair of the two sides may hold.
    parted = members.groupBy("family").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("size"))
    parted = parted.where("low <> high AND size > 2").select("family")
    left = _compared(members.join(parted, "family", "left_semi"), sets, share)
    return components(good.union(left), "similar")


def one_of_each(documents: DataFrame, size: int = 5, share: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` without near copies: of each group the smallest id stays.

    Near copies have ``share`` or more of their different ``size``-word shingles in
    common. SimHashes that differ in ``INDEXED`` bits or fewer find each other first, the prefix index finds
    the rest, and both are verified on the shingles; all such pairs are found, but for the one in millions whose
    256-bit SimHashes differ in more than ``APART`` bits, and nothing below is linked. Texts without words are one group. Rows of one id
    stay or go together, equal texts among them once; rows without an id are not
    judged and stay. An empty table gives no rows; all columns are kept.
    """
    named = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    named = named.where("doc_id is not null").withColumn("print", F.xxhash64("text"))
    common = documents.sparkSession.sparkContext.broadcast(_commonness(named.select("text"), size))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, bits, sets, counts, prefixes = [], [], [], [], []
            for t in batch.column(1).to_pylist():
                hashes = shingle_hashes((t or "").encode("utf-8"), size)
                fps.append(wide_fingerprint(hashes))
                bits.append(int.from_bytes(fps[-1][:8], "little", signed=True))
                sets.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                counts.append(len(hashes))
                prefixes.append(_prefix(hashes, common.value, share).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(fps, pa.binary()), pa.array(bits, pa.int64()),
                    pa.array(sets, pa.binary()), pa.array(counts, pa.int64()), pa.array(prefixes, pa.binary()),
                ],
                names=["doc_id", "print", "fp", "bits", "shingles", "n", "prefix"],
            )

    rows = stored(named.mapInArrow(prints, "doc_id long, print long, fp binary, bits long, shingles binary, n long, prefix binary"), "similar-rows")
    # Texts of the same shingles are one kind from the start; the rest of its columns follow from its set.
    least = rows.groupBy("shingles").agg(F.min(F.struct("doc_id", "print")).alias("who")).select("shingles", "who.*")
    kinds = rows.join(least, ["shingles", "doc_id", "print"], "left_semi").dropDuplicates(["shingles"])
    kinds = stored(kinds.withColumn("kind", F.monotonically_increasing_id()), "similar-kinds")

    def sets_of(some: DataFrame) -> DataFrame:
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingle_hashes((t or "").encode("utf-8"), size).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["kind", "hashes"])

        wanted = kinds.join(some, "kind").select("kind", "doc_id", "print")
        texts = named.join(wanted, ["doc_id", "print"]).select("kind", "text")
        # Repeated rows of one id and text give their set once.
        return texts.mapInArrow(hashed, "kind long, hashes binary").dropDuplicates(["kind"])

    reached = near_sets(kinds, sets_of, share)
    members = kinds.join(reached, F.col("kind") == F.col("node"), "left").select("doc_id", F.coalesce("component", "kind").alias("component"))
    winners = members.groupBy("component").agg(F.min("doc_id").alias("_winner")).select("_winner").distinct()
    counts = rows.groupBy("doc_id").agg((F.count("*") > 1).alias("_several"))
    staying = winners.join(counts, F.col("_winner") == F.col("doc_id")).select("_winner", "_several")
    kept = documents.where(F.col(f"`{doc_id}`").isNotNull()).join(staying, F.col(f"`{doc_id}`").cast("long") == F.col("_winner"))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    single = kept.where(~F.col("_several")).select(columns)
    several = kept.where("_several").dropDuplicates([doc_id, text]).select(columns)
    return single.union(several).union(documents.where(F.col(f"`{doc_id}`").isNull()).select(columns))
