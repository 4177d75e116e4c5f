"""Near-duplicate vectors by iterative quantisation and multi-index hashing.

Rotations learned on a bounded sample turn vectors into balanced binary codes, two
of 64 bits for each vector. A code is cut into substrings, each with its own table, keyed by the substring
with one bit left out in turn, so vectors that differ in at most one bit of any
substring meet. Meetings are found on codes alone; only blocks of buckets in which two
codes are close receive the vectors, and rank them by cosine. A pair that meets
in several buckets counts in the first of them only, so no pair is ever written
out: a bucket gives link counts, and a tree of edges for the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.shared import stored

# The rotation is fitted on so many different vectors, chosen by their hash; all are indexed.
FIT_VECTORS, ROUNDS = 20_000, 50
# Substrings of a code: 64 bits in 4 tables of 16 bits. Longer ones lose pairs.
TABLES = 4
# Codes by rotations of their own: who meets in neither is not found.
CODES = 2
# Vectors whose codes are further apart than this are not ranked by cosine. At a cosine of
# 0.9 they differ in 18 of 128 bits, give or take 4; unrelated ones in 64.
CODE_BITS_APART = 38
# Buckets up to this size are compared all at once, neighbour by neighbour.
SMALL_BUCKET = 64
# Members of a bucket that one task compares with as many others.
BLOCK = 2_048


def fit_rotation(x: np.ndarray, rounds: int = ROUNDS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): principal axes, turned so that their signs lose least."""
    bits = min(64, x.shape[1])
    mean = x.mean(axis=0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    axes = axes[:bits].T
    if axes.shape[1] < bits:
        axes = np.hstack([axes, np.zeros((x.shape[1], bits - axes.shape[1]))])
    projected = (x - mean) @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds):
        signs = np.where(projected @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        turn = right.T @ left.T
    return mean, axes @ turn


def fit_codes(x: np.ndarray, codes: int = CODES) -> tuple[np.ndarray, list[np.ndarray]]:
    """(mean, projections): 64 columns for each code, from as many rotations as short vectors take."""
    mean, first = fit_rotation(x)
    columns, seed = [first], 1
    while sum(c.shape[1] for c in columns) < 64 * codes:
        seed += 1
        columns.append(fit_rotation(x, seed=seed)[1])
    wide = np.hstack(columns)
    return mean, [wide[:, 64 * k : 64 * k + 64] for k in range(codes)]


def codes_of(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bits = (x - mean) @ projection >= 0
    if bits.shape[1] < 64:
        bits = np.hstack([bits, np.zeros((len(bits), 64 - bits.shape[1]), bool)])
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]


def bucket_keys(code: np.ndarray, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, value) arrays of a row for each code: every substring with every one of its bits left out."""
    width = 64 // tables
    slots, values = [], []
    for t in range(tables):
        part = code >> np.uint64(t * width) & np.uint64((1 << width) - 1)
        for bit in range(width):
            slots.append(t * width + bit)
            values.append(part & ~np.uint64(1 << bit))
    return np.array(slots, np.int32), np.stack(values, axis=1).view(np.int64)


def first_meeting(differ: np.ndarray, tables: int) -> np.ndarray:
    """The first slot at which codes with these differing bits meet, -1 if nowhere."""
    width = 64 // tables
    first = np.full(differ.shape, -1, np.int32)
    for t in reversed(range(tables)):
        part = differ >> np.uint64(t * width) & np.uint64((1 << width) - 1)
        n = np.bitwise_count(part)
        first[n == 0] = t * width
        one = n == 1
        first[one] = t * width + np.bitwise_count(part[one] - np.uint64(1))
    return first


def met_at(first: np.ndarray, second: np.ndarray, tables: int) -> np.ndarray:
    """The slot at which vectors count whose two codes differ in these bits, -1 for none or if they are far apart."""
    one, two = first_meeting(first, tables), first_meeting(second, tables)
    slot = np.where(one >= 0, one, np.where(two >= 0, two + 64, -1))
    apart = np.bitwise_count(first).astype(np.int32) + np.bitwise_count(second)
    return np.where(apart <= CODE_BITS_APART, slot, -1)


def _tree(left: list[int], right: list[int], parent: dict[int, int], edges: list[tuple[int, int]]) -> None:
    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(left, right, strict=True):
        x, y = top(a), top(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            edges.append((a, b))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.9,
    tables: int = TABLES,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Pairs with a cosine of ``threshold`` or more in double precision are linked
    where the index finds them; none below it is. A vector that is null, empty, zero, or
    holds a null or non-finite component links with nothing, nor do vectors of different
    lengths with each other. Equal vectors are one entry of the index that counts as many
    times as it occurs, and always find each other. Rows that share an id are separate
    vectors; rows without an id get null for component_id and kept, unless linked to one with
    an id. An empty table gives no rows; other columns are not read.
    """
    spark = embeddings.sparkSession
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    whole = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce((F.size("v") > 0) & whole & F.exists(F.col("v"), lambda x: x != 0), F.lit(False))
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).withColumn("sound", sound)
    # -0.0 and 0.0 are the same number.
    rows = rows.withColumn("v", F.when(F.col("sound"), F.transform("v", lambda x: x + F.lit(0.0))))
    rows = stored(rows.withColumn("key", F.when(F.col("sound"), F.sha2(F.to_json(F.struct("v")), 256))), "vectors")
    kinds = rows.where("sound").groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("v").alias("v"))
    # Numbered, so that edges and counts carry eight bytes.
    kinds = stored(kinds.withColumn("kind", F.monotonically_increasing_id()), "vectors-distinct")
    lengths = [row["d"] for row in kinds.select(F.size("v").alias("d")).distinct().collect()]
    links, edges = None, None
    for d in sorted(lengths):
        some_links, some_edges = _linked(kinds.where(F.size("v") == d), threshold, tables)
        links = some_links if links is None else links.union(some_links)
        edges = some_edges if edges is None else edges.union(some_edges)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    reached = components(edges, "vectors")
    members = reached.join(kinds.select("kind", "least"), F.col("node") == F.col("kind")).select("kind", "component", "least")
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = members.join(smallest, "component").select("kind", "component_id")
    counted = links.groupBy("kind").agg(F.sum("n").alias("others"))
    named = kinds.select("kind", "key", "least", "n").join(moved, "kind", "left").join(counted, "kind", "left")
    named = named.select(
        "key", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")
    )
    joined = rows.select("vec_id", "key").where("key is not null").join(named, "key").select("vec_id", "n_links", "component_id")
    apart = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(apart).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _linked(kinds: DataFrame, threshold: float, tables: int) -> tuple[DataFrame, DataFrame]:
    """(kind, n) partial link counts and (a, b) edges among different vectors of one length."""
    spark = kinds.sparkSession
    sample = kinds.orderBy("key").limit(FIT_VECTORS).select("v").toPandas()["v"]
    x = np.array([np.asarray(v, float) for v in sample])
    model = spark.sparkContext.broadcast(fit_codes(x / np.linalg.norm(x, axis=1)[:, None]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, projections = model.value
        for batch in batches:
            vectors = _matrix(batch.column(1))
            unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
            codes = [codes_of(unit, mean, p) if len(vectors) else np.zeros(0, np.uint64) for p in projections]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c.view(np.int64), pa.int64()) for c in codes)], names=["kind", "code", "code2"]
            )

    coded = stored(kinds.select("kind", "v").mapInArrow(encode, "kind long, code long, code2 long"), "vectors-coded")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, code, code2 = (batch.column(k).to_numpy() for k in range(3))
            for number, part in enumerate((code, code2)):
                slots, values = bucket_keys(part.view(np.uint64), tables)
                k = len(slots)
                columns = [np.tile(slots + np.int32(64 * number), len(kind)), values.reshape(-1), *(np.repeat(c, k) for c in (kind, code, code2))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "value", "kind", "code", "code2"])

    meetings = coded.mapInArrow(spread, "slot int, value long, kind long, code long, code2 long")
    # A bucket of any size is cut into blocks, and every pair of blocks is a task of its own.
    large = meetings.groupBy("slot", "value").count().where(F.col("count") > BLOCK)
    large = stored(large.select("slot", "value", F.ceil(F.col("count") / F.lit(BLOCK)).cast("int").alias("blocks")), "vectors-large")
    placed = meetings.join(large, ["slot", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("kind"), "blocks").cast("int"))
    each = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = ["slot", "value", "low", "high", "block", "kind", "code", "code2"]
    each = each.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).select(columns)

    def close_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of block pairs of which some two codes are close and meet for the first time."""
        current, held = None, []

        def settled() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks() if held else []
            if len(rows) < 2:
                return
            block, code, code2 = rows["block"].to_numpy(), *(rows[c].to_numpy().view(np.uint64) for c in ("code", "code2"))
            slot, _, low, high = current
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            near = np.zeros(len(rows), bool)
            for at in range(0, len(left), 512):
                some = left[at : at + 512]
                hit = met_at(code[some, None] ^ code[None, right], code2[some, None] ^ code2[None, right], tables) == slot
                hit &= some[:, None] != right[None, :]
                near[some] |= hit.any(axis=1)
                near[right] |= hit.any(axis=0)
            yield from rows.filter(pa.array(near)).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            slot, value, low, high, _, _, code, code2 = (batch.column(k).to_numpy() for k in range(8))
            changes = (slot[1:] != slot[:-1]) | (value[1:] != value[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            starts = np.concatenate([[0], np.flatnonzero(changes) + 1])
            ends = np.append(starts[1:], len(slot))
            size = ends - starts
            inner = low[starts] == high[starts]
            inner[:1] = inner[-1:] = False
            small = inner & (size <= SMALL_BUCKET)
            bucket = np.repeat(np.where(small, np.arange(len(starts)), -1), size)
            near = np.zeros(len(slot), bool)
            bits, bits2 = code.view(np.uint64), code2.view(np.uint64)
            for lag in range(1, int(size[small].max()) if small.any() else 0):
                at = np.flatnonzero((bucket[:-lag] >= 0) & (bucket[:-lag] == bucket[lag:]))
                hit = at[met_at(bits[at] ^ bits[at + lag], bits2[at] ^ bits2[at + lag], tables) == slot[at]]
                near[hit] = near[hit + lag] = True
            yield batch.filter(pa.array(near))
            for k in np.flatnonzero(~small).tolist():
                a, b = int(starts[k]), int(ends[k])
                if (key := (slot[a], value[a], low[a], high[a])) != current:
                    yield from settled()
                    current, held = key, []
                held.append(batch.slice(a, b - a))
        yield from settled()

    ddl = "slot int, value long, low int, high int, block int, kind long, code long, code2 long"
    ordered = each.repartition("slot", "value", "low", "high").sortWithinPartitions("slot", "value", "low", "high", "kind")
    close = stored(ordered.mapInArrow(close_ones, ddl), "vectors-close")
    # Vectors join the blocks they are needed in, once for each.
    full = close.join(kinds.select("kind", "n", "v"), "kind")

    def rank(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        slot, low, high = int(key[0]), int(key[2]), int(key[3])
        group = group.sort_values("kind")
        vectors = np.array([np.asarray(v, float) for v in group["v"]])
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
        code, code2 = (group[c].to_numpy().view(np.uint64) for c in ("code", "code2"))
        kind, n = group["kind"].to_numpy(), group["n"].to_numpy()
        block = group["block"].to_numpy()
        left, right = (np.flatnonzero(block == low), np.flatnonzero(block == high))
        counts = np.zeros(len(group), np.int64)
        parent, edges = {}, []
        for at in range(0, len(left), 512):
            some = left[at : at + 512]
            hit = met_at(code[some, None] ^ code[None, right], code2[some, None] ^ code2[None, right], tables) == slot
            hit &= vectors[some] @ vectors[right].T >= threshold
            if low == high:
                hit &= some[:, None] < right[None, :]
            counts[some] += hit @ n[right]
            counts[right] += hit.T @ n[some]
            a, b = np.nonzero(hit)
            _tree(kind[some[a]].tolist(), kind[right[b]].tolist(), parent, edges)
        linked = counts > 0
        return pd.DataFrame(
            {
                "a": np.concatenate([kind[linked], np.array([e[0] for e in edges], np.int64)]),
                "b": np.concatenate([kind[linked], np.array([e[1] for e in edges], np.int64)]),
                "n": np.concatenate([counts[linked], np.zeros(len(edges), np.int64)]),
            }
        )

    ranked = stored(full.groupBy("slot", "value", "low", "high").applyInPandas(rank, "a long, b long, n long"), "vectors-ranked")
    return ranked.where("a = b").select(F.col("a").alias("kind"), "n"), ranked.where("a <> b").select("a", "b")
