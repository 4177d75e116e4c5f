"""Near copies by SimHash, through an inverted index over the bytes of fingerprints.

Two fingerprints that differ in at most two bits differ in at most two of their
eight bytes, so they share the bytes at six positions or more. Postings of one
byte would hold a 256th of all documents each, and their pairs would grow with
the square of the corpus. The index is therefore keyed by six positions and
their bytes, 28 keys a fingerprint: whoever reaches the guaranteed count of six
shared bytes stands in one posting together. As fingerprints are made distinct
first and a posting leaves two bytes open, it can never hold more than 65,536 of
them, however many copies there are. Inside a posting the shared bytes of each
pair are counted, those with six or more verified by the bits that differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.shared import stored

BYTES = 8
# The wide fingerprints of :func:`wide_fingerprint`: 256 bits.
LANES = 4
SHINGLES_AT_ONCE = 65_536


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of a UTF-8 text, repeats counted; 0 without words."""
    from xxhash import xxh64_intdigest

    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= size:
        return xxh64_intdigest(line, seed)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[size - 1 :].tolist()
    ones, n = np.zeros(64, np.int64), len(ends)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = [
            xxh64_intdigest(line[a:b], seed)
            for a, b in zip(starts[at : at + SHINGLES_AT_ONCE], ends[at : at + SHINGLES_AT_ONCE])
        ]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, size: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row, fp as a signed long; null text counts as empty. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint((t or "").encode("utf-8"), size) for t in batch.column(1).to_pylist()]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["doc_id", "fp"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _posting_keys(fp: Column, differing: int) -> Column:
    """One key for each choice of the positions that must agree: its number and their bytes."""
    keys = []
    for number, open_positions in enumerate(combinations(range(BYTES), differing)):
        mask = sum(0xFF << 8 * p for p in range(BYTES) if p not in open_positions)
        keys.append(F.struct(F.lit(number).alias("slot"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bytes")))
    return F.array(*keys)


def spanning(n: int, near, group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that connect what is linked among ``n`` rows: a tree, not every pair.

    ``near(at)`` says which of the rows from ``at`` on (columns) are near the next 256 (rows).
    ``group`` holds what is connected already, and takes what becomes so.
    """
    group, edges = np.arange(n) if group is None else group, []
    for at in range(0, n, 256):
        hit = near(at)
        hit &= np.arange(hit.shape[1])[None, :] > np.arange(hit.shape[0])[:, None]
        for row in np.flatnonzero(hit.any(axis=1)).tolist():
            to, a = np.flatnonzero(hit[row]) + at, at + row
            to = to[group[to] != group[a]]
            if len(to):
                joined, first = np.unique(group[to], return_index=True)
                edges += [(a, b) for b in to[first].tolist()]
                joined = np.append(joined, group[a])
                group[np.isin(group, joined)] = joined.min()
    return edges


def _links_within(values: np.ndarray, differing: int) -> list[tuple[int, int]]:
    """Edges that connect what is linked inside one posting."""

    def near(at: int) -> np.ndarray:
        differ = values[at : at + 256, None] ^ values[None, at:]
        shared = (differ.view(np.uint8).reshape(*differ.shape, BYTES) == 0).sum(axis=2)
        return (shared >= BYTES - differing) & (np.bitwise_count(differ) <= differing)

    return spanning(len(values), near)


def linked(distinct: DataFrame, differing: int = 2) -> DataFrame:
    """(a, b) edges between the distinct fingerprints ``fp`` that span all links at ``differing`` bits or fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_slot, held_bytes, held = None, None, []

        def close() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            values = np.array(held, np.int64).view(np.uint64)
            return [(held[a], held[b]) for a, b in _links_within(values, differing)]

        for batch in batches:
            slot, key, fp = (batch.column(k).to_numpy() for k in range(3))
            cuts = np.flatnonzero((slot[1:] != slot[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], cuts]) if len(fp) else np.zeros(0, int)
            ends = np.append(starts[1:], len(fp))
            found = []
            # Postings of one fingerprint in the middle of a batch have nothing to say.
            edge = np.zeros(len(starts), bool)
            edge[:1] = edge[-1:] = True
            for k in np.flatnonzero(edge | (ends - starts > 1)).tolist():
                a, b = int(starts[k]), int(ends[k])
                if (slot[a], key[a]) == (held_slot, held_bytes):
                    held.extend(fp[a:b].tolist())
                else:
                    found += close()
                    held_slot, held_bytes, held = slot[a], key[a], fp[a:b].tolist()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
        if found := close():
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    postings = distinct.select("fp", F.explode(_posting_keys(F.col("fp"), differing)).alias("key")).select("key.slot", "key.bytes", "fp")
    dealt = postings.repartition("slot", "bytes").sortWithinPartitions("slot", "bytes", "fp")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_copies(documents: DataFrame, size: int = 3, differing: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    component_id is the smallest doc_id reachable over fingerprints that differ
    in at most ``differing`` bits. Equal fingerprints are one vertex from the
    start. Texts without words have fingerprint zero and link like any other. A
    row without an id keeps a null id and does not lend it to its component,
    which is null only if no member has an id. Repeated rows stay; an empty
    table gives no rows; other columns are not read.
    """
    rows = stored(fingerprints(documents, size, doc_id, text), "simhash")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    grouped = components(linked(distinct, differing), "simhash")
    # The smallest id of a component, then of each of its fingerprints.
    members = grouped.join(distinct, F.col("node") == F.col("fp")).select("fp", "component", "least")
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = members.join(smallest, "component").select("fp", "component_id")
    named = distinct.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Another hash from each hash, for a lane of its own."""
    if not lane:
        return hashes
    x = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """Hashes of the different word shingles of a text, in order; none without words."""
    from xxhash import xxh64_intdigest

    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths).tolist(), ends[min(size, len(found)) - 1 :].tolist()
    return np.unique(np.fromiter((xxh64_intdigest(line[a:b]) for a, b in zip(starts, ends)), np.uint64, len(ends)))


def wide_fingerprint(hashes: np.ndarray, lanes: int = LANES) -> bytes:
    """Several SimHashes of different shingles, in a row; zeros without shingles."""
    parts = []
    for lane in range(lanes):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), SHINGLES_AT_ONCE):
            some = _mixed(hashes[at : at + SHINGLES_AT_ONCE], lane)
            ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        parts.append(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes())
    return b"".join(parts)
