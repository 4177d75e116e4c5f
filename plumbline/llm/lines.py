"""Repeated lines, found with two Bloom filters.

A first pass sets the bits of every line's hash in a filter of what was seen once;
what finds its bits set already goes into a filter of what was seen twice. Tasks
fill filters of their own, and these merge without order: once is the union, twice
is the union of the twos and of what both halves had once. No repeated line can
escape, some lines are suspected wrongly. Only suspected lines are shuffled, as
16-byte digests, to be confirmed exactly and to choose the first document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import stored

# Bits of each filter: 8 MB, which is all that is ever broadcast. Beyond about
# 15 million different lines more and more lines are suspected and shuffled;
# results stay the same at any load. A larger cluster takes a larger power of two.
FILTER_BITS = 1 << 26
SEGMENT_BYTES = 1 << 16
PROBES = 2
MIN_CODE_POINTS = 10
BLANK = b" \t\n\x0b\x0c\r"


def keys_of(text: str, least: int) -> list[bytes | None]:
    """The key of each line, None for lines too short to be judged."""
    found = []
    for line in (text or "").encode("utf-8").split(b"\n"):
        key = line.strip(BLANK).lower()
        long_enough = len(key) >= 4 * least or len(key) >= least and len(key.decode("utf-8")) >= least
        found.append(key if long_enough else None)
    return found


def digests(text: str, least: int) -> list[bytes | None]:
    from xxhash import xxh3_128_digest

    return [None if key is None else xxh3_128_digest(key) for key in keys_of(text, least)]


def _probes(found: list[bytes], bits: int) -> np.ndarray:
    """Bit numbers of each digest, a row for each probe."""
    halves = np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)
    return (halves & np.uint64(bits - 1)).T.astype(np.int64)[:PROBES]


def _twice_filter(rows: DataFrame, bits: int, least: int) -> bytes:
    """The filter of lines seen in two rows or more, merged over all tasks."""
    import zstandard

    size = min(SEGMENT_BYTES, bits // 8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        for batch in batches:
            found = [d for text in batch.column(1).to_pylist() for d in set(digests(text, least)) if d is not None]
            if not found:
                continue
            probes = _probes(found, bits)
            order = np.lexsort(probes)
            same = (probes[:, order[1:]] == probes[:, order[:-1]]).all(axis=0)
            seen = once[probes].all(axis=0)
            seen[order[1:][same]] = True
            twice[probes[:, seen]] = True
            once[probes] = True
        pack = zstandard.ZstdCompressor(level=1).compress
        bytes_once, bytes_twice = np.packbits(once), np.packbits(twice)
        del once, twice
        for k in range(bits // 8 // size):
            a, b = bytes_once[k * size : (k + 1) * size], bytes_twice[k * size : (k + 1) * size]
            if a.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([pack(a.tobytes())]), pa.array([pack(b.tobytes())])],
                    names=["segment", "once", "twice"],
                )

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for a, b in zip(group["once"], group["twice"], strict=True):
            a, b = np.frombuffer(unpack(a), np.uint8), np.frombuffer(unpack(b), np.uint8)
            twice |= b | once & a
            once |= a
        pack = zstandard.ZstdCompressor(level=1).compress
        return pd.DataFrame({"segment": group["segment"].iloc[:1], "once": [pack(once.tobytes())], "twice": [pack(twice.tobytes())]})

    ddl = "segment int, once binary, twice binary"
    filled = rows.mapInArrow(fill, ddl)
    # Merged in two steps, so that no task reads the filters of all others.
    part = F.pmod(F.spark_partition_id(), F.lit(64)).alias("part")
    some = filled.select("*", part).groupBy("segment", "part").applyInPandas(merge, ddl)
    whole = some.groupBy("segment").applyInPandas(merge, ddl).select("segment", "twice")
    twice = np.zeros(bits // 8, np.uint8)
    for row in whole.collect():
        at = row["segment"] * size
        twice[at : at + size] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row["twice"])), np.uint8)
    return twice.tobytes()


def drop_repeated(
    documents: DataFrame,
    least: int = MIN_CODE_POINTS,
    filter_bits: int = FILTER_BITS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text that stays) of every row.

    A line whose key (stripped of ASCII white space, A-Z lower-cased, ``least`` code
    points or more) stands in two documents or more stays only in the one with the smallest id,
    there as often as it was. A null or empty text is one empty line. Rows that
    share an id are one document; rows without an id neither lose lines nor take
    them from others. An empty table gives no rows; other columns are not read.
    """
    if filter_bits & (filter_bits - 1) or filter_bits < 64:
        raise ValueError("filter_bits must be a power of two, 64 at least")
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    named = rows.where("doc_id is not null")
    twice = rows.sparkSession.sparkContext.broadcast(_twice_filter(named, filter_bits, least))

    def suspected(texts: list[str]) -> tuple[list[int], list[bytes]]:
        """(row, digest) of the lines that the filter has twice, each once a row."""
        at, found = [], []
        for k, value in enumerate(texts):
            mine = [d for d in set(digests(value, least)) if d is not None]
            at += [k] * len(mine)
            found += mine
        if not found:
            return [], []
        bits, probes = np.frombuffer(twice.value, np.uint8), _probes(found, filter_bits)
        hit = ((bits[probes >> 3] >> (7 - (probes & 7)).astype(np.uint8)) & 1).all(axis=0)
        hits = np.flatnonzero(hit).tolist()
        return [at[k] for k in hits], [found[k] for k in hits]

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = suspected(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.binary())], names=["doc_id", "line"]
            )

    def those(with_suspects: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chosen = np.full(batch.num_rows, not with_suspects)
                chosen[suspected(batch.column(1).to_pylist())[0]] = with_suspects
                yield batch.filter(pa.array(chosen))

        return rows.mapInArrow(run, "doc_id long, text string")

    seen = stored(named.mapInArrow(suspects, "doc_id long, line binary"), "lines-suspected")
    first = seen.groupBy("line").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("final")).where("first < final")
    losing = seen.join(first.select("line", "first"), "line").where("doc_id > first")
    losses = losing.groupBy("doc_id").agg(F.collect_set("line").alias("lost"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for value, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = value.split("\n")
                stay = lines
                if lost:
                    gone = set(lost)
                    stay = [line for line, d in zip(lines, digests(value, least), strict=True) if d not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append("\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept"],
            )

    # Only texts with a suspected line are shuffled to meet their losses.
    met = those(True).join(losses, "doc_id", "left").select("doc_id", "text", "lost")
    met = met.union(those(False).select("doc_id", "text", F.lit(None).cast("array<binary>").alias("lost")))
    return met.mapInArrow(keep, "doc_id long, n_lines long, n_dropped long, kept string")
