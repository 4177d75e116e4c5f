"""Token ids on disk as compressed byte or bit planes.

The table in a folder has one row per segment, a run of whole documents in
order: their ids and lengths, and the id stream in blocks of a fixed size. Each
block is transposed into planes (the first bytes of all its ids, then the second
ones, or single bits), each plane is compressed alone with zstandard, and
``index`` lists the compressed length of every plane of every block, so that a
range of ids can be read without the rest. Spark commits the files, so a lost
executor leaves no half shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.tokens import Encoder

BLOCK_IDS = 65_536
SEGMENT_IDS = 1 << 20
# Characters of text that are encoded at once, in whole documents: enough that most words occur in them repeatedly.
ENCODED_AT_ONCE = 8 << 20
PLANES = {"byte": 4, "bit": 32}

SEGMENT = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("kind", pa.string()),
        ("block_ids", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("index", pa.list_(pa.int32())),
        ("payload", pa.binary()),
    ]
)
SEGMENT_DDL = (
    "shard int, segment int, first_id long, n_ids long, kind string, block_ids int, "
    "doc_ids array<long>, lengths array<long>, index array<int>, payload binary"
)


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, least significant first."""
    if kind == "byte":
        return [plane.tobytes() for plane in ids.astype("<u4").view(np.uint8).reshape(-1, 4).T]
    return [np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        return np.ascontiguousarray(np.array([np.frombuffer(p, np.uint8) for p in planes]).T).view("<u4").reshape(-1)
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype(np.uint32) << np.uint32(k)
    return ids


def pack(ids: np.ndarray, kind: str, block_ids: int) -> tuple[list[int], bytes]:
    """(length of each compressed plane, all of them joined)."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=1).compress
    parts = [
        compress(plane) for at in range(0, len(ids), block_ids) for plane in to_planes(ids[at : at + block_ids], kind)
    ]
    return [len(p) for p in parts], b"".join(parts)


def unpack(segment: dict, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a segment; only the blocks they lie in are decompressed."""
    import zstandard

    decompress = zstandard.ZstdDecompressor().decompress
    n, size, kind, index = segment["n_ids"], segment["block_ids"], segment["kind"], segment["index"]
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    ends, found = [0, *accumulate(index)], []
    for block in range(start // size, (stop - 1) // size + 1):
        at = block * PLANES[kind]
        planes = [decompress(segment["payload"][ends[k] : ends[k + 1]]) for k in range(at, at + PLANES[kind])]
        found.append(from_planes(planes, min(size, n - block * size), kind))
    skip = start // size * size
    return np.concatenate(found)[start - skip : stop - skip]


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _gathered(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[tuple[list, list[str]]]:
    """(keys, texts) of as many rows as it takes to hold ``at_once`` characters."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                keys.append(key)
                texts.append(text)
                held += len(text)
                if held >= at_once:
                    yield keys, texts
                    keys, texts, held = [], [], 0
    if keys:
        yield keys, texts


def write_ids(
    documents: DataFrame,
    folder: str,
    path: str,
    end_id: int = 0,
    kind: str = "byte",
    block_ids: int = BLOCK_IDS,
    segment_ids: int = SEGMENT_IDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending doc_id order.

    One range shuffle by (doc_id, hash of the text), so that rows which share an
    id, or have none, do not lie in one task; those without an id come first,
    rows of one id by the text's hash. A null or empty text is the end id alone.
    An empty table gives a folder without segments. Other columns are not read.
    """
    schema = SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, held = [], [], 0
        end = int(end_id).to_bytes(4, "little")

        def full() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            index, payload = pack(ids, kind, block_ids)
            lengths = [len(p) // 4 for p in parts]
            row = [shard, segment, first, len(ids), kind, block_ids, doc_ids, lengths, index, payload]
            return pa.RecordBatch.from_arrays(
                [pa.array([value], field.type) for value, field in zip(row, schema, strict=True)], schema=schema
            )

        for keys, texts in _gathered(batches, ENCODED_AT_ONCE):
            for key, ids in zip(keys, _encoder(path).ids(texts), strict=True):
                doc_ids.append(key)
                parts.append(ids + end)
                held += len(parts[-1]) // 4
                if held >= segment_ids:
                    yield full()
                    segment, first = segment + 1, first + held
                    doc_ids, parts, held = [], [], 0
        if parts:
            yield full()

    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(run, SEGMENT_DDL).write.option("compression", "uncompressed").parquet(folder)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENT_DDL).parquet(folder)


def shard_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """Ids before each shard. One number per output file comes to the driver."""
    totals = segments(spark, folder).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    counts = sorted((row["shard"], row["n"]) for row in totals)
    return dict(zip((shard for shard, _ in counts), accumulate((n for _, n in counts), initial=0), strict=False))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if wanted, ids of every document in the files."""
    starts = spark.sparkContext.broadcast(shard_starts(spark, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment = batch.slice(row, 1).to_pylist()[0]
                raw = memoryview(unpack(segment).astype("<u4").tobytes())
                lengths = segment["lengths"]
                ends = [0, *accumulate(lengths)]
                before = starts.value[segment["shard"]] + segment["first_id"]
                columns = [
                    pa.array(segment["doc_ids"], pa.int64()),
                    pa.array([before + at for at in ends[:-1]], pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    values = pa.array(np.frombuffer(raw, "<u4").astype(np.int64), pa.int64())
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return segments(spark, folder).mapInArrow(run, ddl)


def read_range(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """(start, ids) pieces of the ids from ``start`` to ``stop``, through the chunk index.

    Segments outside are skipped by their numbers alone, blocks outside are not decompressed.
    """
    begin = shard_starts(spark, folder)
    if not begin:
        return spark.createDataFrame([], "start long, ids array<long>")
    offsets = spark.createDataFrame([(k, v) for k, v in begin.items()], "shard int, before long")
    held = segments(spark, folder).join(F.broadcast(offsets), "shard").withColumn("at", F.col("before") + F.col("first_id"))
    held = held.where((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment = batch.slice(row, 1).to_pylist()[0]
                low = max(0, start - segment["at"])
                ids = unpack(segment, low, stop - segment["at"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment["at"] + low], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))],
                    names=["start", "ids"],
                )

    return held.mapInArrow(run, "start long, ids array<long>")
