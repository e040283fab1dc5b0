"""Token ids as length-delimited binary records with a separate offset index.

A record file holds frames one after the other, all numbers little-endian::

    uint64 length | uint32 masked checksum of the length | payload | uint32 masked checksum of the payload

The checksum is CRC-32, rotated right by 15 bits and shifted by a constant, so that checksums of data
that hold checksums stay useful.  A payload is ``uint8 width, uint8 has_id, int64 doc_id`` and the ids as
unsigned integers of ``width`` bytes.  Files are numbered shards in ascending order of ``doc_id``.  The
index is a Parquet table with a row for each record: shard, file, its place and length in bytes, its first
token's place in the shard and its number of tokens.  A reader that shuffles seeks by the index.

Each attempt at a task writes a file of its own, and only the file of the attempt whose index rows Spark
commits is ever read, so lost executors and repeated tasks do no harm.

Defined results: a null text is empty and has the end id alone; documents without an id come first; rows
with one id stand together in an order given by their text; an empty table gives an index without rows.
Texts are sorted by a range partition of the ids and a hash of the text, so even one id on a third of all
rows is spread over tasks.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm import segments
from ordermill.llm.tables import filesystem, fresh_name

MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
IDENTITY = struct.Struct("<BBq")
INDEX = (
    "shard int, file string, row long, doc_id long, place long, bytes long, shard_start long, n_tokens long"
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def payload(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return IDENTITY.pack(width, doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    width, has_id, doc_id = IDENTITY.unpack_from(data)
    return (doc_id if has_id else None), np.frombuffer(data, f"<u{width}", offset=IDENTITY.size)


def read_frame(stream) -> bytes | None:
    """The next payload of a file; None at its end.  A wrong checksum or a cut file is an error."""
    head = stream.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError("record file ends within a frame")
    length, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("checksum of a record's length is wrong")
    body = stream.read(length + 4)
    if len(body) < length + 4 or masked(body[:length]) != struct.unpack("<I", body[length:])[0]:
        raise ValueError("checksum of a record is wrong")
    return body[:length]


@cache
def _table(path: str) -> segments.SegmentTable:
    return segments.library_table(path)


def encoded(
    batch: pa.RecordBatch, tokenizer: str, end_id: int, size: int = segments.SLICE
) -> Iterator[tuple[int, np.ndarray]]:
    """Row and ids of every text of a batch, with the end id; about ``size`` bytes are worked on at once."""
    table, tail = _table(tokenizer), np.array([end_id], np.int32)
    flat, offsets = segments.utf8(batch.column("text"))
    for low, high in segments.slices(offsets, size):
        part = flat[offsets[low] : offsets[high]]
        ids, starts = table.gather(*table.slots(part, offsets[low : high + 1] - offsets[low]))
        for row in range(low, high):
            yield row, np.concatenate([ids[starts[row - low] : starts[row - low + 1]], tail])


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int, width: int = 2) -> None:
    """Encodes every text and writes records and index to ``path``, a folder all executors reach.

    ``width``: bytes of an id; two hold vocabularies of up to 65,536.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fs, folder = TaskContext.get().partitionId(), *filesystem(f"{path}/records")
        stream, name = None, fresh_name(f"{shard:06d}") + ".rec"
        row = place = start = 0
        for batch in batches:
            if stream is None:
                fs.create_dir(folder, recursive=True)
                stream = fs.open_output_stream(f"{folder}/{name}", buffer_size=1 << 20)
            doc_ids, rows = batch.column("doc_id").to_pylist(), []
            for i, ids in encoded(batch, tokenizer, end_id):
                data = frame(payload(doc_ids[i], ids, width))
                stream.write(data)
                rows.append((shard, name, row, doc_ids[i], place, len(data), start, len(ids)))
                row, place, start = row + 1, place + len(data), start + len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, kind)
                    for column, kind in zip(
                        zip(*rows, strict=True) if rows else [[]] * 8,
                        (pa.int32(), pa.string(), *[pa.int64()] * 6),
                        strict=True,
                    )
                ],
                names=[x.split()[0] for x in INDEX.split(", ")],
            )
        if stream is not None:
            stream.close()

    id_order = F.col("doc_id").asc_nulls_first()
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(id_order, F.xxhash64("text"))
        .sortWithinPartitions(id_order, F.xxhash64("text"))
    )
    ordered.mapInArrow(write, INDEX).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def shard_starts(index: DataFrame) -> DataFrame:
    """For each shard its file and the number of tokens before it; one row per file."""
    totals = index.groupBy("shard", "file").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record, read and checked from the files: doc_id, start (tokens of all records before it),
    n_tokens, ids (little-endian unsigned 32-bit integers)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(f"{path}/records")
        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
        )
        for batch in batches:
            for entry in batch.to_pylist():
                start, rows, size = entry["first"], [], 0
                with fs.open_input_stream(f"{folder}/{entry['file']}", buffer_size=1 << 20) as stream:
                    while (data := read_frame(stream)) is not None:
                        doc_id, ids = parse(data)
                        rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                        start, size = start + len(ids), size + 4 * len(ids)
                        if size > 8_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    files = shard_starts(read_index(spark, path))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def shuffled_records(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """The records in a random order fixed by ``seed``: index rows are dealt out and sorted at random and
    each task seeks its records by the index.  Columns: doc_id, n_tokens, ids."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(f"{path}/records")
        for batch in batches:
            rows = batch.to_pylist()
            for low in range(0, len(rows), 256):
                part = rows[low : low + 256]
                by_place = sorted(range(len(part)), key=lambda i: (part[i]["file"], part[i]["place"]))
                ids: list = [None] * len(part)
                name, stream = None, None
                for i in by_place:
                    if part[i]["file"] != name:
                        name = part[i]["file"]
                        stream = fs.open_input_file(f"{folder}/{name}")
                    stream.seek(part[i]["place"])
                    ids[i] = parse(read_frame(stream))[1].astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["doc_id"] for r in part], pa.int64()),
                        pa.array([r["n_tokens"] for r in part], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    at = F.xxhash64("file", "row", F.lit(seed))
    dealt = read_index(spark, path).withColumn("at", at).repartition("at").sortWithinPartitions("at")
    return dealt.select("file", "place", "doc_id", "n_tokens").mapInArrow(
        fetch, "doc_id long, n_tokens long, ids binary"
    )
