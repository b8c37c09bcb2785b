"""Entries of a LevelDB folder as rows: its table files and logs read by tasks, the newest version of each key kept."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import chain_state
from ledgerlens.sources import codec

#: Fixed values of the file format: a table's last 8 bytes, sizes of its footer and of a log's blocks and record heads.
TABLE_MAGIC, FOOTER, LOG_BLOCK, LOG_HEAD = 0xDB4775248B80FB57, 48, 32768, 7
DELETED, PUT = 0, 1
Entry = tuple[bytes, int, bytes | None]  # key, sequence number, value (None: deleted)


class CorruptIndex(RuntimeError):
    """An index without blocks, or with heights that aren't consecutive."""


def _varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if b < 0x80:
            return n, at


def _block(data: bytes, handle: bytes) -> bytes:
    """The block at a handle (offset, size), unpacked."""
    offset, at = _varint(handle, 0)
    size, _ = _varint(handle, at)
    body, kind = data[offset : offset + size], data[offset + size]
    if kind == 0:
        return body
    if kind == 1:
        return pa.decompress(body, _varint(body, 0)[0], "snappy", asbytes=True)
    raise codec.BadBytes(f"block of compression {kind}")


def _pairs(block: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Keys and values of a block; a key is stored by what it doesn't share with the one before."""
    end = len(block) - 4 * (1 + struct.unpack("<I", block[-4:])[0])
    at, key = 0, b""
    while at < end:
        shared, at = _varint(block, at)
        own, at = _varint(block, at)
        size, at = _varint(block, at)
        key = key[:shared] + block[at : at + own]
        yield key, block[at + own : at + own + size]
        at += own + size


def table_entries(data: bytes) -> Iterator[Entry]:
    if len(data) < FOOTER or struct.unpack("<Q", data[-8:])[0] != TABLE_MAGIC:
        raise codec.BadBytes("no table")
    footer = data[-FOOTER:]
    _, at = _varint(footer, 0)
    _, at = _varint(footer, at)  # what the first handle names isn't needed
    for _, handle in _pairs(_block(data, footer[at:])):
        for key, value in _pairs(_block(data, handle)):
            tag = struct.unpack("<Q", key[-8:])[0]
            yield key[:-8], tag >> 8, value if tag & 0xFF == PUT else None


def _records(data: bytes) -> Iterator[bytes]:
    """A log's records, put together from their parts; a part cut off at the end is left out, as a writer stopped there."""
    at, parts = 0, b""
    while at + LOG_HEAD <= len(data):
        left = LOG_BLOCK - at % LOG_BLOCK
        if left < LOG_HEAD:
            at += left
            continue
        size, kind = struct.unpack("<HB", data[at + 4 : at + LOG_HEAD])
        body = data[at + LOG_HEAD : at + LOG_HEAD + size]
        if kind == 0 or len(body) < size:
            return
        at += LOG_HEAD + size
        parts = body if kind in (1, 2) else parts + body
        if kind in (1, 4):
            yield parts


def log_entries(data: bytes) -> Iterator[Entry]:
    for record in _records(data):
        sequence, count = struct.unpack("<QI", record[:12])
        at = 12
        for k in range(count):
            kind, (size, at) = record[at], _varint(record, at + 1)
            key, at = record[at : at + size], at + size
            value = None
            if kind == PUT:
                size, at = _varint(record, at)
                value, at = record[at : at + size], at + size
            yield key, sequence + k, value


def scan_leveldb(spark: SparkSession, folder: str) -> DataFrame:
    """key, value of the folder's entries. A file (of a few MB) is one task's; of a key the highest sequence number counts, deletions too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[Entry] = []
                for entry in (log_entries if name.endswith(".log") else table_entries)(content.as_py()):
                    rows.append(entry)
                    if len(rows) >= 5000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{ldb,sst,log}").load(folder)
    entries = files.select("path", "content").mapInArrow(run, "key binary, sequence long, value binary")
    newest = entries.groupBy("key").agg(F.max_by(F.struct("value"), "sequence").alias("newest"))
    return newest.select("key", F.col("newest.value").alias("value")).where("value is not null")


def _rows(rows: list[Entry]) -> pa.RecordBatch:
    keys, numbers, values = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(numbers, pa.int64()), pa.array(values, pa.binary())], names=["key", "sequence", "value"])


def block_index(spark: SparkSession, folder: str) -> DataFrame:
    """hash, height, status, tx_count, file_number, file_offset of a block index; other keys and records that can't be read are left out."""
    fields = [("hash", pa.string()), ("height", pa.int64()), ("status", pa.int64()), ("tx_count", pa.int64()), ("file_number", pa.int64()), ("file_offset", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [r for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if (r := codec.index_record(k, v))]
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    blocks = scan_leveldb(spark, folder).where((F.length("key") == 33) & (F.substring("key", 1, 1) == F.lit(b"b")))
    return blocks.mapInArrow(run, "hash string, height long, status long, tx_count long, file_number long, file_offset long")


def check_heights(index: DataFrame) -> None:
    """CorruptIndex where the index has no blocks, a height twice, or a height whose next is missing."""
    n = index.agg(F.count("*").alias("n"), F.count_distinct("height").alias("d")).first()
    if not n.n:
        raise CorruptIndex("no blocks")
    if n.n != n.d:
        raise CorruptIndex(f"{n.n - n.d} heights stand there again")
    if gap := chain_state.height_gaps(index).orderBy("height").first():
        raise CorruptIndex(f"heights {gap.height}, then {gap.nxt}")
