"""Raw block files as relations, and the main chain among their headers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.checkpoints import saved
from ledgerlens.functions.addresses import with_addresses
from ledgerlens.functions.columns import difficulty
from ledgerlens.operators.ledger import latest
from ledgerlens.sources import codec

INPUT = "previous_txid string, previous_output_index long, script_sig string, sequence long, witness array<string>"
OUTPUT = "amount long, script_pubkey string"
TX = f"txid string, version int, locktime long, size long, vsize long, weight long, is_coinbase boolean, inputs array<struct<{INPUT.replace(' ', ':').replace(',:', ',')}>>, outputs array<struct<{OUTPUT.replace(' ', ':').replace(',:', ',')}>>"
BLOCK = f"file string, offset long, hash string, version int, previous_hash string, merkle_root string, timestamp long, bits string, nonce long, tx_count long, size long, weight long, transactions array<struct<{TX.replace(' ', ':').replace(',:', ',')}>>"

BLOCK_COLUMNS = ["file", "offset", "hash", "version", "previous_hash", "merkle_root", "timestamp", "bits", "nonce", "tx_count", "size", "weight", "transactions"]


def _fields(spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], BLOCK).schema)


def scan_blocks(spark: SparkSession, path: str, network: str = "mainnet") -> DataFrame:
    """One row per block of the files at the path (a folder or a glob); a file is one task's, blocks leave it one by one.

    Zeros or under 8 bytes end a file; a wrong magic, a size of 0 or over 4,000,000 and a truncated block are errors.
    """
    schema = _fields(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for at, block in codec.framed_blocks(data.as_py(), network):
                    yield pa.RecordBatch.from_pylist([{"file": name, "offset": at} | codec.read_block(block)], schema=schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, BLOCK)


def scan_blocks_at(spark: SparkSession, places: DataFrame, network: str = "mainnet") -> DataFrame:
    """The blocks at (file, offset) of places, each read alone: its header, then as many bytes as that says.

    The places of a file are sorted and read by one task after the other. Files on stores that Arrow opens (local,
    HDFS, S3, GCS) are sought in; others are an error. So is a file that is missing.
    """
    schema = _fields(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            for own, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != name:
                    name, source = own, _opened(own)
                source.seek(at)
                head = source.read(8)
                size = int.from_bytes(head[4:], "little") if len(head) == 8 else 0
                found = codec.framed_block(head + source.read(min(size, codec.MAX_BLOCK)), 0, network)
                if found:
                    yield pa.RecordBatch.from_pylist([{"file": own, "offset": at} | codec.read_block(found[0])], schema=schema)

    dealt = places.select("file", F.col("offset").cast("long")).distinct().repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, BLOCK)


def _opened(uri: str) -> pa.NativeFile:
    from pyarrow.fs import FileSystem

    scheme, _, rest = uri.partition(":")
    fs, path = FileSystem.from_uri("file:///" + rest.lstrip("/") if scheme == "file" else uri)
    return fs.open_input_file(path)


def load_heights(spark: SparkSession, index: DataFrame, first: int, last: int, folder: str, network: str = "mainnet") -> DataFrame:
    """height and the block of each height from first to last that the index (height, file_number, file_offset) has, read at its place.

    An index's offset is that of the block itself, 8 bytes after its frame. Heights past the tip give no row.
    """
    name = F.concat(F.lit(folder.rstrip("/") + "/blk"), F.lpad(F.col("file_number").cast("string"), 5, "0"), F.lit(".dat"))
    own = index.where(F.col("height").between(first, last)).select("height", name.alias("file"), (F.col("file_offset") - 8).alias("offset"))
    return own.join(scan_blocks_at(spark, own.select("file", "offset"), network), ["file", "offset"]).select("height", *BLOCK_COLUMNS)


def read_counters(blocks: DataFrame) -> DataFrame:
    """file, blocks_read, last_offset of scanned blocks."""
    return blocks.groupBy("file").agg(F.count("*").alias("blocks_read"), F.max("offset").alias("last_offset"))


def main_chain(headers: DataFrame) -> DataFrame:
    """hash, height of the blocks on the chain of most work, from headers (hash, previous_hash, bits) in any order.

    Pointer doubling: after k rounds a header knows its ancestor 2^k below, its height and the work so far; the chain is
    then marked from the tip by the same jumps, longest first. Work is in units of difficulty 1. Rounds grow with the logarithm of the height. A block
    whose parent is absent starts a chain of its own at height 0.
    """
    own = headers.select("hash", "previous_hash", difficulty(F.col("bits")).alias("work")).dropDuplicates(["hash"])
    known = own.select(F.col("hash").alias("p"))
    jump = own.join(known, own["previous_hash"] == known["p"], "left").select("hash", F.col("p").alias("up"), "work", F.when(F.col("p").isNull(), 0).otherwise(1).cast("long").alias("steps"))
    jumps = [saved(jump)]
    while not jumps[-1].where("up is not null").isEmpty():
        j = jumps[-1]
        above = j.select(F.col("hash").alias("up"), F.col("up").alias("up2"), F.col("work").alias("work2"), F.col("steps").alias("steps2"))
        jumps.append(saved(j.join(above, "up", "left").select("hash", F.col("up2").alias("up"), (F.col("work") + F.coalesce("work2", F.lit(0.0))).alias("work"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"))))
    totals = jumps[-1].select("hash", "work", F.col("steps").alias("height"))
    marked = totals.orderBy(F.desc("work"), F.desc("height"), "hash").limit(1).select("hash")
    for j in reversed(jumps[:-1]):
        marked = saved(marked.unionByName(marked.join(j, "hash").where("up is not null").select(F.col("up").alias("hash"))).distinct())
    return totals.join(marked, "hash").select("hash", "height")


def relations(blocks: DataFrame, network: str = "mainnet") -> dict[str, DataFrame]:
    """blocks, transactions, outputs and inputs of scanned blocks that have a height.

    Of a transaction id found in two blocks the higher block's row stays; tx_in_block has both.
    """
    ts = F.timestamp_seconds("timestamp")
    tx = blocks.select(F.col("height").alias("block_height"), F.col("hash").alias("block_hash"), ts.alias("ts"), F.posexplode("transactions").alias("tx_index", "t"))
    flat = tx.select(F.col("t.txid").alias("txid"), "block_height", "block_hash", "ts", F.col("tx_index").cast("long"), *[F.col(f"t.{c}").alias(c) for c in ("version", "locktime", "size", "vsize", "weight", "is_coinbase")])
    outs = tx.select(F.col("t.txid").alias("txid"), "block_height", F.posexplode("t.outputs").alias("output_index", "o"))
    outs = outs.select(F.concat_ws(":", "txid", "output_index").alias("output_id"), F.col("output_index").cast("long"), "txid", "block_height", "o.amount", "o.script_pubkey")
    ins = tx.select(F.col("t.txid").alias("txid"), "block_height", F.col("t.is_coinbase").alias("is_coinbase"), F.posexplode("t.inputs").alias("input_index", "i"))
    ins = ins.select(F.concat_ws(":", "txid", "input_index").alias("input_id"), F.col("input_index").cast("long"), "txid", "block_height", "is_coinbase", "i.*", F.concat_ws(":", "i.previous_txid", "i.previous_output_index").alias("previous_output_id"))
    return {
        "blocks": blocks.select("height", "hash", "previous_hash", "merkle_root", ts.alias("ts"), "bits", difficulty(F.col("bits")).alias("difficulty"), "nonce", "version", "tx_count", "size", "weight"),
        "tx_in_block": flat.select("txid", "block_height", "tx_index"),
        "transactions": latest(flat, ["txid"], "block_height"),
        "outputs": with_addresses(latest(outs, ["output_id"], "block_height"), network),
        "inputs": latest(ins, ["input_id"], "block_height"),
    }
