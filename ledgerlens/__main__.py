"""python -m ledgerlens COMMAND STORE ...: ingest block files, follow a node, look at a store, roll it back, compact it."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources import block_files, ingest, leveldb
from ledgerlens.sources.notify import Subscriber
from ledgerlens.sources.rpc import Node
from ledgerlens.sources.store import Store
from ledgerlens.streaming import follow


def options() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlens", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    for name, what in (("status", "the store's height, status and what to do next"), ("layout", "the store's tables"), ("compact", "write all batches as one"), ("vacuum", "remove folders that no manifest names"), ("rollback", "let only blocks up to a height count"), ("ingest", "block files into the store"), ("follow", "a node's blocks into the store, and on")):
        c = commands.add_parser(name, help=what)
        c.add_argument("store")
        if name == "rollback":
            c.add_argument("height", type=int)
        if name in ("ingest", "follow"):
            c.add_argument("--network", default="mainnet", choices=["mainnet", "testnet", "regtest"])
            c.add_argument("--blocks-at-once", type=int, default=500)
        if name == "ingest":
            c.add_argument("folder", help="of the files blk*.dat")
            c.add_argument("--index", help="LevelDB folder of the block index; else the chain is found among the files' headers")
            c.add_argument("--upto", type=int, help="highest block")
        if name == "follow":
            c.add_argument("--rpc", required=True, help="the node's address")
            c.add_argument("--user", default="")
            c.add_argument("--password", default="")
            c.add_argument("--notify", help="tcp://host:port of the node's announcements")
            c.add_argument("--confirmations", type=int, default=0)
            c.add_argument("--wait", type=float, default=10)
            c.add_argument("--turns", type=int, help="stop after so many")
    return p


def ingest_files(spark: SparkSession, store: Store, folder: str, index: str | None, upto: int | None, network: str, blocks_at_once: int) -> ingest.BatchStats:
    """Blocks of the main chain from the store's height on, so many at a time, each batch read at its blocks' places."""
    start = ingest.recover(store)
    if index:
        heights: DataFrame = leveldb.block_index(spark, index)
        leveldb.check_heights(heights if upto is None else heights.where(F.col("height") <= upto))
        last = heights.agg(F.max("height")).first()[0]
    else:
        headers = block_files.scan_blocks(spark, f"{folder}/blk*.dat", network).drop("transactions")
        heights = ingest.saved(headers.join(block_files.main_chain(headers), "hash").select("height", "file", "offset"))
        last = heights.agg(F.max("height")).first()[0]
    last = last if upto is None or last is None else min(last, upto)
    total = ingest.BatchStats()
    while last is not None and start <= last:
        end = min(last, start + blocks_at_once - 1)
        if index:
            blocks = block_files.load_heights(spark, heights, start, end, folder, network)
        else:
            own = heights.where(F.col("height").between(start, end))
            blocks = own.join(block_files.scan_blocks_at(spark, own.select("file", "offset"), network), ["file", "offset"])
        tables = block_files.relations(blocks, network)
        stats = ingest.ingest_batch(store, f"files-{store.manifest()['version']}", {n: t for n, t in tables.items() if n != "tx_in_block"}, unique=False)
        total = ingest.BatchStats(*(a + b for a, b in zip(vars(total).values(), vars(stats).values(), strict=True)))
        start = end + 1
    store.set_status("completed")
    return total


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = options().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("ledgerlens").getOrCreate()
    store = Store(spark, a.store)
    if a.command == "status":
        print(json.dumps(ingest.status_report(store)))
    elif a.command == "layout":
        store.layout().show(100, False)
    elif a.command == "compact":
        print(json.dumps({"compacted": store.compact(f"compact-{store.manifest()['version']}")}))
    elif a.command == "vacuum":
        print(json.dumps({"removed": store.vacuum()}))
    elif a.command == "rollback":
        print(json.dumps({"rolled_back": store.rollback(a.height)}))
    elif a.command == "ingest":
        print(json.dumps(vars(ingest_files(spark, store, a.folder, a.index, a.upto, a.network, a.blocks_at_once))))
    else:
        turns = iter(range(a.turns)) if a.turns is not None else iter(int, 1)
        wake = Subscriber(a.notify).wake if a.notify else time.sleep
        follow.follow(spark, store, Node(a.rpc, a.user, a.password), lambda: next(turns, None) is None, a.wait, wake, network=a.network, blocks_at_once=a.blocks_at_once, confirmations=a.confirmations)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
