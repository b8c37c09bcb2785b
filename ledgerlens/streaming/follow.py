"""Following a node: recover, find where the chains part, roll back, catch up; again at each turn of a loop."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources import block_files, ingest
from ledgerlens.sources.rpc import Node, rpc_blocks
from ledgerlens.sources.store import Store

WINDOW = 100  # stored hashes that are compared with the node's at a time


def fork_height(store: Store, node: Node) -> int:
    """The highest stored height whose block is also the node's; -1 where there is none."""
    top = store.resume_height() - 1
    while top >= 0:
        low = max(0, top - WINDOW + 1)
        stored = {r.height: r.hash for r in store.versions("blocks").where(F.col("height").between(low, top)).select("height", "hash").collect()}
        for height in range(top, low - 1, -1):
            if height in stored and node.block_hash(height) == stored[height]:
                return height
        top = low - 1
    return -1


def catch_up(spark: SparkSession, store: Store, node: Node, network: str = "mainnet", blocks_at_once: int = 500, confirmations: int = 0) -> ingest.BatchStats:
    """Everything from the store's height up to the node's tip, less the confirmations asked for; what the node has dropped is rolled back first.

    Each batch becomes visible chunk by chunk, so a stop leaves whole blocks. A chain that changes while a batch is read
    shows as a parent that doesn't fit (ReorgDetected); the next call finds the fork.
    """
    ingest.recover(store)
    store.rollback(fork_height(store, node))
    total = ingest.BatchStats()
    while (start := store.resume_height()) <= (tip := node.tip_height() - confirmations):
        count = min(blocks_at_once, tip + 1 - start)
        rows = rpc_blocks(spark, node, start, count)
        tables: dict[str, DataFrame] = block_files.relations(rows, network)
        turn = f"{store.manifest()['version']}-{start}"
        stats = ingest.ingest_batch(store, f"follow-{turn}", {n: t for n, t in tables.items() if n != "tx_in_block"}, unique=False)
        total = ingest.BatchStats(*(a + b for a, b in zip(vars(total).values(), vars(stats).values(), strict=True)))
        if not stats.blocks:
            break
    return total


def follow(spark: SparkSession, store: Store, node: Node, stop: Callable[[], bool], wait: float = 10, wake: Callable[[float], None] = time.sleep, **options) -> None:
    """catch_up again and again until stop() says so; wake(wait) returns when a new block is announced or the time is over."""
    while not stop():
        try:
            catch_up(spark, store, node, **options)
            store.set_status("in_progress")
        except ingest.ReorgDetected:
            continue
        except Exception:
            store.set_status("error")
            raise
        wake(wait)
