"""Live mode: a change log of blocks applied to the store, gaps in notifications, and unspent outputs as stream state.

Offsets of a stream can't go back when a chain is reorganised, so the log's rows are numbered changes: an append of a
block or a rollback to a height.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.sources.store import Store


def surviving(changes: DataFrame) -> DataFrame:
    """Appends of a micro-batch (seq, op, height, ...) that no later rollback in it undoes; of a height's the last one.

    The running minimum is over the narrow rows of one micro-batch, whose size the trigger bounds.
    """
    later = W.orderBy(F.desc("seq")).rowsBetween(W.unboundedPreceding, -1)
    undone = F.min(F.when(F.col("op") == "rollback", F.col("height"))).over(later)
    keys = changes.select("seq", "op", "height").withColumn("_low", undone).where("op = 'append' and (_low is null or height <= _low)")
    return changes.join(keys.groupBy("height").agg(F.max("seq").alias("seq")).select("seq"), "seq", "left_semi")


def apply_changes(store: Store, decode: Callable[[DataFrame], dict[str, DataFrame]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: rollbacks and appends of a micro-batch become one manifest; a batch run again changes nothing."""

    def run(changes: DataFrame, batch: int) -> None:
        changes = changes.persist()  # a micro-batch, read once for its rollbacks and once for each table
        try:
            low = changes.where("op = 'rollback'").agg(F.min("height")).first()[0]
            store.append(f"live-{batch}", decode(surviving(changes)), above=low)
        finally:
            changes.unpersist()

    return run


def start_live(changes: DataFrame, store: Store, decode: Callable[[DataFrame], dict[str, DataFrame]], checkpoint: str, **trigger) -> StreamingQuery:
    """Runs until stopped (or, with availableNow=True, until all changes are in)."""
    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply_changes(store, decode))
    return (writer.trigger(**trigger) if trigger else writer).start()


def notification_gaps(notes: DataFrame) -> DataFrame:
    """expected, got of notifications (source, seq: unsigned 32 bits that wrap) whose number isn't the next; state: the last number of a source."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        found = []
        for seq in pd.concat(list(batches)).sort_values("at")["seq"]:
            if last is not None and seq != (last + 1) % 2**32:
                found.append((key[0], (last + 1) % 2**32, int(seq)))
            last = int(seq)
        state.update((last,))
        yield pd.DataFrame(found, columns=["source", "expected", "got"])

    return notes.groupBy("source").applyInPandasWithState(run, "source string, expected long, got long", "last long", "append", "NoTimeout")


def utxo_state(changes: DataFrame) -> DataFrame:
    """Per output of a stream of creations (amount) and spends (amount null): its amount, and whether it is unspent.

    A built-in aggregate: its state (one row an output, never expired) is in the state store, beside the partition.
    """
    own = changes.groupBy("output_id").agg(F.max("amount").alias("amount"), F.count_if(F.col("amount").isNull()).alias("n_spends"))
    return own.select("output_id", "amount", (F.col("amount").isNotNull() & (F.col("n_spends") == 0)).alias("unspent"))
