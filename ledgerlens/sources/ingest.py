"""Batches of blocks into the store: estimate, cut into chunks, check parents and keys, resolve, commit, count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.checkpoints import saved
from ledgerlens.operators import chain_state, ledger
from ledgerlens.sources.store import KEYS, Store

CHUNK_BYTES = 256 << 20  # estimated, of a chunk


class ReorgDetected(RuntimeError):
    """A block's parent isn't the stored block one below it."""

    def __init__(self, height: int, expected: str, actual: str):
        super().__init__(f"block {height}: parent {actual}, stored {expected}")
        self.height, self.expected, self.actual = height, expected, actual


class DuplicateKeys(RuntimeError):
    """Keys that must be unique are there already, or twice in one chunk."""

    def __init__(self, table: str, keys: list):
        super().__init__(f"{table}: {keys} and perhaps more")
        self.table, self.keys = table, keys


@dataclass(frozen=True)
class BatchStats:
    chunks: int = 0
    blocks: int = 0
    transactions: int = 0
    outputs: int = 0
    inputs: int = 0
    resolved: int = 0


def chunks_of(tables: dict[str, DataFrame], budget: int = CHUNK_BYTES) -> list[tuple[int, int]]:
    """(first, last height) of chunks whose estimated size keeps to the budget; a block over it stands alone. One number a block comes to the driver."""
    sizes = ledger.block_memory(tables["blocks"], tables["transactions"], tables["outputs"], tables["inputs"]).orderBy("height").collect()
    return [(sizes[a].height, sizes[b - 1].height) for a, b in ledger.adaptive_chunks([r.bytes for r in sizes], budget)]


def check_unique(store: Store, tables: dict[str, DataFrame]) -> None:
    """Raises DuplicateKeys where a key of the new rows is stored already or repeated among them."""
    stored = store.manifest()["batches"]
    for name, key in KEYS.items():
        if name not in tables:
            continue
        found = ledger.duplicate_keys(tables[name], key).select(key)
        if any(name in b["tables"] for b in stored):
            found = found.unionByName(tables[name].select(key).join(store.versions(name).select(key), key, "left_semi"))
        if first := [r[0] for r in found.limit(5).collect()]:
            raise DuplicateKeys(name, first)


def ingest_batch(store: Store, batch: str, tables: dict[str, DataFrame], budget: int = CHUNK_BYTES, on_missing: str = "skip", unique: bool = True) -> BatchStats:
    """Blocks with their transactions, outputs and inputs, in any order, into the store, chunk by chunk.

    Each chunk: its first block's parent is checked (ReorgDetected), its keys are checked (DuplicateKeys; with unique
    False later rows of a key replace earlier ones), its inputs are resolved against the outputs stored and those of the
    chunk itself, amounts and money-flow edges are computed, and all tables become visible with one manifest. An error
    leaves the chunks before it in place. A batch run again skips the chunks that are in.
    """
    tables = {n: saved(tables[n]) for n in ("blocks", "transactions", "outputs", "inputs")}
    total = BatchStats()
    for first, last in chunks_of(tables, budget):
        name = f"{batch}-{first}-{last}"
        if any(b["id"] == name for b in store.manifest()["batches"]):
            continue
        own = {n: t.where(F.col("height" if n == "blocks" else "block_height").between(first, last)) for n, t in tables.items()}
        inner = chain_state.broken_parents(own["blocks"]).orderBy("height").first()
        lowest = own["blocks"].where(F.col("height") == first).select("previous_hash").first()
        if broken := store.check_parent(first, lowest.previous_hash) or (inner and tuple(inner)):
            raise ReorgDetected(*broken)
        if unique:
            check_unique(store, own)
        columns = ["output_id", "amount", "address", "script_type"]
        known = own["outputs"].select(*columns)
        if any("outputs" in b["tables"] for b in store.manifest()["batches"]):
            needed = own["inputs"].select(F.col("previous_output_id").alias("output_id")).distinct()
            known = known.unionByName(store.table("outputs").select(*columns).join(needed, "output_id", "left_semi")).dropDuplicates(["output_id"])
        resolved = saved(ledger.resolve_inputs(own["inputs"], known, on_missing))
        spends = resolved.select("input_id", "output_id", "txid", "block_height")
        height = own["transactions"].select("txid", "block_height")
        rows = own | {
            "transactions": ledger.tx_amounts(own["transactions"], own["outputs"], resolved),
            "spends": spends,
            "performs": ledger.performs(resolved).join(height, "txid"),
            "benefits_to": ledger.benefits_to(own["outputs"]).join(height, "txid"),
        }
        store.append(name, rows, unique=unique)
        counts = {n: t.count() for n, t in own.items()}
        total = BatchStats(total.chunks + 1, *(getattr(total, n) + counts[n] for n in ("blocks", "transactions", "outputs", "inputs")), total.resolved + resolved.count())
    return total


def ingest_block(store: Store, tables: dict[str, DataFrame], height: int) -> BatchStats:
    """One block, as a chunk of its own; rows of keys that are stored already replace those."""
    own = {n: t.where(F.col("height" if n == "blocks" else "block_height") == height) for n, t in tables.items()}
    return ingest_batch(store, "block", own, unique=False)


def recover(store: Store) -> int:
    """After a crash: what lies above the highest block that has all its transactions stops counting; the height to go on from."""
    if store.manifest()["height"] is None:
        return 0
    complete = chain_state.complete_height(store.versions("blocks"), store.versions("transactions")).first()[0]
    store.rollback(-1 if complete is None else complete)
    return store.resume_height()


def status_report(store: Store) -> dict:
    """The manifest's fields, the height to go on from, and a hint for what to do."""
    hints = {"in_progress": "start again to go on", "completed": "nothing is left to do", "paused": "start again to go on from here", "error": "look at the log, then start again; incomplete blocks are removed first"}
    m = store.manifest()
    return {"height": m["height"], "hash": m["hash"], "status": m["status"], "resume_height": store.resume_height(), "batches": len(m["batches"]), "hint": hints[m["status"]]}
