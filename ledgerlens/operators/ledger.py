"""Ingestion operators over ledger relations: resolve spends, compute amounts, build the money-flow layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_OUTPUT = 4294967295


def resolve_inputs(inputs: DataFrame, outputs: DataFrame, on_missing: str = "skip") -> DataFrame:
    """Non-coinbase inputs with the output they spend.

    skip: inputs whose output is absent are left out; error: the first such row fails the job when it is computed.
    """
    if on_missing not in ("skip", "error"):
        raise ValueError("on_missing is skip or error")
    spent = outputs.select("output_id", "amount", "address", "script_type")
    own = inputs.where(~F.col("is_coinbase") & (F.col("previous_output_index") != NO_OUTPUT)).select("input_id", "txid", "block_height", "previous_output_id")
    joined = own.join(spent, own["previous_output_id"] == spent["output_id"], "inner" if on_missing == "skip" else "left")
    if on_missing == "error":
        message = F.concat(F.lit("unresolved input "), F.col("input_id"))
        joined = joined.withColumn("output_id", F.when(F.col("output_id").isNull(), F.raise_error(message).cast("string")).otherwise(F.col("output_id")))
    return joined.select("input_id", "txid", "block_height", "output_id", "amount", "address", "script_type")


def tx_amounts(transactions: DataFrame, outputs: DataFrame, resolved: DataFrame) -> DataFrame:
    """total_input, total_output and fee of each transaction; both sides are summed before they are joined."""
    made = outputs.groupBy("txid").agg(F.sum("amount").alias("total_output"))
    spent = resolved.groupBy("txid").agg(F.sum("amount").alias("total_input"))
    both = transactions.join(spent, "txid", "left").join(made, "txid", "left")
    total_in, total_out = F.coalesce("total_input", F.lit(0)).cast("long"), F.coalesce("total_output", F.lit(0)).cast("long")
    return both.select(*transactions.columns, total_in.alias("total_input"), total_out.alias("total_output"), floor_fee(total_in, total_out).alias("fee"))


def floor_fee(total_input: Column, total_output: Column) -> Column:
    return F.greatest(total_input - total_output, F.lit(0)).cast("long")


def performs(resolved: DataFrame) -> DataFrame:
    own = resolved.where("address is not null").groupBy("address", "txid")
    return own.agg(F.count("*").alias("input_count"), F.sum("amount").alias("amount_spent"))


def benefits_to(outputs: DataFrame) -> DataFrame:
    own = outputs.where("address is not null").groupBy("txid", "address")
    return own.agg(F.count("*").alias("output_count"), F.sum("amount").alias("amount_received"))


def with_spent_state(outputs: DataFrame, spends: DataFrame) -> DataFrame:
    """Spent flags as a view: they follow from the spends, so a rollback needs no update."""
    by = spends.select("output_id", F.col("txid").alias("spent_in_txid"), F.col("block_height").alias("spent_at_height"))
    return outputs.join(by, "output_id", "left").withColumn("is_spent", F.col("spent_in_txid").isNotNull())


def utxo_set(outputs: DataFrame, spends: DataFrame) -> DataFrame:
    return outputs.join(spends.select("output_id"), "output_id", "left_anti")


def latest(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Upsert view: of the rows of a key the one of the highest version (last write wins)."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row")).select(*keys, *[F.col(f"_row.{c}") for c in rest])


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once: what a uniqueness constraint would refuse."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def block_memory(blocks: DataFrame, transactions: DataFrame, outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Estimated bytes to hold a block: 3500, and 3000 a transaction, 3500 an output, 2500 an input (fixed values)."""
    n = lambda t, name: t.groupBy(F.col("block_height").alias("height")).agg(F.count("*").alias(name))
    j = blocks.select("height").join(n(transactions, "t"), "height", "left").join(n(outputs, "o"), "height", "left").join(n(inputs, "i"), "height", "left").na.fill(0)
    return j.select("height", F.expr("3500 + 3000 * t + 3500 * o + 2500 * i").cast("long").alias("bytes"))


def adaptive_chunks(sizes: list[int], budget: int) -> list[tuple[int, int]]:
    """Contiguous half-open ranges of blocks that fit the budget; a block over the budget stands alone."""
    out: list[tuple[int, int]] = []
    begin, total = 0, 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > budget:
            out.append((begin, k))
            begin, total = k, 0
        total += size
    return [*out, (begin, len(sizes))] if sizes else []


def mixing(inputs: DataFrame, outputs: DataFrame, least_inputs: int = 10, least_outputs: int = 10, limit: int = 100) -> DataFrame:
    """Transactions of many inputs and outputs, the largest first. Both sides are counted and cut before they meet: never their product."""
    i = inputs.groupBy("txid").agg(F.count("*").alias("n_inputs")).where(F.col("n_inputs") >= least_inputs)
    o = outputs.groupBy("txid").agg(F.count("*").alias("n_outputs")).where(F.col("n_outputs") >= least_outputs)
    return i.join(o, "txid").orderBy(F.desc("n_inputs"), F.desc("n_outputs"), "txid").limit(limit)


def high_fees(transactions: DataFrame, over: int = 100_000_000, limit: int = 100) -> DataFrame:
    """Transactions other than coinbases whose fee is over the bound, the highest first."""
    return transactions.where(~F.col("is_coinbase") & (F.col("fee") > over)).orderBy(F.desc("fee"), "txid").limit(limit)
