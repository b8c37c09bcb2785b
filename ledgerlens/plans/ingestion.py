"""Ingestion relations, index lookups, scalar functions and chain state as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import columns as fn
from ledgerlens.operators import chain_state, ledger
from ledgerlens.plans.chain_view import NO_OUTPUT, Chain
from ledgerlens.plans.registry import query


@query("SELECT * FROM blocks")
def blocks_build(c: Chain) -> DataFrame:
    return c.blocks


@query("SELECT * FROM outputs")
def outputs_build(c: Chain) -> DataFrame:
    return c.outputs


@query("SELECT * FROM benefits_to")
def benefits_to(c: Chain) -> DataFrame:
    return c.benefits_to


@query("SELECT previous_output_id, txid FROM inputs WHERE NOT is_coinbase")
def input_keys(c: Chain) -> DataFrame:
    return c.inputs.where("not is_coinbase").select("previous_output_id", "txid")


@query("SELECT * FROM resolved")
def resolved_inputs(c: Chain) -> DataFrame:
    return c.resolved


@query("SELECT * FROM transactions")
def tx_amounts(c: Chain) -> DataFrame:
    return c.transactions


@query("SELECT * FROM performs")
def performs(c: Chain) -> DataFrame:
    return c.performs


@query("SELECT txid, output_id FROM outputs WHERE txid IN (SELECT txid FROM base)")
def has_output(c: Chain) -> DataFrame:
    return c.lines.join(c.base.select("txid"), "txid", "left_semi").select("txid", "output_id")


@query("SELECT * FROM spends")
def spends(c: Chain) -> DataFrame:
    return c.spends


@query("SELECT * FROM utxos")
def utxo_set(c: Chain) -> DataFrame:
    return c.utxos


@query("SELECT * FROM addresses")
def addresses(c: Chain) -> DataFrame:
    return c.addresses


@query("SELECT txid, max(block_height) AS block_height FROM (SELECT txid, block_height FROM base UNION ALL SELECT txid, block_height + 1 FROM base WHERE is_coinbase AND block_height % 7 = 0) GROUP BY txid")
def bip30_dedup(c: Chain) -> DataFrame:
    again = c.base.where("is_coinbase and block_height % 7 = 0").select("txid", (F.col("block_height") + 1).alias("block_height"))
    rows = c.base.select("txid", "block_height").unionByName(again).withColumn("version", F.col("block_height"))
    return ledger.latest(rows, ["txid"], "version").select("txid", "block_height")


@query("SELECT height, hash, previous_hash, tx_count FROM blocks")
def block_index(c: Chain) -> DataFrame:
    return c.blocks.select("height", "hash", "previous_hash", "tx_count")


@query("SELECT height, hash FROM blocks WHERE height <= 100")
def block_index_upto(c: Chain) -> DataFrame:
    return c.blocks.where("height <= 100").select("height", "hash")


@query("SELECT height, hash FROM blocks WHERE height BETWEEN 50 AND 99")
def block_index_range(c: Chain) -> DataFrame:
    return c.blocks.where("height between 50 and 99").select("height", "hash")


@query("SELECT max_by(hash, height) AS hash, max(height) AS height FROM blocks")
def best_tip(c: Chain) -> DataFrame:
    return c.blocks.agg(F.max_by("hash", "height").alias("hash"), F.max("height").alias("height"))


@query("SELECT height, hash, tx_count FROM blocks WHERE height = 42")
def block_by_height(c: Chain) -> DataFrame:
    return c.blocks.where("height = 42").select("height", "hash", "tx_count")


@query("SELECT height, hash, tx_count FROM blocks WHERE hash = sha256('blk:42')")
def block_by_hash(c: Chain) -> DataFrame:
    return c.blocks.where(F.col("hash") == F.sha2(F.lit("blk:42"), 256)).select("height", "hash", "tx_count")


@query("SELECT hash FROM blocks WHERE height = 7")
def block_hash_at(c: Chain) -> DataFrame:
    return c.blocks.where("height = 7").select("hash")


@query("SELECT output_id, amount, script_type, address FROM outputs WHERE block_height BETWEEN 100 AND 199")
def prewarm_window(c: Chain) -> DataFrame:
    return c.outputs.where("block_height between 100 and 199").select("output_id", "amount", "script_type", "address")


@query("SELECT output_id, amount, address FROM outputs WHERE output_id IN (SELECT previous_output_id FROM inputs WHERE NOT is_coinbase AND block_height BETWEEN 500 AND 599)")
def needed_utxos(c: Chain) -> DataFrame:
    need = c.inputs.where("not is_coinbase and block_height between 500 and 599").select(F.col("previous_output_id").alias("output_id")).distinct()
    return c.lines.join(need, "output_id", "left_semi").select("output_id", "amount", "address")


@query("SELECT i.output_id, amount, script_type, address FROM (SELECT DISTINCT previous_output_id AS output_id FROM inputs WHERE block_height < 300) i JOIN outputs o ON o.output_id = i.output_id")
def lookup_outputs(c: Chain) -> DataFrame:
    ids = c.inputs.where("block_height < 300").select(F.col("previous_output_id").alias("output_id")).distinct()
    return ids.join(c.lines.select("output_id", "amount", "script_type", "address"), "output_id")


@query("SELECT b.height, b.tx_count AS expected, count(t.txid) AS actual FROM blocks b LEFT JOIN base t ON t.block_height = b.height GROUP BY ALL")
def block_complete(c: Chain) -> DataFrame:
    return chain_state.block_complete(c.blocks, c.base)


@query("SELECT max(height) AS max_height FROM blocks")
def max_height(c: Chain) -> DataFrame:
    return c.blocks.agg(F.max("height").alias("max_height"))


@query("SELECT max(height) AS last_height, max(height) + 1 AS resume_height FROM blocks")
def resume_height(c: Chain) -> DataFrame:
    return c.blocks.agg(F.max("height").alias("last_height"), F.coalesce(F.max("height") + 1, F.lit(0)).cast("long").alias("resume_height"))


@query("SELECT b.height, 3500 + 3000 * (SELECT count(*) FROM base t WHERE t.block_height = b.height) + 3500 * (SELECT count(*) FROM outputs o WHERE o.block_height = b.height) + 2500 * (SELECT count(*) FROM inputs i WHERE i.block_height = b.height) AS bytes FROM blocks b")
def block_mem_estimate(c: Chain) -> DataFrame:
    return ledger.block_memory(c.blocks, c.base, c.outputs, c.inputs)


@query("SELECT count(*) FILTER (WHERE output_id IS NOT NULL) AS hits, count(*) AS lookups, count(*) FILTER (WHERE output_id IS NOT NULL)::DOUBLE / count(*) AS rate FROM inputs i LEFT JOIN (SELECT output_id FROM outputs WHERE output_index < 4) o ON o.output_id = i.previous_output_id WHERE NOT i.is_coinbase")
def resolve_rate(c: Chain) -> DataFrame:
    held = c.lines.where("output_index < 4").select("output_id")
    own = c.inputs.where("not is_coinbase").select("previous_output_id").join(held, F.col("previous_output_id") == F.col("output_id"), "left")
    return own.agg(F.count("output_id").alias("hits"), F.count("*").alias("lookups"), (F.count("output_id") / F.count("*")).alias("rate"))


#: Every 97th block's parent is altered, so that the checks have something to find.
DAMAGED = "CASE WHEN height % 97 = 5 THEN 'x' || previous_hash ELSE previous_hash END"


@query(f"SELECT b.height, p.hash AS expected, b.ph AS actual FROM (SELECT height, {DAMAGED} AS ph FROM blocks) b JOIN blocks p ON p.height = b.height - 1 WHERE b.ph <> p.hash")
def reorg_detect(c: Chain) -> DataFrame:
    return chain_state.broken_parents(c.blocks.withColumn("previous_hash", F.expr(DAMAGED)))


@query("SELECT max(height) AS fork_height FROM (SELECT height, hash FROM blocks INTERSECT SELECT height, CASE WHEN height > 900 THEN 'fork' || hash ELSE hash END FROM blocks)")
def fork_point(c: Chain) -> DataFrame:
    return chain_state.fork_point(c.blocks, c.blocks.withColumn("hash", F.expr("case when height > 900 then concat('fork', hash) else hash end")))


@query("SELECT txid, block_height, total_output FROM transactions WHERE block_height <= 900")
def rollback(c: Chain) -> DataFrame:
    return chain_state.rollback(c.transactions, 900).select("txid", "block_height", "total_output")


@query("SELECT max(height) AS complete_height FROM blocks b WHERE tx_count = (SELECT count(*) FROM base t WHERE t.block_height = b.height AND (t.block_height < 1000 OR t.tx_index > 0))")
def crash_sync(c: Chain) -> DataFrame:
    return chain_state.complete_height(c.blocks, c.base.where("block_height < 1000 or tx_index > 0"))


@query("SELECT before + 1 AS expected, event_id AS got FROM (SELECT event_id, lag(event_id) OVER (ORDER BY event_id) AS before FROM events WHERE event_id % 53 <> 0) WHERE event_id <> before + 1")
def seq_gaps(c: Chain) -> DataFrame:
    return chain_state.sequence_gaps(c.table("events").where("event_id % 53 <> 0").select(F.col("event_id").alias("seq")))


@query("SELECT count(*) AS n, max(block_height) AS height, CAST(sum(amount) AS BIGINT) AS total FROM utxos")
def utxo_snapshot(c: Chain) -> DataFrame:
    return c.utxos.agg(F.count("*").alias("n"), F.max("block_height").alias("height"), F.sum("amount").alias("total"))


@query("SELECT txid, previous_txid = repeat('0', 64) AND previous_output_index = 4294967295 AND n = 1 AS is_coinbase FROM (SELECT *, count(*) OVER (PARTITION BY txid) AS n FROM inputs) WHERE input_index = 0")
def is_coinbase(c: Chain) -> DataFrame:
    n = c.inputs.groupBy("txid").agg(F.count("*").alias("n"), F.min("previous_txid").alias("p"), F.max("previous_output_index").alias("v"))
    return n.select("txid", ((F.col("n") == 1) & (F.col("p") == "0" * 64) & (F.col("v") == NO_OUTPUT)).alias("is_coinbase"))


@query("SELECT height, 65535.0::DOUBLE / (1 + height * 20) * pow(2.0::DOUBLE, 8 * (29 - (27 + height % 3))) AS difficulty FROM blocks")
def difficulty(c: Chain) -> DataFrame:
    bits = F.lpad(F.lower(F.hex((F.lit(27) + F.col("height") % 3) * (1 << 24) + F.lit(1) + F.col("height") * 20)), 8, "0")
    return c.blocks.select("height", fn.difficulty(bits).alias("difficulty"))


def scripts(c: Chain) -> DataFrame:
    """output_id, script: each output's script as hex, of the shape its class has; that of an UNKNOWN one is a broken P2PKH."""
    body = F.sha2(F.col("output_id"), 256)
    short = F.substring(body, 1, 40)
    made = {"P2PKH": F.concat(F.lit("76a914"), short, F.lit("88ac")), "P2SH": F.concat(F.lit("a914"), short, F.lit("87")), "P2WPKH": F.concat(F.lit("0014"), short), "P2WSH": F.concat(F.lit("0020"), body), "P2TR": F.concat(F.lit("5120"), body), "NULL_DATA": F.concat(F.lit("6a14"), short)}
    script = F.concat(F.lit("76a913"), short, F.lit("88ac"))
    for name, text in made.items():
        script = F.when(F.col("script_type") == name, text).otherwise(script)
    return c.lines.select("output_id", script.alias("script"))


@query("SELECT output_id, script_type FROM outputs")
def script_type(c: Chain) -> DataFrame:
    """The class of each output, told from its script alone."""
    return scripts(c).select("output_id", fn.script_type(F.col("script")).alias("script_type"))


@query("SELECT output_id, txid, output_index FROM outputs")
def utxo_key(c: Chain) -> DataFrame:
    """Keys made of transaction and index, and taken apart again."""
    key = fn.output_key(F.col("txid"), F.col("output_index"))
    return c.lines.select(key.alias("output_id"), fn.output_key_parts(key).alias("p")).select("output_id", "p.txid", "p.output_index")


DIGITS = ", ".join(f"instr('123456789abcdef', substr(txid, {2 * (32 - k)}, 1))" for k in fn.SHARD_BYTES)


@query(f"SELECT CAST(list_reduce([{DIGITS}, output_index % 16], lambda x, y: xor(x, y)) AS BIGINT) AS shard, count(*) AS n FROM outputs GROUP BY ALL")
def shard_sizes(c: Chain) -> DataFrame:
    return c.lines.groupBy(fn.shard(F.col("txid"), F.col("output_index")).alias("shard")).agg(F.count("*").alias("n"))


@query("SELECT output_id, CASE script_type WHEN 'P2PKH' THEN 0 WHEN 'P2SH' THEN 1 WHEN 'P2WPKH' THEN 2 WHEN 'P2WSH' THEN 3 WHEN 'P2TR' THEN 4 WHEN 'P2PK' THEN 5 WHEN 'NULL_DATA' THEN 6 ELSE 7 END AS tag FROM outputs")
def script_tag(c: Chain) -> DataFrame:
    return c.outputs.select("output_id", fn.script_tag(F.col("script_type")).alias("tag"))


@query("SELECT event_id, to_timestamp(1600000000 + event_id)::TIMESTAMP AS ts FROM events")
def epoch_ts(c: Chain) -> DataFrame:
    return c.table("events").select("event_id", F.timestamp_seconds(F.lit(1600000000) + F.col("event_id")).cast("timestamp_ntz").alias("ts"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM transactions WHERE ts >= TIMESTAMP '1995-01-01' GROUP BY ALL")
def day_trunc(c: Chain) -> DataFrame:
    return c.base.where(F.col("ts") >= F.lit("1995-01-01").cast("timestamp_ntz")).groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT input_id, previous_output_id FROM inputs")
def prev_output_id(c: Chain) -> DataFrame:
    return c.inputs.select("input_id", F.concat_ws(":", "previous_txid", "previous_output_index").alias("previous_output_id"))


@query("SELECT txid, fee FROM transactions")
def fee(c: Chain) -> DataFrame:
    return c.transactions.select("txid", "fee")


@query("SELECT o_orderkey AS k, CASE WHEN l = 0 THEN 'none' WHEN l < 500000000 THEN 'height' ELSE 'time' END AS kind FROM (SELECT o_orderkey, (o_orderkey % 3) * 300000000 AS l FROM orders)")
def locktime_kind(c: Chain) -> DataFrame:
    return c.table("orders").select(F.col("o_orderkey").alias("k"), fn.locktime_kind((F.col("o_orderkey") % 3) * 300000000).alias("kind"))


@query("SELECT o_orderkey AS k, s < 4294967294 AS rbf, s = 4294967295 AS final FROM (SELECT o_orderkey, 4294967295 - o_orderkey % 3 AS s FROM orders)")
def rbf_flag(c: Chain) -> DataFrame:
    s = F.lit(NO_OUTPUT) - F.col("o_orderkey") % 3
    return c.table("orders").select(F.col("o_orderkey").alias("k"), fn.signals_rbf(s).alias("rbf"), (s == NO_OUTPUT).alias("final"))


@query("SELECT o_orderkey AS k, CASE WHEN s <= 0 THEN 'n/a' WHEN s >= 3600 THEN (s // 3600) || 'h' || (s % 3600 // 60) || 'm' ELSE (s // 60) || 'm' END AS eta FROM (SELECT o_orderkey, (o_orderkey * 37) % 20000 - 100 AS s FROM orders)")
def format_eta(c: Chain) -> DataFrame:
    return c.table("orders").select(F.col("o_orderkey").alias("k"), fn.format_eta((F.col("o_orderkey") * 37) % 20000 - 100).alias("eta"))
