"""Integrity rules as queries: each returns its violations. Rules that the chain view can't break run on damaged variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import chain_state, ledger
from ledgerlens.plans.chain_view import Chain
from ledgerlens.plans.registry import query


@query("SELECT txid, total_input, total_output, fee, total_input - total_output - fee AS discrepancy FROM transactions WHERE NOT is_coinbase AND total_input <> total_output + fee")
def v_balance(c: Chain) -> DataFrame:
    return c.transactions.where("not is_coinbase and total_input <> total_output + fee").select("txid", "total_input", "total_output", "fee", F.expr("total_input - total_output - fee").alias("discrepancy"))


@query("SELECT txid FROM transactions WHERE is_coinbase AND (total_input <> 0 OR fee <> 0)")
def v_coinbase_amounts(c: Chain) -> DataFrame:
    return c.transactions.where("is_coinbase and (total_input <> 0 or fee <> 0)").select("txid")


@query("SELECT input_id FROM inputs i WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.txid = i.txid AND b.tx_index <> 1)")
def v_orphan_inputs(c: Chain) -> DataFrame:
    return c.inputs.join(c.base.where("tx_index <> 1").select("txid"), "txid", "left_anti").select("input_id")


@query("SELECT output_id FROM outputs o WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.txid = o.txid AND b.tx_index <> 2)")
def v_orphan_outputs(c: Chain) -> DataFrame:
    return c.lines.join(c.base.where("tx_index <> 2").select("txid"), "txid", "left_anti").select("output_id")


@query("SELECT input_id, txid FROM inputs i WHERE NOT is_coinbase AND NOT EXISTS (SELECT 1 FROM spends s WHERE s.input_id = i.input_id AND s.block_height % 50 <> 3)")
def v_missing_spends(c: Chain) -> DataFrame:
    return c.inputs.where("not is_coinbase").join(c.spends.where("block_height % 50 <> 3").select("input_id"), "input_id", "left_anti").select("input_id", "txid")


@query("SELECT input_id FROM inputs i WHERE is_coinbase AND EXISTS (SELECT 1 FROM spends s WHERE s.input_id = i.input_id)")
def v_coinbase_spends(c: Chain) -> DataFrame:
    return c.inputs.where("is_coinbase").join(c.spends.select("input_id"), "input_id", "left_semi").select("input_id")


@query("SELECT output_id, script_type FROM outputs WHERE script_type NOT IN ('NULL_DATA', 'UNKNOWN') AND CASE WHEN amount % 1000 = 7 THEN NULL ELSE address END IS NULL")
def v_missing_address(c: Chain) -> DataFrame:
    damaged = c.lines.withColumn("address", F.expr("case when amount % 1000 = 7 then null else address end"))
    return damaged.where("script_type not in ('NULL_DATA', 'UNKNOWN') and address is null").select("output_id", "script_type")


@query("SELECT output_id FROM outputs WHERE script_type = 'NULL_DATA' AND CASE WHEN amount % 1000 = 7 THEN 'x' ELSE address END IS NOT NULL")
def v_nulldata_address(c: Chain) -> DataFrame:
    damaged = c.lines.withColumn("address", F.expr("case when amount % 1000 = 7 then 'x' else address end"))
    return damaged.where("script_type = 'NULL_DATA' and address is not null").select("output_id")


@query("SELECT output_id FROM outputs_v v WHERE is_spent AND NOT EXISTS (SELECT 1 FROM spends s WHERE s.output_id = v.output_id AND s.block_height % 50 <> 3)")
def v_spent_no_spender(c: Chain) -> DataFrame:
    return c.outputs_v.where("is_spent").join(c.spends.where("block_height % 50 <> 3").select("output_id"), "output_id", "left_anti").select("output_id")


@query("SELECT output_id FROM outputs_v v WHERE NOT (is_spent AND amount % 1000 <> 7) AND EXISTS (SELECT 1 FROM spends s WHERE s.output_id = v.output_id)")
def v_spender_not_marked(c: Chain) -> DataFrame:
    return c.outputs_v.where("not (is_spent and amount % 1000 <> 7)").join(c.spends.select("output_id"), "output_id", "left_semi").select("output_id")


@query("SELECT v.output_id, v.spent_in_txid, s.txid AS spender FROM (SELECT output_id, CASE WHEN amount % 1000 = 7 THEN 'x' ELSE spent_in_txid END AS spent_in_txid FROM outputs_v) v JOIN spends s USING (output_id) WHERE v.spent_in_txid <> s.txid")
def v_spent_txid(c: Chain) -> DataFrame:
    own = c.outputs_v.select("output_id", F.expr("case when amount % 1000 = 7 then 'x' else spent_in_txid end").alias("spent_in_txid"))
    return own.join(c.spends.select("output_id", F.col("txid").alias("spender")), "output_id").where("spent_in_txid <> spender")


@query("SELECT height FROM (SELECT height, max(height) OVER () AS top FROM blocks b WHERE height > 0 AND NOT EXISTS (SELECT 1 FROM blocks n WHERE n.height = b.height + 1 AND n.height % 97 <> 5)) WHERE height < top")
def v_next_block(c: Chain) -> DataFrame:
    linked = c.blocks.where("height % 97 <> 5").select((F.col("height") - 1).alias("height"))
    bad = c.blocks.where("height > 0").select("height").join(linked, "height", "left_anti")
    return bad.join(bad.agg(F.max("height").alias("top")), F.col("height") < F.col("top")).select("height")


@query("SELECT height, nxt FROM (SELECT height, lead(height) OVER (ORDER BY height) AS nxt FROM blocks WHERE height % 97 <> 5) WHERE nxt <> height + 1")
def v_height_gaps(c: Chain) -> DataFrame:
    return chain_state.height_gaps(c.blocks.where("height % 97 <> 5"))


@query("SELECT b.height FROM (SELECT height, CASE WHEN height % 97 = 5 THEN 'x' ELSE previous_hash END AS ph FROM blocks) b JOIN blocks p ON p.height = b.height - 1 WHERE ph <> p.hash")
def v_prev_hash(c: Chain) -> DataFrame:
    own = c.blocks.select("height", F.expr("case when height % 97 = 5 then 'x' else previous_hash end").alias("ph"))
    return own.join(c.blocks.select((F.col("height") + 1).alias("height"), "hash"), "height").where("ph <> hash").select("height")


def _linked(c: Chain) -> DataFrame:
    return c.base.where("block_height % 97 <> 5 or tx_index > 0")


@query("SELECT height, tx_count, actual FROM (SELECT height, tx_count, (SELECT count(*) FROM base t WHERE t.block_height = height AND (block_height % 97 <> 5 OR tx_index > 0)) AS actual FROM blocks) WHERE tx_count <> actual")
def v_tx_count(c: Chain) -> DataFrame:
    n = _linked(c).groupBy(F.col("block_height").alias("height")).agg(F.count("*").alias("actual"))
    return c.blocks.select("height", "tx_count").join(n, "height", "left").na.fill(0).where("tx_count <> actual")


@query("SELECT height FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM base t WHERE t.block_height = b.height AND t.block_height % 97 <> 5)")
def v_empty_blocks(c: Chain) -> DataFrame:
    return c.blocks.join(c.base.where("block_height % 97 <> 5").select(F.col("block_height").alias("height")), "height", "left_anti").select("height")


@query("SELECT block_height, min_by(txid, tx_index) AS txid FROM base GROUP BY block_height HAVING NOT min_by(is_coinbase, tx_index)")
def v_first_coinbase(c: Chain) -> DataFrame:
    first = c.base.groupBy("block_height").agg(F.min_by(F.struct("txid", "is_coinbase"), "tx_index").alias("f"))
    return first.where("not f.is_coinbase").select("block_height", "f.txid")


@query("SELECT block_height, min(txid) AS txid FROM base GROUP BY block_height HAVING NOT min_by(is_coinbase, txid)")
def v_first_coinbase_by_txid(c: Chain) -> DataFrame:
    first = c.base.groupBy("block_height").agg(F.min(F.struct("txid", "is_coinbase")).alias("f"))
    return first.where("not f.is_coinbase").select("block_height", "f.txid")


@query("SELECT address, txid FROM performs JOIN base USING (txid) WHERE is_coinbase")
def v_performs_coinbase(c: Chain) -> DataFrame:
    return c.performs.join(c.base.where("is_coinbase").select("txid"), "txid", "left_semi").select("address", "txid")


@query("SELECT address, txid FROM performs p WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.txid = p.txid AND r.address = p.address AND r.amount % 1000 <> 7)")
def v_performs_addr(c: Chain) -> DataFrame:
    return c.performs.join(c.resolved.where("amount % 1000 <> 7").select("txid", "address"), ["txid", "address"], "left_anti").select("address", "txid")


@query("SELECT address, txid FROM benefits_to p WHERE NOT EXISTS (SELECT 1 FROM outputs o WHERE o.txid = p.txid AND o.address = p.address AND o.amount % 1000 <> 7)")
def v_benefits_addr(c: Chain) -> DataFrame:
    return c.benefits_to.join(c.lines.where("amount % 1000 <> 7").select("txid", "address"), ["txid", "address"], "left_anti").select("address", "txid")


@query("SELECT address, txid FROM performs WHERE nullif(input_count, 2) IS NULL OR amount_spent IS NULL")
def v_performs_null(c: Chain) -> DataFrame:
    return c.performs.withColumn("input_count", F.expr("nullif(input_count, 2)")).where("input_count is null or amount_spent is null").select("address", "txid")


@query("SELECT address, txid FROM benefits_to WHERE nullif(output_count, 2) IS NULL OR amount_received IS NULL")
def v_benefits_null(c: Chain) -> DataFrame:
    return c.benefits_to.withColumn("output_count", F.expr("nullif(output_count, 2)")).where("output_count is null or amount_received is null").select("address", "txid")


@query("SELECT p.address, p.txid, p.amount_spent AS recorded, CAST(sum(r.amount) AS BIGINT) AS actual, p.input_count, count(*) AS actual_count FROM (SELECT address, txid, amount_spent, input_count + CASE WHEN amount_spent % 1000 = 9 THEN 1 ELSE 0 END AS input_count FROM performs) p JOIN resolved r ON r.txid = p.txid AND r.address = p.address AND r.amount % 1000 <> 7 GROUP BY ALL HAVING p.amount_spent <> sum(r.amount) OR p.input_count <> count(*)")
def v_performs_sum(c: Chain) -> DataFrame:
    """Recorded sums or counts that differ from those of the inputs; here some inputs and some counts are damaged."""
    real = c.resolved.where("address is not null and amount % 1000 <> 7").groupBy("address", "txid").agg(F.sum("amount").alias("actual"), F.count("*").alias("actual_count"))
    own = c.performs.select("address", "txid", F.col("amount_spent").alias("recorded"), F.expr("input_count + case when amount_spent % 1000 = 9 then 1 else 0 end").alias("input_count"))
    return own.join(real, ["address", "txid"]).where("recorded <> actual or input_count <> actual_count").select("address", "txid", "recorded", "actual", "input_count", "actual_count")


@query("SELECT p.address, p.txid, p.amount_received AS recorded, CAST(sum(o.amount) AS BIGINT) AS actual, p.output_count, count(*) AS actual_count FROM (SELECT address, txid, amount_received, output_count + CASE WHEN amount_received % 1000 = 9 THEN 1 ELSE 0 END AS output_count FROM benefits_to) p JOIN outputs o ON o.txid = p.txid AND o.address = p.address AND o.amount % 1000 <> 7 GROUP BY ALL HAVING p.amount_received <> sum(o.amount) OR p.output_count <> count(*)")
def v_benefits_sum(c: Chain) -> DataFrame:
    """Recorded sums or counts that differ from those of the outputs; here some outputs and some counts are damaged."""
    real = c.lines.where("address is not null and amount % 1000 <> 7").groupBy("address", "txid").agg(F.sum("amount").alias("actual"), F.count("*").alias("actual_count"))
    own = c.benefits_to.select("address", "txid", F.col("amount_received").alias("recorded"), F.expr("output_count + case when amount_received % 1000 = 9 then 1 else 0 end").alias("output_count"))
    return own.join(real, ["address", "txid"]).where("recorded <> actual or output_count <> actual_count").select("address", "txid", "recorded", "actual", "output_count", "actual_count")


@query("SELECT txid FROM transactions WHERE nullif(total_output, 0) IS NULL OR total_input IS NULL OR fee IS NULL")
def v_tx_nulls(c: Chain) -> DataFrame:
    return c.transactions.withColumn("total_output", F.expr("nullif(total_output, 0)")).where("total_output is null or total_input is null or fee is null").select("txid")


@query("SELECT txid, output_index FROM (SELECT txid, output_index, script_type, CASE WHEN amount % 1000 = 7 THEN NULL ELSE amount END AS amount, CASE WHEN amount % 1000 = 8 THEN NULL ELSE output_id END AS output_id, CASE WHEN amount % 1000 = 9 THEN NULL ELSE is_spent END AS is_spent FROM outputs_v) WHERE output_id IS NULL OR amount IS NULL OR script_type IS NULL OR is_spent IS NULL")
def v_output_nulls(c: Chain) -> DataFrame:
    """Outputs without key, amount, class or spent flag; here one in a thousand has no amount, key or flag."""
    gone = lambda name, k: F.expr(f"case when amount % 1000 = {k} then null else {name} end").alias(name)
    damaged = c.outputs_v.select("txid", "output_index", "script_type", gone("amount", 7), gone("output_id", 8), gone("is_spent", 9))
    return damaged.where("output_id is null or amount is null or script_type is null or is_spent is null").select("txid", "output_index")


@query("SELECT txid, input_index, previous_output_id FROM (SELECT txid, previous_output_id, nullif(input_index, 3) AS input_index, CASE WHEN input_index = 2 AND block_height % 5 = 0 THEN NULL ELSE input_id END AS input_id FROM inputs) WHERE input_id IS NULL OR input_index IS NULL")
def v_input_nulls(c: Chain) -> DataFrame:
    """Inputs without key or index; here every fourth one of a transaction has no index, and some third ones no key."""
    damaged = c.inputs.select("txid", "previous_output_id", F.expr("nullif(input_index, 3)").alias("input_index"), F.expr("case when input_index = 2 and block_height % 5 = 0 then null else input_id end").alias("input_id"))
    return damaged.where("input_id is null or input_index is null").select("txid", "input_index", "previous_output_id")


@query("SELECT output_id, count(*) AS n FROM (SELECT output_id FROM spends UNION ALL SELECT output_id FROM spends WHERE block_height % 50 = 3) GROUP BY ALL HAVING count(*) > 1")
def v_double_spend(c: Chain) -> DataFrame:
    own = c.spends.select("output_id")
    return own.unionByName(c.spends.where("block_height % 50 = 3").select("output_id")).groupBy("output_id").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT output_id, is_spent FROM outputs_v JOIN base USING (txid) WHERE base.block_height = 0 AND is_coinbase")
def v_genesis_unspent(c: Chain) -> DataFrame:
    return c.outputs_v.join(c.base.where("block_height = 0 and is_coinbase").select("txid"), "txid", "left_semi").select("output_id", "is_spent")


@query("SELECT count(*) AS n, CAST(sum(amount) AS BIGINT) AS total FROM utxos")
def v_utxo_set(c: Chain) -> DataFrame:
    return c.utxos.agg(F.count("*").alias("n"), F.sum("amount").alias("total"))


@query("SELECT txid, block_height, fee, total_input, total_output FROM transactions WHERE NOT is_coinbase AND fee > 5000000 ORDER BY fee DESC, txid LIMIT 100")
def v_high_fees(c: Chain) -> DataFrame:
    """With a lower bound than the operator's own (100,000,000), which no transaction of the test tables reaches."""
    return ledger.high_fees(c.transactions, 5_000_000).select("txid", "block_height", "fee", "total_input", "total_output")


@query("SELECT txid, fee FROM transactions WHERE NOT is_coinbase AND fee < 0")
def v_negative_fees(c: Chain) -> DataFrame:
    return c.transactions.where("not is_coinbase and fee < 0").select("txid", "fee")


KEYS = [("blocks", "height"), ("blocks", "hash"), ("transactions", "txid"), ("outputs", "output_id"), ("inputs", "input_id"), ("addresses", "address")]


@query(" UNION ALL ".join(f"SELECT '{t}.{k}' AS key, count(*) - count(DISTINCT {k}) AS duplicates FROM {t if t != 'transactions' else 'base'}" for t, k in KEYS))
def v_constraints(c: Chain) -> DataFrame:
    """Rows beyond the first of each key, for the keys that must be unique."""
    source = {"blocks": c.blocks, "transactions": c.base, "outputs": c.lines, "inputs": c.inputs, "addresses": c.addresses}
    parts = [source[t].groupBy(k).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")).select(F.lit(f"{t}.{k}").alias("key"), "duplicates") for t, k in KEYS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SUMMARY = {
    "blocks": "SELECT count(*) FROM blocks", "height": "SELECT max(height) FROM blocks", "transactions": "SELECT count(*) FROM base", "coinbases": "SELECT count(*) FROM base WHERE is_coinbase", "outputs": "SELECT count(*) FROM outputs", "inputs": "SELECT count(*) FROM inputs",
    "addresses": "SELECT count(*) FROM addresses", "spends": "SELECT count(*) FROM spends", "performs": "SELECT count(*) FROM performs", "benefits_to": "SELECT count(*) FROM benefits_to", "utxos": "SELECT count(*) FROM utxos", "total_satoshis": "SELECT CAST(sum(amount) AS BIGINT) FROM utxos",
    "balance_errors": "SELECT count(*) FROM transactions WHERE NOT is_coinbase AND total_input <> total_output + fee", "orphaned_inputs": "SELECT count(*) FROM inputs i WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.txid = i.txid)",
    "orphaned_outputs": "SELECT count(*) FROM outputs o WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.txid = o.txid)", "missing_spends": "SELECT count(*) FROM inputs i WHERE NOT is_coinbase AND NOT EXISTS (SELECT 1 FROM spends s WHERE s.input_id = i.input_id)",
}


@query("SELECT " + ", ".join(f"({sql}) AS {name}" for name, sql in SUMMARY.items()))
def v_summary(c: Chain) -> DataFrame:
    """All counters of the chain in one row.

    Outputs meet what refers to them in one join by output, and all that belongs to a transaction in one by transaction;
    both sides are summed before. Each relation is read for one aggregate that has all its counters.
    """
    n = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    refs = c.inputs.where("not is_coinbase").groupBy(F.col("previous_output_id").alias("output_id")).agg(F.count("*").alias("refs"))
    states = c.lines.select("output_id", "amount").withColumn("there", F.lit(True)).join(refs, "output_id", "full")
    here, free = F.col("there").isNotNull(), F.col("there").isNotNull() & F.col("refs").isNull()
    resolved = ledger.resolve_inputs(c.inputs, c.lines)
    made = c.lines.groupBy("txid").agg(F.sum("amount").alias("made"), F.count("*").alias("outputs"))
    took = c.inputs.groupBy("txid").agg(F.count("*").alias("inputs"))
    spent = resolved.groupBy("txid").agg(F.sum("amount").alias("spent"))
    by_tx = c.base.select("txid", "is_coinbase").join(made, "txid", "full").join(took, "txid", "full").join(spent, "txid", "left").na.fill(0, ["made", "spent"])
    wrong = ~F.col("is_coinbase") & (F.col("spent") != F.col("made") + ledger.floor_fee(F.col("spent"), F.col("made")))
    lost = lambda name: F.coalesce(F.sum(F.when(F.col("is_coinbase").isNull(), F.col(name))), F.lit(0)).alias(f"orphaned_{name}")
    one = [
        c.blocks.agg(F.count("*").alias("blocks"), F.max("height").alias("height")),
        by_tx.agg(F.count("is_coinbase").alias("transactions"), F.count_if("is_coinbase").alias("coinbases"), F.count_if(wrong).alias("balance_errors"), n("outputs"), n("inputs"), lost("outputs"), lost("inputs")),
        states.agg(F.count_if(free).alias("utxos"), F.sum(F.when(free, F.col("amount"))).alias("total_satoshis"), F.coalesce(F.sum(F.when(here, F.col("refs"))), F.lit(0)).alias("spends"), F.coalesce(F.sum(F.when(~here, F.col("refs"))), F.lit(0)).alias("missing_spends")),
        resolved.where("address is not null").select("address", "txid").distinct().agg(F.count("*").alias("performs")),
        c.lines.where("address is not null").groupBy("address", "txid").agg(F.lit(1).alias("x")).groupBy("address").agg(F.count("*").alias("k")).agg(F.count("*").alias("addresses"), F.sum("k").alias("benefits_to")),
    ]
    out = one[0]
    for row in one[1:]:
        out = out.crossJoin(row)  # one row each
    return out.select(*SUMMARY)


@query("SELECT b.hash AS block_hash, t.txid, o.amount, o.address FROM blocks b JOIN base t ON t.block_height = b.height JOIN outputs o ON o.txid = t.txid WHERE b.height = 0 AND o.address IS NOT NULL")
def v_genesis(c: Chain) -> DataFrame:
    """The first block's hash, transactions, and amounts that went to an address."""
    block = c.blocks.where("height = 0").select(F.col("height").alias("block_height"), F.col("hash").alias("block_hash"))
    own = c.base.where("block_height = 0").select("txid", "block_height").join(block, "block_height")
    return own.join(c.lines.where("address is not null").select("txid", "amount", "address"), "txid").select("block_hash", "txid", "amount", "address")


@query("SELECT sha256('tx:1') AS txid, (SELECT list_sort(coalesce(list(input_id), [])) FROM inputs WHERE txid = sha256('tx:1')) AS ins, (SELECT list_sort(coalesce(list(output_id), [])) FROM outputs WHERE txid = sha256('tx:1')) AS outs")
def v_known_tx(c: Chain) -> DataFrame:
    txid = F.sha2(F.lit("tx:1"), 256)
    ins = c.inputs.where(F.col("txid") == txid).agg(F.sort_array(F.collect_set("input_id")).alias("ins"))
    outs = c.lines.where(F.col("txid") == txid).agg(F.sort_array(F.collect_set("output_id")).alias("outs"))
    return ins.crossJoin(outs).select(txid.alias("txid"), "ins", "outs")
