"""The investigation library as queries. Every limit has a total order: the unique id breaks ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import ledger, paths
from ledgerlens.plans.chain_view import Chain
from ledgerlens.plans.registry import query

A, B = "addr1", "addr2"


@query(f"SELECT t.txid, ts, amount_spent FROM performs p JOIN transactions t USING (txid) WHERE address = '{A}' ORDER BY ts DESC, txid LIMIT 100")
def tx_performed_by(c: Chain, address: str = A) -> DataFrame:
    own = c.performs.where(F.col("address") == address).select("txid", "amount_spent")
    return own.join(c.base.select("txid", "ts"), "txid").orderBy(F.desc("ts"), "txid").limit(100)


@query(f"SELECT t.txid, ts, amount_received FROM benefits_to p JOIN transactions t USING (txid) WHERE address = '{A}' ORDER BY ts DESC, txid LIMIT 100")
def tx_benefiting(c: Chain, address: str = A) -> DataFrame:
    own = c.benefits_to.where(F.col("address") == address).select("txid", "amount_received")
    return own.join(c.base.select("txid", "ts"), "txid").orderBy(F.desc("ts"), "txid").limit(100)


@query(f"SELECT '{A}' AS address, (SELECT list_sort(coalesce(list(DISTINCT txid), [])) FROM performs WHERE address = '{A}') AS sent, (SELECT list_sort(coalesce(list(DISTINCT txid), [])) FROM benefits_to WHERE address = '{A}') AS received")
def address_history(c: Chain, address: str = A) -> DataFrame:
    one = lambda t, name: t.where(F.col("address") == address).agg(F.sort_array(F.collect_set("txid")).alias(name))
    return one(c.performs, "sent").crossJoin(one(c.benefits_to, "received")).select(F.lit(address).alias("address"), "sent", "received")


@query(f"SELECT b.address AS recipient, count(*) AS n, CAST(sum(total_output) AS BIGINT) AS total FROM performs p JOIN transactions t USING (txid) JOIN benefits_to b USING (txid) WHERE p.address = '{A}' AND b.address <> '{A}' GROUP BY ALL ORDER BY n DESC, recipient LIMIT 50")
def first_degree(c: Chain, address: str = A) -> DataFrame:
    """Who receives from the address's transactions; the amount is that of the whole transaction.

    Only the outputs of those transactions are read on; sums are made of them alone.
    """
    spent = c.lines.where(F.col("address") == address).select(F.col("output_id").alias("previous_output_id"))
    own = c.inputs.where("not is_coinbase").select("txid", "previous_output_id").join(spent, "previous_output_id", "left_semi").select("txid").distinct()
    made = c.lines.select("txid", "address", "amount").join(own, "txid", "left_semi")
    each = made.groupBy("txid", "address").agg(F.sum("amount").alias("amount"))
    total = made.groupBy("txid").agg(F.sum("amount").alias("total_output"))
    to = each.where(F.col("address").isNotNull() & (F.col("address") != address)).select("txid", F.col("address").alias("recipient")).join(total, "txid")
    return to.groupBy("recipient").agg(F.count("*").alias("n"), F.sum("total_output").alias("total")).orderBy(F.desc("n"), "recipient").limit(50)


@query(f"SELECT output_id, amount, script_type FROM utxos WHERE address = '{A}' ORDER BY amount DESC, output_id")
def address_utxos(c: Chain, address: str = A) -> DataFrame:
    return c.utxos.where(F.col("address") == address).select("output_id", "amount", "script_type").orderBy(F.desc("amount"), "output_id")


@query(f"SELECT address, CAST(sum(amount) AS BIGINT) AS balance, count(*) AS n FROM utxos WHERE address = '{A}' GROUP BY ALL")
def address_balance(c: Chain, address: str = A) -> DataFrame:
    return c.utxos.where(F.col("address") == address).groupBy("address").agg(F.sum("amount").alias("balance"), F.count("*").alias("n"))


@query("SELECT s.output_id, s.input_id, s.txid FROM spends s WHERE s.output_id = (SELECT min(output_id) FROM spends)")
def spend_chain_literal(c: Chain) -> DataFrame:
    first = c.spends.agg(F.min("output_id").alias("output_id"))
    return c.spends.join(first, "output_id").select("output_id", "input_id", "txid")


@query(
    ", step AS (SELECT s.output_id, o.output_id AS next FROM spends s JOIN outputs o ON o.txid = s.txid), r(output_id, hop) AS (SELECT min(output_id), 0 FROM spends UNION SELECT next, hop + 1 FROM r JOIN step USING (output_id) WHERE hop < 10) SELECT DISTINCT output_id, CAST(hop AS BIGINT) AS hop FROM r",
    recursive=True,
)
def spend_chain(c: Chain) -> DataFrame:
    return paths.spend_chain(c.lines, c.spends, c.spends.agg(F.min("output_id").alias("output_id")))


EDGES = "SELECT address AS a, txid AS b FROM performs UNION SELECT txid, address FROM benefits_to"


def edges(c: Chain) -> DataFrame:
    return c.performs.select(F.col("address").alias("a"), F.col("txid").alias("b")).unionByName(c.benefits_to.select(F.col("txid").alias("a"), F.col("address").alias("b")))


@query(
    f", e AS MATERIALIZED ({EDGES}), s AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, hops) AS (SELECT 'addr1', 0 UNION SELECT s.b, hops + 1 FROM r JOIN s ON s.a = r.node WHERE hops < 10) SELECT hops, count(*) AS n FROM (SELECT node, CAST(min(hops) AS BIGINT) AS hops FROM r GROUP BY node) GROUP BY hops",
    address_column="l_partkey",
    recursive=True,
)
def path_distances(c: Chain) -> DataFrame:
    """How many nodes stand at each distance from addr1 over the edges of every block; nodes go by their keys."""
    return paths.distances_by_sides(c.edge_keys, int(A.removeprefix("addr"))).groupBy(F.col("hops").cast("long").alias("hops")).agg(F.count("*").alias("n"))


@query(
    f", e AS MATERIALIZED ({EDGES}), s AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, hops) AS (SELECT '{A}', 0 UNION SELECT s.b, hops + 1 FROM r JOIN s ON s.a = r.node WHERE hops < 10), d AS MATERIALIZED (SELECT node, CAST(min(hops) AS BIGINT) AS hops FROM r GROUP BY node), p(step, node) AS (SELECT hops, node FROM d WHERE node = '{B}' UNION ALL SELECT p.step - 1, min(s.a) FROM p JOIN s ON s.b = p.node JOIN d ON d.node = s.a AND d.hops = p.step - 1 GROUP BY p.step) SELECT step, node FROM p",
    address_column="l_partkey",
    recursive=True,
)
def shortest_path(c: Chain, source: str = A, target: str = B) -> DataFrame:
    """One shortest way that money went, in either direction, between two addresses: step, node (addresses and transactions in turn)."""
    return paths.shortest_path(edges(c), source, target)


@query("SELECT t.txid, (SELECT list_sort(list(DISTINCT r.input_id || '|' || r.output_id || '|' || r.address)) FROM resolved r WHERE r.txid = t.txid AND address IS NOT NULL) AS spent, (SELECT list_sort(list(DISTINCT o.output_id || '|' || o.address)) FROM outputs o WHERE o.txid = t.txid AND address IS NOT NULL) AS made FROM transactions t WHERE block_height = 1000")
def tx_detail(c: Chain) -> DataFrame:
    """Inputs and outputs of a block's transactions as sorted texts; sides without an address are null."""
    own = c.base.where("block_height = 1000").select("txid")
    spent = c.resolved.where("address is not null").join(own, "txid", "left_semi").groupBy("txid").agg(F.sort_array(F.collect_set(F.concat_ws("|", "input_id", "output_id", "address"))).alias("spent"))
    made = c.lines.where("address is not null").join(own, "txid", "left_semi").groupBy("txid").agg(F.sort_array(F.collect_set(F.concat_ws("|", "output_id", "address"))).alias("made"))
    return own.join(spent, "txid", "left").join(made, "txid", "left")


@query("SELECT r.txid, r.input_id, o.output_id, o.address, o.amount FROM resolved r JOIN outputs o ON o.txid = r.txid AND o.address = r.address ORDER BY o.output_id, r.input_id LIMIT 100")
def change_outputs(c: Chain) -> DataFrame:
    own = c.resolved.where("address is not null").select("txid", "address", "input_id").join(c.lines.select("txid", "address", "output_id", "amount"), ["txid", "address"])
    return own.select("txid", "input_id", "output_id", "address", "amount").orderBy("output_id", "input_id").limit(100)


@query("SELECT b.height, count(t.txid) AS n, CAST(coalesce(sum(total_output), 0) AS BIGINT) AS total, CAST(coalesce(sum(fee), 0) AS BIGINT) AS fees FROM blocks b LEFT JOIN transactions t ON t.block_height = b.height GROUP BY ALL")
def block_summary(c: Chain) -> DataFrame:
    own = c.transactions.groupBy(F.col("block_height").alias("height")).agg(F.count("*").alias("n"), F.sum("total_output").alias("total"), F.sum("fee").alias("fees"))
    return c.blocks.select("height").join(own, "height", "left").na.fill(0)


@query("SELECT txid, ts, total_output FROM transactions WHERE NOT is_coinbase AND ts BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31' ORDER BY total_output DESC, txid LIMIT 100")
def largest_txs(c: Chain) -> DataFrame:
    when = F.col("ts").between(F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz"))
    return c.transactions.where(~F.col("is_coinbase") & when).select("txid", "ts", "total_output").orderBy(F.desc("total_output"), "txid").limit(100)


@query("SELECT txid, total_output, fee FROM transactions WHERE total_output > 40000000 ORDER BY total_output DESC, txid LIMIT 100")
def large_txs_over(c: Chain) -> DataFrame:
    return c.transactions.where("total_output > 40000000").select("txid", "total_output", "fee").orderBy(F.desc("total_output"), "txid").limit(100)


@query("SELECT address, coalesce(s.n, 0) AS sent, coalesce(r.n, 0) AS received FROM addresses a LEFT JOIN (SELECT address, count(DISTINCT txid) AS n FROM performs GROUP BY ALL) s USING (address) LEFT JOIN (SELECT address, count(DISTINCT txid) AS n FROM benefits_to GROUP BY ALL) r USING (address) ORDER BY sent + received DESC, address LIMIT 100")
def most_active(c: Chain) -> DataFrame:
    n = lambda t, name: t.groupBy("address").agg(F.count("*").alias(name))  # noqa: E731 - (address, txid) is unique
    own = c.addresses.join(n(c.performs, "sent"), "address", "left").join(n(c.benefits_to, "received"), "address", "left").na.fill(0)
    return own.orderBy(F.desc(F.col("sent") + F.col("received")), "address").limit(100)


@query("SELECT address, CAST(sum(amount) AS BIGINT) AS balance FROM utxos WHERE address IS NOT NULL GROUP BY ALL HAVING sum(amount) > 1000000000 ORDER BY balance DESC, address")
def large_balances(c: Chain) -> DataFrame:
    return c.utxos.where("address is not null").groupBy("address").agg(F.sum("amount").alias("balance")).where("balance > 1000000000").orderBy(F.desc("balance"), "address")


@query("SELECT CAST(ts AS DATE) AS day, avg(fee) AS avg_fee, count(*) AS n FROM transactions WHERE NOT is_coinbase AND ts >= TIMESTAMP '1995-01-01' AND ts < TIMESTAMP '1996-01-01' GROUP BY ALL")
def fees_by_day(c: Chain) -> DataFrame:
    when = (F.col("ts") >= F.lit("1995-01-01").cast("timestamp_ntz")) & (F.col("ts") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return c.transactions.where(~F.col("is_coinbase") & when).groupBy(F.to_date("ts").alias("day")).agg(F.avg("fee").alias("avg_fee"), F.count("*").alias("n"))


@query("SELECT txid, i.n AS n_inputs, o.n AS n_outputs FROM (SELECT txid, count(*) AS n FROM inputs GROUP BY ALL HAVING count(*) >= 3) i JOIN (SELECT txid, count(*) AS n FROM outputs GROUP BY ALL HAVING count(*) >= 5) o USING (txid) ORDER BY n_inputs DESC, n_outputs DESC, txid LIMIT 100")
def mixing(c: Chain) -> DataFrame:
    """With lower bounds than the operator's own (10 and 10), which no transaction of the test tables reaches."""
    return ledger.mixing(c.inputs, c.lines, 3, 5)


@query("SELECT output_id, o.txid, ts FROM outputs o JOIN base USING (txid) WHERE script_type = 'NULL_DATA' ORDER BY ts DESC, output_id LIMIT 100")
def op_return(c: Chain) -> DataFrame:
    return c.lines.where("script_type = 'NULL_DATA'").select("output_id", "txid").join(c.base.select("txid", "ts"), "txid").orderBy(F.desc("ts"), "output_id").limit(100)


@query("SELECT h AS height, CASE WHEN EXISTS (SELECT 1 FROM blocks b WHERE b.height = h AND b.hash = x) THEN 'VERIFIED' ELSE 'MISMATCH' END AS state FROM (VALUES (10, sha256('blk:10')), (11, sha256('blk:12'))) v(h, x)")
def checkpoint_verify(c: Chain) -> DataFrame:
    points = c.spark.createDataFrame([(10, 10), (11, 12)], "height long, k long").select("height", F.sha2(F.concat(F.lit("blk:"), F.col("k").cast("string")), 256).alias("hash"))
    stored = c.blocks.select("height", "hash")
    good = points.join(stored, ["height", "hash"], "left_semi").select("height", F.lit("VERIFIED").alias("state"))
    return good.union(points.join(stored, ["height", "hash"], "left_anti").select("height", F.lit("MISMATCH").alias("state"))).distinct()


@query("SELECT max(height) AS height, max(height) >= 2000 AS is_synced FROM blocks")
def progress(c: Chain) -> DataFrame:
    return c.blocks.agg(F.max("height").alias("height"), (F.max("height") >= 2000).alias("is_synced"))


@query("SELECT output_id, amount, script_type, address FROM outputs WHERE output_id = sha256('tx:1') || ':0'")
def lookup_output(c: Chain) -> DataFrame:
    return c.lines.where(F.col("output_id") == F.concat(F.sha2(F.lit("tx:1"), 256), F.lit(":0"))).select("output_id", "amount", "script_type", "address")


@query("SELECT output_id, amount, address FROM utxos ORDER BY amount DESC, output_id LIMIT 100000")
def all_utxos(c: Chain) -> DataFrame:
    return c.utxos.select("output_id", "amount", "address").orderBy(F.desc("amount"), "output_id").limit(100_000)


@query("SELECT txid, ts FROM base WHERE ts >= TIMESTAMP '1998-01-01'")
def tx_since(c: Chain) -> DataFrame:
    return c.base.where(F.col("ts") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("txid", "ts")
