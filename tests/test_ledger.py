import os
import random
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ledgerlens.functions import columns as fn
from ledgerlens.operators import chain_state, ledger, paths
from ledgerlens.plans import investigation, registry
from ledgerlens.plans.chain_view import Chain

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "events"]
#: The other queries pass a relation on, or are compared at a larger scale elsewhere.
CHECKED = [n for n in registry.SQL if n.startswith("v_") or hasattr(investigation, n)] + ["tx_amounts", "performs", "utxo_set", "seq_gaps", "reorg_detect", "block_mem_estimate", "format_eta", "script_type", "utxo_key", "shard_sizes", "crash_sync", "bip30_dedup"]


@pytest.fixture(scope="module")
def answers(spark):
    """name: (columns, rows as text) of each query, several at a time: planning takes most of their time at this scale."""
    queries = __spark_entry__.queries()

    def run(name):
        got = queries[name](spark, SF)
        cols = sorted(got.columns)
        return cols, sorted(str([row[c] for c in cols]) for row in got.collect())

    with ThreadPoolExecutor(8) as pool:
        yield {name: pool.submit(run, name) for name in CHECKED}


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(answers, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cols, got = answers[name].result()
    r = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert got == sorted(str([row[names.index(c)] for c in cols]) for row in r.fetchall())


def test_every_query_has_a_name_and_most_have_sql():
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and len(q) > 100


def test_chunks():
    assert ledger.adaptive_chunks([], 10) == []
    assert ledger.adaptive_chunks([50], 10) == [(0, 1)]
    assert ledger.adaptive_chunks([1] * 200, 1000) == [(0, 200)]
    assert ledger.adaptive_chunks([4, 4, 4, 20, 1, 1], 8) == [(0, 2), (2, 3), (3, 4), (4, 6)]


def test_unresolved_inputs(spark):
    inputs = spark.createDataFrame([("a:0", "a", 1, "x:0", False, 0), ("a:1", "a", 1, "gone:0", False, 0)], "input_id string, txid string, block_height long, previous_output_id string, is_coinbase boolean, previous_output_index long")
    outputs = spark.createDataFrame([("x:0", 5, "addr", "P2PKH")], "output_id string, amount long, address string, script_type string")
    assert ledger.resolve_inputs(inputs, outputs).count() == 1
    with pytest.raises(Exception, match="unresolved input a:1"):
        ledger.resolve_inputs(inputs, outputs, "error").collect()


def test_script_types(spark):
    cases = {
        "76a914" + "89abcdef" + "abbaabba" * 4 + "88ac": "P2PKH", "a914" + "00" * 20 + "87": "P2SH", "0014751e76e8199196d454941c45d1b3a323f1433bd6": "P2WPKH", "0020" + "ab" * 32: "P2WSH", "5120" + "79" * 32: "P2TR",
        "6a0548656c6c6f": "NULL_DATA", "ff": "UNKNOWN", "": "UNKNOWN", "76a913" + "00" * 19 + "88ac": "UNKNOWN", "5220" + "00" * 32: "UNKNOWN", "2102" + "79" * 32 + "ac": "P2PK",
    }
    df = spark.createDataFrame(list(cases.items()), "script string, want string")
    assert [(r.got, r.want) for r in df.select(fn.script_type(df.script).alias("got"), "want").where("got <> want").collect()] == []


def test_difficulty(spark):
    df = spark.createDataFrame([("1d00ffff",), ("1b0404cb",)], "bits string")
    assert [r.d for r in df.select(fn.difficulty(df.bits).alias("d")).collect()] == pytest.approx([1.0, 16307.420938523983])


def test_paths_and_gaps(spark):
    edges = spark.createDataFrame([("a", "t1"), ("t1", "b"), ("b", "t2"), ("t2", "c"), ("x", "y")], "a string, b string")
    assert [r.hops for r in paths.shortest_hops(edges, "a", "c").collect()] == [4]
    assert paths.shortest_hops(edges, "a", "x").collect() == [] and paths.shortest_hops(edges, "a", "c", 3).collect() == []
    assert [tuple(r) for r in paths.shortest_path(edges, "a", "a").collect()] == [(0, "a")]
    assert [r.node for r in paths.shortest_path(edges, "a", "c").orderBy("step").collect()] == ["a", "t1", "b", "t2", "c"]
    blocks = spark.createDataFrame([(0,), (1,), (4,), (9,)], "height long")
    assert sorted(map(tuple, chain_state.height_gaps(blocks).collect())) == [(1, 4), (4, 9)]
    notes = spark.createDataFrame([(1,), (2,), (5,), (6,), (9,)], "seq long")
    assert sorted(map(tuple, chain_state.sequence_gaps(notes, bucket=3).collect())) == [(3, 5), (7, 9)]


def test_path_distances_take_every_block(spark):
    c = Chain(spark, SF, "l_partkey")
    near = {}
    for a, b in investigation.edges(c).collect():
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    hops, front = {"addr1": 0}, ["addr1"]
    for hop in range(1, 11):
        front = sorted({b for a in front for b in near.get(a, ()) if b not in hops})
        hops |= dict.fromkeys(front, hop)
    want = sorted((h, sum(x == h for x in hops.values())) for h in set(hops.values()))
    got = sorted((r.hops, r.n) for r in __spark_entry__.queries()["path_distances"](spark, SF).collect())
    assert got == want
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert got == sorted(con.execute(__spark_entry__.oracle_sql()["path_distances"]).fetchall())
    # each transaction with an address in its outputs is a node of the graph, whatever its block
    assert {r.txid for r in c.benefits_to.select("txid").distinct().collect()} <= set(near)


def test_path_distances_write_keys_alone(spark, monkeypatch):
    """What is written between steps are keys, not ids of 64 characters both ways: those took the disk of a larger chain."""
    frame = type(spark.range(0))
    kinds, write = set(), frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a, **b: (kinds.update(kind for _, kind in df.dtypes), write(df, *a, **b))[1])
    assert __spark_entry__.queries()["path_distances"](spark, SF).count() > 3
    assert kinds == {"bigint", "array<bigint>"}


def test_edge_keys_are_the_edges(spark):
    for column in ("l_partkey", "l_suppkey"):
        c = Chain(spark, SF, column)
        keys = c.edge_keys.select("left", F.explode("rights").alias("right")).distinct()
        named = keys.select(F.sha2(F.concat(F.lit("tx:"), F.col("left").cast("string")), 256).alias("t"), F.concat(F.lit("addr"), F.col("right").cast("string")).alias("a"))
        want = c.performs.select("txid", "address").unionByName(c.benefits_to.select("txid", "address")).distinct()
        assert sorted(map(tuple, named.collect())) == sorted(map(tuple, want.collect()))


def test_distances_by_sides_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(25), rng.sample(range(25), rng.randrange(3))) for _ in range(30)]
    near = {}
    for left, rights in rows:
        for right in rights:
            near.setdefault(("l", left), set()).add(("r", right))
            near.setdefault(("r", right), set()).add(("l", left))
    frame = spark.createDataFrame(rows, "left long, rights array<long>")
    for source, most in ((0, 10), (7, 3), (99, 10)):
        hops, front = {("r", source): 0}, [("r", source)]
        for hop in range(1, most + 1):
            front = sorted({b for a in front for b in near.get(a, ()) if b not in hops})
            hops |= dict.fromkeys(front, hop)
        assert sorted(map(tuple, paths.distances_by_sides(frame, source, most).collect())) == sorted((node, h) for (_, node), h in hops.items())
    nulls = spark.createDataFrame([(None, [1, 2]), (5, [1, 2]), (6, [2, 3]), (None, [3])], "left long, rights array<long>")
    assert sorted(map(tuple, paths.distances_by_sides(nulls, 1).collect()), key=str) == sorted([(1, 0), (5, 1), (None, 1), (2, 2), (6, 3), (3, 4)], key=str)


def test_imports_without_the_text_part():
    import subprocess
    import sys

    code = "import sys; sys.modules['ledgerlens.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert not any(n.startswith('op1_') for n in e.queries()) and 'first_degree' in e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.abspath(__spark_entry__.__file__))).returncode == 0


def test_shortest_paths_equal_brute_force(spark):
    rng = random.Random(3)
    edges = sorted({tuple(rng.sample(range(30), 2)) for _ in range(34)})
    near = {k: set() for k in range(30)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    frame = spark.createDataFrame([(f"n{a:02}", f"n{b:02}") for a, b in edges], "a string, b string").cache()
    for source, target in [rng.sample(range(30), 2) for _ in range(6)]:
        hops, front = {source: 0}, [source]
        while front:
            front = [b for a in front for b in near[a] if b not in hops and not hops.update({b: hops[a] + 1})]
        want = []
        if hops.get(target, 99) <= 10:
            want = [target]
            while want[0] != source:
                want.insert(0, min(b for b in near[want[0]] if hops.get(b) == hops[want[0]] - 1))
        got = [r.node for r in paths.shortest_path(frame, f"n{source:02}", f"n{target:02}").orderBy("step").collect()]
        assert got == [f"n{k:02}" for k in want]


def test_known_answers(spark):
    """Literal values from the definitions, not from this code."""
    one = lambda n, name, first: spark.createDataFrame([(7, k) for k in range(n)], f"block_height long, {name} long") if first else None
    blocks = spark.createDataFrame([(7,), (8,)], "height long")
    got = {r.height: r.bytes for r in ledger.block_memory(blocks, one(90, "t", True), one(270, "o", True), one(270, "i", True)).collect()}
    assert got == {7: 3500 + 90 * 3000 + 270 * 3500 + 270 * 2500, 8: 3500} and got[7] == 1_893_500
    seconds = spark.createDataFrame([(91440.0,), (2520.0,), (0.0,), (-5.0,), (None,), (0.5,), (3599.9,), (3600.0,)], "s double")
    assert [r.e for r in seconds.select(fn.format_eta(seconds.s).alias("e")).collect()] == ["25h24m", "42m", "n/a", "n/a", "n/a", "0m", "59m", "1h0m"]
    tx = spark.createDataFrame([("a", False, 100_000_000), ("b", False, 100_000_001), ("c", True, 900_000_000)], "txid string, is_coinbase boolean, fee long")
    assert [r.txid for r in ledger.high_fees(tx).collect()] == ["b"]
    rows = lambda n, m: spark.createDataFrame([("x",)] * n + [("y",)] * m, "txid string")
    assert [tuple(r) for r in ledger.mixing(rows(10, 9), rows(10, 12)).collect()] == [("x", 10, 10)]
    txid = "0f" + "00" * 30 + "30"  # as shown; the last byte is the first in internal order
    keys = spark.createDataFrame([(txid, 0), (txid, 1), ("ab" * 32, 2)], "txid string, n long")
    assert [r.k for r in keys.select(fn.shard(keys.txid, keys.n).alias("k")).collect()] == [15, 14, 9]
    texts = spark.createDataFrame([("AB" * 32, 3), ("zz", 3)], "txid string, n int")
    made = [r.k for r in texts.select(fn.output_key(texts.txid, texts.n).alias("k")).collect()]
    assert made == ["ab" * 32 + ":3", None]
    parts = spark.createDataFrame([("ab" * 32 + ":3",), ("ab:3",), (None,)], "k string")
    assert [r.p and tuple(r.p) for r in parts.select(fn.output_key_parts(parts.k).alias("p")).collect()] == [("ab" * 32, 3), None, None]


def test_summary_counts_damage(spark):
    """The summary's counters of faults on relations that have some."""
    from ledgerlens.plans import validation

    clean = Chain(spark, SF)
    gone = clean.base.where("tx_index = 2").select("txid")
    c = Chain(spark, SF)
    c.__dict__["base"] = clean.base.where("tx_index <> 2")
    c.__dict__["inputs"] = clean.inputs
    c.__dict__["lines"] = clean.lines.where("amount % 1000 <> 7")
    r = validation.v_summary(c).first()
    assert r.orphaned_outputs == c.lines.join(gone, "txid", "left_semi").count() > 0
    assert r.orphaned_inputs == clean.inputs.join(gone, "txid", "left_semi").count() > 0
    spends = clean.inputs.where("not is_coinbase").select("previous_output_id")
    assert r.missing_spends == spends.join(clean.lines.where("amount % 1000 = 7"), F.col("previous_output_id") == F.col("output_id"), "left_semi").count() > 0
    assert r.spends + r.missing_spends == spends.count() and r.utxos == c.lines.count() - r.spends
    assert r.balance_errors > 0 and r.transactions == c.base.count()
