"""Codec, addresses, block files, store, node interface, live mode, settings."""

import hashlib
import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.functions import addresses
from ledgerlens.sources import block_files, codec
from ledgerlens.sources.rpc import Node, RpcError, rpc_blocks
from ledgerlens.sources.store import Store, load_snapshot, save_snapshot
from ledgerlens.streaming import live

GENESIS_MERKLE = "4a5e1e4baab89f3a32518a88c31bc87f618f76673e2cc77ab2127b7afdeda33b"
GENESIS_HASH = "000000000019d6689c085ae165831e934ff763ae46a2a6c172b3f1b60a8ce26f"
P2PK_KEY = "04678afdb0fe5548271967f1a67130b7105cd6a828e03909a67962e0ea1f61deb649f6bc3f4cef38c4f35504e51ec112de5c384df7ba0b8d578a4c702b6bf11d5f"
COINBASE_TEXT = "04ffff001d0104455468652054696d65732030332f4a616e2f32303039204368616e63656c6c6f72206f6e206272696e6b206f66207365636f6e64206261696c6f757420666f722062616e6b73"
HASH20 = "89abcdef" + "abbaabba" * 4


def tx_in(previous="0" * 64, index=0xFFFFFFFF, script="", witness=()):
    return {"previous_txid": previous, "previous_output_index": index, "script_sig": script, "sequence": 0xFFFFFFFF, "witness": list(witness)}


def tx(inputs, outputs, version=1, locktime=0):
    return {"version": version, "locktime": locktime, "inputs": inputs, "outputs": [{"amount": a, "script_pubkey": s} for a, s in outputs]}


def block(height, previous="0" * 64, more=(), salt=0):
    own = tx([tx_in(script="04" + struct.pack("<I", height).hex() + f"{salt:02x}")], [(50 * 10**8, f"76a914{height:040x}88ac")])
    return {"version": 1, "previous_hash": previous, "merkle_root": "11" * 32, "timestamp": 1300000000 + height, "bits": "1d00ffff", "nonce": height + 1000 * salt, "transactions": [own, *more]}


def chain(n, previous="0" * 64, first=0, salt=0, more=lambda h: ()):
    out = []
    for h in range(first, first + n):
        raw = codec.write_block(block(h, previous, more(h), salt))
        previous = codec.read_block(raw)["hash"]
        out.append((h, previous, raw))
    return out


def test_genesis():
    b = {"version": 1, "previous_hash": "0" * 64, "merkle_root": GENESIS_MERKLE, "timestamp": 1231006505, "bits": "1d00ffff", "nonce": 2083236893, "transactions": [tx([tx_in(script=COINBASE_TEXT)], [(50 * 10**8, f"41{P2PK_KEY}ac")])]}
    got = codec.read_block(codec.write_block(b))
    assert (got["hash"], got["tx_count"], got["size"], got["weight"]) == (GENESIS_HASH, 1, 285, 1140)
    assert got["transactions"][0]["txid"] == GENESIS_MERKLE and got["transactions"][0]["is_coinbase"]
    assert addresses.classify(bytes.fromhex(f"41{P2PK_KEY}ac")) == ("P2PK", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa")


def test_round_trip_of_random_transactions():
    rng = random.Random(1)
    text = lambda n: rng.randbytes(rng.choice([0, 1, 75, 252, 253, 300, 70000][:n])).hex()
    for k in range(40):
        witness = [[text(5) for _ in range(rng.randrange(3))] for _ in range(3)] if k % 2 else [[]] * 3
        t = tx([tx_in(rng.randbytes(32).hex(), rng.randrange(2**32), text(7), w) for w in witness], [(rng.randrange(2**50), text(6)) for _ in range(rng.randrange(4))], 2, rng.randrange(2**32))
        raw = codec.write_transaction(t)
        got = codec.read_transaction(codec.Reader(raw))
        assert codec.write_transaction(got) == raw and {k: got[k] for k in t if k != "inputs" and k != "outputs"} == {k: t[k] for k in ("version", "locktime")}
        bare = codec.write_transaction(t | {"inputs": [i | {"witness": []} for i in t["inputs"]]})
        assert got["txid"] == hashlib.sha256(hashlib.sha256(bare).digest()).digest()[::-1].hex()
        assert (got["size"], got["weight"], got["vsize"]) == (len(raw), 3 * len(bare) + len(raw), -(-(3 * len(bare) + len(raw)) // 4))
        with pytest.raises(codec.BadBytes):
            codec.read_transaction(codec.Reader(raw[:-1]))


@pytest.mark.parametrize(
    ("script", "network", "want"),
    [
        (f"76a914{HASH20}88ac", "mainnet", ("P2PKH", "1DYwPTpZuLjY2qApmJdHaSAuWRvEF5skCN")),
        (f"76a914{HASH20}88ac", "testnet", ("P2PKH", "mt4tgWuYiNAnoweSUsbfQMPENRWw72ccPh")),
        (f"a914{HASH20}87", "mainnet", ("P2SH", "3EExK1K1TF3v7zsFtQHt14XqexCwgmXM1y")),
        ("0014751e76e8199196d454941c45d1b3a323f1433bd6", "mainnet", ("P2WPKH", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4")),
        ("00201863143c14c5166804bd19203356da136c985678cd4d27a1b8c6329604903262", "mainnet", ("P2WSH", "bc1qrp33g0q5c5txsp9arysrx4k6zdkfs4nce4xj0gdcccefvpysxf3qccfmv3")),
        ("512079be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798", "mainnet", ("P2TR", "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj0")),
        ("210279be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798ac", "mainnet", ("P2PK", "1BgGZ9tcN4rm9KBzDn7KprQz87SZ26SAMH")),
        ("2102" + "ff" * 32 + "ac", "mainnet", ("UNKNOWN", None)),
        ("6a0548656c6c6f", "mainnet", ("NULL_DATA", None)),
        ("ff", "mainnet", ("UNKNOWN", None)),
        ("", "mainnet", ("UNKNOWN", None)),
        ("76a913" + "00" * 19 + "88ac", "mainnet", ("UNKNOWN", None)),
        ("5220" + "00" * 32, "mainnet", ("UNKNOWN", None)),
    ],
)
def test_addresses(script, network, want):
    assert addresses.classify(bytes.fromhex(script), network) == want


def test_addresses_of_a_table(spark):
    rows = [("a", "0014751e76e8199196d454941c45d1b3a323f1433bd6"), ("b", None), ("c", "zz"), ("d", "0014751e76e8199196d454941c45d1b3a323f1433bd6")]
    got = {r.k: (r.script_type, r.address) for r in addresses.with_addresses(spark.createDataFrame(rows, "k string, script_pubkey string")).collect()}
    good = ("P2WPKH", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4")
    assert got == {"a": good, "b": ("UNKNOWN", None), "c": ("UNKNOWN", None), "d": good}


def test_numbers_records_and_notifications():
    for raw, n in (("42", 66), ("8000", 128), ("8eed3c", 259900)):
        r = codec.Reader(bytes.fromhex(raw))
        assert codec.varint7(r) == n and r.at == len(raw) // 2
    with pytest.raises(codec.BadBytes):
        codec.varint7(codec.Reader(b"\xff" * 12))
    key = b"b" + bytes(range(32))
    assert codec.index_record(key, bytes([1, 5, 12, 3, 2, 77])) == {"hash": bytes(range(32))[::-1].hex(), "height": 5, "status": 12, "tx_count": 3, "file_number": 2, "file_offset": 77}
    assert codec.index_record(b"f" + key[1:], b"\x01") is codec.index_record(key, b"\x01") is codec.index_record(key, bytes([1, 5, 3, 3, 2, 77])) is None
    raw = bytes.fromhex(GENESIS_HASH)[::-1]
    assert codec.notification([b"hashblock", raw, b"\x07\0\0\0"]) == (GENESIS_HASH, 7)
    assert codec.notification([b"hashblock", raw]) == codec.notification([b"hashblock", raw, b"\0\0"]) == (GENESIS_HASH, None)
    for frames in ([b"hashblock"], [b"hashtx", raw], [b"hashblock", raw[:16]]):
        with pytest.raises(codec.BadBytes):
            codec.notification(frames)


def test_framed_files():
    raw = chain(2)
    data = codec.framed(raw[0][2]) + codec.framed(raw[1][2])
    for tail in (b"", bytes(7), bytes(64)):
        assert [b for _, b in codec.framed_blocks(data + tail, "mainnet")] == [raw[0][2], raw[1][2]]
    for bad in (data[:-1], struct.pack("<II", codec.MAGIC["mainnet"], 0), struct.pack("<II", codec.MAGIC["mainnet"], 4_000_001)):
        with pytest.raises(codec.BadBytes):
            list(codec.framed_blocks(bad, "mainnet"))
    with pytest.raises(codec.BadBytes, match="0xD9B4BEF9 at 0, expected 0x0709110B"):
        list(codec.framed_blocks(data, "testnet"))


def spending(rows):
    """Block h > 2 spends the coinbase of block h - 2, and in the same block that transaction's first output."""

    def more(h):
        if h < 2:
            return ()
        old = codec.read_block(rows[h - 2])["transactions"][0]["txid"]
        first = tx([tx_in(old, 0)], [(30 * 10**8, f"0014{h:040x}"), (19 * 10**8, "6a00")])
        inner = codec.read_transaction(codec.Reader(codec.write_transaction(first)))["txid"]
        return first, tx([tx_in(inner, 0, witness=["aa"])], [(29 * 10**8, f"a914{h:040x}87")])

    return more


def small_chain(n):
    rows, out, previous = [], [], "0" * 64
    for h in range(n):
        [(_, previous, raw)] = chain(1, previous, h, 0, spending(rows))
        rows.append(raw)
        out.append((h, previous, raw))
    return out


def test_files_to_relations(spark, tmp_path):
    main = small_chain(12)
    side = chain(2, main[8][1], 9, salt=1)  # a fork of two blocks that loses
    mixed = [*main[6:], *side, *main[:6]]
    (tmp_path / "blk00000.dat").write_bytes(b"".join(codec.framed(r) for _, _, r in mixed[:7]) + bytes(20))
    (tmp_path / "blk00001.dat").write_bytes(b"".join(codec.framed(r) for _, _, r in mixed[7:]))
    scanned = block_files.scan_blocks(spark, str(tmp_path / "blk*.dat"))
    heights = block_files.main_chain(scanned)
    assert sorted((r.height, r.hash) for r in heights.collect()) == [(h, x) for h, x, _ in main]
    t = block_files.relations(scanned.join(heights, "hash"))
    assert {n: t[n].count() for n in t} == {"blocks": 12, "tx_in_block": 32, "transactions": 32, "outputs": 42, "inputs": 32}
    from ledgerlens.operators import ledger

    resolved = ledger.resolve_inputs(t["inputs"], t["outputs"])
    assert resolved.count() == 20
    fees = ledger.tx_amounts(t["transactions"], t["outputs"], resolved).where("not is_coinbase").select("fee").collect()
    assert sorted(r.fee for r in fees) == [10**8] * 20
    places = scanned.where("offset > 0").select("file", "offset").limit(3)
    again = block_files.scan_blocks_at(spark, places)
    assert sorted(r.hash for r in again.collect()) == sorted(r.hash for r in scanned.join(places, ["file", "offset"]).collect())


def test_store_commits_whole_batches_and_rolls_back(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"))
    blocks = lambda *hs: spark.createDataFrame([(h, f"{x}{h}", f"{x}{h - 1}") for x, h in hs], "height long, hash string, previous_hash string")
    txs = lambda *rows: spark.createDataFrame(rows, "txid string, block_height long")
    assert s.resume_height() == 0 and s.check_parent(1, "x") is None
    assert s.append("a", {"blocks": blocks(("a", 0), ("a", 1)), "transactions": txs(("t", 0), ("u", 1))})
    assert not s.append("a", {"blocks": blocks(("z", 5))})  # a batch seen before
    s.append("b", {"blocks": blocks(("a", 2), ("a", 3)), "transactions": txs(("t", 2), ("v", 3))})
    assert s.resume_height() == 4 and s.check_parent(4, "a3") is None and s.check_parent(4, "b3") == (4, "a3", "b3")
    latest = lambda: sorted(map(tuple, s.table("transactions").collect()))
    assert latest() == [("t", 2), ("u", 1), ("v", 3)]
    assert s.rollback(1) and not s.rollback(1) and s.resume_height() == 2
    assert latest() == [("t", 0), ("u", 1)]  # the earlier version counts again
    s.append("c", {"blocks": blocks(("b", 2)), "transactions": txs(("w", 2))})
    assert sorted(r.hash for r in s.table("blocks").collect()) == ["a0", "a1", "b2"]
    # a writer that fails leaves the tables as they were
    bad = txs(("x", 3)).withColumn("block_height", F.raise_error("stop").cast("long"))
    with pytest.raises(Exception, match="stop"):
        s.append("d", {"blocks": blocks(("b", 3)), "transactions": bad})
    assert s.resume_height() == 3 and s.open is None
    blocks(("q", 9)).write.parquet(str(tmp_path / "s" / "batch-lost" / "blocks"))  # of a writer that was stopped
    assert s.resume_height() == 3 and s.vacuum() == ["batch-lost"]
    s.begin("e")
    with pytest.raises(RuntimeError):
        s.begin("f")
    s.abort()
    with pytest.raises(RuntimeError):
        s.commit()
    s.set_status("completed")
    assert s.manifest()["status"] == "completed"


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snap")
    assert load_snapshot(spark, root) is None
    rows = spark.createDataFrame([("a:0", 5, "P2PKH", "x"), ("b:1", 7, "UNKNOWN", None)], "output_id string, amount long, script_type string, address string")
    save_snapshot(rows, root, 42)
    height, got = load_snapshot(spark, root)
    assert height == 42 and sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    rows.limit(1).write.mode("overwrite").parquet(f"{root}/utxo-42")
    with pytest.raises(ValueError, match="checksum"):
        load_snapshot(spark, root)


def fake_node(rows, failures=0):
    left = [failures]

    def post(body):
        if left[0]:
            left[0] -= 1
            raise ConnectionError("refused")
        q = json.loads(body)
        method, params = q["method"], q["params"]
        if method == "getblockcount":
            result = len(rows) - 1
        elif method == "getblockhash":
            if params[0] >= len(rows):
                return json.dumps({"result": None, "error": {"code": -8, "message": "Block height out of range"}}).encode()
            result = rows[params[0]][1]
        else:
            result = next(raw.hex() for _, x, raw in rows if x == params[0])
        return json.dumps({"result": result, "error": None}).encode()

    return post


def test_node(spark):
    rows = chain(5)
    assert Node("", waits=(0, 0), post=fake_node(rows, 2)).tip_height() == 4
    with pytest.raises(ConnectionError):
        Node("", waits=(0, 0), post=fake_node(rows, 3)).tip_height()
    node = Node("", waits=(0, 0), post=fake_node(rows))
    assert node.block_hash(9) is None
    with pytest.raises(RpcError):
        Node("", waits=(), post=lambda b: b'{"error": {"code": -1, "message": "no"}}').call("x")
    assert sorted((r.height, r.hash) for r in rpc_blocks(spark, node, 3, 10, 3).collect()) == [(h, x) for h, x, _ in rows[3:]]


def test_live_equals_batch(spark, tmp_path):
    log = "seq long, op string, height long, hash string, previous_hash string"
    a = [(k, "append", k, f"a{k}", f"a{k - 1}") for k in range(6)]
    b = [(6, "rollback", 2, None, None), (7, "append", 3, "b3", "a2"), (8, "append", 4, "b4", "b3"), (9, "rollback", 3, None, None), (10, "append", 4, "c4", "b3")]
    for name, rows in (("1", a[:4]), ("2", [*a[4:], *b[:2]]), ("3", b[2:])):
        spark.createDataFrame(rows, log).coalesce(1).write.parquet(str(tmp_path / "log" / name))
    s = Store(spark, str(tmp_path / "store"))
    decode = lambda rows: {"blocks": rows.select("height", "hash", "previous_hash")}
    for _ in range(2):  # the second start finds nothing new
        changes = spark.readStream.schema(log).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "log"))
        live.start_live(changes, s, decode, str(tmp_path / "cp"), availableNow=True).awaitTermination()
        assert sorted((r.height, r.hash) for r in s.table("blocks").collect()) == [(0, "a0"), (1, "a1"), (2, "a2"), (3, "b3"), (4, "c4")]
    assert s.resume_height() == 5
    n = s.manifest()["version"]
    live.apply_changes(s, decode)(spark.createDataFrame(b[2:], log), 2)  # a batch run again
    assert s.manifest()["version"] == n


def test_streams(spark, tmp_path):
    def collected(df, mode, name):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.table(name).collect()))

    notes = [("n", k, s) for k, s in enumerate([2**32 - 2, 2**32 - 1, 0, 1, 5, 6])]
    spark.createDataFrame(notes, "source string, at long, seq long").coalesce(1).write.parquet(str(tmp_path / "notes"))
    stream = spark.readStream.schema("source string, at long, seq long").parquet(str(tmp_path / "notes"))
    assert collected(live.notification_gaps(stream), "append", "gaps") == [("n", 2, 5)]
    spark.createDataFrame([("a", 5), ("b", 6), ("a", None)], "output_id string, amount long").write.parquet(str(tmp_path / "utxo"))
    stream = spark.readStream.schema("output_id string, amount long").parquet(str(tmp_path / "utxo"))
    assert collected(live.utxo_state(stream), "complete", "unspent") == [("a", 5, False), ("b", 6, True)]


def test_config(tmp_path):
    f = tmp_path / "c.toml"
    f.write_text('[source]\nblocks = "/b"\n[store]\nroot = "/s"\n[rpc]\nurl = "http://x"\nnotify = "tcp://y"\n')
    c = config.load(str(f), {"LEDGERLENS_STORE__AUTO_RESUME": "false", "LEDGERLENS_RPC__BATCH_SIZE": "7"}).validate().validate_rpc()
    assert (c.source.blocks, c.store.auto_resume, c.rpc.batch_size) == ("/b", False, 7)
    for env in ({"LEDGERLENS_STORE__ROOT": ""}, {"LEDGERLENS_STORE__MAX_TRANSACTION_MEMORY_MB": "0"}, {"LEDGERLENS_RPC__TIMEOUT_SECS": "0"}, {"LEDGERLENS_RPC__NOPE": "1"}, {"LEDGERLENS_RPC__BATCH_SIZE": "x"}):
        with pytest.raises(config.ConfigError):
            config.load(str(f), env).validate().validate_rpc()
    with pytest.raises(config.ConfigError, match="rpc"):
        config.Config(store=config.StoreSettings("/s")).validate().validate_rpc()


def test_batches_into_the_store(spark, tmp_path):
    from ledgerlens.sources import ingest

    rows = small_chain(9)
    (tmp_path / "blk00000.dat").write_bytes(b"".join(codec.framed(r) for _, _, r in rows))
    scanned = block_files.scan_blocks(spark, str(tmp_path / "blk*.dat"))
    tables = block_files.relations(scanned.join(spark.createDataFrame([(h, x) for h, x, _ in rows], "height long, hash string"), "hash"))
    upto = lambda a, b: {n: t.where(F.col("height" if n == "blocks" else "block_height").between(a, b)) for n, t in tables.items() if n != "tx_in_block"}
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="on_missing"):
        ingest.ingest_batch(store, "x", upto(0, 0), on_missing="other")
    stats = ingest.ingest_batch(store, "a", upto(0, 5), budget=60_000)
    assert (stats.blocks, stats.transactions, stats.outputs, stats.inputs, stats.resolved) == (6, 14, 18, 14, 8) and stats.chunks > 1
    assert ingest.ingest_batch(store, "a", upto(0, 5), budget=60_000) == ingest.BatchStats()  # run again: nothing new
    assert store.resume_height() == 6
    with pytest.raises(ingest.DuplicateKeys):
        ingest.ingest_batch(store, "b", upto(5, 6))
    fork = codec.read_block(chain(1, "77" * 32, 6)[0][2])
    bad = upto(6, 6) | {"blocks": upto(6, 6)["blocks"].withColumn("previous_hash", F.lit("77" * 32))}
    with pytest.raises(ingest.ReorgDetected) as e:
        ingest.ingest_batch(store, "c", bad)
    assert (e.value.height, e.value.expected, e.value.actual) == (6, rows[5][1], fork["previous_hash"])
    assert ingest.ingest_batch(store, "d", upto(6, 7)).resolved == 4
    exchanges = lambda: store.table("outputs")._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert exchanges() == 0  # keys were checked when they were written
    assert ingest.ingest_block(store, upto(8, 8), 8).blocks == 1
    assert exchanges() > 0 and store.table("outputs").count() == tables["outputs"].count()
    whole = {"fees": sorted(r.fee for r in store.table("transactions").where("not is_coinbase").collect()), "spends": store.versions("spends").count(), "benefits": store.versions("benefits_to").count()}
    assert whole == {"fees": [10**8] * 14, "spends": 14, "benefits": sum(1 for _ in tables["outputs"].where("address is not null").collect())}
    before = {n: sorted(map(str, store.versions(n).collect())) for n in ("blocks", "outputs", "spends")}
    assert store.compact("all") and not store.compact("again") and {n: sorted(map(str, store.versions(n).collect())) for n in before} == before
    # blocks of a writer that stopped before their transactions
    more = spark.createDataFrame([(9, "x9", rows[8][1], 2), (10, "x10", "x9", 1)], "height long, hash string, previous_hash string, tx_count long")
    store.append("cut", {"blocks": more.join(upto(0, 0)["blocks"].drop("height", "hash", "previous_hash", "tx_count").limit(1)).select(*store.versions("blocks").columns)})
    assert store.resume_height() == 11 and ingest.recover(store) == 9 and ingest.recover(store) == 9
    report = ingest.status_report(store)
    assert (report["height"], report["resume_height"], report["status"]) == (8, 9, "in_progress") and "again" in report["hint"]
    assert ingest.recover(Store(spark, str(tmp_path / "none"))) == 0


def test_blocks_by_height(spark, tmp_path):
    rows, places, data = chain(6), [], b""
    for h, _, raw in rows:
        places.append((h, 3, len(data) + 8))
        data += codec.framed(raw)
    (tmp_path / "blk00003.dat").write_bytes(data)
    index = spark.createDataFrame(places, "height long, file_number long, file_offset long")
    got = block_files.load_heights(spark, index, 2, 9, f"file:{tmp_path}")
    assert sorted((r.height, r.hash) for r in got.collect()) == [(h, x) for h, x, _ in rows[2:]]
    assert [tuple(r)[1:] for r in block_files.read_counters(block_files.scan_blocks(spark, str(tmp_path))).collect()] == [(6, places[-1][2] - 8)]
    with pytest.raises(Exception, match="blk00004"):
        block_files.load_heights(spark, index.withColumn("file_number", F.lit(4)), 2, 2, f"file:{tmp_path}").collect()
    with pytest.raises(Exception, match="BadBytes"):
        block_files.load_heights(spark, index.withColumn("file_offset", F.col("file_offset") + 1), 2, 2, f"file:{tmp_path}").collect()


def test_utxo_files(spark, tmp_path):
    from ledgerlens.sources.store import read_utxo_file, write_utxo_file

    path = str(tmp_path / "u.bin")
    assert read_utxo_file(spark, path) is None
    entries = [("ab" * 32 + ":1", 5, "P2PKH", "1é"), ("cd" * 32 + ":4294967295", 2**50, "NULL_DATA", None), *(("00" * 32 + f":{k}", k, "UNKNOWN", "") for k in range(3))]
    frame = spark.createDataFrame(entries, "output_id string, amount long, script_type string, address string")
    assert write_utxo_file(frame, path, 42) == 5
    data = (tmp_path / "u.bin").read_bytes()
    assert data[:4] == b"UTXO" and struct.unpack("<IQI", data[4:20]) == (1, 5, 42) and struct.unpack("<I", data[20:24])[0] == __import__("zlib").crc32(data[24:])
    height, got = read_utxo_file(spark, path)
    assert height == 42 and sorted(map(str, got.collect())) == sorted(map(str, frame.collect()))
    for bad in (data[:-1], data + b"x", b"UTXX" + data[4:], data[:30] + b"\x55" + data[31:], data[:10]):
        with pytest.raises(codec.BadBytes):
            codec.utxo_entries(bad)


def test_refused_credentials_are_not_tried_again(monkeypatch):
    import urllib.error
    import urllib.request

    tries = []

    def refuse(request, timeout):
        tries.append(1)
        raise urllib.error.HTTPError(request.full_url, 401, "no", None, None)

    monkeypatch.setattr(urllib.request, "urlopen", refuse)
    with pytest.raises(RpcError, match="credentials"):
        Node("http://localhost:1", waits=(0, 0)).tip_height()
    assert len(tries) == 1


def test_following_a_node_through_a_fork(spark, tmp_path):
    from ledgerlens.streaming import follow

    rows = small_chain(7)
    store = Store(spark, str(tmp_path / "store"))
    first = follow.catch_up(spark, store, Node("", waits=(0,), post=fake_node(rows[:5], 1)), blocks_at_once=3)
    assert (first.blocks, store.resume_height()) == (5, 5) and follow.fork_height(store, Node("", post=fake_node(rows))) == 4
    assert follow.catch_up(spark, store, Node("", post=fake_node(rows[:5]))).blocks == 0
    other = [*rows[:3], *chain(5, rows[2][1], 3, salt=1)]  # the node has another chain from height 3 on
    assert follow.fork_height(store, Node("", post=fake_node(other))) == 2
    turns = []
    follow.follow(spark, store, Node("", post=fake_node(other)), lambda: len(turns) >= 2, wake=turns.append)
    assert [r.hash for r in store.table("blocks").orderBy("height").collect()] == [x for _, x, _ in other]
    assert follow.catch_up(spark, Store(spark, str(tmp_path / "late")), Node("", post=fake_node(rows)), confirmations=2).blocks == 5
    whole = Store(spark, str(tmp_path / "whole"))
    follow.catch_up(spark, whole, Node("", post=fake_node(other)))
    for name in ("transactions", "outputs", "spends", "performs", "benefits_to"):
        assert sorted(map(str, store.table(name).collect())) == sorted(map(str, whole.table(name).collect())), name
    with pytest.raises(ConnectionError):
        follow.follow(spark, whole, Node("", waits=(), post=fake_node(rows, 99)), lambda: False)
    assert whole.manifest()["status"] == "error"


def test_store_in_memory_fails_where_told(spark):
    from ledgerlens.sources.store import MemoryStore

    s = MemoryStore(spark, {"outputs"})
    blocks = spark.createDataFrame([(0, "a"), (1, "b")], "height long, hash string")
    outs = spark.createDataFrame([("x:0", 0)], "output_id string, block_height long")
    with pytest.raises(OSError, match="outputs"):
        s.append("a", {"blocks": blocks, "outputs": outs})
    assert s.resume_height() == 0 and s.open is None and s.manifest()["batches"] == []
    s.fail_on.clear()
    assert s.append("a", {"blocks": blocks, "outputs": outs}) and s.resume_height() == 2 and s.table("outputs").count() == 1
    assert s.rollback(0) and s.table("blocks").count() == 1
    assert [tuple(r)[:4] for r in s.layout().collect()] == [("blocks", "height", "height", 1), ("outputs", "output_id", "block_height", 1)]


class Publisher:
    """The other side of a subscription, on a port of this machine: each connection gets one list of messages, then is closed or held."""

    def __init__(self, connections):
        import socket
        import threading

        self.server = socket.create_server(("127.0.0.1", 0))
        self.address = f"tcp://127.0.0.1:{self.server.getsockname()[1]}"
        self.connections, self.topics, self.held = connections, [], []
        threading.Thread(target=self.run, daemon=True).start()

    def run(self):
        from ledgerlens.sources import notify

        for messages in self.connections:
            s, _ = self.server.accept()
            s.sendall(notify.greeting())
            read = lambda n, s=s: b"".join(iter(lambda: s.recv(1), None).__next__() for _ in range(n))
            read(64)
            s.sendall(notify.ready(b"PUB"))
            read(1)
            read(read(1)[0])  # their READY
            read(1)
            self.topics.append(read(read(1)[0]))
            for frames in messages:
                for k, body in enumerate(frames):
                    s.sendall(notify.frame(body, notify.MORE if k + 1 < len(frames) else 0))
            if messages and messages[-1] == [b"end"]:
                s.close()
            self.held.append(s)


def test_announcements_over_connections():
    from ledgerlens.sources import notify

    raw = bytes.fromhex(GENESIS_HASH)[::-1]
    note = lambda n: [b"hashblock", raw, struct.pack("<I", n)]
    p = Publisher([[note(2**32 - 1), note(0), [b"hashblock", raw[:9]], [b"other", b"x" * 300], [b"end"]], [note(3), note(4)]])
    s = notify.Subscriber(p.address, waits=(0, 0, 0), timeout=5)
    assert list(s.announcements(1)) == [(GENESIS_HASH, 2**32 - 1, None), (GENESIS_HASH, 0, None), (GENESIS_HASH, 3, 1), (GENESIS_HASH, 4, None)]
    assert p.topics == [b"\x01hashblock"] * 2
    s.close()
    p.server.close()
    with pytest.raises(OSError):
        notify.Subscriber(p.address, waits=(0,), timeout=1).receive(1)
    notify.Subscriber(p.address, waits=(), timeout=1).wake(0.1)
    for bad in ("http://x:1", "tcp://x", "tcp://x:y"):
        with pytest.raises(ValueError, match="tcp"):
            notify.Subscriber(bad)


def test_block_index_of_leveldb_files(spark, tmp_path):
    """Files written here by the format's description: a table packed and one not, a log of records over several blocks."""
    import pyarrow as pa

    from ledgerlens.sources import leveldb

    def varint(n):
        out = b""
        while n >= 0x80:
            out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
        return out + bytes([n])

    def packed(entries):
        out, before = b"", b""
        for key, value in entries:
            shared = next((k for k, (a, b) in enumerate(zip(before, key, strict=False)) if a != b), min(len(before), len(key)))
            out, before = out + varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value, key
        return out + struct.pack("<II", 0, 1)

    def table(entries, snappy):
        out, handles = b"", []
        rows = [(k + struct.pack("<Q", n << 8 | (v is not None)), v or b"") for k, n, v in sorted(entries)]
        for at in range(0, len(rows), 7):
            body = packed(rows[at : at + 7])
            body = pa.compress(body, "snappy", asbytes=True) if snappy else body
            handles.append((rows[min(at + 6, len(rows) - 1)][0], varint(len(out)) + varint(len(body))))
            out += body + bytes([int(snappy)]) + bytes(4)
        index = packed(handles)
        footer = varint(0) + varint(0) + varint(len(out)) + varint(len(index))
        return out + index + bytes(5) + footer.ljust(40, b"\0") + struct.pack("<Q", leveldb.TABLE_MAGIC)

    def log(entries, first):
        record = struct.pack("<QI", first, len(entries))
        for k, v in entries:
            record += bytes([v is not None]) + varint(len(k)) + k + (varint(len(v)) + v if v is not None else b"")
        out, kind = b"", 2
        while record:
            room = 32768 - len(out) % 32768 - 7
            if room < 0:
                out += bytes(room + 7)
                continue
            part, record = record[:room], record[room:]
            kind = (4 if kind == 3 else 1) if not record else kind
            out, kind = out + bytes(4) + struct.pack("<HB", len(part), kind) + part, 3
        return out

    def seven(n):
        out = bytes([n & 0x7F])
        n = (n >> 7) - 1
        while n >= 0:
            out, n = bytes([n & 0x7F | 0x80]) + out, (n >> 7) - 1
        return out

    key = lambda h: b"b" + hashlib.sha256(str(h).encode()).digest()
    value = lambda h, offset: b"".join(map(seven, (1, h, 12, 3, h // 10, offset)))
    old = [(key(h), h + 1, value(h, 5 if h == 7 else 1000 * h)) for h in range(40)]
    (tmp_path / "000001.ldb").write_bytes(table([*old, (b"F\x07txindex", 90, b"0"), (b"b" + bytes(32), 91, b"\x01"), (key(100), 92, value(100, 1))], True))
    (tmp_path / "000002.sst").write_bytes(table([(key(7), 200, value(7, 7000)), (key(100), 201, None)], False))
    (tmp_path / "000003.log").write_bytes(log([(key(h), value(h, 1000 * h)) for h in range(40, 900)] + [(b"x", None)], 300) + b"\0\0\0\0\x40\x00\x01cut")
    (tmp_path / "CURRENT").write_text("MANIFEST-000004\n")
    index = leveldb.block_index(spark, str(tmp_path))
    rows = {r.height: r for r in index.collect()}
    assert sorted(rows) == list(range(900)) and all(r.file_offset == 1000 * h and r.file_number == h // 10 and r.hash == key(h)[:0:-1].hex() for h, r in rows.items())
    leveldb.check_heights(index)
    for bad, why in ((index.where("height <> 500"), "499, then 501"), (index.where("false"), "no blocks"), (index.unionByName(index.where("height = 3")), "again")):
        with pytest.raises(leveldb.CorruptIndex, match=why):
            leveldb.check_heights(bad)
    with pytest.raises(codec.BadBytes):
        list(leveldb.table_entries(b"x" * 100))


def test_command_line(spark, tmp_path, capsys):
    from ledgerlens.__main__ import main

    rows = small_chain(8)
    side = chain(1, rows[5][1], 6, salt=1)
    (tmp_path / "blk00000.dat").write_bytes(b"".join(codec.framed(r) for _, _, r in [*rows[4:], *side]))
    (tmp_path / "blk00001.dat").write_bytes(b"".join(codec.framed(r) for _, _, r in rows[:4]))
    store = f"file:{tmp_path}/store"
    told = lambda *a: (main(list(a), spark), json.loads(capsys.readouterr().out.strip().splitlines()[-1]))[1]
    assert told("status", store)["resume_height"] == 0
    assert told("ingest", store, f"file:{tmp_path}", "--upto", "4", "--blocks-at-once", "2")["blocks"] == 5
    got = told("ingest", store, f"file:{tmp_path}")
    assert (got["blocks"], got["resolved"]) == (3, 6)
    assert [r.hash for r in Store(spark, store).table("blocks").orderBy("height").collect()] == [x for _, x, _ in rows]
    assert told("status", store)["status"] == "completed" and told("rollback", store, "5") == {"rolled_back": True}
    assert told("compact", store) == {"compacted": True} and told("status", store)["height"] == 5 and len(told("vacuum", store)["removed"]) > 2
    assert told("ingest", store, f"file:{tmp_path}")["blocks"] == 2
    assert main(["layout", store], spark) == 0 and "benefits_to" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["follow", store], spark)
