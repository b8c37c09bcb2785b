"""The ledger's tables as Parquet batches, made visible together by a manifest.

A batch is written to its own folder; a manifest of the next version that lists it is then renamed into place. Readers
take the highest manifest, so they see all tables of a batch or none, and a crash leaves at most a folder that no
manifest names. A rollback rewrites no data: it lowers the height up to which earlier batches count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.ledger import latest
from ledgerlens.sources.files import Files

BUCKETS, MOST_ROWS = 8, 5_000_000  # files that a batch's edges are dealt to by address; rows of a file
KEYS = {"blocks": "height", "transactions": "txid", "outputs": "output_id", "inputs": "input_id"}
EMPTY = {"version": 0, "height": None, "hash": None, "status": "in_progress", "batches": []}
STATUSES = ["in_progress", "completed", "paused", "error"]


def _height(name: str) -> str:
    return "height" if name == "blocks" else "block_height"


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)
        self.open: tuple[str, dict[str, DataFrame]] | None = None

    def manifest(self) -> dict:
        versions = [int(n[9:-5]) for n in self.files.names() if n.startswith("manifest-")]
        return self.files.read(f"manifest-{max(versions)}.json") if versions else dict(EMPTY)

    def _save(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").option("maxRecordsPerFile", MOST_ROWS).parquet(path)

    def _load(self, paths: list[str]) -> DataFrame:
        return self.spark.read.parquet(*paths)

    def _publish(self, m: dict, **changes) -> None:
        m = m | changes | {"version": m["version"] + 1}
        self.files.publish(f"manifest-{m['version']}.json", m)

    # transactions
    def begin(self, batch: str) -> None:
        if self.open:
            raise RuntimeError("a transaction is open")
        self.open = (batch, {})

    def write(self, name: str, rows: DataFrame) -> None:
        if not self.open:
            raise RuntimeError("no transaction is open")
        self.open[1][name] = rows

    def abort(self) -> None:
        if not self.open:
            raise RuntimeError("no transaction is open")
        self.files.remove(f"batch-{self.open[0]}")
        self.open = None

    def commit(self, above: int | None = None, unique: bool = False) -> bool:
        """Writes the open transaction's tables, publishes them, and says whether it did: a batch seen before isn't added twice.

        above: what lies above that height in earlier batches stops counting with the same manifest (a reorganisation).
        unique: the caller has checked that no key of the batch is there already, so reading needs no shuffle to find out.
        """
        if not self.open:
            raise RuntimeError("no transaction is open")
        batch, tables = self.open
        m = self.manifest()
        if any(b["id"] == batch for b in m["batches"]):
            self.open = None
            return False
        base = f"{self.files.root}/batch-{batch}"
        try:
            for name, rows in tables.items():
                if name in ("performs", "benefits_to"):
                    rows = rows.repartition(BUCKETS, "address")
                self._save(rows.sortWithinPartitions(_height(name)), f"{base}/{name}")
        except Exception:
            self.abort()
            raise
        self.open = None
        earlier = _cut(m["batches"], above)
        entry = {"id": batch, "tables": sorted(tables), "upto": None, "unique": unique}
        tip = None
        if "blocks" in tables:
            tip = self._load([f"{base}/blocks"]).agg(F.max(F.struct("height", "hash")).alias("t")).first().t
        if tip is None and above is not None:
            tip = self._tip(earlier)
        self._publish(m, batches=[*earlier, entry], **({"height": tip.height, "hash": tip.hash} if tip else {}))
        return True

    def append(self, batch: str, tables: dict[str, DataFrame], above: int | None = None, unique: bool = False) -> bool:
        self.begin(batch)
        for name, rows in tables.items():
            self.write(name, rows)
        return self.commit(above, unique)

    # reading
    def _rows(self, name: str, batches: list[dict]) -> DataFrame | None:
        groups: dict[int | None, list[str]] = {}
        for b in batches:
            if name in b["tables"]:
                groups.setdefault(b["upto"], []).append(f"{self.files.root}/batch-{b['id']}/{name}")
        out = None
        for upto, paths in groups.items():
            rows = self._load(paths)
            rows = rows if upto is None else rows.where(F.col(_height(name)) <= upto)
            out = rows if out is None else out.unionByName(rows)
        return out

    def versions(self, name: str) -> DataFrame:
        """All surviving rows of the table: a key may have one for each height."""
        rows = self._rows(name, self.manifest()["batches"])
        if rows is None:
            raise KeyError(f"no table {name}")
        return rows

    def table(self, name: str) -> DataFrame:
        """The table; of a key's rows that of the highest block."""
        rows = self.versions(name)
        unique = all(b.get("unique") for b in self.manifest()["batches"] if name in b["tables"])
        return latest(rows, [KEYS[name]], _height(name)).select(rows.columns) if name in KEYS and KEYS[name] != _height(name) and not unique else rows

    # heights
    def _tip(self, batches: list[dict]):
        blocks = self._rows("blocks", batches)
        return blocks.agg(F.max(F.struct("height", "hash")).alias("t")).first().t if blocks is not None else None

    def resume_height(self) -> int:
        height = self.manifest()["height"]
        return 0 if height is None else height + 1

    def rollback(self, height: int) -> bool:
        """Only blocks up to the height count from now on; nothing happens where there are none above it."""
        m = self.manifest()
        if m["height"] is None or height >= m["height"]:
            return False
        batches = _cut(m["batches"], height)
        tip = self._tip(batches)
        self._publish(m, batches=batches, height=tip.height if tip else None, hash=tip.hash if tip else None)
        return True

    def compact(self, batch: str) -> bool:
        """Writes what counts of all batches as one batch of that name, which a new manifest lists alone; False where there are fewer than two.

        Folders of the batches before stay until vacuum, for readers that still use them.
        """
        m = self.manifest()
        if len(m["batches"]) < 2:
            return False
        names = sorted({t for b in m["batches"] for t in b["tables"]})
        for name in names:
            rows = self._rows(name, m["batches"])
            self._save(rows.repartitionByRange(_height(name)).sortWithinPartitions(_height(name)), f"{self.files.root}/batch-{batch}/{name}")
        self._publish(m, batches=[{"id": batch, "tables": names, "upto": None, "unique": all(b.get("unique") for b in m["batches"])}])
        return True

    def set_status(self, status: str) -> None:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status}")
        self._publish(self.manifest(), status=status)

    def check_parent(self, height: int, previous_hash: str) -> tuple[int, str, str] | None:
        """(height, expected, actual) where the stored block below has another hash: a reorganisation. None: fine, or none stored."""
        if height == 0 or not self.manifest()["batches"]:
            return None
        below = self.versions("blocks").where(F.col("height") == height - 1).select("hash").first()
        return (height, below.hash, previous_hash) if below and below.hash != previous_hash else None

    def vacuum(self) -> list[str]:
        """Removes folders of batches that no manifest names (of writers that stopped); call it while nobody writes."""
        named = {f"batch-{b['id']}" for b in self.manifest()["batches"]}
        gone = [n for n in self.files.names() if n.startswith("batch-") and n not in named]
        for n in gone:
            self.files.remove(n)
        return gone


    def layout(self) -> DataFrame:
        """table, key, sorted_by, batches, files of each table: what stands in for indexes."""
        m, rows = self.manifest(), []
        for name in sorted({t for b in m["batches"] for t in b["tables"]}):
            rows.append((name, KEYS.get(name), _height(name), sum(name in b["tables"] for b in m["batches"]), len(self.versions(name).inputFiles())))
        return self.spark.createDataFrame(rows, "table string, key string, sorted_by string, batches long, files long")


class MemoryFiles:
    """What Files does, in memory."""

    root = "memory"

    def __init__(self):
        self.held: dict[str, dict] = {}

    def names(self) -> list[str]:
        return list(self.held)

    def read(self, name: str) -> dict | None:
        return self.held.get(name)

    def publish(self, name: str, value: dict) -> None:
        if name in self.held:
            raise FileExistsError(name)
        self.held[name] = value

    def remove(self, name: str) -> None:
        self.held.pop(name, None)


class MemoryStore(Store):
    """A store for tests: tables are kept as rows on the driver, and writing a table named in fail_on fails."""

    def __init__(self, spark: SparkSession, fail_on: set[str] = frozenset()):
        self.spark, self.files, self.open = spark, MemoryFiles(), None
        self.fail_on, self.kept = set(fail_on), {}

    def _save(self, rows: DataFrame, path: str) -> None:
        if path.rpartition("/")[2] in self.fail_on:
            raise OSError(f"{path} can't be written")
        self.kept[path] = (rows.collect(), rows.schema)

    def _load(self, paths: list[str]) -> DataFrame:
        out = None
        for p in paths:
            rows = self.spark.createDataFrame(*self.kept[p])
            out = rows if out is None else out.unionByName(rows)
        return out


def _cut(batches: list[dict], above: int | None) -> list[dict]:
    return batches if above is None else [b | {"upto": above if b["upto"] is None else min(b["upto"], above)} for b in batches]


def _digest(utxos: DataFrame):
    row = utxos.agg(F.count("*").alias("n"), F.sum(F.xxhash64("output_id", "amount", "script_type", "address").cast("decimal(38,0)")).alias("s")).first()
    return {"count": row.n, "checksum": str(row.s or 0)}


def write_utxo_file(utxos: DataFrame, path: str, height: int) -> int:
    """Unspent outputs as one binary file with a CRC (see codec.UTXO_HEADER), beside its place first; the number of entries.

    Rows come to the driver a partition at a time and go to a local file; Parquet snapshots are for more than a machine holds.
    """
    import os

    from ledgerlens.sources import codec

    part, n, crc = f"{path}.part", 0, 0
    with open(part, "wb") as f:
        f.write(bytes(codec.UTXO_HEADER.size))
        for r in utxos.select("output_id", "amount", "script_type", "address").toLocalIterator():
            entry = codec.utxo_entry(r.output_id, r.amount, r.script_type, r.address)
            crc, n = codec.crc32(entry, crc), n + 1
            f.write(entry)
        f.seek(0)
        f.write(codec.UTXO_HEADER.pack(codec.UTXO_MAGIC, codec.UTXO_VERSION, n, height, crc))
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)
    return n


def read_utxo_file(spark: SparkSession, path: str) -> tuple[int, DataFrame] | None:
    """Height and rows of such a file, its CRC compared first; None where there is none."""
    import os

    from ledgerlens.sources import codec

    if not os.path.exists(path):
        return None
    with open(path, "rb") as f:
        height, entries = codec.utxo_entries(f.read())
    return height, spark.createDataFrame(entries, "output_id string, amount long, script_type string, address string")


def save_snapshot(utxos: DataFrame, root: str, height: int) -> None:
    """Unspent outputs as Parquet with a manifest of height, count and checksum; a snapshot of that height must not exist."""
    path = f"{root.rstrip('/')}/utxo-{height}"
    utxos.write.mode("errorifexists").parquet(path)
    spark = utxos.sparkSession
    Files(spark, root).publish(f"utxo-{height}.json", {"height": height} | _digest(spark.read.parquet(path)))


def load_snapshot(spark: SparkSession, root: str) -> tuple[int, DataFrame] | None:
    """Height and rows of the highest snapshot that is complete, its checksum compared first; None where there is none."""
    files = Files(spark, root)
    found = [int(n[5:-5]) for n in files.names() if n.startswith("utxo-") and n.endswith(".json")]
    if not found:
        return None
    m = files.read(f"utxo-{max(found)}.json")
    rows = spark.read.parquet(f"{files.root}/utxo-{m['height']}")
    if _digest(rows) != {k: m[k] for k in ("count", "checksum")}:
        raise ValueError(f"snapshot of height {m['height']} doesn't match its checksum")
    return m["height"], rows
