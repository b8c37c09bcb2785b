"""Near-duplicates by MinHash with tensored banding.

Instead of L independent tables, two collections of M half keys (R minhashes each) are computed, and the M * M pairs of
a half key from either collection are the table keys: 2 M R minhashes stand for M * M tables of 2 R. Half keys that no
other text shares are left out before pairs are formed. Texts of a table are compared with one text of it (its pivot)
rather than with each other, and with a second one if they aren't in one class after that; at last the pairs between
different classes that are left are compared, where two sketches say they may be similar enough. Every link is
confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, in_arrow, saved, split_join, table

WIDTH = 5  # words in a shingle
M, R = 12, 2  # half keys in a collection, minhashes in a half key
PERCENT = 75
#: Of the 48 minhashes of a pair at the threshold, 36 agree on average; fewer than 24 do once in 20,000 pairs, which is
#: as rare as such a pair sharing no table (once in 10,000). Of pairs at 0.8 it is one in five million.
ALIKE = 24
#: A finer sketch, for the pairs that are left: of two sets at the threshold less than BINS_LEAST of the bins agree once in 10,000 at most.
BINS, BINS_LEAST = 1024, 0.70
PIVOTS = 2  # rounds with pivots before pairs
SQUARE = 1024  # rows of a key that one task compares with as many others
_WORDS: dict[bytes, int] = {}


def _odd(n: int, salt: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(f"{salt}:{k}") | 1 for k in range(n)], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's 5-word shingles (fewer words: the whole sequence as one; none: empty)."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z alone
    words = data.split()  # of bytes: at x20 and x09-x0D alone
    if not words:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > 300_000:
        _WORDS.clear()
    get = _WORDS.get
    out = []
    for w in words:
        v = get(w)
        if v is None:
            v = _WORDS[w] = xxhash.xxh3_64_intdigest(w)
        out.append(v)
    h = np.array(out, np.uint64)
    with np.errstate(over="ignore"):
        if len(h) < WIDTH:
            total = np.uint64(len(h))
            for v in h:
                total = (total ^ (total >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + v
            return np.array([_mix(total)], np.uint64)
        n = len(h) - WIDTH + 1
        total = h[:n].copy()
        for k in range(1, WIDTH):
            total = (total ^ (total >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
        return np.unique(_mix(total))


def _mix(x):
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_A, _B = _odd(2 * M * R + 128, 1), _odd(2 * M * R + 128, 2)


def half_keys(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """2 * M half keys and 128 bits that agree in a share of (1 + similarity) / 2, from 2 * M * R minhashes."""
    n = 2 * M * R
    best = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 4096):
            part = s[at : at + 4096]
            x = part[None, :] * _A[:n, None] + _B[:n, None]
            x ^= x >> np.uint64(32)
            best = np.minimum(best, x.min(axis=1))
        keys = best.reshape(2 * M, R)
        total = np.zeros(2 * M, np.uint64)
        for k in range(R):
            total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + keys[:, k])
    return total, best


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, h1, h2 (digest of the set), half (2 * M half keys), mins (7 bits of each minhash)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("half", pa.list_(pa.int64())), ("mins", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingles(text.as_py())
                if len(s):
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    half, best = half_keys(s)
                    rows.append((doc, len(s), (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63), half.view(np.int64), packed_mins(best)))
                else:
                    rows.append((doc, 0, None, None, None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        _WORDS.clear()  # the worker lives on for other stages

    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_shingles long, h1 long, h2 long, half array<long>, mins array<long>")


def bins_of(s: np.ndarray) -> np.ndarray:
    """One-permutation sketch: of each of BINS classes of hashes 7 bits of the smallest (1 to 127; 0: none), packed."""
    low = np.zeros(BINS, np.uint64)
    own, first = np.unique(s & np.uint64(BINS - 1), return_index=True)
    low[own.astype(np.int64)] = (s[first] >> np.uint64(20)) % np.uint64(127) + np.uint64(1)
    return packed_mins(low)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, s (the set), bins (its sketch)."""
    schema = pa.schema([("doc_id", pa.int64()), ("s", pa.list_(pa.int64())), ("bins", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 256):
                part = [shingles(t.as_py()) for t in texts[at : at + 256]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 256], pa.int64()), pa.array([x.view(np.int64) for x in part], schema.field("s").type), pa.array(map(bins_of, part), schema.field("bins").type)], schema=schema)
        _WORDS.clear()

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, s array<long>, bins array<long>")


def packed_mins(best: np.ndarray) -> np.ndarray:
    """7 bits of each minhash, a byte each, 7 bytes to a long (so sums below can't overflow); the last is padded with 0."""
    low = np.zeros(-(-len(best) // 7) * 7, np.uint8)
    low[: len(best)] = (best & np.uint64(127)).astype(np.uint8)
    out = np.zeros((len(low) // 7, 8), np.uint8)
    out[:, :7] = low.reshape(-1, 7)
    return out.reshape(-1).view("<i8")


def _agree(a: Column, b: Column) -> Column:
    """How many minhashes agree, going by their 7 bits (those of padding always do)."""
    total = None
    for k in range(-(-2 * M * R // 7)):
        x = a[k].bitwiseXOR(b[k])  # the top bit of a byte of the sum is set where the byte isn't 0
        e = F.lit(7) - F.bit_count((x + F.lit(0x007F7F7F7F7F7F7F)).bitwiseAND(F.lit(0x0080808080808080))).cast("int")
        total = e if total is None else total + e
    return total


def _near(na: Column, nb: Column, ma: Column, mb: Column) -> Column:
    """Exact bound on the sets' sizes; and at least ALIKE of the 48 minhashes alike."""
    return (F.lit(100) * F.least(na, nb) >= F.lit(PERCENT) * F.greatest(na, nb)) & (_agree(ma, mb) >= ALIKE)


def _bins_agree(a: Column, b: Column) -> Column:
    """Whether the share of agreeing bins among those not empty in both reaches BINS_LEAST: alike - empty >= least * (all - empty), as one sum."""
    ones, tops, places, least = 0x007F7F7F7F7F7F7F, 0x0080808080808080, -(-BINS // 7) * 7, round(100 * BINS_LEAST)
    zero = lambda x: F.lit(7) - F.bit_count((x + F.lit(ones)).bitwiseAND(F.lit(tops))).cast("int")
    return F.aggregate(F.zip_with(a, b, lambda x, y: zero(x.bitwiseXOR(y)) * 100 - zero(x.bitwiseOR(y)) * (100 - least)), F.lit(0), lambda t, e: t + e) >= F.lit(least * places)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold."""
    a, b = sets.select(F.col("doc_id").alias("u"), F.col("s").alias("a")), sets.select(F.col("doc_id").alias("v"), F.col("s").alias("b"))
    both = pairs.join(a, "u").join(b, "v").withColumn("i", F.size(F.array_intersect("a", "b")))
    return both.where(F.lit(100) * F.col("i") >= F.lit(PERCENT) * (F.size("a") + F.size("b") - F.col("i"))).select("u", "v")


def _pivot_pairs(cells: DataFrame, turn: int) -> DataFrame:
    """From cells (key, u, c: class): each text with its table's pivot, if they are of different classes."""
    order = F.struct(F.xxhash64(F.lit(turn), F.col("u")).alias("o"), F.col("u").alias("v"), F.col("c").alias("cv"))
    pivot = cells.groupBy("key").agg(F.min(order).alias("p"), F.count("*").alias("k")).where("k > 1").select("key", "p.v", "p.cv")
    pairs = split_join(cells, pivot, "key").where("c <> cv")
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _rest(likely: DataFrame, sets: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs of different classes that share a half key of the first collection, each once, by either sketch.

    A pair comes from the first half key it shares alone. What doesn't pass the sketches never becomes a row. The rows
    of a key are dealt to squares of at most about SQUARE by SQUARE of them, so a task's share is bounded, however many
    classes a key has left.
    """
    keys = F.transform("a", lambda x: F.xxhash64(x["place"], x["value"]))
    own = likely.join(comp, likely["u"] == comp["node"], "left").select("u", "n", "mins", keys.alias("keys"), F.coalesce("component", "u").alias("c"))
    rows = own.withColumn("key", F.explode("keys"))
    several = rows.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("k")).where("x < y").select("key", F.ceil(F.col("k") / SQUARE).cast("int").alias("sides"))
    rows = split_join(rows, several, "key").join(sets.select(F.col("doc_id").alias("u"), "bins"), "u")
    rows = rows.withColumn("side", F.pmod(F.xxhash64(F.lit("side"), "u"), F.col("sides")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")).drop("sides", "other")
    square = ["key", "low", "high"]
    other = rows.select(*[F.col(c).alias(c if c in square else f"{c}_2") for c in rows.columns])
    once = F.element_at(F.array_intersect("keys", "keys_2"), 1) == F.col("key")
    here = (F.col("low") == F.col("high")) | (F.col("side") != F.col("side_2"))
    pairs = rows.join(other, square).where((F.col("u") > F.col("u_2")) & (F.col("c") != F.col("c_2")) & here & _near(F.col("n"), F.col("n_2"), F.col("mins"), F.col("mins_2")) & once & _bins_agree(F.col("bins"), F.col("bins_2")))
    return pairs.select("u", F.col("u_2").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for the nodes of links (u, v), by large and small stars.

    Each round moves neighbours to the smallest one seen; links shrink to stars in rounds of about the logarithm of the
    longest path. Rounds are written to the shared folder; the links of a node that has very many may be dealt to several
    tasks. No links give no rows.
    """
    edges = saved(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = saved(split_join(both, low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_join(large, low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = saved(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


DIGEST = ["h1", "h2", "n_shingles"]


def repeated_ids(docs: DataFrame) -> DataFrame:
    """The ids that several rows have, and null if a row has it."""
    n = fresh(docs, "_n")
    return docs.groupBy("doc_id").agg(F.count("*").alias(n)).where((F.col(n) > 1) | F.col("doc_id").isNull()).select("doc_id")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Rows without words have no shingles and stand alone; rows of one doc_id share its component, whatever their texts; a
    null doc_id links with nothing (component null, kept). Equal sets are one text: the smallest doc_id stands for all
    of them, links are looked for among those alone, and the rows get their set's component at the end. Columns of docs
    but doc_id and text are ignored; no rows give none.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if repeated_ids(docs.where("doc_id is not null")).isEmpty():
        return _classes(docs)
    rows = saved(docs.withColumn("row", F.monotonically_increasing_id()))
    by_row = saved(_classes(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("row")).alias("doc_id"), "text")))
    own = rows.where("doc_id is not null").select("row", F.col("doc_id").alias("id")).join(by_row.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("component")), "row")
    least = own.groupBy("component").agg(F.min("id").alias("least"))
    linked = saved(split_join(own, least, "component").select("id", "n_shingles", "least"))
    nodes = components(linked.select(F.col("id").alias("u"), F.col("least").alias("v")))
    out = linked.join(nodes, linked["id"] == nodes["node"], "left").select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return out.unionByName(by_row.where("doc_id is null"))


def _classes(docs: DataFrame) -> DataFrame:
    """As classes; no two rows have the same doc_id but null."""
    own = saved(sketches(docs))
    whole = own.where("n_shingles > 0 and doc_id is not null")
    groups = saved(whole.groupBy(*DIGEST).agg(F.min("doc_id").alias("rep")))
    reps = whole.join(groups.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("n_shingles").alias("n"), "half", "mins")
    # half keys that another text shares
    half = reps.select("u", F.posexplode("half").alias("place", "value"))
    common = half.groupBy("place", "value").agg(F.min("u").alias("a"), F.max("u").alias("b")).where("a < b").select("place", "value")
    shared = half.join(common, ["place", "value"], "left_semi").groupBy("u").agg(F.collect_list(F.struct("place", "value")).alias("keys"))
    sides = shared.select("u", F.filter("keys", lambda k: k["place"] < M).alias("a"), F.filter("keys", lambda k: k["place"] >= M).alias("b")).where("size(a) > 0 and size(b) > 0")
    likely = saved(sides.join(reps.select("u", "n", "mins"), "u"))
    tensor = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x["place"], x["value"], y["place"], y["value"]))))
    cells = likely.select("u", F.explode(tensor).alias("key"))
    sketch = likely.select("u", "n", "mins")
    sets = saved(shingle_sets(docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(likely.select(F.col("u").alias("doc_id")), "doc_id", "left_semi")))

    links, tried, comp = None, None, None
    for turn in range(PIVOTS + 1):
        if turn == PIVOTS:
            pairs = _rest(likely, sets, comp)
        else:
            now = cells.withColumn("c", F.col("u")) if comp is None else cells.join(comp, cells["u"] == comp["node"], "left").select("u", "key", F.coalesce("component", "u").alias("c"))
            pairs = _pivot_pairs(now, turn).join(sketch, "u").join(sketch.select(F.col("u").alias("v"), F.col("n").alias("nv"), F.col("mins").alias("mv")), "v")
            pairs = pairs.where(_near(F.col("n"), F.col("nv"), F.col("mins"), F.col("mv"))).select("u", "v")
        pairs = saved(pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = saved(verified(pairs, sets))
        if links is None or not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            comp = saved(components(links)) if turn < PIVOTS else comp
    nodes = components(links)
    found = groups.join(nodes, groups["rep"] == nodes["node"], "left").select(*DIGEST, F.coalesce("component", "rep").alias("component"))
    out = own.select("doc_id", *DIGEST).join(found, DIGEST, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: its smallest doc_id. Rows without words stand alone; of those, repeated ids go.

    Where ids are repeated or null (few or none), each row gets a number of its own, in the order of the ids with nulls
    last, and the classes are those of the rows: rows of one id stay where their texts are no near-duplicates.
    """
    if repeated_ids(docs).isEmpty():
        return docs.join(saved(_classes(docs)).where("kept").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    row, size = fresh(docs, "_row"), fresh(docs, "_size")
    rows = saved(docs.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text")).withColumn(row, F.monotonically_increasing_id()))
    found = saved(_classes(rows.select(F.col(row).alias("doc_id"), "text")))
    kept = rows.join(found.where("kept").select(F.col("doc_id").alias(row), F.col("n_shingles").alias(size)), row)
    bare = kept.where((F.col(size) == 0) & F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return kept.where((F.col(size) > 0) | F.col("doc_id").isNull()).unionByName(bare).select(docs.columns)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM e a JOIN e b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * i >= 75 * (x.n + y.n - i)),
b AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(doc_id, node) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, b.v FROM r JOIN b ON b.u = r.node),
c AS (SELECT doc_id, min(node) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
"""
