"""Benchmark decontamination by q-gram lemma filtering.

A stretch of a text within e edits of w characters of an item shares at least w + 1 - q (e + 1) of their q-grams, all
on diagonals (place in text minus place in item) that lie within e of each other. So shared q-grams are counted in
bands of diagonals that overlap by e, wherever in an item they stand. Such a stretch also holds a run of characters
that are all the same, as one of its e + 1 parts between edits; where the bound is reached, alignment on the diagonals
within e of each run, to both sides of it, decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import in_arrow, saved, table

Q = 12
FRAGMENT = 40  # normalised characters; any so many of an item are looked for
WHOLE = 80  # shorter items are looked for as a whole, too, which allows more edits in one place
RATE = 0.05  # edits per character
EDITS = int((WHOLE - 1) * RATE)  # the most in one stretch
BOUND = FRAGMENT + 1 - Q * (int(FRAGMENT * RATE) + 1)  # shared q-grams; a shorter or whole item needs no fewer among as many places
LEAST = 30  # shorter items can't be told from chance by parts of them; those are looked for as a whole, word by word
BLOCK_CHARS = 8_000_000  # of benchmark text per index; a larger benchmark is looked for in several passes over the documents
_TABLE: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For code points below 0x10000: themselves where letter or digit, else 0."""
    if not _TABLE:
        _TABLE.append(np.fromiter((c if chr(c).isalnum() else 0 for c in range(0x10000)), np.uint32, 0x10000))
    return _TABLE[0]


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters and digits, one blank for any stretch of others, and each character's place in the text."""
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow in lower case; those stay
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    a = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(a) and int(a.max()) > 0xFFFF:
        a = np.where(a > 0xFFFF, a, _fold()[np.minimum(a, 0xFFFF)])
    else:
        a = _fold()[a]
    keep = np.empty(len(a), bool)
    if len(a):
        keep[0] = a[0] != 0
        np.logical_or(a[1:] != 0, a[:-1] != 0, out=keep[1:])
    places = np.flatnonzero(keep)
    a = a[places]
    a[a == 0] = 32
    return a, places


def as_text(a: np.ndarray) -> str:
    return a.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def grams(a: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each q-gram (Q = 8 + 4)."""
    if len(a) < Q:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        b = np.uint64(0x9E3779B97F4A7C15)
        h = a.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        two = h[:-1] * b + h[1:]
        b2 = b * b
        four = two[:-2] * b2 + two[2:]
        b4 = b2 * b2
        eight = four[:-4] * b4 + four[4:]
        out = eight[:-4] * b4 + four[8:]
        return out ^ (out >> np.uint64(31))


def reach(x: str, y: str, edits: int) -> list[tuple[int, int]]:
    """For each number of edits from 0: the most characters of x that a beginning of y matches, and how many of y those are."""
    out: list[tuple[int, int]] = []
    front = {0: 0}  # diagonal (place in y minus place in x): furthest place in x
    for k in range(edits + 1):
        if k:
            new: dict[int, int] = {}
            for d, i in front.items():
                for to, at in ((d, i + 1), (d - 1, i + 1), (d + 1, i)):  # another character, one missing in y, one more in y
                    if at <= len(x) and at + to <= len(y) and at > new.get(to, -1):
                        new[to] = at
            front = new
        for d, i in front.items():
            while i < len(x) and i + d < len(y) and x[i] == y[i + d]:
                i += 1
            front[d] = i
        best = max(((i, i + d) for d, i in front.items()), default=(0, 0))
        out.append(max(best, out[-1], key=lambda p: p[0]) if out else best)
    return out


class Index:
    """Benchmark items and where their q-grams stand."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[int, str, list[tuple[int, int]]]] = []  # id, normalised text, (characters, edits) that count as found
        self.short: dict[str, list[tuple[int, list[str]]]] = {}  # first word: (id, words) of items below LEAST
        h: list[np.ndarray] = []
        for item, text in items:
            a, _ = normalise(text or "")
            if len(a) and a[-1] == 32:
                a = a[:-1]
            if len(a) < LEAST:
                if words := as_text(a).split():
                    self.short.setdefault(words[0], []).append((item, words))
                continue
            sizes = sorted({min(len(a), FRAGMENT), len(a) if len(a) < WHOLE else FRAGMENT})
            self.items.append((item, as_text(a), [(n, int(n * RATE)) for n in sizes]))
            h.append(grams(a))
        flat = np.concatenate(h) if h else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hashes = flat[order]
        self.owner = np.repeat(np.arange(len(h)), list(map(len, h)))[order] if h else np.zeros(0, np.int64)
        self.place = np.concatenate([np.arange(len(x)) for x in h])[order] if h else np.zeros(0, np.int64)
        self.longest = max(map(len, h), default=0)
        self.bits = min(24, max(16, int(np.log2(len(flat) + 1)) + 4))
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) of stretches of the text within the edit budget of a fragment; none within another of its item."""
        if not self.short and (not self.items or len(text) < LEAST - 5):
            return []
        a, places = normalise(text)
        out: list[tuple[int, int, int, int]] = []
        for item, start, end, edits in sorted(self._stretches(a) | self._short_items(a), key=lambda x: (x[0], x[1], -x[2], x[3])):
            if not out or out[-1][0] != item or end > out[-1][2]:
                out.append((item, start, end, edits))
        return [(item, int(places[start]), int(places[end - 1]) + 1, edits) for item, start, end, edits in out]

    def _short_items(self, a: np.ndarray) -> set[tuple[int, int, int, int]]:
        """Exact copies of the short items on word borders."""
        if not self.short:
            return set()
        words, at, out = as_text(a).split(), 0, set()
        for k, word in enumerate(words):
            for item, own in self.short.get(word, ()):
                if words[k : k + len(own)] == own:
                    out.add((item, at, at + sum(map(len, own)) + len(own) - 1, 0))
            at += len(word) + 1
        return out

    def _stretches(self, a: np.ndarray) -> set[tuple[int, int, int, int]]:
        h = grams(a)
        at = np.flatnonzero(self.filter[(h >> np.uint64(64 - self.bits)).astype(np.int64)])
        # fewer than BOUND q-grams anywhere within a fragment's reach: nothing can qualify
        if len(at) < BOUND or not (at[BOUND - 1 :] - at[: len(at) - BOUND + 1] <= FRAGMENT + EDITS).any():
            return set()
        low, high = np.searchsorted(self.hashes, h[at], "left"), np.searchsorted(self.hashes, h[at], "right")
        n = high - low
        if n.sum() < BOUND:
            return set()
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        owner, place = self.owner[entry], self.place[entry]
        diagonal = np.repeat(at, n) - place
        good = np.zeros(len(entry), bool)
        for move in (0, EDITS + 1):
            band = (diagonal + self.longest + move) // (2 * (EDITS + 1))
            order = np.lexsort((place, band, owner))
            o, b, p = owner[order], band[order], place[order]
            first, last = slice(0, len(o) - BOUND + 1), slice(BOUND - 1, None)
            full = (o[first] == o[last]) & (b[first] == b[last]) & (p[last] - p[first] <= FRAGMENT - Q)
            for k in range(BOUND):
                good[order[k : len(o) - BOUND + 1 + k][full]] = True
        if not good.any():
            return set()
        owner, place, diagonal = owner[good], place[good], diagonal[good]
        order = np.lexsort((place, diagonal, owner))
        owner, place, diagonal = owner[order], place[order], diagonal[order]
        breaks = (np.diff(owner) != 0) | (np.diff(diagonal) != 0) | (np.diff(place) != 1)
        starts = np.flatnonzero(np.concatenate([[True], breaks]))
        runs = np.diff(np.append(starts, len(owner)))
        text, out = as_text(a), set()
        for s in starts[runs > 1].tolist():  # a stretch holds a run of at least Q + 1 characters
            hit = self._align(text, int(owner[s]), int(place[s]), int(place[s] + diagonal[s]))
            if hit:
                out.add(hit)
        return out

    def _align(self, text: str, k: int, place: int, at: int) -> tuple[int, int, int, int] | None:
        """The longest stretch through this place with the fewest edits that will do: (item, start, end, edits) or None."""
        item, x, sizes = self.items[k]
        left = reach(x[:place][::-1], text[max(0, at - place - EDITS) : at][::-1], EDITS)
        right = reach(x[place:], text[at : at + len(x) - place + EDITS], EDITS)
        for size, most in sizes:
            for edits in range(most + 1):
                n, m = max((left[m][0] + right[edits - m][0], m) for m in range(edits + 1))
                if n >= size:
                    return item, at - left[m][1], at + right[edits - m][1], edits
        return None


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """The benchmark in parts of at most about block_chars characters each, so that an index stays small on every executor."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


SPAN = "struct<item_id:long,start:int,end:int,edits:int>"


def _passes(docs: DataFrame, benchmark: DataFrame, step: Callable[[DataFrame, Broadcast, bool], DataFrame], block_chars: int) -> DataFrame:
    """One pass over docs for each block of the benchmark: the driver and the executors hold the index of one block at a time.

    Between passes docs are written to the shared checkpoint folder, and the block's index is given up.
    """
    own = blocks(benchmark, block_chars)
    for k, block in enumerate(own):
        index = docs.sparkSession.sparkContext.broadcast(Index([(r.item_id, r.text) for r in block.collect()]))
        docs = step(docs, index, k + 1 == len(own))
        if k + 1 < len(own):
            docs = saved(docs)
            index.destroy()
    return docs


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, contaminated, item_ids (distinct, sorted), spans (item_id, start, end, edits).

    Null and empty texts, and benchmark items without letters or digits, match nothing; an empty benchmark marks no
    document. Items given twice count once, items of one id are looked for each; repeated documents and null ids give
    their own rows. Spans are in the order of item, place. Texts are read whole, whatever their length. Columns of docs
    but doc_id and text are ignored.
    """
    span = pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())])
    names = [f.name for f in span]

    def step(own: DataFrame, index: Broadcast, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for text, before in zip(batch.column(1), batch.column(2), strict=True):
                    found.append([*before.as_py(), *(dict(zip(names, x, strict=True)) for x in index.value.find(text.as_py() or ""))])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(batch.num_rows, pa.string()) if last else batch.column(1), pa.array(found, pa.list_(span))], names=["doc_id", "text", "spans"])

        return in_arrow(own, run, f"doc_id long, text string, spans array<{SPAN}>")

    none = F.array().cast(f"array<{SPAN}>").alias("spans")
    found = _passes(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), none), benchmark, step, block_chars)
    ids = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return found.select("doc_id", (F.size("spans") > 0).alias("contaminated"), ids.alias("item_ids"), F.array_sort("spans").alias("spans"))


def clean(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs that hold no passage of the benchmark, with all their columns.

    Null and empty texts hold none; repeated rows and null ids are judged each for itself.
    """
    at = docs.columns.index("text")

    def step(own: DataFrame, index: Broadcast, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not index.value.find(t.as_py() or "") for t in batch.column(at)], pa.bool_()))

        return in_arrow(own, run, own.schema)

    return _passes(docs, benchmark, step, block_chars)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "item_ids", F.size("spans").cast("long").alias("n_spans"), "spans")
