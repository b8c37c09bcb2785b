"""Quality by gradient-boosted trees over histograms of document statistics; the trees are flat arrays in use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import held_out, in_arrow, map_rows, sampled, saved, table
from ledgerlens.llm.quality_rules import repeated_words

TRAIN_ROWS = 40_000  # labelled rows that training reads, about; their statistics are a few hundred bytes each
THRESHOLD = 0.7
FEATURES = ["log_chars", "log_words", "mean_word", "std_word", "distinct_words", "stutter", "repeated_windows", "repeated_pairs", "lines_per_word", "dup_lines", "upper", "digits", "spaces", "marks", "symbols", "pipes", "bangs", "stops", "commas", "words_with_symbol", "top_word", "short_words", "max_word", "other"]
DEPTH, TREES, BINS, RATE, RIDGE = 4, 80, 32, 0.15, 1.0


def statistics(text: str) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    words = text.split()
    k = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    _, counts = np.unique(h, return_counts=True) if words else (None, np.ones(1))
    data = text.encode("utf-8", "surrogatepass")
    a = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in text.split("\n") if x]
    pairs = (h[:-1] * np.uint64(31) + h[1:]) if len(h) > 1 else h
    distinct_pairs = len(np.unique(pairs)) if len(pairs) else 1
    symbols = int(a[[35, 36, 37, 38, 42, 60, 62]].sum())
    bytes_ = max(1, len(data))
    return [
        np.log1p(n), np.log1p(len(words)), sizes.mean(), sizes.std(), len(counts) / k, float((h[1:] == h[:-1]).sum()) / k, repeated_words(h) / k, 1 - distinct_pairs / max(1, len(pairs)),
        len(lines) / k, (len(lines) - len(set(lines))) / max(1, len(lines)), a[65:91].sum() / bytes_, a[48:58].sum() / bytes_, a[32] / bytes_, a[[34, 39, 40, 41, 58, 59]].sum() / bytes_, symbols / k, a[124] / k, a[33] / k,
        a[46] / k, a[44] / k, sum(map(text.count, ("###", "***", "$$$", "%%%", "&&&"))) / k, counts.max() / k, float((sizes <= 2).sum()) / k, float(min(sizes.max(), 1000)), a[128:].sum() / bytes_,
    ]


def all_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (the statistics) of each row; null text counts as empty: all 0."""

    def make():
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield doc, list(map(float, statistics(text.as_py() or "")))

        return rows

    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float32()))])
    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, schema, "doc_id long, x array<float>")


class Trees:
    """Complete binary trees of one depth: node k of a tree has the children 2k + 1 and 2k + 2."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, base: float):
        self.feature, self.cut, self.value, self.base = feature, cut, value, base

    def raw(self, x: np.ndarray) -> np.ndarray:
        """All rows go down all trees together: one gather per level."""
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        return self.base + self.value[trees, node - (2**DEPTH - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -50, 50)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Log-loss boosting; with one class only, or no rows, trees that say the (smoothed) share of it."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    n_trees = TREES if len(y) and 0 < y.sum() < len(y) else 0
    feature, cut, value = np.zeros((n_trees, inner), np.int64), np.full((n_trees, inner), np.inf), np.zeros((n_trees, leaves))
    if not n_trees:
        return Trees(feature, cut, value, base)
    d = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    offset = np.arange(d) * BINS
    raw = np.full(len(y), base)
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            local = node - first
            slot = (local[:, None] * d * BINS + offset[None, :] + binned).ravel()
            size = width * d * BINS
            hg = np.bincount(slot, np.repeat(g, d), size).reshape(width, d, BINS).cumsum(axis=2)
            hh = np.bincount(slot, np.repeat(h, d), size).reshape(width, d, BINS).cumsum(axis=2)
            tg, th = hg[:, :, -1:], hh[:, :, -1:]
            gain = hg**2 / (hh + RIDGE) + (tg - hg) ** 2 / (th - hh + RIDGE) - tg**2 / (th + RIDGE)
            gain[(hh < 1e-2) | (th - hh < 1e-2)] = 0
            for k in range(width):
                j, b = np.unravel_index(np.argmax(gain[k]), (d, BINS))
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    feature[t, first + k], cut[t, first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        leaf = node - inner
        value[t] = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        raw += value[t][leaf]
    return Trees(feature, cut, value, base)


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Fits on the statistics of labelled rows that aren't held out. Repeated labels of an id count once, by their largest value."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    got = stats.join(sampled(ids, "doc_id", rows, 17), "doc_id").select("x", "y").toArrow().to_pydict()
    return fit(np.array(got["x"], np.float64).reshape(-1, len(FEATURES)), np.array(got["y"], np.float64))


def score(stats: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, score of each row of stats (doc_id, x): 0 to 1. Repeated rows and null ids give their own rows, no rows none.

    A statistic equal to a cut goes to the left. The statistics of a null or empty text are all 0, which has a score too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(x))], names=["doc_id", "score"])

    return in_arrow(stats, run, "doc_id long, score double")


def op7_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = saved(all_statistics(table(spark, sf_dir, "documents")))
    out = score(stats, train(stats, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
