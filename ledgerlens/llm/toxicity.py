"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence's score is a logistic function of its words and word beginnings. A document is toxic unless all its
sentences are clean (noisy-or): 1 - prod(1 - s). The weights come from document labels through that product, so the
sentences that carry a label are found along the way.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import held_out, in_arrow, map_rows, sampled, saved, table

TRAIN_ROWS = 8_000  # labelled rows that training reads, about; chosen by a hash of the id
MOST_FEATURES = 20_000
MOST_WORDS, MOST_COUNTED = 100_000, 250_000  # that a task remembers; then it forgets the words, and sends the counts on
THRESHOLD = 0.3
SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """The word and its beginnings of 3 to 6 letters (marked by a star)."""
    return [word, *(word[:k] + "*" for k in (3, 4, 5, 6) if len(word) >= k)]


def sentences(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    for m in SENTENCE.finditer(text):
        if m.start() > at:
            yield at, m.start()
        at = m.end()
    if at < len(text):
        yield at, len(text)


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._seen: dict[str, float] = {}

    def word(self, word: str) -> float:
        w = self.weights
        return sum(w[f] for f in features(word) if f in w)

    def words(self, words: list[str]) -> float:
        seen, total = self._seen, 0.0
        for w in words:
            v = seen.get(w)
            if v is None:
                if len(seen) > MOST_WORDS:
                    seen.clear()
                v = seen[w] = self.word(w)
            total += v
        return total

    def score(self, text: str, spans: bool = False):
        """Probability that the text is toxic; with spans also (start, end, score) of each sentence that alone reaches the threshold."""
        clean, found, quiet, base = 0.0, [], 0, math.log1p(math.exp(self.bias))
        lower = text.lower()
        if spans:
            for a, b in sentences(text):
                z = self.bias + self.words(WORD.findall(text[a:b].lower()))
                s = 1 / (1 + math.exp(-max(-700, min(700, z))))
                clean += max(z, 0) + math.log1p(math.exp(-abs(z)))
                if s >= THRESHOLD:
                    found.append((a, b, s))
            return 1 - math.exp(-clean), found
        for part in SENTENCE.split(lower):
            if not part:
                continue
            total = self.words(WORD.findall(part))
            if total == 0.0:
                quiet += 1
            else:
                z = self.bias + total
                clean += max(z, 0) + math.log1p(math.exp(-abs(z)))
        return 1 - math.exp(-(clean + quiet * base))


def labelled(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """text, y of a sample of labelled documents that aren't held out; at most about `rows`, so their ids may be broadcast.

    Repeated labels of an id count once, by their largest value; rows without id, label or text are left out.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    ids = saved(sampled(saved(ids), "doc_id", rows, 11))
    return documents.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "y")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many toxic and other documents each feature stands (those of two documents or more, or toxic)."""
    toxic, other, n = Counter(), Counter(), [0, 0]
    schema = pa.schema([("f", pa.string()), ("p", pa.int64()), ("n", pa.int64())])

    def out() -> Iterator[pa.RecordBatch]:
        keys = [*toxic, *(k for k in other if k not in toxic)]
        for at in range(0, len(keys), 20_000):
            part = keys[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([toxic[k] for k in part], pa.int64()), pa.array([other[k] for k in part], pa.int64())], schema=schema)
        toxic.clear()
        other.clear()

    for batch in batches:
        for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            words = set(WORD.findall(text.as_py().lower()))
            found = {f for w in words for f in features(w)}
            (toxic if y > 0 else other).update(found)
            n[y > 0] += 1
            if len(toxic) + len(other) > MOST_COUNTED:
                yield from out()
    yield from out()
    yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([n[1]]), pa.array([n[0]])], schema=schema)


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Weights of a Model, from labelled rows that aren't held out.

    With no toxic or no other document in the sample there is nothing to tell them apart by: no weights, and a bias at
    which any sentence is clean. Of equally good features at the end of the list the first by name stays.
    """
    sample = saved(labelled(documents, labels, label, rows))
    counts = in_arrow(sample, _counts, "f string, p long, n long").groupBy("f").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    counts = saved(counts.where("p > 0"))
    total = [r for r in counts.where("f = ''").collect()]
    n_toxic = total[0].p if total else 0
    n_other = total[0].n if total else 0
    if not n_toxic or not n_other:
        return Model({}, -12.0)
    # features that are at least three times as frequent in toxic documents, by their log odds times their count
    rate = (F.col("p") + 0.1) / n_toxic / ((F.col("n") + 0.5) / n_other)
    best = counts.where((F.col("f") != "") & (F.col("p") >= 2) & (rate >= 3)).orderBy((F.col("p") * F.log(rate)).desc(), "f").limit(MOST_FEATURES).collect()
    index = {r.f: k for k, r in enumerate(best)}
    start = np.array([min(3.0, math.log((r.p + 0.1) / n_toxic / ((r.n + 0.5) / n_other))) for r in best])

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """y, number of sentences, features of the sentences that have any (flat, with their lengths)."""
        schema = pa.schema([("y", pa.float64()), ("n", pa.int64()), ("sizes", pa.list_(pa.int32())), ("ids", pa.list_(pa.int32()))])
        for batch in batches:
            rows = []
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                n, sizes, ids = 0, [], []
                for part in SENTENCE.split(text.as_py().lower()):
                    if part:
                        n += 1
                        found = [index[f] for w in WORD.findall(part) for f in features(w) if f in index]
                        if found:
                            sizes.append(len(found))
                            ids += found
                rows.append((y, n, sizes, ids))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    got = in_arrow(sample, bags, "y double, n long, sizes array<int>, ids array<int>").toArrow().to_pydict()
    return Model(*_fit(got, index, start))


def _fit(got: dict, index: dict[str, int], start: np.ndarray, steps: int = 150) -> tuple[dict[str, float], float]:
    """Gradient descent (Adam) on the noisy-or likelihood; the weights are kept at 0 or above."""
    y, n = np.array(got["y"]), np.array(got["n"], float)
    per_doc = np.array([len(s) for s in got["sizes"]])
    sizes = np.array([s for row in got["sizes"] for s in row], np.int64)
    ids = np.array([i for row in got["ids"] for i in row], np.int64)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    doc = np.repeat(np.arange(len(y)), per_doc)
    quiet = n - per_doc
    w, b = start / 4, -7.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(sentence, w[ids], len(sizes)) if len(sizes) else np.zeros(0)
        s, base = 1 / (1 + np.exp(-np.clip(z, -50, 50))), 1 / (1 + math.exp(-b))
        clean = np.bincount(doc, np.logaddexp(0, z), len(y)) + quiet * np.logaddexp(0, b)
        p = np.clip(1 - np.exp(-clean), 1e-9, 1 - 1e-12)
        # d loss / d z of a sentence is s for a clean document and -s (1 - p) / p for a toxic one
        pull = np.where(y > 0, -(1 - p) / p, 1.0)
        g = s * pull[doc]
        gw = np.bincount(ids, g[sentence], len(w)) + 0.01 * w
        gb = g.sum() + (quiet * base * pull).sum()
        grad = np.append(gw, gb)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = np.maximum(w - move[:-1], 0), b - move[-1]
    return {f: float(w[k]) for f, k in index.items() if w[k] > 1e-3}, float(b)


def score(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """doc_id, score of each row and, on request, the offending sentences (start, end, score; in order).

    Null and empty texts score 0 (no sentence), as do all texts of a model without labels to within its bias. Repeated
    rows and null ids give their own rows; other columns are ignored; no rows give none. Texts are read whole.
    """
    weights, bias = model.weights, model.bias

    def make():
        own = Model(weights, bias)

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if spans:
                    p, found = own.score(text.as_py() or "", True)
                    yield doc, float(p), [{"start": a, "end": b, "score": s} for a, b, s in found]
                else:
                    yield doc, float(own.score(text.as_py() or ""))

        return rows

    fields = [("doc_id", pa.int64()), ("score", pa.float64())] + [("sentences", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))] * spans
    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, pa.schema(fields), "doc_id long, score double" + ", sentences array<struct<start:int,end:int,score:double>>" * spans)


def flagged(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that score below the threshold, with all their columns, in one pass.

    Null and empty texts score 0 and stay. Repeated rows and null ids are judged each for itself.
    """
    weights, bias, names = model.weights, model.bias, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = Model(weights, bias), names.index("text")
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py() or "") < THRESHOLD for t in batch.column(at)], pa.bool_()))

    return in_arrow(docs, run, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
