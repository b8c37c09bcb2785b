"""Language identification with hyperdimensional profiles.

A letter is a random vector of +1 and -1; a trigram binds (multiplies) its three letters' vectors, permuted by their
place; a text bundles (adds) its trigrams' vectors; a language is the bundle of its texts. A text's language is the one
whose bundle has the largest cosine with the text's.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import held_out, in_arrow, map_rows, sampled, table

DIM = 1024
BLOCK = 4096  # distinct trigrams whose vectors are held at once
TRAIN_ROWS = 20_000  # training reads about so many rows, chosen by a hash of the id
_ALPHA: list[np.ndarray] = []
_VECTORS: dict[int, np.ndarray] = {}


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _ALPHA[0]


def letter_vector(code: int) -> np.ndarray:
    """The letter's vector (0: the gap between words), the same on every machine."""
    if code not in _VECTORS:
        if len(_VECTORS) > 5000:
            _VECTORS.clear()
        bits = np.unpackbits(np.frombuffer(hashlib.shake_256(code.to_bytes(4, "little")).digest(DIM // 8), np.uint8))
        _VECTORS[code] = bits.astype(np.int8) * 2 - 1
    return _VECTORS[code]


def codes(text: str) -> np.ndarray:
    """Lower-cased letters; every stretch of other characters, and both ends, as one 0. Empty: no letter."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.where(_alpha()[a], a, 0)
    a = np.concatenate([[0], a, [0]]).astype(np.uint32)
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != 0) | (a[:-1] != 0)
    a = a[keep]
    return a if len(a) > 1 else a[:0]


def bundles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bundles (texts x DIM) and how many trigrams each has.

    Distinct trigrams are taken in blocks of BLOCK: their vectors are bound, and times their counts added to the
    texts' bundles. So room for vectors and counts is that of a block, however long or varied the texts.
    """
    each = [codes(t) for t in texts]
    flat = np.concatenate(each) if each else np.zeros(0, np.uint32)
    out, sizes = np.zeros((len(texts), DIM), np.float32), np.array([max(0, len(e) - 2) for e in each], np.int64)
    if len(flat) < 3:
        return out, sizes
    used, dense = np.unique(flat, return_inverse=True) if len(flat) < 4096 or flat.max() > 0xFFFF else _dense(flat)
    owner = np.repeat(np.arange(len(each), dtype=np.int32), sizes)
    starts = np.concatenate([np.arange(max(0, len(e) - 2)) + at for e, at in zip(each, np.cumsum([0, *map(len, each[:-1])]), strict=True)])
    n = len(used)
    dense = dense.astype(np.int64)
    gram = (dense[starts] * n + dense[starts + 1]) * n + dense[starts + 2]
    if n**3 <= 1 << 22:
        present = np.flatnonzero(np.bincount(gram, minlength=n**3))
        place = np.zeros(n**3, np.int32)
        place[present] = np.arange(len(present))
        column = place[gram]
    else:
        present, column = np.unique(gram, return_inverse=True)
    if len(present) > BLOCK:
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
    cuts = np.searchsorted(column, np.arange(0, len(present) + BLOCK, BLOCK)) if len(present) > BLOCK else np.array([0, len(column)])
    for k, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        own = present[k * BLOCK : (k + 1) * BLOCK]
        vectors = np.ones((len(own), DIM), np.float32)
        for shift, place in ((2, own // (n * n)), (1, own // n % n), (0, own % n)):
            letters, which = np.unique(place, return_inverse=True)
            vectors *= np.roll(np.stack([letter_vector(int(used[c])) for c in letters]), shift, axis=1)[which]
        counts = np.bincount(owner[low:high].astype(np.int64) * len(own) + column[low:high] - k * BLOCK, minlength=len(each) * len(own))
        out += counts.reshape(len(each), -1).astype(np.float32) @ vectors
    return out, sizes


def _dense(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used = np.flatnonzero(np.bincount(flat, minlength=0x10000))
    place = np.zeros(0x10000, np.int32)
    place[used] = np.arange(len(used))
    return used, place[flat]


def _groups(batch: pa.RecordBatch, most_chars: int = 600_000, most_rows: int = 256) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) in groups of bounded size."""
    at, group, chars = 0, [], 0
    for k, text in enumerate(batch.column(1)):
        group.append(text.as_py())
        chars += len(group[-1] or "")
        if chars >= most_chars or len(group) >= most_rows:
            yield at, group
            at, group, chars = k + 1, [], 0
    if group:
        yield at, group


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Bundle per language from rows with text and lang that aren't held out.

    Each task adds up its own rows and sends one vector per language; their sums, one per language and dimension, come
    to the driver. With no such row there is no language, and every text is und.
    """
    ids = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = sampled(ids.select("doc_id", "text", "lang"), "doc_id", rows, 5)
    schema = pa.schema([("lang", pa.string()), ("dim", pa.int32()), ("value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for at, texts in _groups(batch):
                bundle, _ = bundles([t or "" for t in texts])
                own = np.array(langs[at : at + len(texts)])
                for lang in set(own.tolist()):
                    total[lang] = total.get(lang, 0) + bundle[own == lang].astype(np.float64).sum(axis=0)
        for lang, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIM), pa.array(np.arange(DIM, dtype=np.int32)), pa.array(v)], schema=schema)

    sums = in_arrow(chosen, run, "lang string, dim int, value double").groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect()
    out: dict[str, np.ndarray] = {}
    for r in sums:
        out.setdefault(r.lang, np.zeros(DIM))[r.dim] = r.value
    return {k: out[k] for k in sorted(out)}


def predict(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, cut at 0) of each row; repeated rows and null ids give their own rows.

    und and 0 where text is null or has no letter, or no language was learned. Ties: the first by name. Other columns
    of docs are ignored. A text is read whole, whatever its length.
    """
    names = list(model)
    profile = np.stack([v / max(np.linalg.norm(v), 1e-9) for v in model.values()]).astype(np.float32) if names else np.zeros((0, DIM), np.float32)

    def make():
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            ids = batch.column(0).to_pylist()
            for at, texts in _groups(batch):
                bundle, sizes = bundles([t or "" for t in texts])
                length = np.sqrt((bundle * bundle).sum(axis=1))
                cosine = (bundle @ profile.T) / np.maximum(length, 1e-9)[:, None]
                letters = sizes > 0
                for k in range(len(texts)):
                    if names and letters[k]:
                        best = int(np.argmax(cosine[k]))
                        yield ids[at + k], names[best], float(min(1.0, max(0.0, cosine[k, best])))
                    else:
                        yield ids[at + k], "und", 0.0

        return rows

    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, schema, "doc_id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
