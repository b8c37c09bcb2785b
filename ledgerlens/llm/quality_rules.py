"""Quality rules as a bitmask ledger: every rule once per document, policies and ablations from the stored bits."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import fresh, in_arrow, map_rows, table

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter"]
#: Bit k is set where rule k fails; each rule reads measures only.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 14 * n_words",
    "stutter": "100 * n_stutter > 20 * n_words",
}
#: Versions of policies: the rules that reject a document. A policy is a mask, so changing one needs no new pass over texts.
POLICIES = {"base": ["few_words", "repeated_windows"], "v1": list(RULES)}


def mask(rules: list[str]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def measure(text: str) -> tuple[int, ...]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: splits at x20 and x09-x0D alone
    lines = [x for x in data.split(b"\n") if x.strip()]
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(data.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(h), len(lines), int((h[1:] == h[:-1]).sum())


def repeated_words(h: np.ndarray, window: int = 8) -> int:
    """Words that stand in a window (a power of two words) found twice or more, given hashes of the words."""
    if len(h) <= window:
        return 0
    step, factor = 1, np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        while step < window:
            h = h[:-step] * factor + h[step:]
            h ^= h >> np.uint64(29)
            factor = factor * factor + np.uint64(2)
            step *= 2
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(h, twice).astype(np.int32)
    edge = np.zeros(len(h) + window, np.int32)
    edge[: len(h)] += starts
    edge[window:] -= starts
    return int((np.cumsum(edge) > 0).sum())


def _bits(measures: Callable[[str], str]) -> Column:
    """The rules' bits, given how SQL names a measure."""
    total = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        own = re.sub(r"\b(" + "|".join(MEASURES) + r")\b", lambda m: measures(m[1]), rule)
        total = total.bitwiseOR(F.when(F.expr(own), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return total


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: id, the measures, failures (bit k: rule k of RULES failed).

    Null text counts as empty: all measures 0, and few_words fails. Repeated rows and null ids give their own rows, no
    rows give none; other columns are ignored.
    """

    def make():
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield (doc, *measure(text.as_py() or ""))

        return rows

    schema = pa.schema([(id_column, pa.int64()), *((m, pa.int64()) for m in MEASURES)])
    out = map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")), make, schema, f"{id_column} long, " + ", ".join(f"{m} long" for m in MEASURES))
    return out.withColumn("failures", _bits(lambda m: m))


def apply_policy(entries: DataFrame, policy: str, column: str = "kept") -> DataFrame:
    return entries.withColumn(column, F.col("failures").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0)


def with_ledger(docs: DataFrame, column: str, text_column: str = "text") -> DataFrame:
    """docs with one more column: its ledger entry, a struct of the measures and failures."""
    at, kind = docs.columns.index(text_column), pa.struct([(m, pa.int64()) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = [dict(zip(MEASURES, measure(t.as_py() or ""), strict=True)) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(entries, kind)], names=[*batch.schema.names, column])

    measured = in_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(column, T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))]))
    return measured.withColumn(column, F.struct(f"{column}.*", _bits(lambda m: f"`{column}`.{m}").alias("failures")))


def kept(docs: DataFrame, policy: str, text_column: str = "text") -> DataFrame:
    """The rows of docs that the policy keeps, with all their columns: each row gets its ledger entry, the policy reads its bits.

    Null text counts as empty, which few_words rejects. Repeated rows and null ids are judged each for itself.
    """
    column = fresh(docs, "_entry")
    judged = with_ledger(docs, column, text_column)
    return judged.where(F.col(f"{column}.failures").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects.

    The ledger is first reduced to its distinct masks (at most 2 to the number of rules), then read by bit.
    """
    m = mask(POLICIES[policy])
    masks = entries.groupBy(F.col("failures").bitwiseAND(F.lit(m).cast("long")).alias("m")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).cast("long").alias("bit")) for r in POLICIES[policy]])).alias("r")
    each = masks.select("m", "n", rules).where(F.col("m").bitwiseAND(F.col("r.bit")) != 0)
    return each.groupBy(F.col("r.rule").alias("rule")).agg(F.sum("n").alias("n_failed"), F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = apply_policy(apply_policy(ledger(table(spark, sf_dir, "documents")), "v1"), "base", "base_kept")
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("base_kept")).alias("base_failed"), "kept", "n_lines", "n_stutter", "failures")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of policy v1 does to documents: how many fail it, and how many only it rejects."""
    return ablation(ledger(table(spark, sf_dir, "documents")), "v1")


_MEASURED = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, unnest(range(1, len(words) - 6)) AS i, words FROM w WHERE len(words) >= 8),
h AS (SELECT rid, i, array_to_string(words[i:i+7], ' ') AS gram FROM g),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM h) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + j) AS n FROM r, (SELECT unnest(range(8)) AS j) GROUP BY rid),
st AS (SELECT rid, count(*) AS n FROM (SELECT rid, unnest(words) AS a, unnest(words[2:]) AS b FROM w) WHERE a = b GROUP BY rid),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(st.n, 0) AS n_stutter
      FROM w LEFT JOIN c USING (rid) LEFT JOIN st USING (rid)),
b AS (SELECT *, """ + " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES.values())) + """ AS failures FROM m)
"""
OP8_SQL = _MEASURED + r"""
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
       OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 100 * n_stutter > 20 * n_words) AS kept,
  CAST(n_lines AS BIGINT) AS n_lines, CAST(n_stutter AS BIGINT) AS n_stutter, CAST(failures AS BIGINT) AS failures
FROM b
"""
ABLATION_SQL = (
    _MEASURED
    + ", bits(rule, bit) AS (VALUES "
    + ", ".join(f"('{rule}', {1 << k})" for k, rule in enumerate(RULES))
    + ") SELECT rule, count(*) AS n_failed, count(*) FILTER (WHERE failures = bit) AS n_only FROM b, bits WHERE failures & bit <> 0 GROUP BY rule"
)
