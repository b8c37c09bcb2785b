"""The corpus pipeline: documents in, token counts and digests of the kept documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.checkpoints import shared_checkpoints
from ledgerlens.llm import bpe, decontamination, near_dedup, quality_rules, toxicity
from ledgerlens.llm.common import table

# Of all stages: further columns of docs pass through, whatever their names; rows of a null or repeated doc_id are rows
# of their own but for near_dedup; no rows give none; texts are read whole, however long.


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labels of documents that reach this stage.

    Null and empty texts stay. Where no label reaches the stage, all documents stay.
    """
    return toxicity.flagged(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy in force keeps, by their entries in the rules' ledger. Null and empty texts go: too few words."""
    return quality_rules.kept(docs, "v1")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id.

    Texts without words stay, one a doc_id. Rows of one doc_id, or of none, go where they are near-duplicates of each
    other or of rows before them, and stay where they aren't.
    """
    return near_dedup.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark. Null and empty texts stay; an empty benchmark removes nothing."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document; null text counts as empty: no tokens."""
    return bpe.encode_documents(docs, bpe.multi_vocabulary())


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_rules_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]
#: SQL expresses neither the trained stage nor the encoding; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written as Parquet in the shared folder and read again.

    A stage's folder goes once the next one's is written; the last one's is what the result reads.
    """
    shared_checkpoints(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{spark.sql('select uuid()').first()[0]}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        own = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(own)
        docs = spark.read.parquet(own)
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = own
    return docs
