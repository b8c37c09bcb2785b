"""Chain continuity: parent checks, fork point, rollback, recovery after a crash, checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broken_parents(blocks: DataFrame) -> DataFrame:
    """Blocks whose previous_hash isn't the hash of the block one below, if that block is there."""
    below = blocks.select((F.col("height") + 1).alias("height"), F.col("hash").alias("expected"))
    return blocks.join(below, "height").where("previous_hash <> expected").select("height", "expected", F.col("previous_hash").alias("actual"))


def fork_point(stored: DataFrame, canonical: DataFrame) -> DataFrame:
    """Highest height at which both chains have the same hash (null: none)."""
    return stored.select("height", "hash").join(canonical.select("height", "hash"), ["height", "hash"]).agg(F.max("height").alias("fork_height"))


def rollback(rows: DataFrame, height: int, column: str = "block_height") -> DataFrame:
    """Rows at or below the height; tables laid out by height drop whole files."""
    return rows.where(F.col(column) <= height)


def complete_height(blocks: DataFrame, tx_in_block: DataFrame) -> DataFrame:
    """Highest block that has all its transactions (null: none)."""
    n = tx_in_block.groupBy(F.col("block_height").alias("height")).agg(F.count("*").alias("actual"))
    return blocks.join(n, "height").where("actual = tx_count and actual > 0").agg(F.max("height").alias("complete_height"))


def block_complete(blocks: DataFrame, tx_in_block: DataFrame) -> DataFrame:
    n = tx_in_block.groupBy(F.col("block_height").alias("height")).agg(F.count("*").alias("actual"))
    return blocks.join(n, "height", "left").select("height", F.col("tx_count").alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual"))


def height_gaps(blocks: DataFrame) -> DataFrame:
    """height, nxt: heights after which some are missing, and the next there is."""
    gaps = sequence_gaps(blocks.select(F.col("height").alias("seq")))
    return gaps.select((F.col("expected") - 1).alias("height"), F.col("got").alias("nxt"))


def sequence_gaps(notes: DataFrame, bucket: int = 1 << 20) -> DataFrame:
    """Notifications (seq) whose predecessor by number is missing, with the number before: expected, got.

    lag() runs within buckets of numbers; the first number of a bucket is matched with the last of the buckets before
    it on one row per bucket, so no task sees all rows.
    """
    from pyspark.sql import Window as W

    own = notes.select("seq").withColumn("_b", F.floor(F.col("seq") / bucket))
    inside = own.withColumn("before", F.lag("seq").over(W.partitionBy("_b").orderBy("seq")))
    edges = own.groupBy("_b").agg(F.max("seq").alias("last"))
    carried = edges.select("_b", F.lag("last").over(W.orderBy("_b")).alias("carried"))
    both = inside.join(carried, "_b").withColumn("before", F.coalesce("before", "carried"))
    return both.where("before is not null and seq <> before + 1").select((F.col("before") + 1).alias("expected"), F.col("seq").alias("got"))
