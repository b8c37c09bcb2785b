"""What the text operators share: checkpoints in the shared folder, the held-out rule, Arrow row streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.checkpoints import saved_alone as saved  # noqa: F401 - for the operators

#: Spark's setting for the size of a batch that goes to Python, and the most that the operators let it be.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows kept from training: crc32 of the id as text, mod 4, is 2 (a null id is in no fold: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(ids: DataFrame, key: str, at_most: int, seed: int) -> DataFrame:
    """About at_most rows of ids, chosen by a hash of the key; all of them where there are fewer."""
    n = ids.count()
    if n <= at_most:
        return ids
    return ids.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) < F.lit(int(1e6 * at_most / n)))


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many _ at its end as it takes to be none of df's columns (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """many.join(one, key, how) on a long key, where one comes from many.groupBy(key), and a key may have very many rows.

    Joined by the key itself, one would stay where the groupBy put it, and Spark doesn't split partitions next to such a
    side. By another form of the key both sides are shuffled (one's row a key is little), and adaptive execution deals
    the rows of a large partition of many to several tasks.
    """
    name = fresh(many, "_key")
    other = lambda df: df.withColumn(name, F.col(key).bitwiseXOR(F.lit(1)))
    return other(many).join(other(one).drop(key), name, how).drop(name)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(run, schema), in batches of at most about BATCH_BYTES (the session's setting is lowered to that).

    A Python worker serves many tasks, and both it and the JVM keep the room of the largest batch; what a task has
    freed is given back at its end.
    """
    conf = df.sparkSession.conf
    now = conf.get(BATCH_SETTING, str(BATCH_BYTES + 1))
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(task, schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[tuple] | list[tuple]]], schema: pa.Schema, ddl: str) -> DataFrame:
    """mapInArrow with a per-task function: make() builds the state once a task, its result turns a batch into rows.

    Rows are sent on in slices, so that a task never holds more than a batch of input and a slice of output.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows: list[tuple] = []
            for row in fn(batch):
                rows.append(row)
                if len(rows) >= 2000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    return in_arrow(df, run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
