"""Helpers shared by the operators: inputs, batches by bytes, distributed running totals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows an Arrow batch holds at most; whole texts, so far below Spark's default.
BATCH_ROWS = 2000

#: Target rows of a block (see ``running_totals``).
RANK_BLOCK_ROWS = 20_000


def arrow_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch carries to a Python worker, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, budget: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each hold about ``budget`` bytes (one row at least)."""
    for batch in batches:
        col = batch.column(column)
        start = used = 0
        sizes = pc.binary_length(col).to_pylist()
        for i, n in enumerate(sizes):
            n = n or 0
            if i > start and used + n > budget:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += n
        if len(sizes) > start:
            yield batch.slice(start)


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, n_rows: int,
                   weight: Column | None = None, block_rows: int = RANK_BLOCK_ROWS) -> DataFrame:
    """Add ``out``: the total weight (1 a row by default) of the rows before a row within its ``keys``.

    Rows are dealt to blocks by a hash of ``order``; each (keys, block) is summed up
    by itself and starts after the totals of the earlier blocks of its key, so a
    key with a third of all rows is done by many tasks.  Only the totals of the
    blocks, ``n_rows / block_rows`` a key at most, meet in one window.  The order
    of a key's rows is that of (block, ``order``): the same on every run if
    ``order`` is a total order; rows equal in all of it are interchangeable.
    """
    n_blocks = max(1, -(-n_rows // block_rows))
    names = [f"__o{i}" for i in range(len(order))]
    df = df.withColumns({**dict(zip(names, order)), "__w": F.lit(1).cast("long") if weight is None else weight})
    df = df.withColumn("__block", F.pmod(F.xxhash64(*names), F.lit(n_blocks)).cast("int"))
    totals = df.groupBy(*keys, "__block").agg(F.sum("__w").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__block").alias("__b"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(*keys, "__block").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("__before", F.coalesce(F.sum("__w").over(within), F.lit(0)))
    same = F.col("__block") == F.col("__b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    joined = summed.join(starts, same)
    gone = [*names, "__w", "__block", "__b", "__start", "__before", *[f"__k_{k}" for k in keys]]
    return joined.withColumn(out, (F.col("__start") + F.col("__before")).cast("long")).drop(*gone)
