"""Row numbers inside groups that may be huge, without one task per group.

``row_number() over (partition by g order by o)`` sends a whole group to one task.
Here the order key is first cut into buckets by splitters, the quantiles of a sketch of
all its values: however the values lie (dense, sparse, in clumps), each bucket holds about
the same number of rows.  Rows are numbered inside (group, bucket), bucket sizes are
counted with a partial aggregate, and a running sum over a group's buckets, at most
``BUCKETS`` rows, gives each bucket's offset.  The order column must be numeric and
unique within a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of the order key; as many splitters come to the driver.
BUCKETS = 1024

#: Accuracy of the sketch: a bucket holds at most 1 / BUCKETS + 2 / ACCURACY of all rows.
ACCURACY = 10_000


def order_buckets(df: DataFrame, order_col: str, buckets: int = BUCKETS) -> list:
    """The distinct values that cut ``order_col`` into buckets of about the same number of rows."""
    at = [k / buckets for k in range(1, buckets)]
    found = df.agg(F.percentile_approx(order_col, at, ACCURACY).alias("s")).first()[0]
    return sorted(set(found or []))


def bucket_of(order_col: str, splitters: list) -> F.Column:
    """How many splitters are below the value, by bisection (nulls: 0)."""
    if not splitters:
        return F.lit(0)
    cuts = F.lit(splitters)
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(len(splitters).bit_length()))])

    def further(lo: F.Column, half: F.Column) -> F.Column:
        return F.when(F.get(cuts, lo + half - 1) < F.col(order_col), lo + half).otherwise(lo)

    return F.aggregate(halves, F.lit(0), further)


def group_row_number(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    out_col: str = "rn",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add ``out_col`` = 1-based rank of ``order_col`` within ``group_cols``."""
    b = "_rk_bucket"
    with_b = df.withColumn(b, bucket_of(order_col, order_buckets(df, order_col, buckets)))
    local = with_b.withColumn(
        "_rk_local", F.row_number().over(Window.partitionBy(*group_cols, b).orderBy(order_col))
    )
    counts = with_b.groupBy(*group_cols, b).agg(F.count(F.lit(1)).alias("_rk_n"))
    w = Window.partitionBy(*group_cols).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, b, F.coalesce(F.sum("_rk_n").over(w), F.lit(0)).alias("_rk_off"))
    keys = [*group_cols, b]
    # At most BUCKETS rows a group, but as many groups as there are: no broadcast hint,
    # AQE broadcasts the table when it is small at run time.
    out = local.join(offsets, keys, "inner")
    return out.select(*df.columns, (F.col("_rk_off") + F.col("_rk_local")).cast("long").alias(out_col))
