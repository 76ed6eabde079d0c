"""Incremental decode of newly landed response pages.

Landed pages arrive as files of the ``responses`` table (JSON lines or
Parquet).  Decoding is stateless per page (all windows of the format are
page-local), so each micro-batch is decoded by the batch operator and appended
to a Parquet table in staged form (one folder per batch id); page assembly
(boundary rows, stop rules, typing: ``plans.extract.extract(sink_table)``)
reads that table, so boundary rows across batches are handled there.  Non-time windows are not allowed on
streams, hence ``foreachBatch``.  The stream's checkpoint records which files
each batch took, and a batch's folder is overwritten on retry, so a restart
after failure neither loses nor duplicates pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reportlake.operators.decode import PAGE_KEYS, decode_pages, stage_pages
from reportlake.session import spread

RESPONSES_SCHEMA = T.StructType([
    T.StructField("report_key", T.StringType()),
    T.StructField("module", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.StringType()),
])


def decoded_for_storage(decoded: DataFrame) -> DataFrame:
    """Decoded pages in the compact staged form read by ``plans.extract``
    (JSON text per row, per-page column types, page facts)."""
    return stage_pages(decoded)


def start_incremental_decode(
    spark: SparkSession,
    landing: str,
    sink: str,
    checkpoint: str,
    fmt: str = "json",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the stream; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(RESPONSES_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One folder per micro-batch, overwritten: a retried batch replaces its
        # own output instead of appending twice.  The files of a batch may be few, so its pages
        # are dealt over many tasks.
        decoded_for_storage(decode_pages(spread(batch, *PAGE_KEYS), with_types=True)).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
