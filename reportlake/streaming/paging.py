"""The paging loop as a stream: pages land, are assembled, and the next requests come out.

Whoever sends requests reads the ledger's rounds and lands the answers; nothing here
talks to a network.  Each micro-batch decodes its pages, advances the assembly
(``streaming.assembly``) and issues the requests of the frontier (``operators.frontier``)
that no earlier round has made.  All three write by batch id, so a batch that is tried
again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions.protocol import PAGE_SIZE
from reportlake.operators.decode import decode_pages, stage_pages
from reportlake.operators.frontier import issue, next_requests, read_ledger
from reportlake.streaming.assembly import Assembly
from reportlake.streaming.incremental import RESPONSES_SCHEMA


def paging_step(spark: SparkSession, assembly: Assembly, landed: DataFrame, batch: int, modules: DataFrame, config: DataFrame,
                ledger: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Assemble a batch of landed responses and issue what is to be asked next (``frontier.REQUESTS``)."""
    assembly.advance(stage_pages(decode_pages(landed, with_types=True)), batch)
    issued = read_ledger(spark, ledger).where(F.col("round") < batch)
    return issue(spark, next_requests(modules, config, assembly.result().progress, issued, page_size), ledger, batch)


def start_paging(spark: SparkSession, landing: str, root: str, modules: DataFrame, config: DataFrame, fmt: str = "json",
                 page_size: int = PAGE_SIZE, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the loop over the files of ``landing``; state, ledger and checkpoint lie below ``root``."""
    paginated = modules.groupBy("report_key", F.col("name").alias("module")).agg(F.min(F.struct("query_template", "paginated")).alias("m"))
    assembly = Assembly(spark, f"{root}/assembly", paginated.select("report_key", "module", "m.paginated"))
    reader = spark.readStream.schema(RESPONSES_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def step(batch: DataFrame, batch_id: int) -> None:
        paging_step(spark, assembly, batch, batch_id, modules, config, f"{root}/ledger", page_size)

    writer = reader.load(landing).writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()
