"""The request frontier -- the next request of every module that is not finished.

A module's progress (``plans.extract.Extraction.progress`` or the state of
``streaming.assembly``) says which page it waits for and gives the restart tokens of the
page before.  The frontier joins that with the modules and their report's config to
request payloads, and leaves out what the ledger of issued requests holds.  So the loop
"land, assemble, ask" can be run again at any point: without new pages it asks nothing
twice, and a page that landed anew with other tokens gives a new request.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions.protocol import PAGE_SIZE
from reportlake.operators.payloads import build_payloads, window_config

#: Why a module's assembly ended, where more pages are to come.
UNFINISHED = ("landing_end", "missing_first_page")

REQUESTS = "request_id string, report_key string, module string, page_no int, restart_tokens string, payload string"


def next_requests(modules: DataFrame, config: DataFrame, progress: DataFrame, issued: DataFrame | None = None,
                  page_size: int = PAGE_SIZE) -> DataFrame:
    """One request per unfinished module: ``REQUESTS``.

    ``modules``: (report_key, name, query_template, paginated); a name that several modules
    of a report share is asked once, by the least template.  ``progress``: (report_key, module, next_page,
    restart_tokens, stop_reason); a module that is not in it starts with page 1.  A module
    that has failed, stopped or ended asks nothing; single-shot modules ask for page 1 only, with their
    template as it was captured.  ``issued``: (request_id) of requests made before.  All joins
    are on module keys, with one row per module on either side.
    """
    keys = ["report_key", "module"]
    once = modules.groupBy("report_key", F.col("name").alias("module")).agg(
        F.min(F.struct("query_template", "paginated")).alias("m"))
    state = progress.select(*keys, "next_page", F.col("restart_tokens").alias("tokens"), "stop_reason")
    open_ = once.join(state, keys, "left").where(F.col("stop_reason").isNull() | F.col("stop_reason").isin(*UNFINISHED))
    page_no = F.coalesce("next_page", F.lit(1))
    requests = open_.select(
        *keys, page_no.cast("int").alias("page_no"), F.when(F.col("m.paginated") & (page_no > 1), F.col("tokens")).alias("restart_tokens"),
        F.col("m.query_template").alias("query_template"))
    asked = build_payloads(requests, config, window_config(page_size, F.col("restart_tokens")))
    asked = asked.where("payload IS NOT NULL")
    name = F.sha2(F.to_json(F.struct(*keys, "page_no", "payload")), 256)
    asked = asked.select(name.alias("request_id"), *keys, "page_no", "restart_tokens", "payload")
    return asked if issued is None else asked.join(issued.select("request_id"), "request_id", "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The requests issued below ``path`` so far (none where it is not there yet)."""
    try:
        return spark.read.schema(f"{REQUESTS}, round bigint").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{REQUESTS}, round bigint")


def issue(spark: SparkSession, requests: DataFrame, path: str, round_no: int) -> DataFrame:
    """Add requests to the ledger as one round and read them back; a round done again replaces itself."""
    folder = f"{path.rstrip('/')}/round={round_no}"
    requests.write.mode("overwrite").parquet(folder)
    return spark.read.schema(REQUESTS).parquet(folder)
