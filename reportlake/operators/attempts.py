"""HTTP attempt logs -> effective response per page: E5, E6, E7.

Replaying a query may take several attempts.  From a landed attempt log
(report_key, module, page_no, attempt, status, retry_after, body) this finds,
for every request, the attempt that ended it:

* the first 200;
* 401/403 are retried while ``attempt < max_retries``, then end it as an
  authorisation failure (the whole module fails, see ``assemble``);
* 429/500/502/503/504 are retried while ``attempt < max_retries``, then end it;
* any other status ends it at once.

A request with no ending attempt yet is ``pending``.  One hash aggregate over
attempt numbers and one join on (request, attempt), which is unique in a log; a
request has at most ``max_retries + 1`` attempts, so groups are bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.functions.protocol import AUTH_STATUS, MAX_RETRIES, RETRY_BASE_DELAY, RETRYABLE_STATUS

REQUEST_KEYS = ("report_key", "module", "page_no")


def is_terminal(max_retries: int = MAX_RETRIES) -> Column:
    s = F.col("status")
    return (
        (s == 200)
        | ~s.isin(*RETRYABLE_STATUS, *AUTH_STATUS)
        | (F.col("attempt") >= F.lit(max_retries))
    )


def outcome_of(status: Column) -> Column:
    """Ok / auth_failed / gave_up for an ending attempt's status."""
    return (
        F.when(status == 200, F.lit("ok"))
        .when(status.isin(*AUTH_STATUS), F.lit("auth_failed"))
        .otherwise(F.lit("gave_up"))
    )


def resolve_attempts(
    attempts: DataFrame,
    max_retries: int = MAX_RETRIES,
    keys: tuple[str, ...] = REQUEST_KEYS,
) -> DataFrame:
    """E5: one row per request: the ending attempt (status, body), its outcome,
    and the number of attempts logged; ``outcome = 'pending'`` when none ended it."""
    extra = [c for c in ("retry_after", "body") if c in attempts.columns]
    # Only numbers are aggregated; the ending attempt's header and body come by one join on its unique key.
    agg = attempts.groupBy(*keys).agg(
        F.min(F.when(is_terminal(max_retries), F.col("attempt"))).alias("attempt"),
        F.count(F.lit(1)).cast("int").alias("n_attempts"),
    )
    ending = attempts.where(is_terminal(max_retries)).select(*keys, "attempt", "status", *extra)
    found = agg.join(ending, [*keys, "attempt"], "left")
    return found.select(
        *keys,
        "attempt",
        "status",
        *extra,
        "n_attempts",
        F.when(F.col("attempt").isNull(), F.lit("pending")).otherwise(outcome_of(F.col("status"))).alias("outcome"),
    )


def with_retry_delay(attempts: DataFrame, retry_after_col: str = "retry_after", attempt_col: str = "attempt",
                     base_delay: float = RETRY_BASE_DELAY, out_col: str = "planned_delay_s") -> DataFrame:
    """E7 as a column on an attempt log (audit only: nothing sleeps)."""
    ra = F.col(retry_after_col)
    parsed = F.when(ra.isNotNull() & (ra != ""), ra.try_cast("double"))
    backoff = F.lit(base_delay) * F.pow(F.lit(2.0), F.col(attempt_col).cast("double"))
    return attempts.withColumn(out_col, F.coalesce(parsed, backoff))


def responses_from_attempts(attempts: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """E5 -> E1: the landed ``responses`` table implied by an attempt log.

    Each request contributes its ending attempt's status and body; a request
    still pending gives no page (assembly then stops before it).  An
    authorisation failure keeps its 401/403 status, which fails the module.
    """
    res = resolve_attempts(attempts, max_retries=max_retries)
    body = F.col("body") if "body" in res.columns else F.lit(None).cast("string")
    return res.where(F.col("outcome") != "pending").select(
        "report_key", "module", F.col("page_no").cast("int").alias("page_no"),
        F.col("status").cast("int").alias("status"), body.alias("body"),
    )
