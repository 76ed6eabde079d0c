"""Module selection and run/report summaries: C17, F1-F5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Names an error message lists; the tables of the error hold all of them.
MESSAGE_NAMES = 100


class UnknownModules(ValueError):
    """Requested module names that no module has.

    ``unknown`` and ``available``: tables (name) of all distinct names.
    """

    def __init__(self, unknown: DataFrame, available: DataFrame):
        self.unknown, self.available = unknown, available
        super().__init__(f"Unknown module(s): {_some(unknown)}. Available: {_some(available)}")


def _some(names: DataFrame) -> str:
    n = names.count()
    if n > MESSAGE_NAMES:
        return f"{n} names (see the tables of this error)"
    return ", ".join(sorted(r.name for r in names.collect()))


def select_modules(modules: DataFrame, requested: DataFrame, raise_unknown: bool = True) -> tuple[DataFrame, DataFrame]:
    """C17: keep the requested modules, in request order and with repeats.

    ``requested``: (report_key, req_pos, name).  Returns ``(selected, unknown)``;
    with ``raise_unknown`` a non-empty ``unknown`` raises.  The error carries two
    tables of distinct names, ``unknown`` and ``available``, and says how many there
    are of each; its message lists them if they are few.  Both results are joins on
    (report_key, name).
    """
    on = ["report_key", "name"]
    selected = requested.join(modules, on, "inner")
    unknown = requested.join(modules.select(*on), on, "left_anti")
    if raise_unknown and not unknown.isEmpty():
        raise UnknownModules(unknown.select("name").distinct(), modules.select("name").distinct())
    return selected, unknown


def run_summary(module_status: DataFrame) -> DataFrame:
    """per report: modules run, failed, ok, and whether all failed.

    ``all_failed`` is true also for zero modules (``all([])``), as the exit rule.
    """
    return module_status.groupBy("report_key").agg(
        F.count(F.lit(1)).alias("n_modules"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.count_if(F.col("status") != "failed").alias("n_not_failed"),
    ).select("report_key", "n_modules", "n_failed", (F.col("n_not_failed") == 0).alias("all_failed"))


def failed_modules(module_status: DataFrame) -> DataFrame:
    """the failed modules (report_key, module, detail) -- a table, not a list."""
    return module_status.where(F.col("status") == "failed").select("report_key", "module", "detail")


def report_status(urls: DataFrame, discovery: DataFrame, module_status: DataFrame | None = None) -> DataFrame:
    """one row per report URL.

    A report is ``failed`` when its discovery failed (no captures, no usable
    modules, no application context); otherwise ``ok`` even if every module
    failed (as the replayed client does), with ``n_modules_ok`` telling the rest.
    ``urls``: (url, report_key).
    """
    st = urls.join(discovery.select("report_key", "n_modules", "status", "detail"), "report_key", "left")
    st = st.select(
        "url", "report_key",
        F.coalesce("status", F.lit("failed")).alias("status"),
        F.coalesce("n_modules", F.lit(0)).alias("n_modules"),
        F.when(F.col("status").isNull(), F.lit("no_captures")).otherwise(F.col("detail")).alias("detail"),
    )
    if module_status is not None:
        ok = module_status.groupBy("report_key").agg(F.count_if(F.col("status") != "failed").alias("n_modules_ok"))
        st = st.join(ok, "report_key", "left").withColumn("n_modules_ok", F.coalesce("n_modules_ok", F.lit(0)))
    return st


def bulk_summary(report_status_df: DataFrame) -> DataFrame:
    """number of reports per status."""
    return report_status_df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def exit_code(report_status_df: DataFrame) -> int:
    """non-zero only if no report is ok (also for zero reports)."""
    return 0 if not report_status_df.where(F.col("status") == "ok").isEmpty() else 1


def failure_messages(module_status: DataFrame, order_col: str | None = None) -> DataFrame:
    """(report_key, message) of every report with failed modules: ``"k/n module(s) failed: a, b"``.

    Names stand in the order of ``order_col`` (of themselves without one).
    """
    failed = F.col("status") == "failed"
    order = F.col(order_col) if order_col else F.col("module")
    names = F.sort_array(F.collect_list(F.when(failed, F.struct(order.alias("o"), "module"))))
    found = module_status.groupBy("report_key").agg(F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("k"), names.alias("names"))
    listed = F.array_join(F.transform("names", lambda x: x["module"]), ", ")
    return found.where("k > 0").select("report_key", F.format_string("%d/%d module(s) failed: %s", "k", "n", listed).alias("message"))


def failure_message(module_status: DataFrame, report_key: str, order_col: str | None = None) -> str | None:
    """the message of one report, or None when nothing failed."""
    row = failure_messages(module_status.where(F.col("report_key") == report_key), order_col).first()
    return row.message if row else None
