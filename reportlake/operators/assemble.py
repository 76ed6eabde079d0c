"""Page assembly: stop rules, boundary duplicates, module outcome, typed tables.

Ops E1-E4, E6, E8, E9 (and the per-module status used by F1/F2).

Scale notes
-----------
* Every decision is taken on *page-level metadata* (one small row per page:
  status, row count, tokens, canonical first/last row).  The previous-page and
  next-page lookups are equi-joins on ``(report_key, module, page_no +- 1)``:
  keys are unique per page, so a module holding a third of all pages still
  spreads over all tasks -- no window over a whole module.
* Per-module facts (where the module stops, whether it failed) are aggregates
  with map-side partial aggregation.
* The decoded rows meet the decisions in one equi-join on the unique page key
  (uniform, no skew); AQE turns it into a broadcast when the decision table is
  small at run time.
* E8 typing aggregates (module, column) -> (first position, variant type) over
  all cells with partial aggregation; only that small result reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.functions.sqlx import let
from reportlake.operators.decode import PAGE_KEYS, explode_cells, explode_rows

MODULE_KEYS = ("report_key", "module")

AUTH_STATUS = (401, 403)


def page_meta(decoded: DataFrame, paginated: DataFrame | None = None) -> DataFrame:
    """Small page-level facts.  ``paginated``: (report_key, module, paginated) per module."""
    cols = [*PAGE_KEYS, "status", "n_rows", "has_tokens", "first_key", "last_key", "bad_json"]
    meta = decoded.select(*[c if c in decoded.columns else F.lit(200).alias(c) for c in cols])
    if paginated is not None:
        meta = meta.join(paginated.select(*MODULE_KEYS, "paginated"), list(MODULE_KEYS), "left")
        meta = meta.withColumn("paginated", F.coalesce("paginated", F.lit(True)))
    elif "paginated" in decoded.columns:
        meta = meta.withColumn("paginated", F.coalesce(decoded["paginated"], F.lit(True)))
    else:
        meta = meta.withColumn("paginated", F.lit(True))
    return meta


def stop_before() -> Column:
    """Why a module stops before a page (NULL: the page is used)."""
    return (
        F.when(F.col("status").isin(*AUTH_STATUS), F.lit("auth_failed"))
        .when(F.col("status") != 200, F.lit("http_error"))
        .when(F.col("bad_json"), F.lit("bad_json"))
        .when(F.col("n_rows") == 0, F.lit("no_rows"))
    )


def stop_after() -> Column:
    """Why a module ends with a page (NULL: more pages follow)."""
    return F.when(~F.col("paginated"), F.lit("single_shot")).when(~F.col("has_tokens"), F.lit("no_tokens"))


def page_plan(meta: DataFrame, dedupe_boundary: bool = True) -> tuple[DataFrame, DataFrame]:
    """Decide, for every landed page, whether it is used and whether its first row is dropped.

    Rules (E2-E4, E6): the module stops *before* a page whose status is not 200,
    that has no rows, or whose body is not JSON; it stops *after* a page without
    restart tokens, after page 1 of a single-shot module, and at the end of the
    landed sequence.  A page's first row is dropped when it equals the last row
    of the previous page (E2).  401/403 (after retries) or an unreadable body
    fails the whole module: nothing is kept.

    Returns ``(pages, modules)``: per page ``keep``, ``drop_first``; per module
    ``status``, ``stop_page``, ``stop_reason``.
    """
    k = list(PAGE_KEYS)
    nxt = meta.select(*MODULE_KEYS, (F.col("page_no") - 1).alias("page_no"), F.lit(True).alias("has_next"))
    prv = meta.select(*MODULE_KEYS, (F.col("page_no") + 1).alias("page_no"), F.col("last_key").alias("prev_last"))
    p = meta.join(nxt, k, "left").join(prv, k, "left")
    before = stop_before()
    after = F.coalesce(stop_after(), F.when(F.col("has_next").isNull(), F.lit("landing_end")))
    event = (
        F.when(before.isNotNull(), F.struct(F.col("page_no").alias("page_no"), F.lit(0).alias("prio"), before.alias("reason")))
        .when(after.isNotNull(), F.struct(F.col("page_no").alias("page_no"), F.lit(1).alias("prio"), after.alias("reason")))
    )
    mods = p.groupBy(*MODULE_KEYS).agg(
        F.min(event).alias("ev"),
        F.min("page_no").alias("first_page"),
    )
    mods = mods.select(
        *MODULE_KEYS,
        F.when(F.col("first_page") != 1, F.lit(0))
        .when(F.col("ev.prio") == 0, F.col("ev.page_no") - 1)
        .otherwise(F.col("ev.page_no")).alias("stop_page"),
        F.when(F.col("first_page") != 1, F.lit("missing_first_page")).otherwise(F.col("ev.reason")).alias("stop_reason"),
    ).withColumn("failed", F.col("stop_reason").isin("auth_failed", "bad_json"))
    pages = p.join(mods, list(MODULE_KEYS), "inner").select(
        *k,
        "n_rows",
        "status",
        ((F.col("page_no") <= F.col("stop_page")) & ~F.col("failed")).alias("keep"),
        (
            F.lit(dedupe_boundary)
            & (F.col("page_no") > 1)
            & F.col("prev_last").isNotNull()
            & (F.col("first_key") == F.col("prev_last"))
        ).alias("drop_first"),
    )
    return pages, mods


def module_status(pages: DataFrame, mods: DataFrame, modules: DataFrame | None = None) -> DataFrame:
    """One row per module: status ok / partial / empty / failed / incomplete.

    ``modules`` (report_key, module): modules expected to run; those with no landed
    page are listed as ``empty``.
    """
    kept = pages.where("keep").groupBy(*MODULE_KEYS).agg(
        F.sum(F.col("n_rows") - F.col("drop_first").cast("int")).alias("n_rows"),
        F.count(F.lit(1)).cast("int").alias("n_pages"),
    )
    st = mods.join(kept, list(MODULE_KEYS), "left").select(
        *MODULE_KEYS,
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce("n_pages", F.lit(0)).alias("n_pages"),
        "stop_reason",
        "failed",
    )
    return status_of(st, modules)


def status_of(st: DataFrame, modules: DataFrame | None = None) -> DataFrame:
    """E6/E9/F1 from (report_key, module, n_rows, n_pages, stop_reason, failed); ``modules`` as in ``module_status``."""
    if modules is not None:
        st = modules.select(*MODULE_KEYS).join(st, list(MODULE_KEYS), "left").fillna(
            {"n_rows": 0, "n_pages": 0, "stop_reason": "no_pages", "failed": False}
        )
    status = (
        F.when(F.col("failed"), F.lit("failed"))
        .when(F.col("stop_reason") == "missing_first_page", F.lit("incomplete"))
        .when(F.col("n_rows") == 0, F.lit("empty"))
        .when(F.col("stop_reason") == "http_error", F.lit("partial"))
        .when(F.col("stop_reason") == "landing_end", F.lit("incomplete"))
        .otherwise(F.lit("ok"))
    )
    rows = F.when(F.col("failed"), F.lit(0)).otherwise(F.col("n_rows")).cast("bigint")
    pages = F.when(F.col("failed"), F.lit(0)).otherwise(F.col("n_pages")).cast("int")
    return st.select(
        *MODULE_KEYS,
        status.alias("status"),
        rows.alias("n_rows"),
        pages.alias("n_pages"),
        F.col("stop_reason").alias("detail"),
    )


def assembled_rows(decoded: DataFrame, pages: DataFrame) -> DataFrame:
    """The rows kept, ordered by (page_no, pos) within a module.

    ``pos`` stays the position inside its page; a dropped boundary row leaves
    position 0 out.
    """
    plan = pages.where("keep").select(*PAGE_KEYS, "drop_first")
    joined = decoded.select(*PAGE_KEYS, "schemas", "rows").join(plan, list(PAGE_KEYS), "inner")
    rows = explode_rows(joined.select(*PAGE_KEYS, "schemas", "rows", "drop_first"), PAGE_KEYS + ("drop_first",))
    return rows.where(~(F.col("drop_first") & (F.col("pos") == 0))).drop("drop_first")


#: Integers stay exact, as BIGINT or, with some of 19 and more digits, as DECIMAL(38,0); of
#: more than 38 digits they are text.  Any number with a fraction makes the column DOUBLE.
_MERGE = (
    "CASE WHEN size(ts) = 0 THEN 'string' "
    "WHEN forall(ts, t -> t = 'BIGINT') THEN 'bigint' "
    "WHEN forall(ts, t -> t = 'BIGINT' OR t RLIKE '^DECIMAL.(19|[23][0-9]),0.$') THEN 'decimal(38,0)' "
    "WHEN forall(ts, t -> t IN ('BIGINT', 'DOUBLE', 'FLOAT') OR t LIKE 'DECIMAL%') THEN 'double' "
    "WHEN forall(ts, t -> t = 'BOOLEAN') THEN 'boolean' "
    "ELSE 'string' END"
)


def merged_type(types: str) -> Column:
    """The Spark type of a column from the VARIANT types of its values (an array column)."""
    return F.expr(let([("ts", f"`{types}`")], _MERGE))


def infer_schema(rows: DataFrame) -> DataFrame:
    """Per (report_key, module, col): first-seen order and a Spark type.

    Columns appear in order of first appearance; the type is the merge of the
    VARIANT types of all values (``merged_type``; at most some 40 of them a column).
    """
    cells = explode_cells(rows)
    agg = cells.groupBy(*MODULE_KEYS, "col").agg(
        F.min(F.struct("page_no", "pos", "field_idx")).alias("first_seen"),
        F.collect_set(F.when(F.col("value").isNotNull(), F.call_function("schema_of_variant", F.col("value")))).alias("variant_types"),
    )
    return agg.select(
        *MODULE_KEYS,
        "col",
        "first_seen",
        "variant_types",
        merged_type("variant_types").alias("spark_type"),
    )


def typed_value(col_name: str, spark_type: str) -> Column:
    """Typed cell of ``col_name``; strings of non-text values are their JSON text."""
    esc = col_name.replace("\\", "\\\\").replace("'", "\\'")
    cell = f"get(vals, array_position(cols, '{esc}') - 1)"
    if spark_type == "string":
        return F.expr(
            f"CASE WHEN schema_of_variant({cell}) = 'STRING' THEN variant_get({cell}, '$', 'string') "
            f"ELSE to_json({cell}) END"
        )
    return F.expr(f"try_variant_get({cell}, '$', '{spark_type}')")


def module_table(rows: DataFrame, schema: DataFrame, report_key: str, module: str) -> DataFrame:
    """Typed table of one module, columns in first-seen order, rows in (page_no, pos) order."""
    cols = (
        schema.where((F.col("report_key") == report_key) & (F.col("module") == module))
        .orderBy("first_seen")
        .select("col", "spark_type")
        .collect()
    )
    sub = rows.where((F.col("report_key") == report_key) & (F.col("module") == module))
    return sub.select(
        "page_no", "pos", *[typed_value(c.col, c.spark_type).alias(c.col) for c in cols]
    )


def typed_columns(rows: DataFrame, columns: dict[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection with a known column -> type list (no inference pass)."""
    return rows.select(*keys, *[typed_value(c, t).alias(c) for c, t in columns.items()])
