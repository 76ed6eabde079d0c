"""Driver checks: one Spark query per operator group, each with its DuckDB SQL.

Every query reads whole driver tables, builds the stand-in landed input from
them (captures, response pages, attempt logs, URL texts -- only rows in the
schema the job expects, via ``plans.encode`` or plain projections), and then
runs the library's operators on that input; the result comes out of those
operators, never from the way the input was made.  ``SQL[name]`` computes the
same result directly from the tables.  Page keys are chosen so every landed
page stays bounded (e.g. ``id div 1000``), as the service's page size does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions.ranking import group_row_number
from reportlake.operators.assemble import typed_columns
from reportlake.functions.protocol import PAGE_SIZE, VIEW_URL_PREFIX
from reportlake.operators.attempts import resolve_attempts, with_retry_delay
from reportlake.operators.discover import discover, report_config
from reportlake.operators.frontier import issue, next_requests, read_ledger
from reportlake.operators.payloads import build_payloads, is_paginated, window_config
from reportlake.operators.runs import bulk_summary, failure_messages, report_status, run_summary, select_modules
from reportlake.session import scratch_dir, spread, stage
from reportlake.sinks.tables import load_catalog, report_dirs, save_catalog, write_module_csv, write_rows_by_report
from reportlake.sources.captures import filter_captures, har_entries, header_value
from reportlake.sources.urls import extract_view_urls, numbered_urls, read_texts, resource_key
from reportlake.streaming.assembly import Assembly
from reportlake.streaming.incremental import start_incremental_decode
from reportlake.operators.decode import PAGE_KEYS, decode_pages, explode_rows, quarantine, stage_pages
from reportlake.functions.sqlx import json_value
from reportlake.plans.extract import extract, staged_rows, typed_from_json
from reportlake.plans.jobs import discover_har, run_bulk
from reportlake.plans.encode import Field, build_pages, descriptor_json, encode_entries, encode_table

CHECKS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None):
    def deco(fn):
        CHECKS[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def responses_of(pages: DataFrame, report_key, module, page_no, status=None) -> DataFrame:
    """Shape encoder output as the landed ``responses`` table."""
    def c(x):
        return x if isinstance(x, F.Column) else F.lit(x)

    return pages.select(
        c(report_key).cast("string").alias("report_key"),
        c(module).cast("string").alias("module"),
        c(page_no).cast("int").alias("page_no"),
        (c(status) if status is not None else F.lit(200)).cast("int").alias("status"),
        "body",
    )


# ---------------------------------------------------------------------------
# 2.D decode
# ---------------------------------------------------------------------------

def decode_landed(responses: DataFrame) -> DataFrame:
    """Decode pages that were just encoded: few bytes, but long work, so they are dealt over many tasks first."""
    return decode_pages(spread(responses, *PAGE_KEYS))


LINEITEM_FIELDS = [
    Field("M0", "lineitem.l_orderkey", "l_orderkey"),
    Field("M1", "lineitem.l_linenumber", "l_linenumber"),
    Field("M2", "lineitem.l_partkey", "l_partkey"),
    Field("M3", "lineitem.l_suppkey", "l_suppkey"),
    Field("M4", "lineitem.l_quantity", "l_quantity"),
    Field("M5", "lineitem.l_extendedprice", "l_extendedprice"),
    Field("M6", "lineitem.l_returnflag", "l_returnflag", dn="VFlag"),
    Field("M7", "lineitem.l_linestatus", "l_linestatus", dn="VStatus"),
]
LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint",
    "l_quantity": "double", "l_extendedprice": "double", "l_returnflag": "string", "l_linestatus": "string",
}


def lineitem_responses(spark: SparkSession, sf_dir: str, rows_per_page_key: int = 1000) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("page", F.expr(f"l_orderkey div {rows_per_page_key}"))
    pages = encode_table(
        li, ["page"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], LINEITEM_FIELDS
    )
    return responses_of(pages, "lineitem", "lineitem", F.col("page") + 1)


def decode_lineitem(responses: DataFrame) -> DataFrame:
    rows = explode_rows(decode_pages(responses))
    typed = typed_columns(rows, {c: ("bigint" if t == "int" else t) for c, t in LINEITEM_TYPES.items()})
    return typed.select(*[F.col(c).cast(t).alias(c) for c, t in LINEITEM_TYPES.items()])


@check("Q_decode_table", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_returnflag, l_linestatus FROM lineitem
""")
def q_decode_table(spark, sf_dir):
    """Flagship: lineitem encoded as pages (orderkey div 1000), decoded."""
    return decode_lineitem(lineitem_responses(spark, sf_dir))


def jv(col_sql: str) -> str:
    """JSON text of a column value (SQL)."""
    return json_value(col_sql)


def custom_pages(df: DataFrame, page_keys: list[str], order_by: list[str], entry_sql: str,
                 descriptor, rt=None, dicts_sql: str | None = None) -> DataFrame:
    """Pages whose entries are written by a SQL expression (for format features
    the generic encoder does not produce: mid-page schemas, matrix entries,
    bad entries, direct values)."""
    entries = df.select(
        *page_keys, *[c for c in order_by if c not in page_keys],
        F.expr(entry_sql).alias("entry"),
        (F.expr(dicts_sql) if dicts_sql else F.lit("{}")).alias("dicts"),
    )
    return build_pages(entries, page_keys, order_by, descriptor, rt=rt)


def desc(*items: tuple[str, str]) -> str:
    import json

    return json.dumps({"Select": [{"Value": c, "Name": n} for c, n in items]})


@check("Q_repeat_carry", f"""
WITH p AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // {PAGE_SIZE} AS page FROM events)
SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS)
  OVER (PARTITION BY user_id, page ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_type
FROM p
""")
def q_repeat_carry(spark, sf_dir):
    """R bit on event_type unless event_id % 3 = 0; module = user, whose events follow each other
    in pages as full as the service's page size allows, so the carry goes over all rows of such a page."""
    from pyspark.sql import Window

    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    ev = ev.withColumn("p", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")))
    ev = ev.withColumn("p", F.expr(f"(p - 1) div {PAGE_SIZE}"))
    fields = [
        Field("M0", "e.event_id", "event_id", repeat=None),
        Field("M1", "e.user_id", "user_id", repeat=None),
        Field("M2", "e.event_type", "event_type", dn="VType", repeat="event_id % 3 <> 0"),
    ]
    pages = encode_table(ev, ["user_id", "p"], ["event_id"], fields)
    resp = responses_of(pages, "events", F.col("user_id"), F.col("p") + 1)
    rows = explode_rows(decode_landed(resp))
    return typed_columns(rows, {"event_id": "bigint", "user_id": "bigint", "event_type": "string"})


@check("Q_null_mask", """
SELECT event_id, event_type, CASE WHEN value < 10 THEN NULL ELSE value END AS value FROM events
""")
def q_null_mask(spark, sf_dir):
    """Ø bit where value < 10."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 1000"))
    fields = [
        Field("M0", "e.event_id", "event_id", repeat=None),
        Field("M1", "e.event_type", "event_type", dn="VType"),
        Field("M2", "e.value", "CASE WHEN value < 10 THEN NULL ELSE value END"),
    ]
    resp = responses_of(encode_table(ev, ["p"], ["event_id"], fields), "events", "events", F.col("p") + 1)
    rows = explode_rows(decode_pages(resp))
    return typed_columns(rows, {"event_id": "bigint", "event_type": "string", "value": "double"})


@check("Q_dict_decode", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 11 = 0 THEN '999' ELSE o_orderpriority END AS o_orderpriority FROM orders
""")
def q_dict_decode(spark, sf_dir):
    """Priority through its DN dictionary, status through a dictionary named
    by its field code; index 999 (out of range) stays an integer."""
    od = table(spark, sf_dir, "orders").withColumn("p", F.expr("o_orderkey div 1000"))
    fields = [
        Field("M0", "orders.o_orderkey", "o_orderkey", repeat=None),
        Field("M1", "orders.o_orderstatus", "o_orderstatus", code_dict=True),
        Field("M2", "orders.o_orderpriority", "o_orderpriority", dn="VPrio", repeat=None,
              override="CASE WHEN o_orderkey % 11 = 0 THEN 999 END"),
    ]
    resp = responses_of(encode_table(od, ["p"], ["o_orderkey"], fields), "orders", "orders", F.col("p") + 1)
    rows = explode_rows(decode_pages(resp))
    return typed_columns(rows, {"o_orderkey": "bigint", "o_orderstatus": "string", "o_orderpriority": "string"})


@check("Q_schema_change", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderkey // 4096 ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderkey, CASE WHEN rn > 1 AND rn % 4 IN (1, 3) THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN rn % 4 IN (3, 0) THEN o_totalprice END AS o_totalprice FROM r
""")
def q_schema_change(spark, sf_dir):
    """A page per (customer, orderkey div 4096); row rn % 4 = 3 switches to three
    fields, rn % 4 = 1 back to two; the status right after a switch is R-coded
    (the length changed, so the carry is reset and it decodes as NULL)."""
    from pyspark.sql import Window

    od = table(spark, sf_dir, "orders").withColumn("b", F.expr("o_orderkey div 4096"))
    od = od.withColumn("rn", F.row_number().over(Window.partitionBy("o_custkey", "b").orderBy("o_orderkey")))
    s2 = '[{"N":"M0"},{"N":"M1"}]'
    s3 = '[{"N":"M0"},{"N":"M1"},{"N":"M2"}]'
    k, st, tp = jv("o_orderkey"), jv("o_orderstatus"), jv("o_totalprice")
    entry = f"""CASE
      WHEN rn = 1 THEN concat('{{"S":{s2},"C":[', {k}, ',', {st}, ']}}')
      WHEN rn % 4 = 3 THEN concat('{{"S":{s3},"R":2,"C":[', {k}, ',', {tp}, ']}}')
      WHEN rn % 4 = 0 THEN concat('{{"C":[', {k}, ',', {st}, ',', {tp}, ']}}')
      WHEN rn % 4 = 1 THEN concat('{{"S":{s2},"R":2,"C":[', {k}, ']}}')
      ELSE concat('{{"C":[', {k}, ',', {st}, ']}}') END"""
    d = desc(("M0", "orders.o_orderkey"), ("M1", "orders.o_orderstatus"), ("M2", "orders.o_totalprice"))
    pages = custom_pages(od, ["o_custkey", "b"], ["o_orderkey"], entry, d)
    resp = responses_of(pages, "orders", F.concat_ws("_", "o_custkey", "b"), 1)
    rows = explode_rows(decode_landed(resp))
    return typed_columns(rows, {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"})


@check("Q_matrix_skip", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0
""")
def q_matrix_skip(spark, sf_dir):
    """Entries of orders with o_orderkey % 7 = 0 are matrix entries (X, no C) and are skipped."""
    od = table(spark, sf_dir, "orders").withColumn("p", F.expr("o_orderkey div 1000"))
    k, tp = jv("o_orderkey"), jv("o_totalprice")
    entry = f"""CASE WHEN o_orderkey % 7 = 0
      THEN concat('{{"S":[{{"N":"M0"}}],"X":[{{"M0":', {k}, '}}]}}')
      ELSE concat('{{"C":[', {k}, ',', {tp}, ']}}') END"""
    d = desc(("M0", "orders.o_orderkey"), ("M1", "orders.o_totalprice"))
    resp = responses_of(custom_pages(od, ["p"], ["o_orderkey"], entry, d), "orders", "orders", F.col("p") + 1)
    rows = explode_rows(decode_pages(resp))
    return typed_columns(rows, {"o_orderkey": "bigint", "o_totalprice": "double"})


@check("Q_direct_value", """
SELECT c_name FROM customer
""")
def q_direct_value(spark, sf_dir):
    """Single-field entries without C; the value sits under the field code."""
    cu = table(spark, sf_dir, "customer").withColumn("p", F.expr("c_custkey div 1000"))
    entry = f"""concat('{{"M0":', {jv("c_name")}, '}}')"""
    resp = responses_of(custom_pages(cu, ["p"], ["c_custkey"], entry, desc(("M0", "customer.c_name"))),
                        "customer", "customer", F.col("p") + 1)
    return typed_columns(explode_rows(decode_pages(resp)), {"c_name": "string"})


@check("Q_short_c", """
SELECT p_partkey, p_name, CASE WHEN p_size < 10 THEN NULL ELSE p_retailprice END AS p_retailprice FROM part
""")
def q_short_c(spark, sf_dir):
    """The last field is missing from C for p_size < 10 -> NULL."""
    pa = table(spark, sf_dir, "part").withColumn("p", F.expr("p_partkey div 1000"))
    k, n, r = jv("p_partkey"), jv("p_name"), jv("p_retailprice")
    entry = f"""concat('{{"C":[', {k}, ',', {n}, CASE WHEN p_size < 10 THEN '' ELSE concat(',', {r}) END, ']}}')"""
    d = desc(("M0", "part.p_partkey"), ("M1", "part.p_name"), ("M2", "part.p_retailprice"))
    resp = responses_of(custom_pages(pa, ["p"], ["p_partkey"], entry, d), "part", "part", F.col("p") + 1)
    rows = explode_rows(decode_pages(resp))
    return typed_columns(rows, {"p_partkey": "bigint", "p_name": "string", "p_retailprice": "double"})


@check("Q_truncate", """
SELECT event_id, value FROM (SELECT *, min(CASE WHEN value > 200 THEN event_id END) OVER (PARTITION BY event_id // 100) AS bad FROM events)
WHERE bad IS NULL OR event_id < bad
""")
def q_truncate(spark, sf_dir):
    """Pages of 100 events; an entry with value > 200 is malformed (C is null),
    which cuts the rest of its page."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 100"))
    entry = f"""CASE WHEN value > 200 THEN '{{"C":null}}'
      ELSE concat('{{"C":[', {jv("event_id")}, ',', {jv("value")}, ']}}') END"""
    d = desc(("M0", "e.event_id"), ("M1", "e.value"))
    resp = responses_of(custom_pages(ev, ["p"], ["event_id"], entry, d), "events", "events", F.col("p") + 1)
    rows = explode_rows(decode_pages(resp))
    return typed_columns(rows, {"event_id": "bigint", "value": "double"})


@check("Q_restart_tokens", """
SELECT p AS page_no, CASE WHEN p < max(p) OVER () THEN last_id END AS restart_token
FROM (SELECT event_id // 100 AS p, max(event_id) AS last_id FROM events GROUP BY 1)
""")
def q_restart_tokens(spark, sf_dir):
    """Each page's RT holds its last event id, except on the last page."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 100"))
    last_page = ev.agg(F.max("p")).first()[0]
    rt = F.when(F.first("p") < F.lit(last_page), F.concat(F.lit("[["), F.max("event_id").cast("string"), F.lit("]]")))
    entries = ev.select("p", "event_id", F.expr(f"""concat('{{"C":[', {jv("event_id")}, ']}}')""").alias("entry"))
    pages = build_pages(entries, ["p"], ["event_id"], desc(("M0", "e.event_id")), rt=rt, dicts_col=None)
    dec = decode_pages(responses_of(pages, "events", "events", F.col("p") + 1))
    return dec.select(
        (F.col("page_no") - 1).cast("bigint").alias("page_no"),
        F.get_json_object("restart_tokens", "$[0][0]").cast("bigint").alias("restart_token"),
    )


@check("Q_column_names", """
SELECT p_partkey, regexp_replace(p_brand || '.' || p_type || '.x', '^[^.]*\\.', '') AS col FROM part
""")
def q_column_names(spark, sf_dir):
    """One page per part whose second descriptor name is brand.type.x;
    the column name is the text after the first dot."""
    pa = table(spark, sf_dir, "part")
    d = F.concat(
        F.lit('{"Select":[{"Value":"M0","Name":"part.key"},{"Value":"M1","Name":'),
        F.expr(jv("concat(p_brand, '.', p_type, '.x')")),
        F.lit("}]}"),
    )
    entries = pa.select("p_partkey", F.expr(f"""concat('{{"C":[', {jv("p_partkey")}, ',0]}}')""").alias("entry"), d.alias("d"))
    pages = build_pages(entries, ["p_partkey"], ["p_partkey"], F.col("d"), dicts_col=None)
    rows = explode_rows(decode_pages(responses_of(pages, "part", "part", F.col("p_partkey"))))
    return rows.select(
        F.expr("try_variant_get(vals[0], '$', 'bigint')").alias("p_partkey"),
        F.expr("cols[1]").alias("col"),
    )


# ---------------------------------------------------------------------------
# 2.E page assembly, attempts, schema
# ---------------------------------------------------------------------------

def boundary_responses(spark, sf_dir):
    """One module, pages of 100 events, each starting with the last row of the page before."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.expr("event_id div 100").alias("p"))
    last_page = ev.agg(F.max("p")).first()[0]
    edge = (
        ev.where(F.col("p") < last_page).groupBy("p")
        .agg(F.max_by(F.struct("event_id", "user_id", "event_type"), "event_id").alias("r"))
        .select((F.col("p") + 1).alias("p"), F.col("r.event_id").alias("event_id"), "r.user_id", "r.event_type",
                F.lit(0).alias("o"))
    )
    rows = ev.withColumn("o", F.lit(1)).unionByName(edge)
    fields = [
        Field("M0", "e.event_id", "event_id", repeat=None),
        Field("M1", "e.user_id", "user_id"),
        Field("M2", "e.event_type", "event_type", dn="VType"),
    ]
    rt = F.when(F.first("p") < F.lit(last_page), F.concat(F.lit("[["), F.max("event_id").cast("string"), F.lit("]]")))
    pages = encode_table(rows, ["p"], ["o", "event_id"], fields, rt=rt)
    return responses_of(pages, "events", "events", F.col("p") + 1)


@check("Q_boundary", """
SELECT event_id, user_id, event_type FROM events
""")
def q_boundary(spark, sf_dir):
    """One module, pages of 100 events; each page starts with the last row of
    the previous page (as the service repeats it); tokens on all but the last page."""
    return extract(boundary_responses(spark, sf_dir)).table("events", "events")


@check("Q_paging_state", SQL["Q_boundary"])
def q_paging_state(spark, sf_dir):
    """S1 with state: the pages of Q_boundary land in three batches, in no order; each is
    assembled once, and the boundary rows are told across batches."""
    pages = stage(boundary_responses(spark, sf_dir), "landed")
    assembly = Assembly(spark, scratch_dir(spark, "assembly"))
    for batch in range(3):
        landed = pages.where(F.pmod(F.xxhash64("page_no"), F.lit(3)) == batch)
        assembly.advance(stage_pages(decode_pages(landed, with_types=True)), batch)
    return assembly.result().table("events", "events")


@check("Q_page_stop", """
WITH p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page_no FROM events),
s AS (SELECT *, max(CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stopped FROM p)
SELECT user_id, page_no, event_id FROM s
WHERE coalesce(stopped, 0) = 0 AND event_type <> 'error' AND (user_id % 10 <> 0 OR page_no = 1)
""")
def q_page_stop(spark, sf_dir):
    """module = user, one page per event (page_no = rank by event_id); status 500
    for 'error' (stop before), no tokens for 'purchase' (stop after), single-shot
    modules (user_id % 10 = 0) keep page 1 only."""
    ev = group_row_number(table(spark, sf_dir, "events"), ["user_id"], "event_id", "page_no")
    fields = [Field("M0", "e.user_id", "user_id", repeat=None), Field("M1", "e.event_id", "event_id", repeat=None)]
    rt = F.when(F.first("event_type") != "purchase", F.lit("[[1]]"))
    entries = encode_entries(ev, ["user_id", "page_no"], ["event_id"], fields)
    ev_type = ev.select("user_id", "page_no", "event_type")
    entries = entries.join(ev_type, ["user_id", "page_no"])
    pages = build_pages(entries, ["user_id", "page_no"], ["_rn"], descriptor_json(fields), rt=rt,
                        extra={"event_type": F.first("event_type")})
    resp = responses_of(pages, "events", F.col("user_id"), F.col("page_no"),
                        status=F.when(F.col("event_type") == "error", 500).otherwise(200))
    paginated = table(spark, sf_dir, "events").select("user_id").distinct().select(
        F.lit("events").alias("report_key"), F.col("user_id").cast("string").alias("module"),
        (F.col("user_id") % 10 != 0).alias("paginated"))
    ex = extract(resp, paginated)
    return ex.rows.select(
        F.col("module").cast("bigint").alias("user_id"),
        F.col("page_no").cast("bigint").alias("page_no"),
        F.get_json_object("row_json", "$.event_id").cast("bigint").alias("event_id"),
    )


@check("Q_attempts", """
WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k FROM events),
b AS (SELECT user_id, k // 5 AS req, k % 5 AS attempt, CASE event_type WHEN 'view' THEN 200 WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'purchase' THEN 401 ELSE 404 END AS status FROM a),
f AS (SELECT user_id, req, min(attempt) AS attempt FROM b WHERE status IN (200, 404) OR attempt = 4 GROUP BY 1, 2)
SELECT b.user_id, b.req, b.attempt, b.status, CASE WHEN status = 200 THEN 'ok' WHEN status = 401 THEN 'auth_failed' ELSE 'gave_up' END AS outcome
FROM b JOIN f USING (user_id, req, attempt)
""")
def q_attempts(spark, sf_dir):
    """request = (user, block of 5 events), attempt = position in the block;
    view 200, error 503, signup 429, purchase 401, click 404; max_retries = 4."""
    ev = group_row_number(table(spark, sf_dir, "events"), ["user_id"], "event_id", "rn")
    log = ev.select(
        F.lit("events").alias("report_key"),
        F.col("user_id").cast("string").alias("module"),
        F.expr("(rn - 1) div 5").alias("page_no"),
        F.expr("(rn - 1) % 5").cast("int").alias("attempt"),
        F.expr("CASE event_type WHEN 'view' THEN 200 WHEN 'error' THEN 503 WHEN 'signup' THEN 429 "
               "WHEN 'purchase' THEN 401 ELSE 404 END").alias("status"),
        F.lit(None).cast("string").alias("retry_after"),
        F.lit(None).cast("string").alias("body"),
    )
    res = resolve_attempts(log, max_retries=4).where(F.col("outcome") != "pending")
    return res.select(
        F.col("module").cast("bigint").alias("user_id"),
        F.col("page_no").cast("bigint").alias("req"),
        F.col("attempt").cast("bigint").alias("attempt"),
        F.col("status").cast("int").alias("status"),
        "outcome",
    )


@check("Q_retry_delay", """
SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_id % 2 = 0 THEN CAST(value AS VARCHAR) WHEN event_id % 4 = 1 THEN 'soon' END AS DOUBLE), power(2, event_id % 5)) AS delay_s FROM events
""")
def q_retry_delay(spark, sf_dir):
    """Retry-After text is the value for even ids, 'soon' for ids % 4 = 1, absent
    otherwise; attempt = id % 5; base delay 1.0."""
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("CASE WHEN event_id % 2 = 0 THEN CAST(value AS STRING) WHEN event_id % 4 = 1 THEN 'soon' END").alias("retry_after"),
        F.expr("event_id % 5").alias("attempt"),
    )
    return with_retry_delay(ev, out_col="delay_s").select("event_id", "delay_s")


@check("Q_schema_union", """
SELECT event_id, CASE WHEN event_type = 'view' THEN value END AS view_value,
       CASE WHEN event_type = 'click' THEN user_id END AS click_user FROM events
""")
def q_schema_union(spark, sf_dir):
    """Rows carry only the keys of their event type (their own S); the module's
    table is the union of keys in first-seen order with types inferred from all values."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 1000"))
    last_page = ev.agg(F.max("p")).first()[0]
    k = jv("event_id")
    entry = f"""CASE event_type
      WHEN 'view' THEN concat('{{"S":[{{"N":"M0"}},{{"N":"M1"}}],"C":[', {k}, ',', {jv("value")}, ']}}')
      WHEN 'click' THEN concat('{{"S":[{{"N":"M0"}},{{"N":"M2"}}],"C":[', {k}, ',', {jv("user_id")}, ']}}')
      ELSE concat('{{"S":[{{"N":"M0"}}],"C":[', {k}, ']}}') END"""
    d = desc(("M0", "e.event_id"), ("M1", "e.view_value"), ("M2", "e.click_user"))
    rt = F.when(F.first("p") < F.lit(last_page), F.lit("[[1]]"))
    pages = custom_pages(ev, ["p"], ["event_id"], entry, d, rt=rt)
    ex = extract(responses_of(pages, "events", "events", F.col("p") + 1))
    return ex.table("events", "events")


@check("Q_run_summary", """
SELECT c_nationkey AS module, count(*) FILTER (WHERE c_acctbal > 0) AS n_rows,
       CASE WHEN count(*) FILTER (WHERE c_acctbal > 0) = 0 THEN 'empty' ELSE 'ok' END AS status
FROM customer GROUP BY 1
""")
def q_run_summary(spark, sf_dir):
    """module = nation; its pages hold the customers with a positive balance
    (pages of custkey div 100, tokens on all but the last); a nation without such
    customers lands one empty page.  Status per module."""
    cu = table(spark, sf_dir, "customer")
    pos = cu.where("c_acctbal > 0").withColumn("b", F.expr("c_custkey div 100"))
    buckets = group_row_number(pos.select("c_nationkey", "b").distinct(), ["c_nationkey"], "b", "page_no")
    n_pages = buckets.groupBy("c_nationkey").agg(F.max("page_no").alias("n_pages"))
    rows = pos.join(buckets, ["c_nationkey", "b"]).join(n_pages, "c_nationkey")
    fields = [Field("M0", "c.c_custkey", "c_custkey", repeat=None), Field("M1", "c.c_acctbal", "c_acctbal", repeat=None)]
    rt = F.when(F.first("page_no") < F.first("n_pages"), F.lit("[[1]]"))
    entries = encode_entries(rows, ["c_nationkey", "page_no"], ["c_custkey"], fields).join(
        n_pages, "c_nationkey")
    pages = build_pages(entries, ["c_nationkey", "page_no"], ["_rn"], descriptor_json(fields), rt=rt)
    nations = cu.select("c_nationkey").distinct()
    empty = nations.join(pages.select("c_nationkey").distinct(), "c_nationkey", "left_anti").select(
        "c_nationkey", F.lit(1).alias("page_no"),
        F.lit('{"results":[{"result":{"data":{"descriptor":{"Select":[]},"dsr":{"DS":[{"PH":[{"DM0":[]}]}]}}}}]}').alias("body"))
    resp = responses_of(pages.unionByName(empty), "customers", F.col("c_nationkey"), F.col("page_no"))
    ex = extract(resp)
    modules = nations.select(F.lit("customers").alias("report_key"), F.col("c_nationkey").cast("string").alias("module"))
    st = ex.status(modules)
    return st.select(F.col("module").cast("int").alias("module"), "n_rows", "status")


# ---------------------------------------------------------------------------
# 2.C discovery, captures, URLs, payloads
# ---------------------------------------------------------------------------

QUERY_URL = "'https://api.example.com/public/reports/querydata?synchronous=true'"


def _column_item(source: str, prop_sql: str) -> str:
    return f"""concat('{{"Column":{{"Expression":{{"SourceRef":{{"Source":"{source}"}}}},"Property":', {prop_sql}, '}}}}')"""


def _capture_body(command_sql: str, ctx_sql: str | None = None, extra_sql: str = "''") -> str:
    ctx = ctx_sql or """'{"DatasetId":"ds","Sources":[{"ReportId":"rep","VisualId":"vis"}]}'"""
    return (
        """concat('{"version":"1.0.0","queries":[{"Query":{"Commands":[{"SemanticQueryDataShapeCommand":', """
        f"{command_sql}, "
        """'}]},"ApplicationContext":', """
        f"{ctx}, "
        """'}],"cancelQueries":[]', """
        f"{extra_sql}, '}}')"
    )


@check("Q_capture_filter", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
WHERE event_type NOT IN ('view', 'signup') AND event_id % 13 <> 0 AND event_id % 17 <> 0
""")
def q_capture_filter(spark, sf_dir):
    """Events as HAR documents (one per 100 events): GET for 'view', another
    path for 'signup', body = props, broken when event_id % 13 = 0, empty when % 17 = 0."""
    ev = table(spark, sf_dir, "events")
    req = F.struct(
        F.when(F.col("event_type") == "view", "GET").otherwise("POST").alias("method"),
        F.when(F.col("event_type") == "signup", F.lit("https://api.example.com/other/path"))
        .otherwise(F.expr(QUERY_URL)).alias("url"),
        F.array(
            F.struct(F.lit("X-Event-Id").alias("name"), F.col("event_id").cast("string").alias("value")),
            F.struct(F.lit("Content-Type").alias("name"), F.lit("application/json").alias("value")),
        ).alias("headers"),
        F.struct(
            F.expr("CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 13 = 0 THEN concat(props, '}}') ELSE props END").alias("text")
        ).alias("postData"),
    )
    docs = ev.groupBy(F.expr("event_id div 100").alias("doc")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", req.alias("request")))).alias("es")
    )
    texts = docs.select(
        F.col("doc").cast("string").alias("source"),
        F.to_json(F.struct(F.struct(F.expr("transform(es, x -> struct(x.request AS request))").alias("entries")).alias("log"))).alias("text"),
    )
    caps, _ = filter_captures(har_entries(texts))
    return caps.select(
        header_value("headers", "x-event-id").cast("bigint").alias("event_id"),
        F.get_json_object("body", "$.k").cast("bigint").alias("k"),
    )


@check("Q_header_ci", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS resource_key FROM events
""")
def q_header_ci(spark, sf_dir):
    """The key header is upper- or lower-case by event_id % 2, absent when
    % 5 = 0; for % 3 = 0 an earlier exact duplicate holds a stale value."""
    ev = table(spark, sf_dir, "events")
    name = F.when(F.col("event_id") % 2 == 0, F.lit("X-RESOURCEKEY")).otherwise(F.lit("x-resourcekey"))
    hdr = lambda n, v: F.struct(n.alias("name"), v.alias("value"))
    headers = F.when(
        F.col("event_id") % 5 == 0, F.array(hdr(F.lit("Accept"), F.lit("*/*")))
    ).when(
        F.col("event_id") % 3 == 0,
        F.array(hdr(F.lit("Accept"), F.lit("*/*")), hdr(name, F.lit("stale")), hdr(F.lit("Origin"), F.lit("o")), hdr(name, F.col("event_type"))),
    ).otherwise(F.array(hdr(F.lit("Accept"), F.lit("*/*")), hdr(name, F.col("event_type"))))
    caps = ev.select("event_id", headers.alias("headers"))
    return caps.select("event_id", F.coalesce(header_value("headers", "X-ResourceKey"), F.lit("")).alias("resource_key"))


@check("Q_view_urls", """
SELECT DISTINCT 'https://app.example.com/view?r=' || c_mktsegment || (c_custkey % 50) AS url FROM customer
""")
def q_view_urls(spark, sf_dir):
    """C4: one text per customer naming its view URL twice among noise."""
    cu = table(spark, sf_dir, "customer")
    url = F.concat(F.lit(VIEW_URL_PREFIX), F.col("c_mktsegment"), (F.col("c_custkey") % 50).cast("string"))
    texts = cu.select(
        F.col("c_custkey").alias("source"),
        F.concat(F.lit("see "), url, F.lit(' and <a href="'), url, F.lit('">noise</a> https://elsewhere.example.org/x')).alias("text"),
    )
    return extract_view_urls(texts).select("url")


@check("Q_resource_key", """
SELECT c_custkey, c_name AS resource_key FROM customer
""")
def q_resource_key(spark, sf_dir):
    """r = unpadded base64 of {"k": c_name}."""
    cu = table(spark, sf_dir, "customer")
    r = F.regexp_replace(F.base64(F.to_json(F.struct(F.col("c_name").alias("k"))).cast("binary")), "=+$", "")
    urls = cu.select("c_custkey", F.concat(F.lit(VIEW_URL_PREFIX), r, F.lit("&pageName=x")).alias("url"))
    key, _ = resource_key(F.col("url"))
    return urls.select("c_custkey", key.alias("resource_key"))


def _event_captures(ev: DataFrame) -> DataFrame:
    cmd = """'{"Query":{"Version":2,"From":[{"Name":"e","Entity":"Events","Type":0}],"Select":[{"Column":{"Expression":{"SourceRef":{"Source":"e"}},"Property":"value"}}]},"Binding":{"Primary":{"Groupings":[{"Projections":[0]}]},"DataReduction":{"DataVolume":3,"Primary":{"Window":{}}}}}'"""
    ctx = """concat('{"DatasetId":"ds-', cast(user_id AS string), '","Sources":[{"ReportId":"rep-', cast(user_id AS string), '","VisualId":"vis-', cast(event_id AS string), '"}]}')"""
    model = """CASE WHEN user_id % 2 = 1 THEN concat(',"modelId":', cast(cast(floor(value) AS bigint) AS string)) ELSE '' END"""
    return ev.select(
        F.col("user_id").cast("string").alias("report_key"),
        F.col("event_id").alias("pos"),
        F.expr(QUERY_URL).alias("url"),
        F.array(F.struct(F.lit("X-ResourceKey").alias("name"), F.col("event_type").alias("value"))).alias("headers"),
        F.expr(_capture_body(cmd, ctx, model)).alias("body"),
    )


@check("Q_report_config", """
SELECT user_id, min(event_id) AS first_capture,
       CASE WHEN user_id % 2 = 1 THEN CAST(floor(arg_min(value, event_id)) AS BIGINT) ELSE 598501 END AS model_id
FROM events GROUP BY 1
""")
def q_report_config(spark, sf_dir):
    """report = user, captures ordered by event_id; modelId present for odd users."""
    cfg = report_config(_event_captures(table(spark, sf_dir, "events")))
    return cfg.select(F.col("report_key").cast("bigint").alias("user_id"), F.col("first_capture").alias("first_capture"), "model_id")


def _part_captures(pa: DataFrame, report_key, select_sql: str, from_sql: str, where_sql: str = "''") -> DataFrame:
    cmd = f"""concat('{{"Query":{{"Version":2,"From":', {from_sql}, ',"Select":', {select_sql}, {where_sql}, '}},"Binding":{{"DataReduction":{{"DataVolume":3,"Primary":{{"Window":{{"Count":500}}}}}}}}}}')"""
    return pa.select(
        report_key.cast("string").alias("report_key"),
        F.col("p_partkey").alias("pos"),
        F.expr(QUERY_URL).alias("url"),
        F.array().cast("array<struct<name:string,value:string>>").alias("headers"),
        F.expr(_capture_body(cmd)).alias("body"),
        "p_partkey",
    )


@check("Q_select_columns", """
SELECT p_partkey, p_brand AS prop, p_size % 5 IN (1, 2) AS is_measure FROM part WHERE p_size % 5 < 3
""")
def q_select_columns(spark, sf_dir):
    """One report per part; p_size % 5 picks the Select item kind: 0 Column,
    1 Measure, 2 Aggregation over a Column, 3 an unknown kind, 4 a subquery source."""
    pa = table(spark, sf_dir, "part")
    b = jv("p_brand")
    ref = """'{"Expression":{"SourceRef":{"Source":"p"}},"Property":'"""
    select_sql = f"""CASE p_size % 5
      WHEN 0 THEN concat('[{{"Column":', {ref}, {b}, '}}}}]')
      WHEN 1 THEN concat('[{{"Measure":', {ref}, {b}, '}}}}]')
      WHEN 2 THEN concat('[{{"Aggregation":{{"Expression":{{"Column":', {ref}, {b}, '}}}},"Function":5}}}}]')
      WHEN 3 THEN concat('[{{"HierarchyLevel":', {ref}, {b}, '}}}}]')
      ELSE concat('[{{"Column":', {ref}, {b}, '}}}}]') END"""
    from_sql = """CASE WHEN p_size % 5 = 4 THEN '[{"Name":"p","Expression":{"Subquery":{}},"Type":2}]' ELSE '[{"Name":"p","Entity":"Parts","Type":0}]' END"""
    caps = _part_captures(pa, F.col("p_partkey"), select_sql, from_sql)
    mods = discover(caps)["modules"]
    return mods.select(F.col("report_key").cast("bigint").alias("p_partkey"), F.explode("select_columns").alias("s")).select(
        "p_partkey", F.col("s.prop").alias("prop"), F.col("s.is_measure").alias("is_measure"))


@check("Q_module_names", """
SELECT p_partkey, lower(replace(least(p_type, p_brand) || CASE WHEN p_type = p_brand THEN '' ELSE '_' || greatest(p_type, p_brand) END || '_' || p_name, ' ', '_')) AS name FROM part
""")
def q_module_names(spark, sf_dir):
    """Entities {p_type, p_brand}, selected column p_name -> module name."""
    pa = table(spark, sf_dir, "part")
    from_sql = f"""concat('[{{"Name":"t","Entity":', {jv("p_type")}, ',"Type":0}},{{"Name":"b","Entity":', {jv("p_brand")}, ',"Type":0}}]')"""
    select_sql = f"concat('[', {_column_item('t', jv('p_name'))}, ']')"
    mods = discover(_part_captures(pa, F.col("p_partkey"), select_sql, from_sql))["modules"]
    return mods.select(F.col("report_key").cast("bigint").alias("p_partkey"), "name")


@check("Q_shape_dedupe", """
SELECT event_type, CAST(floor(value / 10) AS BIGINT) AS bucket, min(event_id) AS kept FROM events GROUP BY 1, 2
""")
def q_shape_dedupe(spark, sf_dir):
    """One report; the query shape is (event_type, value bucket), written with
    its keys in a different order for odd and even event ids."""
    ev = table(spark, sf_dir, "events")
    sel = f"concat('[', {_column_item('e', jv('event_type'))}, ']')"
    frm = """'[{"Name":"e","Entity":"Events","Type":0}]'"""
    where = """concat('[{"Condition":{"Bucket":', cast(cast(floor(value / 10) AS bigint) AS string), '}}]')"""
    cmd = f"""CASE WHEN event_id % 2 = 0
      THEN concat('{{"Query":{{"Version":2,"From":', {frm}, ',"Select":', {sel}, ',"Where":', {where}, '}}}}')
      ELSE concat('{{"Query":{{"Where":', {where}, ',"Select":', {sel}, ',"From":', {frm}, ',"Version":2}}}}') END"""
    caps = ev.select(
        F.lit("events").alias("report_key"), F.col("event_id").alias("pos"), F.expr(QUERY_URL).alias("url"),
        F.array().cast("array<struct<name:string,value:string>>").alias("headers"),
        F.expr(_capture_body(cmd)).alias("body"),
    )
    mods = discover(caps)["modules"]
    return mods.select(
        F.expr("select_columns[0].prop").alias("event_type"),
        F.get_json_object("query_template", "$.Query.Where[0].Condition.Bucket").cast("bigint").alias("bucket"),
        F.col("pos").alias("kept"),
    )


@check("Q_name_suffix", """
SELECT c_custkey, n || CASE WHEN count(*) OVER (PARTITION BY n) = 1 THEN '' ELSE '_' || row_number() OVER (PARTITION BY n ORDER BY c_custkey) END AS name
FROM (SELECT c_custkey, lower(c_mktsegment) || '_' || c_nationkey AS n FROM customer)
""")
def q_name_suffix(spark, sf_dir):
    """C11: one report; a capture per customer named segment_nation (distinct shapes
    through a Where on the customer); repeated names get _1, _2 ... in capture order."""
    cu = table(spark, sf_dir, "customer")
    frm = f"""concat('[{{"Name":"c","Entity":', {jv("c_mktsegment")}, ',"Type":0}}]')"""
    sel = f"concat('[', {_column_item('c', jv('cast(c_nationkey AS string)'))}, ']')"
    where = """concat('[{"Condition":{"Key":', cast(c_custkey AS string), '}}]')"""
    cmd = f"""concat('{{"Query":{{"From":', {frm}, ',"Select":', {sel}, ',"Where":', {where}, '}}}}')"""
    caps = cu.select(
        F.lit("customers").alias("report_key"), F.col("c_custkey").alias("pos"), F.expr(QUERY_URL).alias("url"),
        F.array().cast("array<struct<name:string,value:string>>").alias("headers"),
        F.expr(_capture_body(cmd)).alias("body"),
    )
    mods = discover(caps)["modules"]
    return mods.select(F.col("pos").alias("c_custkey"), "name")


@check("Q_is_paginated", """
SELECT event_id, event_id % 5 IN (0, 4) AS paginated FROM events
""")
def q_is_paginated(spark, sf_dir):
    """event_id % 5: 0 Window, 1 Top, 2 Primary null, 3 Binding null, 4 Window null."""
    ev = table(spark, sf_dir, "events")
    tpl = F.expr("""CASE event_id % 5
      WHEN 0 THEN '{"Query":{},"Binding":{"DataReduction":{"DataVolume":3,"Primary":{"Window":{"Count":500}}}}}'
      WHEN 1 THEN '{"Query":{},"Binding":{"DataReduction":{"DataVolume":3,"Primary":{"Top":{}}}}}'
      WHEN 2 THEN '{"Query":{},"Binding":{"DataReduction":{"Primary":null}}}'
      WHEN 3 THEN '{"Query":{},"Binding":null}'
      ELSE '{"Query":{},"Binding":{"DataReduction":{"Primary":{"Window":null}}}}' END""")
    return ev.select("event_id", is_paginated(tpl).alias("paginated"))


@check("Q_payload", """
SELECT p_partkey, 30000 AS cnt, CASE WHEN p_size < 10 THEN NULL ELSE p_size END AS token, p_brand AS where_value FROM part
""")
def q_payload(spark, sf_dir):
    """A module per part whose template filters on p_brand; its next-page
    request carries tokens = p_size (none when p_size < 10); read back from the JSON."""
    pa = table(spark, sf_dir, "part")
    where = f"""concat(',"Where":[{{"Condition":{{"In":{{"Values":[[{{"Literal":{{"Value":', {jv("p_brand")}, '}}}}]]}}}}}}]')"""
    caps = _part_captures(
        pa, F.col("p_partkey"), f"concat('[', {_column_item('p', jv('p_name'))}, ']')",
        """'[{"Name":"p","Entity":"Parts","Type":0}]'""", where)
    found = discover(caps)
    req = found["modules"].join(pa.select(F.col("p_partkey").cast("string").alias("report_key"), "p_size"), "report_key")
    req = req.withColumn("rt", F.when(F.col("p_size") >= 10, F.col("p_size").cast("string")))
    out = build_payloads(req, found["report_config"], window_config(PAGE_SIZE, F.col("rt")))
    cmd = "$.queries[0].Query.Commands[0].SemanticQueryDataShapeCommand"
    return out.select(
        F.col("report_key").cast("bigint").alias("p_partkey"),
        F.get_json_object("payload", f"{cmd}.Binding.DataReduction.Primary.Window.Count").cast("int").alias("cnt"),
        F.get_json_object("payload", f"{cmd}.Binding.DataReduction.Primary.Window.RestartTokens").cast("int").alias("token"),
        F.get_json_object("payload", f"{cmd}.Query.Where[0].Condition.In.Values[0][0].Literal.Value").alias("where_value"),
    )


_TOP = """'{"Query":{},"Binding":{"DataReduction":{"Primary":{"Top":{}}}}}'"""
_WINDOW = """'{"Query":{},"Binding":{"DataReduction":{"Primary":{"Window":{"Count":500}}}}}'"""


@check("Q_next_requests", """
WITH p AS (SELECT user_id, event_id, event_type, event_id % 11 <> 0 AS landed,
                  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page_no FROM events),
s AS (SELECT user_id, min(page_no) FILTER (NOT landed OR event_type IN ('error', 'purchase') OR user_id % 10 = 0) AS stop, max(page_no) AS n
      FROM p GROUP BY 1),
w AS (SELECT s.user_id, coalesce(stop, n + 1) AS page_no FROM s LEFT JOIN p ON p.user_id = s.user_id AND p.page_no = s.stop
      WHERE stop IS NULL OR NOT landed)
SELECT w.user_id AS module, w.page_no, p.event_id AS token, CASE WHEN w.user_id % 10 <> 0 THEN 20000 END AS cnt
FROM w LEFT JOIN p ON p.user_id = w.user_id AND p.page_no = w.page_no - 1
WHERE w.user_id % 7 <> 0
UNION ALL
SELECT c_custkey, 1, NULL, CASE WHEN c_custkey % 10 <> 0 THEN 20000 END FROM customer
WHERE c_custkey % 7 <> 0 AND c_custkey NOT IN (SELECT user_id FROM events)
""")
def q_next_requests(spark, sf_dir):
    """module = user, one page per event, those with event_id % 11 = 0 not landed; status 500
    for 'error', no tokens for 'purchase', else the event's id; users % 10 = 0 are single shot.
    Customers that are no user have landed nothing.  Requests of modules % 7 = 0 were issued before."""
    ev = group_row_number(table(spark, sf_dir, "events"), ["user_id"], "event_id", "page_no").where("event_id % 11 <> 0")
    fields = [Field("M0", "e.user_id", "user_id", repeat=None), Field("M1", "e.event_id", "event_id", repeat=None)]
    entries = encode_entries(ev, ["user_id", "page_no"], ["event_id"], fields).join(
        ev.select("user_id", "page_no", "event_type"), ["user_id", "page_no"])
    rt = F.when(F.first("event_type") != "purchase", F.concat(F.lit("[["), F.first("event_id").cast("string"), F.lit("]]")))
    pages = build_pages(entries, ["user_id", "page_no"], ["_rn"], descriptor_json(fields), rt=rt, extra={"event_type": F.first("event_type")})
    resp = responses_of(pages, "events", F.col("user_id"), F.col("page_no"), status=F.when(F.col("event_type") == "error", 500).otherwise(200))
    ids = table(spark, sf_dir, "events").select("user_id").union(table(spark, sf_dir, "customer").select("c_custkey")).distinct()
    modules = ids.select(F.lit("events").alias("report_key"), F.col("user_id").cast("string").alias("name"),
                         F.expr(f"CASE WHEN user_id % 10 = 0 THEN {_TOP} ELSE {_WINDOW} END").alias("query_template"),
                         (F.col("user_id") % 10 != 0).alias("paginated"))
    config = report_config(ids.limit(1).select(
        F.lit("events").alias("report_key"), F.lit(0).alias("pos"), F.expr(QUERY_URL).alias("url"),
        F.array().cast("array<struct<name:string,value:string>>").alias("headers"), F.expr(_capture_body(_TOP)).alias("body")))
    progress = extract(resp, modules.withColumnRenamed("name", "module")).progress()
    ledger = scratch_dir(spark, "ledger")
    issue(spark, next_requests(modules.where("name % 7 = 0"), config, progress, page_size=20000), ledger, 0)
    out = issue(spark, next_requests(modules, config, progress, read_ledger(spark, ledger), page_size=20000), ledger, 1)
    window = "$.queries[0].Query.Commands[0].SemanticQueryDataShapeCommand.Binding.DataReduction.Primary.Window"
    return out.select(
        F.col("module").cast("bigint").alias("module"), F.col("page_no").cast("bigint").alias("page_no"),
        F.get_json_object("payload", f"{window}.RestartTokens[0][0]").cast("bigint").alias("token"),
        F.get_json_object("payload", f"{window}.Count").cast("int").alias("cnt"))


@check("Q_module_selection", """
SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#13'
""")
def q_module_selection(spark, sf_dir):
    """C17: modules = parts (one report); the request names every Brand#13 part (in
    key order) plus three unknown names; selection keeps request order."""
    pa = table(spark, sf_dir, "part")
    modules = pa.select(F.lit("parts").alias("report_key"), F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("name"),
                        "p_partkey", "p_name")
    wanted = pa.where(F.col("p_brand") == "Brand#13").select(
        F.lit("parts").alias("report_key"), F.col("p_partkey").alias("req_pos"),
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("name"))
    unknown = spark.createDataFrame([("parts", -3, "no_such_a"), ("parts", -2, "no_such_b"), ("parts", -1, "no_such_c")],
                                    "report_key string, req_pos bigint, name string")
    selected, _ = select_modules(modules, wanted.unionByName(unknown), raise_unknown=False)
    return selected.select("p_partkey", "p_name")


# ---------------------------------------------------------------------------
# 2.B sinks, 2.A catalog source, 2.F bulk runs, S1 streaming
# ---------------------------------------------------------------------------

@check("Q_csv_roundtrip", """
SELECT s_suppkey, s_name, s_acctbal FROM supplier
""")
def q_csv_roundtrip(spark, sf_dir):
    """B1: supplier pages decoded to a typed table, written as CSV, read back."""
    su = table(spark, sf_dir, "supplier").withColumn("p", F.expr("s_suppkey div 1000"))
    fields = [
        Field("M0", "s.s_suppkey", "s_suppkey", repeat=None),
        Field("M1", "s.s_name", "s_name", repeat=None),
        Field("M2", "s.s_acctbal", "s_acctbal"),
    ]
    resp = responses_of(encode_table(su, ["p"], ["s_suppkey"], fields), "suppliers", "supplier", F.col("p") + 1)
    rows = explode_rows(decode_pages(resp))
    typed = typed_columns(rows, {"s_suppkey": "bigint", "s_name": "string", "s_acctbal": "double"}, ("page_no", "pos"))
    path = scratch_dir(spark, "csv") + "/supplier.csv"
    write_module_csv(typed, path)
    return spark.read.schema("s_suppkey bigint, s_name string, s_acctbal double").option("header", True).csv(path)


@check("Q_catalog_roundtrip", """
SELECT DISTINCT p_brand AS module, 'parts_brand' AS name FROM part
""")
def q_catalog_roundtrip(spark, sf_dir):
    """B2/A4: a report per brand; every part's capture has the same query shape, so
    discovery keeps one module per report; saved as JSON and loaded back."""
    pa = table(spark, sf_dir, "part")
    sel = f"concat('[', {_column_item('p', jv(repr('Brand')))}, ']')"
    caps = _part_captures(pa, F.col("p_brand"), sel, """'[{"Name":"p","Entity":"Parts","Type":0}]'""")
    found = discover(caps)
    path = scratch_dir(spark, "catalog")
    save_catalog(found["report_config"], found["modules"], path, redact=True)
    _, mods = load_catalog(spark, path)
    return mods.select(F.col("report_key").alias("module"), "name")


@check("Q_report_dirs", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'report_' || row_number() OVER (ORDER BY o_orderkey) ELSE o_orderpriority END AS report_dir FROM orders
""")
def q_report_dirs(spark, sf_dir):
    """A URL per order, listed in key order; it carries r = base64 of
    {"k": priority} unless o_orderkey % 9 = 0 (no r parameter)."""
    od = table(spark, sf_dir, "orders")
    r = F.regexp_replace(F.base64(F.to_json(F.struct(F.col("o_orderpriority").alias("k"))).cast("binary")), "=+$", "")
    url = F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.lit("https://app.example.com/view?id="), F.col("o_orderkey").cast("string"))) \
        .otherwise(F.concat(F.lit(VIEW_URL_PREFIX), r))
    urls = od.select("o_orderkey", url.alias("url"), F.col("o_orderkey").alias("url_index"))
    return report_dirs(urls).select("o_orderkey", "report_dir")


@check("Q_bulk_summary", """
SELECT status, count(*) AS n FROM (SELECT o_custkey, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'failed' ELSE 'ok' END AS status FROM orders GROUP BY 1) GROUP BY 1
""")
def q_bulk_summary(spark, sf_dir):
    """report = customer, one capture per order; an order with status 'F'
    captured a subquery-sourced query (unusable).  A report whose captures give no
    module fails discovery; count reports per status."""
    od = table(spark, sf_dir, "orders")
    frm = """CASE WHEN o_orderstatus = 'F' THEN '[{"Name":"s","Expression":{"Subquery":{}},"Type":2}]' ELSE '[{"Name":"o","Entity":"Orders","Type":0}]' END"""
    sel = f"concat('[', {_column_item('o', jv(repr('Total')))}, ']')"
    cmd = f"""concat('{{"Query":{{"From":', {frm}, ',"Select":', {sel}, '}}}}')"""
    caps = od.select(
        F.col("o_custkey").cast("string").alias("report_key"), F.col("o_orderkey").alias("pos"),
        F.expr(QUERY_URL).alias("url"), F.array().cast("array<struct<name:string,value:string>>").alias("headers"),
        F.expr(_capture_body(cmd)).alias("body"),
    )
    found = discover(caps)
    urls = od.select(F.col("o_custkey").cast("string").alias("report_key")).distinct().select(
        F.concat(F.lit(VIEW_URL_PREFIX), F.col("report_key")).alias("url"), "report_key")
    return bulk_summary(report_status(urls, found["report_discovery"]))


@check("Q_stream_decode", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_returnflag, l_linestatus FROM lineitem
""")
def q_stream_decode(spark, sf_dir):
    """Lineitem pages landed as files, decoded incrementally by a stream
    (available-now trigger, one micro-batch per landed file group), then typed."""
    base = scratch_dir(spark, "stream")
    lineitem_responses(spark, sf_dir).write.mode("overwrite").json(f"{base}/landing")
    q = start_incremental_decode(spark, f"{base}/landing", f"{base}/decoded", f"{base}/_checkpoint",
                                 max_files_per_trigger=2)
    q.awaitTermination()
    staged = spark.read.parquet(f"{base}/decoded")
    typed = typed_from_json(staged_rows(staged), {c: ("bigint" if t == "int" else t) for c, t in LINEITEM_TYPES.items()})
    return typed.select(*[F.col(c).cast(t).alias(c) for c, t in LINEITEM_TYPES.items()])


@check("Q_quarantine", """
SELECT event_id // 100 + 1 AS page_no, min(event_id % 100) AS pos, 'bad_values' AS reason
FROM events WHERE value > 200 GROUP BY 1
""")
def q_quarantine(spark, sf_dir):
    """The quarantine table of the Q_truncate pages: per page, the position
    of the first malformed entry and its reason."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 100"))
    entry = f"""CASE WHEN value > 200 THEN '{{"C":null}}'
      ELSE concat('{{"C":[', {jv("event_id")}, ',', {jv("value")}, ']}}') END"""
    d = desc(("M0", "e.event_id"), ("M1", "e.value"))
    resp = responses_of(custom_pages(ev, ["p"], ["event_id"], entry, d), "events", "events", F.col("p") + 1)
    q = quarantine(decode_landed(resp))
    return q.select(F.col("page_no").cast("bigint").alias("page_no"), F.col("pos").cast("bigint").alias("pos"), "reason")


@check("Q_module_outcome", """
WITH p AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page_no,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events),
f AS (SELECT user_id, min(page_no) FILTER (WHERE event_type IN ('error', 'purchase')) AS stop_page, max(n) AS n FROM p GROUP BY 1),
t AS (SELECT f.user_id, f.stop_page, f.n, p.event_type AS stop_type FROM f LEFT JOIN p ON p.user_id = f.user_id AND p.page_no = f.stop_page)
SELECT user_id AS module,
       CASE WHEN stop_type = 'purchase' THEN 0 WHEN stop_type = 'error' THEN stop_page - 1 ELSE n END AS n_rows,
       CASE WHEN stop_type = 'purchase' THEN 'failed' WHEN stop_type = 'error' AND stop_page = 1 THEN 'empty'
            WHEN stop_type = 'error' THEN 'partial' ELSE 'ok' END AS status
FROM t
""")
def q_module_outcome(spark, sf_dir):
    """module = user, one page per event (page_no = rank by event_id), tokens
    on every page but the user's last; 'error' pages answered 500 (the module stops
    there, earlier pages kept), 'purchase' pages answered 401 after retries (the
    whole module fails).  Per-module status and row count."""
    ev = group_row_number(table(spark, sf_dir, "events"), ["user_id"], "event_id", "page_no")
    last = ev.groupBy("user_id").agg(F.max("page_no").alias("n_pages"))
    fields = [Field("M0", "e.user_id", "user_id", repeat=None), Field("M1", "e.event_id", "event_id", repeat=None)]
    entries = encode_entries(ev, ["user_id", "page_no"], ["event_id"], fields)
    entries = entries.join(ev.select("user_id", "page_no", "event_type"), ["user_id", "page_no"]).join(last, "user_id")
    rt = F.when(F.first("page_no") < F.first("n_pages"), F.lit("[[1]]"))
    pages = build_pages(entries, ["user_id", "page_no"], ["_rn"], descriptor_json(fields), rt=rt,
                        extra={"event_type": F.first("event_type")})
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "purchase", 401).otherwise(200)
    ex = extract(responses_of(pages, "events", F.col("user_id"), F.col("page_no"), status=status))
    return ex.status().select(F.col("module").cast("bigint").alias("module"), "n_rows", "status")


# ---------------------------------------------------------------------------
# wide pages, text in CSVs
# ---------------------------------------------------------------------------

WIDE = 130


def _wide_value(i: int) -> str:
    return f"s_suppkey * {i + 1} + s_nationkey"


def _wide_repeated(i: int) -> bool:
    """Columns with a repeat bit on rows of kind 1 (s_suppkey % 3)."""
    return i % 5 == 0


def _wide_null(i: int) -> bool:
    """Columns with a null bit on rows of kind 2."""
    return i % 7 == 3


def _wide_sql(i: int) -> str:
    v = _wide_value(i)
    before = f"lag({v}) OVER (PARTITION BY s_suppkey // 99 ORDER BY s_suppkey)" if _wide_repeated(i) else v
    null = "NULL" if _wide_null(i) else v
    return f"CASE s_suppkey % 3 WHEN 1 THEN {before} WHEN 2 THEN {null} ELSE {v} END AS w{i}"


@check("Q_wide_page", "SELECT s_suppkey, " + ", ".join(map(_wide_sql, range(WIDE))) + " FROM supplier")
def q_wide_page(spark, sf_dir):
    """Supplier pages of 131 columns; rows of kind 1 and 2 have repeat and null masks beyond 126 bits."""
    su = table(spark, sf_dir, "supplier").withColumn("p", F.expr("s_suppkey div 99"))
    values = ["CAST(s_suppkey AS STRING)"]
    for i in range(WIDE):
        left_out = [k for k, out in ((1, _wide_repeated(i)), (2, _wide_null(i))) if out]
        v = f"CAST({_wide_value(i)} AS STRING)"
        values.append(f"CASE WHEN s_suppkey % 3 IN ({', '.join(map(str, left_out))}) THEN NULL ELSE {v} END" if left_out else v)
    repeat, null = (sum(1 << i + 1 for i in range(WIDE) if bit(i)) for bit in (_wide_repeated, _wide_null))
    schema = "[" + ",".join(f'{{"N":"M{i}"}}' for i in range(WIDE + 1)) + "]"
    entry = (
        "concat('{', CASE WHEN s_suppkey = min(s_suppkey) OVER (PARTITION BY p) THEN '\"S\":" + schema + ",' ELSE '' END, "
        f"CASE s_suppkey % 3 WHEN 1 THEN '\"R\":{repeat},' WHEN 2 THEN '\"Ø\":{null},' ELSE '' END, "
        "'\"C\":[', concat_ws(',', " + ", ".join(values) + "), ']}')"
    )
    names = desc(("M0", "s.s_suppkey"), *[(f"M{i + 1}", f"s.w{i}") for i in range(WIDE)])
    pages = custom_pages(su, ["p"], ["s_suppkey"], entry, names)
    rows = explode_rows(decode_landed(responses_of(pages, "wide", "supplier", F.col("p") + 1)))
    return typed_columns(rows, {"s_suppkey": "bigint", **{f"w{i}": "bigint" for i in range(WIDE)}})


_BLANKS = "concat('  ', c_name, ', \"', c_mktsegment, '\" ')"


@check("Q_csv_text", f"SELECT c_custkey, {_BLANKS} AS note, c_acctbal > 0 AS solvent FROM customer")
def q_csv_text(spark, sf_dir):
    """B1: blanks at both ends, quotes, commas and booleans come back from a module CSV as they were."""
    cu = table(spark, sf_dir, "customer").withColumn("p", F.expr("c_custkey div 1000"))
    fields = [Field("M0", "c.c_custkey", "c_custkey", repeat=None), Field("M1", "c.note", _BLANKS), Field("M2", "c.solvent", "c_acctbal > 0")]
    resp = responses_of(encode_table(cu, ["p"], ["c_custkey"], fields), "customers", "customer", F.col("p") + 1)
    typed = typed_columns(explode_rows(decode_pages(resp)), {"c_custkey": "bigint", "note": "string", "solvent": "boolean"}, ("page_no", "pos"))
    path = scratch_dir(spark, "csv") + "/customer.csv"
    write_module_csv(typed, path)
    return (spark.read.schema("c_custkey bigint, note string, solvent boolean").option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


# ---------------------------------------------------------------------------
# queries as captured, exact numbers, odd dictionaries
# ---------------------------------------------------------------------------

_REPLAYED = ('{"version":"1.0.0","queries":[{"Query":{"Commands":[{"SemanticQueryDataShapeCommand":',
             '}]},"ApplicationContext":{"DatasetId":"ds","Sources":[{"ReportId":"rep","VisualId":"vis"}]}}],"cancelQueries":[],"modelId":598501}')
#: A command with blanks, number forms and escapes that writing it anew would change: before, between and after two numbers.
_FORMS = ('{ "Query" : {"From":[{"Type":0, "Name":"p","Entity":"Parts"}],\t"Select":[{"Column":{"Expression":{"SourceRef":{"Source":"p"}},'
          '"Property":"x"}}], "Where":[ 2.50, 1e3, -0.0, "\\u00e9\\"}{", ', '.10, ', ' ] }, "Z":[1 , {"Binding":{"DataReduction":7}}]')
#: What follows it by part: a window, no reduction, no binding, no primary part.
_BINDINGS = (', "Binding" : { "DataReduction":{"DataVolume":4, "Primary": {"Window": {"Count": 500}} , "Extra":1.0} , "Version":1 } }',
             ', "Binding":{"DataReduction": null, "Version":1}}', ' }', ', "Binding":{"DataReduction":{ "Extra":1.0 }}}\n')
_PRIMARY = '{"Window":{"Count":30000}}'
_REBOUND = (f', "Binding" : {{ "DataReduction":{{"DataVolume":4, "Primary": {_PRIMARY} , "Extra":1.0}} , "Version":1 }} }}',
            f', "Binding":{{"DataReduction": {{"DataVolume":3,"Primary":{_PRIMARY}}}, "Version":1}}}}',
            f' ,"Binding":{{"DataReduction":{{"DataVolume":3,"Primary":{_PRIMARY}}}}}}}',
            f', "Binding":{{"DataReduction":{{ "Extra":1.0 ,"Primary":{_PRIMARY}}}}}}}')


def _cases(texts) -> str:
    return "CASE p_size % 4 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts)) + " END"


@check("Q_payload_verbatim", f"""
SELECT p_partkey, '{_REPLAYED[0]}' || '{_FORMS[0]}' || p_size || '{_FORMS[1]}' || p_partkey || '{_FORMS[2]}'
       || {_cases(_REBOUND)} || '{_REPLAYED[1]}' AS payload FROM part
""")
def q_payload_verbatim(spark, sf_dir):
    """C14: a report per part whose captured command has blanks, ``2.50``, ``1e3``, escapes and a
    decoy of the binding; its payload is that text but for the window."""
    pa = table(spark, sf_dir, "part")
    binding = F.lit(None).cast("string")
    for i, b in enumerate(_BINDINGS):
        binding = F.when(F.col("p_size") % 4 == i, F.lit(b)).otherwise(binding)
    cmd = F.concat(F.lit(_FORMS[0]), F.col("p_size").cast("string"), F.lit(_FORMS[1]), F.col("p_partkey").cast("string"), F.lit(_FORMS[2]), binding)
    body = F.concat(F.lit('{"modelId":598501, "queries":[{"ApplicationContext":{"DatasetId":"ds","Sources":[{"ReportId":"rep","VisualId":"vis"}]},'
                          '"Query":{"Commands":[{"SemanticQueryDataShapeCommand":'), cmd, F.lit("}]}}]}"))
    caps = pa.select(F.col("p_partkey").cast("string").alias("report_key"), F.col("p_partkey").alias("pos"), F.expr(QUERY_URL).alias("url"),
                     F.array().cast("array<struct<name:string,value:string>>").alias("headers"), body.alias("body"))
    found = discover(caps)
    out = build_payloads(found["modules"], found["report_config"], window_config(), paginated_only=False)
    # A command is the JSON value itself: blanks after it are not part of it.
    return out.select(F.col("report_key").cast("bigint").alias("p_partkey"), "payload")


@check("Q_exact_numbers", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '1234567890' || lpad(o_orderkey::VARCHAR, 10, '0') END AS big,
       repeat('9', 32) || lpad(o_orderkey::VARCHAR, 10, '0') AS huge FROM orders
""")
def q_exact_numbers(spark, sf_dir):
    """Integers of 20 digits (some rows) and of 42 digits come back to the last digit."""
    od = table(spark, sf_dir, "orders").withColumn("p", F.expr("o_orderkey div 1000"))
    digits = "lpad(cast(o_orderkey AS string), 10, '0')"
    entry = f"""concat('{{"C":[', cast(o_orderkey AS string), ',', CASE WHEN o_orderkey % 2 = 0 THEN cast(o_orderkey AS string)
      ELSE concat('1234567890', {digits}) END, ',', repeat('9', 32), {digits}, ']}}')"""
    last = od.agg(F.max("p")).first()[0]
    rt = F.when(F.first("p") < F.lit(last), F.lit("[[1]]"))
    pages = custom_pages(od, ["p"], ["o_orderkey"], entry, desc(("M0", "o.o_orderkey"), ("M1", "o.big"), ("M2", "o.huge")), rt=rt)
    at = pages.select("p").distinct()
    pages = pages.join(group_row_number(at, [], "p", "n"), "p")
    found = extract(responses_of(pages, "orders", "orders", F.col("n"))).table("orders", "orders")
    return found.select("o_orderkey", F.col("big").cast("string").alias("big"), "huge")


_DICTS = """CASE p % 3 WHEN 0 THEN '{"D1":["d0","d1","d2"]}' WHEN 1 THEN '{"D1":{"a":1,"b":2}}' ELSE '{"D1":"xyz"}' END"""


@check("Q_bad_dictionary", """
WITH e AS (SELECT event_id, event_id // 100 AS p, event_id % 100 AS pos, event_id % 7 AS v,
                  min(CASE WHEN event_id % 7 < 2 THEN event_id END) OVER (PARTITION BY event_id // 100) AS cut FROM events)
SELECT event_id, CASE WHEN v > 2 OR p % 3 = 1 THEN v::VARCHAR WHEN p % 3 = 0 THEN 'd' || v ELSE substr('xyz', v::INT + 1, 1) END AS label,
       CAST(NULL AS VARCHAR) AS reason FROM e WHERE p % 3 <> 1 OR event_id < coalesce(cut, event_id + 1)
UNION ALL
SELECT cut, NULL, 'bad_dictionary' FROM e WHERE p % 3 = 1 GROUP BY p, cut HAVING cut IS NOT NULL
""")
def q_bad_dictionary(spark, sf_dir):
    """Pages of 100 events; the dictionary of a page is an array, an object or a text.  A
    number below an object's size cannot be looked up: the page ends before it, with a reason."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 100"))
    entry = f"""concat('{{"C":[', {jv("event_id")}, ',', cast(event_id % 7 AS string), ']}}')"""
    pages = build_pages(ev.select("p", "event_id", F.expr(entry).alias("entry"), F.expr(_DICTS).alias("dicts")),
                        ["p"], ["event_id"], desc(("M0", "e.event_id"), ("M1", "e.label")))
    dec = stage(decode_pages(responses_of(pages, "events", "events", F.col("p") + 1)), "decoded")
    rows = typed_columns(explode_rows(dec), {"event_id": "bigint", "label": "string"}).withColumn("reason", F.lit(None).cast("string"))
    firsts = ev.groupBy("p").agg(F.min("event_id").alias("first"))
    bad = quarantine(dec).join(firsts.withColumn("page_no", (F.col("p") + 1).cast("int")), "page_no")
    return rows.unionByName(bad.select((F.col("first") + F.col("pos")).alias("event_id"), F.lit(None).cast("string").alias("label"), "reason"))


# ---------------------------------------------------------------------------
# unreadable sources, bulk runs, failures
# ---------------------------------------------------------------------------

@check("Q_bad_pages", """
SELECT p + 1 AS page_no, CASE p % 4 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'http' ELSE 'rows' END AS outcome, CASE WHEN p % 4 IN (0, 3) THEN count(*) ELSE 0 END AS n_rows
FROM (SELECT event_id // 100 AS p FROM events) GROUP BY p
""")
def q_bad_pages(spark, sf_dir):
    """A2: the bodies of pages % 4 = 1 are cut short, those of % 4 = 2 came with an HTTP error and are
    no JSON either; only the former are quarantined."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 100"))
    fields = [Field("M0", "e.event_id", "event_id", repeat=None)]
    pages = encode_table(ev, ["p"], ["event_id"], fields)
    kind = F.col("p") % 4
    pages = pages.withColumn("body", F.when(kind == 1, F.expr("substr(body, 1, length(body) - 1)")).when(kind == 2, F.lit("Bad gateway")).otherwise(F.col("body")))
    dec = stage(decode_pages(responses_of(pages, "events", "events", F.col("p") + 1, status=F.when(kind == 2, 502).otherwise(200))), "decoded")
    bad = quarantine(dec).select("page_no", "reason")
    return dec.join(bad, "page_no", "left").select(
        F.col("page_no").cast("bigint").alias("page_no"),
        F.coalesce("reason", F.when(F.col("status") != 200, F.lit("http")).otherwise(F.lit("rows"))).alias("outcome"), F.col("n_rows").cast("bigint").alias("n_rows"))


@check("Q_url_files", """
WITH t AS (SELECT c_nationkey AS f, c_custkey AS k, 'https://app.example.com/view?r=' || c_mktsegment || (c_custkey % 50) AS url FROM customer),
u AS (SELECT url, min(lpad(f::VARCHAR, 3, '0') || lpad(k::VARCHAR, 12, '0')) AS seen FROM t GROUP BY url)
SELECT url, row_number() OVER (ORDER BY seen) AS url_index FROM u
""")
def q_url_files(spark, sf_dir):
    """A3/C4: a text file per nation, a line per customer with its URL; distinct URLs numbered by first appearance."""
    cu = table(spark, sf_dir, "customer")
    line = F.concat(F.lit("- "), F.lit(VIEW_URL_PREFIX), F.col("c_mktsegment"), (F.col("c_custkey") % 50).cast("string"), F.lit(" <now>"))
    texts = cu.groupBy("c_nationkey").agg(F.sort_array(F.collect_list(F.struct("c_custkey", line.alias("line")))).alias("ls"))
    base = scratch_dir(spark, "urls")
    (texts.select(F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation"), F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("value"))
     .write.partitionBy("nation").text(base))
    found = read_texts(spark, f"{base}/*/*.txt")
    return numbered_urls(extract_view_urls(found))


@check("Q_lenient_key", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE c_name END AS resource_key FROM customer")
def q_lenient_key(spark, sf_dir):
    """R with a trailing comma, with blanks and dashes inside, with text after its padding, plain; or cut short (% 5 = 4)."""
    cu = table(spark, sf_dir, "customer")
    full = F.base64(F.to_json(F.struct(F.col("c_name").alias("k"))).cast("binary"))
    full = F.when(F.col("c_custkey") % 5 == 2, F.base64(F.concat(F.to_json(F.struct(F.col("c_name").alias("k"))), F.lit(" ")).cast("binary"))).otherwise(full)
    bare = F.regexp_replace(full, "=+$", "")
    r = (F.when(F.col("c_custkey") % 5 == 0, F.concat(full, F.lit(",")))
         .when(F.col("c_custkey") % 5 == 1, F.concat(F.substring(full, 1, 5), F.lit("%20-"), F.substring(full, 6, 10_000)))
         .when(F.col("c_custkey") % 5 == 2, F.when(full.endswith("="), F.concat(full, F.lit("QUJD"))).otherwise(full))
         .when(F.col("c_custkey") % 5 == 3, bare).otherwise(F.substring("c_mktsegment", 1, 1)))
    key, _ = resource_key(F.concat(F.lit(VIEW_URL_PREFIX), r))
    return cu.select("c_custkey", key.alias("resource_key"))


@check("Q_har_reports", """
SELECT c_nationkey AS doc, CASE WHEN c_nationkey % 4 = 0 THEN 0 WHEN c_nationkey % 4 = 1 THEN 0 ELSE count(*) END AS n_captures,
       CASE c_nationkey % 4 WHEN 0 THEN 'unreadable_har' WHEN 1 THEN 'no_captures' END AS detail, CASE WHEN c_nationkey % 4 < 2 THEN 'failed' ELSE 'ok' END AS status
FROM customer GROUP BY c_nationkey
""")
def q_har_reports(spark, sf_dir):
    """A HAR file per nation, an entry per customer; files of nations % 4 = 0 are cut short,
    those of % 4 = 1 hold GET requests only.  Every file has its line in the discovery report."""
    cu = table(spark, sf_dir, "customer")
    frm = """'[{"Name":"c","Entity":"Customers","Type":0}]'"""
    cmd = f"""concat('{{"Query":{{"From":', {frm}, ',"Select":[', {_column_item('c', jv('c_name'))}, ']}}}}')"""
    req = F.struct(F.when(F.col("c_nationkey") % 4 == 1, F.lit("GET")).otherwise(F.lit("POST")).alias("method"), F.expr(QUERY_URL).alias("url"),
                   F.array().cast("array<struct<name:string,value:string>>").alias("headers"),
                   F.struct(F.expr(_capture_body(cmd)).alias("text")).alias("postData"))
    docs = cu.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", req.alias("request")))).alias("es"))
    text = F.to_json(F.struct(F.struct(F.expr("transform(es, x -> struct(x.request AS request))").alias("entries")).alias("log")))
    cut = F.when(F.col("c_nationkey") % 4 == 0, F.expr("substr(t, 1, length(t) - 2)")).otherwise(F.col("t"))
    base = scratch_dir(spark, "har")
    (docs.select("c_nationkey", text.alias("t")).select(F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("doc"), cut.alias("value"))
     .write.partitionBy("doc").text(base))
    found = discover_har(spark, f"{base}/*/*.txt")["report_discovery"]
    return found.select(F.regexp_extract("report_key", "doc=0*([0-9]+)/", 1).cast("int").alias("doc"), F.col("n_captures").cast("bigint").alias("n_captures"), "detail", "status")


@check("Q_bulk_run", """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderkey % 30 = 1 AS landed FROM orders),
r AS (SELECT o_custkey, o_custkey % 6 = 0 AS nokey, count(*) FILTER (o_orderkey % 5 <> 0) AS caps, count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderstatus <> 'F') AS mods,
             count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderstatus <> 'F' AND landed) AS good FROM o GROUP BY 1)
SELECT o_custkey, CASE WHEN nokey OR mods = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN nokey THEN 0 ELSE mods END AS n_modules,
       CASE WHEN nokey THEN 'no_r_param' WHEN caps = 0 THEN 'no_captures' WHEN mods = 0 THEN 'no_usable_modules' END AS detail,
       CASE WHEN nokey OR mods = 0 THEN 0 ELSE good END AS n_rows
FROM r
""")
def q_bulk_run(spark, sf_dir):
    """A URL per customer (without key for % 6 = 0) in one text; a capture per order with the
    customer's key (none for order % 5 = 0), unusable for status 'F'; a response page of one row per
    order % 30 = 1.  From URL text, captures and responses to statuses and CSV rows."""
    od = table(spark, sf_dir, "orders")
    r = F.regexp_replace(F.base64(F.to_json(F.struct(F.concat(F.lit("key-"), F.col("o_custkey").cast("string")).alias("k"))).cast("binary")), "=+$", "")
    url = F.concat(F.lit(VIEW_URL_PREFIX), F.when(F.col("o_custkey") % 6 == 0, F.concat(F.lit("&id="), F.col("o_custkey").cast("string"))).otherwise(r))
    cu = stage(od.select("o_custkey").distinct().select("o_custkey", url.alias("url")), "bulk-customers")
    texts = cu.select(F.lit("list").alias("source"), (F.col("o_custkey") % 8).alias("part"), "url").groupBy("source", "part").agg(
        F.concat_ws("\n", F.collect_list("url")).alias("text")).select(F.concat("source", F.col("part").cast("string")).alias("source"), "text")
    frm = """CASE WHEN o_orderstatus = 'F' THEN '[{"Name":"s","Expression":{"Subquery":{}},"Type":2}]' ELSE '[{"Name":"o","Entity":"Orders","Type":0}]' END"""
    cmd = f"""concat('{{"Query":{{"From":', {frm}, ',"Select":[', {_column_item('o', jv("concat('k', cast(o_orderkey AS string))"))}, ']}}}}')"""
    header = F.struct(F.lit("x-resourcekey").alias("name"), F.concat(F.lit("key-"), F.col("o_custkey").cast("string")).alias("value"))
    caps = od.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("pos"), F.expr(QUERY_URL).alias("url"), F.array(header).alias("headers"),
                                                  F.expr(_capture_body(cmd)).alias("body"))
    pages = encode_table(od.where("o_orderkey % 30 = 1"), ["o_custkey", "o_orderkey"], ["o_orderkey"], [Field("M0", "o.key", "o_orderkey", repeat=None)])
    resp = responses_of(pages.join(cu, "o_custkey"), F.col("url"), F.concat(F.lit("orders_k"), F.col("o_orderkey").cast("string")), 1)
    out = scratch_dir(spark, "bulk")
    result = run_bulk(texts, caps, resp, out)
    rows = result.run.status.groupBy(F.col("report_key").alias("url")).agg(F.sum("n_rows").alias("n_rows"))
    st = result.report_status.join(rows, "url", "left").join(cu, "url")
    return st.select("o_custkey", "status", F.col("n_modules").cast("bigint").alias("n_modules"), "detail", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))


@check("Q_failures", """
WITH m AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'failed' ELSE 'ok' END AS status FROM orders)
SELECT o_custkey, count(*) FILTER (status = 'failed') || '/' || count(*) || ' module(s) failed: ' ||
       string_agg('m' || o_orderkey, ', ' ORDER BY o_orderkey) FILTER (status = 'failed') AS message,
       CASE WHEN bool_and(status = 'failed') THEN 1 ELSE 0 END AS exit_code
FROM m GROUP BY 1 HAVING count(*) FILTER (status = 'failed') > 0
""")
def q_failures(spark, sf_dir):
    """report = customer, module = order, failed for order % 3 = 0: the message of each
    report with failures, and its exit code (1 only if all its modules failed)."""
    st = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("report_key"), F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("module"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("failed")).otherwise(F.lit("ok")).alias("status"), F.lit(None).cast("string").alias("detail"),
        F.col("o_orderkey").alias("module_order"))
    found = failure_messages(st, "module_order").join(run_summary(st), "report_key")
    return found.select(F.col("report_key").alias("o_custkey"), "message", F.col("all_failed").cast("int").alias("exit_code"))


@check("Q_report_rows", """
SELECT s_nationkey, s_suppkey, s_name FROM supplier
""")
def q_report_rows(spark, sf_dir):
    """report = nation, and reports share a folder by region of ten keys; every row is read back
    with its own report key."""
    su = table(spark, sf_dir, "supplier")
    pages = encode_table(su, ["s_nationkey"], ["s_suppkey"], [Field("M0", "s.s_suppkey", "s_suppkey", repeat=None), Field("M1", "s.s_name", "s_name", repeat=None)])
    ex = extract(responses_of(pages, F.col("s_nationkey"), "a module/of ten", 1))
    dirs = su.select(F.col("s_nationkey").cast("string").alias("report_key"), F.concat(F.lit("folder "), F.expr("s_nationkey div 10").cast("string")).alias("report_dir")).distinct()
    path = scratch_dir(spark, "rows")
    write_rows_by_report(ex.rows, dirs, path)
    back = spark.read.schema("report_key string, row_json string").json(path)
    return back.select(F.col("report_key").cast("int").alias("s_nationkey"), F.get_json_object("row_json", "$.s_suppkey").cast("bigint").alias("s_suppkey"),
                       F.get_json_object("row_json", "$.s_name").alias("s_name"))


@check("Q_decode_counters", """
SELECT event_id // 100 AS module, count(*) FILTER (event_type = 'view') AS n_skipped, CASE event_id // 100 % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE 2 END AS n_guessed,
       CAST(0 AS BIGINT) AS n_cut FROM events GROUP BY event_id // 100
""")
def q_decode_counters(spark, sf_dir):
    """A module per page of 100 events; 'view' events are matrix entries; dictionaries are found by
    position in modules % 3 = 0, by name in % 3 = 1, and by position and by code in % 3 = 2."""
    ev = table(spark, sf_dir, "events").withColumn("p", F.expr("event_id div 100"))
    entry = f"""CASE WHEN event_type = 'view' THEN '{{"X":[1]}}' ELSE concat('{{"C":[', {jv("event_id")}, ',1]}}') END"""
    dicts = """CASE p % 3 WHEN 0 THEN '{"D1":["a"]}' WHEN 1 THEN '{"M1":["a"]}' ELSE '{"D0":["a"],"D1":["b"]}' END"""
    pages = build_pages(ev.select("p", "event_id", F.expr(entry).alias("entry"), F.expr(dicts).alias("dicts")),
                        ["p"], ["event_id"], desc(("M0", "e.event_id"), ("M1", "e.n")))
    found = extract(responses_of(pages, "events", F.col("p"), 1)).counters()
    return found.select(F.col("module").cast("bigint").alias("module"), "n_skipped", F.col("n_guessed").cast("int").alias("n_guessed"), "n_cut")
