"""Benchmark: decode / assembly / discovery throughput at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stand-in inputs (landed response pages, captures) are encoded from the driver
tables and written to a scratch folder first; only the library's jobs are
timed (best of three runs, results to the ``noop`` sink).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from reportlake import get_session  # noqa: E402
from reportlake.plans.extract import extract  # noqa: E402
from reportlake.operators.discover import discover  # noqa: E402
from reportlake.plans.checks import (  # noqa: E402
    LINEITEM_FIELDS,
    _event_captures,
    decode_lineitem,
    responses_of,
    table,
)
from reportlake.plans.encode import encode_table  # noqa: E402
from reportlake.session import scratch_dir  # noqa: E402


def timed(fn, repeat=3):
    best = None
    for _ in range(repeat):
        t = time.time()
        fn()
        dt = time.time() - t
        best = dt if best is None else min(best, dt)
    return round(best, 3)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]")
    sf = sf_dir.rsplit("sf", 1)[-1]
    base = scratch_dir(spark, "bench")

    # --- stand-in inputs (untimed) ---
    li = table(spark, sf_dir, "lineitem")
    n_li = li.count()
    paged = li.withColumn("p", F.expr("l_orderkey div 1000"))
    last_page = paged.agg(F.max("p")).first()[0]
    rt = F.when(F.first("p") < F.lit(last_page), F.lit("[[1]]"))
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    pages = encode_table(paged, ["p"], order, LINEITEM_FIELDS, rt=rt)
    # A landing zone holds many page files; land round-robin into 4 x cpus files.
    n_files = 4 * int(cpus)
    responses_of(pages, "lineitem", "lineitem", F.col("p") + 1).repartition(n_files).write.parquet(f"{base}/lineitem_pages")
    single = {}
    for n in (5000, 30000, 100000):
        if n > n_li:
            continue
        one = li.orderBy(*order).limit(n).withColumn("p", F.lit(0))
        encode_table(one, ["p"], order, LINEITEM_FIELDS).select(
            F.lit("one").alias("report_key"), F.lit(f"page{n}").alias("module"), F.lit(1).alias("page_no"),
            F.lit(200).alias("status"), "body").write.parquet(f"{base}/page_{n}")
        single[n] = f"{base}/page_{n}"
    _event_captures(table(spark, sf_dir, "events")).repartition(n_files).write.parquet(f"{base}/captures")
    n_caps = spark.read.parquet(f"{base}/captures").count()

    resp = spark.read.parquet(f"{base}/lineitem_pages")
    queries = {}

    # warm-up (JIT, first-job overhead)
    noop(decode_lineitem(spark.read.parquet(single.get(5000, f"{base}/lineitem_pages"))))

    queries["decode_lineitem"] = timed(lambda: noop(decode_lineitem(resp)))
    for n, path in single.items():
        queries[f"decode_page_{n // 1000}k"] = timed(lambda p=path: noop(decode_lineitem(spark.read.parquet(p))))

    def assemble_all():
        ex = extract(resp)
        noop(ex.table("lineitem", "lineitem"))
        noop(ex.status())

    queries["assemble_lineitem"] = timed(assemble_all)

    caps = spark.read.parquet(f"{base}/captures")

    def discover_all():
        found = discover(caps)
        noop(found["modules"])
        noop(found["report_config"])

    queries["discover_events"] = timed(discover_all)

    total = round(sum(queries.values()), 3)
    out = {
        "metric": "total_sec",
        "value": total,
        "unit": "sec",
        "queries": queries,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "rows_per_sec": {
            "decode_lineitem": round(n_li / queries["decode_lineitem"]),
            "assemble_lineitem": round(n_li / queries["assemble_lineitem"]),
            **{f"decode_page_{n // 1000}k": round(n / queries[f"decode_page_{n // 1000}k"]) for n in single},
            "discover_events_captures": round(n_caps / queries["discover_events"]),
        },
        "cpus": int(cpus),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
