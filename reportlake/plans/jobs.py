"""End-to-end jobs: the capture-to-tables flows as single calls.

``discover_har``   HAR files -> report configs + modules (+ rejects, statuses);
                   one report per HAR file, keyed by the file path.
``run_extraction`` landed responses -> selected modules -> typed CSVs per
                   report folder + module statuses + exit code.
``run_bulk``       texts with report URLs + captures (+ responses) -> folders (B3),
                   modules, tables, per-report status and summary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions.protocol import QUERY_PATH, RESOURCE_KEY_HEADER, VIEW_URL_PREFIX
from reportlake.operators.discover import discover
from reportlake.operators.runs import bulk_summary, exit_code, report_status, run_summary, select_modules
from reportlake.plans.extract import Extraction, extract
from reportlake.sinks.tables import report_dirs, write_module_csvs
from reportlake.session import stage
from reportlake.sources.captures import filter_captures, har_entries, har_reports, header_value, read_har_texts
from reportlake.sources.urls import extract_view_urls, numbered_urls


def discover_har(spark: SparkSession, path: str, path_marker: str = QUERY_PATH,
                 key_header: str = RESOURCE_KEY_HEADER, multiline: bool = True) -> dict[str, DataFrame]:
    """A1 + C1 + C18 for HAR files: each file is one report (``report_key`` = file path).

    Returns the discovery tables plus ``capture_rejects`` (entries that are not
    query captures, with the reason; an unreadable file is one row without position).
    Every file is a row of ``report_discovery``, also if it is unreadable or has no capture.
    """
    texts = read_har_texts(spark, path, multiline=multiline)
    caps, rejects = filter_captures(har_entries(texts), path_marker)
    files = stage(har_reports(texts).withColumnRenamed("source", "report_key"), "har-files")
    found = discover(caps.withColumnRenamed("source", "report_key"), key_header, reports=files)
    unread = files.where("problem IS NOT NULL").withColumnRenamed("problem", "reject")
    found["capture_rejects"] = rejects.withColumnRenamed("source", "report_key").unionByName(unread, allowMissingColumns=True)
    return found


@dataclass
class RunResult:
    extraction: Extraction
    status: DataFrame      # per module, in module order: status, n_rows, n_pages, detail, output_path
    summary: DataFrame     # per report: n_modules, n_failed, all_failed
    exit_code: int         # non-zero only if every selected module failed (or none ran)


def run_extraction(
    responses: DataFrame,
    modules: DataFrame,
    out_dir: str,
    requested: DataFrame | None = None,
    dirs: DataFrame | None = None,
) -> RunResult:
    """C17 + E1-E9 + B1/B3 + F1/F2/F5 over all reports and modules at once.

    ``modules``: the discovery ``modules`` table (gives ``paginated``);
    ``requested``: optional (report_key, req_pos, name) selection -- unknown
    names raise, as the command line does; ``dirs``: optional
    (report_key, report_dir) folder names.
    """
    chosen = modules
    if requested is not None:
        chosen, _ = select_modules(modules, requested)
        order = F.col("req_pos")
    else:
        order = F.col("pos")
    # results in module order (request order when a selection is given)
    chosen = (
        chosen.groupBy("report_key", F.col("name").alias("module"))
        .agg(F.min(order).alias("module_order"), F.first("paginated").alias("paginated"))
    )
    # four steps read it: naming the modules is not done again for each
    chosen = stage(chosen, "modules-chosen")
    resp = responses.join(chosen.select("report_key", "module"), ["report_key", "module"], "left_semi")
    ex = extract(resp, chosen)
    status = write_module_csvs(ex, dirs, out_dir)
    expected = chosen.select("report_key", "module", "module_order")
    full = stage(
        expected.join(status, ["report_key", "module"], "left")
        .fillna({"status": "empty", "n_rows": 0, "n_pages": 0, "detail": "no_pages"}),
        "module-status",
    ).orderBy("report_key", "module_order")
    # zero selected modules count as "all failed" (all([]) is true)
    some_ok = not full.where(F.col("status") != "failed").isEmpty()
    return RunResult(ex, full, run_summary(full), 0 if some_ok else 1)


@dataclass
class BulkResult:
    folders: DataFrame         # url, url_index, resource_key, key_error, report_dir
    discovery: dict            # the tables of ``operators.discover``; report_key is the URL
    unlinked: DataFrame        # captures whose key is that of no URL
    run: RunResult | None      # the extraction of the responses, if there are any
    report_status: DataFrame   # url, status, n_modules, detail (and n_modules_ok)
    summary: DataFrame         # status, n
    exit_code: int             # non-zero when no report is ok


def link_captures(folders: DataFrame, captures: DataFrame, key_header: str = RESOURCE_KEY_HEADER) -> tuple[DataFrame, DataFrame]:
    """captures of the reports that a list of URLs names: (linked, unlinked).

    A capture belongs to every URL whose decoded key (C5) its key header (C2/C3) carries;
    ``linked`` has ``report_key`` = the URL.  A capture without the header, or of another report, is
    unlinked.  ``captures``: (pos, url, headers, body), pos unique among all.
    """
    keyed = captures.withColumn("__key", header_value("headers", key_header))
    known = folders.where("resource_key IS NOT NULL").select(F.col("url").alias("__report"), F.col("resource_key").alias("__key"))
    linked = keyed.join(known, "__key").select(F.col("__report").alias("report_key"), "pos", "url", "headers", "body")
    unlinked = keyed.join(known.select("__key").distinct(), "__key", "left_anti").drop("__key")
    return linked, unlinked


def run_bulk(texts: DataFrame, captures: DataFrame, responses: DataFrame | None = None, out_dir: str | None = None,
             prefix: str = VIEW_URL_PREFIX, key_header: str = RESOURCE_KEY_HEADER) -> BulkResult:
    """from texts that hold report URLs to a status per report.

    ``texts`` (source, text) are searched for URLs (C4); each gets a folder (B3) and the captures
    with its key, which are discovered (C6-C12).  With ``responses`` (report_key = URL, module, page_no, status,
    body) and ``out_dir`` the modules are extracted into the folders.  A URL whose key
    cannot be decoded, or without captures, is ``failed`` with the reason; one report's
    failure leaves the others alone.
    """
    # ranks read their input several times, so each step of the list is written once
    urls = stage(extract_view_urls(texts, prefix), "bulk-urls")
    folders = stage(report_dirs(stage(numbered_urls(urls), "bulk-numbered")), "bulk-folders")
    linked, unlinked = link_captures(folders, captures, key_header)
    reports = folders.select(F.col("url").alias("report_key"), F.col("key_error").alias("problem"))
    found = discover(linked, key_header, reports=reports)
    found["report_discovery"] = stage(found["report_discovery"], "bulk-discovery")
    run = None
    if responses is not None:
        dirs = folders.select(F.col("url").alias("report_key"), "report_dir")
        usable = found["report_discovery"].where("status = 'ok'").select("report_key")
        run = run_extraction(responses, found["modules"].join(usable, "report_key", "left_semi"), out_dir, dirs=dirs)
    links = folders.select("url", F.col("url").alias("report_key"))
    st = stage(report_status(links, found["report_discovery"], run.status if run else None).drop("report_key"), "bulk-status")
    return BulkResult(folders, found, unlinked, run, st, bulk_summary(st), exit_code(st))
