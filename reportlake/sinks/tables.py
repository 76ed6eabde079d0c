"""Sinks: module CSVs (B1), catalogs (B2), per-report folders (B3).  Source A4."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.functions.ranking import group_row_number
from reportlake.functions.sqlx import quoted
from reportlake.session import exact_case, scratch_dir, stage, task_count
from reportlake.sinks.files import local_path, module_files
from reportlake.sources.urls import resource_key


#: Options of every module CSV: text is kept as it is, blanks at its ends too.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def csv_line(values: list[Column]) -> Column:
    """A row as the line that a module CSV has for it (null: none, as for a single missing value)."""
    line = F.to_csv(F.struct(*values), {k: str(v) for k, v in CSV_OPTIONS.items() if k != "header"})
    return line if len(values) > 1 else F.when(values[0].isNotNull(), line)


def write_module_csv(table: DataFrame, path: str, order_cols: tuple[str, ...] = ("page_no", "pos")) -> bool:
    """B1: write one module's table as CSV (header, null -> empty, true/false).

    Nothing is written for an empty table (returns False).  Rows keep their
    (page_no, pos) order through a range-partitioned sort, so the part files
    read back in order; the order columns themselves are not written.
    """
    if table.isEmpty():
        return False
    cols = [c for c in table.columns if c not in order_cols]
    ordered = table.orderBy(*[c for c in order_cols if c in table.columns]) if any(c in table.columns for c in order_cols) else table
    (
        ordered.select(*cols)
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .csv(path)
    )
    return True


CONFIG_SCHEMA = T.StructType([
    T.StructField("report_key", T.StringType()),
    T.StructField("dataset_id", T.StringType()),
    T.StructField("report_id", T.StringType()),
    T.StructField("visual_id", T.StringType()),
    T.StructField("resource_key", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("model_id", T.LongType()),
    T.StructField("extra_headers", T.MapType(T.StringType(), T.StringType())),
])

MODULE_SCHEMA = T.StructType([
    T.StructField("report_key", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("from_entities", T.MapType(T.StringType(), T.StringType())),
    T.StructField("select_columns", T.ArrayType(T.StructType([
        T.StructField("alias", T.StringType()),
        T.StructField("prop", T.StringType()),
        T.StructField("is_measure", T.BooleanType()),
    ]))),
    T.StructField("query_template", T.StringType()),
    T.StructField("shape_key", T.StringType()),
    T.StructField("paginated", T.BooleanType()),
    T.StructField("output_filename", T.StringType()),
])


def save_catalog(config: DataFrame, modules: DataFrame, path: str, redact: bool = False) -> None:
    """B2: write report configs and modules as JSON under ``path``.

    ``redact=True`` blanks the resource key (a credential, deviation V11).
    """
    cfg = config.select(*[F.col(f.name).cast(f.dataType) for f in CONFIG_SCHEMA.fields if f.name in config.columns])
    if redact and "resource_key" in cfg.columns:
        cfg = cfg.withColumn("resource_key", F.lit(""))
    mods = modules.select(*[F.col(f.name).cast(f.dataType) for f in MODULE_SCHEMA.fields if f.name in modules.columns])
    cfg.write.mode("overwrite").json(f"{path}/config")
    mods.write.mode("overwrite").json(f"{path}/modules")


def load_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A4: read a saved catalog back with explicit schemas (no inference)."""
    cfg = spark.read.schema(CONFIG_SCHEMA).json(f"{path}/config")
    mods = spark.read.schema(MODULE_SCHEMA).json(f"{path}/modules")
    return cfg, mods


def report_dirs(urls: DataFrame, order_col: str = "url_index", base: str | Column | None = None) -> DataFrame:
    """Folder name per report URL: its resource key, else ``report_{i}``.

    ``i`` is the 1-based position of the URL in the list (``order_col``,
    unique and integral); the rank is the bucketed global rank, so no single
    task sees the whole list.  Two URLs with the same key keep their own rows
    (the URL stays a column).
    """
    ranked = group_row_number(urls, [], order_col, "_i")
    key, reason = resource_key(F.col("url"))
    out = ranked.select(
        "*",
        key.alias("resource_key"),
        reason.alias("key_error"),
    ).withColumn(
        "report_dir", F.coalesce(F.col("resource_key"), F.concat(F.lit("report_"), F.col("_i").cast("string")))
    ).drop("_i")
    if base is not None:
        b = F.lit(base) if isinstance(base, str) else base
        out = out.withColumn("report_path", F.concat_ws("/", b, F.col("report_dir")))
    return out


def write_rows_by_report(rows: DataFrame, dirs: DataFrame, path: str) -> None:
    """B3 long form: every kept row of every module in one write job.

    ``rows``: (report_key, module, page_no, pos, row_json) as produced by
    ``plans.extract``; ``dirs``: (report_key, report_dir).  Output is JSON lines
    under ``path/__report_dir=.../__report=.../__module=...``, each with its report key and module
    (``__report`` is a hash of the key): reports that share a folder name stay apart.
    Only the folders of the reports written are replaced; no loop over modules.
    """
    out = rows.join(dirs.select("report_key", "report_dir").dropDuplicates(["report_key"]), "report_key", "left")
    named = out.select(
        safe_name(F.coalesce("report_dir", "report_key")).alias("__report_dir"), F.substring(F.md5("report_key"), 1, 16).alias("__report"),
        safe_name(F.col("module")).alias("__module"), "report_key", "module", "page_no", "pos", "row_json")
    (
        named.repartition("report_key", "module", "page_no")
        .sortWithinPartitions("__report_dir", "__report", "__module", "page_no", "pos")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("__report_dir", "__report", "__module")
        .json(path)
    )


def safe_name(name: Column) -> Column:
    """A folder name for any text: itself if it is plain, else its plain characters and a hash."""
    plain = F.regexp_replace(name, "[^A-Za-z0-9_.-]", "_")
    return F.when(name.rlike("^[A-Za-z0-9_-][A-Za-z0-9_.-]{0,99}$"), name).otherwise(
        F.concat(F.substring(plain, 1, 60), F.lit("-"), F.substring(F.md5(name), 1, 12)))


def _is_there(spark: SparkSession, path: str) -> bool:
    """Does the folder exist."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def write_module_csvs(extraction, dirs: DataFrame | None, base: str) -> DataFrame:
    """B1 + B3: every non-empty module as CSV under ``base/__report_dir=.../__report=.../__module=...``.

    ``report`` is a hash of the report key, so reports that share a folder name keep
    files of their own; folder and module names that a path cannot hold are made
    safe (``safe_name``).  Modules with the same typed column list are written by
    one job.  The rows are first staged by column list, so each job reads only its
    own files however many there are; only the column lists reach the driver.
    Rows are range-partitioned by (report, module, page_no, pos) and sorted inside
    files, so part files read back in row order and a large module is spread over
    many tasks, however few its bytes, as making the folders takes longest.  In a folder of the file system that all
    machines mount the tasks write the files themselves (``sinks.files``); elsewhere Spark's writer does.
    Columns that differ only in case, or are named like a key, are written as they are.  A column list that cannot be written makes its modules
    ``failed`` with the reason and leaves the others alone.  Returns the module
    status table with each written module's ``output_path``.
    """
    status = extraction.status()
    spark = status.sparkSession
    nonempty = status.where(F.col("n_rows") > 0).select("report_key", "module")
    columns = F.expr("transform(array_sort(collect_list(struct(first_seen, col, spark_type))), c -> struct(c.col, c.spark_type))")
    sigs = (
        extraction.schema.join(nonempty, ["report_key", "module"], "inner")
        .groupBy("report_key", "module")
        .agg(F.to_json(columns).alias("sig"))
        .withColumn("sig_id", F.substring(F.md5("sig"), 1, 16))
    )
    if dirs is not None:
        folder = dirs.select("report_key", "report_dir").dropDuplicates(["report_key"])
        sigs = sigs.join(folder, "report_key", "left").withColumn("report_dir", F.coalesce("report_dir", "report_key"))
    else:
        sigs = sigs.withColumn("report_dir", F.col("report_key"))
    sigs = sigs.select(
        "report_key", "module", "sig", "sig_id", safe_name(F.col("report_dir")).alias("__report_dir"),
        F.substring(F.md5("report_key"), 1, 16).alias("__report"), safe_name(F.col("module")).alias("__module"))
    # one small row per module, read once per signature below: written once
    sigs = stage(sigs, "csv-signatures")
    keys = ["__report_dir", "__report", "__module"]
    # the rows, once, in a folder per column list
    by_sig = scratch_dir(spark, "csv-rows")
    (
        extraction.rows.join(sigs.select("report_key", "module", "sig_id", *keys), ["report_key", "module"])
        .select("sig_id", *keys, "page_no", "pos", "row_json")
        .write.partitionBy("sig_id").parquet(by_sig)
    )
    # Each job replaces only the module folders it writes (re-runs are idempotent); where there is nothing to replace
    # the files are only added.
    mode = "overwrite" if _is_there(spark, base) else "append"
    folder = local_path(spark, base)
    if folder is not None:
        spark.dataSource.register(module_files())
    failed = []
    for r in sigs.select("sig_id", "sig").distinct().collect():
        cols = [(c["col"], c["spark_type"]) for c in json.loads(r.sig)]
        try:
            with exact_case(spark):
                ddl = ", ".join(f"{quoted(c)} {t}" for c, t in cols)
                rows = spark.read.parquet(f"{by_sig}/sig_id={r.sig_id}")
                typed = rows.select(*keys, F.col("page_no").alias("__page"), F.col("pos").alias("__pos"), F.from_json("row_json", ddl).alias("__t"))
                values = [F.col("__t").getField(c).alias(c) for c, _ in cols]
                if folder is not None:
                    values = [csv_line(values).alias("__line")]
                sorted_rows = (
                    typed.select(*keys, "__page", "__pos", *values)
                    .repartitionByRange(task_count(spark), *keys, "__page", "__pos")
                    .sortWithinPartitions(*keys, "__page", "__pos")
                    .drop("__page", "__pos")
                )
                if folder is not None:
                    names = spark.range(1).select(csv_line([F.lit(c).alias(c) for c, _ in cols])).first()[0]
                    (
                        sorted_rows.write.format("reportlake_module_files").mode(mode)
                        .options(folder=folder, header=names, job=uuid.uuid4().hex)
                        .save()
                    )
                else:
                    (
                        sorted_rows.write.mode(mode)
                        .option("partitionOverwriteMode", "dynamic")
                        .partitionBy(*keys)
                        .options(**CSV_OPTIONS)
                        .csv(base)
                    )
        except (PySparkException, Py4JJavaError) as e:
            failed.append((r.sig_id, f"write_failed: {str(e).splitlines()[0][:300]}"))
    errors = spark.createDataFrame(failed, "sig_id string, error string")
    paths = sigs.join(F.broadcast(errors), "sig_id", "left").select(
        "report_key", "module", "error",
        F.when(F.col("error").isNull(), F.concat_ws(
            "/", F.lit(base.rstrip("/")), *[F.concat(F.lit(f"{k}="), F.col(k)) for k in keys])).alias("output_path"),
    )
    out = status.join(paths, ["report_key", "module"], "left")
    return out.withColumns({
        "status": F.when(F.col("error").isNotNull(), F.lit("failed")).otherwise(F.col("status")),
        "detail": F.coalesce("error", "detail"),
    }).drop("error")
