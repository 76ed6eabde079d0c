"""S1 with state: pages are assembled as they land, each page read once.

``Assembly`` keeps, below one folder, what the page rules need to know of a module:

* ``progress``: the next page it waits for, the last row and the restart tokens of the
  page before, rows and pages kept, and why it stopped;
* ``columns``: every column seen, where first, and the types of its values (E8);
* ``pending``: pages that cannot be used yet (an earlier page is missing, or the page
  itself came with an error and may land again);
* ``rows``: the kept rows of each batch (E1/E2);
* ``commits``: one row per batch, written last; a batch counts once it is there.

``advance`` takes one batch of decoded pages.  It reads that batch, the pending pages
and the small tables, never the rows of earlier batches.  Every table is a folder per
batch, overwritten when the batch is tried again, so a retry after a lost driver or
executor neither loses nor doubles pages.  Small tables hold the modules a batch has
touched; every ``COMPACT`` batches all of them are written, and reading starts there.

The result is that of ``plans.extract`` over all landings, for any split and order of
them, with one difference: a page that has been used stays, also if it lands again
(``extract`` then takes the landing with most rows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions.ranking import group_row_number
from reportlake.operators.assemble import MODULE_KEYS, merged_type, status_of, stop_after, stop_before
from reportlake.operators.decode import PAGE_KEYS
from reportlake.plans.extract import ModuleTables, one_landing
from reportlake.session import stage

#: Every so many batches the small tables are written whole.
COMPACT = 32

_KEYS = list(MODULE_KEYS)
_M = "report_key string, module string"
PROGRESS = (f"{_M}, next_page int, last_key string, restart_tokens string, done boolean, failed boolean, stop_reason string, "
            "n_rows bigint, n_pages int")
COLUMNS = f"{_M}, col string, first_seen struct<page_no:int,k:int>, types array<string>"
ROWS = f"{_M}, page_no int, pos int, row_json string"
STAGED = (f"{_M}, page_no int, status int, bad_json boolean, envelope_ok boolean, restart_tokens string, has_tokens boolean, n_entries int, "
          "bad_pos int, bad_reason string, n_rows int, first_key string, last_key string, "
          "col_types array<struct<col:string,k:int,types:array<string>>>, rows_json array<string>")
COMMITS = "new_pages bigint, pending_pages bigint, used_pages bigint"


@dataclass
class Assembled(ModuleTables):
    """What ``Assembly.result`` gives; ``table`` and ``columns`` as of an ``Extraction``."""

    progress: DataFrame    # per module: next_page, restart_tokens, stop_reason, done, failed, counts

    def status(self, expected: DataFrame | None = None) -> DataFrame:
        return status_of(self.progress, expected)


class Assembly:
    """Incremental page assembly below ``root`` (a shared folder); see the module's text."""

    def __init__(self, spark: SparkSession, root: str, paginated: DataFrame | None = None, compact: int = COMPACT):
        """``paginated``: (report_key, module, paginated); modules that are not in it are paginated."""
        self.spark, self.root, self.paginated, self.compact = spark, root.rstrip("/"), paginated, compact

    # --- tables ---------------------------------------------------------------------------

    def _folder(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/v={batch}"

    def _read(self, table: str, schema: str) -> DataFrame:
        """All batches of a table, with their number ``v``; no rows where there is none yet."""
        full = f"{schema}, v bigint"
        try:
            return self.spark.read.schema(full).parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

    def _write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(table, batch))

    def _last(self, table: str, schema: str, before: int | None) -> int | None:
        found = self._read(table, schema).select("v")
        return (found if before is None else found.where(F.col("v") < before)).agg(F.max("v")).first()[0]

    def _latest(self, table: str, schema: str, keys: list[str], upto: int | None) -> DataFrame:
        """The latest row of each key, of the last whole copy and the batches after it."""
        names = [f.split()[0] for f in schema.split(", ")]
        if upto is None:
            return self.spark.createDataFrame([], schema)
        base = self._last(f"{table}_whole", schema, upto + 1)
        rows = self._read(table, schema).where(F.col("v") <= upto)
        if base is not None:
            rows = rows.where(F.col("v") > base).unionByName(self._read(f"{table}_whole", schema).where(F.col("v") == base))
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*[n for n in names if n not in keys]), "v").alias("r"))
        return newest.select(*keys, "r.*")

    # --- one batch ------------------------------------------------------------------------

    def advance(self, staged: DataFrame, batch: int) -> None:
        """Use the pages of a batch (staged form, see ``decode.stage_pages``).

        Batches are numbered upwards, gaps are fine; a batch that was committed before is
        done again only if it is the last one (a retry gives the same tables).
        """
        fields = self.spark.createDataFrame([], STAGED).schema
        names = fields.names
        if "status" not in staged.columns:
            staged = staged.withColumn("status", F.lit(200))
        last = self._last("commits", COMMITS, batch)
        progress = stage(self._latest("progress", PROGRESS, _KEYS, last), "progress")
        waiting = self._read("pending", STAGED).where(F.col("v") == F.lit(-1 if last is None else last)).drop("v")
        new = staged.select(*[F.col(f.name).cast(f.dataType) for f in fields])
        pages = stage(one_landing(new.unionByName(waiting)), "arrived")

        known = progress.select(*_KEYS, "next_page", F.col("last_key").alias("state_key"), "done")
        open_ = pages.join(known, _KEYS, "left").where("NOT coalesce(done, false) AND page_no >= coalesce(next_page, 1)")
        open_ = open_.withColumn("next_page", F.coalesce("next_page", F.lit(1)))
        facts = open_.select(*PAGE_KEYS, "next_page", "state_key", "status", "n_rows", "has_tokens", "bad_json", "first_key", "last_key", "restart_tokens")
        if self.paginated is not None:
            facts = facts.join(self.paginated.select(*_KEYS, "paginated"), _KEYS, "left")
            facts = facts.withColumn("paginated", F.coalesce("paginated", F.lit(True)))
        else:
            facts = facts.withColumn("paginated", F.lit(True))
        # Page numbers of a module are distinct, so those that follow on without a gap are told by their rank.
        ranked = stage(group_row_number(facts, _KEYS, "page_no", "rn"), "ranked")
        run = ranked.where(F.col("page_no") == F.col("next_page") + F.col("rn") - 1)
        before, after = stop_before(), stop_after()
        event = F.when(before.isNotNull(), F.struct("page_no", F.lit(0).alias("prio"), before.alias("reason"))).when(
            after.isNotNull(), F.struct("page_no", F.lit(1).alias("prio"), after.alias("reason")))
        stops = run.groupBy(*_KEYS).agg(F.min(event).alias("ev"), F.max("page_no").alias("end"))
        stops = stops.select(*_KEYS, F.coalesce(F.when(F.col("ev.prio") == 0, F.col("ev.page_no") - 1).otherwise(F.col("ev.page_no")),
                                                F.col("end")).alias("upto"),
                             F.coalesce(F.col("ev.prio") == 1, F.lit(False)).alias("done"), F.col("ev.reason").alias("reason"))
        stops = stage(stops, "stops")
        used = run.join(stops.select(*_KEYS, "upto"), _KEYS).where("page_no <= upto")
        previous = used.select(*_KEYS, (F.col("page_no") + 1).alias("page_no"), F.col("last_key").alias("prev_key"))
        used = used.join(previous, list(PAGE_KEYS), "left").withColumn("prev_key", F.coalesce("prev_key", "state_key"))
        drop = F.coalesce((F.col("page_no") > 1) & (F.col("first_key") == F.col("prev_key")), F.lit(False))
        used = stage(used.withColumn("drop_first", drop), "used")

        own = pages.join(used.select(*PAGE_KEYS, "drop_first"), list(PAGE_KEYS))
        rows = own.select(*PAGE_KEYS, "drop_first", F.posexplode_outer("rows_json").alias("pos", "row_json"))
        rows = rows.where(F.col("row_json").isNotNull() & ~(F.col("drop_first") & (F.col("pos") == 0))).drop("drop_first")
        self._write(rows.sortWithinPartitions(*PAGE_KEYS), "rows", batch)

        fresh = own.select(*PAGE_KEYS, F.explode_outer("col_types").alias("ct")).where("ct IS NOT NULL")
        fresh = fresh.select(*_KEYS, "ct.col", F.struct("page_no", F.col("ct.k").alias("k")).alias("first_seen"), "ct.types")
        column_keys = [*_KEYS, "col"]
        seen = self._latest("columns", COLUMNS, column_keys, last)
        touched = fresh.select(*column_keys).distinct()
        both = fresh.unionByName(seen.join(touched, column_keys, "left_semi"))
        columns = both.groupBy(*column_keys).agg(F.min("first_seen").alias("first_seen"), F.array_distinct(F.flatten(F.collect_set("types"))).alias("types"))
        self._write(columns, "columns", batch)

        self._write(self._moved(progress, ranked, used, stops), "progress", batch)
        ended = stops.where("done").select(*_KEYS)
        rest = open_.join(used.select(*PAGE_KEYS), list(PAGE_KEYS), "left_anti").join(ended, _KEYS, "left_anti")
        self._write(rest.select(*names), "pending", batch)
        if batch % self.compact == self.compact - 1:
            self._write(self._latest("progress", PROGRESS, _KEYS, batch), "progress_whole", batch)
            self._write(self._latest("columns", COLUMNS, column_keys, batch), "columns_whole", batch)
        counts = new.agg(F.count(F.lit(1)).alias("new_pages")).join(waiting.agg(F.count(F.lit(1)).alias("pending_pages")))
        self._write(counts.join(used.agg(F.count(F.lit(1)).alias("used_pages"))), "commits", batch)

    @staticmethod
    def _moved(progress: DataFrame, ranked: DataFrame, used: DataFrame, stops: DataFrame) -> DataFrame:
        """The new progress of the modules that had open pages in the batch."""
        gained = used.groupBy(*_KEYS).agg(
            F.max("page_no").alias("u_page"), F.max_by(F.struct("last_key", "restart_tokens"), "page_no").alias("u"),
            F.sum(F.col("n_rows") - F.col("drop_first").cast("int")).alias("u_rows"), F.count(F.lit(1)).cast("int").alias("u_pages"))
        touched = ranked.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("open_pages")).drop("open_pages")
        old = progress.withColumnsRenamed({c: f"old_{c}" for c in progress.columns if c not in _KEYS})
        s = touched.join(old, _KEYS, "left").join(gained, _KEYS, "left").join(stops.drop("upto"), _KEYS, "left")
        moved = F.col("u_page").isNotNull()
        next_page = F.coalesce(F.col("u_page") + 1, "old_next_page", F.lit(1))
        waits = F.when(next_page == 1, F.lit("missing_first_page")).otherwise(F.lit("landing_end"))
        reason = F.coalesce("reason", waits)
        return s.select(
            *_KEYS, next_page.cast("int").alias("next_page"),
            F.when(moved, F.col("u.last_key")).otherwise(F.col("old_last_key")).alias("last_key"),
            F.when(moved, F.col("u.restart_tokens")).otherwise(F.col("old_restart_tokens")).alias("restart_tokens"),
            F.coalesce("done", F.lit(False)).alias("done"),
            reason.isin("auth_failed", "bad_json").alias("failed"), reason.alias("stop_reason"),
            (F.coalesce("old_n_rows", F.lit(0)) + F.coalesce("u_rows", F.lit(0))).cast("bigint").alias("n_rows"),
            (F.coalesce("old_n_pages", F.lit(0)) + F.coalesce("u_pages", F.lit(0))).cast("int").alias("n_pages"))

    # --- what has been assembled ------------------------------------------------------------

    def commits(self) -> DataFrame:
        """(v, new_pages, pending_pages, used_pages) of each batch: the pages it has read and used."""
        return self._read("commits", COMMITS)

    def result(self) -> Assembled:
        """Rows, columns and progress of all committed batches; a failed module keeps nothing."""
        last = self._last("commits", COMMITS, None)
        progress = self._latest("progress", PROGRESS, _KEYS, last)
        failed = progress.where("failed").select(*_KEYS)
        rows = self._read("rows", ROWS).where(F.col("v") <= F.lit(-1 if last is None else last)).drop("v").join(failed, _KEYS, "left_anti")
        columns = self._latest("columns", COLUMNS, [*_KEYS, "col"], last).join(failed, _KEYS, "left_anti")
        schema = columns.select(*_KEYS, "col", "first_seen", F.col("types").alias("variant_types"), merged_type("types").alias("spark_type"))
        return Assembled(schema=schema, rows=rows, progress=progress)
