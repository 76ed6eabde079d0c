"""Registered queries on made tables, where their work shows that the driver's tables hold little of."""

import glob
import os

import duckdb
import pytest
from conftest import wrap
from pyspark.sql import functions as F

from reportlake.functions.protocol import PAGE_SIZE
from reportlake.plans.checks import CHECKS, SQL
from reportlake.plans.extract import extract
from reportlake.sinks import tables
from reportlake.sinks.files import module_files


def by_sql(name, **tables):
    """The rows of a query's SQL over Parquet folders."""
    con = duckdb.connect()
    for t, path in tables.items():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'")
    return con.execute(SQL[name])


def test_repeat_carry_over_all_events_of_a_user(spark, tmp_path):
    """A carry goes on however far apart a user's events are, and ends with a full page."""
    far = spark.range(200).select((F.col("id") * 1001).alias("event_id"), (F.col("id") % 2).alias("user_id"))
    full = spark.range(PAGE_SIZE + 2).select((F.col("id") * 3 + 1 - F.when(F.col("id") == 0, 1).otherwise(0)).alias("event_id"), F.lit(7).cast("long").alias("user_id"))
    lost = spark.range(5).select((F.col("id") + 10**9).alias("event_id"), F.lit(None).cast("long").alias("user_id"))
    ev = far.unionByName(full).unionByName(lost).withColumn("event_type", F.concat(F.lit("type "), (F.col("event_id") % 6).cast("string")))
    path = str(tmp_path / "events.parquet")
    ev.write.parquet(path)
    got = sorted(map(tuple, CHECKS["Q_repeat_carry"](spark, str(tmp_path)).select("event_id", "user_id", "event_type").collect()), key=str)
    assert got == sorted(by_sql("Q_repeat_carry", events=path).fetchall(), key=str)
    assert sum(r[2] is not None for r in got if r[1] in (0, 1) and r[0] % 3 != 0) > 100
    first = sorted((r for r in got if r[1] == 7), key=lambda r: r[0])
    assert [r[2] for r in first[:PAGE_SIZE]] == ["type 0"] * PAGE_SIZE and [r[2] for r in first[PAGE_SIZE:]] == [None, None]


def lines(folder):
    """The text of every part file by its module folder, parts one after the other."""
    found = {}
    for path in sorted(glob.glob(f"{folder}/*/*/*/part-*.csv")):
        with open(path, newline="", encoding="utf-8") as f:
            found.setdefault(os.path.dirname(path)[len(folder):], []).append(f.read())
    return found


def test_module_files_are_those_of_the_csv_writer(spark, tmp_path, monkeypatch):
    """Odd texts, empty and missing values and odd names are written as Spark's CSV writer writes them."""
    texts = ["", None, " a ", 'say "x"', "a,b", "two\nlines", "cr\rlf\r\n", "#1", "\\", "\\\"", "\t", "Ø 漢 \U0001f600", "null", '"']
    select = [{"Value": f"G{i}", "Name": n} for i, n in enumerate(["T.a b", 'T.q"x', "T.c,d", "T. e ", "T.#f"])]
    several = {"PH": [{"DM0": [{"S": [{"N": f"G{i}"} for i in range(5)], "C": [t, 1, 2.5, True, t]} if k == 0 else {"C": [t, 10**20 + k, -k / 3, False, t]} for k, t in enumerate(texts)]}]}
    single = {"PH": [{"DM0": [{"S": [{"N": "G0"}], "C": [t]} if k == 0 else {"C": [t]} for k, t in enumerate(texts)]}]}
    rows = [("r", m, 1, 200, wrap(ds, select)) for m, ds in (("several", several), ("one", single), ("a/b c", single))]
    resp = spark.createDataFrame(rows, "report_key string, module string, page_no int, status int, body string")
    ex = extract(resp)
    fast, plain = str(tmp_path / "fast"), str(tmp_path / "plain")
    tables.write_module_csvs(ex, None, fast)
    assert glob.glob(f"{fast}/*/*/*/part-*.csv") and not glob.glob(f"{fast}/*/*/*/.*")  # no file of Hadoop's, no hidden one
    monkeypatch.setattr(tables, "local_path", lambda spark, base: None)
    tables.write_module_csvs(ex, None, plain)
    assert glob.glob(f"{plain}/*/*/*/.*.crc")
    def whole(found):
        return {k: [t.split("\n", 1)[0] for t in v][0] + "".join(t.split("\n", 1)[1] for t in v) for k, v in found.items()}

    assert len(lines(plain)) == 3 and whole(lines(fast)) == whole(lines(plain))


def test_a_failed_write_of_module_files_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(module_files())
    base = str(tmp_path / "out")

    def write(n, mode, job):
        line = F.when(F.col("id") < n, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("no more")))
        rows = spark.range(40).repartitionByRange(8, "id").select(F.lit("r").alias("__report_dir"), F.lit("h").alias("__report"),
                                                                  F.concat(F.lit("m"), (F.col("id") / 4).cast("int").cast("string")).alias("__module"), line.alias("__line"))
        rows.sortWithinPartitions("__module").write.format("reportlake_module_files").mode(mode).options(folder=base, header="id", job=job).save()

    with pytest.raises(Exception, match="no more"):
        write(30, "append", "one")
    assert not [p for p in glob.glob(f"{base}/**", recursive=True, include_hidden=True) if os.path.isfile(p)]
    write(40, "append", "two")
    assert sum(sum(t.count("\n") - 1 for t in v) for v in lines(base).values()) == 40
    before = lines(base)
    with pytest.raises(Exception, match="no more"):
        write(30, "overwrite", "three")
    assert lines(base) == before
    write(40, "overwrite", "four")
    assert lines(base) == before and not [p for p in glob.glob(f"{base}/*/*/*/*") if "-two" in p] and "_temporary-four" not in os.listdir(base)
    assert not glob.glob(f"{base}/**/.*", recursive=True)
