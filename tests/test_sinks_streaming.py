"""CSV sink (B1, B3, F1) and incremental decode."""

import glob

from conftest import depot_page, page, responses, wrap
from pyspark.sql import functions as F

from reportlake.plans.extract import extract, staged_rows
from reportlake.session import scratch_dir
from reportlake.sinks.tables import write_module_csv, write_module_csvs, write_rows_by_report
from reportlake.streaming.incremental import start_incremental_decode

MORE = [[2, "'z'"]]


def body_of(name, values, rt=None):
    return wrap(page([{"S": [{"N": "G0"}], "C": [values[0]]}, *({"C": [v]} for v in values[1:])], rt=rt), [{"Value": "G0", "Name": f"Depot.{name}"}])


def read_csv(spark, path):
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def paths_of(status):
    return {(r.report_key, r.module): r.output_path for r in status.collect()}


def test_csv_text_and_no_file_without_rows(spark):
    rows = [(1, 0, "Oslo, Alnabru", True, None), (1, 1, 'the "old" yard', None, 4.25), (2, 0, " Lima ", False, -1.0)]
    df = spark.createDataFrame(rows, "page_no int, pos int, yard string, open boolean, rate double")
    path = scratch_dir(spark, "csv")
    assert write_module_csv(df, path)
    lines = [x for p in sorted(glob.glob(path + "/*.csv")) for x in open(p).read().splitlines()]
    assert [x for x in lines if x != "yard,open,rate"] == ['"Oslo, Alnabru",true,', '"the ""old"" yard",,4.25', " Lima ,false,-1.0"]
    assert not write_module_csv(df.where("pos > 5"), scratch_dir(spark, "csv-none"))


def test_blanks_quotes_and_newlines_come_back(spark):
    texts = ["  two before", "behind ", " ", "a,b", 'say "x"', "line\nbreak", "Ärger"]
    ex = extract(responses(spark, [("texts", 1, body_of("Note", texts))]))
    out = paths_of(write_module_csvs(ex, None, scratch_dir(spark, "texts")))["r", "texts"]
    assert sorted(r.Note for r in read_csv(spark, out).collect()) == sorted(texts)


def test_reports_that_share_a_folder_keep_their_files(spark):
    a, b = responses(spark, [("load", 1, body_of("Tonnes", [4, 5]))]), responses(spark, [("load", 1, body_of("Gate", ["N7"]))])
    resp = a.unionByName(b.replace("r", "other", ["report_key"]))
    dirs = spark.createDataFrame([("r", "yard"), ("other", "yard")], "report_key string, report_dir string")
    paths = paths_of(write_module_csvs(extract(resp), dirs, scratch_dir(spark, "shared")))
    assert sorted(r.Tonnes for r in read_csv(spark, paths["r", "load"]).collect()) == ["4", "5"]
    assert [r.Gate for r in read_csv(spark, paths["other", "load"]).collect()] == ["N7"]


def test_names_that_a_path_cannot_hold(spark):
    names = ["cost/unit_%", "a:b?c", "plain", "..", "Übersicht 1"]
    ex = extract(responses(spark, [(n, 1, body_of("Rate", [i])) for i, n in enumerate(names)]))
    paths = paths_of(write_module_csvs(ex, None, scratch_dir(spark, "names")))
    assert len(set(paths.values())) == len(names)
    for i, n in enumerate(names):
        assert [r.Rate for r in read_csv(spark, paths["r", n]).collect()] == [str(i)], n


def test_columns_named_like_keys_or_in_two_cases(spark):
    names = ["module", "report_dir", "pos", "Rate", "rate"]
    select = [{"Value": f"G{i}", "Name": f"Depot.{n}"} for i, n in enumerate(names)]
    odd = wrap(page([{"S": [{"N": f"G{i}"} for i in range(5)], "C": ["m1", "d1", 8, 0.5, "half"]}]), select)
    ex = extract(responses(spark, [("odd", 1, odd), ("fine", 1, body_of("Tonnes", [3])), ("bad", 1, "x{")]))
    st = {r.module: r for r in write_module_csvs(ex, None, scratch_dir(spark, "odd")).collect()}
    assert [st[m].status for m in ("odd", "fine", "bad")] == ["ok", "ok", "failed"]
    text = "".join(open(p).read() for p in glob.glob(st["odd"].output_path + "/*.csv"))
    assert text.splitlines() == ["module,report_dir,pos,Rate,rate", "m1,d1,8,0.5,half"]
    assert [r.Tonnes for r in read_csv(spark, st["fine"].output_path).collect()] == ["3"]


def test_writing_again_changes_nothing_and_long_form(spark):
    resp = responses(spark, [("in", 1, body_of("Tonnes", [4, 8], MORE)), ("in", 2, body_of("Tonnes", [15])), ("out", 1, body_of("Gate", ["N7", "S2", "S9"]))])
    ex, base = extract(resp), scratch_dir(spark, "again")
    for _ in range(2):
        paths = paths_of(write_module_csvs(ex, None, base))
    assert [read_csv(spark, paths["r", m]).count() for m in ("in", "out")] == [3, 3]
    dirs = spark.createDataFrame([("r", "yard")], "report_key string, report_dir string")
    for _ in range(2):
        write_rows_by_report(ex.rows, dirs, base + "/long")
    long = spark.read.json(base + "/long").groupBy("__report_dir", "report_key", "module").count()
    assert sorted(tuple(r) for r in long.collect()) == [("yard", "r", "in", 3), ("yard", "r", "out", 3)]


def test_incremental_decode_feeds_the_assembly(spark):
    base = scratch_dir(spark, "stream")
    pages = [depot_page([("Oslo", i), ("Lima", i + 1)], MORE) for i in range(3)] + [depot_page([("Lima", 3), ("Bern", 50)])]
    for i, body in enumerate(pages):  # each page lands in a file of its own
        responses(spark, [("m", i + 1, body)]).coalesce(1).write.json(f"{base}/landing/p{i}")
    q = start_incremental_decode(spark, f"{base}/landing/*", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    sink = spark.read.parquet(f"{base}/out")
    assert sink.select("batch_id").distinct().count() == 4
    assert staged_rows(sink).count() == 8
    ex = extract(sink.drop("batch_id"))
    got = [tuple(r)[2:] for r in ex.table("r", "m", with_order=True).orderBy("page_no", "pos").collect()]
    # the first row of page 4 is the last one of page 3
    assert got == [("Oslo", 0), ("Lima", 1), ("Oslo", 1), ("Lima", 2), ("Oslo", 2), ("Lima", 3), ("Bern", 50)]


def test_pages_of_one_landed_file_are_decoded_by_many_tasks(spark):
    base = scratch_dir(spark, "stream")
    responses(spark, [("m", i + 1, depot_page([("Oslo", i)])) for i in range(40)]).coalesce(1).write.json(f"{base}/landing")
    start_incremental_decode(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt").awaitTermination()
    assert len(glob.glob(f"{base}/out/batch_id=0/part-*")) > 4
    assert staged_rows(spark.read.parquet(f"{base}/out")).count() == 40


def test_modules_without_older_files_are_written_by_many_tasks_and_added(spark, tmp_path, monkeypatch):
    """Small modules are written by many tasks; only a folder that is there already is replaced part by part."""
    from pyspark.sql.readwriter import DataFrameWriter

    from reportlake.plans.extract import extract
    from reportlake.sinks.tables import write_module_csvs

    body = wrap(page([{"C": [3]}]), [{"Value": "M0", "Name": "T.n"}])
    pages = spark.range(60).coalesce(1).select(F.lit("r").alias("report_key"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("module"),
                                               F.lit(1).alias("page_no"), F.lit(200).alias("status"), F.lit(body).alias("body"))
    modes, mode = [], DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, m: (modes.append(m), mode(self, m))[1])
    base = str(tmp_path / "out")
    for wanted in ("append", "overwrite"):
        ex = extract(pages)
        modes.clear()
        status = write_module_csvs(ex, None, base)
        assert [m for m in modes if m][-1] == wanted
        assert status.where("status = 'ok' AND output_path IS NOT NULL").count() == 60
        files = [p.name for p in tmp_path.glob("out/*/*/*/part-*.csv")]
        assert len(files) == 60 and len({f.split("-")[1] for f in files}) > 4
        assert spark.read.option("header", True).csv(base).where("n = 3").count() == 60
