"""Payloads (C13-C15), module selection and summaries."""

import json

import pytest
from pyspark.sql import functions as F

from reportlake.operators.payloads import build_payloads, is_paginated, window_config
from reportlake.operators.runs import UnknownModules, bulk_summary, exit_code, report_status, run_summary, select_modules

CFG = ("r", "ds", "rep", "vis", 598501)


def payloads(spark, templates, rt=None, paginated_only=True):
    req = spark.createDataFrame([("r", i, json.dumps(t), rt) for i, t in enumerate(templates)],
                                "report_key string, i int, query_template string, rt string")
    cfg = spark.createDataFrame([CFG], "report_key string, dataset_id string, report_id string, visual_id string, model_id bigint")
    out = build_payloads(req, cfg, window_config(30000, F.col("rt")), paginated_only=paginated_only)
    return [json.loads(r.payload) for r in out.orderBy("i").collect()], req


def cmd_of(p):
    return p["queries"][0]["Query"]["Commands"][0]["SemanticQueryDataShapeCommand"]


def test_payload_shape_and_tokens(spark):
    tpl = {"Query": {"Where": [1]}, "Binding": {"DataReduction": {"DataVolume": 4, "Primary": {"Window": {"Count": 5}}}}}
    (p,), req = payloads(spark, [tpl], rt="[[7]]")
    assert p["version"] == "1.0.0" and p["cancelQueries"] == [] and p["modelId"] == 598501
    assert p["queries"][0]["ApplicationContext"] == {"DatasetId": "ds", "Sources": [{"ReportId": "rep", "VisualId": "vis"}]}
    assert cmd_of(p)["Binding"]["DataReduction"] == {"DataVolume": 4, "Primary": {"Window": {"Count": 30000, "RestartTokens": [[7]]}}}
    assert cmd_of(p)["Query"] == {"Where": [1]}
    assert json.loads(req.first().query_template) == tpl  # template unchanged


def test_empty_binding_and_reduction_filled(spark):
    ps, _ = payloads(spark, [{"Query": {}, "Binding": None}, {"Query": {}, "Binding": {"DataReduction": None}}, {"Query": {}}],
                     paginated_only=False)
    for p in ps:
        assert cmd_of(p)["Binding"]["DataReduction"] == {"DataVolume": 3, "Primary": {"Window": {"Count": 30000}}}


def test_top_shaped_template_replayed_as_is(spark):
    tpl = {"Query": {}, "Binding": {"DataReduction": {"Primary": {"Top": {}}}}}
    (p,), _ = payloads(spark, [tpl], rt="[[7]]")
    assert cmd_of(p) == tpl


def test_is_paginated_null_tolerant(spark):
    tpls = [{"Binding": {"DataReduction": {"Primary": {"Window": {}}}}}, {"Binding": {"DataReduction": {"Primary": {"Top": {}}}}},
            {"Binding": {"DataReduction": None}}, {"Binding": None}, {}, {"Binding": {"DataReduction": {"Primary": {"Window": None}}}}]
    df = spark.createDataFrame([(json.dumps(t),) for t in tpls], "t string")
    assert [r[0] for r in df.select(is_paginated("t")).collect()] == [True, False, False, False, False, True]


def test_module_selection_order_and_unknown(spark):
    mods = spark.createDataFrame([("r", "a", 1), ("r", "b", 2), ("r", "c", 3)], "report_key string, name string, pos int")
    req = spark.createDataFrame([("r", 0, "c"), ("r", 1, "a"), ("r", 2, "c")], "report_key string, req_pos int, name string")
    sel, unknown = select_modules(mods, req)
    assert [r.name for r in sel.orderBy("req_pos").collect()] == ["c", "a", "c"]
    bad = req.unionByName(spark.createDataFrame([("r", 3, "zz"), ("r", 4, "yy")], req.schema))
    with pytest.raises(UnknownModules, match="Unknown module\\(s\\): yy, zz. Available: a, b, c"):
        select_modules(mods, bad)


def test_summaries_and_exit_code(spark):
    st = spark.createDataFrame([("r1", "a", "failed"), ("r1", "b", "ok"), ("r2", "c", "failed")],
                               "report_key string, module string, status string")
    s = {r.report_key: (r.n_modules, r.n_failed, r.all_failed) for r in run_summary(st).collect()}
    assert s == {"r1": (2, 1, False), "r2": (1, 1, True)}
    disc = spark.createDataFrame([("r1", 3, 2, "ok", None), ("r2", 1, 0, "failed", "no_usable_modules")],
                                 "report_key string, n_captures long, n_modules long, status string, detail string")
    urls = spark.createDataFrame([("u1", "r1"), ("u2", "r2"), ("u3", "r3")], "url string, report_key string")
    rs = report_status(urls, disc, st)
    got = {r.url: (r.status, r.n_modules_ok) for r in rs.collect()}
    assert got == {"u1": ("ok", 1), "u2": ("failed", 0), "u3": ("failed", 0)}
    assert {r.status: r.n for r in bulk_summary(rs).collect()} == {"ok": 1, "failed": 2}
    assert exit_code(rs) == 0 and exit_code(rs.where("status = 'failed'")) == 1


def test_unreadable_template_gives_null_payload(spark):
    req = spark.createDataFrame([("r", 0, "{not json", None)], "report_key string, i int, query_template string, rt string")
    cfg = spark.createDataFrame([CFG], "report_key string, dataset_id string, report_id string, visual_id string, model_id bigint")
    out = build_payloads(req, cfg, window_config(30000, F.col("rt")), paginated_only=False).collect()
    assert [r.payload for r in out] == [None]


def test_failure_message(spark):
    from reportlake.operators.runs import failure_message

    st = spark.createDataFrame([("r", "a", "failed", 0), ("r", "b", "ok", 1), ("r", "c", "failed", 2), ("q", "d", "ok", 0)],
                               "report_key string, module string, status string, module_order int")
    assert failure_message(st, "r", "module_order") == "2/3 module(s) failed: a, c"
    assert failure_message(st, "q") is None


def test_costly_steps_run_in_many_tasks(spark, tmp_path):
    """Captures of one small file are analysed, cut and turned into payloads by many tasks, not by one."""
    import glob
    import os

    from reportlake.operators.discover import discover, query_templates
    from reportlake.session import checkpoint_root, task_count

    command = '{"Query":{"From":[{"Name":"p","Entity":"Parts","Type":0}],"Select":[{"Column":{"Expression":{"SourceRef":{"Source":"p"}},"Property":"x"}}]}}'
    body = ('{"queries":[{"Query":{"Commands":[{"SemanticQueryDataShapeCommand":' + command + '}]},'
            '"ApplicationContext":{"DatasetId":"d","Sources":[{"ReportId":"r","VisualId":"v"}]}}]}')
    one = spark.range(400).coalesce(1)
    caps = one.selectExpr("cast(id AS string) AS report_key", "id AS pos", "'u' AS url",
                          "cast(array() AS array<struct<name:string,value:string>>) AS headers", f"'{body}' AS body")
    before = set(glob.glob(f"{checkpoint_root(spark)}/captures-analysed-*"))
    found = discover(caps)
    new, = set(glob.glob(f"{checkpoint_root(spark)}/captures-analysed-*")) - before
    assert len([f for f in os.listdir(new) if f.endswith(".parquet")]) > spark.sparkContext.defaultParallelism
    chosen = found["modules"].select("report_key", "pos")
    asked = build_payloads(found["modules"], found["report_config"])
    assert asked.count() == 400 and asked.where("payload IS NULL").isEmpty()
    assert asked.rdd.getNumPartitions() >= task_count(spark)
    assert "RepartitionByExpression [report_key" in query_templates(caps, chosen)._jdf.queryExecution().optimizedPlan().toString()
