"""End-to-end: HAR file -> discovery -> landed pages -> CSVs and statuses."""

import json

from conftest import wrap

from reportlake.plans.jobs import discover_har, run_extraction
from reportlake.session import scratch_dir

QURL = "https://api.example.com/public/reports/querydata?synchronous=true"


def _body(entity, prop, window=True):
    cmd = {"Query": {"From": [{"Name": "t", "Entity": entity, "Type": 0}],
                     "Select": [{"Column": {"Expression": {"SourceRef": {"Source": "t"}}, "Property": prop}}]}}
    if window:
        cmd["Binding"] = {"DataReduction": {"DataVolume": 3, "Primary": {"Window": {"Count": 500}}}}
    else:
        cmd["Binding"] = {"DataReduction": {"DataVolume": 3, "Primary": {"Top": {}}}}
    return json.dumps({"version": "1.0.0", "queries": [{"Query": {"Commands": [{"SemanticQueryDataShapeCommand": cmd}]},
                       "ApplicationContext": {"DatasetId": "d", "Sources": [{"ReportId": "r", "VisualId": "v"}]}}],
                       "cancelQueries": [], "modelId": 7})


def test_har_to_csvs(spark, tmp_path):
    entries = [{"request": {"method": "POST", "url": QURL, "headers": [{"name": "X-ResourceKey", "value": "k"}],
                            "postData": {"text": b}}}
               for b in (_body("Units", "Name"), _body("Units", "Name"), _body("Totals", "Sum", window=False))]
    har = tmp_path / "report.har"
    har.write_text(json.dumps({"log": {"entries": entries}}))
    found = discover_har(spark, str(har))
    mods = {r.name: r.paginated for r in found["modules"].collect()}
    assert mods == {"units_name": True, "totals_sum": False}
    key = found["modules"].first().report_key

    def page(vals, rt=None):
        ds = {"ValueDicts": {}, "PH": [{"DM0": [{"S": [{"N": "G0"}], "C": [vals[0]]}] + [{"C": [v]} for v in vals[1:]]}]}
        if rt:
            ds["RT"] = rt
        return wrap(ds, [{"Value": "G0", "Name": "T.Value"}])

    rows = [(key, "units_name", 1, 200, page(["a", "b"], [[1]])), (key, "units_name", 2, 200, page(["b", "c"])),
            (key, "totals_sum", 1, 200, page([42], [[9]])), (key, "totals_sum", 2, 200, page([43]))]
    resp = spark.createDataFrame(rows, "report_key string, module string, page_no int, status int, body string")
    res = run_extraction(resp, found["modules"], scratch_dir(spark, "job"))
    st = [(r.module, r.status, r.n_rows) for r in res.status.collect()]
    assert st == [("units_name", "ok", 3), ("totals_sum", "ok", 1)]  # module (capture) order
    assert res.exit_code == 0
    assert [r.Value for r in res.extraction.table(key, "units_name", with_order=True).orderBy("page_no", "pos").collect()] == ["a", "b", "c"]


def test_selected_modules_follow_request_order(spark, tmp_path):
    entries = [{"request": {"method": "POST", "url": QURL, "postData": {"text": b}}}
               for b in (_body("Units", "Name"), _body("People", "Email"), _body("Totals", "Sum"))]
    har = tmp_path / "r.har"
    har.write_text(json.dumps({"log": {"entries": entries}}))
    found = discover_har(spark, str(har))
    key = found["modules"].first().report_key
    req = spark.createDataFrame([(key, 0, "totals_sum"), (key, 1, "units_name")], "report_key string, req_pos int, name string")
    empty = spark.createDataFrame([], "report_key string, module string, page_no int, status int, body string")
    res = run_extraction(empty, found["modules"], scratch_dir(spark, "job2"), requested=req)
    assert [(r.module, r.status) for r in res.status.collect()] == [("totals_sum", "empty"), ("units_name", "empty")]
    assert res.exit_code == 0  # nothing failed (empty modules are not failures)
