"""Captures, URLs and discovery."""

import json

from pyspark.sql import functions as F

from reportlake.operators.discover import discover
from reportlake.session import scratch_dir
from reportlake.sinks.tables import load_catalog, report_dirs, save_catalog
from reportlake.sources.captures import filter_captures, har_entries, header_value, read_har_texts
from reportlake.sources.urls import extract_view_urls, read_texts, resource_key

QURL = "https://api.example.com/public/reports/querydata?synchronous=true"


def command(entities, selects, where=None, window=True):
    q = {"Version": 2, "From": [{"Name": n, "Entity": e, "Type": 0} for n, e in entities], "Select": selects}
    if where is not None:
        q["Where"] = where
    cmd = {"Query": q}
    if window:
        cmd["Binding"] = {"DataReduction": {"DataVolume": 3, "Primary": {"Window": {"Count": 120}}}}
    return cmd


def col(src, prop):
    return {"Column": {"Expression": {"SourceRef": {"Source": src}}, "Property": prop}}


def body(cmd, model_id=None, ds="set-7"):
    b = {"version": "1.0.0", "queries": [{"Query": {"Commands": [{"SemanticQueryDataShapeCommand": cmd}]},
                                         "ApplicationContext": {"DatasetId": ds, "Sources": [{"ReportId": "rp-2", "VisualId": "vs-9"}]}}],
         "cancelQueries": []}
    if model_id is not None:
        b["modelId"] = model_id
    return json.dumps(b)


def captures(spark, bodies, headers=None, report="r"):
    rows = [(report, i, QURL, headers or [("X-ResourceKey", "yard-key")], b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "report_key string, pos int, url string, headers array<struct<name:string,value:string>>, body string")


DEPOTS = command([("d", "Depots")], [col("d", "Gate"), col("d", "Crane")])
TRAINS = command([("t", "Trains"), ("w", "Wagons"), ("d", "Depots")], [col("w", "Axles"), col("t", "Line"), col("d", "Gate")])
CREWS = command([("c", "Crews")], [col("c", "Shift")])


def names_of(found):
    return [r.name for r in found["modules"].orderBy("pos").collect()]


def test_har_entries_that_are_query_captures(spark, tmp_path):
    good = body(TRAINS)
    post = {"method": "POST", "url": QURL}
    requests = [
        {"method": "OPTIONS", "url": QURL, "postData": {"text": good}},
        {**post, "postData": {"text": good[:-3]}},
        {**post, "headers": [{"name": "x-a", "value": "1"}], "postData": {"text": good}},
        {**post, "url": "https://api.example.com/other", "postData": {"text": good}},
        {**post, "postData": {"text": ""}},
        {**post, "postData": {"text": good}},
    ]
    (tmp_path / "yard.har").write_text(json.dumps({"log": {"entries": [{"request": r} for r in requests]}}))
    caps, rejects = filter_captures(har_entries(read_har_texts(spark, str(tmp_path / "yard.har"))))
    assert sorted(r.pos for r in caps.collect()) == [2, 5]
    assert {r.pos: r.reject for r in rejects.collect()} == {0: "not_post", 1: "bad_json", 3: "not_query_path", 4: "empty_body"}


def test_headers_are_found_in_any_case_and_the_last_counts(spark):
    df = spark.createDataFrame([([("X-Trace", "t1"), ("x-yard", "first"), ("X-YARD", "other case"), ("x-yard", "last")],)],
                               "h array<struct<name:string,value:string>>")
    assert [df.select(header_value("h", n)).first()[0] for n in ("X-Yard", "x-trace", "absent")] == ["last", "t1", None]


def test_modules_of_a_report_and_its_config(spark):
    found = discover(captures(spark, [body(TRAINS), body(CREWS), body(TRAINS), body(DEPOTS), body(CREWS)], headers=[("X-RESOURCEKEY", "yard-key")]))
    assert names_of(found) == ["depots_trains_wagons_axles_line_gate", "crews_shift", "depots_gate_crane"]
    c = found["report_config"].first()
    assert (c.resource_key, c.dataset_id, c.report_id, c.visual_id, c.model_id) == ("yard-key", "set-7", "rp-2", "vs-9", 598501)


def test_model_of_the_capture_is_kept(spark):
    assert discover(captures(spark, [body(CREWS, model_id=42)]))["report_config"].first().model_id == 42


def test_report_of_subqueries_only_fails(spark):
    nested = json.loads(json.dumps(TRAINS))
    nested["Query"]["From"].insert(1, {"Name": "q", "Type": 2, "Expression": {"Subquery": {"Query": {}}}})
    found = discover(captures(spark, [body(nested), body(nested)]))
    st = found["report_discovery"].first()
    assert (names_of(found), st.status, st.detail) == ([], "failed", "no_usable_modules")
    assert {r.reason for r in found["rejects"].collect()} == {"subquery_source"}


def test_module_without_a_source_is_named_by_its_place(spark):
    bare = command([], [col("z", "Weight"), col("z", "Seal")])
    assert names_of(discover(captures(spark, [body(CREWS), body(DEPOTS), body(bare)])))[2] == "query_2_weight_seal"


def test_equal_names_of_different_queries_are_numbered(spark):
    filtered = [command([("c", "Crews")], [col("c", "Shift")], where=[{"Condition": {"Not": i}}]) for i in range(3)]
    found = discover(captures(spark, [body(filtered[0]), body(filtered[1]), body(DEPOTS), body(filtered[2]), body(filtered[0])]))
    assert names_of(found) == ["crews_shift_1", "crews_shift_2", "depots_gate_crane", "crews_shift_3"]


def test_only_names_used_again_are_ranked_and_templates_are_joined_once(spark, monkeypatch):
    from reportlake.operators import discover as module

    ranked, rank = [], module.group_row_number

    def counted(df, group_cols, *rest):
        ranked.append((group_cols, df.count()))
        return rank(df, group_cols, *rest)

    monkeypatch.setattr(module, "group_row_number", counted)
    filtered = [command([("c", "Crews")], [col("c", "Shift")], where=[{"Condition": {"Not": i}}]) for i in range(2)]
    found = discover(captures(spark, [body(DEPOTS), body(filtered[0]), body(TRAINS), body(filtered[1])]))
    assert names_of(found) == ["depots_gate_crane", "crews_shift_1", "depots_trains_wagons_axles_line_gate", "crews_shift_2"]
    assert ranked == [(["report_key", "base_name"], 2)]
    assert found["modules"].select("name")._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1


def test_a_numbered_name_that_meets_another_is_flagged(spark):
    def named(entity, n):
        return body(command([("c", entity)], [col("c", "Shift")], where=[{"Condition": {"Not": n}}]))

    # crews_shift twice and crews_shift_1 once: the first of them meets it; yards_shift_1 twice and yards_shift twice: none meets
    found = discover(captures(spark, [
        named("Crews", 0), body(command([("c", "Crews")], [col("c", "Shift_1")])), named("Crews", 1), body(DEPOTS),
        *[body(command([("y", "Yards")], [col("y", p)], where=[{"Condition": {"Not": n}}])) for n in range(2) for p in ("Shift", "Shift_1")]]))
    assert [(r.name, r.name_clash) for r in found["modules"].orderBy("pos").collect()] == [
        ("crews_shift_1", True), ("crews_shift_1", True), ("crews_shift_2", False), ("depots_gate_crane", False),
        ("yards_shift_1", False), ("yards_shift_1_1", False), ("yards_shift_2", False), ("yards_shift_1_2", False)]


def test_odd_sources_and_items_are_read_as_by_their_paths(spark):
    from reportlake.operators.discover import analyse_captures

    source, item = {"Name": "s", "Entity": "E"}, col("s", "p")
    cases = [
        ([source], [5, None, "x", item], [("s", "p", False)], None),
        ([source], [{"Column": None, "Measure": item["Column"]}, {"Column": 5, "Measure": item["Column"]}, item], [("s", "p", False)], None),
        ([source], [{"Measure": item["Column"], "Column": item["Column"]}, {"Aggregation": {"Expression": item["Column"]}}], [("s", "p", False), ("s", "p", True)], None),
        ([source], [{"Column": {"Expression": {"SourceRef": {"Source": 7}}, "Property": 1.5}}], [("7", "1.5", False)], None),
        ([source, 5], [item], [("s", "p", False)], "subquery_source"),
        ([source, {"Name": "n", "Entity": None}], [item], [("s", "p", False)], None),
        ([source, {"Name": None, "Entity": "F"}], [item], [("s", "p", False)], "bad_source"),
        ([source], [], [], "no_columns"),
        ({"a": 1}, "x", [], "no_columns"),
    ]
    made = [body({"Query": {"From": f, "Select": s}}) for f, s, _, _ in cases] + [body(None), body({"Query": None})]
    got = analyse_captures(captures(spark, made)).orderBy("pos").collect()
    assert [([tuple(c) for c in r.select_columns], r.reject) for r in got] == [(c, r) for _, _, c, r in cases] + [([], "no_command"), ([], "no_columns")]


def test_filter_stays_in_the_template(spark):
    where = [{"Condition": {"In": {"Expressions": [col("c", "Shift")], "Values": [[{"Literal": {"Value": "2L"}}]]}}}]
    m = discover(captures(spark, [body(command([("c", "Crews")], [col("c", "Shift")], where=where))]))["modules"].first()
    assert json.loads(m.query_template)["Query"]["Where"] == where


def test_kinds_of_selected_columns(spark):
    measure = {"Measure": {"Expression": {"SourceRef": {"Source": "w"}}, "Property": "Load"}}
    items = [{"Aggregation": {"Expression": col("w", "Axles"), "Function": 0}}, {"Arithmetic": {}}, measure, col("w", "Seal"), {"Column": {"Property": "Lost"}}]
    m = discover(captures(spark, [body(command([("w", "Wagons")], items))]))["modules"].first()
    assert [tuple(c) for c in m.select_columns] == [("w", "Axles", True), ("w", "Load", True), ("w", "Seal", False)]


def test_links_of_a_text_in_order_without_repeats(spark, tmp_path):
    link = "https://app.example.com/view?r="
    (tmp_path / "list.txt").write_text(f"see {link}N7, then <{link}S2&lang=no>\n'{link}N7' {link}S2&lang=no\t{link}W1\n")
    got = [r.url for r in extract_view_urls(read_texts(spark, str(tmp_path / "list.txt"))).orderBy("first_seen").collect()]
    assert got[-1] == f"{link}W1" and f"{link}S2&lang=no" in got and len(got) == len(set(got))


def test_resource_key_in_a_link(spark):
    import base64

    links = ["https://app.example.com/view?r=" + base64.b64encode(json.dumps({"t": "x", "k": k}).encode()).decode().rstrip("=") for k in ("n-7", "south-22")]
    df = spark.createDataFrame([(u,) for u in [*links, "https://app.example.com/view?page=3"]], "url string")
    key, reason = resource_key(F.col("url"))
    assert [tuple(r) for r in df.select(key, reason).collect()] == [("n-7", None), ("south-22", None), (None, "no_r_param")]


def test_saved_catalog_comes_back(spark):
    found = discover(captures(spark, [body(DEPOTS), body(TRAINS)]))
    path = scratch_dir(spark, "catalog")
    save_catalog(found["report_config"], found["modules"], path)
    config, modules = load_catalog(spark, path)
    assert config.first().asDict() == found["report_config"].select(*config.columns).first().asDict()
    assert sorted((m.name, m.output_filename) for m in modules.collect()) == [
        ("depots_gate_crane", "depots_gate_crane.csv"), ("depots_trains_wagons_axles_line_gate", "depots_trains_wagons_axles_line_gate.csv")]


def test_folder_of_a_link_without_key(spark):
    urls = spark.createDataFrame([("https://app.example.com/view?page=3", 10), ("https://app.example.com/none", 4)], "url string, url_index long")
    assert {r.url_index: r.report_dir for r in report_dirs(urls).collect()} == {4: "report_1", 10: "report_2"}


def test_source_without_a_name_rejects_its_capture_only(spark):
    odd = json.loads(json.dumps(CREWS))
    odd["Query"]["From"].append({"Entity": "Rosters", "Type": 0})
    found = discover(captures(spark, [body(odd), body(DEPOTS)]))
    assert (names_of(found), [r.reason for r in found["rejects"].collect()]) == (["depots_gate_crane"], ["bad_source"])
