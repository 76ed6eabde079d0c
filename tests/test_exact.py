"""Texts and numbers that come back as they were, and sources that cannot be read."""

import json
import random

import pytest
from conftest import wrap
from pyspark.sql import functions as F

from reportlake.functions.jsonspan import raw_value
from reportlake.functions.ranking import bucket_of, group_row_number, order_buckets
from reportlake.operators.attempts import resolve_attempts
from reportlake.operators.discover import CMD_KEYS, discover
from reportlake.operators.payloads import apply_window
from reportlake.plans.extract import extract
from reportlake.plans.jobs import discover_har, run_bulk
from reportlake.session import scratch_dir
from reportlake.sources.urls import resource_key
from reportlake.streaming.incremental import RESPONSES_SCHEMA


def written(value, rnd):
    """JSON text of a value with random blanks, number forms and escapes; [[key, value]] pairs keep repeated keys."""
    gap = lambda: rnd.choice(["", "", " ", "\n\t"])
    if isinstance(value, dict):
        value = list(value.items())
        if rnd.random() < 0.3 and value:
            value.insert(0, (rnd.choice(value)[0], [1, {"decoy": 2}]))
        return "{" + gap() + ",".join(f"{gap()}{text(k, rnd)}{gap()}:{gap()}{written(v, rnd)}{gap()}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + gap() + ",".join(gap() + written(v, rnd) + gap() for v in value) + "]"
    if isinstance(value, str):
        return text(value, rnd)
    return json.dumps(value)


def text(s, rnd):
    return json.dumps(s, ensure_ascii=rnd.random() < 0.5) if rnd.random() < 0.8 else '"' + "".join(f"\\u{ord(c):04x}" if ord(c) < 65536 else c for c in s) + '"'


def tree(rnd, depth=0):
    kind = rnd.random()
    if depth > 3 or kind < 0.3:
        return rnd.choice([1.5, 0, -2, None, True, "", "a\"]}{[,:\\", "é\U0001f600", "Binding"])
    if kind < 0.6:
        return [tree(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {k: tree(rnd, depth + 1) for k in rnd.sample(["a", "Binding", "é", "x y", "DataReduction", "q\"", "Primary"], rnd.randrange(5))}


@pytest.mark.parametrize("path", [("a",), ("Binding", "DataReduction"), ("a", 1), ("q\"", 0, "é"), ("x y", "x y", "a")])
def test_values_are_found_where_they_stand(spark, path):
    rnd = random.Random(str(path))
    texts = []
    for _ in range(150):
        value = tree(rnd)
        for key in reversed(path):  # most texts have the path
            if rnd.random() < 0.95:
                other = tree(rnd)
                value = {**(other if isinstance(other, dict) else {}), key: value} if isinstance(key, str) else [0] * key + [value]
        texts.append(written(value, rnd))
    got = [r.v for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", raw_value("t", path).alias("v")).orderBy("i").collect()]
    found = 0
    for t, raw in zip(texts, got):
        value, there = json.loads(t), True
        for key in path:
            there = there and (key in value if isinstance(key, str) and isinstance(value, dict) else isinstance(key, int) and isinstance(value, list) and key < len(value))
            value = value[key] if there else None
        assert (raw is not None) == there, t
        if there:
            found += 1
            assert raw in t and json.loads(raw) == value
    assert found > 40


@pytest.mark.parametrize("template, want", [
    ('{"Query":{"n":2.50}, "Binding" : {"DataReduction":{"DataVolume":4,"Primary":{"Window":{}},"x":1e3}} }',
     '{"Query":{"n":2.50}, "Binding" : {"DataReduction":{"DataVolume":4,"Primary":W,"x":1e3}} }'),
    (' {"Query":1.0}\n', ' {"Query":1.0,"Binding":{"DataReduction":{"DataVolume":3,"Primary":W}}}\n'),
    ("{ }", '{ "Binding":{"DataReduction":{"DataVolume":3,"Primary":W}}}'),
    ('{"Binding":null,"z":-0.0}', '{"Binding":{"DataReduction":{"DataVolume":3,"Primary":W}},"z":-0.0}'),
    ('{"Binding":{ },"z":1}', '{"Binding":{"DataReduction":{"DataVolume":3,"Primary":W}},"z":1}'),
    ('{"Binding":{"k":[]}}', '{"Binding":{"k":[],"DataReduction":{"DataVolume":3,"Primary":W}}}'),
    ('{"Binding":{"DataReduction":0.0,"k":1}}', '{"Binding":{"DataReduction":{"DataVolume":3,"Primary":W},"k":1}}'),
    ('{"Binding":{"DataReduction":{"k":"\\u00e9"}}}', '{"Binding":{"DataReduction":{"k":"\\u00e9","Primary":W}}}'),
    ('{"Binding":{"DataReduction":{"Primary":null}}}', '{"Binding":{"DataReduction":{"Primary":W}}}'),
    ('{"Binding":{"a":1},"Binding":{"DataReduction":{"Primary":7}}}', '{"Binding":{"a":1},"Binding":{"DataReduction":{"Primary":W}}}'),
    ('{"Binding":"text"}', None), ("[1]", None), ('{"Binding":{}', None), ("", None),
])
def test_only_the_window_changes(spark, template, want):
    got = spark.createDataFrame([(template, "W")], "t string, w string").select(apply_window("t", "w").alias("o")).first().o
    assert got == want


# --- captures ----------------------------------------------------------------------------------------

CAPTURES = "report_key string, pos bigint, url string, headers array<struct<name:string,value:string>>, body string"
CONTEXT = '"ApplicationContext":{"DatasetId":"d","Sources":[{"ReportId":"r","VisualId":"v"}]}'


def capture(cmd):
    return '{"queries":[{"Query":{"Commands":[{"SemanticQueryDataShapeCommand":' + cmd + "}]}," + CONTEXT + '}],"modelId":5}'


QUERY = '{"Query" : {"From":[{"Name":"t","Entity":"Quay"}],"Select":[{"Column":{"Expression":{"SourceRef":{"Source":"t"}},"Property":"Depth"}}],"Where":[2.50, 1E2]}}'


def test_templates_are_the_captured_text(spark):
    rows = [("rep", 3, "u", [], capture(QUERY)), ("rep", 9, "u", [], capture(QUERY.replace(" ", "")))]
    mods = discover(spark.createDataFrame(rows, CAPTURES))["modules"].collect()
    assert [(m.name, m.pos, m.query_template) for m in mods] == [("quay_depth", 3, QUERY)]


def test_bodies_beyond_one_variant(spark, monkeypatch):
    """Bodies that no VARIANT holds (here: by decree) give the same modules and configs as others."""
    window = QUERY[:-1] + ',"Binding":{"DataReduction":{"Primary":{"Window":{}}}}}'
    subquery = QUERY.replace('"Entity":"Quay"', '"Expression":{}')
    rows = [("a", 1, "u", [], capture(QUERY)), ("a", 2, "u", [], capture(window)), ("a", 3, "u", [], capture(subquery)), ("a", 4, "u", [], capture("{}")),
            ("b", 0, "u", [], '{"queries":[{}]}'), ("c", 0, "u", [], "{broken"), ("d", 0, "u", [], capture(QUERY).replace('"modelId":5', '"modelId":null'))]
    caps = spark.createDataFrame(rows, CAPTURES)

    def tables():
        found = discover(caps, materialize=False)
        return ([sorted(map(str, found[t].drop("shape_key").collect())) for t in ("modules", "report_config", "rejects", "report_discovery")])

    usual = tables()
    monkeypatch.setattr("reportlake.operators.discover.parsed", lambda body: F.lit(None).cast("variant"))
    assert tables() == usual
    assert len(usual[0]) == 3 and len(usual[2]) == 4


def test_no_sort_aggregate_carries_bodies(spark, capsys):
    rows = [("rep", 1, "u", [], capture(QUERY))]
    found = discover(spark.createDataFrame(rows, CAPTURES), materialize=False)
    log = spark.createDataFrame([("r", "m", 1, 0, 200, "1", "body")], "report_key string, module string, page_no int, attempt int, status int, retry_after string, body string")
    for df in (found["modules"], found["report_config"], resolve_attempts(log)):
        df.explain()
        assert "SortAggregate" not in capsys.readouterr().out


def test_every_har_file_is_listed(spark, tmp_path):
    entry = {"request": {"method": "POST", "url": "https://x/public/reports/querydata", "postData": {"text": capture(QUERY)}}}
    whole = json.dumps({"log": {"entries": [entry]}}, indent=1)
    for name, content in {"ok": whole, "cut": whole[:-3], "list": "[1]", "get": json.dumps({"log": {"entries": [{"request": {"method": "GET"}}]}}), "none": "{}"}.items():
        (tmp_path / f"{name}.har").write_text(content)
    found = discover_har(spark, f"{tmp_path}/*.har")
    status = {r.report_key.split("/")[-1]: (r.status, r.detail, r.n_captures) for r in found["report_discovery"].collect()}
    assert status == {"ok.har": ("ok", None, 1), "cut.har": ("failed", "unreadable_har", 0), "list.har": ("failed", "unreadable_har", 0),
                      "get.har": ("failed", "no_captures", 0), "none.har": ("failed", "no_captures", 0)}
    rejects = {(r.report_key.split("/")[-1], r.reject) for r in found["capture_rejects"].collect()}
    assert rejects == {("cut.har", "unreadable_har"), ("list.har", "unreadable_har"), ("get.har", "not_post")}


def test_bulk_from_link_texts(spark):
    import base64

    def link(key):
        return "https://app.example.com/view?r=" + base64.b64encode(json.dumps({"k": key}).encode()).decode().rstrip("=")

    texts = spark.createDataFrame([("b.txt", f"{link('two')} and {link('none')}"), ("a.txt", f"<{link('one')}>\nhttps://app.example.com/view?r=!!!\n{link('two')}")], "source string, text string")
    header = lambda k: [{"name": "x-RESOURCEKEY", "value": k}]
    caps = spark.createDataFrame([(0, "u", header("one"), capture(QUERY)), (1, "u", header("two"), capture(QUERY.replace("Depth", "Width"))),
                                  (2, "u", header("other"), capture(QUERY)), (3, "u", [], capture(QUERY))],
                                 "pos bigint, url string, headers array<struct<name:string,value:string>>, body string")
    page = wrap({"PH": [{"DM0": [{"S": [{"N": "G0"}], "C": ["x"]}]}]}, [{"Value": "G0", "Name": "Q.Depth"}])
    resp = spark.createDataFrame([(link("one"), "quay_depth", 1, 200, page), (link("two"), "quay_width", 1, 403, "")], RESPONSES_SCHEMA)
    out = run_bulk(texts, caps, resp, scratch_dir(spark, "bulk"))
    got = {r.url: (r.status, r.n_modules, r.detail, r.n_modules_ok) for r in out.report_status.collect()}
    assert got == {link("one"): ("ok", 1, None, 1), link("two"): ("ok", 1, None, 0), link("none"): ("failed", 0, "no_captures", 0),
                   "https://app.example.com/view?r=!!!": ("failed", 0, "bad_json", 0)}
    assert [(r.url_index, r.report_dir) for r in out.folders.orderBy("url_index").collect()] == [(1, "one"), (2, "report_2"), (3, "two"), (4, "none")]
    assert sorted(r.pos for r in out.unlinked.collect()) == [2, 3] and out.exit_code == 0
    assert {r.status: r.n for r in out.summary.collect()} == {"ok": 2, "failed": 2}


@pytest.mark.parametrize("r, key", [
    ("eyJrIjoiYWJjIn0=,", "abc"), ("eyJrIjoiYWJjIn0", "abc"), ("eyJrIjoi-YWJjIn0=", "abc"), ("eyJrIjoiYWJjIn0%3D", "abc"),
    ("eyJrIjoiYWJjIn0=QUJD", "abc"), ("eyJrIjoiYWJjIn0*", None), ("e", None),
])
def test_lenient_keys(spark, r, key):
    value, reason = resource_key(F.lit(f"https://app.example.com/view?r={r}"))
    got = spark.range(1).select(value.alias("k"), reason.alias("why")).first()
    assert got.k == key and (got.why is None) == (key is not None)


# --- numbers -----------------------------------------------------------------------------------------


def table_of(spark, columns):
    entries = [{"S": [{"N": f"G{i}"} for i in range(len(columns))], "C": list(row)} for row in zip(*columns.values())]
    body = wrap({"PH": [{"DM0": entries}]}, [{"Value": f"G{i}", "Name": f"T.{c}"} for i, c in enumerate(columns)])
    ex = extract(spark.createDataFrame([("r", "m", 1, 200, body)], RESPONSES_SCHEMA))
    return dict(ex.columns("r", "m")), ex.table("r", "m", with_order=True).orderBy("pos")


def test_integers_stay_exact(spark):
    columns = {"small": [1, -2, 9223372036854775807], "big": [12345678901234567890, 12345678901234567891, 7], "wide": [10 ** 37 + 1, -(10 ** 37) - 2, 0],
               "huge": [10 ** 60 + 1, 10 ** 60 + 2, -(10 ** 45) - 3], "mixed": [12345678901234567890, 0.5, 1], "real": [1.0, 2, 3.25]}
    types, table = table_of(spark, columns)
    assert types == {"small": "bigint", "big": "decimal(38,0)", "wide": "decimal(38,0)", "huge": "string", "mixed": "double", "real": "double"}
    rows = table.collect()
    for c in ("small", "big", "wide", "huge"):
        assert [int(r[c]) for r in rows] == columns[c]
    assert [r.real for r in rows] == [1.0, 2.0, 3.25]


# --- ranks -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("order", ["id * 1000000000", "id", "id * id * id", "if(id < 4000, id, id * 100000000)", "5000 - id", "id / 7"])
def test_buckets_are_even_however_positions_lie(spark, order):
    df = spark.range(5000).selectExpr("id % 3 AS g", f"{order} AS o")
    cuts = order_buckets(df, "o", 50)
    sizes = [r.n for r in df.groupBy(bucket_of("o", cuts).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 45 and max(sizes) <= 3 * 5000 / 50
    rows = group_row_number(df, ["g"], "o", "rn", 50).collect()
    for g in range(3):
        own = sorted((r.o, r.rn) for r in rows if r.g == g)
        assert [rn for _, rn in own] == list(range(1, len(own) + 1))
