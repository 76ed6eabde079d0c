"""Paging rules, module outcome and typing (E1-E9), through the extraction plan."""

import pytest
from conftest import DEPOT, depot_page, page, responses, wrap

from reportlake.operators.assemble import assembled_rows, infer_schema, module_table, page_meta, page_plan
from reportlake.operators.decode import decode_pages
from reportlake.plans.extract import extract

OSLO, LIMA, PUNE, BERN = ("Oslo", 41, True), ("Lima", 7, False), ("Pune", 0, True), ("Bern", 19, False)
MORE = [["'next'", 3]]


def three_pages():
    """The last row of page 1 comes again first on page 2; page 3 starts with a row that page 2 has, but not last."""
    return [depot_page([OSLO, LIMA, PUNE], MORE), depot_page([PUNE, BERN], MORE), depot_page([PUNE, OSLO])]


def table_rows(ex, module="m"):
    return [tuple(r)[2:] for r in ex.table("r", module, with_order=True).orderBy("page_no", "pos").collect()]


def one_status(ex):
    s = ex.status().collect()[0]
    return s.status, s.n_rows, s.n_pages, s.detail


def test_repeated_boundary_row_is_dropped_once(spark):
    ex = extract(responses(spark, three_pages()))
    assert table_rows(ex) == [OSLO, LIMA, PUNE, BERN, PUNE, OSLO]
    assert one_status(ex) == ("ok", 6, 3, "no_tokens")


def test_boundary_rule_off_keeps_all_rows(spark):
    assert len(table_rows(extract(responses(spark, three_pages()), dedupe_boundary=False))) == 7


def test_module_without_paging_takes_its_first_page(spark):
    paging = spark.createDataFrame([("r", "m", False)], "report_key string, module string, paginated boolean")
    ex = extract(responses(spark, three_pages()), paging)
    assert (table_rows(ex), one_status(ex)[3]) == ([OSLO, LIMA, PUNE], "single_shot")


@pytest.mark.parametrize("second, status, rows, outcome", [
    (depot_page([BERN], MORE), 502, 2, ("partial", "http_error")),
    (depot_page([], MORE), 200, 2, ("ok", "no_rows")),
    (depot_page([BERN]), 200, 3, ("ok", "no_tokens")),
    (depot_page([BERN], MORE), 403, 0, ("failed", "auth_failed")),
    ("[{]", 200, 0, ("failed", "bad_json")),
])
def test_what_the_second_page_does(spark, second, status, rows, outcome):
    ex = extract(responses(spark, [depot_page([OSLO, LIMA], MORE), second, depot_page([PUNE])], status=[200, status, 200]))
    s = one_status(ex)
    assert (s[1], len(table_rows(ex)), (s[0], s[3])) == (rows, rows, outcome)


def test_error_on_the_first_page_is_empty(spark):
    assert one_status(extract(responses(spark, [depot_page([OSLO])], status=[404])))[:3] == ("empty", 0, 0)


@pytest.mark.parametrize("landed, rows", [([1, 2, 5], [OSLO, LIMA]), ([2, 3], []), ([1], [OSLO])])
def test_missing_pages_make_a_module_incomplete(spark, landed, rows):
    bodies = {1: OSLO, 2: LIMA, 3: PUNE, 5: BERN}
    ex = extract(responses(spark, [("m", n, depot_page([bodies[n]], MORE)) for n in landed]))
    assert (table_rows(ex), one_status(ex)[0]) == (rows, "incomplete")


def test_page_landed_again_counts_once(spark):
    first = depot_page([OSLO, LIMA], MORE)
    resp = responses(spark, [("m", 1, first), ("m", 1, first), ("m", 2, "busy"), ("m", 2, depot_page([PUNE]))], status=[200, 200, 503, 200])
    ex = extract(resp)
    assert table_rows(ex) == [OSLO, LIMA, PUNE]
    assert one_status(ex) == ("ok", 3, 2, "no_tokens")


def test_modules_do_not_touch_each_other(spark):
    resp = responses(spark, [("north", 1, depot_page([BERN, OSLO])), ("south", 1, "nothing"), ("west", 1, depot_page([]))])
    wanted = spark.createDataFrame([("r", m) for m in ("north", "south", "west", "east")], "report_key string, module string")
    assert {r.module: (r.status, r.n_rows) for r in extract(resp).status(wanted).collect()} == {
        "north": ("ok", 2), "south": ("failed", 0), "west": ("empty", 0), "east": ("empty", 0)}


def test_columns_union_in_order_of_appearance_with_merged_types(spark):
    first = page([{"S": [{"N": "G1"}], "C": [6]}, {"S": [{"N": "G3"}, {"N": "G1"}], "C": [1, 7]}], rt=MORE)
    second = page([{"S": [{"N": "G0"}, {"N": "G3"}, {"N": "G2"}], "C": ["Oslo", 0.5, True]}, {"C": [12, 2, False]}, {"Ø": 5, "C": [4]}])
    ex = extract(responses(spark, [wrap(first), wrap(second)]))
    assert ex.columns("r", "m") == [("Tonnes", "bigint"), ("Rate", "double"), ("City", "string"), ("Open", "boolean")]
    assert table_rows(ex) == [(6, None, None, None), (7, 1.0, None, None), (None, 0.5, "Oslo", True), (None, 2.0, "12", False), (None, 4.0, None, None)]


def test_names_that_differ_in_case_alone(spark):
    select = [{"Value": "G0", "Name": "Depot.rate"}, {"Value": "G1", "Name": "Depot.Rate"}, {"Value": "G2", "Name": "Depot.pos"}]
    body = wrap(page([{"S": [{"N": f"G{i}"} for i in range(3)], "C": ["low", 5, 9]}]), select)
    t = extract(responses(spark, [body])).table("r", "m")
    assert (t.columns, [tuple(r) for r in t.collect()]) == (["rate", "Rate", "pos"], [("low", 5, 9)])


def test_direct_and_staged_assembly_agree(spark):
    resp = responses(spark, three_pages())
    decoded = decode_pages(resp)
    pages, _ = page_plan(page_meta(decoded))
    rows = assembled_rows(decoded, pages)
    direct = module_table(rows, infer_schema(rows), "r", "m").orderBy("page_no", "pos").drop("page_no", "pos")
    assert [tuple(r) for r in direct.collect()] == table_rows(extract(resp))


def test_plans_have_no_window(spark):
    ex = extract(responses(spark, three_pages()))
    for df in (ex.pages, ex.rows, ex.schema, ex.status(), ex.table("r", "m")):
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString()


def test_quarantine_of_an_extraction(spark):
    cut = wrap(page([{"S": [{"N": "G0"}, {"N": "G1"}], "C": ["Oslo", 4]}, {"C": ["Lima", 5]}, {"C": 6}], rt=MORE), DEPOT[:2])
    found = extract(responses(spark, [cut, "]["])).quarantine().collect()
    assert sorted((r.page_no, r.pos, r.reason) for r in found) == [(1, 2, "bad_values"), (2, None, "bad_json")]
