"""Page decoding (D1-D15).  Expected rows are known by construction."""

import json

import pytest
from conftest import DEPOT_COLUMNS, decoded_rows, depot_page, entries_of, page, responses, wrap

from reportlake.functions.sqlx import let, mask_struct
from reportlake.operators.decode import decode_pages, explode_rows, quarantine

FOUR = [{"N": "G0"}, {"N": "G1"}, {"N": "G2"}, {"N": "G3"}]


def dicts(rows, names=DEPOT_COLUMNS):
    return [dict(zip(names, r)) for r in rows]


def test_rows_of_mixed_types_survive_the_round_trip(spark):
    rows = [("Oslo", 12, True, 0.5), ("Oslo", 12, False, 0.5), ("Lima", None, None, 1.25), ("Lima", 0, None, None), (None, 0, True, -3.75)]
    assert decoded_rows(spark, depot_page(rows)) == dicts(rows)


def test_dictionary_chosen_by_schema_code_number_or_position(spark):
    cities, kinds, zones = ["Oslo", "Lima", "Pune"], ["rail", "road"], ["north", "south", "east", "west"]
    schema = [{"N": "G0", "DN": "D9"}, {"N": "kind"}, {"N": "G5"}, {"N": "zz"}]
    entries = [{"S": schema, "C": [2, 0, 1, 1]}, {"C": [0, 1, 3, 0]}]
    select = [{"Value": c, "Name": f"Yard.{n}"} for c, n in (("G0", "City"), ("kind", "Kind"), ("G5", "Zone"), ("zz", "Gate"))]
    body = wrap(page(entries, {"D9": cities, "kind": kinds, "D5": zones, "D3": ["in", "out"]}), select)
    assert decoded_rows(spark, body) == [
        {"City": "Pune", "Kind": "rail", "Zone": "south", "Gate": "out"},
        {"City": "Oslo", "Kind": "road", "Zone": "west", "Gate": "in"},
    ]


@pytest.mark.parametrize("cell, read", [(-1, -1), (3, 3), (2, "Pune"), (True, True), ("Lima", "Lima"), (1.0, 1.0), (None, None)])
def test_only_indexes_inside_a_dictionary_are_looked_up(spark, cell, read):
    body = wrap(page([{"S": [{"N": "G0", "DN": "D0"}, {"N": "G1"}], "C": [cell, 44]}], {"D0": ["Oslo", "Lima", "Pune"]}))
    assert decoded_rows(spark, body) == [{"City": read, "Tonnes": 44}]


@pytest.mark.parametrize("odd, tonnes", [(None, [5, 0, 1, 9]), ("text", [5, "t", "e", 9]), ("", [5, 0, 1, 9]), ({}, [5, 0, 1, 9])])
def test_odd_dictionaries_that_can_be_looked_up(spark, odd, tonnes):
    entries = [{"S": [{"N": "G0", "DN": "D0"}, {"N": "G1", "DN": "D1"}], "C": [1, 5]}, {"C": [0, 0]}, {"C": [0, 1]}, {"C": [0, 9]}]
    rows = decoded_rows(spark, wrap(page(entries, {"D0": ["Oslo", "Lima"], "D1": odd})))
    assert [r["Tonnes"] for r in rows] == tonnes and [r["City"] for r in rows] == ["Lima", "Oslo", "Oslo", "Oslo"]


@pytest.mark.parametrize("odd, kept", [({"x": 1}, 1), ({"x": 1, "y": 2, "z": 3}, 1), (7, 0), (True, 0)])
def test_a_dictionary_that_cannot_be_looked_up_ends_the_page(spark, odd, kept):
    """The page ends before the first number that the dictionary should hold; other dictionaries are read."""
    entries = [{"S": [{"N": "G0", "DN": "D0"}, {"N": "G1", "DN": "D1"}], "C": [1, 5]}, {"C": [0, 0]}, {"X": [1]}, {"C": [0, "plain"]}]
    df = spark.createDataFrame([("r", "m", 1, 200, wrap(page(entries, {"D0": ["Oslo", "Lima"], "D1": odd})))],
                               "report_key string, module string, page_no int, status int, body string")
    dec = decode_pages(df, with_types=True)
    row = dec.select("n_rows", "bad_pos", "bad_reason", "n_skipped").first()
    assert tuple(row) == (kept, kept, "bad_dictionary", 1)
    assert [r.reason for r in quarantine(dec).collect()] == ["bad_dictionary"]
    negative = [{"S": [{"N": "G1", "DN": "D1"}], "C": [-1]}]
    assert decoded_rows(spark, wrap(page(negative, {"D1": odd}))) == [{"Tonnes": -1}]


def test_schema_changes_inside_a_page(spark):
    entries = [
        {"S": [{"N": "G1"}], "C": [5]},
        {"R": 1},
        {"S": FOUR[:3], "C": ["Lima", 6, True]},
        {"R": 5, "C": [7]},
        {"S": [{"N": "G3"}, {"N": "G0"}], "C": [0.25, "Pune"]},
    ]
    assert decoded_rows(spark, wrap(page(entries))) == [
        {"Tonnes": 5}, {"Tonnes": 5},
        {"City": "Lima", "Tonnes": 6, "Open": True}, {"City": "Lima", "Tonnes": 7, "Open": True},
        {"Rate": 0.25, "City": "Pune"},
    ]


def test_schema_of_another_length_starts_without_values_to_repeat(spark):
    entries = [{"S": FOUR[:2], "C": ["Oslo", 9]}, {"S": FOUR[:3], "R": 3, "C": [False]}]
    assert decoded_rows(spark, wrap(page(entries)))[1] == {"City": None, "Tonnes": None, "Open": False}


def test_schema_of_equal_length_repeats_by_position(spark):
    entries = [{"S": FOUR[:2], "C": ["Oslo", 9]}, {"S": [{"N": "G3"}, {"N": "G2"}], "R": 2, "C": [0.5]}]
    assert decoded_rows(spark, wrap(page(entries)))[1] == {"Rate": 0.5, "Open": 9}


def test_values_under_their_own_code_and_short_value_lists(spark):
    entries = [{"S": FOUR, "G0": "Oslo", "G3": 2.5}, {"C": ["Lima", 3]}, {"S": []}, {"S": FOUR[:1], "C": []}]
    assert decoded_rows(spark, wrap(page(entries))) == [
        {"City": "Oslo", "Tonnes": None, "Open": None, "Rate": 2.5}, {"City": "Lima", "Tonnes": 3, "Open": None, "Rate": None}, {"City": None}]


def test_matrix_entries_are_skipped_with_their_schema(spark):
    entries = [{"S": FOUR[:2], "C": ["Oslo", 1]}, {"X": [{"A": 1}], "S": FOUR}, {"C": ["Lima", 2]}, {"X": [], "C": ["Pune", 3]}]
    assert [r["City"] for r in decoded_rows(spark, wrap(page(entries)))] == ["Oslo", "Lima", "Pune"]


def test_columns_of_one_name_read_the_last_field(spark):
    select = [{"Value": "G0", "Name": "From.Port"}, {"Value": "G1", "Name": "Via.Port"}, {"Value": "G2", "Name": "To.Port"}]
    assert decoded_rows(spark, wrap(page([{"S": FOUR[:3], "C": ["a", "b", "c"]}]), select)) == [{"Port": "c"}]


def test_names_keep_what_follows_the_first_dot(spark):
    select = [{"Value": "G0", "Name": "Sum(Yard.Net.Weight)"}, {"Value": "G1", "Name": "plain"}, {"Value": "G2"}]
    assert decoded_rows(spark, wrap(page([{"S": FOUR[:3], "C": [1, 2, 3]}]), select)) == [{"Net.Weight)": 1, "plain": 2, "Unknown": 3}]


@pytest.mark.parametrize("body", [
    '{"results": []}', '{"results": null}', '{}', '{"results": [{"result": {"data": {}}}]}',
    wrap({"PH": []}), wrap({"PH": [{}]}), wrap(page([]), []), wrap(page([{"S": [], "C": []}]))])
def test_pages_without_rows(spark, body):
    r = decode_pages(responses(spark, [body])).collect()[0]
    assert (r.n_rows, r.bad_json, r.bad_reason) == (0, False, None)


def test_tokens_stay_with_an_empty_page(spark):
    r = decode_pages(responses(spark, [depot_page([], rt=[["'k'", 17]])])).collect()[0]
    assert (r.n_rows, json.loads(r.restart_tokens), r.has_tokens) == (0, [["'k'", 17]], True)


@pytest.mark.parametrize("bad, reason", [
    ("row", "entry_not_object"), ({"C": None}, "bad_values"), ({"C": {"a": 1}}, "bad_values"), ({"S": "G0", "C": []}, "bad_schema"),
    ({"R": "1", "C": []}, "bad_repeat_mask"), ({"R": 2.0, "C": []}, "bad_repeat_mask"), ({"Ø": [1], "C": []}, "bad_null_mask"),
    ({"Ø": None, "C": []}, "bad_null_mask")])
def test_first_malformed_entry_cuts_the_page(spark, bad, reason):
    rows = [("Oslo", 1), ("Lima", 2)]
    body = wrap(page([*entries_of(rows), bad, {"C": ["Pune", 3]}]))
    assert decoded_rows(spark, body) == dicts(rows)
    assert [(q.pos, q.reason) for q in quarantine(decode_pages(responses(spark, [body]))).collect()] == [(2, reason)]


def test_null_mask_is_not_read_when_all_fields_repeat(spark):
    body = wrap(page([*entries_of([("Oslo", 1, True)]), {"R": 7, "Ø": "?"}]))
    assert decoded_rows(spark, body) == dicts([("Oslo", 1, True)] * 2)


def test_repeat_without_a_row_before_is_null(spark):
    assert decoded_rows(spark, wrap(page([{"S": FOUR[:3], "R": 5, "C": [8]}]))) == [{"City": None, "Tonnes": 8, "Open": None}]


def test_integer_dictionary_values_are_resolved_once(spark):
    body = wrap(page([{"S": [{"N": "G0", "DN": "D0"}, {"N": "G1"}], "C": [2, 1]}, {"R": 1, "C": [5]}], {"D0": [10, 2, 1]}))
    assert decoded_rows(spark, body) == [{"City": 1, "Tonnes": 1}, {"City": 1, "Tonnes": 5}]


@pytest.mark.parametrize("n", [62, 63, 64, 93, 126, 127, 130, 200, 300])
def test_wide_pages(spark, n):
    rows = [[i for i in range(n)], [i if i % 3 else -i for i in range(n)], [None if i % 7 == 5 or i == n - 1 else i for i in range(n)],
            [None if i % 7 == 5 else f"v{i % 4}" for i in range(n)], [None if i % 7 == 5 else f"v{i % 4}" for i in range(n - 1)] + [1.5]]
    select = [{"Value": f"G{i}", "Name": f"Wide.F{i}"} for i in range(n)]
    names = [f"F{i}" for i in range(n)]
    plain = wrap(page([{"S": [{"N": f"G{i}"} for i in range(n)], "C": rows[0]}, {"C": rows[1]}]), select)
    assert decoded_rows(spark, plain) == dicts(rows[:2], names)
    body = wrap(page(entries_of(rows, seed=n)), select)
    assert decoded_rows(spark, body) == dicts(rows, names)
    assert quarantine(decode_pages(responses(spark, [body]))).isEmpty()


def test_bits_beyond_the_fields_are_ignored(spark):
    body = wrap(page([*entries_of([("Oslo", 1, True)]), {"R": (1 << 150) + 2, "C": ["Lima", False]}]))
    assert decoded_rows(spark, body)[1] == {"City": "Lima", "Tonnes": 1, "Open": False}


def test_many_schema_changes_do_not_copy_the_dictionaries(spark):
    import time

    n = 5000
    entries = [{"S": [{"N": "G0", "DN": "D0"}, {"N": "G1"}, {"N": "G2"}], "C": [n - 1 - i, i, i % 2 == 0]} for i in range(n)]
    t = time.time()
    rows = decoded_rows(spark, wrap(page(entries, {"D0": [f"yard {j}" for j in range(n)]})))
    assert [rows[0], rows[-1], len(rows)] == [{"City": f"yard {n - 1}", "Tonnes": 0, "Open": True},
                                              {"City": "yard 0", "Tonnes": n - 1, "Open": False}, n]
    assert time.time() - t < 90


def test_last_of_repeated_json_keys_wins(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    body = wrap(page(["#"])).replace('"#"', '{"S":[{"N":"G0"},{"N":"G1"}],"C":["Oslo",1],"C":["Lima",2]}')
    assert decoded_rows(spark, body) == [{"City": "Lima", "Tonnes": 2}]


def test_unreadable_descriptor_gives_tokens_and_no_rows(spark):
    body = wrap(page(entries_of([("Oslo", 1)]), rt=[[8, 9]]), [{"Value": "G1", "Name": ["Depot", "Tonnes"]}])
    df = decode_pages(responses(spark, [body]))
    r = df.collect()[0]
    assert (r.n_rows, json.loads(r.restart_tokens)) == (0, [[8, 9]])
    assert [(q.pos, q.reason) for q in quarantine(df).collect()] == [(None, "bad_descriptor")]


def test_descriptor_items_without_a_code_are_passed_over(spark):
    select = [None, {"Name": 5}, {"Value": ""}, {"Value": "G1", "Name": "Depot.Tonnes"}]
    assert decoded_rows(spark, wrap(page([{"S": [{"N": "G1"}, {"N": "G8"}], "C": [4, 5]}]), select)) == [{"Tonnes": 4, "G8": 5}]


def test_bodies_of_http_errors_are_not_bad_json(spark):
    df = responses(spark, [depot_page([("Oslo", 1)]), "<html>busy</html>", "{cut", None], status=[200, 503, 200, 200])
    assert [(q.page_no, q.reason) for q in quarantine(decode_pages(df)).collect()] == [(3, "bad_json")]


def test_decode_plan_has_no_shuffle_and_parses_once(spark):
    df = explode_rows(decode_pages(responses(spark, [depot_page([("Oslo", 1), ("Lima", 2)])]))).select("pos", "vals")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # the second one reads masks as text, from bodies that have such masks only;
    # an inferred filter under the explode would repeat the whole decode expression
    assert plan.count("from_json(") <= 2


def test_quarantine_decodes_a_page_once(spark):
    """The filter of the quarantine table does not bring copies of the decode with it."""
    from reportlake.operators.decode import decode_pages, quarantine

    pages = spark.createDataFrame([("r", "m", 1, 200, "{")], "report_key string, module string, page_no int, status int, body string")
    table = quarantine(decode_pages(pages))
    assert [tuple(r) for r in table.collect()] == [("r", "m", 1, None, "bad_json")]
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "from_json" in line]


def test_a_bound_value_is_not_copied_with_each_binding(spark):
    sql = let([("a", "2"), ("b", "a * 3"), ("c", "cast(NULL AS int)")], "named_struct('s', a + b, 'c', c)")
    assert "transform(" not in sql  # it copies its results, which made the decode of a page cost many copies of its rows
    assert spark.sql(f"SELECT {sql} AS r").first().r.asDict() == {"s": 8, "c": None}


def test_cells_beside_null_items_far_indexes_and_short_lists(spark):
    select = [{"Value": "G0", "Name": "t.a", "DN": "D0"}, {"Value": "G1", "Name": "t.b"}, {"Value": "G2", "Name": "t.c"}]
    entries = [
        {"C": [1, None, "x"], "S": [{"N": "G0", "DN": "D0"}, {"N": "G1"}, {"N": "G2"}]},
        {"C": [99999999999], "G1": 7},
        {"C": ["5"], "R": 6},
        {"C": [-1, 1.5], "R": 4},
    ]
    got = decoded_rows(spark, wrap(page(entries, {"D0": ["p", None, "q"]}), select))
    assert got == [{"a": None, "b": None, "c": "x"}, {"a": 99999999999, "b": 7, "c": None},
                   {"a": "5", "b": 7, "c": None}, {"a": -1, "b": 1.5, "c": None}]


def test_a_mask_is_read_once_and_without_a_cast_of_the_variant():
    sql = mask_struct("v", "t").split("ELSE")[1]  # the branch of a BIGINT
    assert "variant_get" not in sql and sql.count("to_json(v)") == 1
