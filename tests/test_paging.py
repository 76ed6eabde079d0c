"""Assembly with state, the request frontier and the paging loop."""

import json
import random

import pytest
from conftest import wrap
from pyspark.sql import functions as F

from reportlake.operators.decode import decode_pages, stage_pages
from reportlake.operators.frontier import issue, next_requests, read_ledger
from reportlake.plans.extract import extract
from reportlake.session import scratch_dir
from reportlake.streaming.assembly import Assembly
from reportlake.streaming.incremental import RESPONSES_SCHEMA
from reportlake.streaming.paging import paging_step, start_paging

SELECT = [{"Value": "G0", "Name": "Berth.Code"}, {"Value": "G1", "Name": "Berth.Draught"}]


def body(rows, tokens=None):
    entries = [{"S": [{"N": f"G{i}"} for i in range(len(r))], "C": list(r)} for r in rows]
    return wrap({"PH": [{"DM0": entries}], **({"RT": tokens} if tokens else {})}, SELECT)


def harbour(seed, modules=9):
    """Responses of modules that go on, end, fail, break off, repeat boundary rows, change columns; with gaps."""
    rnd = random.Random(seed)
    out = []
    for m in range(modules):
        last, value = None, 0
        for page in range(1, rnd.randrange(2, 9)):
            rows = []
            for _ in range(rnd.randrange(1, 4)):
                value += 1
                rows.append((value, rnd.choice([value, f"x{value}", None])) if rnd.random() < 0.7 else (value,))
            if last is not None and rnd.random() < 0.6:
                rows.insert(0, last)
            last = rows[-1]
            kind = rnd.random()
            tokens = [[f"'{page}'"]] if kind < 0.9 else None
            status = 200 if kind < 0.85 or kind >= 0.9 else rnd.choice([500, 401, 404])
            text = body(rows, tokens) if rnd.random() < 0.95 else rnd.choice(["{broken", body([])])
            if rnd.random() < 0.9:  # else a gap
                out.append(("port", f"m{m}", page, status, text))
    return out


def facts(result, expected):
    rows = sorted((r.module, r.page_no, r.pos, r.row_json) for r in result.rows.collect())
    schema = sorted((r.module, r.col, tuple(r.first_seen), tuple(sorted(r.variant_types)), r.spark_type) for r in result.schema.collect())
    return rows, schema, sorted(map(tuple, result.status(expected).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_and_order_gives_the_batch_result(spark, seed):
    landed = harbour(seed)
    random.Random(seed).shuffle(landed)
    whole = extract(spark.createDataFrame(landed, RESPONSES_SCHEMA))
    expected = spark.createDataFrame([("port", f"m{m}") for m in range(10)], "report_key string, module string")
    assembly = Assembly(spark, scratch_dir(spark, "assembly"), compact=2)
    size = 1 + len(landed) // 4
    staged = stage_pages(decode_pages(spark.createDataFrame(landed, RESPONSES_SCHEMA), with_types=True))
    keys = [(p[1], p[2]) for p in landed]
    for batch in range(4):
        own = {f"{m}-{p}" for m, p in keys[batch * size:(batch + 1) * size]}
        assembly.advance(staged.where(F.concat_ws("-", "module", "page_no").isin(list(own))), batch)
    result = assembly.result()
    assert facts(result, expected) == facts(whole, expected)
    batch = {(r.module, r.next_page, r.restart_tokens if r.next_page > 1 else None, r.stop_reason) for r in whole.progress().collect() if not r.failed}
    state = {(r.module, r.next_page, r.restart_tokens, r.stop_reason) for r in result.progress.collect() if not r.failed}
    assert batch == state
    for m, *_ in {(p[1],) for p in landed}:
        assert sorted(map(str, result.table("port", m).collect())) == sorted(map(str, whole.table("port", m).collect()))


def staged_of(spark, rows):
    return stage_pages(decode_pages(spark.createDataFrame(rows, RESPONSES_SCHEMA), with_types=True))


def test_each_page_is_read_once(spark):
    pages = [("port", "m", n, 200, body([(n, n)], [["t"]] if n < 12 else None)) for n in range(1, 13)]
    assembly = Assembly(spark, scratch_dir(spark, "assembly"), compact=3)
    for b in range(6):
        assembly.advance(staged_of(spark, pages[2 * b:2 * b + 2]), b)
    assert [(r.new_pages, r.pending_pages, r.used_pages) for r in assembly.commits().orderBy("v").collect()] == [(2, 0, 2)] * 6
    r = assembly.result().progress.first()
    assert (r.next_page, r.done, r.stop_reason, r.n_rows, r.n_pages) == (13, True, "no_tokens", 12, 12)
    assembly.advance(staged_of(spark, pages[:3]), 6)  # pages of an ended module are left aside
    assert assembly.result().rows.count() == 12


def test_a_batch_tried_again_replaces_itself(spark):
    pages = [("port", "m", n, 200, body([(n, n), (n + 1, n + 1)], [["t"]])) for n in range(1, 6)]
    assembly = Assembly(spark, scratch_dir(spark, "assembly"))
    assembly.advance(staged_of(spark, [pages[0], pages[3]]), 0)
    for _ in range(3):
        assembly.advance(staged_of(spark, [pages[1], pages[2]]), 1)
    rows = assembly.result().rows.orderBy("page_no", "pos").collect()
    # The first row of each later page repeats the last of the one before.
    assert [json.loads(r.row_json)["Code"] for r in rows] == [1, 2, 3, 4, 5]
    assert assembly.result().progress.first().next_page == 5


def test_an_error_page_that_lands_again_goes_on(spark):
    assembly = Assembly(spark, scratch_dir(spark, "assembly"))
    assembly.advance(staged_of(spark, [("port", "m", 1, 200, body([(1,)], [["a"]])), ("port", "m", 2, 503, "busy")]), 0)
    assert [(r.status, r.n_rows) for r in assembly.result().status().collect()] == [("partial", 1)]
    assembly.advance(staged_of(spark, [("port", "m", 2, 200, body([(2,)]))]), 1)
    assert [(r.status, r.n_rows) for r in assembly.result().status().collect()] == [("ok", 2)]


def test_a_failed_module_keeps_nothing(spark):
    assembly = Assembly(spark, scratch_dir(spark, "assembly"))
    assembly.advance(staged_of(spark, [("port", "m", 1, 200, body([(1,)], [["a"]])), ("port", "n", 1, 200, body([(1,)]))]), 0)
    assembly.advance(staged_of(spark, [("port", "m", 2, 401, "no")]), 1)
    got = assembly.result()
    assert {r.module for r in got.rows.collect()} == {"n"} and {r.module for r in got.schema.collect()} == {"n"}
    assert {(r.module, r.status, r.n_rows) for r in got.status().collect()} == {("m", "failed", 0), ("n", "ok", 1)}


def test_an_empty_batch(spark):
    assembly = Assembly(spark, scratch_dir(spark, "assembly"))
    assembly.advance(staged_of(spark, []), 0)
    assert assembly.result().rows.count() == 0 and assembly.commits().count() == 1


# --- requests ------------------------------------------------------------------------------------

WINDOW = '{"Query":{"Version":2},"Binding":{"DataReduction":{"DataVolume":3,"Primary":{"Window":{"Count":500}}}}}'
TOP = '{"Query":{"Version":2},"Binding":{"DataReduction":{"Primary":{"Top":{}}}}}'
COMMAND = ("queries", 0, "Query", "Commands", 0, "SemanticQueryDataShapeCommand")


def tables(spark, names, paged=True):
    modules = spark.createDataFrame([("port", n, WINDOW if paged else TOP, paged) for n in names],
                                    "report_key string, name string, query_template string, paginated boolean")
    config = spark.createDataFrame([("port", "d", "r", "v", 5)], "report_key string, dataset_id string, report_id string, visual_id string, model_id bigint")
    return modules, config


def primary(payload):
    at = json.loads(payload)
    for k in COMMAND:
        at = at[k]
    return at["Binding"]["DataReduction"]["Primary"]


def test_one_request_for_each_unfinished_module(spark):
    modules, config = tables(spark, ["new", "open", "done", "failed", "nofirst"])
    pages = [("port", "open", 1, 200, body([(1,)], [["a"]])), ("port", "open", 2, 200, body([(2,)], [["b", "c"]])),
             ("port", "open", 4, 200, body([(4,)], [["z"]])), ("port", "done", 1, 200, body([(1,)])),
             ("port", "failed", 1, 403, ""), ("port", "nofirst", 2, 200, body([(1,)], [["a"]]))]
    progress = extract(spark.createDataFrame(pages, RESPONSES_SCHEMA)).progress()
    got = {r.module: (r.page_no, primary(r.payload)) for r in next_requests(modules, config, progress, page_size=10).collect()}
    first = (1, {"Window": {"Count": 10}})
    assert got == {"new": first, "nofirst": first, "open": (3, {"Window": {"Count": 10, "RestartTokens": [["b", "c"]]}})}


def test_single_shot_modules_ask_once_and_as_captured(spark):
    modules, config = tables(spark, ["a", "b"], paged=False)
    pages = spark.createDataFrame([("port", "a", 1, 200, body([(1,)], [["t"]]))], RESPONSES_SCHEMA)
    progress = extract(pages, modules.withColumnRenamed("name", "module")).progress()
    got = next_requests(modules, config, progress).collect()
    assert [(r.module, r.page_no, primary(r.payload)) for r in got] == [("b", 1, {"Top": {}})]


def test_the_ledger_keeps_requests_from_being_made_twice(spark):
    modules, config = tables(spark, ["a"])
    path = scratch_dir(spark, "ledger")

    def ask(tokens, round_no):
        progress = spark.createDataFrame([("port", "a", 2, tokens, "landing_end")],
                                         "report_key string, module string, next_page int, restart_tokens string, stop_reason string")
        return issue(spark, next_requests(modules, config, progress, read_ledger(spark, path).where(F.col("round") < round_no)), path, round_no).count()

    assert [ask('[["x"]]', 0), ask('[["x"]]', 0), ask('[["x"]]', 1), ask('[["y"]]', 2), ask('[["x"]]', 3)] == [1, 1, 0, 1, 0]


def test_the_loop_reads_a_module_to_its_end(spark):
    modules, config = tables(spark, ["a", "b"])
    root = scratch_dir(spark, "loop")
    assembly = Assembly(spark, f"{root}/assembly")
    served = {"a": 3, "b": 1}
    landed, asked = [], []
    for batch in range(6):
        requests = paging_step(spark, assembly, spark.createDataFrame(landed, RESPONSES_SCHEMA), batch, modules, config, f"{root}/ledger", 10).collect()
        asked.append(len(requests))
        landed = []
        for r in requests:
            tokens = primary(r.payload)["Window"].get("RestartTokens")
            n = 1 if tokens is None else tokens[0][0] + 1  # the service goes by tokens alone
            landed.append(("port", r.module, r.page_no, 200, body([(n,)], [[n]] if n < served[r.module] else None)))
    assert asked == [2, 1, 1, 0, 0, 0]
    rows = assembly.result().rows.collect()
    assert sorted((r.module, json.loads(r.row_json)["Code"]) for r in rows) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    assert {r.status for r in assembly.result().status().collect()} == {"ok"}


def test_paging_as_a_stream(spark):
    modules, config = tables(spark, ["a"])
    root = scratch_dir(spark, "stream")
    for n in (1, 2):
        spark.createDataFrame([("port", "a", n, 200, body([(n,)], [[n]]))], RESPONSES_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/landing")
        start_paging(spark, f"{root}/landing", root, modules, config).awaitTermination()
    ledger = sorted((r.round, r.page_no, r.restart_tokens) for r in read_ledger(spark, f"{root}/ledger").collect())
    assert ledger == [(0, 2, "[[1]]"), (1, 3, "[[2]]")]
