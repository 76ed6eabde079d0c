import json
import os
import random
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reportlake.session import get_session  # noqa: E402

#: Freight depots: four columns, the first through a dictionary.
DEPOT = [
    {"Value": "G0", "Name": "Depot.City", "DN": "D0"},
    {"Value": "G1", "Name": "Depot.Tonnes"},
    {"Value": "G2", "Name": "Depot.Open"},
    {"Value": "G3", "Name": "Depot.Rate"},
]
DEPOT_COLUMNS = ["City", "Tonnes", "Open", "Rate"]


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", **{"spark.sql.shuffle.partitions": "8"})
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="reportlake-test-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


def wrap(ds, select=None):
    """A response body around one DS object."""
    sel = DEPOT if select is None else select
    return json.dumps(
        {"results": [{"result": {"data": {"descriptor": {"Select": sel}, "dsr": {"DS": [ds]}}}}]},
        ensure_ascii=False,
    )


def page(entries, dicts=None, rt=None):
    ds = {"ValueDicts": dicts or {}, "PH": [{"DM0": entries}]}
    if rt is not None:
        ds["RT"] = rt
    return ds


def entries_of(rows, schema=None, seed=None):
    """Entries that decode to ``rows``: nulls as null bits, equal neighbours as repeat bits (at random with a seed)."""
    rnd = random.Random(seed)
    out, before = [], None
    for r in rows:
        repeat = null = 0
        values = []
        for i, v in enumerate(r):
            if before is not None and type(before[i]) is type(v) and before[i] == v and (seed is None or rnd.random() < 0.7):
                repeat |= 1 << i
            elif v is None:
                null |= 1 << i
            else:
                values.append(v)
        e = {"C": values}
        if not out:
            e["S"] = schema or [{"N": f"G{i}"} for i in range(len(r))]
        if repeat:
            e["R"] = repeat
        if null:
            e["Ø"] = null
        out.append(e)
        before = r
    return out


def depot_page(rows, rt=None):
    """A body of depot rows (shorter rows leave out the last columns), city as plain text."""
    return wrap(page(entries_of(rows), rt=rt))


def responses(spark, bodies, status=None):
    """(report_key='r', module=m, page_no=i+1, status, body) rows."""
    rows = []
    for i, b in enumerate(bodies):
        module, page_no, body = b if isinstance(b, tuple) else ("m", i + 1, b)
        st = 200 if status is None else status[i]
        rows.append(("r", module, page_no, st, body))
    return spark.createDataFrame(rows, "report_key string, module string, page_no int, status int, body string")


def decoded_rows(spark, body):
    """Decode one page body -> list of dicts with Python values (JSON-decoded)."""
    from pyspark.sql import functions as F

    from reportlake.operators.decode import decode_pages, explode_rows

    rows = explode_rows(decode_pages(responses(spark, [body]))).select(
        "pos", "cols", F.expr("transform(vals, v -> to_json(v))").alias("v")
    ).orderBy("pos").collect()
    return [
        {c: (None if v is None else json.loads(v)) for c, v in zip(r.cols, r.v)}
        for r in rows
    ]
