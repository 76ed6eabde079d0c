"""Encoder: turn rows of a table into landed response pages (stand-in input).

This is the inverse of the decoder and exists to build inputs from the driver
tables for checks, tests and the benchmark.  It writes values the way the
service does -- page-local value dictionaries, ``R`` bits for repeated values,
``Ø`` bits for nulls, values consumed in order from ``C`` -- and does none of
the decoder's work.

Pages are groups of at most a bounded number of rows (the caller's page key
must bound them, as the service's page size does); all work is one window and
one ``groupBy`` on the page key, which share a single shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.functions.sqlx import json_string, json_value


@dataclass(frozen=True)
class Field:
    """One encoded column.

    code      field code (``M0``, ``G1`` ...)
    name      descriptor name (``Table.Column``)
    value     SQL expression over the input row
    dn        name of a page-local value dictionary (or None: value written as is)
    repeat    SQL boolean: write an ``R`` bit instead of the value.  ``"auto"``:
              when the value equals the previous row's value in the page.
    code_dict the dictionary is named by the field code and no DN is written
    override  SQL integer written instead of the dictionary index when not null
    """

    code: str
    name: str
    value: str
    dn: str | None = None
    repeat: str | None = "auto"
    code_dict: bool = False
    override: str | None = None

    @property
    def dict_name(self) -> str | None:
        return self.code if self.code_dict else self.dn


def descriptor_json(fields: list[Field]) -> str:
    items = []
    for f in fields:
        item = {"Value": f.code, "Name": f.name}
        if f.dn and not f.code_dict:
            item["DN"] = f.dn
        items.append(item)
    import json

    return json.dumps({"Select": items}, ensure_ascii=False)


def schema_json(fields: list[Field]) -> str:
    import json

    return json.dumps(
        [{"N": f.code, **({"DN": f.dn} if f.dn and not f.code_dict else {})} for f in fields], ensure_ascii=False
    )


def encode_entries(
    df: DataFrame,
    page_keys: list[str],
    order_by: list[str],
    fields: list[Field],
    schema_on_first: bool = True,
) -> DataFrame:
    """Rows -> (page keys, order columns, ``_rn``, ``entry`` JSON text, ``dicts`` JSON text).

    ``_rn`` is the row's position in its page from the same window that sets
    the repeat bits, so pages must be assembled in ``_rn`` order (ties of
    ``order_by`` are broken once, consistently).
    """
    w_page = Window.partitionBy(*page_keys)
    w_ord = w_page.orderBy(*order_by)
    cols = {f"_v{i}": F.expr(f.value) for i, f in enumerate(fields)}
    base = df.select(
        *page_keys, *[c for c in order_by if c not in page_keys], *[v.alias(k) for k, v in cols.items()],
        *[F.expr(f.override).alias(f"_o{i}") for i, f in enumerate(fields) if f.override],
    )
    exprs = []
    for i, f in enumerate(fields):
        v = F.col(f"_v{i}")
        if f.repeat == "auto":
            prev = F.lag(v).over(w_ord)
            rep = prev.isNotNull() & v.isNotNull() & (prev == v)
        elif f.repeat is None:
            rep = F.lit(False)
        else:
            rep = F.expr(f.repeat)
        exprs.append(rep.alias(f"_r{i}"))
        if f.dict_name:
            exprs.append(F.array_sort(F.collect_set(v).over(w_page)).alias(f"_d{i}"))
    exprs.append(F.row_number().over(w_ord).alias("_rn"))
    staged = base.select("*", *exprs)

    c_items, r_terms, z_terms = [], [], []
    for i, f in enumerate(fields):
        v, r = f"_v{i}", f"_r{i}"
        if f.dict_name:
            text = f"cast(array_position(_d{i}, {v}) - 1 AS string)"
            if f.override:
                text = f"coalesce(cast(_o{i} AS string), {text})"
        else:
            text = json_value(v)
        c_items.append(f"CASE WHEN NOT {r} AND {v} IS NOT NULL THEN {text} END")
        r_terms.append(f"CASE WHEN {r} THEN {1 << i} ELSE 0 END")
        z_terms.append(f"CASE WHEN NOT {r} AND {v} IS NULL THEN {1 << i} ELSE 0 END")
    r_sum = " + ".join(r_terms) if r_terms else "0"
    z_sum = " + ".join(z_terms) if z_terms else "0"
    s_text = schema_json(fields).replace("'", "\\'")
    entry = (
        "concat('{', "
        f"CASE WHEN {str(schema_on_first).lower()} AND _rn = 1 THEN '\"S\":{s_text},' ELSE '' END, "
        f"'\"C\":[', concat_ws(',', {', '.join(c_items)}), ']', "
        f"CASE WHEN ({r_sum}) > 0 THEN concat(',\"R\":', cast(({r_sum}) AS string)) ELSE '' END, "
        f"CASE WHEN ({z_sum}) > 0 THEN concat(',\"Ø\":', cast(({z_sum}) AS string)) ELSE '' END, "
        "'}')"
    )
    dict_parts = [
        f"concat({json_string(repr(f.dict_name))}, ':', to_json(_d{i}))" for i, f in enumerate(fields) if f.dict_name
    ]
    dicts = f"concat('{{', concat_ws(',', {', '.join(dict_parts)}), '}}')" if dict_parts else "'{}'"
    return staged.select(
        *page_keys,
        *[c for c in order_by if c not in page_keys],
        "_rn",
        F.expr(entry).alias("entry"),
        F.expr(dicts).alias("dicts"),
    )


def build_pages(
    entries: DataFrame,
    page_keys: list[str],
    order_by: list[str],
    descriptor: str | Column,
    rt: Column | None = None,
    dicts_col: str | None = "dicts",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Group entries into one response body per page.

    ``descriptor`` JSON text of ``{"Select": [...]}`` (literal or per-page
    column); ``rt`` optional restart-token JSON per page (aggregate expression
    over the page's rows, or ``None`` for no tokens); ``extra`` more page-level
    aggregate columns to keep.
    """
    desc = F.lit(descriptor) if isinstance(descriptor, str) else descriptor
    aggs = [
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order_by], F.col("entry")))).alias("_e"),
        F.first(desc, ignorenulls=True).alias("_desc"),
    ]
    if dicts_col:
        aggs.append(F.first(dicts_col, ignorenulls=True).alias("_dicts"))
    if rt is not None:
        aggs.append(rt.alias("_rt"))
    for k, v in (extra or {}).items():
        aggs.append(v.alias(k))
    pages = entries.groupBy(*page_keys).agg(*aggs)
    dm0 = F.concat(F.lit("["), F.array_join(F.expr("transform(_e, x -> x.entry)"), ","), F.lit("]"))
    ds_parts = [F.lit('{"PH":[{"DM0":'), dm0, F.lit("}]")]
    if dicts_col:
        ds_parts += [F.lit(',"ValueDicts":'), F.coalesce(F.col("_dicts"), F.lit("{}"))]
    if rt is not None:
        ds_parts += [F.when(F.col("_rt").isNotNull(), F.concat(F.lit(',"RT":'), F.col("_rt"))).otherwise(F.lit(""))]
    ds_parts.append(F.lit("}"))
    body = F.concat(
        F.lit('{"results":[{"result":{"data":{"descriptor":'),
        F.col("_desc"),
        F.lit(',"dsr":{"DS":['),
        F.concat(*ds_parts),
        F.lit("]}}}}]}"),
    )
    return pages.select(*page_keys, *(extra or {}).keys(), body.alias("body"))


def encode_table(
    df: DataFrame,
    page_keys: list[str],
    order_by: list[str],
    fields: list[Field],
    rt: Column | None = None,
) -> DataFrame:
    """Rows -> one response body per page, with a literal descriptor."""
    entries = encode_entries(df, page_keys, order_by, fields)
    return build_pages(entries, page_keys, ["_rn"], descriptor_json(fields), rt=rt)
