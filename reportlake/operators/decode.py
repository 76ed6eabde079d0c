"""Decode of landed response pages (row-delta "DSR" format) -- ops D1..D15, A2.

One page is one row.  Everything below is a projection over that row built from
built-in higher-order functions, so the decode runs inside the scan tasks with
no shuffle at all; pages are bounded by the service's page size (30,000 rows by
default), so per-row arrays stay small whatever the total data volume.

Sequential rules of the format, and how they are done without a loop:

* mid-page schema ``S`` (D5): the schema index of every entry is built by
  repeating change ``k`` over its span (``array_repeat`` + ``flatten``) --
  linear in the page size for any number of changes; dictionaries are referred
  to by index per (schema, field), never copied per schema;
* repeat bit ``R`` (D7): per field, the entries that do *not* continue a carry
  are run starts; each run start's value is repeated over its run, again with
  ``array_repeat`` + ``flatten``.  A change of schema *length* starts a new run
  for every field (the carry is reset); an equal-length change does not;
* C consumption (D8): the C index of field ``i`` is the number of earlier fields
  with neither repeat nor null bit -- a ``bit_count`` of the two masks;
* truncation (D14): the first malformed entry cuts the page; it is reported in
  ``bad_pos`` / ``bad_reason``.

Deviation V1 (documented): a dictionary is applied once, when a value is first
read; a repeated value is copied as decoded.  The scalar decoder would look a
repeated *integer* up again, which only differs for dictionaries that hold
integers, or after an equal-length schema change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.functions.jsonx import strict_json_ok
from reportlake.session import json_parity
from reportlake.functions.sqlx import (
    LONG_MAX,
    all_bits_set,
    let,
    long_of,
    mask_struct,
    mask_words,
    quoted,
    seq,
    word_bit,
    word_rank,
    words_below,
)

# Typed envelope: only the parts the decoder reads.  Leaves are VARIANT so each
# entry is a small value; parsing the whole body as one VARIANT would fail for
# bodies above the 16 MiB variant limit.
ENVELOPE_DDL = (
    "results array<struct<result:struct<data:struct<"
    "descriptor:struct<Select:array<variant>>,"
    "dsr:struct<DS:array<struct<PH:array<struct<DM0:array<variant>>>,"
    "RT:variant,ValueDicts:map<string,variant>>>>>>>>"
)

# Masks and values as text, read only from bodies that have an integer a VARIANT cannot keep.
TEXT_DDL = (
    "results array<struct<result:struct<data:struct<dsr:struct<DS:array<struct<PH:array<struct<"
    "DM0:array<struct<R:string,`Ø`:string,C:array<string>>>>>>>>>>>>"
)
WIDE_INTEGER = r"[0-9]{39}"

PAGE_KEYS = ("report_key", "module", "page_no")


def _descriptor(data: str) -> str:
    """Usable descriptor items as (code, name, dn)."""
    o = "o"
    item = (
        f"named_struct("
        f"'code', try_variant_get(try_element_at({o}, 'Value'), '$', 'string'), "
        f"'name', CASE WHEN map_contains_key({o}, 'Name') "
        f"THEN element_at(split(try_variant_get(try_element_at({o}, 'Name'), '$', 'string'), '[.]', 2), -1) "
        f"ELSE 'Unknown' END, "
        f"'dn', try_variant_get(try_element_at({o}, 'DN'), '$', 'string'))"
    )
    per_item = let([(o, "try_variant_get(x, '$', 'map<string,variant>')")], item)
    return (
        f"filter(transform(coalesce({data}.descriptor.Select, array()), x -> {per_item}), y -> y.code <> '')"
    )


ENTRY_STRUCT = "struct<S:variant,C:variant,R:variant,`Ø`:variant,X:variant>"


def _descriptor_bad(data: str) -> str:
    """D2 parity: an item the scalar decoder cannot read -- a truthy non-object, or
    an object with a truthy ``Value`` whose ``Name`` is present but not text --
    makes it give up on the whole page (no rows; tokens are kept)."""
    truthy = "(x IS NOT NULL AND NOT is_variant_null(x) AND to_json(x) NOT IN ('false', '0', '\"\"', '[]', '{}', '0.0'))"
    item_bad = let(
        [("o", "try_variant_get(x, '$', 'map<string,variant>')")],
        f"CASE WHEN o IS NULL THEN {truthy} ELSE map_contains_key(o, 'Name') AND coalesce(schema_of_variant(try_element_at(o, 'Name')), 'VOID') <> 'STRING' "
        "AND coalesce(try_variant_get(try_element_at(o, 'Value'), '$', 'string'), '') <> '' END",
    )
    return f"exists(coalesce({data}.descriptor.Select, array()), x -> {item_bad})"


def _exact_values(values: str, texts: str) -> str:
    """The values of an entry; integers of more digits than a VARIANT keeps (they come as doubles) as their text."""
    listed = f"try_variant_get({values}, '$', 'array<variant>')"
    exact = "CASE WHEN s RLIKE '^-?[0-9]{39,}$' AND schema_of_variant(v) = 'DOUBLE' THEN cast(s AS variant) ELSE v END"
    return f"CASE WHEN {texts} IS NULL THEN {listed} ELSE zip_with({listed}, {texts}, (v, s) -> {exact}) END"


def _entries(dm0: str, texts: str) -> str:
    """D3/D4 + parse of every entry's keys (S, C, R, Ø) in one pass over each object.

    The cast to a struct leaves a missing key as SQL NULL and a JSON null as a
    VARIANT null, and gives NULL for an entry that is not an object.  Chained
    ``transform`` calls bind intermediate values as lambda variables.
    """
    s_arr = "try_variant_get(es.S, '$', 'array<map<string,variant>>')"
    s_present = "(es.S IS NOT NULL AND NOT is_variant_null(es.S))"
    stage1 = f"transform({dm0}, e -> try_variant_get(e, '$', '{ENTRY_STRUCT}'))"
    stage2 = (
        f"transform({stage1}, (es, p) -> named_struct('es', es, 'tx', get({texts}, p), "
        f"'sa', CASE WHEN {s_present} THEN {s_arr} END, "
        f"'ca', CASE WHEN es.C IS NOT NULL THEN {_exact_values('es.C', f'get({texts}, p).C')} END, "
        "'rt', CASE WHEN es.R IS NOT NULL THEN schema_of_variant(es.R) END, "
        "'zt', CASE WHEN es.`Ø` IS NOT NULL THEN schema_of_variant(es.`Ø`) END))"
    )
    body = (
        "named_struct("
        "'obj', y.es IS NOT NULL, "
        "'skip', coalesce(y.es.X IS NOT NULL AND y.es.C IS NULL, false), "
        "'s_present', coalesce(y.es.S IS NOT NULL AND NOT is_variant_null(y.es.S), false), "
        "'s_bad', coalesce(y.es.S IS NOT NULL AND NOT is_variant_null(y.es.S) "
        "AND (y.sa IS NULL OR exists(y.sa, f -> f IS NULL)), false), "
        "'s', transform(y.sa, f -> named_struct("
        "'N', try_variant_get(try_element_at(f, 'N'), '$', 'string'), "
        "'DN', try_variant_get(try_element_at(f, 'DN'), '$', 'string'))), "
        f"'r', {mask_struct('y.es.R', 'y.rt', 'y.tx.R')}, "
        f"'z', {mask_struct('y.es.`Ø`', 'y.zt', 'y.tx.`Ø`')}, "
        # JSON nulls become SQL NULL here, once a value
        "'c', coalesce(transform(y.ca, v -> CASE WHEN is_variant_null(v) THEN NULL ELSE v END), array()), "
        "'c_bad', coalesce(y.es.C IS NOT NULL AND y.ca IS NULL, false))"
    )
    return f"transform({stage2}, y -> {body})"


def _dict_key(f: str, i: str) -> str:
    """Which value dictionary an integer cell of field ``f`` (position i) uses."""
    has = lambda k: f"coalesce(map_contains_key(g.dicts, {k}), false)"
    dflt_key = f"concat('D', cast({i} AS string))"
    return (
        f"CASE WHEN coalesce({f}.DN, '') <> '' AND {has(f + '.DN')} THEN {f}.DN "
        f"WHEN {f}.N IS NOT NULL AND {has(f + '.N')} THEN {f}.N "
        f"WHEN startswith({f}.N, 'G') THEN concat('D', substr({f}.N, 2)) "
        f"WHEN {has(dflt_key)} THEN {dflt_key} END"
    )


def _guessed(f: str, i: str) -> str:
    """V2: field ``f`` (position i) reads a dictionary that neither its DN nor its code names."""
    has = lambda k: f"coalesce(map_contains_key(g.dicts, {k}), false)"
    named = f"coalesce({f}.DN, '') <> '' AND {has(f + '.DN')} OR {f}.N IS NOT NULL AND {has(f + '.N')}"
    return f"NOT ({named}) AND coalesce({has(_dict_key(f, i))}, false)"


def _raw(x: str, i: str, words: str | None = None) -> str:
    """The value field i of emitted entry x reads (NULL for repeat,
    null bit, missing or JSON null), before dictionaries.  Without ``words`` all masks of the
    page fit one 63-bit word (pages of at most 63 fields), so simpler bit tests do, with ``b`` the
    bit of field i.  Only a ``short`` entry has fields that C does not reach."""
    f = f"get(get(h.schemas, {x}.sidx + 1), {i})"
    if words is None:
        taken = f"({x}.tk & b) <> 0L"
        rank = f"{i} - bit_count({x}.tk & (b - 1L))"
    else:
        taken = word_bit(f"{words}.tw", i)
        rank = word_rank(f"{words}.tw", f"{words}.tb", i)
    direct = f"try_element_at(try_variant_get(get(g.dm0, {x}.p), '$', 'map<string,variant>'), {f}.N)"
    return (
        f"CASE WHEN {i} >= {x}.L OR {taken} THEN NULL "
        f"WHEN NOT {x}.short OR {rank} < size({x}.c) THEN get({x}.c, {rank}) "
        f"WHEN {f}.N IS NOT NULL THEN CASE WHEN is_variant_null({direct}) THEN NULL ELSE {direct} END END"
    )


def _resolve(x: str, v: str) -> str:
    """An integer cell through its field's dictionary; ``sd`` is the field's dictionary by schema.

    A null dictionary item stays a VARIANT null here (``unnulled`` takes it out), so an index out of
    range is told by the NULL of ``get``.
    """
    d = f"get(dvals, get(sd, {x}.sidx + 1))"
    return (
        f"CASE WHEN {v} IS NULL OR {d} IS NULL OR schema_of_variant({v}) <> 'BIGINT' THEN {v} "
        f"ELSE coalesce(get({d}, {long_of(v, 'int')}), {v}) END"
    )


def decode_pages(responses: DataFrame, body_col: str = "body", keep: tuple[str, ...] | None = None,
                 with_types: bool = False) -> DataFrame:
    """Decode every page of ``responses`` into a page-level row.

    Output columns (besides the input columns in ``keep``, default all but body):
    ``n_entries`` entries in DM0, ``n_rows`` decoded rows, ``n_skipped`` matrix entries
    passed over (D4), ``n_guessed`` fields of its schemas that read a dictionary neither
    their DN nor their code names (V2), ``bad_pos`` /
    ``bad_reason`` first malformed entry (D14), ``bad_json`` body unreadable
    (A2), ``envelope_ok``, ``restart_tokens`` JSON text (D15), ``has_tokens``
    (Python truthiness), ``schemas`` per-schema column names (deduplicated,
    first position kept), ``schema_fields`` per schema the field index each of
    those names reads (the last field of a repeated name), ``rows``
    array<struct<pos, sidx, vals>> where
    ``vals`` line up with ``schemas[sidx]``, and ``first_key`` / ``last_key``
    canonical JSON of the first and last row (for the page-boundary rule).
    ``with_types`` adds ``field_types``, per field the (schema, VARIANT type)
    pairs of its values, needed by ``stage_pages`` (it costs a type probe per
    cell, so plain decoding leaves it out).
    """
    json_parity(responses.sparkSession)
    if keep is None:
        keep = tuple(c for c in responses.columns if c != body_col)
    env = F.from_json(F.col(body_col), ENVELOPE_DDL)
    texts = F.when(F.col(body_col).rlike(WIDE_INTEGER), F.expr(
        f"get(get(get(from_json({quoted(body_col)}, '{TEXT_DDL}').results, 0).result.data.dsr.DS, 0).PH, 0).DM0"))
    df = responses.select(*keep, env.alias("_env"), F.col(body_col), F.col(body_col).isNull().alias("_nobody"), texts.alias("_texts"))
    df = df.select(
        *keep,
        F.expr("get(_env.results, 0).result.data").alias("_data"),
        (~F.col("_nobody") & ~strict_json_ok(F.col(body_col))).alias("bad_json"),
        "_texts",
    ).select(*keep, "bad_json", "_data", F.expr("get(_data.dsr.DS, 0)").alias("_ds"), "_texts")

    # stage g: descriptor, entries, dictionaries
    g = (
        "named_struct("
        f"'sel', {_descriptor('_data')}, "
        f"'desc_bad', coalesce({_descriptor_bad('_data')}, false), "
        "'dicts', coalesce(_ds.ValueDicts, map()), "
        "'dnames', map_keys(coalesce(_ds.ValueDicts, map())), "
        # a text as dictionary is looked up by character; other dictionaries that are no array read as NULL
        "'dvals', transform(map_values(coalesce(_ds.ValueDicts, map())), d -> CASE WHEN schema_of_variant(d) = 'STRING' "
        "THEN transform(filter(split(variant_get(d, '$', 'string'), ''), c -> c <> ''), c -> cast(c AS variant)) "
        "ELSE try_variant_get(d, '$', 'array<variant>') END), "
        # from 0 up to here a look-up fails (V3): objects by their size, numbers and booleans always, others never
        "'dlim', transform(map_values(coalesce(_ds.ValueDicts, map())), d -> CASE "
        "WHEN d IS NULL OR is_variant_null(d) OR schema_of_variant(d) = 'STRING' OR startswith(schema_of_variant(d), 'ARRAY') THEN 0L "
        "WHEN startswith(schema_of_variant(d), 'OBJECT') THEN cast(size(try_variant_get(d, '$', 'map<string,variant>')) AS bigint) "
        "ELSE 9223372036854775807L END), "
        "'dm0', coalesce(get(_ds.PH, 0).DM0, array()), "
        "'ents', " + _entries("coalesce(get(_ds.PH, 0).DM0, array())", "_texts") + ", "
        "'n_all', coalesce(size(get(_ds.PH, 0).DM0), 0))"
    )
    df = df.select(
        *keep,
        "bad_json",
        (F.col("_ds").isNotNull()).alias("envelope_ok"),
        F.expr("to_json(_ds.RT)").alias("restart_tokens"),
        F.expr(g).alias("_g"),
    )

    # stage h: schema changes, schema per entry, first bad entry, emitted entries
    dflt = "transform(g.sel, x -> named_struct('N', x.code, 'DN', x.dn))"
    pre_bad = (
        "coalesce(array_position(transform(g.ents, x -> NOT x.obj OR (NOT x.skip AND x.s_bad)), true) - 1, -1)"
    )
    changes = (
        "transform(ch0, (c, k) -> named_struct('p', c.p, 's', c.s, "
        "'reset', size(c.s) <> coalesce(size(get(ch0, k - 1).s), size(dflt))))"
    )
    sidx = (
        "concat(array_repeat(-1, coalesce(get(ch, 0).p, g.n_all)), "
        "flatten(transform(ch, (c, k) -> array_repeat(k, coalesce(get(ch, k + 1).p, g.n_all) - c.p))))"
    )
    name_of = "coalesce(try_element_at(filter(g.sel, y -> y.code = f.N), -1).name, f.N, '')"
    scols = (
        "transform(schemas, s -> " + let(
            [("nm", f"transform(s, f -> {name_of})")],
            "named_struct('names', array_distinct(nm), "
            "'idx', transform(array_distinct(nm), c -> size(nm) - array_position(reverse(nm), c)))",
        ) + ")"
    )
    dkeys = "transform(schemas, s -> transform(s, (f, i) -> " + _dict_key("f", "i") + "))"

    def full_bad(n: str) -> str:
        return "NOT x.r.ok OR x.c_bad OR (NOT x.z.ok AND NOT " + all_bits_set("x.r", n) + ")"

    L = "get(ls, p)"
    flags = (
        "transform(g.ents, (x, p) -> named_struct('p', p, 'sidx', get(sidx, p), 'L', " + L + ", 'skip', x.skip, "
        "'reset', x.s_present AND NOT x.skip AND coalesce(get(ch, get(sidx, p)).reset, false), "
        f"'bad', p < pre_bad AND NOT x.skip AND {L} > 0 AND ({full_bad(L)}), "
        "'rl', x.r.lo, 'tk', x.r.lo | x.z.lo, 'c', x.c))"
    )
    # tk: fields that read no value; k: fields that go on with the value above; short: C ends before the last field
    emitted = (
        "transform(filter(wl, x -> NOT g.desc_bad AND x.p < first_bad AND NOT x.skip AND x.L > 0), (x, q) -> named_struct("
        "'p', x.p, 'sidx', x.sidx, 'L', x.L, 'reset', x.reset, 'tk', x.tk, 'k', CASE WHEN q = 0 OR x.reset THEN 0L ELSE x.rl END, "
        "'short', x.L > 63 OR size(x.c) + bit_count(x.tk & (CASE WHEN x.L >= 63 THEN " + LONG_MAX + " ELSE shiftleft(1L, x.L) - 1L END)) < x.L, 'c', x.c))"
    )
    # pages with a schema of more than 63 fields: masks as words, beside the emitted entries
    widened = let(
        [("y", "get(g.ents, x.p)"), ("rw", mask_words("y.r", "nmax")), ("tw", f"zip_with(rw, {mask_words('y.z', 'nmax')}, (a, b) -> a | b)")],
        f"named_struct('rw', rw, 'tw', tw, 'tb', {words_below('tw')})",
    )
    h = let(
        [
            ("dflt", dflt),
            ("pre_bad0", pre_bad),
            ("pre_bad", "CASE WHEN pre_bad0 < 0 THEN g.n_all ELSE pre_bad0 END"),
            ("ch0", "transform(filter(" + seq("cast(pre_bad AS int)") + ", p -> get(g.ents, p).s_present AND NOT get(g.ents, p).skip), "
             "p -> named_struct('p', p, 's', get(g.ents, p).s))"),
            ("ch", changes),
            ("sidx", sidx),
            ("schemas", "concat(array(dflt), transform(ch, c -> c.s))"),
            ("lens", "transform(schemas, s -> size(s))"),
            ("nmax", "coalesce(array_max(lens), 0)"),
            ("ls", "transform(sidx, s -> get(lens, s + 1))"),
            ("wl", flags),
            ("fb0", "array_position(transform(wl, x -> x.bad), true)"),
            ("first_bad", "least(pre_bad, CASE WHEN fb0 > 0 THEN fb0 - 1 ELSE g.n_all END)"),
            ("em", emitted),
        ],
        "named_struct('schemas', schemas, 'scols', " + scols + ", "
        # per (schema, field): index of its dictionary in the page's list (-1: none);
        # indexes, not copies, so many schema changes do not copy dictionaries
        "'sdidx', CASE WHEN size(g.dnames) = 0 THEN transform(schemas, s -> array_repeat(-1, size(s))) "
        "ELSE transform(" + dkeys + ", ks -> transform(ks, k -> coalesce(array_position(g.dnames, k), 0) - 1)) END, "
        "'first_bad', CASE WHEN first_bad < g.n_all THEN first_bad END, "
        "'skipped', size(filter(wl, x -> x.skip AND x.p < first_bad)), "
        "'guessed', CASE WHEN size(g.dnames) = 0 THEN 0 ELSE aggregate(transform(schemas, s -> size(filter(transform(s, (f, i) -> " + _guessed("f", "i") + "), y -> y))), 0, (a, n) -> a + n) END, "
        "'why', " + let([("x", "get(g.ents, first_bad)")],
                        "CASE WHEN g.desc_bad THEN 'bad_descriptor' WHEN x IS NULL THEN NULL "
                        "WHEN NOT x.obj THEN 'entry_not_object' "
                        "WHEN x.s_bad THEN 'bad_schema' WHEN NOT x.r.ok THEN 'bad_repeat_mask' "
                        "WHEN x.c_bad THEN 'bad_values' WHEN NOT x.z.ok THEN 'bad_null_mask' END") + ", "
        "'em', em, 'wm', transform(CASE WHEN nmax > 63 THEN em ELSE slice(em, 1, 0) END, x -> " + widened + "))",
    )
    df = df.select(
        *keep, "bad_json", "envelope_ok", "restart_tokens", "_g",
        F.expr(let([("g", "_g")], h)).alias("_h"),
    )

    # stage values: per field, raw values -> dictionary -> carry; then rows
    def raw(narrow: bool) -> str:
        return "transform(em, x -> " + _raw("x", "i") + ")" if narrow else "transform(em, (x, q) -> " + _raw("x", "i", "get(h.wm, q)") + ")"

    def carried(narrow: bool, with_types: bool) -> str:
        if narrow:
            starts = "filter(" + seq("n") + ", q -> (get(em, q).k & b) = 0L)"
        else:
            starts = "filter(" + seq("n") + ", q -> NOT (q > 0 AND NOT get(em, q).reset AND " + word_bit("get(h.wm, q).rw", "i") + "))"
        run_carry = let(
            [("st", starts)],
            "flatten(transform(st, (s, k) -> array_repeat(get(res, s), coalesce(get(st, k + 1), n) - s)))",
        )
        # fields without a dictionary in any schema of the page are taken as they are
        looked = "zip_with(em, " + raw(narrow) + ", (x, v) -> " + _resolve("x", "v") + ")"
        unnulled = f"CASE WHEN dnull THEN transform({looked}, v -> CASE WHEN is_variant_null(v) THEN NULL ELSE v END) ELSE {looked} END"
        any_r = "(kany & b) <> 0L" if narrow else word_bit("wany", "i")
        # (schema, VARIANT type) pairs of the field's own values: the carry only
        # copies these values, so they are the types of all its cells (E8 input).
        # They are told apart as texts, which are hashed; structs would be compared one by one.
        types = (
            "transform(filter(array_distinct(zip_with(em, res, (x, v) -> CASE WHEN v IS NOT NULL THEN "
            "concat(x.sidx, ' ', schema_of_variant(v)) END)), y -> y IS NOT NULL), "
            "y -> named_struct('s', cast(substring_index(y, ' ', 1) AS int), 't', substr(y, instr(y, ' ') + 1)))"
            if with_types else None
        )
        return (
            "transform(" + seq("nf") + ", i -> " + let(
                [
                    ("b", "shiftleft(1L, i)"),
                    ("sd", "transform(h.sdidx, ds -> get(ds, i))"),
                    ("res", f"CASE WHEN exists(sd, k -> k >= 0) THEN {unnulled} ELSE {raw(narrow)} END"),
                ],
                # a field with no repeat bit anywhere in the page needs no carry pass
                (f"named_struct('v', CASE WHEN {any_r} THEN {run_carry} ELSE res END, 't', {types})"
                 if with_types else f"named_struct('v', CASE WHEN {any_r} THEN {run_carry} ELSE res END)"),
            ) + ")"
        )

    # V3: the first emitted entry with an integer whose dictionary is there but cannot be looked up
    def refused(narrow: bool) -> str:
        fails = (
            "CASE WHEN v IS NOT NULL AND schema_of_variant(v) = 'BIGINT' AND variant_get(v, '$', 'bigint') >= 0 AND variant_get(v, '$', 'bigint') < "
            "coalesce(get(g.dlim, get(get(h.sdidx, get(h.em, q).sidx + 1), i)), 0L) THEN q END"
        )
        return f"array_min(transform({seq('nf')}, i -> {let([('b', 'shiftleft(1L, i)')], f'array_min(transform({raw(narrow)}, (v, q) -> {fails}))')}))"

    rows = (
        "transform(em, (x, q) -> named_struct('pos', q, 'sidx', x.sidx, "
        "'vals', transform(get(idx, x.sidx + 1), j -> get(get(cv, j), q))))"
    )
    suspect = "exists(g.dlim, d -> d > 0)"
    cut = let([("em", "h.em")], f"CASE WHEN nf <= 63 THEN {refused(True)} ELSE {refused(False)} END")
    vals = let(
        [
            ("g", "_g"),
            ("h", "_h"),
            ("nf", "coalesce(array_max(transform(h.em, x -> x.L)), 0)"),
            ("em", f"CASE WHEN {suspect} THEN slice(h.em, 1, coalesce({cut}, size(h.em))) ELSE h.em END"),
            ("n", "size(em)"),
            ("kany", "aggregate(em, 0L, (a, x) -> a | x.k)"),
            ("wany", "aggregate(h.wm, cast(array() AS array<bigint>), (a, x) -> zip_with(a, x.rw, (p, q) -> coalesce(p, 0L) | coalesce(q, 0L)))"),
            ("dvals", "g.dvals"),
            ("dnull", "exists(dvals, d -> exists(d, v -> is_variant_null(v)))"),
            ("idx", "transform(h.scols, s -> s.idx)"),
            ("cvs", f"CASE WHEN nf <= 63 THEN {carried(True, with_types)} ELSE {carried(False, with_types)} END"),
            ("cv", "transform(cvs, c -> c.v)"),
        ],
        ("named_struct('rows', " + rows + ", 'ftypes', transform(cvs, c -> c.t))") if with_types else rows,
    )
    df = df.select(
        *keep, "bad_json", "envelope_ok", "restart_tokens",
        F.expr("_g.n_all").alias("n_entries"),
        F.expr("_h.skipped").alias("n_skipped"),
        F.expr("_h.guessed").alias("n_guessed"),
        F.expr("_h.first_bad").alias("_bad_pos"),
        F.expr("_h.why").alias("_why"),
        F.expr("CASE WHEN exists(_g.dlim, d -> d > 0) THEN transform(_h.em, x -> x.p) END").alias("_places"),
        F.expr("transform(_h.scols, s -> s.names)").alias("schemas"),
        F.expr("transform(_h.scols, s -> s.idx)").alias("schema_fields"),
        F.expr(vals).alias("_v"),
    )
    if with_types:
        rows_col, types_col = F.col("_v.rows"), F.col("_v.ftypes")
    else:
        # no wrapper struct: the rows array is not copied by an extra projection
        rows_col, types_col = F.col("_v"), F.lit(None).cast("array<array<struct<s:int,t:string>>>")
    refused_at = F.get("_places", F.size(rows_col))  # an entry was left out: its dictionary cannot be looked up
    df = df.select(
        *keep, "bad_json", "envelope_ok", "restart_tokens", "n_entries", "n_skipped", "n_guessed",
        F.coalesce(refused_at, "_bad_pos").alias("bad_pos"),
        F.when(refused_at.isNotNull(), F.lit("bad_dictionary")).otherwise(F.col("_why")).alias("bad_reason"),
        "schemas", "schema_fields", rows_col.alias("rows"), types_col.alias("field_types"),
    )
    has_tokens = (
        "restart_tokens IS NOT NULL AND restart_tokens NOT IN "
        "('null', '[]', '{}', '\"\"', '0', 'false', '0.0')"
    )
    return df.select(
        *keep, "bad_json", "envelope_ok", "restart_tokens",
        F.expr(has_tokens).alias("has_tokens"),
        "n_entries", "n_skipped", "n_guessed", "bad_pos", "bad_reason", "schemas", "schema_fields", "field_types", "rows",
        F.size("rows").alias("n_rows"),
        F.expr(_row_key("get(rows, 0)")).alias("first_key"),
        F.expr(_row_key("get(rows, size(rows) - 1)")).alias("last_key"),
    )


def _row_key(row: str) -> str:
    """Canonical text of a decoded row: key-sorted (name, JSON value) pairs.

    Equal dicts in the scalar decoder (key order ignored) give equal keys.
    """
    return (
        f"CASE WHEN {row} IS NULL THEN NULL ELSE to_json(sort_array(zip_with("
        f"get(schemas, {row}.sidx + 1), {row}.vals, "
        "(c, v) -> named_struct('k', c, 'v', coalesce(to_json(v), 'null'))))) END"
    )


def explode_rows(decoded: DataFrame, keys: tuple[str, ...] = PAGE_KEYS) -> DataFrame:
    """One output row per decoded row: ``keys``, pos, cols, vals (still VARIANT)."""
    # explode_outer + explicit filter: a plain explode makes the optimizer infer
    # ``size(rows) > 0`` below it, which would inline (recompute) the whole decode.
    exploded = decoded.select(*keys, "schemas", F.explode_outer("rows").alias("_r"))
    return exploded.where(F.col("_r").isNotNull()).select(
        *keys,
        F.col("_r.pos").alias("pos"),
        F.expr("get(schemas, _r.sidx + 1)").alias("cols"),
        F.col("_r.vals").alias("vals"),
    )


def explode_cells(rows: DataFrame, keys: tuple[str, ...] = PAGE_KEYS) -> DataFrame:
    """Long form: one row per (row, field) with column name and VARIANT value."""
    return rows.select(
        *keys, "pos", F.posexplode_outer(F.arrays_zip("cols", "vals")).alias("field_idx", "_c")
    ).where(F.col("_c").isNotNull()).select(*keys, "pos", "field_idx", F.col("_c.cols").alias("col"), F.col("_c.vals").alias("value"))


def value_of(col_name: str, spark_type: str = "string") -> Column:
    """Typed value of a named column of an exploded row (NULL when the row lacks it)."""
    return F.expr(
        f"try_variant_get(get(vals, array_position(cols, '{col_name}') - 1), '$', '{spark_type}')"
    )


def quarantine(decoded: DataFrame, keys: tuple[str, ...] = PAGE_KEYS) -> DataFrame:
    """Pages cut by a malformed entry, with an unreadable descriptor (no position),
    or whose body is not JSON (reason, position).  The body of a page that came with an
    HTTP error is no response and is not reported here."""
    if "status" in decoded.columns:
        decoded = decoded.where("status IS NULL OR status BETWEEN 200 AND 299")
    # explode_outer, as in explode_rows: a filter on the facts themselves would be moved below the decode,
    # with a copy of the decode in place of each of them.
    reason = F.when(F.col("bad_json"), F.lit("bad_json")).otherwise(F.col("bad_reason"))
    found = F.when(F.expr("bad_json OR bad_pos IS NOT NULL OR bad_reason IS NOT NULL"),
                   F.array(F.struct(F.col("bad_pos").alias("pos"), reason.alias("reason"))))
    return decoded.select(*keys, F.explode_outer(found).alias("_q")).where(F.col("_q").isNotNull()).select(*keys, "_q.pos", "_q.reason")


def stage_pages(decoded: DataFrame, keys: tuple[str, ...] = PAGE_KEYS) -> DataFrame:
    """Decoded pages in a compact, storable form (one row per page).

    ``rows_json`` one JSON object per decoded row (deduplicated names, nulls as
    ``null``) -- typed later by ``from_json`` with the module's inferred schema;
    ``col_types`` per column of the page: its page-local first-seen ordinal ``k``
    and the set of VARIANT types of its non-null values (input to E8, taken from
    the per-field type sets the decode computed); plus the page facts the
    assembly rules need.  Everything is computed inside the page.
    """
    if "field_types" not in decoded.columns:
        raise ValueError("stage_pages needs decode_pages(..., with_types=True)")
    meta = [c for c in decoded.columns if c not in ("schemas", "rows", "schema_fields", "field_types")]
    rows_json = "transform(rows, r -> to_json(map_from_arrays(get(schemas, r.sidx + 1), r.vals)))"
    used = "array_distinct(transform(rows, r -> r.sidx))"
    order = f"array_distinct(flatten(transform({used}, s -> get(schemas, s + 1))))"
    # a column's types: for each schema the page's rows use, the (schema, type)
    # pairs of the field that holds the column in that schema
    types_of = (
        "array_distinct(flatten(transform(us, s -> " + let(
            [("j", "coalesce(array_position(get(schemas, s + 1), c), 0) - 1")],
            "CASE WHEN j < 0 THEN array() ELSE transform(filter(get(field_types, get(get(schema_fields, s + 1), j)), "
            "y -> y.s = s), y -> y.t) END",
        ) + ")))"
    )
    col_types = let(
        [("us", used), ("ord", order)],
        f"transform(ord, (c, k) -> named_struct('col', c, 'k', k, 'types', {types_of}))",
    )
    return decoded.select(*meta, F.expr(col_types).alias("col_types"), F.expr(rows_json).alias("rows_json"))

