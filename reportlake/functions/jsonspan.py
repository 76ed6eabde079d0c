"""Where a value stands in a JSON text, so it can be taken out or replaced byte by byte.

Parsing and writing again changes a text (``2.50`` becomes ``2.5``, keys move, escapes
are resolved).  Here the text is cut into tokens by one regular expression, and one fold
over the tokens follows a path of keys and indexes and notes the character offsets of the
value on every level of it.  Of repeated keys the last one counts.  The text must be
valid JSON (``jsonx.strict_json_ok``); for other texts the offsets mean nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportlake.functions.sqlx import let

#: Strings, punctuation, other words, runs of white space: together they cover a text.
#: Possessive throughout, so a long string costs no stack.
TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},:]|[^\s\[\]{},:"]++|\s++'

#: A value that counts as false.
FALSY = r'^(?:\{\s*\}|\[\s*\]|""|null|false|-?0(?:\.0+)?(?:[eE][+-]?[0-9]+)?)$'


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _key(token: str) -> str:
    """The text of a string token."""
    return f"CASE WHEN instr({token}, '\\\\') > 0 THEN get(from_json(concat('[', {token}, ']'), 'array<string>'), 0) ELSE substr({token}, 2, length({token}) - 2) END"


def spans(text: str, path: Sequence[str | int]) -> str:
    """SQL: struct (s, e) of arrays, the start (from 0) and end of the value on each level of ``path``; -1 where there is none."""
    n = len(path)
    keys = "array(" + ", ".join(_quoted(p) if isinstance(p, str) else "cast(null AS string)" for p in path) + ")"
    places = "array(" + ", ".join(str(p) if isinstance(p, int) else "cast(null AS int)" for p in path) + ")"
    none = f"array_repeat(-1, {n})"
    start = (f"named_struct('at', 0, 'depth', 0, 'm', 0, 'arr', false, 'key', cast(null AS string), 'has', false, 'idx', 0, 's', {none}, 'e', {none})")
    # Flags of a token: the container that the path has led to is open around it; it begins a value there, and that of the next step.
    flags = [
        ("c", "substr(t, 1, 1)"),
        ("opens", "c = '{' OR c = '['"),
        ("closes", "c = '}' OR c = ']'"),
        ("active", f"a.depth = a.m + 1 AND a.m < {n}"),
        ("val", "active AND (a.arr OR a.has) AND NOT closes AND c NOT IN (',', ':') AND NOT (c RLIKE '\\\\s')"),
        ("want", f"val AND coalesce(CASE WHEN a.arr THEN a.idx = get({places}, a.m) ELSE {_key('a.key')} = get({keys}, a.m) END, false)"),
        ("left", "closes AND a.depth = a.m + 1 AND a.m > 0"),
        ("stop", "a.at + length(t)"),
    ]
    step = (
        "named_struct('at', stop, "
        "'depth', a.depth + CASE WHEN opens THEN 1 WHEN closes THEN -1 ELSE 0 END, "
        "'m', a.m + CASE WHEN want AND opens THEN 1 WHEN left THEN -1 ELSE 0 END, "
        f"'arr', CASE WHEN opens AND (want OR a.depth = 0) THEN c = '[' WHEN left THEN get({places}, a.m - 1) IS NOT NULL ELSE a.arr END, "
        "'key', CASE WHEN active AND NOT a.arr AND NOT a.has AND c = '\"' THEN t WHEN want OR left THEN cast(null AS string) ELSE a.key END, "
        "'has', CASE WHEN active AND c = ':' THEN true WHEN val OR left THEN false ELSE a.has END, "
        "'idx', CASE WHEN want AND opens THEN 0 WHEN left THEN 1000000000 WHEN active AND a.arr AND c = ',' THEN a.idx + 1 ELSE a.idx END, "
        "'s', CASE WHEN want THEN transform(a.s, (x, i) -> CASE WHEN i = a.m THEN a.at WHEN i > a.m THEN -1 ELSE x END) ELSE a.s END, "
        "'e', CASE WHEN want THEN transform(a.e, (x, i) -> CASE WHEN i = a.m AND NOT opens THEN stop WHEN i >= a.m THEN -1 ELSE x END) "
        "WHEN left THEN transform(a.e, (x, i) -> CASE WHEN i = a.m - 1 THEN stop ELSE x END) ELSE a.e END)"
    )
    return (f"aggregate(regexp_extract_all({text}, {_quoted(TOKEN)}, 0), {start}, (a, t) -> {let(flags, step)}, "
            "a -> named_struct('s', a.s, 'e', a.e))")


def raw_value(text: Column | str, path: Sequence[str | int]) -> Column:
    """The text of the value at ``path``, as it stands in the column; null where there is none."""
    name = text if isinstance(text, str) else "__text"
    body = let([("p", spans("j", path))],
               f"CASE WHEN get(p.s, {len(path) - 1}) >= 0 THEN substr(j, get(p.s, {len(path) - 1}) + 1, get(p.e, {len(path) - 1}) - get(p.s, {len(path) - 1})) END")
    return F.expr(let([("j", f"`{name}`")], body))


def spliced(text: str, path: Sequence[str], value: str, defaults: Sequence[str]) -> Column:
    """The JSON object of column ``text`` with the value at ``path`` (keys) replaced; all other characters stay.

    ``value`` is the column of the new JSON text.  ``defaults[k]`` are further members, as
    text, of an object that has to be made on level k (the value of ``path[k]``): where
    that level is missing it becomes the last member of its object, and where its value
    counts as false it is replaced.  Null if the text or a level on the way is no object.
    """
    last = len(path) - 1

    def made(k: int) -> str:
        """The text of a new value on level k."""
        out = "v"
        for j in range(last, k, -1):
            members = f"{defaults[j - 1]}, " if defaults[j - 1] else ""
            out = f"concat('{{', {members}{_quoted(chr(34) + path[j] + chr(34) + ':')}, {out}, '}}')"
        return out

    def at(k: int) -> str:
        return f"substr(j, get(p.s, {k}) + 1, get(p.e, {k}) - get(p.s, {k}))"

    def put(k: int) -> str:
        return f"concat(substr(j, 1, get(p.s, {k})), {made(k)}, substr(j, get(p.e, {k}) + 1))"

    def add(k: int, end: str, whole: str) -> str:
        """Level k as the last member of the object that ends at ``end`` (its brace included)."""
        comma = f"CASE WHEN {whole} RLIKE '^\\\\{{\\\\s*\\\\}}$' THEN '' ELSE ',' END"
        return f"concat(substr(j, 1, {end} - 1), {comma}, {_quoted(chr(34) + path[k] + chr(34) + ':')}, {made(k)}, substr(j, {end}))"

    out = put(last)
    for k in range(last, -1, -1):
        end, whole = ("length(rtrim_)", "ltrim_") if k == 0 else (f"get(p.e, {k - 1})", at(k - 1))
        here = f"CASE WHEN get(p.s, {k}) < 0 THEN {add(k, end, whole)} "
        if k < last:
            here += f"WHEN {at(k)} RLIKE {_quoted(FALSY)} THEN {put(k)} WHEN NOT startswith({at(k)}, '{{') THEN NULL "
        out = f"{here}ELSE {out} END"
    body = let([("p", spans("j", path))], out)
    body = let([("rtrim_", "regexp_replace(j, '\\\\s+$', '')"), ("ltrim_", "regexp_replace(rtrim_, '^\\\\s+', '')")],
               f"CASE WHEN startswith(ltrim_, '{{') THEN {body} END")
    return F.expr(let([("j", f"`{text}`"), ("v", f"`{value}`")], body))
