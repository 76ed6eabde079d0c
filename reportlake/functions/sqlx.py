"""Small builders for Spark SQL expression text.

Higher-order functions re-evaluate any non-lambda expression they reference in
their body for every element, and even a plain column reference inside a lambda
body is slow in interpreted evaluation.  ``let`` evaluates a value once and
hands it to the body as a lambda variable, which is fast; the decoder is
written as a chain of such bindings.
"""

from __future__ import annotations

LONG_MAX = "9223372036854775807"


def let(bindings: list[tuple[str, str]], body: str) -> str:
    """``let a = x; b = y in body`` as nested ``aggregate`` calls over no element: x is the start, the body the finish.

    A ``transform`` over one element would do as well, but it copies the whole result of the body, once a binding.
    """
    out = body
    for name, value in reversed(bindings):
        out = f"aggregate(cast(array() AS array<int>), {value}, ({name}, {name}_e) -> {name}, {name} -> {out})"
    return out


def quoted(name: str) -> str:
    """A column name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def seq(n: str) -> str:
    """``0 .. n-1`` (empty for n <= 0; ``sequence(0, -1)`` would count down)."""
    return f"CASE WHEN ({n}) > 0 THEN sequence(0, ({n}) - 1) ELSE array() END"


#: Bits in a word of a wide mask: a word times 10**9 stays a BIGINT.
WORD = 31
WORD_MAX = "2147483647L"


def _digit_words(d: str) -> str:
    """A decimal integer text as 31-bit words, lowest first: word array times 10**9 plus the next nine digits."""
    return let(
        [
            ("dg", f"lpad({d}, cast(9 * ceil(length({d}) / 9.0) AS int), '0')"),
            ("nw", "cast((length(dg) * 108) div 1000 + 1 AS int)"),
        ],
        "aggregate(transform(sequence(0, length(dg) div 9 - 1), k -> cast(substr(dg, cast(k * 9 + 1 AS int), 9) AS bigint)), "
        "array_repeat(0L, nw), (acc, nine) -> aggregate(acc, "
        "named_struct('c', nine, 'o', cast(array() AS array<bigint>)), (st, w) -> named_struct("
        f"'c', shiftright(w * 1000000000L + st.c, {WORD}), 'o', concat(st.o, array((w * 1000000000L + st.c) & {WORD_MAX}))"
        ")).o)",
    )


def long_of(v: str, to: str = "bigint") -> str:
    """The integer in a VARIANT of type ``BIGINT`` (NULL if ``to`` is too narrow); its text is read, as ``variant_get`` makes a new cast for each value."""
    return f"try_cast(to_json({v}) AS {to})"


def _mask_body(v: str, t: str, b: str, text: str) -> str:
    digits = (
        f"CASE WHEN {t} LIKE 'DECIMAL(%,0)' THEN cast(try_variant_get({v}, '$', 'decimal(38,0)') AS string) "
        f"WHEN {t} NOT IN ('STRING', 'VOID') THEN {text} END"
    )
    boo = f"CASE WHEN variant_get({v}, '$', 'boolean') THEN 1L ELSE 0L END"
    wide = let(
        [("d", digits), ("ws", f"CASE WHEN d RLIKE '^[0-9]{{19,}}$' THEN {_digit_words('d')} END")],
        f"named_struct('ok', {t} = 'BOOLEAN' OR ws IS NOT NULL, "
        f"'lo', CASE WHEN {t} = 'BOOLEAN' THEN {boo} WHEN ws IS NOT NULL THEN get(ws, 0) | shiftleft(coalesce(get(ws, 1), 0L), 31) "
        "| shiftleft(coalesce(get(ws, 2), 0L) & 1L, 62) ELSE 0L END, 'neg', false, 'ws', ws)",
    )
    plain = f"named_struct('ok', true, 'lo', mb & {LONG_MAX}, 'neg', mb < 0, 'ws', cast(NULL AS array<bigint>))"
    return (
        f"CASE WHEN {t} = 'BIGINT' THEN {let([('mb', b)], plain)} "
        f"ELSE {wide} END"
    )


def mask_struct(v: str, t: str, text: str = "cast(NULL AS string)") -> str:
    """An integer bit mask held in a VARIANT, of any width.

    ``lo`` holds the bits below 63; ``ws`` the whole mask in 31-bit words where it
    does not fit a BIGINT; ``neg`` that all higher bits are set.  ``text`` is the mask as
    it stands in the body, for integers beyond 38 digits, which a VARIANT does not
    keep.  A missing key is mask 0.  ``ok`` is false for anything an integer ``&``
    would reject (null, float, text, ...).  Booleans behave as 0/1 like Python's
    bool.  ``t``: an expression already holding ``schema_of_variant(v)``.
    """
    empty = "named_struct('ok', true, 'lo', 0L, 'neg', false, 'ws', cast(NULL AS array<bigint>))"
    big = long_of(v)
    return f"CASE WHEN ({v}) IS NULL THEN {empty} ELSE {_mask_body(v, t, big, text)} END"


def mask_words(m: str, n: str) -> str:
    """Mask struct ``m`` as 31-bit words for ``n`` fields (one word more than they need)."""
    own = (
        f"CASE k WHEN 0 THEN {m}.lo & {WORD_MAX} WHEN 1 THEN shiftright({m}.lo, 31) & {WORD_MAX} "
        f"WHEN 2 THEN shiftright({m}.lo, 62) | CASE WHEN {m}.neg THEN 2147483646L ELSE 0L END "
        f"ELSE CASE WHEN {m}.neg THEN {WORD_MAX} ELSE 0L END END"
    )
    return (
        f"transform(sequence(0, cast(({n}) div {WORD} AS int)), k -> "
        f"CASE WHEN {m}.ws IS NOT NULL THEN coalesce(get({m}.ws, k), 0L) ELSE {own} END)"
    )


def word_bit(ws: str, i: str) -> str:
    """Is bit ``i`` set in a word array."""
    return f"((shiftright(coalesce(get({ws}, cast(({i}) div {WORD} AS int)), 0L), ({i}) % {WORD}) & 1L) = 1L)"


def words_below(ws: str) -> str:
    """For each word: the number of bits set in the words before it."""
    return f"transform({ws}, (w, k) -> aggregate(slice({ws}, 1, k), 0, (acc, y) -> acc + bit_count(y)))"


def word_rank(ws: str, below: str, i: str) -> str:
    """``i`` less the number of bits set below ``i``: the C index of field i, where ``ws`` are the taken fields."""
    k = f"cast(({i}) div {WORD} AS int)"
    return f"(({i}) - get({below}, {k}) - bit_count(get({ws}, {k}) & (shiftleft(1L, ({i}) % {WORD}) - 1L)))"


def all_bits_set(m: str, n: str) -> str:
    """All of bits ``0..n-1`` set in mask struct ``m``."""
    low = f"(CASE WHEN ({n}) >= 63 THEN {LONG_MAX} ELSE shiftleft(1L, {n}) - 1L END)"
    wide = f"forall({seq(n)}, bi -> {word_bit('mw', 'bi')})"
    return f"(({m}.lo & {low}) = {low} AND (({n}) <= 63 OR {let([('mw', mask_words(m, n))], wide)}))"


def json_value(col_sql: str) -> str:
    """JSON text of a scalar column (string quoted and escaped, null -> ``null``)."""
    return f"coalesce(regexp_extract(to_json(array({col_sql})), '^\\\\[(.*)\\\\]$', 1), 'null')"


def json_string(col_sql: str) -> str:
    """JSON string literal of a text column."""
    return json_value(f"cast({col_sql} AS string)")
