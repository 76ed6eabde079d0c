"""Secret scans with a trigram inverted index.

Every rule is a regular expression.  A Boolean query over lower-case trigrams is
derived from its syntax tree: a text without them cannot match.  The scan
indexes one Arrow batch after another, as small index segments: for each trigram
that some rule asks for, a posting list of the texts that have it.  Queries
intersect and unite posting lists; only the candidates are verified with the
expression.  Rules without mandatory trigrams scan every text.  Segments need no
shuffle, hold one batch, and are rebuilt with their task if an executor is lost.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from re import _constants as sre, _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches, by_bytes

#: UTF-8 bytes of text per index segment.
SEGMENT_BYTES = 4 << 20

#: Alternative strings that are followed at once while a query is derived.
MAX_STRINGS = 32


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret.  ``group``/``min_chars``: matches whose group is shorter are dropped."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0


# The three base kinds, as the task gives them.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
        r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Maximal runs only: the same spans as [0-9a-f]+ with a minimum length.
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24),
)

#: Further kinds in common use.
MORE_RULES = (
    # The whole block up to its end line; without one, up to the last line of the key.  Line
    # ends may be written as \\n, as in JSON.
    SecretRule(
        "private_key",
        r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
        r"(?:(?:[^-]++|-(?!----BEGIN |----END [A-Z ]{0,30}PRIVATE KEY))*+-----END [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
        r"|(?:(?:(?:\s|\\[nr])*(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset):[^\n\\]*)*"
        r"(?:(?:\s|\\[nr]|[>#*\"'])*[A-Za-z0-9+/=]{24,})+"
        r"(?:(?:\s|\\[nr]|[>#*\"'])+[A-Za-z0-9+/]+={0,2}(?=\s*(?:\n|\Z)|\\n|[\"']))?)?)"),
    SecretRule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    SecretRule("live_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    SecretRule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)

ALL_RULES = BASE_RULES + MORE_RULES


# --- Boolean trigram queries ---------------------------------------------------------
# A query is True (no demand), a trigram (bytes), or ("and"|"or", [queries]).


def _both(queries: list) -> object:
    parts = [q for q in queries if q is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _either(queries: list) -> object:
    if not queries or any(q is True for q in queries):
        return True
    return queries[0] if len(queries) == 1 else ("or", queries)


def _of_strings(strings: set[bytes]) -> object:
    """The demand that a text has one of these strings."""
    alternatives = []
    for s in sorted(strings):
        grams = sorted({s[i:i + 3] for i in range(len(s) - 2)})
        alternatives.append(_both(list(grams)) if grams else True)
    return _either(alternatives)


def _chars(items) -> set[bytes] | None:
    """The lower-case characters of a class, or None where they are many."""
    found: set[bytes] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            found.add(chr(arg).encode().lower())
        elif op is sre.RANGE and arg[1] - arg[0] < 8:
            found |= {chr(c).encode().lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= 6 else None


def _walk(tree) -> tuple[set[bytes] | None, object]:
    """(all strings the tree can match, or None; the demand it makes)."""
    run: set[bytes] = {b""}  # strings that the part since the last open element matches
    demands: list = []

    def close():
        nonlocal run
        demands.append(_of_strings(run))
        run = {b""}

    whole = True
    for op, arg in tree:
        strings: set[bytes] | None = None
        demand: object = True
        if op is sre.LITERAL:
            strings = {chr(arg).encode().lower()}
        elif op is sre.IN:
            strings = _chars(arg)
        elif op is sre.SUBPATTERN:
            strings, demand = _walk(arg[3])
        elif op is sre.BRANCH:
            ways = [_walk(t) for t in arg[1]]
            if all(s is not None for s, _ in ways):
                strings = set().union(*[s for s, _ in ways])
            demand = _either([q if s is None else _both([q, _of_strings(s)]) for s, q in ways])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            s, q = _walk(inner)
            if s is not None and low == high == 1:
                strings = s
            elif s is not None and low == 0 and high == 1:
                strings = s | {b""}
            elif low:
                demand = q if s is None else _both([q, _of_strings(s)])
        elif op is sre.AT:
            continue
        if strings is not None and len(strings) * len(run) <= MAX_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        whole = False
        close()
        if strings is not None:
            run = strings if len(strings) <= MAX_STRINGS else {b""}
            if len(strings) > MAX_STRINGS:
                demands.append(_of_strings(strings))
        demands.append(demand)
    if whole:
        return run, True
    close()
    return None, _both(demands)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every text matching ``pattern`` satisfies; True if there is none."""
    strings, demand = _walk(sre_parser.parse(pattern))
    return demand if strings is None else _both([demand, _of_strings(strings)])


def trigrams_of(query: object) -> set[bytes]:
    if query is True:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*[trigrams_of(q) for q in query[1]])


class SegmentIndex:
    """Posting lists of the wanted trigrams over the texts of one segment."""

    def __init__(self, wanted: Sequence[bytes]):
        self.wanted = list(wanted)
        self.number = np.zeros(1 << 24, np.uint16)
        for i, g in enumerate(self.wanted):
            self.number[g[0] << 16 | g[1] << 8 | g[2]] = i + 1
        self.postings: dict[bytes, np.ndarray] = {}
        self.size = 0

    def build(self, texts: list[str]) -> None:
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        self.size = len(raw)
        data = np.frombuffer(b"\0\0\0".join([*raw, b""]), np.uint8).astype(np.uint32)
        ends = np.cumsum([len(r) + 3 for r in raw])
        codes = data[:-2] << 16 | data[1:-1] << 8 | data[2:] if len(data) > 2 else np.zeros(0, np.uint32)
        hits = self.number[codes]
        at = np.flatnonzero(hits)
        rows = np.searchsorted(ends, at, side="right")
        both = np.unique(hits[at].astype(np.int64) * (self.size + 1) + rows)
        grams, rows = both // (self.size + 1), both % (self.size + 1)
        cut = np.searchsorted(grams, np.arange(1, len(self.wanted) + 2))
        self.postings = {g: rows[cut[i]:cut[i + 1]] for i, g in enumerate(self.wanted)}

    def candidates(self, query: object) -> np.ndarray:
        """Numbers of the texts that satisfy the query, ascending."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, bytes):
            return self.postings[query]
        parts = [self.candidates(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        parts.sort(key=len)
        out = parts[0]
        for p in parts[1:]:
            if not len(out):
                break
            out = out[np.isin(out, p, assume_unique=True)]
        return out


def scanner(rules: Sequence[SecretRule]) -> Callable[[list[str]], list[list[tuple[int, int, int]]]]:
    """A function from texts to their spans (start, end, rule number), by start, then rule."""
    compiled = [re.compile(r.pattern) for r in rules]
    queries = [trigram_query(r.pattern) for r in rules]
    index = SegmentIndex(sorted(set().union(*[trigrams_of(q) for q in queries])))

    def scan(texts: list[str]) -> list[list[tuple[int, int, int]]]:
        index.build(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, rule in enumerate(rules):
            for row in index.candidates(queries[k]).tolist():
                for m in compiled[k].finditer(texts[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.min_chars:
                        found[row].append((m.start(), m.end(), k))
        for spans in found:
            spans.sort(key=lambda x: (x[0], x[2], x[1]))
        return found

    return scan


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def scan_secrets(docs: DataFrame, rules: Sequence[SecretRule] = ALL_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``spans`` (kind, start, end in code points, end exclusive).

    Spans are in order of start, then of the rules; per kind they are the leftmost
    non-overlapping matches, without those below the kind's least length.  Null
    and empty texts give an empty list; null ids and repeated rows are kept; other
    columns are ignored; an empty table gives no rows.
    """
    arrow_batches(docs.sparkSession)
    rules = tuple(rules)
    out_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in by_bytes(batches, 1, SEGMENT_BYTES):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, b, k in s] for s in scan(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, out_type)], names=["id", "spans"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, spans {SPAN_TYPE}").withColumnRenamed("id", id_col))


def redact_secrets(docs: DataFrame, rules: Sequence[SecretRule] = ALL_RULES, text_col: str = "text",
                   mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by ``mark``; overlapping spans become one mark.

    All rows and all columns stay (null texts too), in the same types.
    """
    arrow_batches(docs.sparkSession)
    rules = tuple(rules)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in by_bytes(batches, at, SEGMENT_BYTES):
            texts = batch.column(at).to_pylist()
            out = []
            for text, spans in zip(texts, scan([t or "" for t in texts])):
                if spans:
                    parts, end = [], 0
                    for a, b, _ in spans:
                        if a >= end:
                            parts += [text[end:a], mark]
                        end = max(end, b)
                    text = "".join([*parts, text[end:]])
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.column(at).type))

    return docs.mapInArrow(run, docs.schema)
