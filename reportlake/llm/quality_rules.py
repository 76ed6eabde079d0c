"""Quality rules as a short-circuit cascade.

Each rule rejects texts.  On a bounded sample every rule's cost (CPU seconds a
text) and its rejections are measured in Spark tasks; the cascade then takes, again and
again, the rule that rejects most of what is left per second.  A text that one
rule rejects is not shown to the later ones.  The verdict is the conjunction of
all rules, so it does not depend on the order that was measured.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches, by_bytes

#: Rows the plan of a cascade is measured on, at most.
SAMPLE_ROWS = 1500

#: UTF-8 bytes of text per batch.
BATCH_BYTES = 2 << 20

# The words and symbols of the base columns, as the task gives them.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

UPPER = re.compile("[A-Z]")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeat_words(words: Sequence[list[str]], width: int = WINDOW) -> np.ndarray:
    """Per text: its words in windows of ``width`` words that it has twice or more."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    total = int(lens.sum())
    if not total:
        return np.zeros(len(words), np.int64)
    flat = pa.array([w for ws in words for w in ws], pa.large_string()).dictionary_encode()
    ids = flat.indices.to_numpy().astype(np.uint64)
    ends = np.cumsum(lens)
    doc = np.repeat(np.arange(len(words)), lens)
    at = np.flatnonzero(np.arange(total) + width <= ends[doc])
    covered = np.zeros(total + 1, np.int64)
    if len(at):
        mixed = _mix(ids + np.uint64(1))
        key = _mix(doc[at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for k in range(width):
            key = key * np.uint64(0x9E3779B97F4A7C15) + mixed[at + k]
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        same = np.flatnonzero(key[1:] == key[:-1])
        a, b = at[same], at[same + 1]
        real = doc[a] == doc[b]  # equal hashes are checked word by word
        for k in range(width):
            real &= ids[a + k] == ids[b + k]
        hit = np.unique(np.concatenate((a[real], b[real])))
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + width, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    return inside[ends] - inside[ends - lens]


class TextBatch:
    """Texts with the features rules ask for; each feature is computed once, when it is first asked for."""

    def __init__(self, texts: Sequence[str], features: dict | None = None):
        self.texts = list(texts)
        self._features = {} if features is None else features

    def __len__(self) -> int:
        return len(self.texts)

    def take(self, at: np.ndarray) -> TextBatch:
        """Some of the texts, with what is known of them."""
        known = {k: [v[i] for i in at] if isinstance(v, list) else v[at] for k, v in self._features.items()}
        return TextBatch([self.texts[i] for i in at], known)

    def _get(self, name: str, make: Callable[[], object]):
        if name not in self._features:
            self._features[name] = make()
        return self._features[name]

    def _each(self, name: str, of: Callable[[str], int]) -> np.ndarray:
        return self._get(name, lambda: np.fromiter(map(of, self.texts), np.int64, len(self.texts)))

    @property
    def words(self) -> list[list[str]]:
        return self._get("words", lambda: [WORD.findall(t) for t in self.texts])

    @property
    def n_words(self) -> np.ndarray:
        return self._get("n_words", lambda: np.fromiter(map(len, self.words), np.int64, len(self.texts)))

    @property
    def word_chars(self) -> np.ndarray:
        return self._each("word_chars", lambda t: len(t) - sum(map(t.count, SEPARATORS)))

    @property
    def n_symbols(self) -> np.ndarray:
        return self._each("n_symbols", lambda t: sum(map(t.count, SYMBOLS)))

    @property
    def lines(self) -> list[list[str]]:
        return self._get("lines", lambda: [[x for x in t.split("\n") if x.strip(SEPARATORS)] for t in self.texts])

    @property
    def n_lines(self) -> np.ndarray:
        return self._get("n_lines", lambda: np.fromiter(map(len, self.lines), np.int64, len(self.texts)))

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self._get("n_dup_lines", lambda: self.n_lines - np.fromiter(
            (len(set(x)) for x in self.lines), np.int64, len(self.texts)))

    @property
    def n_repeat_words(self) -> np.ndarray:
        return self._get("n_repeat_words", lambda: repeat_words(self.words))

    @property
    def doubled_words(self) -> np.ndarray:
        """Words equal to the word before them."""
        return self._get("doubled_words", lambda: np.fromiter(
            (sum(map(eq, w, w[1:])) for w in self.words), np.int64, len(self.texts)))

    @property
    def n_upper(self) -> np.ndarray:
        return self._each("n_upper", lambda t: len(UPPER.findall(t)) if t.isascii() else sum(map(str.isupper, t)))

    @property
    def n_exclaims(self) -> np.ndarray:
        return self._each("n_exclaims", lambda t: t.count("!"))

    @property
    def n_digits(self) -> np.ndarray:
        return self._each("n_digits", lambda t: sum(map(t.count, "0123456789")))


# --- rules -----------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityRule:
    """``rejects`` takes a batch and says for each text whether the rule rejects it."""

    name: str
    rejects: Callable[[TextBatch], np.ndarray]


RULES = (
    QualityRule("repeated_windows", lambda b: 100 * b.n_repeat_words > 30 * b.n_words),
    QualityRule("few_words", lambda b: b.n_words < 20),
    QualityRule("symbols", lambda b: 10 * b.n_symbols > b.n_words),
    QualityRule("shouting", lambda b: 2 * b.n_upper > b.word_chars),
    QualityRule("exclaims", lambda b: 5 * b.n_exclaims > b.n_words),
    QualityRule("word_length", lambda b: (b.word_chars < 2 * b.n_words) | (b.word_chars > 15 * b.n_words)),
    QualityRule("dup_lines", lambda b: (b.n_dup_lines > 3) & (10 * b.n_dup_lines > 3 * b.n_lines)),
    QualityRule("doubled_words", lambda b: 10 * b.doubled_words > 3 * b.n_words),
    QualityRule("digits", lambda b: 10 * b.n_digits > 3 * b.word_chars),
)


# --- the cascade -------------------------------------------------------------------------


@dataclass(frozen=True)
class PlannedRule:
    rule: QualityRule
    seconds: float  # a text
    rejection: float  # share rejected of the texts that reach it, on the sample


def order_rules(rules: Sequence[QualityRule], seconds: Sequence[float], rejected: np.ndarray) -> list[PlannedRule]:
    """Greedy order by rejections per second among the texts left; ``rejected`` is rules x sample."""
    left = np.ones(rejected.shape[1], bool)
    todo, out = list(range(len(rules))), []
    while todo:
        best = max(todo, key=lambda k: ((rejected[k] & left).sum() / max(seconds[k], 1e-9), -seconds[k], -k))
        share = (rejected[best] & left).sum() / max(1, left.sum())
        out.append(PlannedRule(rules[best], float(seconds[best]), float(share)))
        left &= ~rejected[best]
        todo.remove(best)
    return out


def plan_cascade(docs: DataFrame, rules: Sequence[QualityRule] = RULES, text_col: str = "text",
                 sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[PlannedRule]:
    """Measure all rules on about ``sample_rows`` random texts, in Spark tasks, and order them.

    Only one small record per sampled text comes to the driver.  An empty table
    or a table of null texts gives an order by cost alone.
    """
    arrow_batches(docs.sparkSession)
    rules = tuple(rules)
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    n = docs.count()
    if n > sample_rows:
        texts = texts.sample(False, min(1.0, 1.2 * sample_rows / n), seed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = [t or "" for t in batch.column(0).to_pylist()]
            bits, secs = np.zeros(len(part), np.int64), []
            for k, rule in enumerate(rules):
                t = time.process_time()
                bits |= rule.rejects(TextBatch(part)).astype(np.int64) << k
                secs.append((time.process_time() - t) / max(1, len(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bits), pa.array([secs] * len(part), pa.list_(pa.float64()))], names=["bits", "secs"])

    got = texts.mapInArrow(measure, "bits long, secs array<double>").limit(sample_rows).collect()
    if not got:
        return [PlannedRule(r, 0.0, 0.0) for r in rules]
    bits = np.array([r.bits for r in got])
    rejected = np.array([(bits >> k) & 1 == 1 for k in range(len(rules))])
    return order_rules(rules, np.array([r.secs for r in got]).mean(axis=0), rejected)


def run_cascade(batch: TextBatch, plan: Sequence[PlannedRule], alive: np.ndarray) -> np.ndarray:
    """The texts that survive: each rule sees only what the rules before it have left."""
    alive = alive.copy()
    for step in plan:
        at = np.flatnonzero(alive)
        if not len(at):
            break
        alive[at[step.rule.rejects(batch.take(at))]] = False
    return alive


def quality(docs: DataFrame, rules: Sequence[QualityRule] = RULES, id_col: str = "doc_id", text_col: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, the base columns, base_failed and kept.

    ``kept`` is false where the base fails or a rule rejects.  Null texts have no
    words, so they fail; null ids and repeated rows stay; other columns are
    ignored; an empty table gives no rows.
    """
    plan = plan_cascade(docs, rules, text_col, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            s = TextBatch(texts)
            failed = (s.n_words < 20) | (100 * s.n_repeat_words > 30 * s.n_words)
            kept = run_cascade(s, plan, ~failed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines,
                                                  s.n_repeat_words, failed, kept))],
                names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])

    kind = dict(docs.dtypes)[id_col]
    arrow_batches(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                             "n_repeat_words long, base_failed boolean, kept boolean")
            .withColumnRenamed("id", id_col))
