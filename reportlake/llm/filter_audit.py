"""Filter interaction audit: what each filter removes, in every order of the filters.

Each row gets a mask of the filters it fails.  Rows are counted by (part, mask, marks) in
Spark, so a part comes down to at most 2 ** filters masks, whatever its size.  A part's
counts become a decision diagram: a level for each filter, an edge for pass and for
fail, and in each node the counts of the rows that reach it.  Equal subdiagrams are one
node.  Along the path on which all filters pass, the counts are those kept after each
step of the order of the levels.  The next order comes from swapping two adjacent
levels, which rebuilds those two and leaves the rest; plain changes visit all orders, each
one swap after the other.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches
from reportlake.session import stage

Counts = tuple[int, ...]


class Diagram:
    """A count-weighted decision diagram over the variables 0 .. n-1, a level each.

    ``levels[k]`` holds the nodes (pass, fail) of level k, numbers of nodes of level k + 1;
    the last level's point into ``leaves``, the distinct counts.  ``order[k]`` is the variable
    of level k.  The root is node 0 of level 0.
    """

    def __init__(self, n: int, counts: Mapping[int, Counts], width: int):
        self.order = list(range(n))
        zero = (0,) * width
        self.leaves: list[Counts] = []
        known: dict[Counts, int] = {}
        row = []
        for mask in range(1 << n):
            leaf = tuple(counts.get(mask, zero))
            if leaf not in known:
                known[leaf] = len(self.leaves)
                self.leaves.append(leaf)
            row.append(known[leaf])
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        # Bit k of a mask belongs to variable k, so the last level joins masks that differ in the highest bit.
        for k in reversed(range(n)):
            half, unique = len(row) // 2, {}
            row = [unique.setdefault((row[i], row[i + half]), len(unique)) for i in range(half)]
            self.levels[k] = list(unique)
        self.weights: list[list[Counts]] = [[] for _ in range(n)]
        for k in reversed(range(n)):
            self.weights[k] = self._weighed(k)

    def _below(self, k: int) -> list[Counts]:
        return self.weights[k + 1] if k + 1 < len(self.levels) else self.leaves

    def _weighed(self, k: int) -> list[Counts]:
        below = self._below(k)
        return [tuple(x + y for x, y in zip(below[a], below[b])) for a, b in self.levels[k]]

    def swap(self, k: int) -> None:
        """Exchange the variables of levels k and k + 1; nodes of level k keep their numbers."""
        unique: dict[tuple[int, int], int] = {}
        lower = self.levels[k + 1]
        upper = []
        for p, f in self.levels[k]:
            (pp, pf), (fp, ff) = lower[p], lower[f]
            upper.append((unique.setdefault((pp, fp), len(unique)), unique.setdefault((pf, ff), len(unique))))
        self.levels[k], self.levels[k + 1] = upper, list(unique)
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]
        self.weights[k + 1] = self._weighed(k + 1)  # a node of level k is reached by the same rows as before

    def passed(self) -> list[Counts]:
        """Counts of all rows, and of those that pass the first 1, 2, ... filters of the order."""
        out, node = [self.weights[0][0]], 0
        for k in range(len(self.levels)):
            node = self.levels[k][node][0]
            out.append(self._below(k)[node])
        return out

    def only(self, variable: int) -> Counts:
        """Counts of the rows that fail this filter and no other."""
        node = 0
        for k, v in enumerate(self.order):
            node = self.levels[k][node][v == variable]
        return self.leaves[node]


def plain_changes(n: int) -> Iterator[int]:
    """The levels k to swap with k + 1, one after the other, to visit all orders of n variables."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    down = True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        k = next(inner, None)
        if k is None:
            return
        # The last variable stands at an end; the others change beside it.
        yield k + 1 if down else k
        down = not down


def audit_part(n: int, counts: Mapping[int, Counts], width: int) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique fails, sum of removed over all orders), for every order and step.

    ``order`` is a tuple of variables; kept to unique fails are counts (tuples of ``width``);
    the sum is of their first entry, over the variable of the step.
    """
    diagram = Diagram(n, counts, width)
    paths = {tuple(diagram.order): diagram.passed()}
    for k in plain_changes(n):
        diagram.swap(k)
        paths[tuple(diagram.order)] = diagram.passed()
    removed = {o: [tuple(a - b for a, b in zip(x, y)) for x, y in zip(p, p[1:])] for o, p in paths.items()}
    total = [0] * n
    fails: list[Counts] = [()] * n
    for order, steps in removed.items():
        fails[order[0]] = steps[0]  # a filter that comes first removes all that fail it
        for v, step in zip(order, steps):
            total[v] += step[0]
    only = [diagram.only(v) for v in range(n)]
    return [(order, s + 1, paths[order][s + 1], gone, tuple(a - b for a, b in zip(fails[v], gone)), only[v], total[v])
            for order, steps in removed.items() for s, (v, gone) in enumerate(zip(order, steps))]


def audit_filters(rows: DataFrame, part: Column, failures: Mapping[str, Column], marks: Mapping[str, Column]) -> DataFrame:
    """One row per part, order of the filters and step.

    ``failures``: name of each filter (a letter) and when a row fails it; null is no failure.
    ``marks``: names and conditions of rows counted apart among the removed.  Columns: part
    (null and empty are one part), filter_order, step, kept, removed, redundant (failing, but removed
    earlier), unique_fails, ``<mark>_lost`` and shapley (removed by the step's filter, summed
    over all orders).  An empty table gives no rows.  The counts of a part, at most
    2 ** (filters + marks) rows, meet in one task; no row of the table does.
    """
    names, n = list(failures), len(failures)
    arrow_batches(rows.sparkSession)

    def bit(c: Column, k: int) -> Column:
        return F.when(F.coalesce(c, F.lit(False)), F.lit(1 << k)).otherwise(F.lit(0))

    mask = sum((bit(c, k) for k, c in enumerate(failures.values())), F.lit(0))
    flags = [F.coalesce(c, F.lit(False)).alias(f"m{i}") for i, c in enumerate(marks.values())]
    marked = [f"m{i}" for i in range(len(marks))]
    masked = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"), *flags)
    counted = masked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(m).alias(f"n{m}") for m in marked])
    weights = F.array("n", *[F.col(f"n{m}") for m in marked])
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", weights.alias("counts"))).alias("masks"))
    width = 1 + len(marked)
    heads = ["kept", "removed", "redundant", "unique_fails", *[f"{m}_lost" for m in marks], "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = audit_part(n, {m["mask"]: tuple(m["counts"]) for m in masks}, width)
                columns = [[p] * len(found), ["".join(names[v] for v in f[0]) for f in found], [f[1] for f in found]]
                columns += [[f[i][0] for f in found] for i in (2, 3, 4, 5)]
                columns += [[f[3][1 + i] for f in found] for i in range(width - 1)] + [[f[6] for f in found]]
                kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(heads)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "filter_order", "step", *heads])

    return parts.mapInArrow(run, ", ".join(["part string", "filter_order string", "step int", *[f"{h} long" for h in heads]]))


# --- the five filters of documents ---------------------------------------------------------------

#: Fewest words; least share of distinct words and largest of capitals, in hundredths.
MIN_WORDS = 100
DISTINCT_SHARE = 80
CAPITAL_SHARE = 10
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "[#$%&*|]"
SPACE = "[\\x20\\x09-\\x0D]+"


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D, each a condition on the text alone (null: empty)."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_SHARE * n_words.cast("long"),
        "C": 100 * capitals.cast("long") > CAPITAL_SHARE * F.length(text).cast("long"),
        "D": text.rlike(SYMBOLS),
    }


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of filters A to E over whole texts, by part; marks are good (quality 1) and toxic (toxic 1).

    E fails a text that is identical to one of a smaller id.  A null id is smaller than none
    and has no smaller one, so it neither fails E nor makes others fail; rows equal in id
    and text do not fail each other.  An id with several labels bears a mark if one of them
    does; labels without an id count for no row.  A null text is an empty one.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    once = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{part_col}`").cast("string").alias("part"), text.alias("text"))
    tested = once.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(k) for k, c in text_failures(F.col("text")).items()])
    tested = stage(tested, "filters-tested")
    # The least id of each text meets its own row, on id and text: no join on the text alone, which may be a hot group.
    least = tested.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    own = labels.select(F.col(f"`{id_col}`").alias("id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    own = own.where("id IS NOT NULL").groupBy("id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = tested.join(least, ["id", "digest"], "left").join(own, "id", "left")
    failures = {k: F.col(k) for k in "ABCD"} | {"E": F.col("id").isNotNull() & F.col("first").isNull()}
    return audit_filters(rows, F.col("part"), failures, {"good": F.col("good"), "toxic": F.col("toxic")})
