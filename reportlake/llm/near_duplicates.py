"""Classes of near-duplicate texts from signature keys and a pairwise check.

Shared by the MinHash and the Order MinHash operators.  Exact copies collapse to
one text first (128-bit digest).  Texts that share a key share a bucket.  A
bucket of the first keys is never expanded into all its pairs.  In the first round a
text is checked against the least member of its buckets, since most buckets of a class
repeat the same pair.  Texts whose buckets still hold several classes are unsettled.
Many of them are alike but not near (a family that has drifted apart), and first keys do
not tell those from near ones.  So unsettled texts get a second, steeper family of keys
(``Steep``), which near texts still share and others rarely do.  A text first asks the
first members of other classes with which it shares most of these keys, then, when
classes have grown, members of different classes in a bucket are checked.  Texts too short for steep keys meet by their
rarest items: near texts share ``OVERLAP`` of the items of each, so of any common
order of all items they share one of the first of both (prefix filter), and texts
that share no more than a frequent passage do not meet.  Members are checked against
leaders of the other classes at their item, if they share enough keys; leaders are
the least member of each class, then the next ones, until one class is left or
every member has met all members of other classes.  Links make classes by connected
components.  All state is in tables below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches, by_bytes
from reportlake.session import stage

#: UTF-8 bytes of text signed at once in a worker.
SIGN_BYTES = 2 << 20

#: Bits of the filter that keeps texts without candidates out of the shuffle (fixed size: 1 MB).
FILTER_BITS = 1 << 23

#: Counters of items (fixed size: 8 MB).  Items that share a counter count as more
#: frequent than they are, which costs checks but loses no pair.
COUNTERS = 1 << 20

#: Near texts share at least this part of the items of each.
OVERLAP = 0.8

#: Leaders of a group in the first round of leaders.
LEADERS = 32

#: Members of other classes that an unsettled text asks in a round of closest ones, and such rounds.
CLOSEST = 3
CLOSEST_ROUNDS = 2

#: (texts) -> an array of keys (int64) for each text.
Signer = Callable[[Sequence[str]], list[np.ndarray]]

#: (texts) -> the items of each text (int64) that the check compares.
Preparer = Callable[[Sequence[str]], list[np.ndarray]]

#: (items, items) -> whether the two are near duplicates.
Verifier = Callable[[np.ndarray, np.ndarray], bool]


@dataclass(frozen=True)
class Steep:
    """Second keys of unsettled texts: ``keys`` of the items of a text, for texts of more than
    ``above`` items; texts of up to ``exact`` items are settled by their rarest items.
    ``bits`` sums a text up in ``words`` 64-bit words: near texts differ in ``apart`` of their bits at most."""

    keys: Callable[[np.ndarray], np.ndarray]
    bits: Callable[[np.ndarray], np.ndarray]
    words: int
    apart: int
    above: int
    exact: int


def digest(text_col: str):
    return F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def _signed(docs: DataFrame, sign: Signer) -> DataFrame:
    """(id, digest, keys) of rows (id, digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2, SIGN_BYTES):
            coded = batch.column(2).dictionary_encode()  # copies in a batch are signed once
            keys = sign(coded.dictionary.to_pylist())
            keys = [keys[i] for i in coded.indices.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], names=["id", "digest", "keys"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, digest binary, keys array<long>")


def _filter_of(hashes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit set for each hash; 2 MB at most come to the driver."""
    words = (hashes.select(F.pmod("h", F.lit(FILTER_BITS)).alias("bit"))
             .selectExpr("shiftright(bit, 6) AS w", "shiftleft(1L, CAST(pmod(bit, 64) AS INT)) AS b")
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def _items(docs: DataFrame, wanted: DataFrame, prepare: Preparer) -> DataFrame:
    """(uid, items), one row for each of ``wanted`` (uid, digest), from rows (digest, text)."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted.select(F.xxhash64("digest").alias("h"))))

    @F.pandas_udf("boolean")
    def may_be(h):
        at = h.to_numpy() & (FILTER_BITS - 1)
        return pd.Series((bits.value[at >> 6] >> (at & 63)) & 1 == 1)

    some = docs.select("digest", "text").where(may_be(F.xxhash64("digest")))
    once = some.join(wanted, "digest").groupBy("uid").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, SIGN_BYTES):
            items = pa.array(prepare(batch.column(1).to_pylist()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), items], names=["uid", "items"])

    return once.mapInArrow(run, "uid long, items array<long>")


def _item_counts(items: DataFrame) -> np.ndarray:
    """How often the items of each counter occur; ``COUNTERS`` numbers come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy() & (COUNTERS - 1), minlength=COUNTERS)
        slot = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n[slot])], names=["slot", "n"])

    found = items.select("items").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def _rare_items(items: DataFrame) -> DataFrame:
    """(key, uid): the rarest items of each text, as many as near texts can differ in and one more."""
    counts = items.sparkSession.sparkContext.broadcast(_item_counts(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            rare = []
            for own in (values[a:b] for a, b in zip(at[:-1], at[1:])):
                first = len(own) - int(np.ceil(OVERLAP * len(own) - 1e-9)) + 1
                rare.append(np.unique(own[np.lexsort((own, counts.value[own & (COUNTERS - 1)]))[:first]]))
            if rare:
                uids = np.repeat(batch.column(0).to_numpy(), [len(r) for r in rare])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rare)), pa.array(uids)], names=["key", "uid"])

    keyed = items.select("uid", "items").mapInArrow(run, "key long, uid long")
    several = keyed.groupBy("key").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo < hi")
    return keyed.join(several.select("key"), "key")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of rows (a, b): label is the least node of the component.  Nodes are longs."""
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        new = stage(step.join(jump, "next").select("node", "label", F.least("next", "far").alias("new")), "labels")
        if new.where("new != label").isEmpty():
            return labels
        labels = new.select("node", F.col("new").alias("label"))


def _side(table: DataFrame, uid: str, value: str) -> DataFrame:
    """``table`` (uid, value) with its columns named for one side of a pair."""
    return table.toDF(uid, value)


def _verified(pairs: DataFrame, keys: DataFrame, items: DataFrame, verify: Verifier, shared: int) -> DataFrame:
    """The pairs (a, b) that share ``shared`` keys at least and whose items pass.

    ``keys`` has 32 bits of each key; a chance match costs a check and no more.
    """
    if shared > 1:
        both = pairs.join(_side(keys, "a", "ka"), "a").join(_side(keys, "b", "kb"), "b")
        pairs = both.where(F.size(F.array_intersect("ka", "kb")) >= shared).select("a", "b")
    joined = pairs.join(_side(items, "a", "ia"), "a").join(_side(items, "b", "ib"), "b").select("a", "b", "ia", "ib")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (c.values.to_numpy() for c in batch.columns[2:])
            i, j = (c.offsets.to_numpy() for c in batch.columns[2:])
            ok = [verify(x[i[k]:i[k + 1]], y[j[k]:j[k + 1]]) for k in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def near_duplicate_classes(docs: DataFrame, sign: Signer, prepare: Preparer, verify: Verifier, id_col: str = "doc_id",
                           text_col: str = "text", shared: int = 1, steep: Steep | None = None) -> DataFrame:
    """One row per row of ``docs``: id, digest of the text, class_id, is_kept.

    class_id is the least id of the class, over copies and near duplicates; ids
    must be of an orderable type.  is_kept marks one row of each class: the first
    by id, then text digest; of rows equal in both, one.  A null text is like an
    empty one; all texts without words form one class with their equals only.
    A pair is checked if it shares ``shared`` keys at least.  Null ids sort first.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    plain = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    signed = stage(_signed(plain, sign), "signed")
    once = signed.groupBy("digest").agg(F.first("keys").alias("keys"))
    once = stage(once.select(F.monotonically_increasing_id().alias("uid"), "digest", "keys"), "texts-once")

    keyed = once.select("uid", F.explode(F.array_distinct("keys")).alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo < hi").select("key", "lo")
    members = stage(keyed.join(buckets, "key"), "members")

    found = _settled(members, once, plain, prepare, verify, shared, steep)
    label = spark.createDataFrame([], "uid long, label long") if found is None else found[1]
    classes = stage(once.select("uid", "digest").join(label, "uid", "left")
                    .select("digest", F.coalesce("label", "uid").alias("label")), "classes")
    rows = signed.select("id", "digest").join(classes, "digest")
    # One row per class: its first row; then every row learns it by its class.
    first = rows.groupBy("label").agg(F.min(F.struct("id", "digest")).alias("first"))
    tagged = rows.join(first, "label")
    return _keep_one(tagged).withColumnRenamed("id", id_col)


def _keep_one(tagged: DataFrame) -> DataFrame:
    """(id, digest, class_id, is_kept) of rows with the first row of their class; of equal first rows one is kept."""
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest"))
    # Rows equal to the first in id and text are numbered; as a rule there is one of them a class.
    firsts = tagged.where(same).groupBy("label", "id", "digest", F.col("first.id").alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    firsts = firsts.select("id", "digest", "class_id", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k"))
    kept = firsts.select("id", "digest", "class_id", (F.col("k") == 1).alias("is_kept"))
    return tagged.where(~same).select("id", "digest", F.col("first.id").alias("class_id"), F.lit(False).alias("is_kept")).unionByName(kept)


def _steep_keys(items: DataFrame, steep: Steep) -> DataFrame:
    """Staged (key, uid, n): the steep keys of each text, with its number of items; keys of one text are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            keys = [np.unique(steep.keys(values[a:b])) for a, b in zip(at[:-1], at[1:])]
            if keys:
                each = [len(k) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.repeat(batch.column(0).to_numpy(), each)),
                     pa.array(np.repeat(np.diff(at), each).astype(np.int32))], names=["key", "uid", "n"])

    keyed = stage(items.select("uid", "items").mapInArrow(run, "key long, uid long, n int"), "steep-keys")
    several = keyed.groupBy("key").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo < hi").select("key")
    return stage(keyed.join(several, "key"), "steep")


def _in_open_buckets(keyed: DataFrame, label: DataFrame) -> DataFrame:
    """``keyed`` with the class of each text, and ``lo`` (label, uid), its first member, for buckets of several classes."""
    m = keyed.join(label, "uid", "left").select("key", "uid", "n", F.coalesce("label", "uid").alias("label"))
    first = m.groupBy("key").agg(F.min(F.struct("label", "uid")).alias("lo"), F.max("label").alias("hi")).where("lo.label < hi")
    return m.join(first.select("key", "lo"), "key")


def _closest(keyed: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs (a, b) of each text and the ``CLOSEST`` first members of other classes that share most of its steep keys."""
    asked = _in_open_buckets(keyed, label).where("label != lo.label").groupBy("uid", F.col("lo.uid").alias("lo")).agg(F.count(F.lit(1)).alias("n"))
    # A text has as many rows here as keys at most.
    nth = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("n"), "lo"))
    best = asked.withColumn("nth", nth).where(F.col("nth") <= CLOSEST)
    return best.select(F.greatest("uid", "lo").alias("a"), F.least("uid", "lo").alias("b")).distinct()


def _bits(items: DataFrame, steep: Steep) -> DataFrame:
    """Staged (uid, b0, b1, ...): the bits of each text."""
    names = [f"b{i}" for i in range(steep.words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            bits = [steep.bits(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            if bits:
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(w) for w in np.stack(bits, axis=1)]], names=["uid", *names])

    return stage(items.select("uid", "items").mapInArrow(run, ", ".join(["uid long", *[f"{b} long" for b in names]])), "steep-bits")


def _steep_pairs(keyed: DataFrame, label: DataFrame, bits: DataFrame, apart: int) -> DataFrame:
    """Pairs (a, b) of texts of different classes that share a steep key and could be near by their numbers of items and their bits."""
    one = stage(_in_open_buckets(keyed, label).drop("lo").join(bits, "uid"), "steep-open")
    names = [c for c in one.columns if c != "key"]
    two = one.select("key", *[F.col(c).alias(f"{c}2") for c in names])
    differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"{b}2"))) for b in bits.columns[1:]), F.lit(0))
    both = one.join(two, "key").where((F.col("uid") > F.col("uid2")) & (F.col("label") != F.col("label2"))
                                      & (F.least("n", "n2") >= OVERLAP * F.greatest("n", "n2")) & (differ <= apart))
    return both.select(F.col("uid").alias("a"), F.col("uid2").alias("b")).distinct()


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """(uid, label) after further ``links`` (a, b): only classes that these join are looked at again."""
    ends = [label.select(F.col("uid").alias(e), F.col("label").alias(f"of_{e}")) for e in "ab"]
    named = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    whole = components(named.where("a != b").distinct()).select(F.col("node").alias("label"), F.col("label").alias("root"))
    single = links.select(F.explode(F.array("a", "b")).alias("uid")).distinct().join(label, "uid", "left_anti").withColumn("label", F.col("uid"))
    both = label.select("uid", "label").unionByName(single)
    return stage(both.join(whole, "label", "left").select("uid", F.coalesce("root", "label").alias("label")), "labels")


def _settled(members: DataFrame, once: DataFrame, plain: DataFrame, prepare: Preparer, verify: Verifier, shared: int,
             steep: Steep | None = None) -> tuple[DataFrame, DataFrame] | None:
    """(verified pairs (a, b) of uids that connect all classes, (uid, label) of the classes); None if there are no candidates.

    Each later round takes 64 times as many leaders of every open group, so the number
    of rounds grows with the logarithm of the largest group.  A group is done when it
    holds one class or every member has been a leader: then all pairs of two classes
    have been checked.
    """
    if members.isEmpty():
        return None
    wanted = stage(members.select("uid").distinct().join(once, "uid"), "candidates")
    keys = stage(wanted.select("uid", F.transform("keys", lambda k: F.shiftright(k, 32).cast("int")).alias("keys")), "keys-32")
    items = stage(_items(plain, wanted.select("uid", "digest"), prepare), "items")

    pairs = members.where("uid != lo").groupBy(F.col("uid").alias("a")).agg(F.min("lo").alias("b"))
    tested = stage(pairs, "pairs")
    links = stage(_verified(tested, keys, items, verify, shared), "links")
    label = components(links).withColumnRenamed("node", "uid")
    m = members.join(label, "uid", "left").select("key", "uid", F.coalesce("label", "uid").alias("label"))
    m = stage(m, "first-classes")
    several = m.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    unsettled = stage(items.join(m.join(several, "key").select("uid").distinct(), "uid"), "unsettled")
    if steep is not None:
        long = unsettled.where(F.size("items") > steep.above)
        keyed, bits = _steep_keys(long, steep), _bits(long, steep)
        # Members of large classes find together by their closest ones first, so that few pairs of two classes are left.
        for last in [False] * CLOSEST_ROUNDS + [True]:
            found = _steep_pairs(keyed, label, bits, steep.apart) if last else _closest(keyed, label)
            new = stage(found.join(tested, ["a", "b"], "left_anti"), "steep-pairs")
            tested = tested.unionByName(new)
            new = stage(_verified(new, keys, items, verify, 1), "links")
            links, label = links.unionByName(new), _joined(label, new)
        unsettled = unsettled.where(F.size("items") <= steep.exact)
    # led marks members that have met all others at their item.
    members = stage(_rare_items(unsettled).withColumn("led", F.lit(False)), "rare")
    leaders = LEADERS
    while True:
        m = members.join(label, "uid", "left").select("key", "uid", "led", F.coalesce("label", "uid").alias("label"))
        # An item with one class, or with leaders only, is done.
        open_ = m.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("led").alias("all_led"))
        m = stage(m.join(open_.where("lo < hi AND NOT all_led").select("key"), "key"), "open")
        if m.isEmpty():
            return links, label
        # The next leaders: first one member of each class, then a second one of each, and so on.
        rest = m.where("NOT led").withColumn("nth", F.row_number().over(Window.partitionBy("key", "label").orderBy("uid")))
        rest = rest.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("nth", "uid")))
        rest = stage(rest.select("key", "uid", "label", (F.col("place") <= leaders).alias("leads")), "leaders")
        lead = rest.where("leads").select("key", F.col("uid").alias("lo"), F.col("label").alias("lead"))
        # Members that led before have met these; two leaders meet once.
        asked = rest.join(lead, "key").where("label != lead AND (uid > lo OR NOT leads)")
        asked = asked.select(F.greatest("uid", "lo").alias("a"), F.least("uid", "lo").alias("b")).distinct()
        new = stage(asked.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(new)
        new = stage(_verified(new, keys, items, verify, shared), "links")
        links, label = links.unionByName(new), _joined(label, new)
        led = m.where("led").select("key", "uid", "led").unionByName(rest.select("key", "uid", F.col("leads").alias("led")))
        members = stage(led, "members")
        leaders *= 64
