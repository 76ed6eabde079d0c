"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Each source's documents are dealt into blocks.  Block k (from 0) of a source of
weight w is released at floor(k / w) and due by ceil((k + 1) / w).  In every slot
the released block with the earliest deadline goes next, so at any time each
source is less than one block away from its share.  Weights are fractions a / P
with whole a that add up to P, so all windows start anew every P slots: the
schedule of one period, P rows, serves blocks of all periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.common import running_totals
from reportlake.session import stage

#: Documents in a block.
BLOCK_DOCS = 64

#: Weights are rounded to this many parts, one part a source at least.
GRAIN = 1000

#: Columns that are added.
OUT = ("mix_block", "mix_place", "mix_release", "mix_deadline", "mix_slot")

#: Default targets: shares to this power, which lifts small sources.
TEMPER = 0.7


def tempered_weights(docs: DataFrame, source_col: str = "source", power: float = TEMPER) -> DataFrame:
    """(source, weight): weight is the source's number of documents to ``power``."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.pow(F.count(F.lit(1)), F.lit(power)).alias("weight"))


def period_schedule(weights: DataFrame, grain: int = GRAIN) -> DataFrame:
    """(source, a, period, k, release, deadline, slot): one row per slot of a period.

    ``weights`` (source, weight) has one row per source; weights need not add up to
    one; those that are null or not above 0 get the least share.  The table has
    ``grain`` rows and one more per source at most.
    """
    total = Window.partitionBy()
    w = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    parts = weights.select("source", w.alias("w")).withColumn("all", F.sum("w").over(total)).select(
        "source", F.greatest(F.lit(1), F.round(F.when(F.col("all") > 0, F.col("w") / F.col("all") * grain).otherwise(1))).cast("long").alias("a"))
    listed = parts.agg(F.array_sort(F.collect_list(F.struct("source", "a"))).alias("s"), F.sum("a").alias("p")).where("p IS NOT NULL")
    # One period, slot by slot: done[i] counts the blocks that source i has had.
    picked = """aggregate(sequence(0L, p - 1),
        named_struct('done', transform(s, x -> 0L), 'out', cast(array() AS array<int>)),
        (acc, t) -> transform(
            array(array_min(filter(
                transform(s, (x, i) -> named_struct(
                    'due', ((acc.done[i] + 1) * p + x.a - 1) div x.a,
                    'i', i,
                    'ready', acc.done[i] < x.a AND (acc.done[i] * p) div x.a <= t)),
                y -> y.ready))),
            best -> named_struct(
                'done', transform(acc.done, (n, i) -> n + if(i = best.i, 1L, 0L)),
                'out', concat(acc.out, array(best.i))))[0],
        acc -> acc.out)"""
    slots = listed.select("s", "p", F.expr(picked).alias("out")).select("s", "p", F.posexplode("out").alias("slot", "i"))
    k = F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1
    a = F.col("s")[F.col("i")]["a"]
    rows = slots.select(F.col("s")[F.col("i")]["source"].alias("source"), a.alias("a"), F.col("p").alias("period"), k.cast("long").alias("k"), F.col("slot").cast("long"))
    return rows.select("source", "a", "period", "k", F.expr("(k * period) div a").alias("release"),
                       F.expr("((k + 1) * period + a - 1) div a").alias("deadline"), "slot")


def pfair_mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source",
              block_docs: int = BLOCK_DOCS, grain: int = GRAIN) -> DataFrame:
    """``docs`` with mix_block, mix_place, mix_release, mix_deadline and mix_slot (all long) added.

    Reading by (mix_slot, mix_place) gives the mixture.  A source's documents are
    dealt into its blocks in a hashed order.  When a source has no blocks left, its
    slots stay empty and the others keep their proportions; no row is dropped or
    repeated.  Documents without a source form a source of their own; sources
    missing in ``weights`` get the least share; rows equal in all columns are
    interchangeable; columns of ``docs`` with these five names are replaced; an empty
    table gives no rows.
    """
    names = [c for c in docs.columns if c not in OUT]
    # Columns go by position inside, so that no name of theirs meets one of ours.
    own = [f"__c{i}" for i in range(len(names))]
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).toDF(*own)
    key, source = own[names.index(id_col)], own[names.index(source_col)]
    n = rows.count()
    sources = rows.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    given = tempered_weights(rows, source) if weights is None else weights
    given = given.select(F.col("source").alias("__s"), "weight")
    asked = sources.join(given, F.col("source").eqNullSafe(F.col("__s")), "left").select("source", "weight")
    # Rows by the grain and the number of sources, so it may be broadcast.
    schedule = stage(period_schedule(asked, grain), "schedule").withColumnRenamed("source", "__source")
    dealt = running_totals(rows, [source], [F.col(key), F.xxhash64(*own)], "nth", n)
    dealt = dealt.withColumn("block", F.expr(f"nth div {block_docs}")).withColumn("place", F.col("nth") % block_docs)
    shares = schedule.select("__source", "a", "period").distinct()
    dealt = dealt.join(F.broadcast(shares), F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    dealt = dealt.withColumns({"turn": F.expr("block div a"), "turn_k": F.expr("block % a")}).drop("a")
    turns = F.broadcast(schedule.drop("a", "period"))
    out = dealt.join(turns, F.col(source).eqNullSafe(F.col("__source")) & (F.col("turn_k") == F.col("k")))
    start = F.col("turn") * F.col("period")
    return out.select(*own, "block", "place", start + F.col("release"), start + F.col("deadline"), start + F.col("slot")).toDF(
        *names, *OUT)


def in_mixed_order(mixed: DataFrame) -> DataFrame:
    """The rows in the order of the mixture, as its files will have them."""
    return mixed.repartitionByRange("mix_slot", "mix_place").sortWithinPartitions("mix_slot", "mix_place")
