"""Sharding by balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked.  A group of copies is a clique, so its
state is small: how many of its documents lie in each shard.  In each round a
group's documents want to move to the shard where most of their neighbours are,
among the shards with room; a shard takes no more than its quota.  Documents
without links are placed last and make the counts even: they cut no link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.common import running_totals
from reportlake.session import stage

#: Rounds of label propagation at most; it ends before, as soon as nothing moves.
ROUNDS = 12


def _loads(state: DataFrame, targets: DataFrame) -> DataFrame:
    """(shard, room) for all shards; ``targets`` has a row per shard, so this is small by construction."""
    used = state.groupBy("shard").agg(F.sum("n").alias("used"))
    return targets.join(used, "shard", "left").select("shard", (F.col("target") - F.coalesce("used", F.lit(0))).alias("room"))


def _start(groups: DataFrame, n_shards: int) -> DataFrame:
    """(link, shard, n): the documents of a group dealt round the shards, from a shard that its hash says."""
    k = F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(n_shards)).cast("int") - 1))
    dealt = groups.select("link", "n", k.alias("k"))
    return dealt.select(
        "link", F.pmod(F.xxhash64("link") + F.col("k"), F.lit(n_shards)).cast("int").alias("shard"),
        (F.expr(f"n div {n_shards}") + F.when(F.col("k") < F.col("n") % n_shards, 1).otherwise(0)).alias("n"))


def _within_quota(state: DataFrame, targets: DataFrame, n_rows: int) -> DataFrame:
    """Take from shards that are over their target what is too much; it goes to the pool (shard -1)."""
    over = _loads(state, targets).where("room < 0").select("shard", (-F.col("room")).alias("excess"))
    cut = state.join(F.broadcast(over), "shard", "left")
    sums = running_totals(cut.where("excess IS NOT NULL"), ["shard"], [F.col("n"), F.col("link")], "ahead", n_rows, F.col("n"))
    out = F.least(F.col("n"), F.greatest(F.lit(0), F.col("excess") - F.col("ahead")))
    kept = sums.select("link", "shard", (F.col("n") - out).alias("n")).where("n > 0")
    pool = sums.select("link", F.lit(-1).alias("shard"), out.alias("n")).where("n > 0").groupBy("link", "shard").agg(F.sum("n").alias("n"))
    return cut.where("excess IS NULL").select("link", "shard", "n").unionByName(kept).unionByName(pool)


def _propagate(state: DataFrame, targets: DataFrame, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """(next state, accepted moves) of one round."""
    room = _loads(state, targets)
    strength = F.struct("n", F.xxhash64("link", "shard").alias("tie"), "shard")
    ranked = state.join(F.broadcast(room), "shard").select("link", "shard", "n", "room", strength.alias("strength"))
    best = ranked.where("room > 0").groupBy("link").agg(F.max("strength").alias("best"))
    wish = ranked.join(best, "link").where("strength < best").select(
        "link", "shard", "n", F.col("best.shard").alias("to"), F.col("best.n").alias("pull"))
    # Each shard admits up to its room: the parts with most neighbours there come first within a block.
    asked = running_totals(wish, ["to"], [-F.col("pull"), F.col("link"), F.col("shard")], "ahead", n_rows, F.col("n"))
    admitted = asked.join(F.broadcast(room.withColumnRenamed("shard", "to")), "to")
    moves = stage(admitted.select(
        "link", "shard", "to", F.least(F.col("n"), F.greatest(F.lit(0), F.col("room") - F.col("ahead"))).alias("moved")).where("moved > 0"), "moves")
    gone = moves.select("link", "shard", (-F.col("moved")).alias("n"))
    come = moves.select("link", F.col("to").alias("shard"), F.col("moved").alias("n"))
    new = state.unionByName(gone).unionByName(come).groupBy("link", "shard").agg(F.sum("n").alias("n")).where("n > 0")
    return stage(new, "shards"), moves


def _place_by(intervals: Column, at: Column) -> Column:
    """The shard of the interval (upto, shard) that holds place ``at``; intervals ascend."""
    return F.filter(intervals, lambda p: p["upto"] > at)[0]["shard"]


def propagate_shards(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                     rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: the counts of any two shards differ by one at most.  Slots
    of a shard are gapless from 0.  Null texts count as empty (size 16); they and
    empty texts are copies of each other.  Null ids and repeated rows are rows like
    others; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stage(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.md5(text)).alias("link")), "rows")
    n = rows.count()
    spark = docs.sparkSession
    targets = spark.range(n_shards).select(
        F.col("id").cast("int").alias("shard"), (F.lit(n // n_shards) + F.when(F.col("id") < n % n_shards, 1).otherwise(0)).cast("long").alias("target"))

    groups = stage(rows.groupBy("link").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
    state = stage(_start(groups, n_shards), "shards")
    for _ in range(rounds):
        state, moves = _propagate(state, targets, n)
        if moves.isEmpty():
            break
    state = stage(_within_quota(state, targets, n), "shards")

    # Documents of a group are alike: the first of its order go to its first part, and so on.
    upto = Window.partitionBy("link").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    parts = state.withColumn("upto", F.sum("n").over(upto)).groupBy("link").agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("parts"))
    # Groups without parts are single documents.
    tied = running_totals(rows.join(groups.select("link"), "link", "left_semi"), ["link"], [F.col("id")], "nth", n)
    grouped = tied.join(parts, "link").select("id", "size", "text_crc32", "link", _place_by(F.col("parts"), F.col("nth")).alias("shard"))
    single = rows.join(groups.select("link"), "link", "left_anti").select("id", "size", "text_crc32", "link", F.lit(-1).alias("shard"))
    labelled = stage(grouped.unionByName(single), "labelled")

    # The pool fills what is left of every target; the gaps are one number per shard.
    gaps = _loads(labelled.where("shard >= 0").groupBy("shard").agg(F.count(F.lit(1)).alias("n")), targets)
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    fill = gaps.withColumn("upto", F.sum("room").over(ahead)).agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("fill"))
    pool = running_totals(labelled.where("shard < 0"), [], [F.col("id"), F.col("link")], "nth", n)
    filled = pool.crossJoin(F.broadcast(fill)).select("id", "size", "text_crc32", "link", _place_by(F.col("fill"), F.col("nth")).alias("shard"))
    placed = stage(labelled.where("shard >= 0").unionByName(filled), "placed")
    slots = running_totals(placed, ["shard"], [F.col("id"), F.col("link")], "slot", n)
    return slots.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
