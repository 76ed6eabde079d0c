"""Conflict-constrained best-fit packing of documents into bins of fixed size.

Documents are measured in UTF-8 bytes plus one for the separator behind them.  A
document longer than a bin is cut; its full pieces fill bins of their own and the
rest is packed.  Two documents of one source, or of one cluster of duplicates,
never share a bin.  Bins are ordered by residual space and carry bitmaps of their
sources and clusters; a document takes the tightest bin that fits, and the search
goes on to the successor until one has neither of its bits set.

Documents are dealt into blocks of about ``BLOCK_DOCS`` by a hash, or where their
order counts by runs of it; a block is packed by one task from narrow rows, longest
document first.  Bins are numbered by blocks.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlake.session import stage

#: Bytes a bin holds.
CAPACITY = 8192

#: Documents packed together, on average.
BLOCK_DOCS = 2000


class Bins:
    """Open bins in order of residual space, with bitmaps of what they hold."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, bin), ascending
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, start within it) for a document with one source bit and one cluster bit (0: no cluster)."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not (self.sources[b] & source or self.clusters[b] & cluster):
                del self.order[at]
                break
            at += 1
        else:
            residual, b = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if residual > size:
            insort(self.order, (residual - size, b))
        return b, self.capacity - residual

    def fill(self) -> int:
        """A new bin that a full piece takes whole."""
        self.sources.append(-1)
        self.clusters.append(-1)
        return len(self.sources) - 1


def pack(sizes: Sequence[int], sources: Sequence[object], clusters: Sequence[object], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Pieces (document, piece, start in document, size, bin, start in bin) of documents in the given order."""
    often = Counter(clusters)
    cluster_bits = {c: 1 << i for i, c in enumerate(k for k, n in often.items() if n > 1)}
    source_bits = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    bins, out = Bins(capacity), []
    rests = []
    for d, size in enumerate(sizes):
        full = size // capacity
        out += [(d, k, k * capacity, capacity, bins.fill(), 0) for k in range(full)]
        if size % capacity:
            rests.append((-(size % capacity), d, full))
    for size, d, full in sorted(rests):
        b, at = bins.place(-size, source_bits[sources[d]], cluster_bits.get(clusters[d], 0))
        out.append((d, full, full * capacity, -size, b, at))
    return out


def in_file_order(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the place of each row (long, from 0) in the order of its Parquet files in column ``name``.

    Files are in the order of their part numbers, then paths.  Rows that do not come
    straight from files are written first, in the order they have.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = stage(docs, "in-order")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*names, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    part = F.regexp_extract("__file", r"/part-(\d+)[^/]*$", 1)
    # One row per file.
    files = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(F.expr("try_cast(part AS long)"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("part", part).select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return rows.join(files, "__file").select(*names, (F.col("__start") + F.col("__row")).alias(name))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", cluster_col: str | None = None, block_docs: int = BLOCK_DOCS,
                   place_col: str | None = None) -> DataFrame:
    """One row per piece: id, source, piece, piece_start, piece_bytes, bin, bin_start.

    ``cluster_col`` names the cluster of duplicates of a row; by default equal
    texts are a cluster.  ``place_col`` gives each row its place from 0 (see
    ``in_file_order``): then every ``block_docs`` places are packed together, and their
    bins come before those of later places.  Pieces of one document cover its bytes and the separator,
    gapless and in order.  Null and empty texts are one separator long; rows
    without a source share a source, rows with a null in ``cluster_col`` are in no
    cluster; repeated rows are packed as often as they occur (apart, if they have a
    cluster); other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cluster = F.md5(text) if cluster_col is None else F.col(cluster_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       (F.octet_length(text) + 1).cast("long").alias("size"), cluster.alias("cluster"),
                       *([] if place_col is None else [F.col(place_col).alias("place")]))
    if place_col is None:
        n_blocks = max(1, -(-docs.count() // block_docs))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "cluster", "size"), F.lit(n_blocks)))
    else:
        rows = rows.withColumn("block", F.expr(f"place div {block_docs}")).drop("place")
    kind = dict(rows.dtypes)["id"]
    columns = ["id", "source", "piece", "piece_start", "piece_bytes", "bin", "bin_start"]

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        # The same order whatever order the rows arrived in, so a task run again gives the same bins.
        pdf = pdf.sort_values(["size", "id", "cluster", "source"], ascending=[False, True, True, True], kind="stable", na_position="first")
        ids, sources, at = pdf["id"].tolist(), [None if pd.isna(s) else s for s in pdf["source"]], int(pdf["block"].iloc[0])
        clusters = [object() if pd.isna(c) else c for c in pdf["cluster"]]
        found = pack(pdf["size"].tolist(), sources, clusters, capacity)
        return pd.DataFrame([(ids[d], sources[d], k, a, size, (at << 32) + b, start) for d, k, a, size, b, start in found], columns=columns)

    schema = f"id {kind}, source string, piece long, piece_start long, piece_bytes long, bin long, bin_start long"
    return rows.groupBy("block").applyInPandas(block, schema).withColumnsRenamed({"id": id_col, "source": source_col})
