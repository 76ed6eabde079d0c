"""Document fingerprints: MinHash over five-word shingles.

``PERMUTATIONS`` universal hash permutations (x -> a * x + b modulo 2**32, a odd)
run in numpy over the shingles of a whole batch.  A fingerprint is the minimum of
each, cut to 16 bits, in hexadecimal.  Near duplicates come from signature bands joined in
Spark, with the Jaccard similarity of the shingle sets verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches
from reportlake.llm.near_duplicates import near_duplicate_classes
from reportlake.llm.shingles import mix, shingle_hashes

PERMUTATIONS = 128

#: Rows of a band, and bands: at a similarity of 0.8 a pair shares a band with probability 0.998.
BAND_ROWS = 6
BANDS = PERMUTATIONS // BAND_ROWS

SIMILARITY = 0.8

#: Code points of text handled at once in a worker.
BATCH_CHARS = 1 << 20

#: Documents of a range that is walked in order by one task, and the most ranges
#: there are: beyond that ranges grow, so that their bounds stay below 1 MB.
RANGE_ROWS = 2_000
MAX_RANGES = 100_000

_rng = np.random.default_rng(20240611)
_ODD = _rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)


def signatures(texts: Sequence[str]) -> np.ndarray:
    """(texts x permutations) of 16-bit values; all ones where a text has no words."""
    out = np.full((len(texts), PERMUTATIONS), 0xFFFF, np.uint16)
    hashes, at = shingle_hashes(texts)
    some = np.flatnonzero(at[1:] > at[:-1])
    if not len(some):
        return out
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = at[:-1][some]
    h = np.empty_like(x)
    for k in range(PERMUTATIONS):
        np.multiply(x, _ODD[k], out=h)
        np.add(h, _ADD[k], out=h)
        least = np.minimum.reduceat(h, starts)
        # The minimum is small; its bits are spread before it is cut.
        out[some, k] = (mix(least.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the permutations in which two signatures agree: an estimate of the Jaccard similarity."""
    return float(np.mean(a == b))


def fingerprint(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def band_keys(texts: Sequence[str]) -> list[np.ndarray]:
    """One 64-bit key per band; none for a text without words."""
    sig = signatures(texts).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(texts), BANDS)).copy()
    for k in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, k:BANDS * BAND_ROWS:BAND_ROWS] + np.uint64(1))
    empty = np.zeros(0, np.int64)
    return [keys[i].view(np.int64) if not (sig[i] == 0xFFFF).all() else empty for i in range(len(texts))]


def shingle_sets(texts: Sequence[str]) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    hashes, at = shingle_hashes(texts)
    return [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:])]


def jaccard_near(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SIMILARITY * (len(a) + len(b) - both)


def minhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, digest, class_id, is_kept, by bands and verified Jaccard similarity."""
    return near_duplicate_classes(docs, band_keys, shingle_sets, jaccard_near, id_col, text_col)


# --- each document, its edited text and the next document ------------------------------------


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of ``following``."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


def _in_order(docs: DataFrame) -> DataFrame:
    """(range, tail, id, text): rows dealt to ranges of ids; each range ends with the first row of the next.

    The bounds are ids of the table, found from the narrow id column; only one
    number per range comes to the driver.  After the last range the first follows.
    """
    spark = docs.sparkSession
    ids = docs.select("id").where("id IS NOT NULL")
    n = ids.count()
    n_ranges = min(max(1, n // RANGE_ROWS), MAX_RANGES)
    starts = np.zeros(0, np.int64)
    if n:
        cuts = [i / n_ranges for i in range(1, n_ranges)]
        row = ids.agg(F.min("id").alias("lo"), *([F.percentile_approx("id", cuts, max(10_000, 10 * n_ranges)).alias("cuts")] if cuts else [])).first()
        starts = np.unique(np.array([row.lo, *(row.cuts if cuts else [])], np.int64))
    shared = spark.sparkContext.broadcast(starts)
    no_id = docs.where("id IS NULL").limit(1).count() > 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        last = max(0, len(at) - 1)
        for batch in batches:
            col = batch.column(0)
            null = col.is_null().to_numpy(zero_copy_only=False)
            value = col.fill_null(0).to_numpy()
            home = np.where(null, 0, np.maximum(np.searchsorted(at, value, side="right") - 1, 0)).astype(np.int32)
            head = np.zeros(len(home), bool) if not len(at) else ~null & (at[home] == value)
            # The first rows of a range are also the tail of the range before; those of the table, of the last.
            if no_id:
                head = np.where(null, True, head & (home > 0))
            twice = np.flatnonzero(head)
            before = np.where(home[twice] > 0, home[twice] - 1, last).astype(np.int32)
            rows = pa.array(np.concatenate((np.arange(len(home)), twice)))
            out = batch.take(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((home, before))), pa.array(np.concatenate((np.zeros(len(home), bool), np.ones(len(twice), bool)))),
                 out.column(0), out.column(1)], names=["range", "tail", "id", "text"])

    dealt = docs.mapInArrow(deal, "range int, tail boolean, id long, text binary")
    return dealt.repartition(max(1, len(starts)), "range").sortWithinPartitions("range", "tail", "id", "text")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next id; rows of one id follow in order
    of their text; null ids come first; after the last row the first follows (a
    single row is its own next one).  Null texts count as empty.  Two texts
    without words are alike (1), one without words is unlike any other (0).  Ids
    are long integers.  Other columns are ignored; an empty table gives no rows.
    """
    arrow_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("text"))
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        """``rows``: (id, text, whether it yields a result, whether the row after it is its next one)."""
        texts = [r[1] for r in rows]
        at = [i for i, r in enumerate(rows) if r[2]]
        changed = [edited(texts[i], texts[i + 1]) for i in at]
        own, new = signatures(texts), signatures(changed)
        cols = list(zip(*[
            (rows[i][0], len(texts[i]), hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(own[i]),
             fingerprint(new[k]), likeness(own[i], new[k]), likeness(own[i], own[i + 1])) for k, (i, t) in enumerate(zip(at, changed))]))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []  # in order; a row yields a result once its next one stands behind it
        used, tailed = 0, None  # tailed: the range whose tail has come
        for batch in batches:
            for number, tail, key, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if tail and tailed == number:
                    continue  # the first row of the tail is the next one; more rows of its id are not
                text = raw.decode("utf-8", "replace")
                if tail:
                    tailed = number
                rows.append((key, text, not tail))
                used += len(text)
                if used >= BATCH_CHARS:
                    done = finish([*((k, t, y and i < len(rows) - 1) for i, (k, t, y) in enumerate(rows))])
                    if done.num_rows:
                        yield done
                    rows, used = rows[-1:], 0
        if len(rows) > 1:
            done = finish([*((k, t, y and i < len(rows) - 1) for i, (k, t, y) in enumerate(rows))])
            if done.num_rows:
                yield done

    return _in_order(plain).mapInArrow(run, schema).withColumnRenamed("id", id_col)
