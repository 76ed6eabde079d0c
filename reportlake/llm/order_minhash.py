"""Near duplicates by Order MinHash.

The items of a text are its word 5-mers, each labelled with the number of its
earlier occurrences, so repeats count.  One sketch hashes all items by one
permutation, samples the ``LENGTH`` least, and keeps them in text order: two
texts share the sketch only if they share those 5-mers in the same order, which
follows edit similarity where plain MinHash is blind to order.  Each text has
``SKETCHES`` independent sketches, the keys of its buckets.  Texts of up to ``EXACT``
5-mers, of which a sketch would hold most or all, have their least items by one order
as keys instead (prefix filter): two that are near share one with certainty.  Texts that
share buckets with texts of other classes get a second, steeper family of sketches: more
and longer ones, which near texts still share but texts of a similarity of 0.7 hardly ever.
A candidate pair is verified by a banded alignment of the two 5-mer sequences.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from reportlake.llm.near_duplicates import Steep, near_duplicate_classes
from reportlake.llm.shingles import mix, shingle_hashes

#: Sampled k-mers of a sketch and sketches of a text.  At a similarity of 0.8 two of
#: 40 sketches agree with probability 0.987 where a pair has 65 5-mers in all, 0.994
#: from some 500 on; at 0.5 with 0.01.
LENGTH = 8
SKETCHES = 40

#: Sketches a pair shares at least to be verified.
SHARED = 2

#: Near duplicates have at least this similarity.
SIMILARITY = 0.8

#: Two near texts of at most so many 5-mers are always candidates.  A text of up to
#: ``SIMILARITY * EXACT`` 5-mers is near no longer one, so it needs no sketches.
EXACT = 64

#: Sampled k-mers and number of the steeper sketches.  At a similarity of 0.8 one of 240 agrees
#: with probability 0.99 (0.96 where a pair has 150 5-mers in all), at 0.7 with 0.32, at 0.6 with 0.02.
STEEP_LENGTH = 18
STEEP_SKETCHES = 240

#: One-bit minima that sum a text up: at a similarity of 0.8 texts differ in 51 of 512 on average, and
#: in more than 77 with a probability of 0.0001; at 0.7 in 77 on average.
BITS = 512
BITS_APART = 77

#: Numbers scored at once when steep sketches are drawn (32 MB).
STEEP_CELLS = 1 << 22

_rng = np.random.default_rng(20240607)


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of ``n`` permutations of 64-bit numbers."""
    return (_rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), _rng.integers(0, 2**63, n, dtype=np.uint64))


_FIRST, _STEEP, _MINIMA = _permutations(SKETCHES), _permutations(STEEP_SKETCHES), _permutations(BITS)


def occurrence_labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes of one text's k-mers with the number of earlier equal ones mixed in."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if new.all():
        return mix(hashes)
    place = np.arange(len(hashes))
    nth = np.empty(len(hashes), np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(hashes + nth * np.uint64(0xD1B54A32D192ED03))


def _sketches(items: np.ndarray, permutations: tuple[np.ndarray, np.ndarray], length: int) -> np.ndarray:
    """A key for each permutation: the ``length`` least of one text's labelled items, in text order."""
    odd, add = permutations
    if len(items) > length:
        step = max(1, STEEP_CELLS // len(items))
        least = np.concatenate([
            np.argpartition(items[None, :] * odd[i:i + step, None] + add[i:i + step, None], length - 1, axis=1)[:, :length]
            for i in range(0, len(odd), step)])
        least.sort(axis=1)  # back into text order
        items = items[least]
    else:
        items = np.broadcast_to(items, (len(odd), len(items)))
    keys = np.arange(len(odd), dtype=np.uint64)
    for k in range(items.shape[1]):
        keys = mix(keys + items[:, k])
    return keys.view(np.int64)


def order_sketches(hashes: np.ndarray) -> np.ndarray:
    """The ``SKETCHES`` keys of one text from its k-mer hashes in text order."""
    return _sketches(occurrence_labelled(hashes), _FIRST, LENGTH)


def steep_sketches(hashes: np.ndarray) -> np.ndarray:
    """The ``STEEP_SKETCHES`` keys of one text from its k-mer hashes in text order."""
    return _sketches(occurrence_labelled(hashes.view(np.uint64)), _STEEP, STEEP_LENGTH)


def minima_bits(hashes: np.ndarray) -> np.ndarray:
    """A bit of the least labelled item of one text by each of ``BITS`` permutations, in 64-bit words."""
    items = occurrence_labelled(hashes.view(np.uint64))
    odd, add = _MINIMA
    step = max(1, STEEP_CELLS // len(items))
    least = np.concatenate([(items[None, :] * odd[i:i + step, None] + add[i:i + step, None]).min(axis=1) for i in range(0, BITS, step)])
    return np.packbits((mix(least) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def prefix_keys(hashes: np.ndarray) -> np.ndarray:
    """``SHARED`` keys for each of the least items of one text, as many as near texts can differ in and one more.

    Near texts share one of them, and with it as many keys as a candidate pair needs.
    """
    items = np.sort(occurrence_labelled(hashes))[:len(hashes) - int(np.ceil(SIMILARITY * len(hashes) - 1e-9)) + 1]
    nth = np.arange(1, SHARED + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    return mix(items[:, None] + nth).ravel().view(np.int64)


def text_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of one text from its k-mer hashes in text order."""
    if len(hashes) > EXACT:
        return order_sketches(hashes)
    if len(hashes) <= SIMILARITY * EXACT:
        return prefix_keys(hashes)
    return np.concatenate((order_sketches(hashes), prefix_keys(hashes)))


def sign(texts: Sequence[str]) -> list[np.ndarray]:
    """Keys of each text; a text without words has none."""
    hashes, at = shingle_hashes(texts)
    return [text_keys(hashes[a:b]) if b > a else np.zeros(0, np.int64) for a, b in zip(at[:-1], at[1:])]


def aligned(a: Sequence[int], b: Sequence[int], band: int) -> int:
    """Length of the longest common subsequence that stays within ``band`` places of the diagonal.

    Bit-parallel, a row at a time: bit j of the row's word stands for place
    ``i - band + j`` of ``b``, so each row costs ``(2 * band + 1) / 64`` machine words.
    """
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << 2 * band + 1) - 1
    row, lost = full, 0  # zeros in row and lost count the common subsequence
    for i, x in enumerate(a):
        low = i - band
        if i:
            lost += not row & 1
            row = row >> 1 | 1 << 2 * band
        m = where.get(x, 0)
        m = (m >> low if low >= 0 else m << -low) & full
        if m:
            u = row & m
            row = (row + u | row & ~m) & full
    return lost + (2 * band + 1 - row.bit_count())


def similarity_at_least(a: Sequence[int], b: Sequence[int], least: float = SIMILARITY) -> bool:
    """Whether matched / (len(a) + len(b) - matched) of the best in-order matching reaches ``least``."""
    n, m = len(a), len(b)
    if not n or not m:
        return n == m
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))  # matches that give the similarity
    if min(n, m) < need:
        return False
    head = 0
    while head < min(n, m) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    if head + tail >= need:
        return True
    # At most n + m - 2 * need items stay unmatched, so no match is further off the diagonal.
    band = n + m - 2 * need
    return head + tail + aligned(a[head:n - tail], b[head:m - tail], band) >= need


def kmers(texts: Sequence[str]) -> list[np.ndarray]:
    """The 5-mer hashes of each text, in text order."""
    hashes, at = shingle_hashes(texts)
    return [hashes[a:b].view(np.int64) for a, b in zip(at[:-1], at[1:])]


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """``similarity_at_least``, but pairs with too few items in common are not aligned."""
    need = SIMILARITY * (len(a) + len(b)) / (1 + SIMILARITY) - 1e-9
    if min(len(a), len(b)) < need:
        return False
    x, y = np.sort(a), np.sort(b)
    if len(y) and np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x) < need:
        return False
    return similarity_at_least(a.tolist(), b.tolist())


def order_minhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, digest, class_id (least id of the class) and is_kept (one row a class).

    Cases of nulls, empty texts, repeated rows and empty tables: see
    ``near_duplicates.near_duplicate_classes``.
    """
    steep = Steep(steep_sketches, minima_bits, BITS // 64, BITS_APART, int(SIMILARITY * EXACT), EXACT)
    return near_duplicate_classes(docs, sign, kmers, near, id_col, text_col, SHARED, steep)
