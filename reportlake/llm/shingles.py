"""Word shingles as hashed numbers, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash

#: Words in a shingle.
WIDTH = 5

_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a one-to-one map)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: Sequence[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the shingles of text i, in text order, are hashes[offsets[i]:offsets[i+1]].

    A text of fewer than ``width`` words but one at least has one shingle, all its
    words; a text without words has none.  Words are what white space parts.
    """
    words = [t.split() for t in texts]
    lens = np.fromiter(map(len, words), np.int64, len(words))
    total = int(lens.sum())
    counts = np.where(lens == 0, 0, np.maximum(lens - width + 1, 1))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    if not total:
        return np.zeros(0, np.uint64), offsets
    coded = pa.array([w for ws in words for w in ws], pa.large_string()).dictionary_encode()
    of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64)
    ids = of_word[coded.indices.to_numpy()]
    # Padding lets the windows of the last words be computed too; they are not taken below.
    ids = np.concatenate((ids, np.zeros(width, np.uint64)))
    rolled = np.zeros(total, np.uint64)
    for k in range(width):
        rolled = rolled * _STEP + ids[k:k + total]
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    doc = np.repeat(np.arange(len(words)), counts)
    at = starts[doc] + np.arange(len(doc)) - offsets[doc]
    out = mix(rolled[at])
    for i in np.flatnonzero((lens > 0) & (lens < width)):
        out[offsets[i]] = xxhash.xxh64_intdigest("\n".join(words[i]), seed=1)
    return out, offsets
