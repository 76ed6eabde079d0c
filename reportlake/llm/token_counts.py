"""Token counts: lengths only, from Arrow functions over batches balanced by bytes.

A text is cut at safe boundaries: before a blank whose left neighbour is no
white space.  A byte-level pre-tokeniser never makes a token across such a
place, and an added token holds no blank, so the counts of the pieces add up to
the count of the whole text.  Pieces that recur in a batch are encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches, by_bytes

#: UTF-8 bytes of text handled at once in a worker.
BATCH_BYTES = 8 << 20

#: Texts above this are cut into segments of about this many characters first.
SEGMENT_CHARS = 1 << 20

#: Piece counts a worker remembers between batches; it starts anew beyond that.
CACHE_PIECES = 300_000


def safe_segments(text: str, limit: int = SEGMENT_CHARS) -> list[str]:
    """Cut a long text before blanks that follow a non-blank; a text without such a place stays whole."""
    out, start, n = [], 0, len(text)
    while n - start > limit:
        cut = text.find(" ", start + limit)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut <= 0:
            break
        out.append(text[start:cut])
        start = cut
    out.append(text[start:])
    return out


def safe_pieces(text: str) -> list[str]:
    """The pieces of a text between all its safe boundaries; joined they are the text."""
    out: list[str] = []
    for i, part in enumerate(text.split(" ")):
        if i == 0:
            out.append(part)
        elif not out[-1] or out[-1][-1].isspace():
            out[-1] += " " + part
        else:
            out.append(" " + part)
    return out


class PieceCounter:
    """Counts tokens of texts by their pieces with one ``tokenizers`` model."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def lengths(self, pieces: list[str]) -> np.ndarray:
        new = list({p for p in pieces if p not in self.known})
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
            new = list(set(pieces))
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[p] = len(e)
        known = self.known
        return np.fromiter((known[p] for p in pieces), np.int64, len(pieces))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; null counts as empty."""
        if not len(texts):
            return np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        words = coded.dictionary.to_pylist()
        # A piece that is empty or ends in white space makes the next boundary unsafe.
        loose = np.fromiter((not w or w[-1].isspace() for w in words), bool, len(words))
        first, last = offsets[:-1] - offsets[0], offsets[1:] - offsets[0] - 1
        unsafe = loose[codes]
        unsafe[last] = False  # no boundary follows the last piece of a text
        before = np.concatenate(([0], np.cumsum(unsafe)))
        rough = before[last + 1] - before[first] > 0
        lens = self.lengths([" " + w for w in words])[codes]
        starts = pc.take(coded.dictionary, pa.array(codes[first])).to_pylist()
        lens[first] = self.lengths(starts)
        total = np.add.reduceat(lens, first)
        for i in np.flatnonzero(rough):
            total[i] = int(self.lengths(safe_pieces(texts[int(i)].as_py())).sum())
        return total


def count_tokens(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    Null texts count as empty (0 bytes, 0 tokens); null ids and repeated rows stay
    as they are; other columns of ``docs`` are ignored; an empty table gives no rows.
    ``tokenizer_file`` must be readable at the same place on every executor.
    Special strings inside texts are treated as the tokeniser does by default;
    none are added.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer_file)
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            if pc.max(sizes).as_py() > SEGMENT_CHARS:
                segments = [safe_segments(t or "") for t in texts.to_pylist()]
                flat = [s for group in segments for s in group]
                counts = np.concatenate([counter.count(pa.array(flat[i:i + 8], pa.string())) for i in range(0, len(flat), 8)])
                n = np.add.reduceat(counts, np.concatenate(([0], np.cumsum([len(g) for g in segments])[:-1])))
            else:
                n = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(n, pa.int64()), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("id", id_col))
