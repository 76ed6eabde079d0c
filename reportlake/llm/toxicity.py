"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a learned word vector and the mean of the learned vectors of its
character n-grams (both by hashing), so unseen words have a meaning too.  Windows
of ``WINDOW`` words that overlap run through the network in both directions; attention
pools the states of a window.  The score of a text is that of its most toxic
window, calibrated on documents kept back from training.

Labels say nothing about single windows, so training is multiple-instance: of a
toxic document the window that scores highest now, of others the highest and a
random one.  Training runs on the driver over a bounded sample of labelled
documents; scoring runs in Arrow batches over everything.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches, by_bytes

WINDOW = 64
STRIDE = 52

#: Most documents of either class that training takes (chosen by a hash of their id).
TOXIC_DOCS = 800
OTHER_DOCS = 1600

#: A text is toxic from this score on.
THRESHOLD = 0.7

#: Hash slots of words and of n-grams, for evidence; learned vectors share ``VECTORS`` rows each.
SLOTS = 1 << 20
VECTORS = 1 << 14
WORD_DIM = GRAM_DIM = 8
HIDDEN = 8
#: Besides the learned vectors: the evidence of the word and the strongest of its n-grams.
INPUT = WORD_DIM + GRAM_DIM + 2

#: A word is frequent if this share of the training documents, and so many, have it.
FREQUENT_SHARE = 0.005
MIN_FREQUENT = 10

#: Likelihood ratio below which the evidence may be chance.
CHANCE = 15.0

BATCH_BYTES = 3 << 20

#: Words a worker remembers between batches; it starts anew beyond that.
CACHE_WORDS = 200_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int32)


def hashed_words(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each word, slots of character n-grams, word of each n-gram), n-grams in order of words.

    The n-grams are all of 3, 4 and 5 characters of the word with its ends marked,
    and the first 5, 7 and 9 characters.
    """
    n = len(words)
    lens = np.fromiter(map(len, words), np.int64, n) + 4
    codes = np.frombuffer("".join(f"^{w}$$$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lens)
    starts = ends - lens
    owner = np.repeat(np.arange(n, dtype=np.int32), lens)
    place = np.arange(len(codes)) - starts[owner]
    factor = np.uint64(0xD1B54A32D192ED03) ** np.arange(1, int(lens.max(initial=1)) + 1, dtype=np.uint64)
    word_ids = _slot(np.add.reduceat(codes * factor[place], starts) if n else np.zeros(0, np.uint64))
    ids, of = [], []
    rolled = codes.copy()
    for size in range(2, 6):
        rolled = rolled[:-1] * np.uint64(0x100000001B3) + codes[size - 1:]
        if size > 2:
            ok = np.flatnonzero(place[:len(rolled)] + size <= lens[owner[:len(rolled)]])
            ids.append(_slot(rolled[ok]))
            of.append(owner[ok])
    head = np.full(n, 7, np.uint64)
    for k in range(10 if n else 0):
        head = head * np.uint64(0x100000001B3) + np.where(k < lens, codes[np.minimum(starts + k, len(codes) - 1)], np.uint64(0))
        if k in (5, 7, 9):
            ids.append(_slot(head))
            of.append(np.arange(n, dtype=np.int32))
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return word_ids, np.concatenate(ids)[order], of[order]


def window_starts(n_words: int) -> list[int]:
    """Starts of the overlapping windows that cover a text; the last one ends with it."""
    if n_words <= WINDOW:
        return [0]
    return [*range(0, n_words - WINDOW, STRIDE), n_words - WINDOW]


# --- network ------------------------------------------------------------------------------


class Network:
    """Parameters, forward pass and gradients.  Gates are in the order update, reset, candidate."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)

        def small(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {k: (0.1 * r.standard_normal((VECTORS, n))).astype(np.float32) for k, n in (("words", WORD_DIM), ("grams", GRAM_DIM))}
        self.frequent = np.zeros(SLOTS, bool)
        self.word_evidence = np.zeros(SLOTS, np.float32)
        self.gram_evidence = np.zeros(SLOTS, np.float32)
        for d in "fb":
            self.p |= {f"W{d}": small(INPUT, 3 * HIDDEN), f"U{d}": small(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": small(2 * HIDDEN, 2 * HIDDEN), "a": small(2 * HIDDEN), "o": small(2 * HIDDEN), "o0": np.full(1, -1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, word_ids: np.ndarray, gram_ids: np.ndarray, gram_of: np.ndarray, n: int) -> np.ndarray:
        """(n x INPUT): vectors of n words from their slot and their (gram, word) pairs, in order of words."""
        if not n:
            return np.zeros((0, INPUT), np.float32)
        per = np.bincount(gram_of, minlength=n)
        first = np.cumsum(per) - per
        means = np.add.reduceat(self.p["grams"][gram_ids % VECTORS], first) / per[:, None].astype(np.float32)
        # Frequent words speak for themselves, rare ones by their n-grams.
        strongest = np.where(self.frequent[word_ids], 0, np.maximum.reduceat(self.gram_evidence[gram_ids], first))
        return np.concatenate((self.p["words"][word_ids % VECTORS], means, self.word_evidence[word_ids][:, None], strongest[:, None]), axis=1)

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What each word adds to the gates, for both directions, with a last row for padding."""
        return {d: np.concatenate((x @ self.p[f"W{d}"] + self.p[f"c{d}"], np.zeros((1, 3 * HIDDEN), np.float32))) for d in "fb"}

    def _run(self, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States (T x B x HIDDEN) of one direction; ``at`` (B x T) points into ``gates``."""
        u = self.p[f"U{d}"]
        n, steps = at.shape
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = gates[at[:, t]]
            hu = h @ u
            zr = 0.5 * np.tanh(0.5 * (g[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])) + 0.5
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
            m = mask[:, t, None]
            new = h + m * (1 - z) * (c - h)
            if keep is not None:
                keep.append((t, h, z, r, c, hu[:, 2 * HIDDEN:], m))
            h = new
            out[t] = h
        return out

    def forward(self, gates: dict[str, np.ndarray], at: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        kept = {d: [] if keep is not None else None for d in "fb"}
        s = np.concatenate([self._run(gates[d], at, mask, d, kept[d]) for d in "fb"], axis=2)
        q = np.tanh(s @ self.p["A"])
        e = np.where(mask.T > 0, q @ self.p["a"], -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", w, s)
        if keep is not None:
            keep |= {"s": s, "q": q, "w": w, "pooled": pooled, "steps": kept}
        return pooled @ self.p["o"] + self.p["o0"][0]

    def gradients(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray, float]:
        """(gradients of the dense parameters, gradient of x, loss) of the weighted logistic loss."""
        gates, keep = self.gates(x), {}
        logit = self.forward(gates, at, mask, keep)
        prob = 1 / (1 + np.exp(-logit))
        loss = float(np.mean(weight * (np.logaddexp(0, logit) - target * logit)))
        dl = (weight * (prob - target) / len(target)).astype(np.float32)
        s, q, w = keep["s"], keep["q"], keep["w"]
        g = {"o": keep["pooled"].T @ dl, "o0": np.array([dl.sum()], np.float32)}
        dpool = dl[:, None] * self.p["o"]
        dw = np.einsum("bh,tbh->tb", dpool, s)
        de = w * (dw - (w * dw).sum(axis=0))
        g["a"] = np.einsum("tb,tbk->k", de, q)
        dq = de[:, :, None] * self.p["a"] * (1 - q * q)
        g["A"] = np.einsum("tbh,tbk->hk", s, dq)
        ds = w[:, :, None] * dpool[None] + dq @ self.p["A"].T
        dx = np.zeros_like(x)
        order = np.argsort(at.T, axis=None, kind="stable")
        found, begin = np.unique(at.T.reshape(-1)[order], return_index=True)
        for i, d in enumerate("fb"):
            u = self.p[f"U{d}"]
            each = np.empty((at.shape[1], at.shape[0], 3 * HIDDEN), np.float32)
            du = np.zeros_like(u)
            dh = np.zeros((at.shape[0], HIDDEN), np.float32)
            for t, h, z, r, c, hc, m in reversed(keep["steps"][d]):
                dh = dh + ds[t, :, i * HIDDEN:(i + 1) * HIDDEN]
                dnew = m * dh
                dc = dnew * (1 - z) * (1 - c * c)
                dz = -dnew * (c - h) * z * (1 - z)
                dr = dc * hc * r * (1 - r)
                dpre = np.concatenate((dz, dr, dc), axis=1)
                dhu = np.concatenate((dz, dr, dc * r), axis=1)
                each[t] = dpre
                du += h.T @ dhu
                dh = dh - dnew * (1 - z) + dhu @ u.T
            dgates = np.zeros_like(gates[d])
            dgates[found] = np.add.reduceat(each.reshape(-1, 3 * HIDDEN)[order], begin)
            dgates = dgates[:-1]
            g |= {f"U{d}": du, f"W{d}": x.T @ dgates, f"c{d}": dgates.sum(axis=0)}
            dx += dgates @ self.p[f"W{d}"].T
        return g, dx, loss

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * logit + self.shift)))


@dataclass
class Vocabulary:
    """Words of some texts with their hash slots."""

    words: list[str]

    def __post_init__(self):
        parts = [hashed_words(self.words[i:i + 20_000]) for i in range(0, len(self.words), 20_000)] or [hashed_words([])]
        self.word_ids = np.concatenate([p[0] for p in parts])
        self.gram_ids = np.concatenate([p[1] for p in parts])
        self.gram_of = np.concatenate([p[2] + np.int32(20_000 * i) for i, p in enumerate(parts)])


def _windows(codes: np.ndarray, offsets: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows x WINDOW of word numbers, document of each window)."""
    starts, docs = [], []
    for d in range(len(offsets) - 1):
        own = window_starts(int(offsets[d + 1] - offsets[d]))
        starts += [offsets[d] + s for s in own]
        docs += [d] * len(own)
    docs = np.array(docs, np.int64)
    at = np.array(starts, np.int64)[:, None] + np.arange(WINDOW)
    inside = at < offsets[docs + 1][:, None]
    padded = np.append(codes, pad)
    return np.where(inside, padded[np.where(inside, at, len(codes))], pad), docs


def _coded(texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, number of each word, offsets of the texts)."""
    known: dict[str, int] = {}
    codes = []
    for t in texts:  # a text at a time: only numbers stay of its words
        words = words_of(t)
        codes.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in codes]))).astype(np.int64)
    return list(known), np.concatenate(codes) if codes else np.zeros(0, np.int32), offsets


# --- training -----------------------------------------------------------------------------


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _add_rows(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """table[rows] += values, where rows may repeat."""
    for k in range(table.shape[1]):
        table[:, k] += np.bincount(rows, weights=values[:, k], minlength=len(table))


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            params[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.99 ** self.t)) + 1e-7)


def _log_odds(hits: np.ndarray, rest: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Smoothed log-odds by how many toxic (``hits``) and other documents have each slot."""
    base = (toxic.sum() + 0.5) / (len(toxic) + 1)
    n = np.maximum(hits + rest, 1)
    # Shrunk by the likelihood ratio against the base rate, so chance finds carry no evidence.
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(hits > 0, hits * np.log(hits / n / base), 0) + np.where(rest > 0, rest * np.log(rest / n / (1 - base)), 0))
    odds = np.log((hits + 0.5) / (rest + 0.5) * (1 - base) / base)
    return (odds * np.maximum(0, 1 - CHANCE / np.maximum(ratio, 1e-9))).astype(np.float32)


def train(texts: Sequence[str], toxic: Sequence[bool], seed: int = 11, rounds: int = 4, epochs: int = 2) -> Network | None:
    """A network for labelled texts; None unless both classes are there."""
    toxic = np.asarray(toxic, bool)
    if toxic.all() or not toxic.any():
        return None
    r = np.random.default_rng(seed)
    net = Network(seed)
    words, codes, offsets = _coded(texts)
    vocabulary = Vocabulary(words)
    pad = len(words)
    at, docs = _windows(codes, offsets, pad)

    back = r.random(len(texts)) < 0.2  # documents kept back for calibration
    if not (toxic & back).any() or not (~toxic & back).any():
        back[:] = False
    fit = ~back
    word_doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    use = fit[word_doc]
    # Documents that have each word; an n-gram counts with each rare word that has it.
    pairs = _distinct(codes[use].astype(np.int64) * len(texts) + word_doc[use])
    of_word, bad = pairs // len(texts), toxic[pairs % len(texts)]
    hits, rest = np.bincount(of_word[bad], minlength=len(words)), np.bincount(of_word[~bad], minlength=len(words))

    def per_slot(slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.bincount(slots, weights=counts, minlength=SLOTS)

    base = toxic[fit]
    net.word_evidence = _log_odds(per_slot(vocabulary.word_ids, hits), per_slot(vocabulary.word_ids, rest), base)
    net.frequent = per_slot(vocabulary.word_ids, hits + rest) >= max(MIN_FREQUENT, FREQUENT_SHARE * fit.sum())
    rare = ~net.frequent[vocabulary.word_ids]
    net.gram_evidence = _log_odds(per_slot(vocabulary.gram_ids, (hits * rare)[vocabulary.gram_of]),
                                  per_slot(vocabulary.gram_ids, (rest * rare)[vocabulary.gram_of]), base)
    per = np.bincount(vocabulary.gram_of, minlength=len(words))
    first = np.cumsum(per) - per

    def word_inputs() -> np.ndarray:
        return net.inputs(vocabulary.word_ids, vocabulary.gram_ids, vocabulary.gram_of, len(words))

    # The first choice of windows goes by the evidence of their words alone.
    evidence = np.append(np.maximum(word_inputs()[:, -2:].sum(axis=1), 0), 0)
    score = np.sort(evidence[at], axis=1)[:, -3:].sum(axis=1)
    dense = [k for k in net.p if k not in ("words", "grams")]
    adam = Adam({k: net.p[k] for k in dense}, 0.01)
    for _ in range(rounds):
        order = np.lexsort((score, docs))
        best = order[np.append(docs[order][1:] != docs[order][:-1], True)]
        best = best[fit[docs[best]]]
        plain = np.flatnonzero(~toxic[docs] & fit[docs])
        chosen = np.concatenate((best, r.choice(plain, min(len(plain), len(best)), replace=False)))
        weight_of = np.where(toxic[docs[chosen]], (~toxic[docs[chosen]]).sum() / max(1, toxic[docs[chosen]].sum()) / 2, 1.0)
        for _ in range(epochs):
            mixed = r.permutation(len(chosen))
            for i in range(0, len(mixed), 256):
                part = mixed[i:i + 256]
                own, small = np.unique(at[chosen[part]], return_inverse=True)
                small = small.reshape(len(part), WINDOW)
                has_pad = own[-1] == pad
                own_words = own[:-1] if has_pad else own
                # Inputs of the words of this batch only.
                spread = np.repeat(first[own_words] - np.concatenate(([0], np.cumsum(per[own_words])[:-1])), per[own_words]) + np.arange(per[own_words].sum())
                gram_ids, gram_of = vocabulary.gram_ids[spread], np.repeat(np.arange(len(own_words)), per[own_words])
                x = net.inputs(vocabulary.word_ids[own_words], gram_ids, gram_of, len(own_words))
                mask = (small < len(own_words)).astype(np.float32)
                g, dx, _ = net.gradients(x, small, mask, toxic[docs[chosen[part]]].astype(np.float32), weight_of[part].astype(np.float32))
                norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                cut = min(1.0, 1.0 / max(norm, 1e-9))
                adam.step(net.p, {k: g[k] * np.float32(cut) for k in dense})
                # Plain steps for the sparse vectors.
                _add_rows(net.p["words"], vocabulary.word_ids[own_words] % VECTORS, -0.2 * dx[:, :WORD_DIM])
                _add_rows(net.p["grams"], gram_ids % VECTORS, -0.2 * dx[gram_of, WORD_DIM:WORD_DIM + GRAM_DIM] / per[own_words][gram_of][:, None])
        score = _logits(net, word_inputs(), at)
    top = np.full(len(texts), -np.inf, np.float32)
    np.maximum.at(top, docs, score)
    _calibrate(net, top[back] if back.any() else top, toxic[back] if back.any() else toxic)
    return net


def _calibrate(net: Network, logit: np.ndarray, toxic: np.ndarray) -> None:
    """Logistic regression of the label on the document's highest logit (with a light pull to the centre)."""
    centre, spread = float(logit.mean()), float(logit.std()) + 1e-6
    x, a, b = (logit - centre) / spread, 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - toxic) * x).sum() + 0.02 * a, (p - toxic).sum()])
        h = np.array([[(w * x * x).sum() + 0.02, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = max(a - step[0], 0.05), b - step[1]
    net.scale, net.shift = a / spread, b - a * centre / spread


def _logits(net: Network, x: np.ndarray, at: np.ndarray, chunk: int = 2048) -> np.ndarray:
    gates, pad = net.gates(x), len(x)
    out = np.empty(len(at), np.float32)
    for i in range(0, len(at), chunk):
        part = at[i:i + chunk]
        out[i:i + chunk] = net.forward(gates, part, (part < pad).astype(np.float32))
    return out


class Scorer:
    """Scores texts; keeps the input vectors of known words between batches."""

    def __init__(self, net: Network):
        self.net = net
        self.known: dict[str, int] = {}
        self.vectors = np.zeros((0, INPUT), np.float32)

    def _inputs(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known, self.vectors = {}, np.zeros((0, INPUT), np.float32)
        new = [w for w in words if w not in self.known]
        if new:
            v = Vocabulary(new)
            self.vectors = np.concatenate((self.vectors, self.net.inputs(v.word_ids, v.gram_ids, v.gram_of, len(new))))
            base = len(self.known)
            self.known |= {w: base + i for i, w in enumerate(new)}
        return self.vectors[np.fromiter((self.known[w] for w in words), np.int64, len(words))]

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """Probability of the most toxic window of each text; 0 without words."""
        words, codes, offsets = _coded(texts)
        out = np.zeros(len(texts))
        some = np.flatnonzero(np.diff(offsets) > 0)
        if not len(some):
            return out
        at, docs = _windows(codes, offsets, len(words))
        top = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(top, docs, _logits(self.net, self._inputs(words), at))
        out[some] = self.net.probability(top[some].astype(np.float64))
        return out


# --- Spark ----------------------------------------------------------------------------------


def held_out(doc_id) -> object:
    """Rows never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             toxic_docs: int = TOXIC_DOCS, other_docs: int = OTHER_DOCS) -> Network | None:
    """Train on at most ``toxic_docs`` and ``other_docs`` labelled documents that are not held out.

    Ids are chosen by a hash, among all labels; only the texts of those come to the driver.
    Null labels and ids are left out; an id with several labels counts as toxic if one says so,
    and of an id with several texts one is taken (the least by its digest).
    """
    own = (labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
           .where(~held_out(F.col("id"))).groupBy("id").agg((F.max("toxic") == 1).alias("toxic")))
    own = own.select("id", "toxic", F.xxhash64(F.col("id"), F.lit(5)).alias("h"))
    few = [own.where("toxic").orderBy("h", "id").limit(toxic_docs), own.where(~F.col("toxic")).orderBy("h", "id").limit(other_docs)]
    chosen = F.broadcast(few[0].unionByName(few[1]).select("id", "toxic"))  # toxic_docs + other_docs rows at most
    got = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
           .join(chosen, "id").groupBy("id", "toxic").agg(F.min(F.struct(F.md5("text").alias("h"), "text")).alias("t"))
           .orderBy("id").select("toxic", F.col("t.text").alias("text")).toArrow())
    return train(got.column("text").to_pylist(), got.column("toxic").to_pylist()) if got.num_rows else None


def score_documents(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity_score`` (double) and ``toxicity`` (int, 1 from ``THRESHOLD`` on) added.

    Every overlapping window of every whole text is scored.  Null texts, texts
    without words and, without a network, all texts score 0.  All rows and columns
    stay; columns of these two names are replaced.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = docs.drop("toxicity_score", "toxicity")
    if net is None:
        return docs.withColumns({"toxicity_score": F.lit(0.0), "toxicity": F.lit(0)})
    at = docs.columns.index(text_col)
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in by_bytes(batches, at, BATCH_BYTES):
            score = scorer.scores([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=[*batch.schema.names, "toxicity_score", "toxicity"])

    out = ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), "toxicity_score double", "toxicity int"])
    return docs.mapInArrow(run, out)
