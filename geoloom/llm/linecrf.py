"""Document quality from a linear-chain conditional random field over lines.

Every line with a word gets features of itself and of its neighbours; the chain
of good/bad labels has one potential per line and a 2 x 2 transition table.
Labels exist for documents only, so lines start with the label of their
document; one more round relabels the lines of bad documents by the first model
(its worst line stays bad). A document's quality is the mean of its lines'
marginals P(good), weighted by their characters, put on the scale of the labels
by a one-variable logistic fit.

Only the fit uses a sample: at most ``SAMPLE_DOCS`` labelled documents of each
class with at most ``SAMPLE_BYTES`` bytes each, those with the smallest hashes
of their ids. Every text is scored whole.

Defined results: a null or empty text, or one without words, has quality 0;
with no usable labels of both classes every score is the share of label 1
(0.5 without labels); null and other labels than 0 and 1 are ignored, of
repeated labels the lower counts; repeated rows score alike; an empty table
gives no rows; further columns are left alone.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCS = 1500
SAMPLE_BYTES = 100_000
#: Line measures, see ``line_features``; those from 0 to SHARED - 1 also count for the neighbouring lines.
MEASURES, SHARED = 11, 6
WIDTH = 1 + MEASURES + 2 * (SHARED + 1)
L2 = 1e-3


def _classes() -> np.ndarray:
    """Class of a code point below 384: 1 odd sign, 2 upper case, 3 letter else, 4 digit, 0 anything else."""
    out = np.zeros(384, np.uint8)
    for c in range(384):
        s = chr(c)
        out[c] = 2 if s.isupper() else 3 if s.isalpha() else 4 if s.isdigit() else 1 if s in "#*$%&|<>!@^~=_+\\{}[]`" else 0
    return out


CLASSES = _classes()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, characters of each line) of the lines that have a word."""
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    if not lines:
        return np.zeros((0, WIDTH)), np.zeros(0)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = CLASSES[np.minimum(codes, 383)]
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    odd, upper, lower, digit = (np.add.reduceat((kinds == k).astype(np.int64), first) for k in (1, 2, 3, 4))
    seen: set[str] = set()
    words = np.empty((len(lines), 5))
    for k, line in enumerate(lines):
        w = line.split()
        n, pairs = len(w), max(1, len(w) - 1)
        words[k] = (
            n,
            sum(map(operator.eq, w, w[1:])) / pairs,
            1 - len(set(zip(w, w[1:]))) / pairs if n > 1 else 0,
            line[-1] in ".!?:;\"'",
            line in seen,
        )
        seen.add(line)
    n = words[:, 0]
    own = np.stack([
        np.minimum(1, odd / n), odd / size, upper / np.maximum(1, upper + lower), words[:, 1], words[:, 2], words[:, 4],
        digit / size, words[:, 3], np.minimum(1, np.log1p(n) / 6), np.minimum(1, size / n / 20), n < 4,
    ], axis=1)
    near = np.zeros((len(lines) + 2, SHARED + 1))
    near[1:-1, :SHARED], near[[0, -1], SHARED] = own[:, :SHARED], 1  # the last column: no such neighbour
    return np.concatenate([np.ones((len(lines), 1)), own, near[:-2], near[2:]], axis=1), size.astype(float)


class Chains:
    """Documents of a batch, longest first, so that step t of all chains is one array operation."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        self.starts, sizes = starts[order], lengths[order]
        self.active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")

    def marginals(self, emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of every line, expected transitions, and the sum of the log normalisers.

        ``emission``: log potential of good against bad; ``moves``: potentials of (from, to).
        """
        n = len(emission)
        obs = np.exp(np.stack([np.zeros(n), np.clip(emission, -40, 40)], axis=1))
        ahead, scale = np.empty((n, 2)), np.empty(n)
        for t, k in enumerate(self.active):
            at = self.starts[:k] + t
            p = obs[at] if t == 0 else (ahead[at - 1] @ moves) * obs[at]
            scale[at] = p.sum(axis=1)
            ahead[at] = p / scale[at][:, None]
        back, pairs = np.ones((n, 2)), np.zeros((2, 2))
        for t in range(len(self.active) - 1, 0, -1):
            at = self.starts[: self.active[t]] + t
            right = obs[at] * back[at] / scale[at][:, None]
            pairs += moves * (ahead[at - 1].T @ right)
            back[at - 1] = right @ moves.T
        both = ahead * back
        return both[:, 1] / both.sum(axis=1), pairs, float(np.log(scale).sum())


@dataclass
class Model:
    weights: np.ndarray
    moves: np.ndarray
    slope: float
    shift: float

    def quality(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean of P(good) of each text."""
        parts = [line_features(t or "") for t in texts]
        lengths = np.array([len(s) for _, s in parts], np.int64)
        if not lengths.sum():
            return np.zeros(len(texts))
        good, _, _ = Chains(lengths).marginals(np.concatenate([x for x, _ in parts]) @ self.weights, self.moves)
        return _weighted(good, np.concatenate([s for _, s in parts]), lengths)

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.quality(texts) + self.shift)))


def _weighted(good: np.ndarray, size: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(lengths)), lengths)
    total = np.bincount(doc, size, len(lengths))
    return np.bincount(doc, good * size, len(lengths)) / np.maximum(total, 1)


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Train on whole documents with labels 0 (bad) and 1 (good)."""
    share = float(labels.mean()) if len(labels) else 0.5
    flat = Model(np.zeros(WIDTH), np.ones((2, 2)), 0.0, float(np.log(share / (1 - share))) if 0 < share < 1 else (share - 0.5) * 20)
    if not 0 < share < 1:
        return flat
    parts = [line_features(t) for t in texts]
    lengths = np.array([len(s) for _, s in parts], np.int64)
    if not lengths.sum():
        return flat
    x, size = np.concatenate([p for p, _ in parts]), np.concatenate([s for _, s in parts])
    doc = np.repeat(np.arange(len(lengths)), lengths)
    chains, y = Chains(lengths), labels[doc].astype(float)
    weights, moves = _fit_chain(x, y, chains, doc)
    good, _, _ = chains.marginals(x @ weights, moves)
    worst = np.full(len(lengths), np.inf)
    np.minimum.at(worst, doc, good)
    y = np.where(labels[doc] == 1, 1.0, (good > 0.5) & (good > worst[doc]))
    weights, moves = _fit_chain(x, y, chains, doc)
    good, _, _ = chains.marginals(x @ weights, moves)
    slope, shift = _logistic(_weighted(good, size, lengths), labels)
    return Model(weights, moves, slope, shift)


def _fit_chain(x: np.ndarray, y: np.ndarray, chains: Chains, doc: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Maximum conditional likelihood (with an L2 penalty) by Adam steps on the whole sample."""
    inside = np.flatnonzero(doc[1:] == doc[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inside].astype(int), y[inside + 1].astype(int)), 1)
    n, theta = len(x), np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        moves = np.exp(theta[-4:].reshape(2, 2))
        good, pairs, _ = chains.marginals(x @ theta[:-4], moves)
        slope = np.concatenate([x.T @ (good - y), (pairs - seen).ravel()]) / n + L2 * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta -= 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-4], np.exp(theta[-4:].reshape(2, 2))


def _logistic(q: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of y on q, by damped Newton steps; classes weigh alike."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    design, beta = np.stack([q, np.ones_like(q)], axis=1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(design @ beta)))
        slope = design.T @ (weight * (p - y)) + L2 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + L2 * np.eye(2)
        beta = beta - np.linalg.solve(curve, slope)
    return float(beta[0]), float(beta[1])


def held_out(key: Column) -> Column:
    """Rows that never train: crc32 of the key as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    rows = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    rows = rows.where(F.col("k").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("k"))).groupBy("k").agg(F.min("y").alias("y"))
    pick = [rows.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(sample_docs) for y in (0, 1)]
    # At most 2 * sample_docs ids: the broadcast has a fixed bound.
    chosen = F.broadcast(pick[0].unionByName(pick[1]))
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.octet_length("t") <= sample_bytes)
    got = texts.join(chosen, "k").groupBy("k").agg(F.min("t").alias("t"), F.min("y").alias("y")).orderBy("k").collect()
    return fit([r["t"] for r in got], np.array([r["y"] for r in got], dtype=float))


def score(model: Model):
    """Column function: score of a text, 0 to 1."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = np.empty(len(texts))
        for a in range(0, len(texts), 500):
            out[a : a + 500] = model.score([t.as_py() for t in texts[a : a + 500]])
        return pa.array(out)

    return scored


def quality(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score is at least 0.5)."""
    clash = {"score", "predicted"} & {c.lower() for c in docs.columns}
    kept = docs.drop(*[c for c in docs.columns if c.lower() in clash])
    scored = kept.withColumn("score", score(train(docs, labels, key=key, text=text))(F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
