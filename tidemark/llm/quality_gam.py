"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text falls into a bin. Shallow trees over the bins of one feature are
boosted in turns, feature by feature, each adding a small step to that feature's lookup
table; then trees over the bins of two features do the same for the pairs that explain most
of what is left. A score is the logistic of the sum of the looked-up values; with ``cut``, the
sum is moved so that a text as likely under either label, both labels weighed alike, scores
``cut``. Else a rare label is only predicted where it outweighs its rarity.

Features are computed in Spark for whole texts. The model is fitted on a bounded sample:
the ``SAMPLE`` labelled rows with the smallest hashes of their ids. That bound keeps the fit
(a few megabytes of numbers) the same size for any corpus; everything else covers all rows.

Defined cases: null and empty texts have all features 0 and get the score of those bins. Labels that are
null are ignored; several labels of a document count separately. Without any label the score
is 0.5; with labels of one kind only, it is their smoothed share. Equal texts get equal
scores; repeated rows and null ids are kept row by row. Features of a very long text are those
of the whole text; it has to fit a row. Other columns are neither read nor returned. An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers

SAMPLE = 16_384
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE, LEAF = 150, 60, 0.15, 1.0, 3.0
FEATURES = (
    "log_words", "word_length", "distinct_share", "same_as_previous", "upper_share", "digit_share", "symbol_share",
    "shout_share", "bar_share", "comma_share", "non_ascii_share", "dup_line_share", "line_words", "longest_word",
)
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_SYMBOLS, _COMMAS = b"#*$%&<>@^~_=+{}[]\\", b",.;:"
_HIGH = bytes(range(128, 256))


def features(text: bytes | None) -> list[float]:
    """The features of one whole text, from its UTF-8 bytes."""
    words = (text or b"").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    chars = size - sum(map(text.count, (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")))
    share = lambda drop: (size - len(text.translate(None, drop))) / chars
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        np.log2(n + 1),
        chars / n,
        len(set(words)) / n ** 0.9,
        sum(map(eq, words, words[1:])) / n,
        share(_UPPER),
        share(_DIGITS),
        share(_SYMBOLS),
        (text.count(b"!") + text.count(b"?")) / n,
        text.count(b"|") / n,
        share(_COMMAS),
        share(_HIGH),
        (len(lines) - len(set(lines))) / max(len(lines), 1),
        np.log2(n / max(len(lines), 1) + 1),
        np.log2(max(map(len, words)) + 1),
    ]


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray]
    tables: np.ndarray  # feature, bin
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray  # pair, coarse bin, coarse bin
    shift: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        out = self.intercept + self.tables[np.arange(len(self.edges)), at].sum(axis=1)
        coarse = at * PAIR_BINS // BINS
        for table, (a, b) in zip(self.pair_tables, self.pairs):
            out += table[coarse[:, a], coarse[:, b]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x) + self.shift, -30, 30)))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Along the last axis: the best gain of a cut, and the number of bins left of it."""
    left_g, left_h = np.cumsum(g, -1)[..., :-1], np.cumsum(h, -1)[..., :-1]
    all_g, all_h = g.sum(-1, keepdims=True), h.sum(-1, keepdims=True)
    gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
    gain[(left_h < LEAF / 4) | (all_h - left_h < LEAF / 4)] = 0.0
    at = gain.argmax(-1)
    return np.take_along_axis(gain, at[..., None], -1)[..., 0], at + 1


def feature_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of a tree with up to four leaves."""
    cuts = {0, len(g)}
    gain, at = _best_cut(g, h)
    if gain > 0:
        cuts.add(int(at))
        for a, b in ((0, int(at)), (int(at), len(g))):
            if b - a > 1:
                gain, inner = _best_cut(g[a:b], h[a:b])
                if gain > 0:
                    cuts.add(a + int(inner))
    values = np.zeros(len(g))
    for a, b in zip(sorted(cuts), sorted(cuts)[1:]):
        values[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return values


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain, and values by pair of bins, of the best tree that cuts one feature, then the other."""
    best, values = 0.0, np.zeros_like(g)
    whole = _gain(g.sum(), h.sum())
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        low_g, low_h = np.cumsum(gg, 0)[:-1], np.cumsum(hh, 0)[:-1]
        high_g, high_h = gg.sum(0) - low_g, hh.sum(0) - low_h
        (gain_low, cut_low), (gain_high, cut_high) = _best_cut(low_g, low_h), _best_cut(high_g, high_h)
        side = _gain(low_g.sum(1), low_h.sum(1)) + _gain(high_g.sum(1), high_h.sum(1)) - whole
        gain = gain_low + gain_high + side
        i = int(gain.argmax())
        if gain[i] > best:
            best, out = float(gain[i]), np.zeros_like(gg)
            for rows, cut in ((slice(0, i + 1), cut_low[i]), (slice(i + 1, None), cut_high[i])):
                for columns in (slice(0, cut), slice(cut, None)):
                    out[rows, columns] = -gg[rows, columns].sum() / (hh[rows, columns].sum() + RIDGE)
            values = out.T if flip else out
    return best, values


def fit(x: np.ndarray, y: np.ndarray, cut: float | None = None) -> Model:
    """The model of feature rows ``x`` and labels ``y`` (0 or 1); ``cut`` parts the labels."""
    k = len(FEATURES)
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], quantiles)) if len(x) else np.empty(0) for j in range(k)]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))), edges, np.zeros((k, BINS)), [], np.zeros((0, PAIR_BINS, PAIR_BINS)))
    if len(y) == 0 or y.min() == y.max():
        return model
    if cut is not None:
        model.shift = float(np.log(cut / (1 - cut))) - model.intercept
    at = model.bins(x)
    margin = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j in range(k):
            g, h = slopes()
            step = RATE * feature_tree(np.bincount(at[:, j], g, BINS), np.bincount(at[:, j], h, BINS))
            model.tables[j] += step
            margin += step[at[:, j]]
    coarse = at * PAIR_BINS // BINS
    cells = {(a, b): coarse[:, a] * PAIR_BINS + coarse[:, b] for a in range(k) for b in range(a + 1, k)}
    square = lambda v, pair: np.bincount(cells[pair], v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)
    g, h = slopes()
    gains = {pair: pair_tree(square(g, pair), square(h, pair))[0] for pair in cells}
    model.pairs = sorted(cells, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    model.pair_tables = np.zeros((len(model.pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for i, pair in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * pair_tree(square(g, pair), square(h, pair))[1]
            model.pair_tables[i] += step
            margin += step.ravel()[cells[pair]]
    return model


def feature_rows():
    """A column function from UTF-8 bytes to the features."""

    @F.arrow_udf("array<double>")
    def rows(texts: pa.Array) -> pa.Array:
        return pa.array([features(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return rows


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float | None = None) -> Model:
    """Fits ``labels`` (doc_id, label) on the texts of ``docs``."""
    python_workers(docs.sparkSession)
    chosen = (
        labels.select("doc_id", F.col("label").cast("double").alias("label"))
        .where("label IS NOT NULL AND doc_id IS NOT NULL")
        .withColumn("place", F.xxhash64("doc_id"))
        .orderBy("place", "doc_id", "label")
        .limit(sample)
    )
    # The sample has at most ``sample`` rows of 16 bytes, whatever the size of the corpus.
    pairs = docs.select(F.col("doc_id").alias("of"), F.col("text").cast("binary").alias("text")).join(
        F.broadcast(chosen), F.col("of") == F.col("doc_id")
    )
    rows = pairs.select("place", "doc_id", "label", feature_rows()("text").alias("x")).orderBy("place", "doc_id", "label", "x").limit(sample)
    found = rows.select("x", "label").collect()
    x = np.array([r.x for r in found], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.label for r in found], float), cut)


def scorer(model: Model):
    """A column function from UTF-8 bytes to the score."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        x = np.array([features(t) for t in texts.to_pylist()], float).reshape(-1, len(FEATURES))
        return pa.array(model.scores(x), pa.float64())

    return score


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    python_workers(docs.sparkSession)
    return docs.select("doc_id", scorer(model)(F.col("text").cast("binary")).alias("score"))
