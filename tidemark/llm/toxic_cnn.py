"""Toxicity: a convolutional text classifier, trained in numpy.

A word is looked up in two hashed embedding tables; filters of one, two and three words slide
over the whole text, the largest response of each is kept, and a logistic layer weighs them.
The first embedding component starts as the word's log odds, so that the filters begin with
the words that matter. Words seen in fewer than ``SEEN`` sample texts, or in less than ``SEEN_SHARE``
of them, start and stay at zero: they say nothing, and cannot be learned by heart.

Texts of different languages get different margins for the same offence. The language is read
off the text's own function words; per language the threshold on the margin is calibrated on
sample rows the filters were not trained on, and moved to score 0.5. A language with fewer
than ``CALIBRATION`` such rows of either label takes the threshold of all; if even all are
fewer, the rows trained on are taken as well.

The model is fitted on a bounded sample: per label the ``SAMPLE`` labelled rows with the
smallest hashes of their ids, without texts of more than ``LONGEST`` words. Their words reach
the driver as 4 bytes each. Counts of labels, and scores, cover all rows and whole texts.

Defined cases: null and empty texts have no word and get the score of no response. Letter case
A-Z and ASCII punctuation are ignored. Labels that are null are ignored; several labels of a
document count separately. Without any label the score is 0.5; with labels of one kind only,
it is their smoothed share. Equal texts get equal scores; repeated rows and null ids are kept
row by row. Very long texts are gone through in blocks of ``BLOCK`` words that overlap. Other
columns are neither read nor returned. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers, text_of

SAMPLE, LONGEST = 4096, 4096
SEEN, SEEN_SHARE, CALIBRATION = 4, 0.002, 20
TABLES, BUCKETS, DIM = 2, 1 << 16, 8
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE, DECAY, SMOOTH = 6, 32, 0.05, 1e-4, 0.02
BLOCK = 1 << 15
_OFFSETS = sum(WIDTHS)
_SIZE = TABLES * DIM

# Frequent function words of each language, which tell languages apart.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht ein eine mit von zu den im für auf sich dem auch",
    "en": "the of and to in is that it for was with as be are this by from have",
    "es": "el los las del que y en un una es por con para su al como más pero",
    "fr": "le les des et est une dans qui pour pas sur du au ce il elle avec par",
    "it": "il di che è un una per non sono della con gli nel alla anche più dei si",
    "nl": "de het een van en is dat niet op te zijn voor met hij aan ook er maar",
    "pl": "i w nie na się jest z do to że o jak po co ale za od przez",
    "pt": "o os as da do que e em um uma não para com por mais dos na se",
    "ru": "и в не на что с по как это но из за от для так же его все",
    "tr": "ve bir bu için ile de da çok ne daha gibi var olarak kadar sonra ama o en",
}
OTHER = "other"

_PLAIN = bytes.maketrans(
    string.ascii_uppercase.encode() + string.punctuation.encode(),
    string.ascii_lowercase.encode() + b" " * len(string.punctuation),
)


def word_hashes(text: bytes | None) -> np.ndarray:
    """A 32-bit hash of every word; its halves are the buckets in the two tables."""
    words = (text or b"").translate(_PLAIN).split()
    if not words:
        return np.empty(0, np.uint32)
    return (pd.util.hash_array(np.array(words, object), categorize=False) >> np.uint64(32)).astype(np.uint32)


def _function_words() -> tuple[np.ndarray, np.ndarray]:
    names = sorted(FUNCTION_WORDS)
    said = [(h, k) for k, name in enumerate(names) for h in word_hashes(FUNCTION_WORDS[name].encode()).tolist()]
    # A word of several languages speaks for none of them.
    by_hash: dict[int, set[int]] = {}
    for h, k in said:
        by_hash.setdefault(h, set()).add(k)
    own = sorted((h, min(ks)) for h, ks in by_hash.items() if len(ks) == 1)
    return np.array([h for h, _ in own], np.uint32), np.array([k for _, k in own])


_KNOWN, _OF = _function_words()


def language(hashes: np.ndarray) -> str:
    """The language with most function words in a text; ties go by name."""
    at = np.minimum(np.searchsorted(_KNOWN, hashes), len(_KNOWN) - 1)
    votes = np.bincount(_OF[at[_KNOWN[at] == hashes]], minlength=len(FUNCTION_WORDS))
    return sorted(FUNCTION_WORDS)[int(votes.argmax())] if votes.any() else OTHER


@dataclass
class Model:
    tables: np.ndarray  # table, bucket, component
    filters: np.ndarray  # component of all tables, offset of all widths, filter
    bias: np.ndarray  # width and filter
    weights: np.ndarray  # width and filter
    intercept: float
    thresholds: dict[str, float]

    def vectors(self, hashes: np.ndarray) -> np.ndarray:
        return np.concatenate([self.tables[0][hashes & 0xFFFF], self.tables[1][hashes >> 16]], axis=1)

    def responses(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Per width, the response of its filters at every place where they fit."""
        n = len(vectors)
        each = (vectors @ self.filters.reshape(_SIZE, -1)).reshape(n, _OFFSETS, FILTERS)
        out, at = [], 0
        for k, width in enumerate(WIDTHS):
            total = each[: max(n - width + 1, 0), at].copy()
            for j in range(1, width):
                total += each[j : j + len(total), at + j]
            out.append(total + self.bias[k * FILTERS : (k + 1) * FILTERS])
            at += width
        return out

    def pooled(self, hashes: np.ndarray) -> np.ndarray:
        """The largest response of every filter over the whole text, at least 0."""
        best = np.zeros(len(self.bias), np.float32)
        reach = max(WIDTHS) - 1
        for lo in range(0, max(len(hashes) - reach, 1), BLOCK):
            found = self.responses(self.vectors(hashes[lo : lo + BLOCK + reach]))
            tops = [r.max(axis=0) if len(r) else np.zeros(FILTERS, np.float32) for r in found]
            best = np.maximum(best, np.concatenate(tops))
        return best

    def margin(self, hashes: np.ndarray) -> float:
        return float(self.pooled(hashes) @ self.weights + self.intercept)

    def score(self, hashes: np.ndarray) -> float:
        threshold = self.thresholds.get(language(hashes), self.thresholds[""])
        return float(1 / (1 + np.exp(-np.clip(self.margin(hashes) - threshold, -30, 30))))


def constant(share: float) -> Model:
    """The model that gives every text the same score."""
    none = len(WIDTHS) * FILTERS
    return Model(
        np.zeros((TABLES, 1 << 16, DIM), np.float32), np.zeros((_SIZE, _OFFSETS, FILTERS), np.float32), np.zeros(none, np.float32),
        np.zeros(none, np.float32), float(np.log(share / (1 - share))), {"": 0.0},
    )


def first_model(texts: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> tuple[Model, np.ndarray]:
    """Embeddings from log odds and small noise, and which buckets may be learned."""
    model = constant(0.5)
    learned = np.zeros((TABLES, BUCKETS), bool)
    kinds = [np.unique(t) for t in texts]
    least = max(SEEN, SEEN_SHARE * len(y))
    for k, buckets in enumerate(([w & 0xFFFF for w in kinds], [w >> 16 for w in kinds])):
        count = lambda label: np.bincount(np.concatenate([np.unique(b) for b, l in zip(buckets, y) if l == label]).astype(np.int64), minlength=BUCKETS)  # noqa: E731,E741
        bad, good = count(1), count(0)
        odds = np.log((bad + 1) / (y.sum() + 2)) - np.log((good + 1) / (len(y) - y.sum() + 2))
        learned[k] = bad + good >= least
        model.tables[k] = rng.normal(0, 0.05, (BUCKETS, DIM))
        model.tables[k, :, 0] = 0.2 * odds
    words, n = np.unique(np.concatenate(kinds), return_counts=True)
    # A bucket is learned only if a word that falls into it was seen often enough.
    words = words[n >= least]
    for k, buckets in enumerate((words & 0xFFFF, words >> 16)):
        seen = np.zeros(BUCKETS, bool)
        seen[buckets] = True
        learned[k] &= seen
        model.tables[k][~learned[k]] = 0
    model.filters = rng.normal(0, 0.1, model.filters.shape).astype(np.float32)
    model.filters[::DIM] += 1.0 / np.repeat(WIDTHS, WIDTHS).astype(np.float32)[None, :, None]
    model.weights[:] = 0.5
    model.intercept = -1.0
    return model, learned


def train_filters(texts: list[np.ndarray], y: np.ndarray, seed: int = 5) -> Model:
    """Stochastic gradient descent with step sizes by past gradients, on both labels alike."""
    rng = np.random.default_rng(seed)
    model, learned = first_model(texts, y, rng)
    rows_of = [np.flatnonzero(y == label) for label in (0, 1)]
    names = ("filters", "bias", "weights")
    past = {name: np.full_like(getattr(model, name), 1e-2) for name in names}
    past_tables, past_intercept = np.full_like(model.tables, 1e-2), 1e-2
    starts = np.concatenate([[0], np.cumsum(WIDTHS)])
    for _ in range(EPOCHS * len(y) // BATCH):
        grads = {name: np.zeros_like(getattr(model, name)) for name in names}
        touched: list[tuple[np.ndarray, np.ndarray]] = []
        grad_intercept = 0.0
        chosen = np.concatenate([rng.choice(rows, BATCH // 2) for rows in rows_of])
        for row in chosen:
            hashes = texts[row]
            vectors = model.vectors(hashes)
            responses = model.responses(vectors)
            at = [r.argmax(axis=0) if len(r) else None for r in responses]
            tops = [r[a, range(FILTERS)] if a is not None else np.zeros(FILTERS, np.float32) for r, a in zip(responses, at)]
            pooled = np.maximum(np.concatenate(tops), 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.weights + model.intercept, -30, 30)))
            slope = (p - (1 - SMOOTH if y[row] else SMOOTH)) / BATCH
            grad_intercept += slope
            grads["weights"] += slope * pooled
            back = slope * model.weights * (pooled > 0)
            grads["bias"] += back
            for k, width in enumerate(WIDTHS):
                mine = back[k * FILTERS : (k + 1) * FILTERS]
                if at[k] is None or not mine.any():
                    continue
                for j in range(width):
                    seen = at[k] + j
                    grads["filters"][:, starts[k] + j] += (mine[:, None] * vectors[seen]).T
                    touched.append((hashes[seen], mine[:, None] * model.filters[:, starts[k] + j].T))
        for name in names:
            value = getattr(model, name)
            grad = grads[name] + DECAY * value
            past[name] += grad**2
            value -= RATE * grad / np.sqrt(past[name])
        past_intercept += grad_intercept**2
        model.intercept -= RATE * grad_intercept / past_intercept**0.5
        if touched:
            hashes, grad = (np.concatenate(x) for x in zip(*touched))
            for k, buckets in enumerate((hashes & 0xFFFF, hashes >> 16)):
                rows, place = np.unique(buckets, return_inverse=True)
                total = np.zeros((len(rows), DIM), np.float32)
                np.add.at(total, place, grad[:, k * DIM : (k + 1) * DIM])
                past_tables[k, rows] += total**2
                model.tables[k, rows] -= RATE * total / np.sqrt(past_tables[k, rows]) * learned[k, rows, None]
    return model


def best_threshold(margins: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The cut with the best F1 of label 1 among weighted rows, in the middle of its gap."""
    order = np.argsort(-margins, kind="stable")
    m, hit, w = margins[order], y[order] == 1, weights[order]
    good, taken = np.cumsum(w * hit), np.cumsum(w)
    f1 = 2 * good / (taken + (w * hit).sum())
    last = np.append(m[1:] < m[:-1], True)  # equal margins fall on one side
    k = int(np.argmax(np.where(last, f1, -1)))
    return float((m[k] + m[k + 1]) / 2) if k + 1 < len(m) else float(m[k] - 1)


def calibrate(model: Model, texts: list[np.ndarray], y: np.ndarray, weights: np.ndarray) -> dict[str, float]:
    """Thresholds on the margin by language, and of all rows under ''."""
    margins = np.array([model.margin(t) for t in texts])
    names = np.array([language(t) for t in texts])
    out = {"": best_threshold(margins, y, weights) if len(y) and y.min() != y.max() else 0.0}
    for name in np.unique(names):
        own = names == name
        if min((y[own] == 1).sum(), (y[own] == 0).sum()) >= CALIBRATION:
            out[str(name)] = best_threshold(margins[own], y[own], weights[own])
    return out


def fit(texts: list[np.ndarray], y: np.ndarray, shares: tuple[float, float]) -> Model:
    """The model of sample texts (hashes of words) and labels; ``shares`` are the rows of either
    label that a sample row stands for. Copies of a text fall into one fold."""
    if len(y) == 0 or y.min() == y.max():
        return constant((y.sum() + 0.5) / (len(y) + 1))
    aside = np.array([int(t.astype(np.uint64).sum()) * 2654435761 % 2**32 % 5 == 0 for t in texts])
    if min((y[~aside] == 1).sum(), (y[~aside] == 0).sum()) == 0:
        aside[:] = False
    pick = lambda mask: [t for t, m in zip(texts, mask) if m]
    model = train_filters(pick(~aside), y[~aside])
    if min((y[aside] == 1).sum(), (y[aside] == 0).sum()) < CALIBRATION:
        aside[:] = True
    model.thresholds = calibrate(model, pick(aside), y[aside], np.where(y[aside] == 1, shares[1], shares[0]))
    return model


def hashed_words() -> Column:
    """A column function from UTF-8 bytes to the hashes of the words, as bytes."""

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        return pa.array([word_hashes(t.as_py()).astype("<u4").tobytes() for t in texts], pa.binary())

    return packed


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits ``labels`` (doc_id, label) on the texts of ``docs``."""
    python_workers(docs.sparkSession)
    known = (
        labels.select("doc_id", F.col("label").cast("int").alias("label"))
        .where("label IN (0, 1) AND doc_id IS NOT NULL")
        .withColumn("place", F.xxhash64("doc_id"))
    )
    order = ("place", "doc_id")
    # At most ``sample`` rows of 20 bytes per label, whatever the size of the corpus.
    chosen = [known.where(F.col("label") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    texts = docs.select(F.col("doc_id").alias("of"), F.encode(text_of(), "utf-8").alias("text"))
    rows = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), F.col("of") == F.col("doc_id"))
    packed = rows.select(*order, "label", hashed_words()("text").alias("words")).where(F.length("words") <= 4 * LONGEST)
    # Rows of documents may repeat an id, so the bound is set once more.
    found = packed.orderBy(*order, "label", "words").limit(2 * sample).collect()
    counts = dict(known.groupBy("label").count().collect())
    hashes = [np.frombuffer(bytes(r.words), "<u4") for r in found]
    y = np.array([r.label for r in found], np.int64)
    return fit(hashes, y, tuple(counts.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1)))


def scorer(model: Model):
    """A column function from UTF-8 bytes to the score."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(word_hashes(t.as_py())) for t in texts], pa.float64())

    return score


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    python_workers(docs.sparkSession)
    return docs.select("doc_id", scorer(model)(F.col("text").cast("binary")).alias("score"))
