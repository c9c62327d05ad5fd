"""Periodic runs of words: every maximal stretch that repeats with some period.

For a period ``q`` only word pairs ``(g, g + q)`` on the grid of multiples of ``q`` are looked
at; a run of three periods or more holds three grid points in a row. Over all periods these
are n/1 + n/2 + ... pairs. How far a pair's stretch reaches, to the right and to the left, is
a question of longest common extension (LCE), answered in constant time:

* positions in a difference cover modulo ``V`` are samples; only suffixes at samples are
  sorted, by their first ``V`` words and then by doubling along one residue;
* for any two positions fewer than ``V`` words ahead both meet samples, so a question compares
  those few words and, if they agree, takes the minimum of neighbouring sorted suffixes' common
  prefixes from a sparse table.

The samples are sorted when the first question gets that far: texts without repeats never pay.

Defined cases: null and empty texts have no words and no runs and collapse to an empty text.
Words are compared as bytes, any run of the six ASCII white-space characters parts them.
Ties and overlapping runs are all kept, by start, then period. Very long texts are gone through
in blocks of ``PAIRS`` pairs; a text has to fit a row, the samples take about 40 bytes a word.
Null ids and repeated rows are kept row by row. Other columns are neither read nor returned.
An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers, text_of

#: A run has at least so many words and so many periods.
LEAST, PERIODS = 24, 3
# A perfect difference set, every difference modulo V occurs once.
V, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Grid pairs looked at together.
PAIRS = 1 << 20

_IN_COVER = np.isin(np.arange(V), COVER)
_AHEAD = np.full((V, V), V, np.int64)
for _i in range(V):
    for _d in range(V):
        # From i and i + d, both are samples after the least such number of words.
        _AHEAD[_i, _d] = min((x - _i) % V for x in COVER if (x + _d) % V in COVER)


class Extensions:
    """Longest common extensions to the right between positions of a sequence of ids above 0."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.ids = np.concatenate([ids, np.zeros(2 * V, np.int64)])  # 0 ends every comparison

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For positions ``i < j <= n``, in whole arrays."""
        out = np.zeros(len(i), np.int64)
        ahead = _AHEAD[i % V, (j - i) % V]
        live = np.arange(len(i))
        for t in range(V):
            at_samples = live[ahead[live] == t]
            if len(at_samples):
                out[at_samples] += self._of_samples(i[at_samples] + t, j[at_samples] + t)
            live = live[ahead[live] > t]
            live = live[self.ids[i[live] + t] == self.ids[j[live] + t]]
            if not len(live):
                break
            out[live] += 1
        return out

    @cached_property
    def _samples(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Place of each position among the samples, rank by place, and minima over ranks."""
        at = np.flatnonzero(_IN_COVER[np.arange(self.n + 1) % V])
        m, stride = len(at), len(COVER)
        first = np.ascontiguousarray(self.ids[at[:, None] + np.arange(V)].astype(">u4"))
        levels = [np.unique(first.view(f"S{4 * V}").ravel(), return_inverse=True)[1]]
        while levels[-1].max() + 1 < m:
            # ``stride`` places on lies the sample of the same residue that the level reaches.
            rank, after = levels[-1], np.zeros(m, np.int64)
            after[: max(m - stride, 0)] = rank[stride:] + 1
            levels.append(np.unique(rank * (m + 1) + after, return_inverse=True)[1])
            stride *= 2
        order = np.argsort(levels[-1])
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(m - 1, np.int64)
        for k in range(len(levels) - 2, -1, -1):
            same = levels[k][a] == levels[k][b]
            common[same] += V << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        a, b, live = at[a], at[b], np.arange(m - 1)
        for t in range(V):
            live = live[self.ids[a[live] + t] == self.ids[b[live] + t]]
            common[live] += 1
        minima = [common]
        while 2 ** len(minima) <= m - 1:
            low, half = minima[-1], 2 ** (len(minima) - 1)
            minima.append(np.minimum(low[:-half], low[half:]))
        place = np.zeros(self.n + 1, np.int64)
        place[at] = np.arange(m)
        return place, levels[-1], minima

    def _of_samples(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        place, rank, minima = self._samples
        a, b = rank[place[i]], rank[place[j]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.zeros(len(i), np.int64)
        for k in np.unique(level):
            of = level == k
            out[of] = np.minimum(minima[k][lo[of]], minima[k][hi[of] - (1 << k)])
        return out


def grids(n: int, points: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid positions and periods, in blocks, such that ``points`` grid points follow in a row."""
    q = 1
    while points * q <= n + q - 1:
        # (n - 1) // q is the last grid point's number.
        most = max(1, PAIRS * q // n)
        periods = np.arange(q, min(q + most, (n - 1) // (points - 1) + 1))
        counts = (n - 1) // periods - (points - 2)
        starts = np.cumsum(counts) - counts
        period = np.repeat(periods, counts)
        yield (np.arange(len(period)) - np.repeat(starts, counts)) * period, period
        q = int(periods[-1]) + 1


def runs(ids: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """Start, length and smallest period of every run, by start, then period."""
    n = len(ids)
    right, left = Extensions(ids), Extensions(ids[::-1])
    found = [np.empty((0, 3), np.int64)]
    for g, q in grids(n, periods) if n >= least else ():
        same = np.ones(len(g), bool)
        for k in range(1, periods):
            same &= ids[g + (k - 1) * q] == ids[g + k * q]
        g, q = g[same], q[same]
        before = left(n - g - q, n - g)
        length = before + q + right(g, g + q)
        held = length >= np.maximum(least, periods * q)
        if held.any():
            found.append(_smallest_periods(np.stack([g - before, length, q], axis=1)[held]))
    all_ = _smallest_periods(np.concatenate(found))
    return all_[np.lexsort((all_[:, 2], all_[:, 0]))]


def _smallest_periods(found: np.ndarray) -> np.ndarray:
    """One row per stretch: with period ``q`` it has every multiple that fits as well."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal numbers, from 1 on, for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.int64, len(words))


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which words stay if each run is cut down to its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edges[:n]) == 0


def collapsed(docs: DataFrame, least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: all runs, and the text without their repeats."""
    python_workers(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    @F.arrow_udf("struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: binary>")
    def gone_through(texts: pa.Array) -> pa.Array:
        n_words, all_runs, kept = [], [], []
        for text in texts:
            words = text.as_py().split()
            found = runs(word_ids(words), least, periods)
            n_words.append(len(words))
            all_runs.append([dict(zip(("start", "length", "period"), r)) for r in found.tolist()])
            kept.append(b" ".join(words[i] for i in np.flatnonzero(kept_words(len(words), found))) if len(found) else b" ".join(words))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(all_runs, kind), pa.array(kept, pa.binary())], ["n_words", "runs", "collapsed"]
        )

    made = docs.select("doc_id", gone_through(text_of().cast("binary")).alias("made"))
    return made.select("doc_id", "made.n_words", "made.runs", F.col("made.collapsed").cast("string").alias("collapsed"))
