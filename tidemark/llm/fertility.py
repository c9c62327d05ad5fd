"""Quality rules: base counts, and tokeniser fertility with rejection bands per script.

Two public vocabularies encode every word: a byte-level BPE one gives characters per token;
one with byte fallback gives the share of fallback pieces and the entropy of the pieces in bits.
A document is rejected if a measure leaves the band of the script that most of its words are
written in. Words are encoded once per worker and remembered.

Longer texts have more entropy, so its band depends on the number of pieces: ``LEAST_BITS``
has, per script, the least bits by the binary logarithm of that number, straight lines between.

Bands lie just outside what prose of the script measures, so that random letters, hex and
texts of very few words leave them. Both vocabularies know little but western languages:
Latin texts with letters beyond Latin-1 in one of ``EXTENDED`` words (Polish, Vietnamese) have
a band of their own, and in Greek, Arabic, Hebrew and Indic scripts prose and random letters
measure much the same.

Base: a document fails with fewer than 10 words, or if more than 20 % of its words lie in
5-word windows that occur twice or more in it.

Defined cases: a null or empty text has no words, all counts 0, measures null, and fails the
base rule. Repeated rows are judged alike. Words without letters count as script ``other``;
ties go to the script named first in ``BANDS``. A very long text is measured whole. An empty table
gives none.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers, unused

WINDOW, MIN_WORDS, MAX_REPEATED = 5, 10, 0.20
#: script: characters per token (least, most), most byte fallback
BANDS = {
    "latin": (1.65, 8.0, 0.10),
    "latin extended": (0.72, 8.0, 0.10),
    "cyrillic": (0.68, 5.0, 0.10),
    "greek": (0.71, 5.0, 0.15),
    "cjk": (0.35, 3.0, 0.40),
    "hangul": (0.33, 3.0, 0.40),
    "arabic": (0.58, 5.0, 0.20),
    "hebrew": (0.65, 5.0, 0.20),
    "indic": (0.30, 5.0, 0.60),
    "other": (0.25, 8.0, 0.40),
}
#: script: (log2 of pieces, least bits). Of Latin prose a tenth of a bit below the least of labelled
#: rows of each length; of the others, for want of such rows, a share of the most so many pieces
#: can have, up to six bits of it.
_SHARES = {
    "latin extended": 0.80, "cyrillic": 0.80, "greek": 0.66, "cjk": 0.68, "hangul": 0.75, "arabic": 0.63, "hebrew": 0.65,
    "indic": 0.66, "other": 0.60,
}
LEAST_BITS = {
    "latin": ((0, 0.0), (4, 3.55), (5, 3.9), (6, 4.7), (7, 5.3), (8, 5.75), (9, 6.0), (10, 6.25), (11, 6.4), (12, 6.45)),
    **{script: ((0, 0.0), (6, 6 * share)) for script, share in _SHARES.items()},
}
#: Of so many Latin words, one with a letter beyond Latin-1 makes the text extended.
EXTENDED = 20
#: First and last code point of the scripts' main blocks, fixed values.
RANGES = (
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0590, 0x05FF, "hebrew"),
    (0x0600, 0x077F, "arabic"), (0x0900, 0x0DFF, "indic"), (0x1E00, 0x1EFF, "latin"), (0x3040, 0x30FF, "cjk"),
    (0x3400, 0x9FFF, "cjk"), (0xAC00, 0xD7AF, "hangul"),
)
SCRIPTS = tuple(BANDS)
SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")
#: Words a worker remembers.
REMEMBERED = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)

MEASURES = pa.struct(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
     ("n_repeat_words", pa.int64()), ("script", pa.string()), ("chars_per_token", pa.float64()),
     ("byte_share", pa.float64()), ("n_pieces", pa.int64()), ("entropy", pa.float64())]
)
MEASURES_DDL = (
    "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
    "script:string,chars_per_token:double,byte_share:double,n_pieces:long,entropy:double>"
)


LATIN, LATIN_EXTENDED = SCRIPTS.index("latin"), SCRIPTS.index("latin extended")


def script_of(word: str) -> int:
    for c in word:
        if c.isalpha():
            at = ord(c)
            script = next((SCRIPTS.index(s) for a, b, s in RANGES if a <= at <= b), len(SCRIPTS) - 1)
            return LATIN_EXTENDED if script == LATIN and any("\u0100" <= x <= "\u024f" or "\u1e00" <= x <= "\u1eff" for x in word) else script
    return len(SCRIPTS) - 1


class Places(dict):
    """Numbers words as they come; ``new`` lists those that were not there before."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        self.new.append(word)
        return place


class Words:
    """What a worker knows of the words seen so far: one row of counts each, and their pieces."""

    def __init__(self, ranks_path: str, pattern: str, pieces_path: str):
        import sentencepiece
        import tiktoken

        from tidemark.llm.bpe_chunks import read_ranks

        ranks = read_ranks(ranks_path)
        self.tokens = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token_size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.token_size[list(ranks.values())] = list(map(len, ranks))
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.n_ids = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.n_ids)])
        self.forget()

    def forget(self) -> None:
        self.at = Places()
        self.rows = np.empty((1024, 6), np.int64)  # chars, tokens, pieces, byte pieces, script, start
        self.hash = np.empty(1024, np.uint64)
        self.flat = np.empty(4096, np.int32)
        self.used = 0

    def learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        ids = self.pieces.encode(texts, num_threads=1)
        first, need = len(self.at) - len(words), len(self.at)
        while len(self.rows) < need:
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            self.hash = np.concatenate([self.hash, np.empty_like(self.hash)])
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        while len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        starts = np.cumsum(lengths) - lengths
        fallback = np.concatenate([[0], np.cumsum(self.is_byte[flat])])
        new = self.rows[first:need]
        new[:, 0], new[:, 1], new[:, 2] = list(map(len, texts)), self.n_tokens(words, texts), lengths
        new[:, 3] = fallback[starts + lengths] - fallback[starts]
        new[:, 4] = [0 if t[0].isalpha() and t.isascii() else script_of(t) for t in texts]
        new[:, 5] = starts + self.used
        self.hash[first:need] = list(map(xxhash.xxh64_intdigest, words))
        self.used += len(flat)

    def n_tokens(self, words: list[bytes], texts: list[str]) -> np.ndarray:
        """Tokens of each word with a space before it: one call, cut by the bytes of the tokens."""
        ids = self.tokens.encode_ordinary("".join([" " + t for t in texts]))
        ends = np.cumsum(self.token_size[ids])
        upto = np.searchsorted(ends, np.cumsum([len(w) + 1 for w in words]), side="right")
        return np.diff(upto, prepend=0)

    def measures(self, texts: list[bytes | None]) -> list[dict]:
        if len(self.at) > REMEMBERED:
            self.forget()
        self.at.new = []
        place = self.at.__getitem__
        split = []
        for t in texts:
            words = (t or b"").split()  # at the six ASCII white-space characters
            split.append(np.fromiter(map(place, words), np.int64, len(words)))
        self.learn(self.at.new)
        out = [self.measure(t or b"", at) for t, at in zip(texts, split)]
        if self.used > 8 * REMEMBERED:  # some words were very long
            self.forget()
        return out

    def measure(self, text: bytes, at: np.ndarray) -> dict:
        n = len(at)
        row = {"n_words": n, "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": dup_lines(text)}
        if not n:
            return row | {"word_chars": 0, "n_repeat_words": 0, "script": None, "chars_per_token": None, "byte_share": None, "n_pieces": 0, "entropy": None}
        distinct, times = np.unique(at, return_counts=True)
        sums = times @ self.rows[distinct, :4]
        scripts = np.bincount(self.rows[distinct, 4], times, len(SCRIPTS))
        scripts[-1] *= scripts[:-1].sum() == 0  # words without letters have no say
        latin = scripts[LATIN] + scripts[LATIN_EXTENDED]
        extended = EXTENDED * scripts[LATIN_EXTENDED] >= max(latin, 1)
        scripts[LATIN], scripts[LATIN_EXTENDED] = (0, latin) if extended else (latin, 0)
        lengths, starts = self.rows[distinct, 2], self.rows[distinct, 5]
        ends = np.cumsum(lengths)
        where = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
        counts = np.bincount(self.flat[where], np.repeat(times, lengths), self.n_ids)
        p = counts[counts > 0] / sums[2]
        return row | {
            "word_chars": int(sums[0]),
            "n_repeat_words": repeated(self.hash[at]),
            "script": SCRIPTS[int(scripts.argmax())],
            "chars_per_token": float(sums[0] / sums[1]),
            "byte_share": float(sums[3] / sums[2]),
            "n_pieces": int(sums[2]),
            "entropy": float(max(0.0, -(p * np.log2(p)).sum())),
        }


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def repeated(words: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window occurring twice or more. Windows are compared by 64-bit hashes."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h = (h ^ words[k : k + n]) * _MIX
        h ^= h >> np.uint64(29)
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    twice = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + n] |= twice
    return int(covered.sum())


@lru_cache(maxsize=2)
def worker_words(ranks_path: str, pattern: str, pieces_path: str) -> Words:
    return Words(ranks_path, pattern, pieces_path)


def measures(ranks_path: str, pattern: str, pieces_path: str):
    """A column function from a text's UTF-8 bytes to its measures."""

    @F.arrow_udf(MEASURES_DDL)
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array(worker_words(ranks_path, pattern, pieces_path).measures(texts.to_pylist()), MEASURES)

    return measure


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > int(100 * MAX_REPEATED) * m["n_words"])


def least_bits(pieces: Column, script: str) -> Column:
    """The least entropy of a number of pieces: a line between the points around it."""
    points, x = LEAST_BITS[script], F.log2(F.greatest(pieces, F.lit(1)))
    out = F.lit(points[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(points, points[1:]))):
        out = F.when(x < x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0))).otherwise(out)
    return out


def within_bands(m: Column) -> Column:
    ok = F.lit(False)
    for script, (least, most, fallback) in BANDS.items():
        inside = m["chars_per_token"].between(least, most) & (m["byte_share"] <= fallback)
        inside &= m["entropy"] >= least_bits(m["n_pieces"], script)
        ok = F.when(m["script"] == script, inside).otherwise(ok)
    return ok


def kept(m: Column) -> Column:
    return ~base_failed(m) & F.coalesce(within_bands(m), F.lit(False))


def measured(docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str) -> DataFrame:
    """``docs`` with a struct ``fertility``: the measures, ``base_failed`` and ``kept``.

    A column ``fertility`` of ``docs`` is replaced.
    """
    python_workers(docs.sparkSession)
    measure = measures(ranks_path, pattern, pieces_path)
    name = unused(docs, "measures")
    found = docs.select(*docs.columns, measure(F.col("text").cast("binary")).alias(name))
    m = F.col(name)
    verdict = F.struct(
        *[m[f.name].alias(f.name) for f in MEASURES],
        base_failed(m).alias("base_failed"),
        kept(m).alias("kept"),
    )
    return found.select(*[c for c in docs.columns if c.lower() != "fertility"], verdict.alias("fertility"))
