"""Fill-in-middle: a text is cut in three and its parts are exchanged in place.

A scan over the bytes finds the two cuts. The sentinels go into one bytearray, before each
part; then whole blocks change places by three reversals, which need no second copy of the
text. The same rotations, with the lengths the other way round, restore the text exactly.

Cuts, and whether and how a text is rearranged, are drawn from a hash of its id, so a rerun
draws the same. Units are runs of ASCII letters and single other characters.

Defined cases: a null text is empty; an empty text and one that holds a sentinel stay plain.
A null id is hashed as empty text. Repeated rows and ids are kept row by row and equal rows
get equal outputs; both cuts may fall on the same unit, the first or the end (empty parts).
Very long texts are scanned and reversed in blocks of ``BLOCK`` bytes; a text and its output
have to fit a row. Other columns of the table are neither read nor returned. An empty table
gives none. ``restored`` gives null for a null output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers, text_of

# The sentinels, and the shares of plain and suffix-first texts in percent.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
REARRANGED, SUFFIX_FIRST = 90, 20

BLOCK = 1 << 16
_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
#: First bytes of characters in UTF-8.
_HEAD = (_BYTES & 0xC0) != 0x80


def unit_heads(text: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Which bytes of ``text[lo:hi]`` begin a unit."""
    letter = _LETTER[text[lo:hi]]
    before = np.empty_like(letter)
    before[1:] = letter[:-1]
    before[:1] = lo > 0 and _LETTER[text[lo - 1]]
    return np.where(letter, ~before, _HEAD[text[lo:hi]])


def unit_counts(text: np.ndarray) -> np.ndarray:
    """Number of units begun before each block of bytes, and at the end."""
    counts = [np.count_nonzero(unit_heads(text, lo, lo + BLOCK)) for lo in range(0, len(text), BLOCK)]
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def offset(text: np.ndarray, counts: np.ndarray, unit: int) -> int:
    """The byte where a unit begins; the end of the text for the number of units."""
    if unit == counts[-1]:
        return len(text)
    k = int(np.searchsorted(counts, unit, side="right")) - 1
    heads = np.flatnonzero(unit_heads(text, k * BLOCK, (k + 1) * BLOCK))
    return k * BLOCK + int(heads[unit - counts[k]])


def reverse(buf: np.ndarray, lo: int, hi: int) -> None:
    """``buf[lo:hi]`` back to front, in place."""
    while hi - lo > 1:
        k = min(BLOCK, (hi - lo) // 2)
        head = buf[lo : lo + k][::-1].copy()
        buf[lo : lo + k] = buf[hi - k : hi][::-1]
        buf[hi - k : hi] = head
        lo, hi = lo + k, hi - k


def rotate(buf: np.ndarray, lo: int, mid: int, hi: int) -> None:
    """``buf[lo:mid]`` and ``buf[mid:hi]`` change places."""
    reverse(buf, lo, mid)
    reverse(buf, mid, hi)
    reverse(buf, lo, hi)


def arrange(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text cut at two bytes, in the order of ``form``."""
    buf = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buf[at:at] = sentinel
    middle, suffix = len(PREFIX) + first, len(PREFIX) + len(MIDDLE) + second
    rotate(np.frombuffer(buf, np.uint8), middle if form == PSM else 0, suffix, len(buf))
    return bytes(buf)


def restore(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given."""
    if form == PLAIN:
        return output
    buf, end = bytearray(output), len(output)
    # The text holds no sentinel, so the first of each kind is the one put in.
    if form == PSM:
        moved = output.index(SUFFIX)
        middle, back = moved, output.index(MIDDLE, moved)
    else:
        moved = 0
        back = output.index(PREFIX)
        middle = output.index(MIDDLE, back) - back
    rotate(np.frombuffer(buf, np.uint8), moved, back, end)
    suffix = moved + end - back
    for at in (suffix, middle, 0):
        del buf[at : at + len(PREFIX)]
    return bytes(buf)


def cut_and_arranged(text: bytes, draws: list[int]) -> tuple:
    """Units, form, characters of the first two parts, and output of one text."""
    data = np.frombuffer(text, np.uint8)
    counts = unit_counts(data)
    n = int(counts[-1])
    if not text or any(s in text for s in SENTINELS) or draws[2] % 100 >= REARRANGED:
        return n, PLAIN, None, None, text
    form = SPM if draws[3] % 100 < SUFFIX_FIRST else PSM
    first, second = (offset(data, counts, u) for u in sorted(d % (n + 1) for d in draws[:2]))
    chars = lambda lo, hi: int(np.count_nonzero(_HEAD[data[lo:hi]]))
    return n, form, chars(0, first), chars(first, second), arrange(text, first, second, form)


def draws(seed: int) -> Column:
    """Four unsigned 32-bit numbers from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


_FIELDS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]


def transformed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs``."""
    python_workers(docs.sparkSession)

    @F.arrow_udf("struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: binary>")
    def arranged(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        done = [cut_and_arranged(t, d) for t, d in zip(texts.to_pylist(), numbers.to_pylist())]
        columns = list(zip(*done)) or [()] * len(_FIELDS)
        return pa.StructArray.from_arrays(
            [pa.array(c, kind) for c, (_, kind) in zip(columns, _FIELDS)], [name for name, _ in _FIELDS]
        )

    made = docs.select("doc_id", arranged(text_of().cast("binary"), draws(seed)).alias("made"))
    return made.select("doc_id", "made.n", "made.form", "made.prefix_chars", "made.middle_chars", F.col("made.output").cast("string").alias("output"))


def restorer():
    """A column function from UTF-8 output and form to the bytes of the text."""

    @F.arrow_udf("binary")
    def text(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        pairs = zip(outputs.to_pylist(), forms.to_pylist())
        return pa.array([None if o is None else restore(o, f) for o, f in pairs], pa.binary())

    return text


def restored(made: DataFrame) -> DataFrame:
    """``made`` with ``restored``, the text rebuilt from ``output`` and ``form`` alone."""
    python_workers(made.sparkSession)
    return made.withColumn("restored", restorer()(F.col("output").cast("binary"), F.col("form")).cast("string"))
