"""Hand-made documents with every odd case, and the extra columns that might clash."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, key double, block int, ids string, fp long, score string, mix string, row long"
)
LONG = 120_000


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeéßж") for _ in range(rng.randint(1, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """(doc_id, text, source)"""
    rng = random.Random(4)
    base = words(rng, 400)
    long = words(rng, LONG // 5)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", "b"), (4, "one", None), (5, "Two words", "b"), (6, base, "a")]
    rows += [(7 + i, base, "b") for i in range(4)]  # exact copies
    rows += [(20, base + " tail", "c"), (21, base + " tail more", "c"), (22, "x " + base, "c")]  # near copies
    rows += [(30, long, "d"), (31, "ж" * 30_000, "d"), (32, "same " * 5_000, "d"), (33, "a\r\n\nb\x0b\x0cc d　e f", "d")]
    rows += [(40, words(rng, 30), "e"), (40, words(rng, 30), "e"), (41, "repeated row here", "e"), (41, "repeated row here", "e")]
    rows += [(None, "no id", "e"), (None, base, "e"), (None, None, None)]
    rows += [(100 + i, words(rng, rng.randint(1, 120)), rng.choice("abcde")) for i in range(60)]
    return rows


def documents(spark, rows=None):
    rows = odd_rows() if rows is None else rows
    filler = (7, 1.5, 3, "[1]", 5, "0.5", "m", 9)
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) + filler for i, t, s in rows], SCHEMA)


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
