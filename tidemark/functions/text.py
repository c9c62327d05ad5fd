"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: longest error text that is shown.
ERROR_LIMIT = 2000


def error_text(kind: Column, reason: Column, limit: int | None = ERROR_LIMIT) -> Column:
    """``kind: reason``, cut to ``limit`` characters unless that is None."""
    text = F.concat_ws(": ", kind, reason)
    return text if limit is None else F.left(text, F.lit(limit))


def or_unknown(value: Column) -> Column:
    """Empty and NULL both count as ``unknown``."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("unknown"))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def tokens(text: Column) -> Column:
    """Lower-case words of a text: runs of letters and digits."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")
