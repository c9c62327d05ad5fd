"""Cursor predicates and the pages cut with them.

A comparison of structs returns the same rows but pushes nothing to the scan, so
row comparisons are written out: ``a >= x AND (a > x OR b > y)``. The leading
``a >= x`` is what row-group statistics, or a database index, can use.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import micros

WATERMARK = ("updated_at", "id")
_EPOCH = datetime(1970, 1, 1)


def cursor_literal(dtype: T.DataType, value: int | str) -> Column:
    """A literal of the column's own type, so that the scan column is never cast.

    Timestamps come as microseconds since the epoch.
    """
    if isinstance(dtype, T.TimestampNTZType):
        text = (_EPOCH + timedelta(microseconds=value)).isoformat(sep=" ", timespec="microseconds")
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(value).cast("long"))
    return F.lit(value).cast(dtype)


def _row_compare(df: DataFrame, columns: Sequence[str], values: Sequence, descending, last) -> Column:
    name, rest = columns[0], columns[1:]
    bound = cursor_literal(df.schema[name].dataType, values[0])
    down = name in descending
    if not rest:
        return last(F.col(name), bound, down)
    outside = F.col(name) < bound if down else F.col(name) > bound
    reach = F.col(name) <= bound if down else F.col(name) >= bound
    return reach & (outside | _row_compare(df, rest, values[1:], descending, last))


def after_cursor(
    df: DataFrame, columns: Sequence[str], values: Sequence, descending: Sequence[str] = ()
) -> Column:
    """Rows that come after ``values`` when sorted by ``columns``.

    Columns named in ``descending`` run from high to low.
    """

    def strictly_after(col: Column, bound: Column, down: bool) -> Column:
        return col < bound if down else col > bound

    return _row_compare(df, columns, values, descending, strictly_after)


def upto_cursor(df: DataFrame, columns: Sequence[str], values: Sequence) -> Column:
    """Rows at or before ``values``: the complement of :func:`after_cursor`, also pushable."""

    def at_or_after(col: Column, bound: Column, down: bool) -> Column:
        return col <= bound if down else col >= bound

    # Seen from the far end of the sort order, "at or before" is "at or after".
    return _row_compare(df, columns, values, columns, at_or_after)


def keyset_page(df: DataFrame, after_id: int, limit: int, key: str = "id") -> DataFrame:
    """The next ``limit`` rows by key. Plans as a top-k, not as a sort of the table."""
    return df.where(after_cursor(df, [key], [after_id])).orderBy(key).limit(limit)


def watermark_page(df: DataFrame, after: tuple[int | None, int], limit: int) -> DataFrame:
    """The next ``limit`` rows by ``(updated_at, id)``; a NULL watermark means the epoch."""
    lo = (after[0] or 0, after[1])
    return df.where(after_cursor(df, WATERMARK, lo)).orderBy(*WATERMARK).limit(limit)


def high_water(df: DataFrame) -> Row | None:
    """The largest ``(updated_at, id)`` as ``(micros, id)``: one row, two columns read."""
    top = df.agg(F.max(F.struct(micros(F.col("updated_at")).alias("micros"), "id")).alias("hi")).first()
    return top["hi"]


def bounded_range(
    df: DataFrame, lo: tuple[int | None, int], hi: tuple[int, int], lookback_micros: int = 0
) -> DataFrame:
    """All rows in ``(lo, hi]`` by ``(updated_at, id)``.

    ``hi`` is fixed before the work starts, so a retry covers the same range while the
    table goes on changing. ``lookback_micros`` reads again what lies just below ``lo``,
    for transactions that commit late with an old timestamp.
    """
    low, low_id = lo[0] or 0, lo[1]
    if lookback_micros:
        low, low_id = low - lookback_micros, -1
    return df.where(after_cursor(df, WATERMARK, (low, low_id)) & upto_cursor(df, WATERMARK, hi))
