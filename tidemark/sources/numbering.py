"""Row numbers without a global window.

``row_number()`` over a whole table, or over a key that holds a third of it, sorts that
many rows in one task. Here each row falls into a bucket that respects the sort order;
buckets are counted with a map-side aggregate, a running sum over the small bucket table
gives every bucket its starting number, and only rows of one bucket are sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Ids are unique, so a bucket of 2^18 ids holds at most 2^18 rows, and a super-bucket of
# 2^40 ids at most 2^22 buckets: no sort below can outgrow a task, however many rows.
BUCKET_BITS = 18
SUPER_BITS = 40


def _joined(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """An inner join on ``names`` in which NULL equals NULL; the left side's columns stay."""
    renamed = right.select(*[F.col(c).alias(f"_r{c}") if c in names else F.col(c) for c in right.columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in names], F.lit(True))
    return left.join(renamed, same).drop(*[f"_r{c}" for c in names])


def _starts(counts: DataFrame, keys: list[str], levels: list[str]) -> DataFrame:
    """How many rows of the key come before each bucket."""
    parents, leaf = keys + levels[:-1], levels[-1]
    before = W.partitionBy(*parents).orderBy(leaf).rowsBetween(W.unboundedPreceding, -1)
    here = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if len(levels) == 1:
        return here.drop("_n")
    coarse = counts.groupBy(*parents).agg(F.sum("_n").alias("_n"))
    upper = _starts(coarse, keys, levels[:-1]).withColumnRenamed("_start", "_upper")
    return _joined(here, upper, parents).select(
        *keys, *levels, (F.col("_start") + F.col("_upper")).alias("_start")
    )


def numbered(
    df: DataFrame,
    order_by: Sequence[Column | str],
    buckets: Sequence[Column],
    keys: Sequence[str] = (),
    out: str = "rank",
) -> DataFrame:
    """``df`` with ``out`` = 1, 2, ... per ``keys`` in the order ``order_by``.

    ``buckets`` go from coarse to fine and must never decrease along ``order_by``; a NULL
    bucket comes first, as NULLs do in an ascending order. A NULL key is a key.
    """
    keys = list(keys)
    levels = [f"_b{i}" for i in range(len(buckets))]
    tagged = df.select("*", *[b.alias(name) for b, name in zip(buckets, levels)])
    counts = tagged.groupBy(*keys, *levels).agg(F.count(F.lit(1)).alias("_n"))
    within = W.partitionBy(*keys, *levels).orderBy(*order_by)
    return (
        _joined(tagged, _starts(counts, keys, levels), keys + levels)
        .withColumn(out, F.row_number().over(within) + F.col("_start"))
        .drop("_start", *levels)
    )


def id_buckets(key: str = "id") -> list[Column]:
    return [F.shiftright(key, SUPER_BITS), F.shiftright(key, BUCKET_BITS)]


def with_page(df: DataFrame, page_rows: int, key: str = "id", out: str = "page") -> DataFrame:
    """Each row with the number of the page an ordered scan would deliver it in."""
    ranked = numbered(df, [key], id_buckets(key), out="_rank")
    page = F.floor((F.col("_rank") - 1) / F.lit(page_rows)) + 1
    return ranked.withColumn(out, page.cast("long")).drop("_rank")


def range_plan(df: DataFrame, about: int, key: str = "id") -> DataFrame:
    """Consecutive id ranges of about ``about`` rows: page, first and last id, rows.

    Ranges are cut at the edges of id buckets of at most an eighth of a range, so ids are
    only counted, map-side, and never numbered or sorted. A range exceeds ``about`` by less
    than a bucket; with buckets of one id the ranges are exact.
    """
    bits = max(0, (about // 8).bit_length() - 1)
    levels = ["_b0", "_b1"]
    counts = (
        df.groupBy(F.shiftright(key, max(SUPER_BITS, bits)).alias("_b0"), F.shiftright(key, bits).alias("_b1"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"), F.max(key).alias("_last"))
    )
    starts = _starts(counts.select(*levels, "_n"), [], levels)
    page = F.floor(F.col("_start") / F.lit(about)) + 1
    return (
        _joined(counts, starts, levels)
        .groupBy(page.cast("long").alias("page"))
        .agg(F.min("_first").alias("first_id"), F.max("_last").alias("last_id"), F.sum("_n").alias("n_rows"))
    )


def page_plan(df: DataFrame, page_rows: int, key: str = "id", after_page: int = 0) -> DataFrame:
    """Page number, first id, last id and rows of every page. Reads only the key column."""
    return (
        with_page(df.select(key), page_rows, key)
        .groupBy((F.col("page") + after_page).alias("page"))
        .agg(
            F.min(key).alias("first_id"),
            F.max(key).alias("last_id"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
