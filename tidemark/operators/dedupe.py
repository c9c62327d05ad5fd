"""Deliveries of the same change: rank them, keep one, count the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.state import first_per_key
from tidemark.sources.numbering import numbered

CHANGE_KEY = ("id", "version")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All deliveries of all workers, duplicates kept."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed)
    return out


def first_deliveries(
    df: DataFrame, order: Sequence[str], key: Sequence[str] = CHANGE_KEY
) -> DataFrame:
    """One row per change, the earliest delivery."""
    return first_per_key(df, key, [F.asc(c) for c in order])


def ranked_deliveries(
    df: DataFrame,
    order: Sequence[str],
    buckets: Sequence[Column],
    key: Sequence[str] = CHANGE_KEY,
) -> DataFrame:
    """Every delivery with its rank; rank 1 counts, later ones are duplicates."""
    ranked = numbered(df, list(order), list(buckets), key, out="delivery_rank")
    return ranked.withColumn("is_duplicate", F.col("delivery_rank") > 1)


def unseen(
    batch: DataFrame, earlier: DataFrame, order: Sequence[str], key: Sequence[str] = CHANGE_KEY
) -> DataFrame:
    """First deliveries of this batch that no earlier batch had.

    Both sides are reduced to one row per change before they meet, so a change that was
    delivered over and over costs one row per task.
    """
    once = earlier.select(*key).distinct()
    return first_deliveries(batch, order, key).join(once, list(key), "left_anti")


def overlap(left: DataFrame, right: DataFrame, key: Sequence[str] = CHANGE_KEY) -> DataFrame:
    """Changes both workers delivered, each once."""
    return left.select(*key).distinct().join(right.select(*key).distinct(), list(key), "left_semi")
