"""Current state: the newest version of every key, whatever order deliveries came in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.change import accepted, judged, live_rows


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Keeping rank 1 plans as a group limit on both sides of the shuffle: each task passes
    on one row per key, so a key that holds a third of the rows does not gather in one
    task. Measured a fifth faster than ``max_by`` of whole rows, which has to sort too.
    """
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, order: Sequence[str] = ("version", "updated_at"), key: str = "id"
) -> DataFrame:
    """The row with the highest ``order`` per key."""
    return first_per_key(df, [key], [F.desc(c) for c in order])


def live_state(feed: DataFrame, order: Sequence[str] = ("version", "updated_at")) -> DataFrame:
    """Latest rows without the deleted ones. Tombstones win first and go afterwards, so a
    late old version cannot bring a deleted row back."""
    return live_rows(latest_per_key(feed, order))


def typed_state(feed: DataFrame, order: Sequence[str] = ("version", "updated_at")) -> DataFrame:
    """Latest *accepted* row per key: a rejected newer version leaves the older one."""
    return live_state(accepted(judged(feed)), order)


def lookup(keys: DataFrame, table: DataFrame, key: str = "id", how: str = "left") -> DataFrame:
    """The rows of a large ``table`` for a set of unique ``keys``.

    A left join cannot broadcast its left side. Cutting the table down to the wanted keys
    first lets the planner broadcast the keys, if they turn out small, and skip the
    shuffle of the table.
    """
    wanted = table.join(keys.select(key), key, "left_semi")
    return keys.join(wanted, key, how)
