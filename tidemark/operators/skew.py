"""Joining rows of a table that may have hot keys to one row per key.

Adaptive execution splits a skewed join only if both sides come straight from a shuffle
and nothing after it needs the partitioning; chains of aggregates and joins on one key do
not qualify. Here the rows of hot keys are taken out and dealt over salts; all other keys
go through one plain exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """``key, _salts`` of the keys that have more rows than a quarter of a task's fair share.

    The share is of all rows and the session's shuffle partitions, so there are at most
    four hot keys per partition, whatever the data: that bounds the broadcast of this
    table. ``hot_rows`` sets another threshold.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if hot_rows is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        limit: Column = F.ceil(df.agg(F.count(F.lit(1))).scalar() / F.lit(4 * parts))
        limit = F.greatest(F.lit(1), limit)
    else:
        limit = F.lit(hot_rows)
    return counts.where(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))


def split(df: DataFrame, hot: DataFrame, key: str, by: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary keys, and those of hot keys with a salt drawn from ``by``."""
    known = F.broadcast(hot)  # see hot_keys() for its bound
    drawn = F.pmod(F.xxhash64(by), F.col("_salts")).cast("int")
    return df.join(known, key, "left_anti"), df.join(known, key).withColumn(SALT, drawn)


def per_salt(unique: DataFrame) -> DataFrame:
    """One row per key and salt, from one row per key that has ``_salts``."""
    every = F.sequence(F.lit(0), F.col("_salts") - 1)
    return unique.withColumn(SALT, F.explode(every)).drop("_salts")
