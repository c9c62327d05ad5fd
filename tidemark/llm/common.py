"""What the operators share: words, table loading, written intermediate tables, Arrow batches."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: A word: a run of anything but the six ASCII white-space characters. ``bytes.split()``
#: cuts at the same six, so Python code splits the UTF-8 bytes instead of using this.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def remainder(column: str, modulus: int) -> Column:
    """``crc32`` of an id as text, modulo ``modulus``. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: a cut lineage that survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot if it has more than this share of the rows: there are at most 10 000 such keys.
HOT_SHARE = 1e-4


def spread_join(rows: DataFrame, key: str, salt: Column, unique: DataFrame, of: str, counts: DataFrame) -> DataFrame:
    """``rows`` joined on ``key`` with ``unique``, which has one row per value of ``of``.

    The rows of a hot key are dealt over all shuffle partitions by ``salt``, a number that a task
    that runs again finds again; the one row they meet is there once for each. ``counts`` (key, n)
    tells which keys are hot. They are broadcast: 8 bytes each, at most ``1 / HOT_SHARE``.
    """
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("n") > HOT_SHARE * total).select(F.col("key").alias("hot_key")))
    is_hot = F.col("hot_key").isNotNull()
    own = F.when(is_hot, F.pmod(salt, F.lit(salts)).cast("int")).otherwise(F.lit(0))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(hot, F.col(key) == F.col("hot_key"), "left").withColumn("salt", own).drop("hot_key")
    right = unique.join(hot, F.col(of) == F.col("hot_key"), "left").withColumn("salt_of", F.explode(every)).drop("hot_key")
    return left.join(right, (F.col(key) == F.col(of)) & (F.col("salt") == F.col("salt_of"))).drop("salt", "salt_of")


def python_workers(spark: SparkSession, rows: int = 1000) -> None:
    """Let workers import this package, and hand them at most ``rows`` rows or 64 MB at once.

    Settings the user changed stay.
    """
    for key, default, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000, str(rows)),
        ("spark.sql.execution.arrow.maxBytesPerBatch", 2**31 - 1, str(2**26)),
    ):
        if int(spark.conf.get(key).rstrip("b")) == default:
            spark.conf.set(key, value)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))
