"""Source tables: parquet folders and relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schemas import RECORD


def parquet_table(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def jdbc_options(
    url: str,
    table: str,
    low: int,
    high: int,
    partitions: int,
    key: str = "id",
    fetch_rows: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a relational read split into key ranges, one query per partition.

    Cursor filters and column lists put on the result travel into those queries.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
        **extra,
    }


def jdbc_table(spark: SparkSession, **kwargs) -> DataFrame:
    """See :func:`jdbc_options` for the arguments."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def clustered_copy(df: DataFrame, path: str, columns: tuple[str, ...] = ("id",)) -> DataFrame:
    """Write ``df`` sorted by ``columns`` and read it back.

    A backfill reads one id range per chunk. On files sorted by id each range touches its
    own row groups; on unsorted files every chunk would scan the table. One range shuffle
    here pays for all chunks, and freezes a changing source.
    """
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
