"""Applying inserts, updates and soft deletes to a record table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import skew

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _effect(live: Column, born: Column) -> Column:
    """Whether a change finds its row; ``live`` is NULL for an id the table lacks."""
    seq, kind = F.col("seq"), F.col("kind")
    return F.when(live.isNotNull(), live & (kind != INSERT)).otherwise(
        F.when(kind == INSERT, seq == born).otherwise(seq > born)
    )


def _known(records: DataFrame) -> DataFrame:
    return records.select("id", F.col("deleted_at").isNull().alias("_live"))


def _ordinary(records: DataFrame, changes: DataFrame) -> DataFrame:
    """Effective changes of ids without many: join and windows share one exchange by id."""
    of_id = Window.partitionBy("id")
    seq, kind = F.col("seq"), F.col("kind")
    # Only the ids at hand travel; see lookup() on why the table is cut down first.
    known = _known(records).join(changes.select("id"), "id", "left_semi")
    return (
        changes.join(known, "id", "left")
        .withColumn("_born", F.min(F.when(kind == INSERT, seq)).over(of_id))
        .where(_effect(F.col("_live"), F.col("_born")))
        .withColumn("_gone", F.min(F.when(kind == DELETE, seq)).over(of_id))
        .where(F.col("_gone").isNull() | (seq <= F.col("_gone")))
        .drop("_live", "_born", "_gone")
    )


def _hot(records: DataFrame, salted: DataFrame, hot: DataFrame) -> DataFrame:
    """Effective changes of hot ids: what is known of an id goes to each of its salts."""
    seq, kind = F.col("seq"), F.col("kind")
    born = salted.groupBy("id").agg(F.min(F.when(kind == INSERT, seq)).alias("_born"))
    base = hot.join(born, "id").join(_known(records).join(hot, "id", "left_semi"), "id", "left")
    on_row = (
        salted.drop("_salts")
        .join(skew.per_salt(base), ["id", skew.SALT])
        .where(_effect(F.col("_live"), F.col("_born")))
        .drop("_live", "_born")
    )
    gone = on_row.where(kind == DELETE).groupBy("id").agg(F.min("seq").alias("_gone"))
    return (
        on_row.join(skew.per_salt(gone.join(hot, "id")), ["id", skew.SALT], "left")
        .where(F.col("_gone").isNull() | (seq <= F.col("_gone")))
        .drop("_gone", skew.SALT)
    )


def _effective(records: DataFrame, changes: DataFrame, hot_rows: int | None) -> list[DataFrame]:
    hot = skew.hot_keys(changes, "id", hot_rows)
    plain, salted = skew.split(changes, hot, "id", by="seq")
    return [_ordinary(records, plain), _hot(records, salted, hot).select(*changes.columns)]


def effective_changes(records: DataFrame, changes: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The changes that do something when applied one by one in ``seq`` order.

    An insert works on an absent id, once; updates and deletes work on a live row, so
    nothing follows the first delete. ``changes`` is
    ``(id, seq, kind, changed_at, <values>)``, ``seq`` unique per id; an id may have any
    number of changes, so those of hot ids are spread over several tasks.
    """
    plain, hot = _effective(records, changes, hot_rows)
    return plain.unionByName(hot)


def _net(effective: DataFrame, news: list[Column]) -> DataFrame:
    seq, kind = F.col("seq"), F.col("kind")
    return effective.groupBy("id").agg(
        F.count(F.lit(1)).cast("int").alias("_steps"),
        F.max_by("changed_at", seq).alias("_updated_at"),
        F.min(F.when(kind == INSERT, F.col("changed_at"))).alias("_created_at"),
        F.max(F.when(kind == DELETE, F.col("changed_at"))).alias("_deleted_at"),
        *news,
    )


def apply_changes(
    records: DataFrame, changes: DataFrame, values: list[str], hot_rows: int | None = None
) -> DataFrame:
    """The record table after ``changes``.

    An insert starts at version 1. Each update adds 1 to the version and sets the
    non-NULL ``values``. A delete adds 1 and sets ``deleted_at``. ``updated_at`` follows
    the last of them. Columns of ``records`` a change cannot set stay as they are.
    """
    seq = F.col("seq")
    # The last value set per column; NULL means the change leaves the column alone.
    news = [F.max_by(v, F.when(F.col(v).isNotNull(), seq)).alias(f"_{v}") for v in values]
    # The steps of a hot id are added up per task before they meet.
    net = reduce(DataFrame.unionByName, [_net(part, news) for part in _effective(records, changes, hot_rows)])
    out = {
        "version": F.coalesce("version", F.lit(0)) + F.coalesce("_steps", F.lit(0)),
        "created_at": F.coalesce("created_at", "_created_at"),
        "updated_at": F.coalesce("_updated_at", "updated_at"),
        "deleted_at": F.coalesce("deleted_at", "_deleted_at"),
        **{v: F.coalesce(f"_{v}", v) for v in values},
    }
    merged = records.join(net, "id", "full_outer")
    return merged.select(*[out[c].alias(c) if c in out else F.col(c) for c in records.columns])


def change_counts(records: DataFrame, changes: DataFrame) -> DataFrame:
    """How many inserts, updates and deletes took effect."""
    kind = F.col("kind")
    return effective_changes(records, changes).agg(
        F.count_if(kind == INSERT).alias("inserted"),
        F.count_if(kind == UPDATE).alias("updated"),
        F.count_if(kind == DELETE).alias("deleted"),
    )
