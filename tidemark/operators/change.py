"""What a source row becomes: a document, an event, or a rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import strict_double
from tidemark.functions.text import error_text
from tidemark.schemas import RECORD

# The words of the change kinds.
CREATED, UPDATED, DELETED = "created", "updated", "deleted"
# The document has all fields of the record but its key and the deletion mark.
DOCUMENT_FIELDS = [name for name in RECORD.names if name not in ("id", "deleted_at")]
# Fixed value: the error kind of a document that does not fit its mapping.
MAPPING_ERROR = "mapper_parsing_exception"


def is_deleted() -> Column:
    return F.col("deleted_at").isNotNull()


def live_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("deleted_at").isNull())


def op_kind() -> Column:
    return F.when(is_deleted(), DELETED).when(F.col("version") > 1, UPDATED).otherwise(CREATED)


def judged(df: DataFrame) -> DataFrame:
    """Rows with ``amount_value`` and ``reject_reason``, NULL if the typed state takes them.

    The verdict stays a column of the row, so accepted and rejected rows of one batch need
    no join to part ways. Deleted rows carry no document, so they are never refused. A
    NULL amount is an absent field, not a bad one.
    """
    bad = F.col("amount").isNotNull() & F.col("amount_value").isNull()
    reason = error_text(F.lit(MAPPING_ERROR), F.concat(F.lit("bad amount "), F.col("amount")), limit=None)
    typed = df.withColumn("amount_value", strict_double(F.col("amount")))
    return typed.withColumn("reject_reason", F.when(~is_deleted() & bad, reason))


def accepted(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where(F.col("reject_reason").isNull())


def rejected(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where(F.col("reject_reason").isNotNull())


def to_document(df: DataFrame) -> DataFrame:
    """Key plus document fields, amount typed. Drops ``deleted_at``."""
    fields = [
        strict_double(F.col("amount")).alias("amount") if f == "amount" else F.col(f)
        for f in DOCUMENT_FIELDS
    ]
    return df.select("id", *fields)


def to_event(df: DataFrame, emitted_at: Column, data_fields: list[str] | None = None) -> DataFrame:
    """One envelope per row change. ``emitted_at`` is fixed per batch, so that publishing
    a batch again yields the same bytes."""
    fields = data_fields or RECORD.names
    return df.select(
        "id",
        "external_id",
        "version",
        op_kind().alias("op"),
        F.struct(*fields).alias("data"),
        emitted_at.alias("emitted_at"),
    )
