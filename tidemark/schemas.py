"""Explicit schemas. Nothing here is inferred, so streams and batch reads agree."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("amount", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("deleted_at", T.TimestampType()),
    ]
)

# The change log: the record as extracted, how it was judged, and its place in the run.
CHANGE = T.StructType(
    RECORD.fields
    + [
        T.StructField("op", T.StringType()),
        T.StructField("amount_value", T.DoubleType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("emitted_at", T.TimestampType()),
        T.StructField("batch_seq", T.LongType()),
    ]
)

# Directory levels below the change log and the dead-letter log.
BATCH_KEYS = [
    T.StructField("mode", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
]

DEAD_LETTER = T.StructType(
    [
        T.StructField("source_record_id", T.LongType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("sink", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("failed_at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("batch_seq", T.LongType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("mode", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("lo_micros", T.LongType()),
        T.StructField("lo_id", T.LongType()),
        T.StructField("hi_micros", T.LongType()),
        T.StructField("hi_id", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_rejected", T.LongType()),
        T.StructField("n_deleted", T.LongType()),
        T.StructField("n_dead_letters", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("actor", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_buckets", T.IntegerType()),
        T.StructField("at_micros", T.LongType()),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("op", T.StringType()),
        T.StructField("data", RECORD),
        T.StructField("emitted_at", T.TimestampType()),
    ]
)
