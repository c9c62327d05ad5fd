"""Dead letters: failures per source row and sink, and their replay.

The log is append-only. What the reader sees, one row per ``(source_record_id, sink)``,
is an aggregate over it, so a failure seen by two workers is one entry with two attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import is_strict_number
from tidemark.functions.text import ERROR_LIMIT
from tidemark.functions.times import micros
from tidemark.operators.state import lookup
from tidemark.sources.numbering import numbered

KEY = ["source_record_id", "sink"]
# States of an entry.
PENDING, REPLAYED, RESOLVED = "pending", "replayed", "resolved"
# What a log row says.
FAILURE, BUMP = "failure", "bump"
# What a replay would do.
OK, TOMBSTONE, STILL_BAD, MISSING = "ok", "tombstone", "still_bad", "missing"


def entries(log: DataFrame) -> DataFrame:
    """The dead-letter table: first and last failure, attempts, newest payload and status.

    A failure reopens its entry as pending; a bump adds an attempt and leaves the status;
    a replayed or resolved row only sets the status.
    """
    kind = F.col("kind")
    is_failure, is_bump = kind == FAILURE, kind == BUMP
    failed = is_failure | is_bump
    order = F.struct("failed_at", "batch_seq")
    status = F.when(is_failure, PENDING).otherwise(kind)
    newest = F.max_by(F.struct("external_id", "payload"), F.when(is_failure, order))
    return (
        log.groupBy(*KEY)
        .agg(
            newest.alias("_failure"),
            F.max_by("error", F.when(failed, order)).alias("error"),
            F.count_if(failed).cast("int").alias("attempt_count"),
            F.max_by(status, F.when(~is_bump, order)).alias("status"),
            F.min(F.when(is_failure, F.col("failed_at"))).alias("first_failed_at"),
            F.max(F.when(failed, F.col("failed_at"))).alias("last_failed_at"),
        )
        .select(
            *KEY,
            F.col("_failure.external_id").alias("external_id"),
            F.col("_failure.payload").alias("payload"),
            "error",
            "attempt_count",
            "status",
            "first_failed_at",
            "last_failed_at",
        )
    )


def failure_rows(
    rejected: DataFrame, sink: str, failed_at: Column, batch_seq: Column, payload: list[str]
) -> DataFrame:
    """Log rows for the rejected rows of a batch."""
    return rejected.select(
        F.col("id").alias("source_record_id"),
        "external_id",
        F.lit(sink).alias("sink"),
        F.to_json(F.struct(*payload)).alias("payload"),
        F.col("reject_reason").alias("error"),
        failed_at.alias("failed_at"),
        F.lit(FAILURE).alias("kind"),
        batch_seq.alias("batch_seq"),
    )


def list_entries(dlq: DataFrame, status: str = PENDING, limit: int = 50, offset: int = 0) -> DataFrame:
    """One page of entries, newest failure first, long errors cut for display."""
    newest = [F.desc("first_failed_at"), F.desc("source_record_id")]
    page = dlq.where(F.col("status") == status).orderBy(*newest).offset(offset).limit(limit)
    return page.withColumn("error", F.left("error", F.lit(ERROR_LIMIT)))


def entry(dlq: DataFrame, source_record_id: int, sink: str) -> DataFrame:
    """The entry of one source row and sink, whole."""
    return dlq.where((F.col("source_record_id") == source_record_id) & (F.col("sink") == sink))


def latest_entries(dlq: DataFrame, n: int) -> DataFrame:
    return dlq.orderBy(F.desc("first_failed_at"), F.desc("source_record_id")).limit(n)


def counts_by_status(dlq: DataFrame) -> DataFrame:
    return dlq.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def attempts(log: DataFrame) -> DataFrame:
    """Each failure and refused replay with its number as ``attempt_no``.

    Hours, then seconds, are the buckets of a busy entry.
    """
    tried = log.where(F.col("kind").isin(FAILURE, BUMP))
    second = F.floor(micros(F.col("failed_at")) / F.lit(1_000_000))
    buckets = [F.floor(second / F.lit(3600)), second]
    return numbered(tried, ["failed_at", "batch_seq", "mode"], buckets, KEY, out="attempt_no")


def replay_plan(dlq: DataFrame, records: DataFrame) -> DataFrame:
    """Pending entries with the *current* source row and what a replay would do.

    The frozen payload is not used: replay makes sense once the source was fixed.
    A row deleted since its failure replays as a deletion, not as a document.
    """
    pending = dlq.where(F.col("status") == PENDING).select(
        *KEY, "attempt_count", "first_failed_at", "last_failed_at"
    )
    keys = pending.select(F.col("source_record_id").alias("id")).distinct()
    current = lookup(keys, records.withColumn("_found", F.lit(True)))
    outcome = (
        F.when(F.col("_found").isNull(), MISSING)
        .when(F.col("deleted_at").isNotNull(), TOMBSTONE)
        .when(F.col("amount").isNull() | is_strict_number(F.col("amount")), OK)
        .otherwise(STILL_BAD)
    )
    return (
        pending.withColumnRenamed("source_record_id", "id")
        .join(current, "id")
        .withColumn("outcome", outcome)
        .drop("_found")
    )


def replayable(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("outcome").isin(OK, TOMBSTONE))


def outcome_rows(plan: DataFrame, at: Column, batch_seq: Column) -> DataFrame:
    """Log rows that close replayed entries; the others stay as they are."""
    closed = F.when(F.col("outcome") == OK, REPLAYED).otherwise(RESOLVED)
    return replayable(plan).select(
        F.col("id").alias("source_record_id"),
        "external_id",
        "sink",
        F.lit(None).cast("string").alias("payload"),
        F.lit(None).cast("string").alias("error"),
        at.alias("failed_at"),
        closed.alias("kind"),
        batch_seq.alias("batch_seq"),
    )


def bump_rows(keys: DataFrame, error: Column, at: Column, batch_seq: Column) -> DataFrame:
    """Log rows for replays the sink refused: one more attempt, new error, same status."""
    return keys.select(
        *KEY,
        F.lit(None).cast("string").alias("external_id"),
        F.lit(None).cast("string").alias("payload"),
        error.alias("error"),
        at.alias("failed_at"),
        F.lit(BUMP).alias("kind"),
        batch_seq.alias("batch_seq"),
    )


def auto_resolvable(plan: DataFrame) -> DataFrame:
    """Entries whose source row was fixed by a later ordinary change, which the
    incremental scan delivers by itself."""
    return plan.where((F.col("outcome") == OK) & (F.col("updated_at") > F.col("last_failed_at")))
