"""Counters, gauges and the status report.

Each figure is an aggregate over an append-only log, reduced in the tasks before it
travels. ``now`` is always a parameter, so a report can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import to_fixed
from tidemark.functions.text import or_unknown
from tidemark.functions.times import age_seconds
from tidemark.sources.cursor import WATERMARK, after_cursor

# Fixed value: length of the trailing throughput window.
RATE_WINDOW_MS = 30_000
# Slices of the sample log sorted in one task. A row reaches into the next slice only if
# it lies in the last window of its own.
RATE_SLICE_MS = 20 * RATE_WINDOW_MS


def live_count(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count_if(F.col("deleted_at").isNull()).alias("live"), F.count(F.lit(1)).alias("total")
    )


def max_id(records: DataFrame) -> DataFrame:
    return records.agg(F.coalesce(F.max("id"), F.lit(0).cast("long")).alias("max_id"))


def events_by(events: DataFrame, field: Column, name: str) -> DataFrame:
    return events.groupBy(or_unknown(field).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def event_counters(events: DataFrame, **fields: Column) -> DataFrame:
    """All counters in one pass: ``(dimension, key, n)``.

    Events are first counted per combination of values; only those few rows are expanded
    to one row per dimension.
    """
    names = list(fields)
    combos = events.groupBy(*[or_unknown(c).alias(n) for n, c in fields.items()]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).alias("key")) for n in names])
    return (
        combos.select("_n", F.explode(pairs).alias("_p"))
        .groupBy(F.col("_p.dimension").alias("dimension"), F.col("_p.key").alias("key"))
        .agg(F.sum("_n").alias("n"))
    )


def consumer_totals(parsed: DataFrame) -> DataFrame:
    """Unique changes processed, repeated deliveries skipped, poison events.

    One pass over deliveries with ``poison`` set or NULL: they are counted per change,
    poison as one group, and the counts are added up.
    """
    good = F.col("poison").isNull()
    change = F.when(good, F.struct("id", "version"))
    copies = parsed.groupBy(change.alias("_change")).agg(F.count(F.lit(1)).alias("_n"))
    valid, n = F.col("_change").isNotNull(), F.col("_n")
    return copies.agg(
        F.count_if(valid).alias("processed_total"),
        F.coalesce(F.sum(F.when(valid, n - 1)), F.lit(0)).alias("duplicates_skipped_total"),
        F.coalesce(F.sum(F.when(~valid, n)), F.lit(0)).alias("errors_total"),
    )


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side, without a join."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def batch_outcomes(judged_rows: DataFrame, batch: list[str]) -> DataFrame:
    """Rows, indexed (deletions count), dead-lettered and published per batch."""
    bad = F.col("reject_reason").isNotNull()
    return judged_rows.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~bad).alias("indexed"),
        F.count_if(bad).alias("dead_lettered"),
        F.count(F.lit(1)).alias("published"),
        F.count_if(F.col("deleted_at").isNotNull()).alias("deleted"),
    )


def progress_pct(last_id: Column, highest_id: Column) -> Column:
    """Share of the id range behind the backfill cursor, at most 100, two decimals."""
    share = F.least(F.lit(100.0), last_id / highest_id * 100)
    return F.when(highest_id > 0, to_fixed(share, 2)).otherwise(F.lit(0.0))


def lag_seconds(records: DataFrame, cursor: tuple[int | None, int], now_micros: int) -> DataFrame:
    """Age of the oldest row the incremental scan has not processed; 0 without a backlog."""
    backlog = records.where(after_cursor(records, WATERMARK, (cursor[0] or 0, cursor[1])))
    oldest = backlog.agg(F.min("updated_at").alias("oldest"))
    age = age_seconds(F.lit(now_micros), F.col("oldest"))
    return oldest.select(F.coalesce(age, F.lit(0.0)).alias("lag_seconds"))


def throughput(samples: DataFrame) -> DataFrame:
    """Rows per second over the trailing 30 s at each sample time, from ``(mode, t_ms, n)``.

    There are two modes, so a window per mode would be two tasks. Samples of one
    millisecond are added up first, then the log is cut into time slices, so no task sorts
    more than the milliseconds of a slice. Samples near the end of a slice are copied into
    the next, where they count but are not reported.
    """
    t, slice_ = F.col("t_ms"), F.floor(F.col("t_ms") / RATE_SLICE_MS).cast("long")
    spills = F.pmod(t, F.lit(RATE_SLICE_MS)) >= RATE_SLICE_MS - RATE_WINDOW_MS
    home = F.col("_home")
    per_ms = samples.groupBy("mode", "t_ms").agg(
        F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_samples")
    )
    sliced = per_ms.withColumn("_home", slice_).withColumn(
        "_slice", F.explode(F.when(spills, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    trailing = W.partitionBy("mode", "_slice").orderBy("t_ms").rangeBetween(-RATE_WINDOW_MS, 0)
    seconds = F.greatest(F.lit(1.0), (t - F.min("t_ms").over(trailing)) / 1000)
    total, count = F.sum("_rows").over(trailing), F.sum("_samples").over(trailing)
    return (
        sliced.withColumns({"n_samples": count, "total": total, "_seconds": seconds})
        .where(F.col("_slice") == F.col("_home"))
        .select(
            "mode",
            "t_ms",
            "n_samples",
            "total",
            F.when(F.col("n_samples") < 2, F.lit(0.0))
            .otherwise(F.col("total") / F.col("_seconds"))
            .alias("rows_per_sec"),
        )
    )


def samples_of(commits: DataFrame) -> DataFrame:
    """``(mode, t_ms, n)`` of a run: every batch is a sample, taken when it was committed."""
    at = F.floor(F.col("at_micros") / 1000).cast("long")
    return commits.select("mode", at.alias("t_ms"), F.col("n_rows").alias("n"))


def outcomes_of(commits: DataFrame) -> DataFrame:
    """``batch_outcomes`` of committed batches, from what was counted when they were written."""
    bad = F.coalesce("n_rejected", F.lit(0).cast("long"))
    return commits.select(
        "mode",
        "batch_id",
        "n_rows",
        (F.col("n_rows") - bad).alias("indexed"),
        bad.alias("dead_lettered"),
        # A replay repairs the state and publishes nothing.
        F.when(F.col("mode") == "replay", F.lit(0).cast("long")).otherwise(F.col("n_rows")).alias("published"),
        F.col("n_deleted").alias("deleted"),
    )


def sliding_rate(
    samples: DataFrame, length: str = "30 seconds", step: str = "10 seconds", late: str | None = None
) -> DataFrame:
    """Rows per sliding window; works on a batch and on a stream.

    A stream needs ``late``: how far a sample may lie behind the newest one. Windows that end
    before that are closed and leave the state, and samples for them alone are dropped.
    """
    timed = samples.withColumn("_ts", F.timestamp_millis("t_ms"))
    if late:
        timed = timed.withWatermark("_ts", late)
    return (
        timed.groupBy("mode", F.window("_ts", length, step).alias("_w"))
        .agg(F.sum("n").alias("n_rows"))
        .select("mode", F.unix_seconds("_w.start").alias("window_start"), "n_rows")
    )


def overall_health(components: DataFrame) -> DataFrame:
    """Healthy only if every component ``(component, ok)`` is."""
    ok = F.coalesce(F.bool_and("ok"), F.lit(False))
    return components.agg(ok.alias("ok")).withColumn(
        "overall_health", F.when(F.col("ok"), "healthy").otherwise("degraded")
    )


def status_report(
    records: DataFrame,
    checkpoints: DataFrame,
    lag: DataFrame,
    totals: DataFrame,
    dead_letters: DataFrame,
    rates: DataFrame,
    components: DataFrame,
) -> DataFrame:
    """Everything an operator looks at, as one row. Each part is one aggregate."""
    backfill, incremental = F.col("mode") == "backfill", F.col("mode") == "incremental"
    source = records.agg(
        F.count_if(F.col("deleted_at").isNull()).alias("total_records"),
        F.coalesce(F.max("id"), F.lit(0).cast("long")).alias("max_id"),
    )
    runs = checkpoints.agg(
        F.max(F.when(backfill, F.col("status"))).alias("backfill_status"),
        F.max(F.when(backfill, F.col("last_id"))).alias("backfill_last_id"),
        F.max(F.when(backfill, F.col("rows_processed"))).alias("backfill_rows_processed"),
        F.max(F.when(incremental, F.col("status"))).alias("incremental_status"),
        F.max(F.when(incremental, F.col("rows_processed"))).alias("incremental_rows_processed"),
    )
    now = rates.agg(
        F.max_by("rows_per_sec", F.when(backfill, F.col("t_ms"))).alias("backfill_rows_per_sec"),
        F.max_by("rows_per_sec", F.when(incremental, F.col("t_ms"))).alias("incremental_rows_per_sec"),
    )
    waiting = dead_letters.agg(F.count_if(F.col("status") == "pending").alias("dlq_pending_count"))
    health = overall_health(components).select("overall_health")
    row = one_row(source, runs, lag.withColumnRenamed("lag_seconds", "incremental_lag_seconds"))
    row = one_row(row, now, totals, waiting, health)
    progress = progress_pct(F.col("backfill_last_id"), F.col("max_id"))
    return row.withColumn("backfill_progress_pct", progress)
