"""The runs: backfill, incremental, replay.

All share one rule: plan in the ledger, write the logs, commit in the ledger. A run that
dies anywhere leaves either a committed batch or one that the next run does again.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.jobs import store as st
from tidemark.jobs.manifest import Lost
from tidemark.jobs.store import Batch, Store
from tidemark.operators import deadletter
from tidemark.operators.change import judged, op_kind, rejected
from tidemark.schemas import LEDGER, RECORD
from tidemark.sources.cursor import WATERMARK, after_cursor, bounded_range, high_water, upto_cursor
from tidemark.sources.numbering import range_plan
from tidemark.functions.times import micros

# Re-read at each batch, so that a batch sees the table as it is then.
Source = Callable[[], DataFrame]
# The rows of an id range ``(lo, hi]``, for tables that can split a range by themselves.
RangeSource = Callable[[int, int], DataFrame]
# A further sink: gets the written rows of a batch and returns once it holds them.
Sink = Callable[[DataFrame, Batch], None]

SEARCH = "search"
# Rows per backfill chunk: one job and one commit each. A chunk is spread over all
# executors, so it is sized to keep a cluster busy for minutes, not to fit a worker.
CHUNK_ROWS = 50_000_000
# Chunks listed on the driver at a time.
CHUNK_LIST = 1_000
# Seconds a chunk is claimed at a time, and between looks at chunks that others hold.
LEASE, LOOK_AGAIN = 600.0, 1.0
# Shares of a backlog a batch can take: halvings, then steps of a 64th.
SHARES = sorted({2.0**-k for k in range(7, 31)} | {k / 64 for k in range(1, 64)})
_MAX_LONG = 2**63 - 1


def write_batch(
    store: Store, batch: Batch, rows: DataFrame, sinks: Sequence[Sink] = (), scattered: bool = False
) -> None:
    """Judge, write and commit one batch: changes, dead letters, further sinks, ledger.

    A rejected row goes to the dead letters and is published as an event all the same;
    the rest of the batch is not held up. Without rejects no dead-letter file is written.
    ``scattered`` rows, a few from each task of a large scan, are brought together first,
    so that the log does not get a tiny file per task.
    """
    at = F.timestamp_micros(F.lit(batch.at_micros))
    changes = judged(rows).withColumns(
        {
            "op": op_kind(),
            "emitted_at": at,
            "batch_seq": F.lit(batch.at_micros).cast("long"),
        }
    )
    written = store.write_changes(batch, changes.hint("rebalance") if scattered else changes)
    stats = _stats(written)
    if stats["n_rejected"]:
        bad = deadletter.failure_rows(
            rejected(written), SEARCH, F.col("emitted_at"), F.col("batch_seq"), RECORD.names
        )
        store.write_dead_letters(batch, bad.hint("rebalance"))
    for sink in sinks:
        sink(written, batch)
    store.commit(batch, {**stats, "n_dead_letters": stats["n_rejected"]})


def _stats(written: DataFrame) -> dict[str, int]:
    """Counts from the written files, not from task counters: a task that ran twice
    cannot count twice."""
    return (
        written.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("n_rejected"),
            F.count_if(F.col("deleted_at").isNotNull()).alias("n_deleted"),
        )
        .first()
        .asDict()
    )


# -- backfill ---------------------------------------------------------------------------


def plan_chunks(store: Store, records: DataFrame, chunk_rows: int) -> bool:
    """Append the chunks of all ids beyond the last planned chunk to the ledger.

    Of runs that plan at the same time the first to append counts.
    """
    known = store.ledger().where(F.col("kind") == st.CHUNK)
    top = known.agg(F.max("last_id").alias("id"), F.max("batch_id").alias("n")).first()
    last_id, n = top["id"] or 0, top["n"] or 0
    new = records.where(after_cursor(records, ["id"], [last_id])).select("id")
    common = {"mode": st.BACKFILL, "kind": st.CHUNK, "at_micros": st.now_micros()}
    # Each chunk starts where the one before ends, so ids that turn up in a gap are read.
    # One row per chunk goes through these windows.
    in_order = Window.orderBy("first_id")
    rows = range_plan(new, chunk_rows).withColumns(
        {
            **{name: F.lit(value) for name, value in common.items()},
            "batch_id": F.row_number().over(in_order) + n,
            "lo_id": F.coalesce(F.lag("last_id").over(in_order), F.lit(last_id)),
        }
    )
    planned = ("batch_id", "lo_id", "last_id", *common)
    filled = [
        (F.col(f.name) if f.name in planned else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in LEDGER.fields
    ]
    return store.append_chunks(rows.select(*filled), n)


def pending_chunks(chunks: DataFrame, commits: DataFrame, key: str = "batch_id") -> DataFrame:
    """Planned minus done, in order: what a resumed run still has to do."""
    return chunks.join(commits.select(key), key, "left_anti").orderBy(key)


def run_backfill(
    store: Store,
    source: Source,
    chunk_rows: int = CHUNK_ROWS,
    sinks: Sequence[Sink] = (),
    max_chunks: int | None = None,
    chunk_source: RangeSource | None = None,
    in_flight: int = 1,
    lease: float = LEASE,
) -> int:
    """Copy the whole table chunk by chunk; returns the chunks committed by this call.

    Call it again after a crash or a pause, or to pick up rows added since. Several runs may
    work on one backfill, and each on ``in_flight`` chunks at a time: a chunk is claimed before
    it is read. Claims are held ``lease`` seconds at a time; those of a run that died are taken
    over after that, those of one that failed at once. A relational source should give
    ``chunk_source`` and partition each chunk's own id range, or only the few partitions of the
    table that hold the chunk would work.
    """

    def copy(chunk: Batch) -> bool:
        batch = None if store.paused(st.BACKFILL) else store.claim(chunk, owner, lease)
        if batch is None:
            return False
        rows = chunk_source(batch.lo_id, batch.last_id) if chunk_source else source()
        in_chunk = after_cursor(rows, ["id"], [batch.lo_id]) & (F.col("id") <= batch.last_id)
        write_batch(store, batch, rows.where(in_chunk), sinks)
        return True

    done = 0
    with _claims(store, lease) as owner:
        while not store.paused(st.BACKFILL):
            todo = _todo(store)
            if not todo and not plan_chunks(store, source(), chunk_rows):
                if store.progress(st.BACKFILL).status != st.COMPLETED:
                    store.set_status(st.BACKFILL, st.COMPLETED)
                return done
            chunks = [Batch(st.BACKFILL, c["batch_id"], 0, 0, c["lo_id"], c["last_id"]) for c in todo]
            n = _work_off(iter(chunks), copy, in_flight, None if max_chunks is None else max_chunks - done)
            done += n
            if done == max_chunks:
                break
            if todo and not n:
                time.sleep(min(lease / 10, LOOK_AGAIN))  # all that is left is others'
    return done


@contextmanager
def _claims(store: Store, lease: float) -> Iterator[str]:
    """An owner whose claims are renewed until the block ends, and given up then."""
    owner, over = uuid.uuid4().hex, threading.Event()

    def keep() -> None:
        while not over.wait(lease / 3):
            store.renew(owner, lease)

    keeper = threading.Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield owner
    finally:
        over.set()
        keeper.join()
        store.renew(owner, 0)


def _work_off(chunks: Iterator[Batch], work: Callable[[Batch], bool], in_flight: int, budget: int | None) -> int:
    """Chunks done by ``in_flight`` threads, each taking the next one; at most ``budget``.

    Chunks of other runs count as not done. The first failure stops the rest.
    """
    lock, failures, under_way, done = threading.Lock(), [], 0, 0

    def one_after_another() -> None:
        nonlocal under_way, done
        while not failures:
            with lock:
                chunk = next(chunks, None) if budget is None or under_way + done < budget else None
                under_way += chunk is not None
            if chunk is None:
                return
            mine = False
            try:
                mine = work(chunk)
            except Lost:  # taken over by another run
                pass
            except BaseException as e:
                failures.append(e)
            with lock:
                under_way -= 1
                done += mine

    threads = [threading.Thread(target=one_after_another) for _ in range(in_flight - 1)]
    for t in threads:
        t.start()
    one_after_another()
    for t in threads:
        t.join()
    if failures:
        raise failures[0]
    return done


def _todo(store: Store) -> list:
    """Planned chunks that are not committed, the first ``CHUNK_LIST`` in order."""
    ledger = store.ledger().where(F.col("mode") == st.BACKFILL)
    chunks = ledger.where(F.col("kind") == st.CHUNK).select("batch_id", "lo_id", "last_id")
    todo = pending_chunks(chunks, ledger.where(F.col("kind") == st.COMMIT))
    return todo.limit(CHUNK_LIST).collect()


# -- incremental ------------------------------------------------------------------------


def next_bound(
    records: DataFrame, lo: tuple[int | None, int], max_rows: int | None = None
) -> tuple[int, int] | None:
    """Where the next batch ends, as ``(micros, id)``, or None without a backlog.

    ``max_rows`` aims at a batch size: the cut is an approximate quantile of the waiting
    timestamps. Count, end and quantiles come from one aggregate over the cursor columns;
    which rows the batch covers is exact all the same.
    """
    backlog = records.where(after_cursor(records, WATERMARK, (lo[0] or 0, lo[1])))
    if not max_rows:
        hi = high_water(backlog)
        return (hi["micros"], hi["id"]) if hi else None
    at = micros(F.col("updated_at"))
    top = F.max(F.struct(at.alias("micros"), "id")).alias("hi")
    seen = backlog.agg(F.count(F.lit(1)).alias("n"), top, F.percentile_approx(at, SHARES, 10_000).alias("cuts")).first()
    if not seen["n"]:
        return None
    if seen["n"] <= max_rows:
        return (seen["hi"]["micros"], seen["hi"]["id"])
    fitting = [cut for share, cut in zip(SHARES, seen["cuts"]) if share * seen["n"] <= max_rows]
    cut = fitting[-1] if fitting else seen["cuts"][0]
    hi = high_water(backlog.where(upto_cursor(records, WATERMARK, (cut, _MAX_LONG))))
    return (hi["micros"], hi["id"])


def run_incremental(
    store: Store,
    source: Source,
    sinks: Sequence[Sink] = (),
    max_rows: int | None = None,
    lookback_micros: int = 0,
) -> bool:
    """One batch of changes after the cursor; False if there is nothing to do.

    The upper bound goes into the ledger before the batch is read. Repeat until False, or
    run on a schedule.
    """
    progress = store.progress(st.INCREMENTAL)
    if progress.status == st.PAUSED:
        return False
    if progress.open:
        batch = store.plan(progress, st.INCREMENTAL, progress.open.batch_id)
    else:
        lo = progress.cursor
        hi = next_bound(source(), lo, max_rows)
        if hi is None:
            return False
        bounds = {"lo_micros": lo[0], "lo_id": lo[1], "hi_micros": hi[0], "hi_id": hi[1]}
        batch = store.plan(progress, st.INCREMENTAL, progress.next_batch_id, **bounds)
    lo, hi = (batch.lo_micros, batch.lo_id), (batch.hi_micros, batch.hi_id)
    rows = bounded_range(source(), lo, hi, lookback_micros)
    # The first batch starts at the epoch and may be the whole table; later ones are deltas.
    write_batch(store, batch, rows, sinks, scattered=lo[0] is not None)
    return True


# -- replay -----------------------------------------------------------------------------


def run_replay(
    store: Store, source: Source, sinks: Sequence[Sink] = (), keys: DataFrame | None = None
) -> int:
    """Replay pending dead letters whose current source row is fit now.

    ``keys`` (source_record_id, sink) picks entries; without it, all pending ones. Repaired
    rows join the change log under their own mode, which publishes no events, and go to
    ``sinks`` like any batch; entries are closed from the written copy. If a sink refuses
    them, nothing is repaired and each entry gets one more attempt with the sink's error.
    Returns the number of rows repaired. Without anything to repair, nothing is written.
    """
    if store.dead_letter_log().isEmpty():
        return 0
    plan = deadletter.replay_plan(store.dead_letters(), source())
    if keys is not None:
        plan = plan.join(
            keys.select(F.col("source_record_id").alias("id"), "sink").distinct(), ["id", "sink"], "left_semi"
        )
    fit = deadletter.replayable(plan)
    if fit.isEmpty():
        return 0
    batch, rows = _replay_batch(store, fit)
    written = store.write_changes(batch, rows)
    stats = _stats(written)
    try:
        for sink in sinks:
            sink(written, batch)
    except Exception as refusal:
        _bump(store, written, refusal)
        return 0
    outcome = F.when(F.col("deleted_at").isNull(), deadletter.OK).otherwise(deadletter.TOMBSTONE)
    closed = written.withColumns({"outcome": outcome, "sink": F.lit(SEARCH)})
    store.write_dead_letters(batch, deadletter.outcome_rows(closed, *_stamp(batch)))
    store.commit(batch, {**stats, "n_dead_letters": stats["n_rows"]})
    return stats["n_rows"]


def _stamp(batch: Batch) -> tuple[Column, Column]:
    return F.timestamp_micros(F.lit(batch.at_micros)), F.lit(batch.at_micros).cast("long")


def _replay_batch(store: Store, fit: DataFrame) -> tuple[Batch, DataFrame]:
    progress = store.progress(st.REPLAY)
    batch_id = progress.open.batch_id if progress.open else progress.next_batch_id
    batch = store.plan(progress, st.REPLAY, batch_id)
    at, seq = _stamp(batch)
    return batch, judged(fit).withColumns({"op": F.lit(None).cast("string"), "emitted_at": at, "batch_seq": seq})


def _bump(store: Store, refused: DataFrame, refusal: Exception) -> None:
    """One more attempt for every refused entry, as a new attempt of the batch without rows."""
    progress = store.progress(st.REPLAY)
    batch = store.plan(progress, st.REPLAY, progress.open.batch_id)
    keys = refused.select(F.col("id").alias("source_record_id"), F.lit(SEARCH).alias("sink"))
    error = F.lit(f"{type(refusal).__name__}: {refusal}")
    store.write_dead_letters(batch, deadletter.bump_rows(keys, error, *_stamp(batch)))
    n = keys.count()
    store.commit(batch, {"n_rows": 0, "n_rejected": 0, "n_deleted": 0, "n_dead_letters": n})
