"""Crash gates: whatever step fails, a later run ends with what a smooth run has."""

import random

import pytest
from pyspark.sql import functions as F
from rows import at, record, table

from tidemark.jobs import replicate
from tidemark.jobs import store as st
from tidemark.jobs.store import Store
from tidemark.operators import dedupe, reconcile

ROWS = [
    record(i, version=1 + i % 3, updated=i // 4, amount="N/A" if i % 10 == 3 else f"{i}.50", deleted=i % 11 == 5)
    for i in range(1, 41)
]


class Boom(Exception):
    pass


class Table:
    """A source table whose content a test can change."""

    def __init__(self, spark, rows):
        self.spark, self.rows = spark, list(rows)

    def __call__(self):
        return table(self.spark, self.rows)


def fresh(spark, work, name="s"):
    return Store.create(spark, f"{work}/{name}")


def documents(store):
    return sorted(
        (r["id"], r["version"], r["amount"], r["status"], r["updated_at"]) for r in store.state().collect()
    )


def letters(store):
    return sorted(
        (r["source_record_id"], r["attempt_count"], r["status"]) for r in store.dead_letters().collect()
    )


def unique_events(store):
    rows = dedupe.first_deliveries(store.events().select("id", "version", "op", "batch_seq"), ["batch_seq"])
    return sorted((r["id"], r["version"], r["op"]) for r in rows.collect())


def expected(rows):
    live = [r for r in rows if r[-1] is None and r[9] != "N/A"]
    return sorted((r[0], r[10], float(r[9]), r[7], r[12]) for r in live)


def fail_once(monkeypatch, method, n, before):
    """Make the n-th call of a store method fail, before or after it did its work."""
    real, calls = getattr(Store, method), [0]

    def wrapped(self, *args, **kwargs):
        calls[0] += 1
        if calls[0] == n and before:
            raise Boom(method)
        out = real(self, *args, **kwargs)
        if calls[0] == n:
            raise Boom(method)
        return out

    monkeypatch.setattr(Store, method, wrapped)


def test_backfill_in_chunks(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    assert replicate.run_backfill(store, source, chunk_rows=15) == 3
    assert documents(store) == expected(ROWS)
    row = store.checkpoints().where("mode = 'backfill'").first()
    assert (row["status"], row["last_id"], row["rows_processed"]) == ("completed", 40, 40)
    # Rejected rows are published too.
    assert len(unique_events(store)) == 40
    assert replicate.run_backfill(store, source, chunk_rows=15) == 0
    # Rows added later are picked up by the next call.
    source.rows += [record(i) for i in range(41, 44)]
    assert replicate.run_backfill(store, source, chunk_rows=15) == 1
    assert documents(store) == expected(source.rows)


@pytest.mark.parametrize("method", ["write_changes", "write_dead_letters", "commit"])
@pytest.mark.parametrize("before", [True, False])
def test_backfill_crash_at_every_step(spark, work, monkeypatch, method, before):
    store, source = fresh(spark, work), Table(spark, ROWS)
    with monkeypatch.context() as patch:
        fail_once(patch, method, 2, before)
        with pytest.raises(Boom):
            replicate.run_backfill(store, source, chunk_rows=15)
    # A new process: nothing but the folder is left.
    store = Store(spark, store.root)
    replicate.run_backfill(store, source, chunk_rows=15)
    assert documents(store) == expected(ROWS)
    assert letters(store) == [(i, 1, "pending") for i in (3, 13, 23, 33)]
    assert len(unique_events(store)) == 40
    assert store.checkpoints().where("mode = 'backfill'").first()["rows_processed"] == 40


def test_cut_after_every_chunk(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    steps = 0
    while replicate.run_backfill(Store(spark, store.root), source, chunk_rows=15, max_chunks=1):
        steps += 1
    assert steps == 3
    per_id = store.changes().groupBy("id").count()
    assert per_id.count() == 40 and per_id.where("count > 1").count() == 0


@pytest.mark.parametrize("method", ["write_changes", "write_dead_letters", "commit"])
def test_incremental_crash_covers_the_same_range(spark, work, monkeypatch, method):
    store, source = fresh(spark, work), Table(spark, ROWS)
    with monkeypatch.context() as patch:
        fail_once(patch, method, 1, before=False)
        with pytest.raises(Boom):
            replicate.run_incremental(store, source)
    # The table moves on before the retry.
    source.rows[0] = record(1, version=9, updated=500, amount="9")
    store = Store(spark, store.root)
    while replicate.run_incremental(store, source):
        pass
    assert documents(store) == expected(source.rows)
    assert not replicate.run_incremental(store, source)


def test_incremental_batches_of_a_size(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    runs = 0
    while replicate.run_incremental(store, source, max_rows=12):
        runs += 1
    assert runs >= 3
    assert documents(store) == expected(ROWS)
    per_id = store.changes().groupBy("id").count()
    assert per_id.count() == 40 and per_id.where("count > 1").count() == 0


def test_both_workers_meet(spark, work):
    """Old and new versions arrive in the wrong order; bad rows are one entry, two attempts."""
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_incremental(store, source)
    source.rows[1] = record(2, version=7, updated=900, amount="7")
    replicate.run_incremental(store, source)
    stale = Table(spark, ROWS)
    replicate.run_backfill(store, stale, chunk_rows=25)
    assert documents(store) == expected(source.rows)
    assert letters(store) == [(i, 2, "pending") for i in (3, 13, 23, 33)]
    live = source().where("deleted_at IS NULL AND amount <> 'N/A'").select("id", "version")
    verdicts = reconcile.summary(reconcile.reconcile(live, store.state().select("id", "version"))).collect()
    assert [(r["verdict"], r["n"]) for r in verdicts] == [("equal", len(expected(source.rows)))]


def test_pause_wins_over_the_worker(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    store.pause(st.BACKFILL)
    store.pause(st.INCREMENTAL)
    store.set_status(st.BACKFILL, st.RUNNING)
    assert store.progress(st.BACKFILL).status == "paused"
    assert replicate.run_backfill(store, source, chunk_rows=15) == 0
    assert not replicate.run_incremental(store, source)
    store.resume(st.BACKFILL)
    assert store.progress(st.BACKFILL).status == "idle"
    assert replicate.run_backfill(store, source, chunk_rows=15) == 3


def test_replay(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_backfill(store, source)
    replicate.run_incremental(store, source)
    assert replicate.run_replay(store, source) == 0
    events = unique_events(store)
    # Fixed without a new version; fixed with one; deleted; 33 stays bad.
    source.rows[2] = record(3, version=1, updated=0, amount="1.00")
    source.rows[12] = record(13, version=5, updated=700, amount="2.00")
    source.rows[22] = record(23, version=5, updated=700, amount="N/A", deleted=True)
    assert replicate.run_replay(store, source) == 3
    assert letters(store) == [(3, 2, "replayed"), (13, 2, "replayed"), (23, 2, "resolved"), (33, 2, "pending")]
    assert documents(store) == expected(source.rows)
    # A replay repairs the state; it publishes nothing.
    assert unique_events(store) == events
    # Failing again reopens the entry.
    source.rows[2] = record(3, version=8, updated=950, amount="N/A")
    replicate.run_incremental(store, source)
    assert letters(store)[0] == (3, 3, "pending")


def test_replay_crash(spark, work, monkeypatch):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_backfill(store, source)
    source.rows[2] = record(3, amount="1.00")
    with monkeypatch.context() as patch:
        fail_once(patch, "write_dead_letters", 1, before=False)
        with pytest.raises(Boom):
            replicate.run_replay(store, source)
    assert letters(store)[0] == (3, 1, "pending")
    assert replicate.run_replay(Store(spark, store.root), source) == 1
    assert letters(store)[0] == (3, 1, "replayed")


def test_compaction_keeps_tombstones_and_order(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_incremental(store, source)
    store.compact(4)
    before = documents(store)
    assert before == expected(ROWS)
    source.rows[0] = record(1, version=6, updated=900, amount="6")
    source.rows[1] = record(2, version=6, updated=900, deleted=True)
    replicate.run_incremental(store, source)
    # An old version of a deleted row, delivered late by the other worker.
    replicate.run_backfill(store, Table(spark, ROWS), chunk_rows=15)
    assert documents(store) == expected(source.rows)
    store.compact(4)
    assert documents(store) == expected(source.rows)
    # Another session learns of the snapshot from the ledger.
    spark.sql(f"DROP TABLE {store._table_name(store.ledger().agg(F.max_by('path', 'at_micros')).first()[0])}")
    assert documents(Store(spark, store.root)) == expected(source.rows)


def test_reading_a_snapshot_shuffles_only_the_log(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_incremental(store, source)
    store.compact(4)
    source.rows[0] = record(1, version=6, updated=900, amount="6")
    replicate.run_incremental(store, source)
    plan = store.state()._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("Union")]
    assert "Exchange" not in top and "Bucketed: true" in plan
    # Writing the next snapshot needs no further shuffle either.
    again = store._merged().repartition(4, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in again[: again.index("Union")]


def test_half_written_batch_is_invisible(spark, work, monkeypatch):
    store, source = fresh(spark, work), Table(spark, ROWS)
    with monkeypatch.context() as patch:
        fail_once(patch, "commit", 1, before=True)
        with pytest.raises(Boom):
            replicate.run_backfill(store, source)
    assert documents(store) == [] and letters(store) == [] and unique_events(store) == []


@pytest.mark.parametrize(
    "rows",
    [[], [record(1, amount="N/A")], [record(1, deleted=True), record(2, version=2, deleted=True)]],
    ids=["empty", "all rejected", "all deleted"],
)
def test_odd_batches_advance(spark, work, rows):
    store, source = fresh(spark, work), Table(spark, rows)
    assert replicate.run_backfill(store, source) == (1 if rows else 0)
    assert replicate.run_incremental(store, source) is bool(rows)
    assert not replicate.run_incremental(store, source)
    assert documents(store) == []
    assert store.progress(st.BACKFILL).status == "completed"


def test_further_sinks_see_the_written_rows(spark, work):
    store, source, seen = fresh(spark, work), Table(spark, ROWS), []
    replicate.run_backfill(store, source, 15, sinks=[lambda rows, b: seen.append((b.batch_id, rows.count()))])
    assert seen == [(1, 15), (2, 15), (3, 10)]


def test_a_sink_that_fails_holds_the_batch_back(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)

    def down(rows, batch):
        raise Boom

    with pytest.raises(Boom):
        replicate.run_backfill(store, source, sinks=[down])
    assert store.progress(st.BACKFILL).open.batch_id == 1 and documents(store) == []
    replicate.run_backfill(store, source)
    assert documents(store) == expected(ROWS)
    assert store.progress(st.BACKFILL).open is None


def test_shuffled_rebatched_feeds_converge(spark, work):
    rng = random.Random(4)
    versions = [record(i, v, v, str(v), deleted=(v == 3 and i % 2 == 0)) for i in range(1, 9) for v in (1, 2, 3)]
    want = sorted((i, 3, 3.0, "active", at(3)) for i in (1, 3, 5, 7))
    for n in range(2):
        mixed = versions + rng.sample(versions, 8)
        rng.shuffle(mixed)
        store = fresh(spark, work, f"r{n}")
        cut = rng.randrange(5, 25)
        for number, part in enumerate((mixed[:cut], mixed[cut:]), 1):
            progress = store.progress(st.STREAM)
            replicate.write_batch(store, store.plan(progress, st.STREAM, number), table(spark, part))
        assert documents(store) == want


def test_a_run_that_comes_back_is_not_read_twice(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    zombie = store.plan(store.progress(st.STREAM), st.STREAM, 1)
    batch = store.plan(store.progress(st.STREAM), st.STREAM, 1)
    assert (zombie.attempt, batch.attempt, zombie.at_micros) == (1, 2, batch.at_micros)
    replicate.write_batch(store, batch, source())
    replicate.write_batch(store, zombie, source())
    assert store.events().count() == 40
    assert letters(store) == [(i, 1, "pending") for i in (3, 13, 23, 33)]


def test_chunks_can_come_from_a_ranged_source(spark, work):
    store, asked = fresh(spark, work), []

    def ranged(lo, hi):
        asked.append((lo, hi))
        return table(spark, ROWS)

    replicate.run_backfill(store, Table(spark, ROWS), 15, chunk_source=ranged)
    assert asked == [(0, 15), (15, 30), (30, 40)]
    assert documents(store) == expected(ROWS)
