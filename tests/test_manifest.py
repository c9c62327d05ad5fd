"""The numbered manifest, claims of chunks, and snapshots that grow with the changes."""

import threading
import time

import pytest
from pyspark.sql import functions as F
from rows import record, table
from test_jobs import ROWS, Boom, Table, documents, expected, fail_once, fresh, letters

from tidemark.jobs import manifest as mf
from tidemark.jobs import replicate
from tidemark.jobs import store as st
from tidemark.jobs.manifest import Folder, Lost, Manifest
from tidemark.jobs.store import Batch, Store


def book(spark, work):
    return Manifest(spark, work + "/m", work + "/runs")


def test_a_file_is_created_once(spark, work):
    folder, got = Folder(spark, work + "/f"), []
    threads = [threading.Thread(target=lambda k=k: got.append((folder.create("x.json", str(k)), k))) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    (winner,) = [k for won, k in got if won]
    assert folder.read("x.json") == str(winner) and folder.names() == ["x.json"]
    assert folder.read("y.json") is None and folder.names("nothing") == []


def test_steps_of_many_writers_all_count(spark, work):
    m = book(spark, work)

    def add():
        for _ in range(10):
            m.step(lambda c: {"n": c.get("n", 0) + 1})

    threads = [threading.Thread(target=add) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert m.newest() == (60, {"n": 60})


def test_old_entries_go_and_a_late_writer_loses(spark, work, monkeypatch):
    monkeypatch.setattr(mf, "KEPT", 5)
    m = book(spark, work)
    for n in range(1, 21):
        assert m.publish(n, {"n": n})
    assert len(m._numbers()) <= 6 and m.newest() == (20, {"n": 20})
    assert not m.publish(7, {"n": "late"}) and m.newest() == (20, {"n": 20})
    assert not m.publish(20, {"n": "same"})


def test_runs_are_merged_by_levels(spark, work, monkeypatch):
    monkeypatch.setattr(mf, "FAN", 3)
    m, runs = book(spark, work), []
    for n in range(11):
        runs = m.merged("t", [*runs, m.write_run("t", spark.range(n, n + 1))], spark.range(0).schema, lambda df: df.coalesce(1))
        assert len(runs) <= 6
    assert sorted(r["id"] for r in m.read_runs(runs, spark.range(0).schema).collect()) == list(range(11))
    assert sorted(r["level"] for r in runs) == [0, 0, 2] and sum(r["n"] for r in runs) == 11


def test_vacuum_spares_what_is_named_or_leased(spark, work):
    m = book(spark, work)
    one, two, stray = (m.write_run("t", spark.range(n)) for n in (1, 2, 3))
    m.step(lambda c: {"t": [one]})
    with m.lease(60) as content:
        m.step(lambda c: {"t": [two]})
        assert m.vacuum(grace=0) == 1  # the stray one
        assert m.read_runs(content["t"], spark.range(0).schema).count() == 1
    assert m.vacuum(grace=3600) == 0  # recent entries are spared as well
    assert m.vacuum(grace=0) == 1
    assert m.read_runs(m.newest()[1]["t"], spark.range(0).schema).count() == 2
    with m.lease(0.0):
        m.step(lambda c: {"t": []})
        assert m.vacuum(grace=0) == 1  # the lease ran out


def test_progress_is_one_small_file_after_many_steps(spark, work, monkeypatch):
    store, sizes = fresh(spark, work), []
    for n in range(1, 61):
        batch = Batch(st.INCREMENTAL, n, 1, st.now_micros(), lo_micros=n, lo_id=n, hi_micros=n + 1, hi_id=n)
        store.append_ledger({**vars(batch), "kind": st.PLAN})
        store.commit(batch, {"n_rows": 1, "n_rejected": 0, "n_deleted": 0, "n_dead_letters": 0})
        number, _ = store.manifest.newest()
        sizes.append(len(store.manifest._entries.read(f"{number:012d}.json")))
    assert len(store.ledger().inputFiles()) <= 2 * st.FOLD_EVERY
    assert max(sizes) < 12_000
    monkeypatch.setattr(Store, "ledger", None)  # progress reads no table
    progress = store.progress(st.INCREMENTAL)
    assert progress.cursor == (61, 60) and progress.next_batch_id == 61 and progress.open is None


def standing(store):
    row = store.checkpoints().where("mode = 'backfill'").first()
    return row["last_id"], row["rows_processed"], row["batches"]


@pytest.mark.parametrize("in_flight", [1, 4])
def test_two_runs_share_a_backfill(spark, work, in_flight):
    store, source, done = fresh(spark, work), Table(spark, ROWS), []
    threads = [
        threading.Thread(
            target=lambda: done.append(replicate.run_backfill(Store(spark, store.root), source, chunk_rows=5, in_flight=in_flight, lease=60))
        )
        for _ in range(2)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(done) == 8 and len(done) == 2
    assert documents(store) == expected(ROWS)
    assert store.events().count() == 40 and standing(store) == (40, 40, 8)
    commits = store.ledger().where("kind = 'commit' AND mode = 'backfill'")
    assert commits.count() == commits.select("batch_id").distinct().count() == 8
    assert letters(store) == [(i, 1, "pending") for i in (3, 13, 23, 33)]
    assert store.manifest.newest()[1]["claims"] == {}


def chunk_of(store, n):
    (row,) = store.ledger().where(f"kind = 'chunk' AND batch_id = {n}").collect()
    return Batch(st.BACKFILL, n, 0, 0, row["lo_id"], row["last_id"])


def test_a_dead_claim_is_taken_over_and_its_run_fenced_off(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.plan_chunks(store, source(), 15)
    dead = store.claim(chunk_of(store, 1), "dead", 1.0)
    assert store.claim(chunk_of(store, 1), "other", 60) is None
    time.sleep(1.1)
    assert replicate.run_backfill(store, source, chunk_rows=15, lease=5) == 3
    before = documents(store)
    with pytest.raises(Lost):
        replicate.write_batch(store, dead, table(spark, [record(999)]))
    assert documents(store) == before == expected(ROWS) and standing(store) == (40, 40, 3)
    attempts = store.ledger().where("kind = 'plan' AND batch_id = 1").select("attempt", "at_micros").collect()
    assert sorted(r["attempt"] for r in attempts) == [1, 2] and len({r["at_micros"] for r in attempts}) == 1


def test_a_committed_chunk_cannot_be_claimed(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_backfill(store, source, chunk_rows=15)
    assert store.claim(chunk_of(store, 2), "late", 60) is None


def test_claims_are_renewed_while_a_chunk_is_worked_on(spark, work):
    store, source, tried = fresh(spark, work), Table(spark, ROWS), []

    def slow(rows, batch):
        time.sleep(2.0)
        tried.append(store.claim(chunk_of(store, batch.batch_id), "other", 60))

    assert replicate.run_backfill(store, source, sinks=[slow], lease=0.9) == 1
    assert tried == [None]


def test_the_cursor_waits_for_the_first_open_chunk(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.plan_chunks(store, source(), 10)
    held = store.claim(chunk_of(store, 2), "slow", 600)
    assert replicate.run_backfill(store, source, max_chunks=3) == 3
    assert standing(store) == (10, 30, 3)
    store.compact(2)
    store.renew("slow", 0)
    assert held.attempt == 1 and replicate.run_backfill(store, source) == 1
    assert standing(store) == (40, 40, 4) and documents(store) == expected(ROWS)


def test_of_two_plans_of_chunks_the_first_counts(spark, work, monkeypatch):
    store, source = fresh(spark, work), Table(spark, ROWS)
    real = Store.append_chunks

    def late(self, rows, planned):
        with monkeypatch.context() as patch:
            patch.setattr(Store, "append_chunks", real)
            replicate.plan_chunks(Store(spark, store.root), source(), 8)
        return real(self, rows, planned)

    with monkeypatch.context() as patch:
        patch.setattr(Store, "append_chunks", late)
        assert replicate.plan_chunks(store, source(), 15)
    assert store.ledger().where("kind = 'chunk'").count() == 5
    assert replicate.run_backfill(store, source) == 5
    assert documents(store) == expected(ROWS) and store.events().count() == 40


@pytest.mark.parametrize("in_flight", [2, 3])
def test_a_failure_in_flight_stops_the_run_and_the_next_goes_on(spark, work, monkeypatch, in_flight):
    store, source = fresh(spark, work), Table(spark, ROWS)
    with monkeypatch.context() as patch:
        fail_once(patch, "write_changes", 3, before=False)
        with pytest.raises(Boom):
            replicate.run_backfill(store, source, chunk_rows=5, in_flight=in_flight)
    replicate.run_backfill(Store(spark, store.root), source, chunk_rows=5, in_flight=in_flight)
    assert documents(store) == expected(ROWS) and standing(store) == (40, 40, 8)


# -- snapshots --------------------------------------------------------------------------


def test_compaction_writes_follow_the_changes(spark, work):
    rows = [record(i, version=1, amount=f"{i}.00") for i in range(400)]
    store, source = fresh(spark, work), Table(spark, rows)
    replicate.run_incremental(store, source)
    store.compact(4)
    sizes = []
    for n in range(4):
        for i in (n, 100 + n, 200 + n):
            source.rows[i] = record(i, version=2 + n, updated=1000 + n, amount="7", deleted=i == n)
        source.rows.append(record(1000 + n, updated=1000 + n))
        assert replicate.run_incremental(store, source)
        before = {r["path"] for r in store._snapshot()["runs"]}
        store.compact(4)
        runs = store._snapshot()["runs"]
        sizes.append(sum(r["n"] for r in runs if r["path"] not in before))
        assert documents(store) == expected(source.rows)
        assert len(runs) <= 4 and runs[0]["n"] == 400
    assert max(sizes) <= 16
    plan = store.state()._jdf.queryExecution().executedPlan().toString()
    assert len(store._snapshot()["runs"]) > 1 and "Exchange" not in plan[: plan.index("Union")]
    store.compact(2)  # other buckets: written anew
    assert len(store._snapshot()["runs"]) == 1 and documents(store) == expected(source.rows)
    removed = store.vacuum(grace=0)
    assert removed > 0 and documents(store) == expected(source.rows)


def test_a_crash_of_the_compaction_changes_nothing(spark, work, monkeypatch):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_incremental(store, source)
    with monkeypatch.context() as patch:
        fail_once(patch, "append_ledger", 1, before=True)
        with pytest.raises(Boom):
            store.compact(3)
    assert store._snapshot()["runs"] == [] and documents(store) == expected(ROWS)
    store.compact(3)
    assert documents(store) == expected(ROWS)
    fresh(spark, work, "empty").compact(3)


def test_of_two_compactions_the_first_counts(spark, work, monkeypatch):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_incremental(store, source)
    real = Store._bucketed_run

    def late(self, rows, n):
        run = real(self, rows, n)
        with monkeypatch.context() as patch:
            patch.setattr(Store, "_bucketed_run", real)
            Store(spark, store.root).compact(2)
        return run

    with monkeypatch.context() as patch:
        patch.setattr(Store, "_bucketed_run", late)
        store.compact(3)
    assert store._snapshot()["n_buckets"] == 2 and documents(store) == expected(ROWS)
    assert store.ledger().where(F.col("kind") == st.SNAPSHOT).count() == 1
