"""Late commits, replays with sinks, NULL keys, range plans, paused streams, text ids."""

import json
import random
import threading
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from rows import record, table
from test_jobs import ROWS, Boom, Table, documents, fresh, letters, unique_events

from tidemark.jobs import replicate
from tidemark.jobs import store as st
from tidemark.operators import deadletter, routing
from tidemark.plans.queries import QUERIES
from tidemark.schemas import EVENT, RECORD
from tidemark.sources import numbered
from tidemark.sources.numbering import id_buckets, range_plan
from tidemark.streaming import consumer
from tidemark.streaming.replicate import replicate_stream


def standing(store):
    row = store.checkpoints().where(F.col("mode") == st.STREAM).first()
    return documents(store), unique_events(store), letters(store), row["rows_processed"], row["batches"]


def test_the_first_commit_of_a_batch_wins(spark, work):
    """A run thought dead commits last, with other rows; nothing that was visible changes."""
    store = fresh(spark, work)
    zombie = store.plan(store.progress(st.STREAM), st.STREAM, 1)
    batch = store.plan(store.progress(st.STREAM), st.STREAM, 1)
    replicate.write_batch(store, batch, table(spark, [record(1, 2, amount="2"), record(2, 2, amount="N/A")]))
    before = standing(store)
    assert before[3:] == (2, 1) and before[0][0][1] == 2
    replicate.write_batch(store, zombie, table(spark, [record(1, 1, amount="1"), record(3, 1, amount="N/A"), record(4)]))
    assert standing(store) == before
    store.compact(2)
    assert documents(store) == before[0]


def test_replay_goes_to_sinks_and_a_refusal_adds_an_attempt(spark, work):
    store, source, index = fresh(spark, work), Table(spark, ROWS), {}

    def sink(rows, batch):
        index.update({r["id"]: r["version"] for r in rows.where("reject_reason IS NULL").collect()})

    def down(rows, batch):
        raise Boom("index is away")

    replicate.run_backfill(store, source, sinks=[sink])
    assert 3 not in index
    files = store.ledger().count()
    assert replicate.run_replay(store, source, sinks=[sink]) == 0
    assert store.ledger().count() == files  # nothing to do, nothing written
    source.rows[2], source.rows[12] = record(3, 4, amount="1.00"), record(13, 4, amount="2.00")
    before = documents(store)
    assert replicate.run_replay(store, source, sinks=[down]) == 0
    assert documents(store) == before
    assert letters(store) == [(3, 2, "pending"), (13, 2, "pending"), (23, 1, "pending"), (33, 1, "pending")]
    assert deadletter.entry(store.dead_letters(), 3, "search").first()["error"] == "Boom: index is away"
    chosen = spark.createDataFrame([(13, "search"), (23, "search")], "source_record_id long, sink string")
    assert replicate.run_replay(store, source, sinks=[sink], keys=chosen) == 1
    assert index[13] == 4 and 3 not in index
    assert replicate.run_replay(store, source, sinks=[sink]) == 1
    assert index[3] == 4
    assert letters(store) == [(3, 2, "replayed"), (13, 2, "replayed"), (23, 1, "pending"), (33, 1, "pending")]
    last = store.commits().where("mode = 'replay'").orderBy(F.desc("batch_id")).first()
    assert (last["n_rows"], last["n_rejected"], last["n_dead_letters"]) == (1, 0, 1)


def test_attempts_of_a_real_store(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_backfill(store, source)
    replicate.run_incremental(store, source)
    source.rows[2] = record(3, 4, amount="1.00")
    replicate.run_replay(store, source)
    got = deadletter.attempts(store.dead_letter_log()).select("source_record_id", "mode", "attempt_no").collect()
    want = [(i, mode, n) for i in (3, 13, 23, 33) for n, mode in enumerate(("backfill", "incremental"), 1)]
    assert sorted(map(tuple, got)) == want


def test_reading_needs_no_shuffle_of_the_log(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_backfill(store, source, chunk_rows=15)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.changes()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Join" not in plan


def test_long_errors_are_kept_whole(spark, work):
    store = fresh(spark, work)
    replicate.run_backfill(store, Table(spark, [record(1, amount="x" * 5000)]))
    assert len(store.dead_letters().first()["error"]) > 5000
    assert len(deadletter.list_entries(store.dead_letters()).first()["error"]) == 2000


def test_rows_without_a_key_are_numbered(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, rng.randrange(1 << 44)]), n) for n in range(400)]
    df = spark.createDataFrame(rows, "k string, id long, n long")
    got = numbered(df, ["id", "n"], id_buckets(), ["k"]).collect()
    for key in (None, "a", "b"):
        mine = sorted(((i is not None, i or 0, n) for k, i, n in rows if k == key))
        assert [r["n"] for r in sorted((r for r in got if r["k"] == key), key=lambda r: r["rank"])] == [n for *_, n in mine]
        assert sorted(r["rank"] for r in got if r["k"] == key) == list(range(1, len(mine) + 1))


@pytest.mark.parametrize("about", [1, 7, 100, 5000])
def test_ranges_cover_all_ids_in_order(spark, about):
    ids = sorted(random.Random(about).sample(range(-50, 1 << 22), 3000))
    plan = range_plan(spark.createDataFrame([(i,) for i in ids], "id long"), about).orderBy("page").collect()
    assert sum(r["n_rows"] for r in plan) == len(ids)
    assert all(a["last_id"] < b["first_id"] for a, b in zip(plan, plan[1:]))
    at = 0
    for r in plan:
        assert ids[at] == r["first_id"] and ids[at + r["n_rows"] - 1] == r["last_id"]
        assert r["n_rows"] <= about + max(0, about // 8)
        at += r["n_rows"]


def test_planning_shuffles_counts_not_ids(spark, work):
    spark.range(1 << 18).repartition(3).write.parquet(work + "/ids")
    ids = spark.read.parquet(work + "/ids")
    plan = range_plan(ids, 1 << 17)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("HashAggregate") < text.index("FileScan")
    assert plan.agg(F.sum("n_rows")).first()[0] == 1 << 18


def test_repeated_wildcards(spark):
    assert routing.binding_regex("#.#") == "^.*$"
    assert routing.binding_regex("a.#.#") == routing.binding_regex("a.#")


def test_a_paused_stream_waits_and_goes_on(spark, work):
    store = fresh(spark, work)
    table(spark, ROWS).write.parquet(work + "/in")
    store.pause(st.STREAM)
    stream = spark.readStream.schema(RECORD).parquet(work + "/in")
    run = replicate_stream(stream, store, work + "/cp", every="200 milliseconds", look_again=0.1)
    try:
        time.sleep(4)
        assert store.changes().count() == 0 and run.isActive
        threading.Timer(0.1, lambda: store.resume(st.STREAM)).start()
        deadline = time.time() + 60
        while store.changes().count() < len(ROWS) and time.time() < deadline:
            time.sleep(0.3)
        assert store.changes().count() == len(ROWS)
        table(spark, [record(900)]).write.mode("append").parquet(work + "/in")  # the stream goes on polling
        while store.changes().count() <= len(ROWS) and time.time() < deadline:
            time.sleep(0.3)
        assert store.changes().count() == len(ROWS) + 1
    finally:
        run.stop()


def test_ids_may_be_texts(spark):
    data = {"id": "7", "name": "n"}
    events = [{"id": "7", "version": 1, "data": data}, {"id": 7, "version": 1, "data": {**data, "id": 7}}, {"id": "x", "version": 1, "data": data}]
    raw = spark.createDataFrame([(json.dumps(e),) for e in events] + [("{",)], "value string")
    got = consumer.parse_events(raw, EVENT).select("id", "data.id", "poison").collect()
    assert [tuple(r) for r in got] == [(7, 7, None), (7, 7, None), (None, 7, "malformed"), (None, None, "malformed")]


def test_a_folded_ledger_says_the_same(spark, work, monkeypatch):
    monkeypatch.setattr(st, "FOLD_EVERY", 10_000)
    store = fresh(spark, work)
    source = Table(spark, ROWS)
    replicate.run_backfill(store, source, chunk_rows=15)
    for n in range(25):
        store.set_status(st.INCREMENTAL, st.RUNNING if n % 2 else st.IDLE)
    rows = sorted(map(str, store.ledger().collect()))
    progress = store.progress(st.BACKFILL)
    held = lambda: [len(store.manifest.newest()[1][part]) for part in ("tail", "ledger")]
    assert held()[0] > 25
    store.fold()
    assert sorted(map(str, store.ledger().collect())) == rows and held() == [0, 1] and len(store.ledger().inputFiles()) == 1
    other = st.Store(spark, store.root)  # another process reads the fold and the tail
    other.set_status(st.INCREMENTAL, st.IDLE)
    assert held() == [1, 1] and replace(store.progress(st.BACKFILL), newest_micros=0) == replace(progress, newest_micros=0)
    source.rows.append(record(500))
    replicate.run_backfill(other, source, chunk_rows=15)
    other.fold()
    store.fold()
    assert held() == [0, 1] and documents(store) == documents(other)
    assert store.commits().where("mode = 'backfill'").count() == 4


def test_writers_fold_by_themselves(spark, work, monkeypatch):
    monkeypatch.setattr(st, "FOLD_EVERY", 4)
    store = fresh(spark, work)
    for _ in range(9):
        store.set_status(st.BACKFILL, st.IDLE)
    assert store.ledger().count() == 11 and len(store.ledger().inputFiles()) <= 5


def test_batches_are_ordered_by_the_ledger_not_by_clocks(spark, work, monkeypatch):
    store = fresh(spark, work)
    with monkeypatch.context() as patch:
        patch.setattr(st, "now_micros", lambda: 9_000_000_000_000_000)  # a host whose clock runs ahead
        replicate.run_backfill(store, Table(spark, [record(1, amount="1")]))
    # A repair with an unchanged version, planned by a host with the right time.
    replicate.write_batch(store, store.plan(store.progress(st.REPLAY), st.REPLAY, 1), table(spark, [record(1, amount="2")]))
    assert [d[2] for d in documents(store)] == [2.0]


def test_lookback_finds_rows_that_commit_late(spark, work):
    store, source = fresh(spark, work), Table(spark, [record(1, updated=100.0), record(2, updated=200.0)])
    assert replicate.run_incremental(store, source)
    source.rows += [record(3, updated=199.0), record(4, updated=300.0)]  # 3 was committed late
    assert replicate.run_incremental(store, source, lookback_micros=10_000_000)
    assert [d[0] for d in documents(store)] == [1, 2, 3, 4]


@pytest.mark.parametrize("name", ["q_keyset_page", "q_watermark_page", "q_row_compare", "q_incremental_range"])
def test_cursors_reach_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan" in pushed[: pushed.index("]")]
