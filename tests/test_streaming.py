import json

import pytest
from pyspark.sql import functions as F
from rows import record, table
from test_jobs import ROWS, Boom, documents, expected, fail_once, letters, unique_events

from tidemark.jobs import replicate
from tidemark.jobs.store import Store
from tidemark.schemas import RECORD
from tidemark.streaming import consumer
from tidemark.streaming.replicate import replicate_stream


def event(id, version=1, status="active", country="Norway", op="created", **over):
    data = {"status": status, "country": country}
    return json.dumps({"id": id, "version": version, "op": op, "data": data} | over)


def append(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.mode("append").text(path)


def consume(spark, raw, out, **options):
    parsed = consumer.parse_events(consumer.raw_event_stream(spark, raw, 2))
    consumer.consume(parsed, out, **options).awaitTermination()


def counted(spark, out):
    return {(r["dimension"], r["key"]): r["n"] for r in consumer.counters(spark, out).collect()}


def test_poison_reasons(spark):
    lines = ["{", "null", "5", '"x"', "[1]", event(None), event(1, None), '{"id":1,"version":1}', event(1), ""]
    parsed = consumer.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [r["poison"] for r in parsed.collect()]
    assert got == ["malformed"] * 5 + ["missing key", "missing key", "missing data", None, "malformed"]


def test_consumer_counts_each_change_once(spark, work):
    raw, out = work + "/raw", work + "/out"
    first = [event(i, 1, "active" if i % 2 else "") for i in range(20)]
    # One change makes up a third of all deliveries, in every file.
    append(spark, raw, first + [event(3)] * 25 + ["{", "null"])
    consume(spark, raw, out)
    # After a restart: repeats, new versions, a poison event whose key is good later.
    append(spark, raw, first[:10] + [event(3)] * 25 + [event(i, 2, op="updated") for i in range(5)])
    append(spark, raw, ['{"id":77,"version":1}', event(77)])
    consume(spark, raw, out)
    got = counted(spark, out)
    assert got[("total", "processed")] == 26
    assert got[("op", "created")] == 21 and got[("op", "updated")] == 5
    assert got[("status", "unknown")] == 10 and got[("country", "Norway")] == 26
    row = consumer.totals(spark, out).first()
    assert tuple(row) == (26, 20 + 25 + 10 + 25 + 5 + 1 - 26, 3)


def test_a_failed_micro_batch_is_counted_once(spark, work, monkeypatch):
    raw, out = work + "/raw", work + "/out"
    append(spark, raw, [event(i) for i in range(30)] + [event(1)] * 5)
    real, calls = consumer.event_counters, [0]

    def flaky(*args, **kwargs):
        calls[0] += 1
        if calls[0] == 1:
            raise Boom
        return real(*args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(consumer, "event_counters", flaky)
        with pytest.raises(Exception):
            consume(spark, raw, out)
    consume(spark, raw, out)
    assert counted(spark, out)[("total", "processed")] == 30
    assert consumer.totals(spark, out).first()["duplicates_skipped_total"] == 5


def write_changes(spark, work, rows):
    table(spark, rows).repartition(3).write.mode("append").parquet(work + "/in")
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(work + "/in")


@pytest.mark.parametrize("method", ["write_changes", "write_dead_letters", "commit"])
def test_stream_crash_between_sinks(spark, work, monkeypatch, method):
    store = Store.create(spark, work + "/s")
    changes = write_changes(spark, work, ROWS)
    with monkeypatch.context() as patch:
        fail_once(patch, method, 2, before=False)
        with pytest.raises(Exception):
            replicate_stream(changes, store, work + "/cp").awaitTermination()
    replicate_stream(changes, Store(spark, store.root), work + "/cp").awaitTermination()
    assert documents(store) == expected(ROWS)
    assert letters(store) == [(i, 1, "pending") for i in (3, 13, 23, 33)]
    assert len(unique_events(store)) == 40
    assert store.events().count() == 40


def test_a_new_checkpoint_skips_nothing(spark, work):
    store = Store.create(spark, work + "/s")
    changes = write_changes(spark, work, ROWS[:20])
    replicate_stream(changes, store, work + "/cp1").awaitTermination()
    changes = write_changes(spark, work, ROWS[20:])
    replicate_stream(changes, store, work + "/cp2").awaitTermination()
    assert documents(store) == expected(ROWS)
    assert len(unique_events(store)) == 40


def test_change_log_feeds_the_consumer(spark, work, monkeypatch):
    """An abandoned attempt is delivered again; the consumer counts it once."""
    store, out = Store.create(spark, work + "/s"), work + "/out"
    with monkeypatch.context() as patch:
        fail_once(patch, "commit", 1, before=True)
        with pytest.raises(Boom):
            replicate.run_backfill(store, lambda: table(spark, ROWS))
    replicate.run_backfill(store, lambda: table(spark, ROWS))
    replicate.run_incremental(store, lambda: table(spark, ROWS))
    fixed = [record(3, amount="1.00")] + [r for r in ROWS if r[0] != 3]
    assert replicate.run_replay(store, lambda: table(spark, fixed)) == 1
    events = consumer.change_log_stream(spark, store.root)
    run = consumer.consume(events, out)
    run.awaitTermination()
    # Two attempts of the backfill and the incremental run; the replay publishes nothing.
    assert sum(p["numInputRows"] for p in run.recentProgress) >= 120
    got = counted(spark, out)
    assert got[("total", "processed")] == 40
    assert got[("op", "deleted")] == sum(1 for r in ROWS if r[-1] is not None)


HOUR = 3600 * 1_000_000


def test_changes_are_forgotten_to_the_microsecond(spark, work):
    raw, out, now = work + "/raw", work + "/out", [10 * HOUR]

    def deliver(at, *lines):
        now[0] = at
        append(spark, raw, lines)
        consume(spark, raw, out, clock=lambda: now[0])
        return tuple(consumer.totals(spark, out).first())[:2]

    t0 = now[0]
    assert deliver(t0, event(1), event(2)) == (2, 0)
    assert deliver(t0 + 12 * HOUR, event(1), event(3)) == (3, 1)  # a repeat does not prolong
    assert deliver(t0 + 24 * HOUR - 1, event(1), event(2)) == (3, 3)
    assert deliver(t0 + 24 * HOUR, event(1)) == (4, 3)
    assert deliver(t0 + 24 * HOUR, event(2), event(1)) == (5, 4)
    assert deliver(t0 + 36 * HOUR - 1, event(3)) == (5, 5)
    assert deliver(t0 + 36 * HOUR, event(3), event(1)) == (6, 6)
    runs = consumer.manifest(spark, out).newest()[1]["runs"]["seen"]
    assert {r["generation"] for r in runs} == {(t0 + h * HOUR) // HOUR for h in (24, 36)}


def test_a_clock_that_runs_back_forgets_nothing(spark, work):
    raw, out, now = work + "/raw", work + "/out", [100 * HOUR]
    for at in (100, 50, 100, 123):
        now[0] = at * HOUR
        append(spark, raw, [event(1)])
        consume(spark, raw, out, clock=lambda: now[0])
    assert tuple(consumer.totals(spark, out).first()) == (1, 3, 0)


@pytest.mark.parametrize("step", ["write_run", "merged", "publish"])
@pytest.mark.parametrize("before", [True, False])
def test_a_crash_of_the_consumer_loses_and_doubles_nothing(spark, work, monkeypatch, step, before):
    raw, out = work + "/raw", work + "/out"
    append(spark, raw, [event(i) for i in range(8)])
    consume(spark, raw, out)
    append(spark, raw, [event(i) for i in range(4, 12)] + ["{"])
    real, calls = getattr(consumer.Manifest, step), [0]

    def flaky(self, *args, **kwargs):
        calls[0] += 1
        if calls[0] == 1 and before:
            raise Boom
        done = real(self, *args, **kwargs)
        if calls[0] == 1:
            raise Boom
        return done

    with monkeypatch.context() as patch:
        patch.setattr(consumer.Manifest, step, flaky)
        with pytest.raises(Exception):
            consume(spark, raw, out)
    consume(spark, raw, out)
    assert tuple(consumer.totals(spark, out).first()) == (12, 4, 1)
    assert counted(spark, out)[("op", "created")] == 12
    assert [tuple(r) for r in consumer.poison(spark, out).collect()] == [("{", "malformed")]


def test_totals_agree_at_every_moment_and_runs_stay_few(spark, work):
    raw, out = work + "/raw", work + "/out"
    for n in range(12):
        spark.createDataFrame([(event(i),) for i in (n, n, n + 1)] + [("{",)], "value string").coalesce(1).write.mode("append").text(raw)
    parsed = consumer.parse_events(consumer.raw_event_stream(spark, raw, 1))
    run, seen = consumer.consume(parsed, out), []
    while run.isActive:
        seen.append(tuple(consumer.totals(spark, out).first()))
    run.awaitTermination()
    seen.append(tuple(consumer.totals(spark, out).first()))
    assert len(set(seen)) > 5 and seen[-1] == (13, 23, 12)
    # Each file holds three good deliveries and a poison one.
    assert all(new + again == 3 * bad and min(new, again, bad) >= 0 for new, again, bad in seen)
    runs = consumer.manifest(spark, out).newest()[1]["runs"]
    assert all(len(of) <= 12 for of in runs.values())
    assert counted(spark, out)[("total", "processed")] == 13
    assert consumer.poison(spark, out).count() == 12


def test_a_hot_change_is_reduced_before_it_meets_the_seen_set(spark, work):
    events = spark.range(100_000, numPartitions=8).selectExpr("id % 2 AS id", "cast(1 AS int) AS version", "'created' AS op", "named_struct('status', 'active', 'country', 'Norway') AS data")
    events.write.parquet(work + "/in")
    stream = spark.readStream.schema(events.schema).parquet(work + "/in")
    sizes, real = [], consumer.Manifest.write_run

    def noted(self, table, rows, **marks):
        run = real(self, table, rows, **marks)
        sizes.append((table, run["n"]))
        return run

    consumer.Manifest.write_run = noted
    try:
        consumer.consume(stream, work + "/out").awaitTermination()
    finally:
        consumer.Manifest.write_run = real
    assert ("firsts", 2) in sizes and ("seen", 2) in sizes
    assert tuple(consumer.totals(spark, work + "/out").first()) == (2, 99_998, 0)
