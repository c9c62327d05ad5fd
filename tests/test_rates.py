"""Recorded samples, outcomes and lag of real runs; windows kept by a stream."""

import glob
import random

import pytest
from pyspark.sql import functions as F
from rows import record
from test_jobs import ROWS, Table, fresh

from tidemark.jobs import replicate
from tidemark.operators import report
from tidemark.streaming import rates
from tidemark.streaming.replicate import replicate_stream
from tidemark.schemas import RECORD


def test_a_run_records_its_samples(spark, work):
    store, source = fresh(spark, work), Table(spark, ROWS)
    replicate.run_backfill(store, source, chunk_rows=10)
    samples = store.samples().where("mode = 'backfill'").orderBy("t_ms").collect()
    assert [r["n"] for r in samples] == [10] * 4
    newest = report.throughput(store.samples()).where("mode = 'backfill'").orderBy(F.desc("t_ms")).first()
    seconds = max(1.0, (samples[-1]["t_ms"] - samples[0]["t_ms"]) / 1000)
    assert newest["n_samples"] == 4 and newest["rows_per_sec"] == pytest.approx(40 / seconds)
    rows = store.outcomes().orderBy("batch_id").collect()
    assert sum(r["n_rows"] for r in rows) == sum(r["published"] for r in rows) == 40
    assert sum(r["dead_lettered"] for r in rows) == 4 and sum(r["indexed"] for r in rows) == 36
    assert sum(r["deleted"] for r in rows) == sum(r[-1] is not None for r in ROWS)


def test_lag_of_a_real_run(spark, work):
    store, source = fresh(spark, work), Table(spark, [record(1, updated=0.0), record(2, updated=60.0)])
    at = 1_704_067_200_000_000 + 100_000_000  # 100 s after the first row
    assert store.lag(source(), at).first()[0] == 100.0
    replicate.run_incremental(store, source)
    assert store.lag(source(), at).first()[0] == 0.0
    source.rows.append(record(3, updated=70.0))
    assert store.lag(source(), at).first()[0] == 30.0


def write_samples(spark, path, rows):
    for row in rows:  # a file each
        spark.createDataFrame(row, rates.SAMPLE).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(rates.SAMPLE).option("maxFilesPerTrigger", 1).parquet(path)


def test_the_stream_has_what_the_batch_query_has(spark, work):
    rng = random.Random(6)
    rows = [(rng.choice(["backfill", "incremental"]), rng.randrange(120_000), rng.randint(1, 9)) for _ in range(30)]
    rng.shuffle(rows)
    write_samples(spark, work + "/in", [rows[i : i + 5] for i in range(0, 30, 5)])
    run = rates.count_windows(stream(spark, work + "/in"), work + "/out", late="5 minutes")
    run.awaitTermination()
    want = report.sliding_rate(spark.createDataFrame(rows, rates.SAMPLE)).collect()
    got = rates.rates(spark, work + "/out").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert sum(o["numRowsDroppedByWatermark"] for p in run.recentProgress for o in p["stateOperators"]) == 0
    assert len(rates.manifest(spark, work + "/out").newest()[1]["rates"]) <= 9


def run_files(spark, out):
    """Files and rows of each run, oldest first."""
    book = rates.manifest(spark, out)
    runs = book.newest()[1]["rates"]
    return [(len(glob.glob(f"{book.path(r['path'])}/*.parquet")), r["n"]) for r in runs]


def test_no_task_gets_all_state_or_all_windows_of_a_run(spark, work, monkeypatch):
    monkeypatch.setattr(rates, "FILE_ROWS", 50, raising=False)
    rows = [("backfill" if i % 2 else "incremental", i * 4_000, 1 + i) for i in range(600)] + [(None, None, 1)]
    write_samples(spark, work + "/in", [rows])
    run = rates.count_windows(stream(spark, work + "/in"), work + "/out")
    run.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(run.runId))]
    stages = [tracker.getStageInfo(s) for job in jobs for s in job.stageIds]
    state_tasks = run.recentProgress[0]["stateOperators"][0]["numShufflePartitions"]
    # The input is one file, so no stage but that of the state has more tasks than one.
    assert state_tasks == 3 and max(s.numTasks for s in stages) == state_tasks
    want = report.sliding_rate(spark.createDataFrame(rows, rates.SAMPLE)).collect()
    assert sorted(map(tuple, rates.rates(spark, work + "/out").collect())) == sorted(map(tuple, want))
    assert run_files(spark, work + "/out") == [(3, len(want))] and len(want) > 3 * 50


def test_a_small_micro_batch_leaves_one_file(spark, work):
    rows = [("backfill", i * 1_000, 1) for i in range(200)]
    write_samples(spark, work + "/in", [rows[i : i + 20] for i in range(0, 200, 20)])
    rates.count_windows(stream(spark, work + "/in"), work + "/out", late="1 hour").awaitTermination()
    # Eight runs were merged into the first.
    files = run_files(spark, work + "/out")
    assert len(files) == 3 and all(n <= 1 for n, _ in files)
    want = report.sliding_rate(spark.createDataFrame(rows, rates.SAMPLE)).collect()
    assert sorted(map(tuple, rates.rates(spark, work + "/out").collect())) == sorted(map(tuple, want))


def test_late_samples_are_dropped_and_counted(spark, work):
    minute = 60_000
    write_samples(spark, work + "/in", [[("backfill", 0, 1)], [("backfill", 60 * minute, 2)]])
    rates.count_windows(stream(spark, work + "/in"), work + "/out", late="10 minutes").awaitTermination()
    # Another 50 minutes late is out, 5 minutes late is in; closed windows keep their values.
    write_samples(spark, work + "/in", [[("backfill", 10 * minute, 100), ("backfill", 55 * minute, 4)]])
    run = rates.count_windows(stream(spark, work + "/in"), work + "/out", late="10 minutes")
    run.awaitTermination()
    assert sum(o["numRowsDroppedByWatermark"] for p in run.recentProgress for o in p["stateOperators"]) > 0
    kept = [("backfill", 0, 1), ("backfill", 60 * minute, 2), ("backfill", 55 * minute, 4)]
    want = report.sliding_rate(spark.createDataFrame(kept, rates.SAMPLE)).collect()
    assert sorted(map(tuple, rates.rates(spark, work + "/out").collect())) == sorted(map(tuple, want))


def test_progress_of_streams_gives_samples(spark, work):
    store, log = fresh(spark, work), rates.ProgressLog(kept=50)
    spark.createDataFrame(ROWS, RECORD).repartition(4).write.parquet(work + "/in")
    changes = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(work + "/in")
    spark.streams.addListener(log)
    try:
        replicate_stream(changes, store, work + "/cp").awaitTermination()
        spark._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        samples = log.samples(spark)
        rows = samples.collect()
    finally:
        spark.streams.removeListener(log)
    assert sum(r["n"] for r in rows) >= 40 and len(rows) >= 4
    assert report.throughput(samples).agg(F.max("total")).first()[0] >= 40
