"""Rows per sliding window of a stream of samples, and progress of streams as samples.

Windows are aggregated in Spark's state under a watermark. Each micro-batch publishes the
windows it changed as a run; readers take the newest value of each window. So rates of windows
that are still open can be read, and a micro-batch that comes again leaves the same result.

The tasks that hold the state write what they changed; only as many are taken together as
make a file of ``FILE_ROWS`` windows, after the state was updated. So neither the state nor a
run ever passes one task, and a small micro-batch leaves one file.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.jobs.manifest import Manifest
from tidemark.operators.report import sliding_rate
from tidemark.operators.state import first_per_key
from tidemark.session import keep_state_on_disk
from tidemark.streaming.consumer import start

SAMPLE = T.StructType(
    [T.StructField("mode", T.StringType()), T.StructField("t_ms", T.LongType()), T.StructField("n", T.LongType())]
)
RATE = T.StructType(
    [
        T.StructField("mode", T.StringType()),
        T.StructField("window_start", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)
#: How far a sample may lie behind the newest one.
LATE = "10 minutes"
#: Windows of a run that make a file of their own.
FILE_ROWS = 1 << 18


def manifest(spark: SparkSession, out: str) -> Manifest:
    return Manifest(spark, f"{out}/manifest", f"{out}/runs")


def _newest(rates: DataFrame) -> DataFrame:
    return first_per_key(rates, ["mode", "window_start"], [F.desc("batch")])


def count_windows(samples: DataFrame, out: str, late: str = LATE, every: str | None = None) -> StreamingQuery:
    """Keep ``sliding_rate`` of a stream of ``(mode, t_ms, n)`` up to date below ``out``."""
    spark = samples.sparkSession
    book = manifest(spark, out)
    keep_state_on_disk(spark)

    def write(changed: DataFrame, number: int) -> None:
        # Kept before it is coalesced; else the tasks of the state would be coalesced with it.
        kept = changed.withColumn("batch", F.lit(number).cast("long")).persist(StorageLevel.DISK_ONLY)
        try:
            n = kept.count()
            if not n:
                return
            run = book.write_run("rates", kept.coalesce(-(-n // FILE_ROWS)))
        finally:
            kept.unpersist()

        def named(content: dict) -> dict:
            # A batch that comes again has the same windows under the same number.
            return {"rates": [*content.get("rates", []), run]}

        rates = book.step(named)["rates"]
        merged = book.merged("rates", rates, RATE, _newest)
        if merged != rates:
            book.step(lambda content: {"rates": merged})

    windows = sliding_rate(samples, late=late)
    return start(windows.writeStream.outputMode("update").foreachBatch(write), f"{out}/checkpoint", every)


def rates(spark: SparkSession, out: str) -> DataFrame:
    """Rows per mode and window so far."""
    book = manifest(spark, out)
    return _newest(book.read_runs(book.newest()[1].get("rates", []), RATE)).drop("batch")


class ProgressLog(StreamingQueryListener):
    """Samples of running streams, one per micro-batch with rows, under the query's name.

    ``spark.streams.addListener(log)`` starts it; ``samples`` gives the log as a table. It
    keeps the last ``kept`` samples: more than the trailing window of any rate needs.
    """

    def __init__(self, kept: int = 10_000):
        self._kept, self._rows, self._lock = kept, [], threading.Lock()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            began = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp()
            done = int(began * 1000) + int(p.durationMs.get("triggerExecution", 0))
            with self._lock:
                self._rows = [*self._rows[1 - self._kept :], (p.name or str(p.id), done, int(p.numInputRows))]

    def samples(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(list(self._rows), SAMPLE)
