"""A stream of row changes into the store, both sinks moving together."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.jobs import store as st
from tidemark.jobs.replicate import Sink, write_batch
from tidemark.jobs.store import Store
from tidemark.streaming.consumer import QUERY_ID, start


def replicate_stream(
    changes: DataFrame,
    store: Store,
    checkpoint: str,
    sinks: Sequence[Sink] = (),
    every: str | None = None,
    look_again: float = 1.0,
) -> StreamingQuery:
    """Each micro-batch is one batch of the store; the stream commits after the ledger.

    A micro-batch that failed comes again under the same number and is written as a new
    attempt; one that reached the ledger before the crash is left alone. Numbers belong
    to a checkpoint, so the mode carries the id Spark keeps there: a stream started over
    with a new checkpoint delivers its rows again and skips nothing.

    Pausing the mode, or ``stream`` for all streams, holds the next micro-batch back: it
    waits, nothing of it is written, and it goes on after the operator resumes. The ledger
    is looked at every ``look_again`` seconds meanwhile; a stopped stream waits no longer.
    """

    def write(rows: DataFrame, number: int) -> None:
        batch_id = number + 1
        query_id = rows.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        mode = f"{st.STREAM}-{query_id}"
        while store.paused(st.STREAM, mode):
            if query_id not in {str(q.id) for q in store.spark.streams.active}:
                raise RuntimeError("stopped while paused")
            time.sleep(look_again)
        progress = store.progress(mode)
        if batch_id < progress.next_batch_id:
            return
        write_batch(store, store.plan(progress, mode, batch_id), rows, sinks)

    return start(changes.writeStream.foreachBatch(write), checkpoint, every)
