"""The store: an append-only change log, dead-letter log and ledger, plus state snapshots.

Layout below ``root``, plain parquet but for the manifest::

    changes/mode=M/batch_id=N/attempt=A/       every row of a batch, accepted or not
    dead_letters/mode=M/batch_id=N/attempt=A/  failures and replay outcomes
    runs/snapshots/<id>/                       state, bucketed and sorted by id
    runs/ledger/<id>/                          ledger rows of many steps
    manifest/<number>.json                     the newest names runs and says where modes stand

A batch is written once, as changes; the state, the event stream and the dead letters are
all read from that one copy. Every write goes to a folder of its own, so a retry or the
other worker never overwrites or deletes what somebody reads. Batch readers take the
attempts the ledger names; a half-written or abandoned attempt is invisible to them.
Streams see every attempt, which is at-least-once delivery; the consumer dedupes.

Every step of the ledger is a manifest entry. It carries on, per mode, what runs must know
(status, cursor, committed batches, open plan) and who works on which chunk, so ``progress``
and claims read one small file however long the history is. Snapshots are runs as well: a
compaction writes what changed since the last one, and merges runs when they get as large as
the one before, so that reading unites a few runs that are bucketed alike.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.jobs.manifest import GRACE, Lost, Manifest
from tidemark.operators import deadletter, report
from tidemark.operators.change import accepted, live_rows
from tidemark.operators.state import latest_per_key
from tidemark.schemas import BATCH_KEYS, CHANGE, DEAD_LETTER, LEDGER
from tidemark.session import pin_utc

# Run modes, worker states, who set a state, kinds of ledger rows.
BACKFILL, INCREMENTAL, REPLAY, STREAM = "backfill", "incremental", "replay", "stream"
IDLE, RUNNING, PAUSED, COMPLETED = "idle", "running", "paused", "completed"
OPERATOR, WORKER = "operator", "worker"
CHUNK, PLAN, COMMIT, STATUS, SNAPSHOT = "chunk", "plan", "commit", "status", "snapshot"

KEYS = [f.name for f in BATCH_KEYS]
# Where sessions note the snapshots they know; the files lie below the store's root.
DATABASE = "tidemark_snapshots"
# Newest wins: version, then its time, then the batch, as a repair may keep the version.
STATE_ORDER = ("version", "updated_at", "batch_seq")
STATE_COLUMNS = [c for c in CHANGE.names if c not in ("op", "reject_reason", "emitted_at")]


# Keys that are looked up one by one.
FEW = 1_000
# Ledger rows the manifest carries before they become a run, and runs of a level merged into one.
FOLD_EVERY = 16


def now_micros() -> int:
    return time.time_ns() // 1000


# Aggregates over the ledger rows of a mode, as SQL text: they run once per batch, and
# one text is quicker to build than a tree of columns.
STANDING = {
    "_command": f"max_by(status, at_micros) FILTER (WHERE kind = '{STATUS}' AND actor = '{OPERATOR}')",
    "_command_at": f"max(at_micros) FILTER (WHERE kind = '{STATUS}' AND actor = '{OPERATOR}')",
    "_worker": f"max_by(status, at_micros) FILTER (WHERE kind = '{STATUS}' AND actor = '{WORKER}')",
    "_worker_at": f"max(at_micros) FILTER (WHERE kind = '{STATUS}' AND actor = '{WORKER}')",
    "last_id": f"coalesce(max(last_id) FILTER (WHERE kind = '{COMMIT}'), 0L)",
    "_mark": "max(struct(hi_micros, hi_id)) "
    f"FILTER (WHERE kind = '{COMMIT}' AND hi_micros IS NOT NULL)",
    "rows_processed": f"coalesce(sum(n_rows) FILTER (WHERE kind = '{COMMIT}'), 0L)",
    "batches": f"count_if(kind = '{COMMIT}')",
}
STATUS_RULE = f"""
CASE WHEN _command = '{PAUSED}' THEN '{PAUSED}'
     WHEN _worker_at > coalesce(_command_at, 0) THEN _worker
     ELSE '{IDLE}' END"""


def _standing() -> list[Column]:
    return [F.expr(text).alias(name) for name, text in STANDING.items()]


def first_commits(ledger: DataFrame) -> DataFrame:
    """One commit per batch: the first, whatever a run thought dead commits later."""
    row = F.struct(*ledger.columns)
    commits = ledger.where(F.col("kind") == COMMIT).groupBy("mode", "batch_id")
    return commits.agg(F.min_by(row, F.struct("at_micros", "attempt")).alias("_c")).select("_c.*")


def settled(ledger: DataFrame) -> DataFrame:
    """The ledger with one commit per batch."""
    return ledger.where(~F.col("kind").eqNullSafe(COMMIT)).unionByName(first_commits(ledger))


def checkpoints(ledger: DataFrame) -> DataFrame:
    """One row per mode: status, cursors, rows and batches so far. All from one aggregate.

    An operator's pause holds until the operator resumes, whatever the worker reports
    meanwhile; after a resume the mode is idle until the worker reports again.
    """
    rows = settled(ledger.where(F.col("kind").isin(COMMIT, STATUS)))
    return rows.groupBy("mode").agg(*_standing()).select(
        "mode",
        F.expr(STATUS_RULE).alias("status"),
        "last_id",
        F.col("_mark.hi_micros").alias("last_watermark_micros"),
        F.coalesce("_mark.hi_id", F.lit(0).cast("long")).alias("last_watermark_id"),
        "rows_processed",
        "batches",
    )


@dataclass(frozen=True)
class Batch:
    """A planned batch. ``at_micros`` is fixed at the first try, so every attempt writes
    the same rows."""

    mode: str
    batch_id: int
    attempt: int
    at_micros: int
    lo_id: int | None = None
    last_id: int | None = None
    lo_micros: int | None = None
    hi_micros: int | None = None
    hi_id: int | None = None
    owner: str | None = None  # of the claim the batch is worked on under

    @property
    def folder(self) -> str:
        return f"mode={self.mode}/batch_id={self.batch_id}/attempt={self.attempt}"


PLANNED = ["batch_id", "attempt", "at_micros", "lo_id", "last_id", "lo_micros", "hi_micros", "hi_id"]


# -- where the modes stand, as the manifest carries it ----------------------------------
#
# Per mode: newest report of the worker and command of the operator, newest plan, highest
# position, and the committed batches as a number up to which all are and those beyond it.


def committed(standing: dict, batch_id: int) -> bool:
    return batch_id <= standing.get("upto", 0) or batch_id in standing.get("beyond", ())


def _with_commit(standing: dict, row: dict) -> dict:
    if committed(standing, row["batch_id"]):
        return standing  # the first commit counts
    upto, beyond = standing.get("upto", 0), sorted([*standing.get("beyond", ()), row["batch_id"]])
    if row["mode"] != BACKFILL:
        upto, beyond = beyond[-1], []  # these modes commit in order
    while beyond and beyond[0] == upto + 1:
        upto, beyond = beyond[0], beyond[1:]
    mark = standing.get("mark")
    if row.get("hi_micros") is not None:
        mark = max(mark or [], [row["hi_micros"], row["hi_id"]])
    return {**standing, "upto": upto, "beyond": beyond, "mark": mark}


def _with_row(standing: dict, row: dict) -> dict:
    if row["kind"] == COMMIT:
        return _with_commit(standing, row)
    if row["kind"] == PLAN:
        plan = [row.get(c) for c in PLANNED]
        return {**standing, "plan": max(standing.get("plan") or [0], plan, key=lambda p: p[:2])}
    if row["kind"] == STATUS:
        said = [row["at_micros"], row["status"]]
        return {**standing, row["actor"]: max(standing.get(row["actor"]) or said, said, key=lambda x: x[0])}
    return standing


def _status(standing: dict) -> str:
    """As ``STATUS_RULE`` has it."""
    command_at, command = standing.get(OPERATOR) or (0, None)
    worker_at, worker = standing.get(WORKER) or (0, None)
    if command == PAUSED:
        return PAUSED
    return worker if worker_at > command_at else IDLE


@dataclass(frozen=True)
class Progress:
    """What a run needs to know of its mode; ``open`` is planned but not committed."""

    status: str
    cursor: tuple[int | None, int]
    next_batch_id: int
    open: Batch | None
    newest_micros: int = 0


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = pin_utc(spark), root.rstrip("/")
        self.manifest = Manifest(spark, f"{self.root}/manifest", f"{self.root}/runs")

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> Store:
        """A new store; both scanning modes start idle."""
        store = cls(spark, root)
        store.append_ledger(*[store._status_row(m, IDLE) for m in (BACKFILL, INCREMENTAL)])
        return store

    # -- ledger ---------------------------------------------------------------------

    def append_ledger(self, *rows: dict, change: Callable[[dict], dict] = dict) -> None:
        """Append rows as one step: all of them become visible, or none.

        The rows lie in the manifest entry until there are enough for a run. ``change`` sees the
        content the step is made on and may alter other parts of it, or raise ``Lost``.
        """

        def with_rows(content: dict) -> dict:
            content = change(content)
            modes = dict(content.get("modes", {}))
            for row in rows:
                modes[row["mode"]] = _with_row(modes.get(row["mode"], {}), row)
            newest = max(content.get("newest", 0), *[row["at_micros"] for row in rows])
            slim = [{c: row[c] for c in LEDGER.names if row.get(c) is not None} for row in rows]
            return {**content, "modes": modes, "newest": newest, "tail": [*content.get("tail", []), *slim]}

        done = self.manifest.step(with_rows)
        if len(done["tail"]) >= FOLD_EVERY:
            self._write_tail(done["tail"])

    def _rows(self, tail: list[dict]) -> DataFrame:
        cells = F.from_json(F.lit(json.dumps(tail)), T.ArrayType(LEDGER))
        return self.spark.range(1, numPartitions=1).select(F.inline(cells))

    def _write_tail(self, tail: list[dict]) -> None:
        run = self.manifest.write_run("ledger", self._rows(tail))

        def as_run(content: dict) -> dict:
            if content["tail"][: len(tail)] != tail:
                raise Lost("written by another")
            return {**content, "tail": content["tail"][len(tail) :], "ledger": [*content.get("ledger", []), run]}

        self._named(as_run)

    def _named(self, change: Callable[[dict], dict]) -> bool:
        """Make a step that adds a ledger run, and fold a level that is full; False if it is Lost."""
        try:
            done = self.manifest.step(change)
        except Lost:
            return False
        levels = [r["level"] for r in done["ledger"]]
        full = [level for level in sorted(set(levels)) if levels.count(level) >= FOLD_EVERY]
        if full:
            self._fold([r for r in done["ledger"] if r["level"] == full[0]])
        return True

    def append_chunks(self, rows: DataFrame, planned: int) -> bool:
        """Append planned chunks, numbered from ``planned`` on; False if there are none, or if
        another run has planned meanwhile."""
        run = self.manifest.write_run("ledger", rows.coalesce(1))

        def next_chunks(content: dict) -> dict:
            if content.get("chunks", 0) != planned:
                raise Lost("chunks were planned by another run")
            return {**content, "chunks": planned + run["n"], "ledger": [*content.get("ledger", []), run]}

        if run["n"]:
            self._named(next_chunks)  # if that is lost there are chunks, if not these
        return run["n"] > 0

    def ledger(self) -> DataFrame:
        """A few rows per batch, whatever the size of the batches."""
        content = self.manifest.newest()[1]
        runs, tail = content.get("ledger", []), content.get("tail", [])
        if not runs:
            return self._rows(tail)
        rows = self.manifest.read_runs(runs, LEDGER)
        return rows.unionByName(self._rows(tail)) if tail else rows

    def fold(self) -> None:
        """Write the whole ledger as one run.

        Writers do so by themselves for every ``FOLD_EVERY`` rows and then runs of a level. Two
        folds at a time do no harm: the first to be named counts.
        """
        content = self.manifest.newest()[1]
        if content.get("tail"):
            self._write_tail(content["tail"])
        self._fold(self.manifest.newest()[1].get("ledger", []))

    def _fold(self, runs: list[dict]) -> None:
        level = max((r["level"] for r in runs), default=0) + 1
        whole = self.manifest.write_run("ledger", self.manifest.read_runs(runs, LEDGER).coalesce(1)) | {"level": level}
        paths = {r["path"] for r in runs}

        def folded(content: dict) -> dict:
            rest = [r for r in content.get("ledger", []) if r["path"] not in paths]
            if len(rest) + len(paths) != len(content.get("ledger", [])):
                raise Lost("folded by another")
            return {**content, "ledger": [whole, *rest]}

        try:
            self.manifest.step(folded)
        except Lost:
            pass

    def commits(self) -> DataFrame:
        return first_commits(self.ledger())

    def samples(self) -> DataFrame:
        """Throughput samples of all runs, for ``report.throughput`` and ``report.sliding_rate``."""
        return report.samples_of(self.commits())

    def outcomes(self) -> DataFrame:
        """Rows, indexed, dead-lettered, published and deleted per committed batch."""
        return report.outcomes_of(self.commits())

    def lag(self, records: DataFrame, at_micros: int | None = None) -> DataFrame:
        """Age of the oldest row that the incremental run has not committed."""
        return report.lag_seconds(records, self.progress(INCREMENTAL).cursor, at_micros or now_micros())

    def checkpoints(self) -> DataFrame:
        ledger, rows = self.ledger(), checkpoints(self.ledger())
        standing = self.manifest.newest()[1].get("modes", {}).get(BACKFILL, {})
        if not standing.get("beyond"):
            return rows
        # Chunks were committed out of order: the cursor stands before the first that was not.
        first = (F.col("kind") == CHUNK) & (F.col("batch_id") == standing["upto"] + 1)
        stop = ledger.where(first).agg(F.min("lo_id")).first()[0]
        last_id = F.when(F.col("mode") == BACKFILL, F.least("last_id", F.lit(stop))).otherwise(F.col("last_id"))
        return rows.withColumn("last_id", last_id)

    def progress(self, mode: str) -> Progress:
        """Where a mode stands, from the newest manifest entry alone."""
        content = self.manifest.newest()[1]
        standing = content.get("modes", {}).get(mode, {})
        top = max([standing.get("upto", 0), *standing.get("beyond", ())])
        plan = standing.get("plan")
        # Batches commit in order unless claimed, so only the last plan can be open.
        open_ = Batch(mode=mode, **dict(zip(PLANNED, plan))) if plan and not committed(standing, plan[0]) else None
        cursor = tuple(standing.get("mark") or (None, 0))
        return Progress(_status(standing), cursor, top + 1, open_, content.get("newest", 0))

    def _status_row(self, mode: str, status: str, actor: str = WORKER) -> dict:
        return {"mode": mode, "kind": STATUS, "status": status, "actor": actor, "at_micros": now_micros()}

    def set_status(self, mode: str, status: str) -> None:
        self.append_ledger(self._status_row(mode, status))

    def paused(self, *modes: str) -> bool:
        """Whether the operator holds any of the modes."""
        return any(self.progress(mode).status == PAUSED for mode in modes)

    def pause(self, mode: str) -> None:
        self.append_ledger(self._status_row(mode, PAUSED, OPERATOR))

    def resume(self, mode: str) -> None:
        self.append_ledger(self._status_row(mode, IDLE, OPERATOR))

    def plan(self, progress: Progress, mode: str, batch_id: int, **bounds: int | None) -> Batch:
        """Write down what a batch will cover before any of its rows are read.

        A batch planned before keeps its bounds and time and gets a new attempt.
        """
        open_ = progress.open
        if open_ is not None and open_.batch_id == batch_id:
            batch = replace(open_, attempt=open_.attempt + 1)
        else:
            # After everything in the ledger, whatever the clocks of its writers said.
            at = max(now_micros(), progress.newest_micros + 1)
            batch = Batch(mode, batch_id, 1, at, **bounds)
        report = [] if progress.status == RUNNING else [self._status_row(mode, RUNNING)]
        self.append_ledger({**vars(batch), "kind": PLAN}, *report)
        return batch

    def commit(self, batch: Batch, stats: dict[str, int]) -> None:
        """Make the batch visible. One worked on under a claim that another run has taken over
        is refused with ``Lost``."""
        row = {**vars(batch), **stats, "kind": COMMIT, "at_micros": now_micros()}
        self.append_ledger(row, change=lambda content: self._unclaimed(content, batch))

    # -- claims ---------------------------------------------------------------------

    @staticmethod
    def _claim_name(mode: str, batch_id: int) -> str:
        return f"{mode}/{batch_id}"

    def claim(self, chunk: Batch, owner: str, seconds: float) -> Batch | None:
        """Take a planned chunk for ``seconds``, or None if it is done or another run's.

        A claim that ran out can be taken over; the attempt number fences off the run that
        held it. The time of the batch stays that of its first claim, so that every attempt
        writes the same rows.
        """
        name, taken = self._claim_name(chunk.mode, chunk.batch_id), {}

        def take(content: dict) -> dict:
            held = content.get("claims", {}).get(name)
            if committed(content.get("modes", {}).get(chunk.mode, {}), chunk.batch_id):
                raise Lost("committed")
            if held and held["owner"] not in (None, owner) and held["until"] > time.time():
                raise Lost("another run's")
            newest = content.get("newest", 0)
            # After everything in the ledger, whatever the clocks of its writers said.
            at = held["at_micros"] if held else max(now_micros(), newest + 1)
            taken.update(attempt=held["attempt"] + 1 if held else 1, at_micros=at)
            claim = {**taken, "owner": owner, "until": time.time() + seconds}
            return {**content, "newest": max(newest, at), "claims": {**content.get("claims", {}), name: claim}}

        try:
            self.manifest.step(take)
        except Lost:
            return None
        batch = replace(chunk, owner=owner, **taken)
        standing = self.manifest.newest()[1].get("modes", {}).get(chunk.mode, {})
        report = [] if _status(standing) == RUNNING else [self._status_row(chunk.mode, RUNNING)]
        self.append_ledger({**vars(batch), "kind": PLAN}, *report)
        return batch

    def _unclaimed(self, content: dict, batch: Batch) -> dict:
        if batch.owner is None:
            return content
        claims, name = dict(content.get("claims", {})), self._claim_name(batch.mode, batch.batch_id)
        if claims.get(name, {}).get("attempt") != batch.attempt:
            raise Lost(f"{name} was taken over")
        del claims[name]
        return {**content, "claims": claims}

    def renew(self, owner: str, seconds: float) -> None:
        """Hold the claims of a run for ``seconds`` from now; 0 gives them up to whoever comes."""

        def longer(content: dict) -> dict:
            claims = dict(content.get("claims", {}))
            mine = [name for name, c in claims.items() if c["owner"] == owner]
            if not mine:
                raise Lost("nothing held")
            for name in mine:
                claims[name] = {**claims[name], "until": time.time() + seconds, "owner": owner if seconds else None}
            return {**content, "claims": claims}

        try:
            self.manifest.step(longer)
        except Lost:
            pass

    # -- logs -----------------------------------------------------------------------

    def write_changes(self, batch: Batch, rows: DataFrame) -> DataFrame:
        """Write the rows of a batch once and return the written copy.

        What follows reads the copy, so a source that changes meanwhile cannot make the
        sinks disagree.
        """
        path = f"{self.root}/changes/{batch.folder}"
        rows.select(*CHANGE.names).write.parquet(path)
        return self.spark.read.schema(CHANGE).parquet(path)

    def write_dead_letters(self, batch: Batch, rows: DataFrame) -> None:
        rows.select(*DEAD_LETTER.names).write.parquet(f"{self.root}/dead_letters/{batch.folder}")

    def _committed(self, log: str, schema: T.StructType, covered: dict[str, int]) -> DataFrame:
        """Rows of committed attempts, without batches a snapshot covers.

        The reader gets the folders of these attempts: one per batch since the snapshot.
        Covered folders are not even listed, and no join with the ledger is needed.
        """
        held = {"changes": F.col("n_rows") > 0, "dead_letters": F.coalesce("n_dead_letters", "n_rejected") > 0}
        fresh = [
            (F.col("mode") != mode) | (F.col("batch_id") > batch_id)
            for mode, batch_id in covered.items()
        ]
        wanted = self.commits().where(reduce(and_, fresh, held[log])).select(*KEYS).collect()
        whole = T.StructType(schema.fields + BATCH_KEYS)
        if not wanted:
            return self.spark.createDataFrame([], whole)
        path = f"{self.root}/{log}"
        folders = [f"{path}/mode={r.mode}/batch_id={r.batch_id}/attempt={r.attempt}" for r in wanted]
        return self.spark.read.schema(whole).option("basePath", path).parquet(*folders)

    def changes(self, covered: dict[str, int] | None = None) -> DataFrame:
        return self._committed("changes", CHANGE, covered or {})

    def dead_letter_log(self) -> DataFrame:
        return self._committed("dead_letters", DEAD_LETTER, {})

    def dead_letters(self) -> DataFrame:
        return deadletter.entries(self.dead_letter_log())

    def events(self) -> DataFrame:
        """Published events of committed batches. A replay repairs the state only."""
        return self.changes().where(F.col("mode") != REPLAY)

    # -- state ----------------------------------------------------------------------

    def _snapshot(self) -> dict:
        """Runs, covered batch per mode, and number of buckets of the newest snapshot."""
        return self.manifest.newest()[1].get("snapshot", {"runs": [], "covered": {}, "n_buckets": 0})

    def _table_name(self, path: str) -> str:
        return f"{DATABASE}.snapshot_" + hashlib.md5(f"{self.root}/{path}".encode()).hexdigest()

    def _bucketed_table(self, path: str, n_buckets: int) -> DataFrame:
        """The snapshot as a bucketed table; a new session learns of it here."""
        name = self._table_name(path)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
            fields = T.StructType([CHANGE[c] for c in STATE_COLUMNS]).toDDL()
            self.spark.sql(
                f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (id) SORTED BY (id) "
                f"INTO {n_buckets} BUCKETS LOCATION :path",
                args={"path": self.manifest.path(path)},
            )
        return self.spark.table(name)

    def _runs(self, snapshot: dict) -> list[DataFrame]:
        return [self._bucketed_table(r["path"], snapshot["n_buckets"]) for r in snapshot["runs"]]

    def _fresh(self, covered: dict[str, int]) -> DataFrame:
        """Newest accepted row per id of the log since a snapshot."""
        return latest_per_key(accepted(self.changes(covered)).select(*STATE_COLUMNS), STATE_ORDER)

    def _merged(self) -> DataFrame:
        """Newest accepted row per id, tombstones included.

        Only the log since the snapshot is shuffled: it is reduced, brought to the
        snapshot's buckets, and the union keeps that partitioning for the last aggregate.
        """
        snapshot = self._snapshot()
        fresh = self._fresh(snapshot["covered"])
        if not snapshot["runs"]:
            return fresh
        return self._newest_of([*self._runs(snapshot), fresh.repartition(snapshot["n_buckets"], "id")])

    @staticmethod
    def _newest_of(parts: list[DataFrame]) -> DataFrame:
        """Newest row per id of parts that are bucketed alike.

        The condition holds for every row. It makes the parts rows: a union whose parts are all
        columnar scans claims their partitioning and does not keep it (Spark 4.1).
        """
        rows = [p.where(F.col("batch_seq").isNotNull()) for p in parts]
        return latest_per_key(reduce(DataFrame.unionByName, rows), STATE_ORDER)

    def state(self) -> DataFrame:
        """Current documents: latest accepted rows that are not deleted."""
        return live_rows(self._merged()).withColumn("amount", F.col("amount_value")).drop(
            "amount_value", "deleted_at"
        )

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The current documents of a set of unique ``keys`` (column ``id``).

        Up to ``FEW`` keys are looked up: they are put into the query, which opens only the
        buckets they fall into, and in these the row groups that their bloom filters and ranges
        let through. More keys are brought to the buckets and joined there, without a shuffle of
        the snapshot.
        """
        few = keys.select("id").limit(FEW + 1).collect()
        if len(few) <= FEW:
            return self.state().where(F.col("id").isin([r["id"] for r in few]))
        n_buckets = self._snapshot()["n_buckets"]
        wanted = keys.select("id").repartition(n_buckets, "id") if n_buckets else keys.select("id")
        return self.state().join(wanted, "id", "left_semi")

    def compact(self, n_buckets: int) -> None:
        """Bring the snapshot up to date, published with one step of the ledger.

        What changed since the last one is written as a run of its own. While a run is at
        least half as large as the one before it, the two are merged, bucket by bucket: so
        there are at most log(rows) runs, and what is written follows the changes. Tombstones
        stay: without them an old version delivered late would revive its row.
        """
        # Read before the log is: what is committed in between is merged now and again next
        # time, never skipped.
        content = self.manifest.newest()[1]
        covered = {mode: m["upto"] for mode, m in content.get("modes", {}).items() if m.get("upto")}
        old = content.get("snapshot", {"runs": [], "covered": {}, "n_buckets": 0})
        if not covered:
            return
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        if old["n_buckets"] in (0, n_buckets):
            runs = [*old["runs"], self._bucketed_run(self._fresh(old["covered"]), n_buckets)]
        else:
            runs = [self._bucketed_run(self._merged(), n_buckets)]
        while len(runs) > 1 and 2 * runs[-1]["n"] >= runs[-2]["n"]:
            tables = [self._bucketed_table(r["path"], n_buckets) for r in runs[-2:]]
            runs = [*runs[:-2], self._bucketed_run(self._newest_of(tables), n_buckets)]
        runs = [r for r in runs if r["n"]]
        snapshot = {"runs": runs, "covered": covered, "n_buckets": n_buckets}

        def published(content: dict) -> dict:
            if content.get("snapshot", old) != old:
                raise Lost("another compaction was faster")
            return {**content, "snapshot": snapshot}

        path = runs[-1]["path"] if runs else None
        common = {"kind": SNAPSHOT, "path": path, "n_buckets": n_buckets, "at_micros": now_micros()}
        try:
            self.append_ledger(*[{**common, "mode": m, "batch_id": b} for m, b in covered.items()], change=published)
        except Lost:
            pass

    def _bucketed_run(self, rows: DataFrame, n_buckets: int) -> dict:
        seen, name = Observation(), self.manifest.new_run("snapshots")
        state = rows.select(*STATE_COLUMNS).repartition(n_buckets, "id").observe(seen, F.count(F.lit(1)).alias("n"))
        (
            state.write.format("parquet")
            .bucketBy(n_buckets, "id")
            .sortBy("id")
            .option("path", self.manifest.path(name))
            .option("parquet.bloom.filter.enabled#id", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .saveAsTable(self._table_name(name))
        )
        return {"path": name, "n": seen.get["n"]}

    def vacuum(self, grace: float = GRACE) -> int:
        """Remove ledger and snapshot runs that nothing needs any more; returns how many.

        Readers that take longer than ``grace`` seconds hold ``store.manifest.lease(...)``.
        """
        return self.manifest.vacuum(grace)
