"""The event consumer: parse, set poison aside, drop repeated deliveries, count.

One query does all of it. A micro-batch is written once, parsed; poison stays where it was
written, the other deliveries are reduced to one row per change and held against the changes
seen within the time to live. The new ones are written as a run of the seen-set, their counts
as a run of the counters, and one manifest entry names everything and carries the totals. So
whatever is read, at any moment, belongs to the same deliveries; a batch that dies on the way
leaves nothing, and one that comes again after its entry changes nothing.

The seen-set is a wheel of generations, one per ``TICKS``-th of the time to live: a run belongs
to the generation of its arrival, runs are merged within a generation, and a run drops out of
the manifest as soon as its last change has expired.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.jobs.manifest import Manifest
from tidemark.jobs.store import now_micros
from tidemark.operators.change import op_kind
from tidemark.operators.dedupe import CHANGE_KEY
from tidemark.operators.report import event_counters
from tidemark.schemas import BATCH_KEYS, CHANGE, EVENT, RECORD

# Fixed value: how long a change is remembered after its first delivery.
TTL_MICROS = 24 * 3600 * 1_000_000
# Where Spark tells a micro-batch which query, that is which checkpoint, it belongs to.
QUERY_ID = "sql.streaming.queryId"
#: Generations of the seen-set within the time to live.
TICKS = 24
COUNTERS = T.StructType(
    [
        T.StructField("dimension", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
POISON = T.StructType([T.StructField("value", T.StringType()), T.StructField("poison", T.StringType())])
CHANGES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("version", T.IntegerType())]
    + [T.StructField(name, T.StringType()) for name in ("op", "status", "country")]
)
SEEN = T.StructType([*CHANGES.fields[:2], T.StructField("arrived", T.LongType())])
TOTALS = ("processed_total", "duplicates_skipped_total", "errors_total")


def start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """Poll at an interval, or work off what is there and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def change_log_stream(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """Events as the store's change log delivers them, every attempt included."""
    rows = (
        spark.readStream.schema(T.StructType(CHANGE.fields + BATCH_KEYS))
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{root}/changes")
    )
    published = rows.where(F.col("op").isNotNull())
    data = F.struct(*RECORD.names).alias("data")
    return published.select("id", "external_id", "version", op_kind().alias("op"), data, "emitted_at")


def raw_event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """One JSON text per line, column ``value``."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def _ids_as_text(schema: T.StructType) -> T.StructType:
    def kind(f: T.StructField) -> T.DataType:
        if isinstance(f.dataType, T.StructType):
            return _ids_as_text(f.dataType)
        return T.StringType() if f.name == "id" else f.dataType

    return T.StructType([T.StructField(f.name, kind(f)) for f in schema.fields])


def _with_long_ids(event: Column, schema: T.StructType) -> Column:
    def field(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StructType):
            return _with_long_ids(event[f.name], f.dataType).alias(f.name)
        return (event[f.name].try_cast("long") if f.name == "id" else event[f.name]).alias(f.name)

    return F.when(event.isNotNull(), F.struct(*[field(f) for f in schema.fields]))


def parse_events(raw: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """JSON texts as events plus ``poison``: NULL, or why the event cannot be counted.

    Poison is found before deduping, so a bad delivery never claims the key of a good one.
    Ids may be JSON numbers or JSON texts; both are read as text and cast.
    """
    with_corrupt = T.StructType(_ids_as_text(schema).fields + [T.StructField("_corrupt_record", T.StringType())])
    event = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE"})
    parsed = raw.withColumn("_t", event).withColumn("_e", _with_long_ids(F.col("_t"), schema))
    bad_id = F.col("_t.id").isNotNull() & F.col("_e.id").isNull()
    poison = (
        F.when(F.col("_t").isNull() | F.col("_t._corrupt_record").isNotNull() | bad_id, "malformed")
        .when(F.col("_e.id").isNull() | F.col("_e.version").isNull(), "missing key")
        .when(F.col("_e.data").isNull(), "missing data")
    )
    return parsed.select("value", *[F.col("_e")[f].alias(f) for f in schema.names], poison.alias("poison"))


def manifest(spark: SparkSession, out: str) -> Manifest:
    return Manifest(spark, f"{out}/manifest", f"{out}/runs")


def _slim(deliveries: DataFrame) -> DataFrame:
    """What is kept of a delivery: poison as it came, of the others key and counted fields."""
    for name in ("value", "poison"):
        if name not in deliveries.columns:
            deliveries = deliveries.withColumn(name, F.lit(None).cast("string"))
    bad = F.col("poison").isNotNull()
    fields = {"op": F.col("op"), "status": F.col("data.status"), "country": F.col("data.country")}
    return deliveries.select(
        F.when(bad, F.col("value")).alias("value"),
        "poison",
        *[F.when(~bad, F.col(c)).alias(c) for c in CHANGE_KEY],
        *[F.when(~bad, c).alias(name) for name, c in fields.items()],
        F.when(bad, "poison").otherwise("valid").alias("part"),
    )


def _new_changes(book: Manifest, firsts: DataFrame, seen: list[dict], since: int) -> DataFrame:
    """The changes of ``firsts`` that were not first delivered after ``since``.

    The seen-set is cut down to the changes at hand before the two meet. ``firsts`` is a
    written table of known size, so the planner sends it to the seen-set if it is small; only
    a batch too large for that shuffles both.
    """
    known = book.read_runs(seen, SEEN).where(F.col("arrived") > since)
    again = known.join(firsts.select(*CHANGE_KEY), list(CHANGE_KEY), "left_semi").select(*CHANGE_KEY)
    return firsts.join(again, list(CHANGE_KEY), "left_anti")


def consume(
    deliveries: DataFrame,
    out: str,
    every: str | None = None,
    ttl_micros: int = TTL_MICROS,
    clock: Callable[[], int] = now_micros,
) -> StreamingQuery:
    """Count every change once within ``ttl_micros`` of its first delivery; set poison aside.

    ``deliveries`` are parsed events, with ``poison`` and ``value`` if there may be poison. The
    clock is arrival, not event time: no delivery is ever late. A repeat does not prolong what
    is remembered; one that comes after the time to live counts again, and starts anew. One
    change may make up any share of the deliveries: each task passes on one row of it.
    """
    spark = deliveries.sparkSession
    book = manifest(spark, out)

    def write(batch: DataFrame, number: int) -> None:
        entry, content = book.newest()
        query = spark.sparkContext.getLocalProperty(QUERY_ID)
        if content.get("query") == query and content["batch"] >= number:
            return  # published before the stream could note it
        now = max(clock(), content.get("at", 0))
        since, tick = now - ttl_micros, max(ttl_micros // TICKS, 1)
        runs = content.get("runs", {"seen": [], "counters": [], "poison": []})

        counts = Observation()
        poison = F.col("part") == "poison"
        name = book.new_run("deliveries")
        slim = _slim(batch).observe(counts, F.count_if(~poison).alias("valid"), F.count_if(poison).alias("poison"))
        slim.write.partitionBy("part").parquet(book.path(name))
        n_valid, n_poison = counts.get["valid"], counts.get["poison"]

        seen = [r for r in runs["seen"] if r["newest"] > since]
        counters, aside = runs["counters"], runs["poison"]
        n_new = 0
        if n_valid:
            valid = spark.read.schema(CHANGES).parquet(f"{book.path(name)}/part=valid")
            fields = F.struct(*CHANGES.names[2:])
            once = valid.groupBy(*CHANGE_KEY).agg(F.min(fields).alias("_f")).select(*CHANGE_KEY, "_f.*")
            firsts = book.write_run("firsts", once)
            new = book.read_runs([firsts], CHANGES)
            if seen:
                firsts = book.write_run("firsts", _new_changes(book, new, seen, since))
                new = book.read_runs([firsts], CHANGES)
            n_new = firsts["n"]
        if n_new:
            marks = {"generation": now // tick, "newest": now}
            arrived = new.select(*CHANGE_KEY, F.lit(now).cast("long").alias("arrived"))
            seen = [*seen, book.write_run("seen", arrived.sortWithinPartitions(*CHANGE_KEY), **marks)]
            seen = book.merged("seen", seen, SEEN, lambda rows: rows.repartitionByRange(*CHANGE_KEY).sortWithinPartitions(*CHANGE_KEY), "generation")
            tallies = event_counters(
                new, total=F.lit("processed"), status=F.col("status"), country=F.col("country"), op=F.col("op")
            )
            counters = book.merged("counters", [*counters, book.write_run("counters", tallies.coalesce(1))], COUNTERS, _added)
        if n_poison:
            run = {"path": f"{name}/part=poison", "level": 0, "n": n_poison}
            aside = book.merged("poison", [*aside, run], POISON, lambda rows: rows.hint("rebalance"))
        past = content.get("totals", [0, 0, 0])
        totals = [past[0] + n_new, past[1] + n_valid - n_new, past[2] + n_poison]
        runs = {"seen": seen, "counters": counters, "poison": aside}
        if not book.publish(entry + 1, {"query": query, "batch": number, "at": now, "runs": runs, "totals": totals}):
            raise RuntimeError(f"another query consumes into {out}")

    return start(deliveries.writeStream.foreachBatch(write), f"{out}/checkpoints/consumer", every)


def _added(counters: DataFrame) -> DataFrame:
    """Counters of several runs as one; a few keys, as one file."""
    return counters.groupBy("dimension", "key").agg(F.sum("n").alias("n")).coalesce(1)


def counters(spark: SparkSession, out: str) -> DataFrame:
    """Counters so far: the sum of the counter runs, whose number grows with the logarithm
    of the number of micro-batches."""
    book = manifest(spark, out)
    runs = book.newest()[1].get("runs", {})
    return book.read_runs(runs.get("counters", []), COUNTERS).groupBy("dimension", "key").agg(F.sum("n").alias("n"))


def poison(spark: SparkSession, out: str) -> DataFrame:
    """Poison deliveries so far, as they came, and why they were not counted."""
    book = manifest(spark, out)
    return book.read_runs(book.newest()[1].get("runs", {}).get("poison", []), POISON)


def totals(spark: SparkSession, out: str) -> DataFrame:
    """Processed, skipped and poison events so far, as one row, all of the same deliveries."""
    row = manifest(spark, out).newest()[1].get("totals", [0, 0, 0])
    return spark.createDataFrame([tuple(row)], ", ".join(f"{name} long" for name in TOTALS))
