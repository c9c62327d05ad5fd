"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark.jobs import replicate
from tidemark.jobs import store as st
from tidemark.jobs.search_index import SearchIndex
from tidemark.jobs.subscriptions import Subscriptions
from tidemark.operators import bulk, change, deadletter, dedupe, mutate, reconcile, report, routing
from tidemark.operators import search as find
from tidemark.operators import state
from tidemark.plans.inputs import (
    CURSOR_ID,
    CURSOR_MICROS,
    NOW_MICROS,
    PAGE_ROWS,
    Inputs,
)
from tidemark.session import shared_dir
from tidemark.sources import (
    after_cursor,
    bounded_range,
    high_water,
    keyset_page,
    watermark_page,
)
from tidemark.sources.cursor import WATERMARK
from tidemark.sources.numbering import with_page
from tidemark.sources.tables import parquet_table
from tidemark.streaming import consumer, rates
from tidemark.streaming.replicate import replicate_stream

CURSOR = (CURSOR_MICROS, CURSOR_ID)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its own name."""
    QUERIES["q_" + build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def _docs(t: Inputs) -> DataFrame:
    """Current documents of ``rec``."""
    rec = t.rec().withColumn("tags", fn.parse_tags(F.col("tags_literal")))
    return change.to_document(change.live_rows(change.accepted(change.judged(rec))))


def _hit_columns(docs: DataFrame) -> DataFrame:
    return docs.select("id", "name", "company", "country", "status", "amount", "version", "updated_at")


# -- scans ------------------------------------------------------------------------------


@query
def keyset_page_(t):
    return keyset_page(t.stored(), 1000, PAGE_ROWS).select("id", "version", "status", "amount")


@query
def watermark_page_(t):
    return watermark_page(t.stored(), CURSOR, PAGE_ROWS).select("id", "version", "updated_at")


@query
def row_compare(t):
    rec = t.stored()
    return rec.where(after_cursor(rec, WATERMARK, CURSOR)).select("id", "updated_at")


@query
def incremental_range(t):
    rec = t.stored()
    hi = high_water(rec)
    rows = bounded_range(rec, CURSOR, (hi["micros"], hi["id"]))
    return rows.select("id", "version", "status", "updated_at", change.op_kind().alias("op"))


@query
def incremental_initial(t):
    rec = t.rec()
    hi = high_water(rec)
    rows = bounded_range(rec, (None, 0), (hi["micros"], hi["id"]))
    return rows.select("id", "external_id", "version", "updated_at")


@query
def page_plan_(t):
    return t.plan()


@query
def backfill_resume(t):
    return replicate.pending_chunks(t.plan(), t.ledger(), key="page")


@query
def current_by_ids(t):
    keys = t.failures().select(F.col("source_record_id").alias("id")).distinct()
    rows = state.lookup(keys, t.repaired(), how="inner")
    return rows.select("id", "version", "status", "amount", "updated_at")


@query
def doc_lookup(t):
    lines = t.table("lineitem").select((F.col("l_orderkey") + 1).alias("id"))
    keys = lines.unionByName(t.sink_copy().select("id")).distinct()
    docs = _docs(t).select("id", "name", "amount", "version")
    return state.lookup(keys, docs).withColumn("found", F.col("version").isNotNull())


@query
def checkpoint_current(t):
    return st.checkpoints(t.full_ledger())


@query
def backfill_ledger(t):
    rows = st.checkpoints(t.full_ledger()).where(F.col("mode") == st.BACKFILL)
    return rows.select("mode", "last_id", "rows_processed", "batches")


@query
def incremental_ledger(t):
    rows = st.checkpoints(t.full_ledger()).where(F.col("mode") == st.INCREMENTAL)
    return rows.select("mode", "last_watermark_micros", "last_watermark_id", "rows_processed", "batches")


@query
def unnest_zip(t):
    arrays = {
        "address_part": F.split("email", "[.@]"),
        "tag": fn.parse_tags(F.col("tags_literal")),
        "name_part": F.split("name", "#"),
    }
    return fn.unzip_columns(t.rec(), arrays, ["id"], position="pos")


@query
def reference_pool(t):
    suppliers = t.table("supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    pool = bulk.reference_pool(suppliers, t.table("nation"), F.col("s_acctbal") >= 3000, "n_nationkey")
    return pool.select(F.col("s_name").alias("place"), F.col("n_name").alias("country"))


# -- state and sinks --------------------------------------------------------------------


@query
def latest_state(t):
    rows = state.latest_per_key(t.feed().drop("worker"))
    return rows.select("id", "version", "updated_at", "status", "amount", "deleted_at")


@query
def state_after_deletes(t):
    rows = state.live_state(t.feed().drop("worker"))
    return rows.select("id", "version", "updated_at", "status", "amount")


@query
def typed_state(t):
    rows = state.typed_state(t.feed().drop("worker"))
    return rows.select("id", "version", "updated_at", "status", F.col("amount_value").alias("amount"))


@query
def typed_accept(t):
    rows = change.accepted(change.judged(t.feed()))
    gone = F.col("deleted_at").isNotNull()
    amount = F.when(~gone, F.col("amount_value"))
    return rows.select("id", "version", "worker", gone.alias("is_delete"), amount.alias("amount"))


@query
def rejects(t):
    rows = change.rejected(change.judged(t.feed()))
    return rows.select("id", "version", "worker", F.col("reject_reason").alias("reason"))


@query
def event_log(t):
    events = change.to_event(
        t.rec(), F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"), ["status", "country", "amount"]
    )
    events = events.withColumn("worker", F.explode(F.array(F.lit("backfill"), F.lit("incremental"))))
    return events.select(
        "id",
        "external_id",
        "version",
        "op",
        "worker",
        routing.routing_key().alias("routing_key"),
        F.col("data.status").alias("data_status"),
        F.col("data.country").alias("data_country"),
        F.col("data.amount").alias("data_amount"),
        "emitted_at",
    )


@query
def op_classify(t):
    return t.rec().select("id", "version", change.op_kind().alias("op"))


@query
def doc_projection(t):
    rec = change.live_rows(t.rec()).withColumn("tags", fn.parse_tags(F.col("tags_literal")))
    return change.to_document(rec).withColumn("tags", fn.tags_literal(F.col("tags")))


@query
def route_fanout(t):
    bindings = {"all": "#", "removals": "record.deleted", "any_record": "record.*"}
    routed = routing.fan_out(t.ev(), bindings)
    return routed.groupBy("subscriber", "routing_key").agg(F.count(F.lit(1)).alias("n"))


@query
def apply_changes(t):
    rec = t.rec().select("id", "status", "amount", "version", "created_at", "updated_at", "deleted_at")
    return mutate.apply_changes(rec, t.changes(), ["status", "amount"])


@query
def change_counts(t):
    return mutate.change_counts(t.rec(), t.changes())


@query
def batch_outcomes(t):
    pages = with_page(change.judged(t.rec()).select("id", "reject_reason", "deleted_at"), PAGE_ROWS)
    return report.batch_outcomes(pages, ["page"])


# -- dead letters -----------------------------------------------------------------------


def _entry_columns(dlq: DataFrame) -> DataFrame:
    return dlq.select(
        "source_record_id",
        "sink",
        "external_id",
        "payload",
        "error",
        "attempt_count",
        "status",
        "first_failed_at",
        "last_failed_at",
    )


@query
def dlq_upsert(t):
    return _entry_columns(t.dlq())


@query
def dlq_attempts(t):
    rows = deadletter.attempts(t.failures())
    return rows.select("source_record_id", "sink", "mode", "failed_at", "attempt_no")


@query
def dlq_list(t):
    return _entry_columns(deadletter.list_entries(t.dlq()))


@query
def dlq_latest(t):
    return _entry_columns(deadletter.latest_entries(t.dlq(), 3))


@query
def dlq_replay_plan(t):
    return t.replay_plan().select("id", "sink", "outcome", "amount", "version")


@query
def dlq_replay_result(t):
    rows = change.judged(deadletter.replayable(t.replay_plan()))
    gone = F.col("deleted_at").isNotNull()
    op = F.when(gone, "delete").otherwise("index")
    return rows.select("id", op.alias("op"), F.when(~gone, F.col("amount_value")).alias("amount"), "version")


def _after_replay(t: Inputs) -> DataFrame:
    at = F.lit("2005-01-01 00:00:00").cast("timestamp_ntz")
    closed = deadletter.outcome_rows(t.replay_plan(), at, F.lit(3).cast("long"))
    return deadletter.entries(t.failures().drop("mode").unionByName(closed))


@query
def dlq_after_replay(t):
    return _entry_columns(_after_replay(t))


@query
def dlq_counts(t):
    return deadletter.counts_by_status(_after_replay(t))


@query
def dlq_autoresolve(t):
    return deadletter.auto_resolvable(t.replay_plan()).select("id", "sink", "amount", "version")


# -- events -----------------------------------------------------------------------------

RAW_EVENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("op", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [T.StructField("status", T.StringType()), T.StructField("country", T.StringType())]
            ),
        ),
    ]
)


def _first(t: Inputs) -> DataFrame:
    return dedupe.first_deliveries(t.deliveries(), ["delivery"])


@query
def union_feeds(t):
    feed = t.feed()
    return dedupe.union_feeds(
        feed.where(F.col("worker") == "backfill"), feed.where(F.col("worker") == "incremental")
    ).select("id", "version", "worker", "updated_at")


@query
def dedupe_events(t):
    return _first(t).select("event_id", "id", "version", "op", "status", "emitted_at", "delivery")


@query
def dedupe_new_only(t):
    feed = t.feed()
    stop = t.ledger().agg(F.max("last_id")).scalar()
    earlier = feed.where((F.col("worker") == "backfill") & (F.col("id") <= stop))
    batch = feed.where(F.col("worker") == "incremental")
    return dedupe.unseen(batch, earlier, ["updated_at"]).select("id", "version", "updated_at")


@query
def overlap_rows(t):
    feed = t.feed()
    stop = t.ledger().agg(F.max("last_id")).scalar()
    scanned = feed.where((F.col("worker") == "backfill") & (F.col("id") <= stop))
    return dedupe.overlap(feed.where(F.col("worker") == "incremental"), scanned)


@query
def delivery_rank(t):
    slots = [F.shiftright("delivery", 18)]
    rows = dedupe.ranked_deliveries(t.deliveries(), ["delivery"], slots)
    return rows.select("event_id", "id", "version", "delivery", "delivery_rank", "is_duplicate")


@query
def events_by_status(t):
    return report.events_by(_first(t), F.col("status"), "status")


@query
def events_by_op(t):
    return report.events_by(_first(t), F.col("op"), "op")


@query
def events_by_country(t):
    events = change.to_event(t.rec(), F.lit(None).cast("timestamp_ntz"), ["status", "country"])
    return report.events_by(events, F.col("data.country"), "country")


@query
def event_counters(t):
    return report.event_counters(_first(t), status=F.col("status"), op=F.col("op"))


def _parsed(t: Inputs) -> DataFrame:
    return consumer.parse_events(t.raw_events(), RAW_EVENT)


@query
def poison_events(t):
    bad = _parsed(t).where(F.col("poison").isNotNull())
    return bad.groupBy("value", "poison").agg(F.count(F.lit(1)).alias("n"))


@query
def consumer_totals(t):
    return report.consumer_totals(_parsed(t))


# -- search -----------------------------------------------------------------------------


@query
def search(t):
    hits = find.search(_docs(t), q="Customer BUILDING", status="active", country="NATION_3")
    return _hit_columns(hits)


@query
def search_text(t):
    docs = _docs(t)
    parts = [
        ("words", "000000042 000000107"),
        ("company", "BUILDING"),
        ("address", "customer#000000042.0@example.com"),
    ]
    found = [find.search(docs, q=q).select(F.lit(name).alias("asked"), "id") for name, q in parts]
    return dedupe.union_feeds(*found)


@query
def search_terms(t):
    return _hit_columns(find.search(_docs(t), status="pending", country="NATION_7"))


@query
def search_page(t):
    return _hit_columns(find.search_page(_docs(t), page=3, limit=25, status="active"))


@query
def search_keyset(t):
    return _hit_columns(find.search_after(_docs(t), CURSOR_MICROS, CURSOR_ID, 100, status="active"))


@query
def search_total(t):
    hits = find.search_total(_docs(t), status="active")
    return hits.withColumn("pages", fn.page_count(F.col("total"), 20))


def _index(t: Inputs) -> SearchIndex:
    index = SearchIndex(t.spark, shared_dir(t.spark, "search"))
    index.build(_docs(t), slice_rows=max(1, t.table("orders").count() // 16))
    return index


@query
def search_index_page(t):
    return _hit_columns(_index(t).page(page=3, limit=25, status="active"))


@query
def search_index_keyset(t):
    return _hit_columns(_index(t).after(CURSOR_MICROS, CURSOR_ID, 100, status="active"))


@query
def search_index_total(t):
    hits = _index(t).total(status="active")
    return hits.withColumn("pages", fn.page_count(F.col("total"), 20))


@query
def sample_live(t):
    return bulk.sample_rows(change.live_rows(t.rec()), 20, seed=7).select("id", "version", "status")


# -- reconciliation ---------------------------------------------------------------------


def _source(t: Inputs) -> DataFrame:
    return change.live_rows(t.rec()).select("id", "version")


@query
def reconcile_(t):
    return reconcile.reconcile(_source(t), t.sink_copy())


@query
def reconcile_summary(t):
    return reconcile.summary(reconcile.reconcile(_source(t), t.sink_copy()))


CONTENTS = ["version", "status", "amount", "updated_at"]


@query
def reconcile_digest(t):
    """Damage of contents, found by digests and joined for unlike leaves only."""
    source = change.live_rows(t.rec()).select("id", *CONTENTS)
    depth = reconcile.depth_for(t.table("orders").count())
    return reconcile.damage(source, t.sink_contents(), CONTENTS, depth)


@query
def missing_in_sink(t):
    return reconcile.missing_in_sink(_source(t), t.sink_copy())


@query
def extra_in_sink(t):
    return reconcile.extra_in_sink(_source(t), t.sink_copy())


@query
def duplicate_ids(t):
    return reconcile.duplicate_ids(t.feed().select("id"))


# -- report -----------------------------------------------------------------------------


@query
def live_count(t):
    return report.live_count(t.rec())


@query
def max_id(t):
    return report.max_id(t.rec())


@query
def backfill_progress(t):
    cursor = t.ledger().agg(F.max("last_id").alias("last_id"))
    row = report.one_row(cursor, report.max_id(t.rec()))
    return row.withColumn("progress_pct", report.progress_pct(F.col("last_id"), F.col("max_id")))


@query
def lag_seconds(t):
    return report.lag_seconds(t.rec(), CURSOR, NOW_MICROS)


@query
def throughput_30s(t):
    return report.throughput(t.samples())


@query
def rate_sliding(t):
    return report.sliding_rate(t.samples())


def _components(t: Inputs, sink: DataFrame) -> DataFrame:
    lost = reconcile.missing_in_sink(_source(t), sink).agg((F.count(F.lit(1)) == 0).alias("ok"))
    # A worker that reports samples is up.
    modes = t.samples().groupBy(F.col("mode").alias("component")).agg((F.count("n") > 0).alias("ok"))
    return lost.withColumn("component", F.lit("search")).unionByName(modes)


@query
def overall_health(t):
    damaged = report.overall_health(_components(t, t.sink_copy()))
    whole = report.overall_health(_components(t, _source(t)))
    return damaged.withColumn("sink", F.lit("damaged")).unionByName(whole.withColumn("sink", F.lit("whole")))


@query
def status_report(t):
    return report.status_report(
        records=t.rec(),
        checkpoints=st.checkpoints(t.full_ledger()),
        lag=report.lag_seconds(t.rec(), CURSOR, NOW_MICROS),
        totals=report.consumer_totals(_parsed(t)),
        dead_letters=t.dlq(),
        rates=report.throughput(t.samples()),
        components=_components(t, t.sink_copy()),
    )


# -- scalars ----------------------------------------------------------------------------


@query
def scalar_text(t):
    return t.rec().select(
        "id",
        fn.error_text(F.lit("mapper"), F.repeat("email", F.lit(80))).alias("error"),
        fn.or_unknown(F.regexp_replace("company", "^BUILDING$", "")).alias("company_or_unknown"),
        fn.composite_key(F.col("id"), F.col("version")).alias("change_key"),
        F.lower(F.concat("name", F.lit("@"), "city")).alias("address"),
        F.concat_ws(" ", fn.tokens(F.col("email"))).alias("words"),
    )


@query
def scalar_json(t):
    to_millis = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}
    text = F.to_json(F.struct("id", "external_id", "version", "status", "updated_at"), to_millis)
    rows = t.rec().select("id", text.alias("json"))
    back = F.from_json("json", "id long, external_id string, version int, status string")
    return rows.withColumn("_b", back).select(
        "id", "json", F.col("_b.external_id").alias("external_id"), F.col("_b.version").alias("version")
    )


@query
def scalar_array(t):
    tags = fn.parse_tags(F.col("tags_literal"))
    twice = F.concat(tags, tags)
    return t.rec().select(
        "id",
        F.size(tags).cast("long").alias("n_tags"),
        fn.tags_literal(tags).alias("literal"),
        fn.tags_literal(F.array_distinct(twice)).alias("distinct_literal"),
        F.get(tags, F.lit(0)).alias("first_tag"),
    )


@query
def scalar_num(t):
    value = fn.strict_double(F.col("amount"))
    return t.rec().select(
        "id",
        fn.is_strict_number(F.col("amount")).alias("numeric"),
        F.coalesce(value, F.lit(0.0)).alias("value"),
        fn.clamp(F.col("version"), F.lit(2), F.lit(3)).alias("clamped"),
        fn.to_fixed(F.coalesce(value, F.lit(0.0)), 1).alias("one_decimal"),
        fn.page_count(F.col("id"), 20).alias("pages"),
    )


@query
def scalar_time(t):
    ts = F.col("ts").cast("timestamp")
    return t.table("events").select(
        "event_id",
        fn.micros(F.col("ts")).alias("micros"),
        fn.micros(fn.truncate_millis(ts)).alias("millis_cut"),
        fn.iso_millis(ts).alias("iso"),
        fn.age_seconds(F.lit(1_706_745_600_000_000), F.col("ts")).alias("age_seconds"),
        F.col("props").isNotNull().alias("has_props"),
    )


# -- jobs and streams, end to end -------------------------------------------------------


def _state_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        "id",
        "email",
        "status",
        fn.tags_literal(F.col("tags")).alias("tags"),
        "amount",
        "version",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


def _written_source(t: Inputs) -> replicate.Source:
    """The source table as files sorted by id, so that a chunk reads its own row groups."""
    path = shared_dir(t.spark, "source")
    t.records().repartitionByRange("id").sortWithinPartitions("id").write.parquet(path)
    return lambda: parquet_table(t.spark, path)


@query
def backfill_job(t):
    """A whole backfill into a new store, read back as current documents."""
    source = _written_source(t)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    replicate.run_backfill(store, source)
    return _state_columns(store.state())


@query
def incremental_job(t):
    """Both workers over one store, compacted in between; every row arrives twice."""
    source = _written_source(t)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    replicate.run_backfill(store, source)
    store.compact(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    replicate.run_incremental(store, source)
    return _state_columns(store.state())


@query
def dead_letter_job(t):
    """Dead letters of both workers after a replay against the unchanged source."""
    source = _written_source(t)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    replicate.run_backfill(store, source)
    replicate.run_incremental(store, source)
    replicate.run_replay(store, source)
    return store.dead_letters().select(
        "source_record_id", "sink", "external_id", "error", "attempt_count", "status"
    )


@query
def subscription_backlog(t):
    """What subscribers receive of the events of both workers, the second after the first was acknowledged."""
    source = _written_source(t)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    subs = Subscriptions(store)
    for name, pattern in {"all": "#", "removals": "record.deleted", "any_record": "record.*"}.items():
        subs.subscribe(name, pattern)
    replicate.run_backfill(store, source)
    subs.publish()
    subs.acknowledge("all", subs.poll("all").upto)
    replicate.run_incremental(store, source)
    subs.publish()
    found = [subs.poll(name).events.withColumn("subscriber", F.lit(name)) for name in ("all", "removals", "any_record")]
    return dedupe.union_feeds(*found).groupBy("subscriber", "routing_key").agg(F.count(F.lit(1)).alias("n"))


@query
def store_lookup(t):
    """Documents of one nation and segment, by key from a compacted store."""
    source = _written_source(t)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    replicate.run_backfill(store, source)
    store.compact(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    keys = t.rec().where("country = 'NATION_3' AND company = 'BUILDING'").select("id")
    return _state_columns(store.lookup(keys))


@query
def run_outcomes(t):
    """What became of the rows of both workers, as their runs recorded it."""
    source = _written_source(t)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    replicate.run_backfill(store, source)
    replicate.run_incremental(store, source)
    return store.outcomes()


@query
def run_samples(t):
    """Rows in the samples of both workers' runs, and whether they give rates."""
    source = _written_source(t)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    chunk = -(-t.table("orders").count() // 3)
    replicate.run_backfill(store, source, chunk)
    replicate.run_incremental(store, source)
    rated = report.throughput(store.samples()).groupBy("mode").agg((F.max("rows_per_sec") > 0).alias("has_rate"))
    return store.samples().groupBy("mode").agg(F.sum("n").alias("n_rows")).join(rated, "mode")


@query
def rate_stream(t):
    """Sliding windows kept by a stream of samples."""
    path, out = shared_dir(t.spark, "samples"), shared_dir(t.spark, "rates")
    t.samples().write.parquet(path)
    samples = t.spark.readStream.schema(rates.SAMPLE).option("maxFilesPerTrigger", 64).parquet(path)
    rates.count_windows(samples, out, late="36500 days").awaitTermination()
    return rates.rates(t.spark, out)


@query
def replicate_stream_(t):
    """A stream of row changes into a store, read back as current documents."""
    path = shared_dir(t.spark, "changes")
    t.records().write.parquet(path)
    changes = t.spark.readStream.schema(replicate.RECORD).option("maxFilesPerTrigger", 64).parquet(path)
    store = st.Store.create(t.spark, shared_dir(t.spark, "store"))
    replicate_stream(changes, store, shared_dir(t.spark, "checkpoint")).awaitTermination()
    return _state_columns(store.state())


def _consumed(t: Inputs) -> str:
    """Stream all raw deliveries through the consumer; returns its output folder."""
    raw, out = shared_dir(t.spark, "raw"), shared_dir(t.spark, "consumer")
    t.raw_events().select("value").write.text(raw)
    parsed = consumer.parse_events(consumer.raw_event_stream(t.spark, raw, 64), RAW_EVENT)
    consumer.consume(parsed, out).awaitTermination()
    return out


@query
def consume_stream(t):
    """Counters of the streaming consumer over all deliveries."""
    return consumer.counters(t.spark, _consumed(t))


@query
def consume_stream_totals(t):
    return consumer.totals(t.spark, _consumed(t))


@query
def consume_stream_poison(t):
    """Poison deliveries as the streaming consumer set them aside."""
    return consumer.poison(t.spark, _consumed(t)).groupBy("value", "poison").agg(F.count(F.lit(1)).alias("n"))


# Trailing underscores only avoid clashes with imported names.
QUERIES = {name.rstrip("_"): run for name, run in QUERIES.items()}
