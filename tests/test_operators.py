import random

from pyspark.sql import functions as F
from rows import at, record, table

from tidemark.functions import micros
from tidemark.operators import change, deadletter, dedupe, mutate, reconcile, report, state
from tidemark.schemas import DEAD_LETTER
from tidemark.sources import after_cursor


def as_dict(df, key="id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_state_ignores_order_and_repetition(spark):
    feed = [record(i, version=v, updated=v, status=f"s{v}") for i in range(20) for v in range(1, 4)]
    feed += [record(i, version=4, updated=4, deleted=True) for i in range(0, 20, 5)]
    want = as_dict(state.live_state(table(spark, feed)))
    assert len(want) == 16 and {r["status"] for r in want.values()} == {"s3"}
    rng = random.Random(2)
    for _ in range(3):
        mixed = feed + rng.sample(feed, 30)
        rng.shuffle(mixed)
        assert as_dict(state.live_state(table(spark, mixed).repartition(3))) == want


def test_late_old_version_does_not_revive(spark):
    feed = table(spark, [record(1, 2, 2, deleted=True), record(1, 1, 1), record(2, 2, 2), record(2, 1, 9)])
    got = as_dict(state.live_state(feed))
    assert list(got) == [2] and got[2]["version"] == 2


def test_rejected_newer_version_leaves_the_older(spark):
    feed = table(spark, [record(1, 1, 1, "5"), record(1, 2, 2, "N/A"), record(2, 1, 1, "N/A")])
    got = as_dict(state.typed_state(feed))
    assert list(got) == [1] and got[1]["version"] == 1


def test_deleted_rows_are_never_typed(spark):
    rows = change.judged(table(spark, [record(1, amount="N/A", deleted=True), record(2, amount=None)]))
    assert change.rejected(rows).count() == 0


def test_op_kinds(spark):
    df = table(spark, [record(1), record(2, version=2), record(3, version=3, deleted=True)])
    assert [r[0] for r in df.orderBy("id").select(change.op_kind()).collect()] == [
        "created",
        "updated",
        "deleted",
    ]


def test_document_has_no_deleted_at(spark):
    doc = change.to_document(table(spark, [record(1, amount=" 7 ")]))
    assert "deleted_at" not in doc.columns and doc.first()["amount"] == 7.0


def test_delivery_ranks(spark):
    rows = [(1, 1, d) for d in range(300_000, 300_005)] + [(1, 2, 1)]
    df = spark.createDataFrame(rows, "id long, version int, delivery long")
    got = dedupe.ranked_deliveries(df, ["delivery"], [F.shiftright("delivery", 18)])
    assert got.where("NOT is_duplicate").count() == 2
    assert sorted(r["delivery_rank"] for r in got.where("version = 1").collect()) == [1, 2, 3, 4, 5]


def letter(id, when, kind="failure", error="e", seq=1):
    return (id, f"ext-{id}", "search", f"p{when}", error, at(when), kind, seq)


def test_dead_letter_entries(spark):
    log = spark.createDataFrame(
        [
            letter(1, 1, error="first"),
            letter(1, 5, error="second"),
            letter(2, 1),
            letter(2, 3, "replayed", None),
            letter(3, 1),
            letter(3, 2, "replayed", None),
            letter(3, 4, error="again"),
            letter(4, 1),
            letter(4, 6, "bump", "sink down"),
            letter(5, 1),
            letter(5, 2, "resolved", None),
        ],
        DEAD_LETTER,
    )
    got = as_dict(deadletter.entries(log), "source_record_id")
    assert [got[i]["status"] for i in range(1, 6)] == [
        "pending",
        "replayed",
        "pending",
        "pending",
        "resolved",
    ]
    assert [got[i]["attempt_count"] for i in range(1, 6)] == [2, 1, 2, 2, 1]
    assert got[1]["error"] == "second" and got[1]["payload"] == "p5"
    assert got[1]["first_failed_at"] == at(1) and got[1]["last_failed_at"] == at(5)
    assert got[4]["error"] == "sink down" and got[4]["payload"] == "p1"
    assert got[4]["first_failed_at"] == at(1) and got[4]["last_failed_at"] == at(6)


def test_bump_rows_close_nothing(spark):
    log = spark.createDataFrame([letter(1, 1)], DEAD_LETTER)
    keys = log.select("source_record_id", "sink")
    bump = deadletter.bump_rows(keys, F.lit("x" * 3000), F.lit(at(9)), F.lit(2).cast("long"))
    dlq = deadletter.entries(log.unionByName(bump))
    row = dlq.first()
    # The log keeps the whole error; only a listing cuts it.
    assert row["status"] == "pending" and row["attempt_count"] == 2 and len(row["error"]) == 3000
    assert len(deadletter.list_entries(dlq).first()["error"]) == 2000
    assert row["external_id"] == "ext-1"


def test_replay_plan_outcomes(spark):
    log = spark.createDataFrame([letter(i, 1) for i in range(1, 6)], DEAD_LETTER)
    source = table(
        spark,
        [
            record(1, amount="1.00"),
            record(2, amount="N/A"),
            record(3, version=2, updated=9, deleted=True),
            record(5, version=2, updated=9),
            record(6),
        ],
    )
    plan = deadletter.replay_plan(deadletter.entries(log), source)
    got = {r["id"]: r["outcome"] for r in plan.collect()}
    assert got == {1: "ok", 2: "still_bad", 3: "tombstone", 4: "missing", 5: "ok"}
    assert [r["id"] for r in deadletter.auto_resolvable(plan).collect()] == [5]
    page = deadletter.list_entries(deadletter.entries(log), limit=2, offset=1)
    assert [r["source_record_id"] for r in page.collect()] == [4, 3]


CHANGE_ROW = "id long, seq long, kind string, changed_at timestamp, status string, amount string"


def test_apply_changes_equals_one_by_one(spark):
    rng = random.Random(9)
    rows = [record(i, version=1 + i % 3, deleted=i % 4 == 0) for i in range(1, 25)]
    changes, step = [], 0
    for _ in range(160):
        step += 1
        kind = rng.choice(["insert", "update", "update", "delete"])
        # One id takes a third of all changes.
        id = 7 if rng.random() < 0.33 else rng.randrange(1, 40)
        values = (rng.choice([None, "pending", "inactive"]), rng.choice([None, f"{step}.00"]))
        changes.append((id, step, kind, at(1000 + step), *values))
    names = table(spark, []).columns
    world = {r[0]: dict(zip(names, r)) for r in rows}
    counts = {"inserted": 0, "updated": 0, "deleted": 0}
    for id, _, kind, when, status, amount in changes:
        row = world.get(id)
        if kind == "insert" and row is None:
            row = dict.fromkeys(names) | {"id": id, "version": 1, "created_at": when, "updated_at": when}
            world[id] = row | {"status": status, "amount": amount}
            counts["inserted"] += 1
        elif kind != "insert" and row and row["deleted_at"] is None:
            row["version"] += 1
            row["updated_at"] = when
            if kind == "delete":
                row["deleted_at"] = when
                counts["deleted"] += 1
            else:
                counts["updated"] += 1
            if status is not None:
                row["status"] = status
            if amount is not None:
                row["amount"] = amount
    records, log = table(spark, rows), spark.createDataFrame(changes, CHANGE_ROW)
    assert as_dict(mutate.apply_changes(records, log, ["status", "amount"])) == world
    # The same with every id beyond 5 changes spread over salts.
    assert as_dict(mutate.apply_changes(records, log, ["status", "amount"], hot_rows=5)) == world
    assert mutate.change_counts(records, log).first().asDict() == counts


def test_unseen_counts_a_change_once(spark):
    shape = "id long, version int, n int"
    batch = spark.createDataFrame([(1, 1, 5), (1, 1, 4), (2, 1, 6), (2, 2, 7)], shape)
    earlier = spark.createDataFrame([(2, 1, 1), (2, 1, 2)], shape)
    got = dedupe.unseen(batch, earlier, ["n"]).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 4), (2, 2, 7)]
    assert [tuple(r) for r in dedupe.overlap(batch, earlier).collect()] == [(2, 1)]


def test_reconcile_classes(spark):
    shape = "id long, version int"
    source = spark.createDataFrame([(1, 1), (2, 2), (3, 1), (4, 1)], shape)
    sink = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (9, 1), (9, 1)], shape)
    got = {r["id"]: r["verdict"] for r in reconcile.reconcile(source, sink).collect()}
    assert got == {1: "equal", 2: "stale", 3: "ahead", 4: "missing", 9: "extra"}
    assert [tuple(r) for r in reconcile.duplicate_ids(sink).collect()] == [(9, 2)]
    assert [tuple(r) for r in reconcile.missing_in_sink(source, sink).collect()] == [(4, 1)]
    assert [tuple(r) for r in reconcile.extra_in_sink(source, sink).collect()] == [(9, 1)]


def test_progress_and_lag_edges(spark):
    rows = spark.createDataFrame([(0, 0), (50, 100), (120, 100), (1, 3)], "l long, m long")
    pct = [r[0] for r in rows.select(report.progress_pct(F.col("l"), F.col("m"))).collect()]
    assert pct == [0.0, 50.0, 100.0, 33.33]
    assert report.lag_seconds(table(spark, []), (None, 0), 10).first()["lag_seconds"] == 0.0
    assert report.max_id(table(spark, [])).first()["max_id"] == 0


def test_health_needs_every_component(spark):
    shape = "component string, ok boolean"
    assert report.overall_health(spark.createDataFrame([("a", True), ("b", True)], shape)).first()["ok"]
    assert not report.overall_health(spark.createDataFrame([("a", True), ("b", False)], shape)).first()["ok"]
    assert not report.overall_health(spark.createDataFrame([], shape)).first()["ok"]


def test_counters_match_single_groupings(spark):
    df = spark.createDataFrame([("a", "x"), ("a", ""), ("", None)], "status string, country string")
    got = {
        (r["dimension"], r["key"]): r["n"]
        for r in report.event_counters(df, status=F.col("status"), country=F.col("country")).collect()
    }
    assert got == {("status", "a"): 2, ("status", "unknown"): 1, ("country", "x"): 1, ("country", "unknown"): 2}


def test_wrong_rules_would_show(spark):
    """The fixtures tell right rules from nearby wrong ones."""
    feed = table(spark, [record(1, 2, 2, deleted=True), record(1, 1, 5), record(2, 1, 1), record(2, 2, 1)])
    right = state.live_state(feed)
    by_time = state.live_state(feed, order=("updated_at",))
    assert [r["id"] for r in right.collect()] == [2]
    assert sorted(r["id"] for r in by_time.collect()) == [1, 2]
    # Dropping deleted rows before picking the newest revives row 1.
    early = state.latest_per_key(change.live_rows(feed))
    assert sorted(r["id"] for r in early.collect()) == [1, 2]
    # A cursor without the id skips rows that share its timestamp.
    ties = table(spark, [record(i, updated=3) for i in range(1, 6)])
    seen = (micros_of(spark, 3), 2)
    assert ties.where(after_cursor(ties, ["updated_at"], seen[:1])).count() == 0
    assert ties.where(after_cursor(ties, ["updated_at", "id"], seen)).count() == 3


def micros_of(spark, seconds):
    return spark.createDataFrame([(at(seconds),)], "t timestamp").select(micros(F.col("t"))).first()[0]
