import random

import pytest
from pyspark.sql import functions as F
from rows import at

from tidemark import functions as fn
from tidemark.operators import routing
from tidemark.operators.search import matches, search_after, search_page, text_match


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, value",
    [
        ("", None),
        (" 1.5 ", 1.5),
        ("1e3", 1000.0),
        ("0x10", None),
        ("1.0d", None),
        ("1.0f", None),
        ("NaN", None),
        ("Infinity", None),
        ("-inf", None),
        ("1_000", None),
        ("+1", 1.0),
        (".5", 0.5),
        ("5.", 5.0),
        (".", None),
        ("1e999", None),
        ("-1e999", None),
        ("N/A", None),
        ("-0.25E-2", -0.0025),
    ],
)
def test_strict_double(spark, text, value):
    assert one(spark, fn.strict_double(F.col("t")), t=text) == value


def test_error_text_is_cut(spark):
    got = one(spark, fn.error_text(F.lit("kind"), F.col("r")), r="x" * 5000)
    assert got.startswith("kind: x") and len(got) == 2000


@pytest.mark.parametrize("given, want", [("", "unknown"), (None, "unknown"), ("a", "a")])
def test_or_unknown(spark, given, want):
    assert one(spark, fn.or_unknown(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize("tags", [[], ["vip"], ["vip", "lead", "trial"]])
def test_tags_round_trip(spark, tags):
    df = spark.createDataFrame([(tags,)], "t array<string>")
    assert df.select(fn.parse_tags(fn.tags_literal(F.col("t")))).first()[0] == tags


def test_unzip_pads_short_arrays(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["a"])], "k int, a array<int>, b array<string>")
    rows = fn.unzip_columns(df, {"x": F.col("a"), "y": F.col("b")}, ["k"]).collect()
    assert [tuple(r) for r in rows] == [(1, 1, "a"), (1, 2, None), (1, 3, None)]


def test_micros_keep_what_json_loses(spark):
    df = spark.createDataFrame([(at(0, 123456),)], "t timestamp")
    row = df.select(
        fn.micros(F.col("t")).alias("m"),
        fn.micros(F.col("t").cast("timestamp_ntz")).alias("n"),
        fn.micros(fn.truncate_millis(F.col("t"))).alias("cut"),
        F.to_json(F.struct("t")).alias("j"),
    ).first()
    assert row["m"] == row["n"] and row["m"] % 1000 == 456
    assert row["cut"] == row["m"] - 456
    assert ".123Z" in row["j"]


def test_age_is_never_negative(spark):
    df = spark.createDataFrame([(at(10),)], "t timestamp")
    now = df.select(fn.micros(F.col("t"))).first()[0]
    ages = df.select(
        fn.age_seconds(F.lit(now - 5_000_000), F.col("t")), fn.age_seconds(F.lit(now + 1_250_000), F.col("t"))
    )
    assert tuple(ages.first()) == (0.0, 1.3)


@pytest.mark.parametrize("total, pages", [(0, 1), (1, 1), (20, 1), (21, 2), (400, 20)])
def test_page_count(spark, total, pages):
    assert one(spark, fn.page_count(F.col("n"), 20), n=total) == pages


@pytest.mark.parametrize(
    "pattern, key, takes",
    [
        ("#", "record.created", True),
        ("record.*", "record.created", True),
        ("record.*", "record.a.b", False),
        ("record.#", "record", True),
        ("record.#", "record.a.b", True),
        ("#.deleted", "record.deleted", True),
        ("#.deleted", "deleted", True),
        ("record.deleted", "record.updated", False),
        ("record.deleted", "recordXdeleted", False),
    ],
)
def test_bindings(spark, pattern, key, takes):
    assert one(spark, F.col("k").rlike(routing.binding_regex(pattern)), k=key) is takes


def test_subscribe_takes_an_event_once(spark):
    events = spark.createDataFrame([("created",), ("deleted",)], "op string")
    assert routing.subscribe(events, "#", "record.deleted").count() == 2
    assert routing.subscribe(events, "record.deleted").count() == 1


def test_search_clauses(spark):
    docs = spark.createDataFrame(
        [
            (1, "Ana Beridze", "ana@x.com", "Vector Labs", "active", "Georgia"),
            (2, "Luka Ana-Maria", "luka@x.com", "Acme", "pending", "Georgia"),
            (3, "Giorgi", "g@x.com", "ana", "active", "Norway"),
        ],
        "id long, name string, email string, company string, status string, country string",
    )

    def ids(**clauses):
        return sorted(r["id"] for r in docs.where(matches(**clauses)).collect())

    assert ids() == [1, 2, 3]
    assert ids(q="ana") == [1, 2, 3]
    assert ids(q="ANA") == [1, 2]  # words ignore case, the company does not
    assert ids(q="ana", status="active") == [1, 3]
    assert ids(q="Vector Labs") == [1]
    assert ids(q="Vector") == []
    assert ids(q="luka@x.com") == [2]
    assert ids(status="active", country="Norway") == [3]
    assert docs.where(text_match("  ")).count() == 0


def test_pages_have_the_size_asked_for(spark):
    docs = spark.range(20_000).selectExpr("id", "timestamp_micros(1) AS updated_at")
    assert [r["id"] for r in search_page(docs, page=2, limit=250).collect()] == list(range(250, 500))
    assert [r["id"] for r in search_page(docs, page=40, limit=500).collect()][-1] == 19_999
    assert search_after(docs, 1, 99, limit=250).count() == 250


def test_throughput_slices_agree_with_brute_force(spark):
    from tidemark.operators.report import throughput

    rng = random.Random(3)
    samples = [(rng.choice("ab"), rng.randrange(0, 2_000_000), rng.randrange(1, 9)) for _ in range(600)]
    samples += [("a", 599_999, 1), ("a", 600_000, 2), ("a", 600_000, 3), ("a", 570_000, 4), ("a", 629_999, 5)]
    got = {
        (r["mode"], r["t_ms"]): (r["n_samples"], r["total"], r["rows_per_sec"])
        for r in throughput(spark.createDataFrame(samples, "mode string, t_ms long, n long")).collect()
    }
    want = {}
    for mode, now, _ in samples:
        kept = [(t, n) for m, t, n in samples if m == mode and now - 30_000 <= t <= now]
        total, first = sum(n for _, n in kept), min(t for t, _ in kept)
        rate = 0.0 if len(kept) < 2 else total / max(1.0, (now - first) / 1000)
        want[(mode, now)] = (len(kept), total, rate)
    assert got == want
