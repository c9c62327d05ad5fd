import random

from pyspark.sql import functions as F
from rows import at, record, table

from tidemark.functions import micros
from tidemark.sources import (
    after_cursor,
    bounded_range,
    clustered_copy,
    high_water,
    jdbc_options,
    keyset_page,
    numbered,
    page_plan,
    upto_cursor,
    watermark_page,
)
from tidemark.sources.cursor import WATERMARK
from tidemark.sources.numbering import id_buckets


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def to_micros(spark, when):
    return spark.createDataFrame([(when,)], "t timestamp").select(micros(F.col("t"))).first()[0]


def test_row_comparison_splits_every_table_in_two(spark):
    rows = [(a, b, c) for a in range(4) for b in range(4) for c in range(4)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    for cut in [(0, 0, 0), (1, 3, 2), (3, 3, 3), (-1, 9, 9)]:
        after = {tuple(r) for r in df.where(after_cursor(df, "abc", cut)).collect()}
        upto = {tuple(r) for r in df.where(upto_cursor(df, "abc", cut)).collect()}
        assert after == {r for r in rows if r > cut}
        assert upto == {r for r in rows if r <= cut}


def test_descending_cursor(spark):
    rows = [(a, b) for a in range(5) for b in range(5)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = {tuple(r) for r in df.where(after_cursor(df, "ab", (3, 2), descending=["a"])).collect()}
    assert got == {(a, b) for a, b in rows if (-a, b) > (-3, 2)}


def test_cursor_reaches_the_scan(spark, work):
    table(spark, [record(i, updated=i) for i in range(10)]).write.parquet(work + "/t")
    df = spark.read.parquet(work + "/t")
    plan = plan_text(df.where(after_cursor(df, WATERMARK, (to_micros(spark, at(3)), 2))))
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(updated_at" in pushed and "Or(GreaterThan(" in pushed
    ntz = df.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    ntz.write.parquet(work + "/n")
    df = spark.read.parquet(work + "/n")
    plan = plan_text(df.where(after_cursor(df, WATERMARK, (to_micros(spark, at(3)), 2))))
    assert "GreaterThanOrEqual(updated_at" in plan[plan.index("PushedFilters") :]


def test_pages_are_top_k(spark):
    df = table(spark, [record(i) for i in range(20)])
    plan = plan_text(keyset_page(df, 3, 5))
    assert "TakeOrderedAndProject" in plan
    assert [r["id"] for r in keyset_page(df, 3, 5).collect()] == [4, 5, 6, 7, 8]


def test_null_watermark_means_epoch(spark):
    df = table(spark, [record(i, updated=i) for i in range(5)])
    assert watermark_page(df, (None, 0), 10).count() == 5


def test_microsecond_cursor_does_not_repeat_rows(spark):
    df = table(spark, [record(i, updated=at(1, 123456 + i % 2)) for i in range(1, 9)])
    hi = high_water(df)
    assert bounded_range(df, (None, 0), (hi["micros"], hi["id"])).count() == 8
    assert df.where(after_cursor(df, WATERMARK, (hi["micros"], hi["id"]))).count() == 0
    # A cursor cut to milliseconds, as JSON would write it, keeps finding the same rows.
    assert df.where(after_cursor(df, WATERMARK, (hi["micros"] // 1000 * 1000, hi["id"]))).count() == 8


def test_ties_across_a_page_edge(spark):
    df = table(spark, [record(i, updated=7) for i in range(1, 12)])
    seen, cursor = [], (None, 0)
    while True:
        page = watermark_page(df, cursor, 4).select("id", micros(F.col("updated_at")).alias("m")).collect()
        if not page:
            break
        seen += [r["id"] for r in page]
        cursor = (page[-1]["m"], page[-1]["id"])
    assert seen == list(range(1, 12))


def test_lookback_reads_late_commits(spark):
    df = table(spark, [record(1, updated=5), record(2, updated=9), record(3, updated=20)])
    lo, hi = (to_micros(spark, at(10)), 5), (to_micros(spark, at(30)), 9)
    assert [r["id"] for r in bounded_range(df, lo, hi).collect()] == [3]
    late = bounded_range(df, lo, hi, lookback_micros=2_000_000).collect()
    assert sorted(r["id"] for r in late) == [2, 3]


def test_high_water_of_an_empty_table(spark):
    assert high_water(table(spark, [])) is None


def test_numbering_equals_a_global_window(spark):
    rng = random.Random(5)
    ids = sorted({rng.randrange(1, 1 << rng.choice([6, 19, 30, 41, 45])) for _ in range(900)})
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    got = numbered(df, ["id"], id_buckets()).orderBy("id").collect()
    assert [r["rank"] for r in got] == list(range(1, len(ids) + 1))
    assert [r["id"] for r in got] == ids


def test_numbering_per_key_with_one_key_holding_most_rows(spark):
    rng = random.Random(6)
    rows = [(rng.choice("aaaaaab"), i, rng.randrange(1000)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, id long, t long")
    got = numbered(df, ["t", "id"], [F.floor(F.col("t") / 50)], ["k"], "n").collect()
    for key in "ab":
        mine = sorted((t, i) for k, i, t in rows if k == key)
        assert sorted((r["n"], r["t"], r["id"]) for r in got if r["k"] == key) == [
            (n, t, i) for n, (t, i) in enumerate(mine, 1)
        ]


def test_page_plan_has_no_single_task_sort_of_rows(spark):
    df = spark.range(10)
    plan = plan_text(page_plan(df, 3))
    windows = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert windows and all("_b0" in line and "_b1" in line for line in windows)


def test_page_edges(spark):
    for n, pages in [(0, []), (500, [500]), (501, [500, 1])]:
        got = page_plan(spark.range(1, n + 1), 500).orderBy("page").collect()
        assert [r["n_rows"] for r in got] == pages


def test_clustered_copy_is_sorted_by_id(spark, work):
    rows = [record(i) for i in range(100)]
    random.Random(1).shuffle(rows)
    copy = clustered_copy(table(spark, rows).repartition(5), work + "/c")
    per_file = copy.groupBy(F.input_file_name()).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    spans = sorted((r["lo"], r["hi"]) for r in per_file.collect())
    assert copy.count() == 100
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_jdbc_options():
    got = jdbc_options("jdbc:x://h/d", "records", 1, 100, 8, user="u")
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "8" and got["user"] == "u"
