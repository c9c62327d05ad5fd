"""Sliced search and keyed lookup: the same answers, from few slices and buckets."""

import random

import pytest
from pyspark.sql import functions as F
from rows import record
from test_jobs import Table, documents, fresh

from tidemark.functions.times import micros
from tidemark.jobs import replicate
from tidemark.jobs import store as st
from tidemark.jobs.search_index import SearchIndex
from tidemark.operators import search as find

SCHEMA = "id long, name string, email string, company string, country string, status string, updated_at timestamp, amount double"


def docs(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = 1_700_000_000 + rng.randrange(n // 3)  # many ties
        status, country = rng.choice(["active", "inactive", None]), rng.choice(["Norway", "Peru"])
        rows.append((i, rng.choice(["Ann Lee", "Bo Ek"]), f"n{i}@example.com", rng.choice(["Acme", "Umbrella"]), country, status, at, 1.0))
    wide = spark.createDataFrame(rows, SCHEMA.replace("updated_at timestamp", "updated_at long"))
    return wide.withColumn("updated_at", F.timestamp_seconds("updated_at")).repartition(4)


def ids(df):
    return [r["id"] for r in df.collect()]


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    table = docs(spark)
    path = str(tmp_path_factory.mktemp("docs"))
    table.write.parquet(path + "/docs")
    table = spark.read.parquet(path + "/docs")
    index = SearchIndex(spark, path + "/index")
    index.build(table, slice_rows=20)
    return table, index


CLAUSES = [{}, {"status": "active"}, {"status": "active", "country": "Peru"}, {"q": "lee"}, {"q": "Acme", "status": "inactive"}, {"q": "n7@example.com"}, {"country": "Nowhere"}]


@pytest.mark.parametrize("clauses", CLAUSES)
def test_pages_and_totals_are_those_of_a_scan(both, clauses):
    table, index = both
    for page in (1, 7, 40):
        assert ids(index.page(page, 9, **clauses)) == ids(find.search_page(table, page, 9, **clauses))
    assert tuple(index.total(**clauses).first()) == tuple(find.search_total(table, **clauses).first())
    for row in table.orderBy("id").limit(1).select(micros(F.col("updated_at")).alias("at"), "id").collect():
        assert ids(index.after(row["at"], row["id"], 8, **clauses)) == ids(find.search_after(table, row["at"], row["id"], 8, **clauses))


def test_a_page_opens_the_slices_that_fill_it(both):
    _, index = both
    slices = lambda df: {f.split("slice=")[1].split("/")[0] for f in df.inputFiles()}
    assert index.manifest.newest()[1]["slices"] == 15
    assert len(slices(index.page(1, 9))) == 1 and len(slices(index.page(5, 9, status="active"))) <= 3
    assert len(slices(index.page(1, 9, q="lee"))) <= 2
    total = index.total(status="active")
    assert all("counts" in f for f in total.inputFiles())


def test_an_empty_index(spark, work):
    index = SearchIndex(spark, work)
    index.build(docs(spark, 6).limit(0))
    assert ids(index.page()) == ids(index.page(q="x")) == ids(index.after(0, 0)) == []
    assert index.total(status="active").first()["total"] == 0


def test_a_new_index_replaces_the_old_one(spark, work):
    index, table = SearchIndex(spark, work), docs(spark, 30)
    index.build(table, 10)
    page = index.page(1, 5)
    index.build(table.where("id < 10"), 10)
    assert len(ids(page)) == 5 and index.total().first()["total"] == 10
    assert index.vacuum(grace=0) == 2 and len(ids(index.page(1, 50))) == 10


def test_lookup_opens_the_buckets_of_its_keys(spark, work, monkeypatch):
    rows = [record(i, amount=f"{i}.00") for i in range(1, 400)]
    store, source = fresh(spark, work), Table(spark, rows)
    replicate.run_incremental(store, source)
    store.compact(16)
    keys = spark.createDataFrame([(7,), (300,), (5000,)], "id long")
    found = store.lookup(keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 3 out of 16" in plan or "SelectedBucketsCount: 2 out of 16" in plan
    assert sorted(r["id"] for r in found.collect()) == [7, 300]
    # What came after the snapshot is found as well, by few keys and by many.
    source.rows[6] = record(7, version=9, updated=9_000, amount="70")
    source.rows[299] = record(300, version=9, updated=9_000, deleted=True)
    source.rows.append(record(5000, updated=9_000))
    replicate.run_incremental(store, source)
    want = [(i, v, a) for i, v, a, *_ in documents(store) if i in (7, 300, 5000)]
    assert [w[0] for w in want] == [7, 5000]
    for few in (1_000, 1):
        monkeypatch.setattr(st, "FEW", few)
        found = store.lookup(keys)
        assert sorted((r["id"], r["version"], r["amount"]) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.undo()
    assert store.lookup(keys.limit(0)).count() == 0
