"""Digest trees: any damage of contents is found, and only unlike leaves are joined."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reconcile

SCHEMA = "id long, version int, status string, amount double"
COLUMNS = ["version", "status", "amount"]


def rows_of(n, seed=1):
    rng = random.Random(seed)
    return {i: (i, rng.randint(1, 3), rng.choice([None, "a", "b"]), rng.choice([None, 0.0, 1.5])) for i in range(n)}


def want(source, sink):
    out = {}
    for i in source.keys() | sink.keys():
        s, t = source.get(i), sink.get(i)
        if s != t:
            out[i] = (
                "missing" if t is None else "extra" if s is None else "stale" if t[1] < s[1] else "ahead" if t[1] > s[1] else "differs"
            )
    return out


def found(spark, source, sink, depth=2):
    sides = [spark.createDataFrame(list(rows.values()), SCHEMA) for rows in (source, sink)]
    return {r["id"]: r["verdict"] for r in reconcile.damage(*sides, COLUMNS, depth).collect()}


@pytest.mark.parametrize("depth", [1, 3])
def test_every_kind_of_damage(spark, depth):
    source = rows_of(500)
    sink = dict(source)
    del sink[3], sink[4]
    sink[1000] = (1000, 1, None, None)
    sink[10] = (10, source[10][1] - 1, *source[10][2:])
    sink[11] = (11, source[11][1] + 1, *source[11][2:])
    sink[12] = (12, source[12][1], "other", source[12][3])
    source[13] = (13, 1, None, 1.5)
    sink[13] = (13, 1, "a", None)
    source[14], sink[14] = (14, 1, None, 0.0), (14, 1, "", 0.0)
    assert found(spark, source, sink, depth) == want(source, sink)
    if depth == 1:
        assert found(spark, source, source, depth) == {}
        assert set(found(spark, source, {}, depth).values()) == {"missing"} and found(spark, {}, {}, depth) == {}


def test_swapped_contents_are_seen(spark):
    """The same values under other ids give the same sums of values, but not of rows."""
    source = {1: (1, 1, "a", 1.0), 2: (2, 1, "b", 2.0)}
    sink = {1: (1, 1, "b", 2.0), 2: (2, 1, "a", 1.0)}
    assert found(spark, source, sink) == {1: "differs", 2: "differs"}


def test_repeated_ids(spark):
    rows = [(1, 1, "a", 1.0)] * 2 + [(2, 1, "a", 1.0)]
    twice, once = (spark.createDataFrame(r, SCHEMA) for r in (rows, rows[1:]))
    assert [tuple(r) for r in reconcile.damage(once, twice, COLUMNS, 1).select("id", "verdict").collect()] == [(1, "differs")]
    assert reconcile.damage(twice, twice, COLUMNS, 1).count() == 0


def test_order_and_partitions_do_not_matter(spark):
    rows = list(rows_of(300).values())
    trees = []
    for n in (1, 7):
        random.Random(n).shuffle(rows)
        tree = reconcile.digest_tree(spark.createDataFrame(rows, SCHEMA).repartition(n), COLUMNS, 2)
        trees.append(sorted(map(tuple, tree.collect())))
    assert trees[0] == trees[1]
    root = [t for t in trees[0] if t[0] == 0]
    assert len(root) == 1 and root[0][2] == 300
    assert {t[0] for t in trees[0]} == {0, 1, 2}


def test_joined_rows_follow_the_damage(spark):
    rows = spark.range(100_000).selectExpr("id", "cast(1 AS int) AS version", "'a' AS status", "cast(id AS double) AS amount")
    sink = rows.withColumn("amount", F.when(F.col("id").isin(5, 77_777), -1.0).otherwise(F.col("amount")))
    depth = reconcile.depth_for(100_000)
    assert depth == 3
    trees = [reconcile.digest_tree(side, COLUMNS, depth) for side in (rows, sink)]
    leaves = reconcile.unlike_leaves(*trees, depth)
    assert leaves.count() == 2
    assert 2 <= reconcile.rows_in(rows, leaves, depth).count() <= 200
    got = reconcile.damage(rows, sink, COLUMNS, depth, *trees).collect()
    assert sorted((r["id"], r["verdict"]) for r in got) == [(5, "differs"), (77_777, "differs")]
