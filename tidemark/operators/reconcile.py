"""Comparing source and sink row by row, not by counts.

Versions can be joined for all ids (``reconcile``). Contents are compared by a tree of digests:
ids fall into leaves by hash, a leaf has a digest of all its rows that does not depend on their
order, and 16 nodes make one node of the level above. Two trees are walked from the top, below
unlike nodes only; rows are joined for the leaves that are unlike, so the join is as large as
the damage and not as the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING, EXTRA, STALE, AHEAD, EQUAL, DIFFERS = "missing", "extra", "stale", "ahead", "equal", "differs"
#: Children of a node as bits, most levels below the root (a million leaves), rows aimed at per leaf.
FAN_BITS, DEEPEST, LEAF_ROWS = 4, 5, 256


def _one_per_id(df: DataFrame, name: str) -> DataFrame:
    # Both sides are unique by design; if one is not, its copies melt here, map-side.
    return df.groupBy("id").agg(F.max("version").alias(name))


def reconcile(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Every id of either side with both versions and how they relate."""
    left, right = _one_per_id(source, "source_version"), _one_per_id(sink, "sink_version")
    s, t = F.col("source_version"), F.col("sink_version")
    verdict = (
        F.when(t.isNull(), MISSING)
        .when(s.isNull(), EXTRA)
        .when(t < s, STALE)
        .when(t > s, AHEAD)
        .otherwise(EQUAL)
    )
    return left.join(right, "id", "full_outer").withColumn("verdict", verdict)


def summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def missing_in_sink(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Source ids, with their version, that the sink lacks."""
    return _one_per_id(source, "version").join(sink.select("id").distinct(), "id", "left_anti")


def extra_in_sink(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Sink ids, with their version, that the source lacks: hard deletes show up here."""
    return missing_in_sink(sink, source)


def duplicate_ids(sink: DataFrame) -> DataFrame:
    """Ids the sink holds more than once, with the number of copies."""
    return sink.groupBy("id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


# -- contents ---------------------------------------------------------------------------


def depth_for(n_rows: int) -> int:
    """Levels below the root that give leaves of about ``LEAF_ROWS`` rows, while there are at most
    a million of them."""
    leaves = max(n_rows / LEAF_ROWS, 1)
    return min(max(ceil(log(leaves, 2**FAN_BITS)), 1), DEEPEST)


def leaf(depth: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(1 << FAN_BITS * depth)).alias("leaf")


def row_digest(columns: Sequence[str], seed: int) -> Column:
    """A hash of the values and of where NULLs stand, which the hash function skips."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(F.lit(seed), "id", nulls, *columns)


def _hashes(columns: Sequence[str]) -> list[Column]:
    return [row_digest(columns, 1).alias("a"), row_digest(columns, 2).alias("b")]


def _digest() -> list[Column]:
    """Of the rows of a group, in any order."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.bit_xor("a").alias("x"),
        F.sum(F.col("b").bitwiseAND(0xFFFFFFFF)).alias("lo"),
        F.sum(F.shiftrightunsigned("b", 32)).alias("hi"),
    ]


def digest_tree(rows: DataFrame, columns: Sequence[str], depth: int) -> DataFrame:
    """Every node as ``(level, node, n, x, lo, hi)``: number of rows, and XOR and sums of their hashes.

    One pass, reduced in the tasks to a row per leaf; the levels above are added up from the
    leaves. Rows that repeat count as often as they occur.
    """
    leaves = rows.select(leaf(depth), *_hashes(columns)).groupBy("leaf").agg(*_digest())
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    node = F.expr(f"shiftright(leaf, {FAN_BITS} * ({depth} - level))").alias("node")
    return (
        leaves.select("*", levels)
        .select("level", node, "n", "x", "lo", "hi")
        .groupBy("level", "node")
        .agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("lo").alias("lo"), F.sum("hi").alias("hi"))
    )


def unlike_leaves(left: DataFrame, right: DataFrame, depth: int) -> DataFrame:
    """Leaves of two trees that hold unlike rows, found from the root down."""
    unlike = None
    for level in range(depth + 1):
        sides = []
        for tree, name in ((left, "l"), (right, "r")):
            nodes = tree.where(F.col("level") == level).select("node", F.struct("n", "x", "lo", "hi").alias(name))
            if unlike is not None:
                nodes = nodes.withColumn("up", F.shiftright("node", FAN_BITS)).join(unlike, "up", "left_semi").drop("up")
            sides.append(nodes)
        met = sides[0].join(sides[1], "node", "full_outer").where(~F.col("l").eqNullSafe(F.col("r")))
        unlike = met.select(F.col("node").alias("up"))
    return unlike.select(F.col("up").alias("leaf"))


def rows_in(rows: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """The rows of some leaves. There are at most a million leaves of 8 bytes: they are broadcast."""
    return rows.withColumn("leaf", leaf(depth)).join(F.broadcast(leaves), "leaf", "left_semi").drop("leaf")


def damage(
    source: DataFrame,
    sink: DataFrame,
    columns: Sequence[str],
    depth: int,
    source_tree: DataFrame | None = None,
    sink_tree: DataFrame | None = None,
) -> DataFrame:
    """Ids whose rows are not alike in ``columns``, with both versions and a verdict.

    Equal versions with other contents are ``differs``. Trees made before (``digest_tree``) save
    a scan of their side; they must be of the same columns, column types and depth.
    """
    trees = [
        digest_tree(rows, columns, depth) if tree is None else tree
        for rows, tree in ((source, source_tree), (sink, sink_tree))
    ]
    leaves = unlike_leaves(*trees, depth)
    sides = []
    for rows, name in ((source, "source"), (sink, "sink")):
        # One row per id; where an id repeats, all its rows count.
        one = rows_in(rows, leaves, depth).select("id", "version", *_hashes(columns)).groupBy("id")
        digested = one.agg(F.max("version").alias(f"{name}_version"), *_digest())
        sides.append(digested.select("id", f"{name}_version", F.struct("n", "x", "lo", "hi").alias(f"{name}_d")))
    both = sides[0].join(sides[1], "id", "full_outer")
    s, t = F.col("source_version"), F.col("sink_version")
    verdict = (
        F.when(F.col("sink_d").isNull(), MISSING)
        .when(F.col("source_d").isNull(), EXTRA)
        .when(t < s, STALE)
        .when(t > s, AHEAD)
        .when(F.col("source_d") != F.col("sink_d"), DIFFERS)
    )
    return both.select("id", "source_version", "sink_version", verdict.alias("verdict")).where("verdict IS NOT NULL")
