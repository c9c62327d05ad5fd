"""Mixing sources to target weights: weighted sampling without replacement to token budgets.

Every document draws an exponential key ``-ln(u) / weight`` (Efraimidis and Spirakis: the
smallest keys are a weighted sample without replacement). Within its source, documents are
taken in key order until the source's token budget is used. A budget above the source's
size is first served by complete epochs; only the remainder is selected.

The selection of a source is a prefix of its key order, so it is known by one cut key. Keys
fall into blocks of equal width on their logarithmic scale, so a block holds about a thousandth
of its source, or some ``BLOCK_ROWS`` rows if that is less, at any scale of the weights. Block totals (one row per source and block) give
the block in which the budget ends; only that block is ordered row by row. So no window
holds more than a block, however large the source is, and texts are never shuffled: the
cuts (one row per source) are joined to the documents.

Defined cases: a null text has size 0; a null source is a source of its own, the last one;
a source of size 0 gets target 0 and its documents are taken 0 times over. Documents equal in id, source and
text are one unit: they are taken together. Weights of any positive size are told apart (keys are
kept as logarithms). A null weight or NaN counts as 1, infinity as the largest double, and 0 or
less as the smallest positive one: such documents are taken when nothing else is left. Equal keys
are ordered by the draw, the id and the size. Very long texts are read whole; only their counts
and digests are kept. Columns of ``docs`` may have any names; ``mix`` is replaced. An empty table
gives an empty result. Keys depend on ``doc_id``, text and seed alone, so reruns agree.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words, text_of, unused, written

#: Weights of the sources in code-point order, repeated.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Key blocks per doubling of the key, at least; more where a block would hold more rows than this.
BLOCKS, BLOCK_ROWS = 256, 100_000
#: Characters that lower a document's quality weight.
SYMBOLS = "#*$%&|<>"
#: Up to this many sources, the cuts (some 60 bytes each) are broadcast; beyond, joined.
BROADCAST_SOURCES = 20_000


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size)`` to targets that share the total of all sizes by weight.

    A target stops at ``cap`` times its source's size and the excess is shared again by
    weight. Capped are the sources with the smallest ``cap * size / weight``: in that order,
    the first k are capped where k is the smallest number whose remaining sources all stay
    below their caps. One row per source goes through one task here.
    """
    w = F.element_at(
        F.array(*[F.lit(float(x)) for x in weights]),
        (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    room = F.lit(float(cap)) * F.col("source_size")
    by_ratio = Window.orderBy("ratio", "weight", F.col("source").asc_nulls_last())
    rows = (
        sizes.withColumn("weight", w)
        .withColumn("room", room)
        .withColumn("ratio", F.col("room") / F.col("weight"))
        .withColumn("capped", F.coalesce(F.sum("room").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        # What a unit of weight gets if all before this source are capped and the rest are not.
        .withColumn("rate", (F.col("total") - F.col("capped")) / F.col("open"))
        .withColumn("nth", F.row_number().over(by_ratio))
        .withColumn("rate", F.min(F.when(F.col("rate") <= F.col("ratio"), F.struct("nth", "rate"))).over(Window.partitionBy())["rate"])
    )
    target = F.when(F.col("rate").isNull() | (F.col("ratio") <= F.col("rate")), F.col("room")).otherwise(
        F.col("rate") * F.col("weight")
    )
    return rows.select("source", "source_size", target.alias("target"))


def uniform(seed: int) -> Column:
    """A number in (0, 1): 52 bits of the MD5 digest of seed, id and text."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of())
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(2.0**52)


def quality_weight() -> Column:
    """1 for a text without symbols, less the more symbols it has per word."""
    symbols = F.regexp_count(text_of(), F.lit(f"[{SYMBOLS}]"))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * symbols / F.greatest(n_words(), F.lit(1)))


def cuts(docs: DataFrame, weight: Column, weights: Sequence[float] = WEIGHTS, seed: int = 1, blocks: int = BLOCKS) -> DataFrame:
    """Per source: its size and target, complete epochs, and the last key selected beyond them.

    ``docs`` has ``doc_id, text, source`` and whatever ``weight`` needs. A document is
    selected if at least half of it fits into what is left of the budget.
    """
    # Written before it is filtered: a filter below would go through the texts once more.
    keyed = docs.select("source", n_words().alias("size"), *_key(uniform(seed), weight, blocks), "doc_id")
    keyed = written(keyed, "mix-keys").where("size > 0")
    totals = written(keyed.groupBy("source", "block").agg(F.sum("size").alias("size")), "mix-blocks")
    sizes = docs.select("source").distinct().join(
        totals.groupBy(F.col("source").alias("s")).agg(F.sum("size").alias("source_size")),
        F.col("source").eqNullSafe(F.col("s")),
        "left",
    )
    sizes = sizes.select("source", F.coalesce("source_size", F.lit(0)).alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = written(
        targets(sizes, weights)
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")),
        "mix-targets",
    )
    named = plan.select(F.col("source").alias("s"), "budget")
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        totals.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .join(named, F.col("source").eqNullSafe(F.col("s")))
        .where("before < budget")
        .groupBy(F.col("s"), "budget")
        .agg(F.max(F.struct("block", "before")).alias("at"))
        .select("s", "budget", F.col("at.block").alias("b"), "at.before")
    )
    order = Window.partitionBy("source").orderBy("key", "u", "doc_id", "size")
    inside = (
        keyed.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
        .groupBy("source", "before", "budget", "key", "u", "doc_id", "size")
        .agg(F.sum("size").alias("unit"))
        .withColumn("start", F.col("before") + F.sum("unit").over(order) - F.col("unit"))
    )
    # Key order within a source is block order, so everything in earlier blocks is selected.
    last = (
        inside.where("2 * start + unit <= 2 * budget")
        .groupBy(F.col("source").alias("s"))
        .agg(F.max(F.struct("key", "u")).alias("last"))
    )
    first = edge.select("s", F.col("b").alias("edge"))
    return (
        plan.join(last, F.col("source").eqNullSafe(last["s"]), "left")
        .drop("s")
        .join(first, F.col("source").eqNullSafe(first["s"]), "left")
        .select("source", "source_size", "target", "epochs", "edge", F.col("last.key").alias("last_key"), F.col("last.u").alias("last_u"))
    )


def blocks_for(rows: int) -> int:
    """Key blocks per doubling. Most keys lie within three doublings."""
    return max(BLOCKS, rows // BLOCK_ROWS)


def _key(u: Column, weight: Column, blocks: int) -> list[Column]:
    """The logarithm of the exponential key, its block, and the draw that breaks ties of rounded keys."""
    w = F.coalesce(F.nanvl(weight.cast("double"), F.lit(1.0)), F.lit(1.0))
    w = F.greatest(F.least(w, F.lit(sys.float_info.max)), F.lit(math.ulp(0.0)))
    key = F.log(-F.log(u)) - F.log(w)
    return [key.alias("key"), F.floor(key / math.log(2) * blocks).cast("long").alias("block"), u.alias("u")]


def mixed(docs: DataFrame, weight: Column, weights: Sequence[float] = WEIGHTS, seed: int = 1) -> DataFrame:
    """``docs`` with ``mix`` (struct of size, source_size, target, copies), every row kept.

    ``copies`` is how often the mix takes the document. A column ``mix`` of ``docs`` is
    replaced.
    """
    found = unused(docs, "mix")
    rows = _with_mix(docs, weight, weights, seed, found)
    kept = [F.col(c) for c in docs.columns if c.lower() != "mix"]
    return rows.select(*kept, F.col(found).alias("mix"))


def _with_mix(docs: DataFrame, weight: Column, weights: Sequence[float], seed: int, out: str) -> DataFrame:
    blocks = blocks_for(docs.count())
    cut = written(cuts(docs, weight, weights, seed, blocks), "mix-cuts")
    if cut.count() <= BROADCAST_SOURCES:
        cut = F.broadcast(cut)
    named = unused(docs, "mix_cut")
    cut = cut.select(F.struct("*").alias(named))
    c = lambda name: F.col(f"{named}.{name}")
    # The same expressions as in cuts(), computed once below the join.
    drawn = [unused(docs, "mix_" + name) for name in ("size", "key", "block", "u")]
    rows = docs.select("*", *[e.alias(name) for e, name in zip((n_words(), *_key(uniform(seed), weight, blocks)), drawn)])
    size, key, block, u = map(F.col, drawn)
    selected = F.coalesce(
        (size > 0) & ((block < c("edge")) | ((block == c("edge")) & ((key < c("last_key")) | ((key == c("last_key")) & (u <= c("last_u")))))),
        F.lit(False),
    )
    columns = [F.col(x) for x in docs.columns]
    return rows.join(cut, F.col("source").eqNullSafe(c("source")), "left").select(
        *columns,
        F.struct(
            size.alias("size"),
            c("source_size").alias("source_size"),
            c("target").alias("target"),
            (c("epochs") + selected.cast("long")).alias("copies"),
        ).alias(out),
    )


def sampled(docs: DataFrame, weight: Column, weights: Sequence[float] = WEIGHTS, seed: int = 1) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document repeated as often as it is taken."""
    found, epoch = unused(docs, "mix"), unused(docs, "mix_epoch")
    rows = _with_mix(docs, weight, weights, seed, found)
    each = F.explode(F.array_repeat(F.lit(1), F.col(f"{found}.copies").cast("int")))  # none for 0 copies
    return rows.select(*docs.columns, each.alias(epoch)).select(*docs.columns)
