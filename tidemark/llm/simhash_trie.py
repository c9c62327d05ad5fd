"""SimHash near-duplicates: a binary trie joined with itself.

Fingerprints of 64 bits are leaves of a binary trie. Pairs of nodes are traversed together
from the top; each step down adds the bits in which the two nodes differ, and a pair of
nodes is dropped as soon as that exceeds the allowed distance ``d``. Small pairs of nodes
are finished by comparing their leaves.

To share the work out, the 64 bits are cut into ``d + 1`` fields. Fingerprints within the
distance agree on at least one field, so there is a trie for each field with its bits first
(the fingerprint rotated), and below its first bits only equal nodes need to be paired: each
such subtree is a unit of work. A subtree with more than ``UNIT`` leaves is split by a hash
into slices, and every pair of slices is a unit, so a unit never exceeds two slices however
many fingerprints share a field. Units of a task are traversed side by side with array
operations.

A unit returns only a star for each group it finds (a link from every member to the
smallest), which joins the same fingerprints as all its pairs would. Connected components of
the stars are found by minimum labels and pointer jumping, with each round written to the
shared folder. Equal fingerprints are one leaf, so copies cost nothing beyond their hash.

Defined cases: a text with fewer words than a shingle has its whole word sequence as its one
shingle; a null text, or one without words, has fingerprint zero, linked like any other.
Rows with a null id are linked too; a component's id is its smallest non-null id. Repeated
rows share a component; ties of ids are broken by the fingerprint. A very long text is hashed
whole and has to fit a row. Columns of ``docs`` may have any names. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers, spread_join, unused, written

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Leaves of a unit's side, leaves compared directly, and comparisons made at once.
UNIT, LEAVES, AT_ONCE = 16_384, 256, 1 << 21
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's shingles, repeats included."""
    words = (text or b"").lower().split()  # bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[min(shingle, len(words)) - 1 :].tolist()
    of = xxhash.xxh64_intdigest
    view = memoryview(joined)
    total, n = np.zeros(64, np.int64), len(ends)
    for at in range(0, n, BLOCK):
        hashes = np.array([of(view[a:b], SEED) for a, b in zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK])], ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">u8")[0])


def fingerprints(shingle: int = SHINGLE):
    """A column function from UTF-8 bytes to the fingerprint, as a signed long."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
        return pa.array(found.view(np.int64))

    return of


def close_pairs(values: np.ndarray, lo1, hi1, lo2, hi2, depth: int, distance: int):
    """Yields index arrays of leaves within ``distance``, for pairs of ranges of ``values``.

    ``values`` (unsigned) ascend inside each range; the bits above ``depth`` are equal. Equal
    ranges are paired with themselves.
    """
    apart = np.zeros(len(lo1), np.int64)
    while len(lo1):
        sizes = (hi1 - lo1) * (hi2 - lo2)
        small = (sizes <= LEAVES) | (depth >= 64)
        yield from _compared(values, *(x[small] for x in (lo1, hi1, lo2, hi2)), distance)
        keep = ~small
        if not keep.any():
            return
        lo1, hi1, lo2, hi2, apart = (x[keep] for x in (lo1, hi1, lo2, hi2, apart))
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64)])
        mid1, mid2 = hi1 - (ones[hi1] - ones[lo1]), hi2 - (ones[hi2] - ones[lo2])
        same = (lo1 == lo2) & (hi1 == hi2)
        other = ~same
        parts = [
            (lo1, mid1, lo2, mid2, apart),
            (mid1, hi1, mid2, hi2, apart),
            (lo1, mid1, mid2, hi2, apart + 1),
            (mid1[other], hi1[other], lo2[other], mid2[other], apart[other] + 1),
        ]
        lo1, hi1, lo2, hi2, apart = (np.concatenate(x) for x in zip(*parts))
        live = (hi1 > lo1) & (hi2 > lo2) & (apart <= distance)
        lo1, hi1, lo2, hi2, apart = (x[live] for x in (lo1, hi1, lo2, hi2, apart))
        depth += 1


def _compared(values, lo1, hi1, lo2, hi2, distance):
    """All leaves of small pairs of ranges, a bounded number at once."""
    wide = hi2 - lo2
    sizes = (hi1 - lo1) * wide
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), AT_ONCE, side="right")) + at)
        n = sizes[at:upto]
        for first in range(0, int(n.sum()), 4 * AT_ONCE):  # a pair of equal leaves may be large by itself
            k = np.arange(first, min(first + 4 * AT_ONCE, int(n.sum())))
            ends = np.cumsum(n)
            pair = np.searchsorted(ends, k, side="right")
            off = k - (ends - n)[pair]
            pair += at
            i, j = lo1[pair] + off // wide[pair], lo2[pair] + off % wide[pair]
            ok = (np.bitwise_count(values[i] ^ values[j]) <= distance) & ((lo1[pair] != lo2[pair]) | (i < j))
            if ok.any():
                yield i[ok], j[ok]
        at = upto


def stars(n: int, links) -> np.ndarray:
    """The smallest index that each of ``n`` is connected to."""
    label = np.arange(n)
    for i, j in links:
        while True:
            a, b = label[i], label[j]
            differ = a != b
            if not differ.any():
                break
            i, j, low, high = i[differ], j[differ], np.minimum(a, b)[differ], np.maximum(a, b)[differ]
            np.minimum.at(label, high, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def rotated(value: Column, by: int) -> Column:
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by)) if by else value


def fields(distance: int) -> list[tuple[int, int]]:
    """First bit and width of each field."""
    edges = [64 * k // (distance + 1) for k in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(prints: DataFrame, distance: int = DISTANCE, unit: int = UNIT) -> DataFrame:
    """``a, b``: for every fingerprint with neighbours, a star link per unit; ``prints`` holds distinct ``fp``."""
    cut = fields(distance)
    tries = F.array(
        *[F.struct(F.lit(i).alias("field"), F.shiftrightunsigned(rotated(F.col("fp"), at), 64 - width).alias("node"), rotated(F.col("fp"), at).alias("value")) for i, (at, width) in enumerate(cut)]
    )
    leaves = prints.select(F.explode(tries).alias("t")).select("t.*")
    crowded = leaves.groupBy("field", "node").agg(F.ceil(F.count("*") / unit).cast("int").alias("slices")).where("slices > 1")
    crowded = crowded.select(F.col("field").alias("f"), F.col("node").alias("n"), "slices")
    # At most (distance + 1) * 2 ** 13 rows of 16 bytes at the default distance, by the widths of the fields.
    dealt = leaves.join(F.broadcast(crowded), (F.col("field") == F.col("f")) & (F.col("node") == F.col("n")), "left")
    mine = F.pmod(F.xxhash64("value"), F.col("slices")).cast("int")
    others = F.sequence(F.lit(0), F.col("slices") - 1)
    units = F.when(F.col("slices").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
        F.transform(others, lambda o: F.struct(F.least(o, mine).alias("x"), F.greatest(o, mine).alias("y")))
    )
    members = (
        dealt.withColumn("unit", F.explode(units))
        .select("field", "node", "unit.x", "unit.y", F.when(F.col("slices").isNotNull() & (mine != F.col("unit.x")), 1).otherwise(0).alias("side"), "value")
        .repartition("field", "node", "x", "y")
        .sortWithinPartitions("field", "node", "x", "y", "side", "value")
    )

    def traverse(batches):
        """Units whole, as they come sorted; the last unit of a batch waits for the next one."""
        waiting, n = [], 0
        for batch in batches:
            waiting.append(np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)]))
            n += waiting[-1].shape[1]
            if n >= 4 * unit:
                rows = np.concatenate(waiting, axis=1)
                last = np.flatnonzero((rows[:4] != rows[:4, -1:]).any(axis=0))
                done = int(last[-1]) + 1 if len(last) else 0
                waiting, n = [rows[:, done:]], rows.shape[1] - done
                if done:
                    yield from join(rows[:, :done])
        if n:
            yield from join(np.concatenate(waiting, axis=1))

    def join(rows):
        key, side, values = rows[:4], rows[4], rows[5].view(np.uint64)
        new_unit = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])
        starts = np.flatnonzero(new_unit)
        ends = np.append(starts[1:], rows.shape[1])
        middle = ends - np.add.reduceat(side, starts)  # where side 1 begins
        field = key[0][starts]
        split = key[2][starts] != key[3][starts]
        links = []
        for f, (_, width) in enumerate(cut):
            own = field == f
            whole, pair = own & ~split, own & split
            lo1, hi1 = np.append(starts[whole], starts[pair]), np.append(ends[whole], middle[pair])
            lo2, hi2 = np.append(starts[whole], middle[pair]), np.append(ends[whole], ends[pair])
            some = (hi1 - lo1) * (hi2 - lo2) > np.append(np.ones(whole.sum(), int), np.zeros(pair.sum(), int))
            links.append(close_pairs(values, lo1[some], hi1[some], lo2[some], hi2[some], width, distance))
        label = stars(rows.shape[1], (x for each in links for x in each))
        member = np.flatnonzero(label != np.arange(len(label)))
        if len(member):
            at = np.array([a for a, _ in cut])[key[0][member]].astype(np.uint64)
            back = lambda v: ((v >> at) | np.where(at > 0, v << (np.uint64(64) - np.maximum(at, np.uint64(1))), np.uint64(0))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(back(values[member])), pa.array(back(values[label[member]]))], ["a", "b"])

    return members.mapInArrow(traverse, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): the smallest node connected to it."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "simhash-edges")
    state = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "simhash-roots")
    while True:
        of = state.select(F.col("node").alias("b"), F.col("root").alias("of_b"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("of_b").alias("near"))
        lower = written(
            state.join(near, "node").select("node", F.least("root", "near").alias("next"), F.col("root").alias("old")), "simhash-near"
        )
        up = lower.select(F.col("node").alias("up"), F.col("next").alias("up_root"))
        jumped = written(
            lower.join(up, F.col("next") == F.col("up")).select("node", F.col("up_root").alias("root"), "old"), "simhash-roots"
        )
        state = jumped.select("node", "root")
        if jumped.where("root < old").isEmpty():
            return state


def grouped(docs: DataFrame, shingle: int, distance: int, unit: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, fp``; and for each fingerprint ``of, first, n, root, component_id``: the smallest
    id that has it, its rows, the smallest fingerprint of its group, and the smallest id of its group."""
    if not 0 <= distance < 16:
        raise ValueError("distance must be from 0 to 15")
    python_workers(docs.sparkSession)
    rows = written(docs.select("doc_id", fingerprints(shingle)(F.col("text").cast("binary")).alias("fp")), "simhash-prints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "simhash-distinct")
    found = written(links(prints.select("fp"), distance, unit), "simhash-links")
    roots = components(found)
    known = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    known = written(known, "simhash-known")
    smallest = written(known.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n")), "simhash-groups")
    sizes = smallest.select(F.col("root").alias("key"), "n")
    groups = smallest.select(F.col("root").alias("group"), "component_id")
    of = spread_join(known, "root", F.xxhash64("fp"), groups, "group", sizes)
    return rows, written(of.select(F.col("fp").alias("of"), "first", "n", "root", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, unit: int = UNIT) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``."""
    rows, of = grouped(docs, shingle, distance, unit)
    copies = of.select(F.col("of").alias("key"), "n")
    return spread_join(rows, "fp", F.monotonically_increasing_id(), of, "of", copies).select("doc_id", "fp", "component_id")


def distinct_documents(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group: the one with the smallest id, then the smallest fingerprint.

    A group is known by its smallest fingerprint, so rows that repeat an id with unlike texts
    stand for themselves. Of rows equal in id and fingerprint, one stays; in a group without
    any id, one row stays.
    """
    rows, of = grouped(docs, shingle, distance, UNIT)
    kept_id, kept_fp, own_fp = (unused(docs, name) for name in ("kept_id", "kept_fp", "own_fp"))
    kept = of.where(F.col("first").eqNullSafe(F.col("component_id"))).groupBy("root", "component_id").agg(F.min("of").alias(kept_fp))
    # Only rows without an id, and those whose id has several fingerprints, are told apart by their
    # own; only texts of ids that repeat are shuffled.
    by_id = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
    again = written(by_id.where("n > 1").select("doc_id", (F.col("low") < F.col("high")).alias("unlike")), "simhash-again")
    unlike = again.where("unlike").select("doc_id")
    named = kept.where("component_id IS NOT NULL").select(F.col("component_id").alias(kept_id), kept_fp)
    named = named.join(again, F.col(kept_id) == F.col("doc_id"), "left").select(
        kept_id, kept_fp, F.col("doc_id").isNotNull().alias("repeated"), F.coalesce("unlike", F.lit(False)).alias("several")
    )
    named = written(named, "simhash-kept")
    nameless = written(kept.where("component_id IS NULL").select(kept_fp), "simhash-nameless")
    rows_of = lambda some: docs.join(named.where(some).select(kept_id), F.col("doc_id") == F.col(kept_id), "left_semi")
    out = rows_of("NOT repeated")
    if not again.isEmpty():
        out = out.unionByName(rows_of("repeated AND NOT several").dropDuplicates(["doc_id"]))
    own = fingerprints(shingle)(F.col("text").cast("binary"))
    if not unlike.isEmpty():
        several = named.where("several").select(kept_id, kept_fp)
        some = docs.join(unlike.select(F.col("doc_id").alias(kept_id)), F.col("doc_id") == F.col(kept_id), "left_semi").withColumn(own_fp, own)
        some = some.join(several, (F.col("doc_id") == F.col(kept_id)) & (F.col(own_fp) == F.col(kept_fp)), "left_semi")
        out = out.unionByName(some.dropDuplicates(["doc_id", own_fp]).select(*docs.columns))
    if not nameless.isEmpty():
        alone = docs.where(F.col("doc_id").isNull()).withColumn(own_fp, own)
        alone = alone.join(nameless, F.col(own_fp) == F.col(kept_fp), "left_semi")
        out = out.unionByName(alone.dropDuplicates([own_fp]).select(*docs.columns))
    return out
