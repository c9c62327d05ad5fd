"""LM scoring: an interpolated modified Kneser-Ney n-gram model of any order, counted in Spark.

The model lies in the shared folder as sorted arrays, and the workers that score map them
into memory. An n-gram is the id of its context (the n-gram without its last word) and the id
of a word; its own id is its place among all n-grams of its length, so the next length is
counted in the same way. Per length there are these shuffles of packed arrays:

1. Words. Tasks send the distinct 64-bit hashes of their words with counts, dealt by the
   leading bits of the hash. A word's id is its rank among all hashes.
2. n-grams. Tasks send the distinct pairs of context and word with counts, dealt over a grid:
   rows by context, columns by word. So neither the n-grams after one frequent context nor
   those before a word meet in one task, and every cell holds its share of the pairs.
3. Margins. Cells send what they add to each context (sum of counts, and how many n-grams occur
   once, twice, more often) and to each suffix, the n-gram without its first word (distinct
   words before it, the count of that n-gram in a lower order).

Tasks send each distinct word or n-gram once, so the traffic follows what is distinct in the
input and no key is hot. Parts are merged as they come in: a task holds what is distinct in a
part. The number of parts follows the size of the input, ``FILES`` files hold them, and a
worker keeps at most ``MAPS`` files mapped.

With ``c`` the count of an n-gram (in lower orders: distinct words before it) and ``D`` its
discount (1, 2, 3 or more, each its own): ``p(w | h) = max(c - D, 0) / c(h .) + g(h) * p(w | h')``,
``h'`` the context without its first word, down to the uniform distribution over the vocabulary
and one unknown word. A context never seen (or never continued) gives ``p(w | h')``. A text is
its lower-cased (A-Z) words and an end token; before it stand ``order - 1`` start marks.

Defined cases: a null or empty text is just the end token. Without training rows every
token has probability 1 (an unknown word is all there is). Discounts that the counts leave
undefined are 0.5, 1 and 1.5. Repeated rows count repeatedly; ties do not arise, as all sums are
exact. Very long texts are counted and scored whole, ``PACK`` tokens or one text at a time.
Other columns are neither read nor returned. An empty table gives none.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers, written
from tidemark.session import shared_dir

#: Bytes of text per part of the words and cell of the bigrams, and tokens a task packs at once.
PART_BYTES, PACK = 1 << 24, 1 << 22
#: Files that hold an array (up to twice as many), and files a worker keeps mapped.
FILES, MAPS = 1024, 256
END = xxhash.xxh64_intdigest(b" end")  # no word holds a space
FALLBACK = (0.5, 1.0, 1.5)


# Arrays in the shared folder -------------------------------------------------------------


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else path


class Writer:
    """Arrays appended part by part; a repeated task replaces the files by equal ones at once."""

    def __init__(self, path: str):
        self.path, self.draft, self.open = path, f".{uuid.uuid4().hex}.tmp", {}

    def add(self, kind: str, array: np.ndarray) -> None:
        if kind not in self.open:
            local, at = _local(self.path), f"{self.path}.{kind}{self.draft}"
            if local:
                os.makedirs(os.path.dirname(local), exist_ok=True)
                self.open[kind] = open(f"{local}.{kind}{self.draft}", "wb")
            else:
                store, name = _store(at)
                store.create_dir(os.path.dirname(name), recursive=True)
                self.open[kind] = store.open_output_stream(name)
        self.open[kind].write(memoryview(np.ascontiguousarray(array)).cast("B"))

    def close(self) -> None:
        for kind, f in self.open.items():
            f.close()
            local, at = _local(self.path), f"{self.path}.{kind}"
            if local:
                os.replace(f"{local}.{kind}{self.draft}", f"{local}.{kind}")
            else:
                store, name = _store(at)
                store.move(name + self.draft, name)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def mapped(path: str, kind: str) -> np.ndarray:
    """An array of the shared folder, mapped into memory.

    From a store without local paths a file is copied to an unlinked temporary one first; it is
    given back when the worker maps others (``MAPS``).
    """
    local = _local(path)
    if local:
        return np.memmap(local, kind, "r") if os.path.getsize(local) else np.empty(0, kind)
    store, at = _store(path)
    with tempfile.TemporaryFile() as copy, store.open_input_stream(at) as f:
        while block := f.read(1 << 24):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, kind, "r") if copy.tell() else np.empty(0, kind)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers, each in the narrowest type that holds it."""
    out = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        a = np.asarray(a, np.uint64)
        size = next(s for s in (1, 2, 4, 8) if not len(a) or int(a.max()) < 1 << 8 * s)
        out += [np.array([len(a), size], np.int64).tobytes(), a.astype(f"u{size}").tobytes()]
    return b"".join(out)


def _unpack(blob: bytes) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(blob, np.int64, 1)[0]), 8, []
    for _ in range(n):
        length, size = (int(x) for x in np.frombuffer(blob, np.int64, 2, at))
        out.append(np.frombuffer(blob, f"u{size}", length, at + 16).astype(np.uint64))
        at += 16 + length * size
    return out


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    sums = [np.add.reduceat(v[order], starts) if len(keys) else v for v in values]
    return keys[starts], *sums


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.diff(np.append(starts, len(keys))).astype(np.uint64)


class Sums:
    """Sums by key of arrays that come in bit by bit; holds what is distinct, and as much again."""

    def __init__(self):
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n = self.held = 0

    def add(self, keys: np.ndarray, *values: np.ndarray) -> None:
        self.waiting.append((keys, *values))
        self.n += len(keys)
        if self.n > max(2 * self.held, PACK):
            self.result()

    def result(self) -> tuple[np.ndarray, ...]:
        """Keys in order and the sums of their values."""
        merged = _summed(*(np.concatenate(x) for x in zip(*self.waiting)))
        self.waiting, self.n, self.held = [merged], len(merged[0]), len(merged[0])
        return merged


@dataclass(frozen=True)
class Table:
    """Arrays cut into parts, consecutive parts in one file."""

    path: str
    per_file: int
    starts: np.ndarray  # place of the first item of each part, and the number of items

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    def file_of(self, part: int) -> str:
        return f"{self.path}-{part // self.per_file}"

    def files(self) -> Iterator[tuple[str, int, int]]:
        """Files that are not empty, and the places they hold."""
        for first in range(0, len(self.starts) - 1, self.per_file):
            lo, hi = int(self.starts[first]), int(self.starts[min(first + self.per_file, len(self.starts) - 1)])
            if hi > lo:
                yield self.file_of(first), lo, hi

    def part(self, maps: Maps, part: int, kind: str, of: str) -> np.ndarray:
        lo, hi = int(self.starts[part]), int(self.starts[part + 1])
        if lo == hi:
            return np.empty(0, of)
        first = int(self.starts[part - part % self.per_file])
        return maps.get(f"{self.file_of(part)}.{kind}", of)[lo - first : hi - first]

    def take(self, maps: Maps, kind: str, of: str, edges: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Values of ids, part ``p`` being those of the ids from ``edges[p]`` on; 0 where it is empty."""
        out = np.zeros(len(ids))
        part = np.searchsorted(edges, ids, side="right") - 1
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(len(edges)))
        for p in np.flatnonzero(np.diff(cuts)):
            values = self.part(maps, int(p), kind, of)
            if len(values):
                mine = order[cuts[p] : cuts[p + 1]]
                out[mine] = values[ids[mine] - edges[p]]
        return out


class Maps:
    """The files last used, mapped into memory."""

    def __init__(self):
        self.open: OrderedDict[str, np.ndarray] = OrderedDict()

    def get(self, path: str, of: str) -> np.ndarray:
        if path not in self.open:
            self.open[path] = mapped(path, of)
            if len(self.open) > MAPS:
                self.open.popitem(last=False)
        self.open.move_to_end(path)
        return self.open[path]


def per_file(parts: int) -> int:
    return max(1, parts // FILES)


def _by_part(packed: DataFrame, parts: int) -> DataFrame:
    """Packed rows (part, blob) with all parts of a file in one task, in order."""
    file = (F.col("part") / per_file(parts)).cast("int")
    return packed.repartition(file).sortWithinPartitions("part")


def _merging(path: str, parts: int, start, add, finish):
    """Merge the packed rows of each part: a state from ``start(part)`` goes through ``add`` with every
    blob; ``finish`` appends arrays to the part's file and yields what to pass on."""
    per = per_file(parts)

    def run(batches):
        part = state = writer = None

        def done():
            yield from finish(part, state, writer)

        for batch in batches:
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist()):
                if p != part:
                    if part is not None:
                        yield from done()
                        if p // per != part // per:
                            writer.close()
                            writer = None
                    part, state = p, start(p)
                    writer = writer or Writer(f"{path}-{p // per}")
                add(part, state, _unpack(blob))
        if part is not None:
            yield from done()
            writer.close()

    return run


_PACKED = pa.schema([("part", pa.int32()), ("blob", pa.binary())])
_SIZES = pa.schema([("part", pa.int32()), ("numbers", pa.list_(pa.int64()))])


def _packed_batches(rows):
    for part, blob in rows:
        yield pa.RecordBatch.from_pydict({"part": [part], "blob": [blob]}, _PACKED)


def _numbers(part: int, numbers: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": [part], "numbers": [[int(x) for x in numbers]]}, _SIZES)


def _table(path: str, parts: int, sizes: dict[int, int]) -> Table:
    return Table(path, per_file(parts), np.cumsum([0, *(sizes.get(p, 0) for p in range(parts))]))


# Tokens ----------------------------------------------------------------------------------


def hashes(text: bytes | None) -> np.ndarray:
    """The hashes of a text's tokens, the end included."""
    words = (text or b"").lower().split()  # bytes: A-Z, and the six ASCII white-space characters
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def _runs(batches, size: int = PACK):
    """Token hashes of whole texts, about ``size`` at once, and the positions where texts start."""
    found, n = [], 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found.append(hashes(text))
            n += len(found[-1])
            if n >= size:
                yield np.concatenate(found), np.cumsum([0, *map(len, found[:-1])])
                found, n = [], 0
    if found:
        yield np.concatenate(found), np.cumsum([0, *map(len, found[:-1])])


# Counting --------------------------------------------------------------------------------


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def edges_of(n: int, parts: int) -> np.ndarray:
    """First ids of equal ranges of ``n`` ids."""
    return np.array([n * p // parts for p in range(parts + 1)], np.int64)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, by how many things have count 1, 2, 3 and 4."""
    n1, n2, n3, n4 = n
    if min(n) < 1:
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return d if all(0 < x <= k for k, x in enumerate(d, 1)) else FALLBACK


def discounted(counts: np.ndarray, d) -> np.ndarray:
    counts = np.asarray(counts, float)
    return counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


def _levels(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, how many 3 or more, and their sum."""
    n = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()
    return [*n, int((counts >= 3).sum()), int(counts.sum())]


def _as_counts(counts: np.ndarray) -> np.ndarray:
    """Four bytes a count: what occurs more often is scored as that often."""
    return np.minimum(counts, 2**32 - 1).astype("u4")


@dataclass(frozen=True)
class Vocabulary:
    table: Table
    tokens: int

    @property
    def size(self) -> int:
        return self.table.size

    def ids(self, maps: Maps, hashes: np.ndarray) -> np.ndarray:
        """Ids of ascending hashes; -1 where unknown."""
        out = np.full(len(hashes), -1, np.int64)
        for file, lo, hi in self.table.files():
            known = maps.get(f"{file}.hash", "u8")
            a, b = np.searchsorted(hashes, known[0]), np.searchsorted(hashes, known[-1], side="right")
            at = np.searchsorted(known, hashes[a:b])
            out[a:b] = np.where(known[at] == hashes[a:b], at + lo, -1)
        return out


@dataclass(frozen=True)
class Grams:
    """The n-grams of one length."""

    table: Table  # key and count by cell
    contexts: int  # ids of contexts, the start marks included
    words: int
    side: int
    margins: Table | None = None  # total, and how many n-grams occur once, twice, more often, by context
    before: Table | None = None  # counts in this order, where it is not the highest
    discounts: tuple[float, float, float] = FALLBACK

    def row_edges(self) -> np.ndarray:
        return edges_of(self.contexts, self.side)

    def column_edges(self) -> np.ndarray:
        return edges_of(self.words, self.side)

    def margin_edges(self) -> np.ndarray:
        return edges_of(self.contexts, self.side**2)

    def cells(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each n-gram, and its key there."""
        rows, columns = self.row_edges(), self.column_edges()
        row, column = np.searchsorted(rows, context, side="right") - 1, np.searchsorted(columns, word, side="right") - 1
        key = (context - rows[row]) * np.diff(columns)[column] + (word - columns[column])
        return row * self.side + column, key.astype(np.uint64)

    def context_of(self, cell: int, keys: np.ndarray) -> np.ndarray:
        """Contexts of the keys of a cell, from the first of its row on."""
        column = self.column_edges()[cell % self.side : cell % self.side + 2]
        return keys // np.uint64(column[1] - column[0])

    def find(self, maps: Maps, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Ids of n-grams; -1 where context or word are -1 or the n-gram is unknown."""
        out = np.full(len(context), -1, np.int64)
        known = np.flatnonzero((context >= 0) & (word >= 0))
        if not len(known) or not self.table.size:
            return out
        cell, key = self.cells(context[known], word[known])
        order = np.lexsort((key, cell))
        cuts = np.searchsorted(cell[order], np.arange(self.side**2 + 1))
        for c in np.flatnonzero(np.diff(cuts)):
            keys = self.table.part(maps, int(c), "key", "u8")
            if len(keys):
                mine = order[cuts[c] : cuts[c + 1]]
                at = np.minimum(np.searchsorted(keys, key[mine]), len(keys) - 1)
                hit = keys[at] == key[mine]
                out[known[mine[hit]]] = self.table.starts[c] + at[hit]
        return out


@dataclass(frozen=True)
class Model:
    path: str
    vocabulary: Vocabulary
    grams: tuple[Grams, ...]  # bigrams and longer
    before: Table  # of words: distinct words before them
    side: int
    pairs: int  # distinct bigrams
    word_discounts: tuple[float, float, float]
    spread: float  # weight of the uniform distribution in p(w)


def count_words(texts: DataFrame, path: str, bits: int) -> Vocabulary:
    parts = 2**bits

    def pack(batches):
        for tokens, _ in _runs(batches):
            words, counts = _counted(tokens)
            cuts = np.searchsorted(_top(words, bits), np.arange(parts + 1))
            yield from _packed_batches((p, _pack(words[a:b], counts[a:b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a)

    def finish(part, sums, writer):
        words, counts = sums.result()
        writer.add("hash", words)
        writer.add("count", counts)
        yield _numbers(part, [len(words), counts.sum()])

    merged = _by_part(texts.mapInArrow(pack, "part int, blob binary"), parts).mapInArrow(
        _merging(f"{path}/words", parts, lambda part: Sums(), lambda part, sums, blob: sums.add(*blob), finish), "part int, numbers array<long>"
    )
    found = {r.part: r.numbers for r in written(merged, "kn-words").collect()}  # a row per part
    return Vocabulary(_table(f"{path}/words", parts, {p: n for p, (n, _) in found.items()}), sum(t for _, t in found.values()))


def token_ids(maps: Maps, words: Vocabulary, grams: list[Grams], tokens: np.ndarray, starts: np.ndarray) -> tuple[list, list, tuple]:
    """Of tokens: ids of the n-grams that end there, by length, and of their contexts, from bigrams on
    to one length more than ``grams`` has; and the distinct words' ids with their places."""
    distinct, inverse = np.unique(tokens, return_inverse=True)
    known = words.ids(maps, distinct)
    ids, contexts = [known[inverse]], []
    for lower in [words, *grams]:
        context = np.empty_like(ids[0])
        context[1:] = ids[-1][:-1]
        context[starts] = lower.size if lower is words else lower.table.size  # the start marks
        contexts.append(context)
        if len(contexts) <= len(grams):
            ids.append(grams[len(contexts) - 1].find(maps, context, ids[0]))
    return ids, contexts, (known, inverse)


def count_grams(texts: DataFrame, words: Vocabulary, lower: list[Grams], path: str, side: int, top: bool) -> tuple[Grams, Table, list[int]]:
    """The n-grams one longer than ``lower`` has, the counts that gives to the lower order, and
    ``_levels`` of these."""
    length, v = len(lower) + 2, words.size
    below = lower[-1].table if lower else None
    grams = Grams(Table("", 1, np.zeros(1)), (below.size if lower else v) + 1, v, side)
    cells = side**2
    suffix_edges = below.starts if lower else edges_of(v, cells)
    name = f"{path}/grams-{length}"
    row_edges, column_edges = grams.row_edges(), grams.column_edges()

    def pack(batches):
        maps = Maps()
        for tokens, starts in _runs(batches):
            ids, contexts, _ = token_ids(maps, words, lower, tokens, starts)
            cell, key = grams.cells(contexts[-1], ids[0])
            order = np.argsort(cell.astype(np.uint16) if cells <= 1 << 16 else cell, kind="stable")
            key, cuts = key[order], np.searchsorted(cell[order], np.arange(cells + 1))
            suffix = ids[-1][order].astype(np.uint64) if lower else None
            for c in np.flatnonzero(np.diff(cuts)):
                mine = slice(cuts[c], cuts[c + 1])
                if lower:  # and which shorter n-gram it ends with; of a bigram, that is the word itself
                    keys, first, counts = np.unique(key[mine], return_index=True, return_counts=True)
                    more = [suffix[mine][first]]
                else:
                    (keys, counts), more = _counted(key[mine]), []
                yield from _packed_batches([(int(c), _pack(np.diff(keys, prepend=np.uint64(0)), counts, *more))])

    def add(part, sums, blob):
        # The suffix of a key is the same wherever it comes from: summed with its number of times.
        keys = np.cumsum(blob[0], dtype=np.uint64)
        sums.add(keys, *blob[1:2], *([blob[2], np.ones(len(keys), np.uint64)] if lower else []))

    def finish(cell, sums, writer):
        keys, counts, *more = sums.result()
        writer.add("key", keys)
        writer.add("count", _as_counts(counts))
        suffix = more[0] // more[1] if lower else keys % np.uint64(np.diff(column_edges)[cell % side]) + np.uint64(column_edges[cell % side])
        ends, times = _counted(suffix)
        part = np.searchsorted(suffix_edges, ends.astype(np.int64), side="right") - 1
        cuts = np.searchsorted(part, np.arange(cells + 1))
        rows = [(int(p), _pack(ends[a:b] - np.uint64(suffix_edges[p]), times[a:b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        if top:
            rows += [(cells + p, blob) for p, blob in _of_contexts(grams, cell, keys, counts)]
        yield pa.RecordBatch.from_pydict(
            {"part": [cell] + [p for p, _ in rows], "blob": [None] + [b for _, b in rows], "numbers": [[len(keys), *_levels(counts)]] + [None] * len(rows)},
            pa.schema([*_PACKED, *list(_SIZES)[1:]]),
        )

    packed = _by_part(texts.mapInArrow(pack, "part int, blob binary"), cells)
    merged = packed.mapInArrow(_merging(name, cells, lambda part: Sums(), add, finish), "part int, blob binary, numbers array<long>")
    merged = written(merged, "kn-grams")
    found = {r.part: r.numbers for r in merged.where("numbers IS NOT NULL").select("part", "numbers").collect()}  # a row per cell
    grams = Grams(_table(name, cells, {c: n[0] for c, n in found.items()}), grams.contexts, v, side)
    before, levels = _dense(merged.where(f"numbers IS NULL AND part < {cells}"), f"{path}/before-{length - 1}", suffix_edges, ("before",))
    if top:
        raw = np.sum([n[1:] for n in found.values()] or [[0] * 6], axis=0).tolist()
        rows = merged.where(f"part >= {cells}").select((F.col("part") - cells).alias("part"), "blob")
        grams = _with_margins(grams, rows, path, raw)
    return grams, before, levels


MARGINS = ("total", "once", "twice", "more")


def _of_contexts(grams: Grams, cell: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """What a cell adds to its contexts, by part of these: a row of cells has as many parts as cells."""
    level = np.minimum(counts, np.uint64(3))
    row, edges = cell // grams.side, grams.margin_edges()
    context = grams.context_of(cell, keys) + np.uint64(grams.row_edges()[row])
    context, *sums = _summed(context, counts.astype(np.uint64), *((level == k).astype(np.uint64) for k in (1, 2, 3)))
    for part in range(row * grams.side, (row + 1) * grams.side):
        a, b = np.searchsorted(context, edges[part : part + 2].astype(np.uint64))
        if b > a:
            yield part, _pack(context[a:b] - np.uint64(edges[part]), *(x[a:b] for x in sums))


def _with_margins(grams: Grams, rows: DataFrame, path: str, levels: list[int]) -> Grams:
    length = grams.table.path.rsplit("-", 1)[-1]
    margins, _ = _dense(rows, f"{path}/contexts-{length}", grams.margin_edges(), MARGINS)
    return Grams(grams.table, grams.contexts, grams.words, grams.side, margins, grams.before, discounts(levels[:4]))


def _dense(packed: DataFrame, path: str, edges: np.ndarray, kinds: tuple[str, ...]) -> tuple[Table, list[int]]:
    """Arrays by id from sums that come in by part, and ``_levels`` of the first of them."""
    parts = len(edges) - 1

    def start(part):
        return [np.zeros(int(edges[part + 1] - edges[part]), np.uint64) for _ in kinds]

    def add(part, arrays, blob):
        at = blob[0].astype(np.int64)  # each id once a blob
        for a, values in zip(arrays, blob[1:]):
            a[at] += values

    def finish(part, arrays, writer):
        for kind, a in zip(kinds, arrays):
            writer.add(kind, a if kind == "total" else _as_counts(a))
        yield _numbers(part, [len(arrays[0]), *_levels(arrays[0])])

    rows = _by_part(packed.select("part", "blob"), parts)
    done = written(rows.mapInArrow(_merging(path, parts, start, add, finish), "part int, numbers array<long>"), "kn-dense")
    found = {r.part: r.numbers for r in done.collect()}  # a row per part
    levels = np.sum([n[1:] for n in found.values()] or [[0] * 6], axis=0).tolist()
    return _table(path, parts, {p: n[0] for p, n in found.items()}), levels


def lower_margins(spark, grams: Grams, path: str, levels: list[int]) -> Grams:
    """The margins of a lower order, from its counts: distinct words before."""
    cells = grams.side**2

    def sums(batches):
        maps = Maps()
        for batch in batches:
            for cell in batch.column(0).to_pylist():
                keys = grams.table.part(maps, cell, "key", "u8")
                if len(keys):
                    counts = grams.before.part(maps, cell, "before", "u4").astype(np.uint64)
                    yield from _packed_batches(_of_contexts(grams, cell, keys, counts))

    each = spark.range(cells).repartition(min(cells, FILES), "id")
    return _with_margins(grams, each.mapInArrow(sums, "part int, blob binary"), path, levels)


def train(docs: DataFrame, keep: Column | None = None, order: int = 2) -> Model:
    """The model of the texts of ``docs`` (of the rows where ``keep`` holds)."""
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = docs.sparkSession
    python_workers(spark)
    texts = (docs if keep is None else docs.where(keep)).select(F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, size // PART_BYTES)
    bits = max(1, (int(parts).bit_length() + 1) // 2)
    path = shared_dir(spark, "kneser-ney")
    words = count_words(texts, path, 2 * bits)
    grams: list[Grams] = []
    for length in range(2, order + 1):
        longer, before, levels = count_grams(texts, words, grams, path, 2**bits, top=length == order)
        if grams:
            last = grams[-1]
            grams[-1] = lower_margins(spark, Grams(last.table, last.contexts, last.words, last.side, before=before), path, levels)
        else:
            of_words, word_levels = before, levels
        grams.append(longer)
    pairs, d = grams[0].table.size, discounts(word_levels[:4])
    spread = (d[0] * word_levels[0] + d[1] * word_levels[1] + d[2] * word_levels[4]) / pairs if pairs else 1.0
    return Model(path, words, tuple(grams), of_words, 2**bits, pairs, d, float(spread))


# Scoring ---------------------------------------------------------------------------------


class Reader:
    """Scores with the mapped arrays of a model, in a worker."""

    def __init__(self, model: Model):
        self.model, self.maps = model, Maps()

    def scores(self, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score, model score."""
        m, words, n = self.model, self.model.vocabulary, self.model.vocabulary.size
        ids, contexts, (distinct, inverse) = token_ids(self.maps, words, list(m.grams), tokens, starts)
        known, count, before = distinct >= 0, np.zeros(len(distinct)), np.zeros(len(distinct))
        count[known] = words.table.take(self.maps, "count", "u8", words.table.starts, distinct[known])
        before[known] = m.before.take(self.maps, "before", "u4", edges_of(n, m.side**2), distinct[known])
        base = np.log10((count + 1) / (words.tokens + n + 1))[inverse]
        p = ((discounted(before, m.word_discounts) / m.pairs if m.pairs else before) + m.spread / (n + 1))[inverse]
        for grams, context, found in zip(m.grams, contexts, ids[1:]):
            p = self.longer(grams, context, found, p)
        sums = lambda v: np.add.reduceat(np.asarray(v, float), starts)
        return np.diff(np.append(starts, len(tokens))), sums(ids[0] >= 0).astype(np.int64), sums(base), sums(np.log10(p))

    def longer(self, grams: Grams, context: np.ndarray, found: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Probabilities after a context, from those after the context without its first word."""
        if not grams.table.size:
            return p
        at = np.flatnonzero(context >= 0)
        distinct, inverse = np.unique(context[at], return_inverse=True)
        total, *levels = (grams.margins.take(self.maps, k, "u8" if k == "total" else "u4", grams.margin_edges(), distinct) for k in MARGINS)
        total, left = total[inverse], sum(d * n for d, n in zip(grams.discounts, levels))[inverse]
        seen = total > 0
        at, total, left = at[seen], total[seen], left[seen]
        out = p.copy()
        out[at] *= left / total
        have = found[at] >= 0
        kind, table = ("before", grams.before) if grams.before else ("count", grams.table)
        counts = table.take(self.maps, kind, "u4", grams.table.starts, found[at[have]])
        out[at[have]] += discounted(counts, grams.discounts) / total[have]
        return out


_READERS: dict[str, Reader] = {}


def reader(model: Model) -> Reader:
    """The reader of a model, kept while the worker scores with it."""
    if model.path not in _READERS:
        _READERS.clear()
        _READERS[model.path] = Reader(model)
    return _READERS[model.path]


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every row of ``docs`` (log10)."""
    python_workers(docs.sparkSession)

    def score(batches):
        read = reader(model)
        for batch in batches:
            found = [hashes(t) for t in batch.column("text").to_pylist()]
            if found:
                starts = np.cumsum([0, *map(len, found[:-1])])
                columns = read.scores(np.concatenate(found), starts)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
