"""Byte-level BPE encoding and decoding, long texts in overlapping chunks.

A text longer than ``CHUNK`` characters is dealt out as chunks that overlap. Where two
chunks overlap, both scans cut the text into pre-tokens, each from its own start, wherever
that falls. The pattern looks ahead but never back, so from the first position on which both
scans have a boundary they agree for good: there the chunks are stitched. An overlap always
reaches over the end of a run of non-space characters, which is a boundary of every scan (a
pre-token has white space at its start or is white space altogether); so a stitch always
exists. What lies between two stitches is then encoded by tiktoken's merges.

A chunk knows how many ids of its successor precede their stitch, so the ids of a document
are put together by slicing arrays. Chunks of one document may run on any executors. Decoding
concatenates the bytes of the ids.

Defined cases: a null text is empty; an empty text has no ids and decodes to no bytes; a
text without white space is one chunk. Repeated rows and null ids are kept row by row; ids may be
of any type. Other columns are neither read nor returned. An empty table gives none. Special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import python_workers, text_of

CHUNK = 1 << 14
#: How far before the next chunk a chunk's own scan is taken up again.
NEAR = 256
#: End of a run of non-space characters, in the pattern's own terms.
RUN_END = regex.compile(r"\S(?=\s)")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Encodes whole spans of text, or pre-tokens cut elsewhere."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.spans = tiktoken.Encoding("spans", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # One match is the whole piece: the merges are applied to a pre-token as it is.
        self.merges = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.spans.encode_ordinary(text), np.int32)

    def pieces(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.merges.encode_ordinary, pieces)), np.int32)

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def chunks_of(text: str, size: int = CHUNK) -> Iterator[tuple[str, int | None]]:
    """Chunks of a text, and where in each the next one starts (None in the last)."""
    at = 0
    least = size
    while True:
        end = RUN_END.search(text, least) if least < len(text) else None
        if end is None:
            yield text[at:], None
            return
        # The run ends at end.end(); one character more shows that it does.
        yield text[at : end.end() + 1], least - at
        at, least = least, max(least + size, end.end() + 1)


def encode_chunk(enc: Encoder, text: str, following: int | None) -> tuple[np.ndarray, int]:
    """Ids from the chunk's start to the stitch, and how many ids of the next chunk precede it."""
    if following is None:
        return enc.ids(text), 0
    # The last run that ends before the next chunk is a boundary of this chunk's own scan.
    ends = [m.end() for m in RUN_END.finditer(text, max(0, following - NEAR), following)]
    near = ends[-1] if ends else 0
    own = [near + s for s in enc.starts(text[near:])]
    after = [following + s for s in enc.starts(text[following:])]
    stitch = min(set(own) & set(after))
    cut = lambda starts: [text[a:b] for a, b in zip(starts, starts[1:]) if b <= stitch]
    head = enc.ids(text[:near])  # ends with a run, so its last pre-token does not depend on what follows
    return np.concatenate([head, enc.pieces(cut(own))]), len(enc.pieces(cut(after)))


def _ids_array(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.empty(0, np.int32)])))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``."""
    python_workers(docs.sparkSession)
    text = docs.select("doc_id", text_of().alias("text"))
    long = F.length("text") > chunk

    def short_ids(batches):
        enc = encoder(path, pattern)
        for b in batches:
            ids = [enc.ids(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _ids_array(ids)], ["doc_id", "ids"])

    def cut(batches):
        for b in batches:
            for row, doc, t in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                parts = list(chunks_of(t, chunk))
                for k in range(0, len(parts), 64):
                    some = parts[k : k + 64]
                    yield pa.RecordBatch.from_pydict(
                        {"row": [row] * len(some), "doc_id": [doc] * len(some), "k": range(k, k + len(some)),
                         "text": [p[0] for p in some], "following": [p[1] for p in some]},
                        cut_schema,
                    )

    def chunk_ids(batches):
        enc = encoder(path, pattern)
        for b in batches:
            done = [encode_chunk(enc, t, f) for t, f in zip(b.column("text").to_pylist(), b.column("following").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("k"), pa.array([n for _, n in done], pa.int32()), _ids_array([i for i, _ in done])],
                ["row", "doc_id", "k", "skip", "ids"],
            )

    kind = text.schema["doc_id"].dataType.simpleString()
    cut_schema = pa.schema([("row", pa.int64()), ("doc_id", to_arrow_type(text.schema["doc_id"].dataType)), ("k", pa.int32()), ("text", pa.string()), ("following", pa.int32())])
    parts = (
        text.where(long)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(cut, f"row long, doc_id {kind}, k int, text string, following int")
        .repartition("row", "k")
        .mapInArrow(chunk_ids, f"row long, doc_id {kind}, k int, skip int, ids array<int>")
        .groupBy("row", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("k", "skip", "ids"))).alias("parts"))
    )
    skipped = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.col("parts")[F.greatest(i - 1, F.lit(0))]["skip"])
    stitched = F.flatten(F.transform("parts", lambda p, i: F.slice(p["ids"], skipped(i) + 1, F.size(p["ids"]))))
    return text.where(~long).mapInArrow(short_ids, f"doc_id {kind}, ids array<int>").unionByName(parts.select("doc_id", stitched.alias("ids")))


def decoder(path: str):
    """A column function from ids to the bytes they stand for."""

    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        table = token_bytes(path)
        return pa.array([None if x is None else b"".join(map(table.__getitem__, x)) for x in ids.to_pylist()], pa.binary())

    return decode


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``bytes``, the concatenated bytes of ``ids``."""
    return encoded.withColumn("bytes", decoder(path)("ids"))
