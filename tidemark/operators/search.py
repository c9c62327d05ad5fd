"""Filtered, paged search over the documents of the current state."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.sources.cursor import after_cursor

# Fixed value: the page size if none is asked for.
PAGE_DEFAULT = 25
ORDER = ("updated_at", "id")


def text_match(query: str) -> Column:
    """Any word of the name, the whole e-mail, or the whole company."""
    words = tokens(F.lit(query))
    return (
        F.arrays_overlap(tokens(F.col("name")), words)
        | (F.col("email") == query)
        | (F.col("company") == query)
    )


def matches(q: str | None = None, status: str | None = None, country: str | None = None) -> Column:
    """All given clauses must hold; without any, every document matches."""
    clauses = []
    if status:
        clauses.append(F.col("status") == status)
    if country:
        clauses.append(F.col("country") == country)
    if q:
        clauses.append(text_match(q))
    return reduce(and_, clauses, F.lit(True))


def search(docs: DataFrame, **clauses: str | None) -> DataFrame:
    return docs.where(matches(**clauses))


def search_page(
    docs: DataFrame, page: int = 1, limit: int = PAGE_DEFAULT, **clauses: str | None
) -> DataFrame:
    """One page of hits, newest first, ties by id.

    Plans as a top-k of ``page * limit`` rows per task, so a page costs what lies before
    it; :func:`search_after` goes on from any row at constant cost.
    """
    hits = search(docs, **clauses).orderBy(F.desc("updated_at"), "id")
    return hits.offset((page - 1) * limit).limit(limit)


def search_after(
    docs: DataFrame, updated_micros: int, last_id: int, limit: int = PAGE_DEFAULT, **clauses: str | None
) -> DataFrame:
    """The page that follows the hit ``(updated_at, id)``."""
    rest = after_cursor(docs, ORDER, (updated_micros, last_id), descending=["updated_at"])
    hits = search(docs, **clauses).where(rest)
    return hits.orderBy(F.desc("updated_at"), "id").limit(limit)


def search_total(docs: DataFrame, **clauses: str | None) -> DataFrame:
    """The exact number of hits."""
    return search(docs, **clauses).agg(F.count(F.lit(1)).alias("total"))
