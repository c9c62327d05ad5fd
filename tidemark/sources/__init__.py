"""Reading the source table: tables, cursors, pages."""

from tidemark.sources.cursor import (
    after_cursor,
    bounded_range,
    high_water,
    keyset_page,
    upto_cursor,
    watermark_page,
)
from tidemark.sources.numbering import numbered, page_plan
from tidemark.sources.tables import clustered_copy, jdbc_options, jdbc_table, parquet_table

__all__ = [
    "after_cursor",
    "bounded_range",
    "clustered_copy",
    "high_water",
    "jdbc_options",
    "jdbc_table",
    "keyset_page",
    "numbered",
    "page_plan",
    "parquet_table",
    "upto_cursor",
    "watermark_page",
]
