"""Scalar building blocks. Every one is a built-in expression; none is a Python UDF."""

from tidemark.functions.arrays import parse_tags, tags_literal, unzip_columns
from tidemark.functions.numbers import clamp, is_strict_number, page_count, strict_double, to_fixed
from tidemark.functions.text import composite_key, error_text, or_unknown, tokens
from tidemark.functions.times import age_seconds, iso_millis, micros, truncate_millis

__all__ = [
    "age_seconds",
    "clamp",
    "composite_key",
    "error_text",
    "is_strict_number",
    "iso_millis",
    "micros",
    "or_unknown",
    "page_count",
    "parse_tags",
    "strict_double",
    "tags_literal",
    "to_fixed",
    "tokens",
    "truncate_millis",
    "unzip_columns",
]
