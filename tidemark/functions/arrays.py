"""Array literals and zipped column arrays."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tags_literal(tags: Column) -> Column:
    """``['vip', 'lead']`` to ``{vip,lead}``."""
    return F.concat(F.lit("{"), F.concat_ws(",", tags), F.lit("}"))


def parse_tags(literal: Column) -> Column:
    """``{vip,lead}`` to ``['vip', 'lead']``; ``{}`` is the empty array."""
    inner = F.regexp_replace(literal, r"^\{|\}$", "")
    return F.filter(F.split(inner, ","), lambda t: t != "")


def unzip_columns(
    df: DataFrame, arrays: Mapping[str, Column], keep: list[str], position: str | None = None
) -> DataFrame:
    """One row per array position, arrays read side by side; short arrays pad with NULL.

    Works inside each row, so there is no shuffle.
    """
    zipped = F.arrays_zip(*[c.alias(n) for n, c in arrays.items()])
    if position is None:
        exploded = df.select(*keep, F.explode(zipped).alias("_z"))
        return exploded.select(*keep, *[F.col("_z")[n].alias(n) for n in arrays])
    exploded = df.select(*keep, F.posexplode(zipped).alias(position, "_z"))
    return exploded.select(*keep, position, *[F.col("_z")[n].alias(n) for n in arrays])
