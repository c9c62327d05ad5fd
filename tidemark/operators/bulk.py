"""Loading helpers: the reference pool and reproducible samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reference_pool(items: DataFrame, codes: DataFrame, floor: Column, code: str) -> DataFrame:
    """Items that pass ``floor`` and whose code is known.

    No broadcast hint: the planner broadcasts the code list when its size allows.
    """
    return items.where(floor).join(codes, code)


def sample_rows(df: DataFrame, k: int, seed: int, key: str = "id") -> DataFrame:
    """``k`` rows chosen by a seeded hash of the key: random-looking, yet repeatable.

    A bottom-k, so each task keeps ``k`` rows and nothing is sorted as a whole.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(draw, key).limit(k)
