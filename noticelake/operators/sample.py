"""Uniform samples that can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_key(seed: int, key: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def sample(rows: DataFrame, n: int, key: str = "url", seed: int = 0) -> DataFrame:
    """Exactly n rows without replacement (all, if there are fewer), the same for the same seed."""
    if n <= 0:
        raise ValueError("the sample's size must be positive")
    return rows.orderBy(sample_key(seed, F.col(key)), key).limit(n)


def sample_boards(boards: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n documents of all boards, grouped into boards again."""
    from noticelake.operators.nest import flatten, regroup

    return regroup(sample(flatten(boards), n, "url", seed))
