"""Counts of different values that can be stored and added up: sketches as columns.

Exact distinct counts cannot be merged; sketches of districts, days or runs can. HLL sketches are the smaller ones;
theta sketches also tell how many values two sets share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's size. The relative error is about 1.04 / sqrt(2^size) for HLL and 1 / sqrt(2^size) for theta.
SIZE = 12


def error_bound(size: int = SIZE, deviations: float = 4.0) -> float:
    """The relative error that estimates stay below, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (size / 2)


def sketched(rows: DataFrame, value: Column, *group: str, size: int = SIZE) -> DataFrame:
    """group, hll, theta, n: one row per group, to be stored."""
    key = value.cast("string")
    return rows.groupBy(*group).agg(F.hll_sketch_agg(key, size).alias("hll"), F.theta_sketch_agg(key, size).alias("theta"), F.count(F.lit(1)).alias("n"))


def added(stored: DataFrame, *group: str) -> DataFrame:
    """Stored sketches of finer groups as those of coarser ones."""
    return stored.groupBy(*group).agg(F.hll_union_agg("hll").alias("hll"), F.theta_union_agg("theta").alias("theta"), F.sum("n").alias("n"))


def different(hll: str = "hll") -> Column:
    return F.hll_sketch_estimate(hll)


def shared(a: str, b: str) -> Column:
    """How many values two theta sketches share."""
    return F.theta_sketch_estimate(F.theta_intersection(a, b))
