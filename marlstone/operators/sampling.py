"""Splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_random(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def split_by_key(df: DataFrame, key: str, train_percent: int, seed: int = 0) -> list[DataFrame]:
    """(train, test) by a hash of the key: the same rows whatever the partitioning."""
    slot = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100))
    return [df.where(slot < train_percent), df.where(slot >= train_percent)]


def split_by_modulo(df: DataFrame, key: str, train_percent: int) -> list[DataFrame]:
    """(train, test) by the last digits of a numeric key; easy to repeat in SQL."""
    slot = F.pmod(F.col(key), F.lit(100))
    return [df.where(slot < train_percent), df.where(slot >= train_percent)]


def sample_n(df: DataFrame, n: int, seed: int, keys: Sequence[str] = ()) -> DataFrame:
    """n rows without replacement, those with the smallest hash of the keys (all columns).

    The same rows whatever the partitioning; each task keeps at most n of its own.
    """
    draw = F.xxhash64(F.lit(seed), *[F.col(c) for c in (keys or df.columns)])
    return df.orderBy(draw, *df.columns).limit(n)
