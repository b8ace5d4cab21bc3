"""Fitted column transforms: dummies, scalers, weights, label codes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.ordered import row_numbers


def learn_levels(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct values of a category column, which become columns of a plan.

    For categories of a known, short list; open ones are numbered with
    ``index_labels``, whose labels stay in the cluster.
    """
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def dummy_name(prefix: str, level: str) -> str:
    return f"{prefix}_{re.sub(r'[^0-9A-Za-z]+', '_', str(level)).strip('_')}"


def dummy_columns(
    col: Column, prefix: str, levels: Sequence[str], drop_first: bool
) -> dict[str, Column]:
    """0/1 column per level; unknown and null values are 0 everywhere."""
    used = list(levels)[1:] if drop_first else list(levels)
    return {
        dummy_name(prefix, level): F.coalesce((col == level).cast("int"), F.lit(0))
        for level in used
    }


def dummies(
    df: DataFrame,
    col: str,
    prefix: str,
    levels: Sequence[str] | None = None,
    drop_first: bool = False,
) -> DataFrame:
    """Replace a category column by its dummies (levels from ``df`` unless given)."""
    levels = learn_levels(df, col) if levels is None else levels
    return df.withColumns(dummy_columns(F.col(col), prefix, levels, drop_first)).drop(col)


@dataclass(frozen=True)
class Standardizer:
    """Column means and population deviations learned on one table."""

    parameters: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> Standardizer:
        stats = df.agg(*[F.struct(F.avg(c), F.stddev_pop(c)).alias(c) for c in cols]).first()
        return cls({c: (stats[c][0], stats[c][1]) for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        """A constant column is only centred."""
        return df.withColumns(
            {
                c: (F.col(c) - mean) / (deviation if deviation else 1.0)
                for c, (mean, deviation) in self.parameters.items()
            }
        )


@dataclass(frozen=True)
class MinMaxScaler:
    """Value range learned on one table; maps it to 0..1 and back."""

    low: float
    high: float

    @classmethod
    def fit(cls, df: DataFrame, col: str) -> MinMaxScaler:
        low, high = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
        return cls(low, high)

    @property
    def _range(self) -> float:
        return (self.high - self.low) or 1.0

    def scale(self, col: Column) -> Column:
        return (col - self.low) / self._range

    def inverse(self, col: Column) -> Column:
        return col * self._range + self.low


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight ``n / (classes * n_class)`` on every row; null labels are a class of their own."""
    counts = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n") / F.count(F.lit(1))).scalar()
    weights = counts.select("_class", (totals / F.col("_n")).alias(out))
    return df.join(weights, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")


def index_labels(df: DataFrame, col: str, out: str = "class_index") -> DataFrame:
    """Zero-based position of each label in alphabetical order; null for null.

    The distinct labels are numbered in range partitions and joined back, so their
    number doesn't matter.
    """
    labels = df.select(F.col(col).alias("_label")).where(F.col(col).isNotNull()).distinct()
    numbered = row_numbers(labels, [], ["_label"], "_number")
    codes = numbered.select("_label", (F.col("_number") - 1).cast("int").alias(out))
    return df.join(codes, F.col(col) == F.col("_label"), "left").drop("_label")


def index_by_frequency(
    train: DataFrame, df: DataFrame, col: str, out: str, handle_invalid: str = "error"
) -> DataFrame:
    """Add the zero-based place of each category by falling frequency in ``train`` (ties by value).

    The numbers of StringIndexer, for categories of any number: they are counted, numbered
    in range partitions and joined back, and none of them reaches the driver. Categories
    that ``train`` lacks, nulls too, fail the query (``error``), get the number after the
    last (``keep``) or lose their rows (``skip``).
    """
    if handle_invalid not in ("error", "keep", "skip"):
        raise ValueError(f"unknown handling: {handle_invalid!r}")
    counts = train.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_label")).agg(
        (-F.count(F.lit(1))).alias("_rarity")
    )
    numbered = row_numbers(counts, [], ["_rarity", "_label"], "_number")
    codes = numbered.select("_label", (F.col("_number") - 1).cast("double").alias(out))
    same = F.col(col) == F.col("_label")
    if handle_invalid == "skip":
        return df.join(codes, same).drop("_label")
    if handle_invalid == "keep":
        other = codes.agg(F.count(F.lit(1)).cast("double")).scalar()
    else:
        unknown = F.concat(F.lit(f"unknown {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("null")))
        other = F.raise_error(unknown).cast("double")
    joined = df.join(codes, same, "left").drop("_label")
    return joined.withColumn(out, F.coalesce(out, other))
