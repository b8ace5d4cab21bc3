"""Group statistics, one-row-per-key picks and alignments of groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_stats(df: DataFrame, key: str, stats: Mapping[str, Column]) -> DataFrame:
    """Every row with aggregates of its key.

    An aggregate with map-side combine and a join back: unlike a window
    partitioned by the key, a key with very many rows is combined in every map
    task and its rows can be split over several join tasks. Adaptive execution
    measures the aggregate and broadcasts it where it is small.
    """
    grouped = df.groupBy(key).agg(*[c.alias(name) for name, c in stats.items()])
    return df.join(grouped, key, "left")


def with_group_count(df: DataFrame, key: str, counted: str, out: str) -> DataFrame:
    return with_group_stats(df, key, {out: F.count(counted)})


def with_group_mean(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    return with_group_stats(df, key, {out: F.avg(col)})


def latest_per_key(df: DataFrame, key: str, order: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest (order, ties) of each key.

    An aggregate over whole rows, so each map task sends one row per key.
    """
    return _pick(df, key, [order, *ties], F.max_by)


def first_per_key(df: DataFrame, key: str, order: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest (order, ties) of each key."""
    return _pick(df, key, [order, *ties], F.min_by)


def _pick(df: DataFrame, key: str, order: Sequence[str], by) -> DataFrame:
    row = F.struct(*df.columns)
    picked = df.groupBy(F.col(key).alias("_key")).agg(by(row, F.struct(*order)).alias("_row"))
    # The key itself, by which the result is partitioned, not its copy in the row.
    columns = {c: F.col("_key") if c == key else F.col("_row")[c] for c in df.columns}
    return picked.select(*[value.alias(c) for c, value in columns.items()])


def ratio_of_groups(
    df: DataFrame, key: str, numerator: Column, denominator: Column, out: str
) -> DataFrame:
    """Ratio of two aggregates per key; null where either is missing or the divisor is 0."""
    return df.groupBy(key).agg(F.try_divide(numerator, denominator).alias(out))


def order_by_total(df: DataFrame, category: str, count: str) -> DataFrame:
    """Rows of a count table with their category total, smallest category first.

    Null is a category like any other, and the first among equal totals.
    """
    totals = df.groupBy(F.col(category).alias("_category")).agg(F.sum(count).alias("total"))
    same = F.col(category).eqNullSafe(F.col("_category"))
    return df.join(totals, same, "left").drop("_category").orderBy("total", category)


def first_group(df: DataFrame, order: Sequence[str], group: str) -> DataFrame:
    """One row: the group of the first row in sort order."""
    return df.agg(F.min_by(group, F.struct(*order)).alias(group))


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)
