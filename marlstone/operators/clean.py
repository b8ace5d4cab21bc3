"""Row filters, fills and imputers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.numbers import product
from marlstone.operators.profile import mode_of
from marlstone.operators.selection import exact_median


def with_product(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, product(*[F.col(c) for c in cols]))


def history_as_of(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """Rows up to and including the cut-off."""
    return df.where(F.col(ts) <= F.lit(cutoff))


def between_dates(df: DataFrame, ts: str, low, high) -> DataFrame:
    """Rows within the closed range."""
    return df.where(F.col(ts).between(F.lit(low), F.lit(high)))


def drop_outliers(df: DataFrame, col: str, low=None, high=None) -> DataFrame:
    """Keep rows within the bounds; rows without a value stay."""
    keep = F.lit(True)
    if low is not None:
        keep = keep & (F.col(col) >= low)
    if high is not None:
        keep = keep & (F.col(col) <= high)
    return df.where(keep | F.col(col).isNull())


def drop_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(cols) if cols else None)


def fill_constants(df: DataFrame, values: Mapping | float) -> DataFrame:
    """Per-column constants, or one number for all numeric columns."""
    return df.na.fill(dict(values) if isinstance(values, Mapping) else values)


def impute_median(df: DataFrame, col: str) -> DataFrame:
    """Nulls become the exact median of the column."""
    median = exact_median(df, col)
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(median).cast("double")))


def impute_mode(df: DataFrame, col: str, sentinel: str | None = None) -> DataFrame:
    """The sentinel (or null, where none is named) becomes the most frequent value.

    As in the text-book recipe the sentinel itself takes part in the count.
    """
    mode = mode_of(df, col).scalar()
    missing = F.col(col).isNull() if sentinel is None else F.col(col) == sentinel
    return df.withColumn(col, F.when(missing, mode).otherwise(F.col(col)))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Everything but ids, targets and other excluded columns (missing names are fine)."""
    return df.drop(*exclude)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    numeric = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, numeric) and f.name not in exclude]
