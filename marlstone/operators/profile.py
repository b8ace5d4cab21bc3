"""Table profiles: missing values, frequencies, shares, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.selection import percentiles_of


def count_missing(df: DataFrame) -> DataFrame:
    """One row with the null count of every column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def count_sentinel(df: DataFrame, sentinel: str = "NA") -> DataFrame:
    """One row with the count of a marker text in every column, in one pass."""
    # Compared as text: other types cannot be compared with the marker directly.
    hits = [F.count_if(F.col(c).cast("string") == sentinel).alias(c) for c in df.columns]
    return df.agg(*hits)


def normalize_sentinels(df: DataFrame, sentinels: Sequence[str]) -> DataFrame:
    """Marker texts in string columns become null."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(list(sentinels)), F.col(c)) for c in texts}
    )


def profile_schema(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null, row_count) per column, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count(c).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f.name).alias("non_null"),
                F.col("row_count"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select(F.inline(rows))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Frequency table, most frequent first, ties by value."""
    kept = df.where(F.col(col).isNotNull()) if dropna else df
    counts = kept.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last(col))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Share of every category in percent of all rows.

    Null rows count in the denominator but have no line of their own.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(col, "n", (F.col("n") / total * 100).alias("percent")).where(
        F.col(col).isNotNull()
    )


def compare_distributions(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Two distributions side by side; null where a category is absent on one side."""
    left = distribution(a, col).select(col, F.col("percent").alias("percent_a"))
    right = distribution(b, col).select(col, F.col("percent").alias("percent_b"))
    return left.join(right, col, "full_outer")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def summarize(
    df: DataFrame, cols: Sequence[str], segments: Mapping[str, Column] | None = None
) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max per column.

    With ``segments``, a condition by name, the same of the rows of each segment, in a
    first column ``segment``; all segments and columns share the passes. The quartiles
    interpolate and are found by narrowing value brackets (no sort of the table and no
    per-value buffer in one task); the other measures come from the first of their passes.
    """
    parts = [
        (f"{i}_{c}", name, c, F.col(c) if rows is None else F.when(rows, F.col(c)))
        for i, (name, rows) in enumerate((segments or {None: None}).items())
        for c in cols
    ]
    values = {part: value for part, _, _, value in parts}
    measures = [
        F.struct(
            F.count(v),
            F.avg(v).cast("double"),
            F.stddev_samp(v).cast("double"),
            F.min(v).cast("double"),
            F.max(v).cast("double"),
        )
        for v in values.values()
    ]
    quartiles, found = percentiles_of(df, values, dict.fromkeys(values, [0.25, 0.5, 0.75]), measures)
    schema = "column_name string, count long, mean double, stddev double, min double, max double"
    schema += ", q25 double, median double, q75 double"
    lines = [(c, *own, *quartiles[part]) for (part, _, c, _), own in zip(parts, found, strict=True)]
    if segments:
        schema = "segment string, " + schema
        lines = [(name, *line) for (_, name, _, _), line in zip(parts, lines, strict=True)]
    # One line per column and segment.
    return df.sparkSession.createDataFrame(lines, schema)


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """One row with the most frequent value (the smallest on ties), nulls ignored."""
    # Counted by groups and cut by a top-1, not by a buffer of all values.
    return value_counts(df, col).select(F.col(col).alias("mode")).limit(1)
