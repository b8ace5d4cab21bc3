"""File readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(
    spark: SparkSession,
    path: str,
    schema=None,
    sep: str = ",",
    null_values: Sequence[str] = (),
) -> DataFrame:
    """CSV with a header. Types come from ``schema``; without one they are inferred.

    Inference reads the file twice. The first null marker is handled by the
    reader, so that numeric columns may hold it; further ones in text columns.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if null_values:
        reader = reader.option("nullValue", null_values[0])
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(path)
    rest = list(null_values[1:])
    texts = [name for name, kind in df.dtypes if kind == "string"] if rest else []
    return df.withColumns({c: F.when(~F.col(c).isin(rest), F.col(c)) for c in texts})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_nested(
    spark: SparkSession,
    path: str,
    schema=None,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Nested records from JSON (with a schema) or parquet; pick and rename columns."""
    df = spark.read.schema(schema).json(path) if schema else spark.read.parquet(path)
    if columns:
        df = df.select(*[F.col(old).alias(new) for old, new in columns.items()])
    return df


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with headers, as a folder of part files written by the tasks themselves."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(tables: Mapping[str, DataFrame], path: str) -> None:
    """Each named table as JSON lines below ``path``."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as a table in ``buckets`` files by the hash of ``key``; returns the table.

    Tables with the same key and number of buckets are joined and grouped by the key
    without a shuffle. The rows are dealt before writing, so each bucket is one file,
    written by one task. ``path`` puts the files elsewhere than in the warehouse.
    """
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
