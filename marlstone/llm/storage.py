"""Row positions that never gather a group in one task, and small Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.session import stable as store

__all__ = ["arrow_rows", "store", "with_position"]


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within the block, Arrow batches hold at most ``rows`` rows.

    For wide rows whose plan is executed within the block.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_position(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """Each row's 0-based position in its group by ``order``, gapless.

    Range partitions of (groups, order) split a hot group over many tasks; a
    position is the row's number within its partition plus the rows of the
    group in earlier partitions. ``groups`` must not be null. Rows that tie in
    all of ``order`` take their positions in any order.
    """
    ranged = store(
        df.repartitionByRange(*[F.col(c) for c in (*groups, *order)]).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    keys = [*groups, "_part"]
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per partition and group.
    offsets = (
        ranged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    within = Window.partitionBy(*keys).orderBy(*order)
    return (
        ranged.withColumn("_number", F.row_number().over(within))
        .join(offsets, keys)
        .withColumn(name, F.col("_before") + F.col("_number") - 1)
        .drop("_part", "_number", "_before")
    )
