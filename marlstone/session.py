"""Session helpers: the shared scratch folder and stored intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    Without that setting, a folder below the warehouse; there a local path is
    refused unless the master is local, because executors on other machines
    would write to disks of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    is_local = master == "local" or master.startswith("local[")
    if not is_local and (root.startswith("file:") or "://" not in root):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; what is there goes when the driver's JVM ends."""
    path = f"{scratch_root(spark)}/marlstone-{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stable(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared scratch folder and read it from there.

    Used where several jobs must see exactly the same rows (range-partitioned
    blocks, tables that models iterate over), also after an executor is lost.
    Parquet, so that each reader takes only its columns and Spark knows the size
    of the table.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
