"""Ordered per-key operators that do not depend on the size of any one key.

A window partitioned by the key alone would send a key with a third of all
rows to one task. Here the rows are range-partitioned by (key, order), so a
large key is spread over many *blocks*; the windows run within (block, key)
and whatever a block needs from earlier blocks is carried over in a table with
at most one line per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.session import stable

_BLOCK = "_block"
_KEY = "_key"


def _blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with a block number that grows along (keys, order).

    Stored, because the range bounds are sampled and must not change between
    the jobs that read the blocks.
    """
    placed = df.repartitionByRange(*keys, *order)
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    return stable(placed.withColumn(_BLOCK, F.spark_partition_id()).withColumn(_KEY, key))


def _last_keys(blocks: DataFrame) -> DataFrame:
    """The last key of every block: the only one that can go on in the next block."""
    return blocks.groupBy(_BLOCK).agg(F.max(_KEY).alias("_last"))


def _handed_on(per_block: DataFrame, carried: str) -> DataFrame:
    """Move each block's carried value to the block after it.

    ``per_block`` has one line per block, so this single-partition window and
    the broadcast are bounded by the number of partitions, not by the data.
    """
    following = Window.orderBy(_BLOCK)
    moved = per_block.select(
        _BLOCK,
        F.lag("_last").over(following).alias("_from_key"),
        F.lag(carried).over(following).alias(carried),
    )
    return F.broadcast(moved)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, out: str
) -> DataFrame:
    """Inclusive running sum per key along ``order`` (unique within the key).

    With no keys the sum runs over the whole table.
    """
    blocks = _blocks(df.withColumn("_amount", amount), keys, order)
    last = _last_keys(blocks)
    totals = (
        blocks.join(F.broadcast(last), _BLOCK)
        .where(F.col(_KEY).eqNullSafe(F.col("_last")))
        .groupBy(_BLOCK, "_last")
        .agg(F.sum("_amount").alias("_total"))
    )
    # One line per block from here on.
    upto = Window.partitionBy("_last").orderBy(_BLOCK)
    carried = _handed_on(totals.withColumn("_carry", F.sum("_total").over(upto)), "_carry")
    within = Window.partitionBy(_BLOCK, _KEY).orderBy(*order)
    local = F.sum("_amount").over(within.rowsBetween(Window.unboundedPreceding, 0))
    carry = F.when(F.col(_KEY).eqNullSafe(F.col("_from_key")), F.col("_carry"))
    total = blocks.withColumn("_local", local).join(carried, _BLOCK, "left")
    total = total.withColumn(out, F.col("_local") + F.coalesce(carry, F.lit(0)))
    return total.drop(_BLOCK, _KEY, "_amount", "_local", "_from_key", "_carry")


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "row_number"
) -> DataFrame:
    """Position of each row within its key (1-based); ``order`` is unique per key."""
    return running_total(df, keys, order, F.lit(1).cast("long"), out)


def previous_values(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    length: int,
    out: str,
) -> DataFrame:
    """Array of up to ``length`` values before each row of its key, oldest first."""
    blocks = _blocks(df.withColumn("_value", F.struct(F.col(value).alias("v"))), keys, order)
    last = _last_keys(blocks)
    backwards = Window.partitionBy(_BLOCK, _KEY).orderBy(*[F.desc(c) for c in order])
    # At most ``length`` rows per block.
    tails = (
        blocks.join(F.broadcast(last), _BLOCK)
        .where(F.col(_KEY).eqNullSafe(F.col("_last")))
        .withColumn("_from_end", F.row_number().over(backwards))
        .where(F.col("_from_end") <= length)
    )
    along = Window.partitionBy("_last").orderBy(_BLOCK, F.desc("_from_end"))
    history = F.collect_list("_value").over(along.rowsBetween(-(length - 1), 0))
    ends = tails.withColumn("_tail", history).where(F.col("_from_end") == 1)
    carried = _handed_on(ends.select(_BLOCK, "_last", "_tail"), "_tail")
    within = Window.partitionBy(_BLOCK, _KEY).orderBy(*order)
    local = F.collect_list("_value").over(within.rowsBetween(-length, -1))
    tail = F.when(F.col(_KEY).eqNullSafe(F.col("_from_key")), F.col("_tail"))
    # An empty array of the right type where nothing is handed on.
    joined = blocks.withColumn("_local", local).join(carried, _BLOCK, "left")
    both = F.concat(F.coalesce(tail, F.slice("_local", 1, 0)), F.col("_local"))
    kept = F.slice(both, F.greatest(F.size(both) - length + 1, F.lit(1)), F.lit(length))
    joined = joined.withColumn(out, F.transform(kept, lambda x: x["v"]))
    return joined.drop(_BLOCK, _KEY, "_value", "_local", "_from_key", "_tail")


def gap_days(
    df: DataFrame, key: str, ts: str, ties: Sequence[str], out: str = "gap_days"
) -> DataFrame:
    """Days since the previous row of the key; null on the first row."""
    seen = previous_values(df, [key], [ts, *ties], ts, 1, "_previous")
    gap = F.datediff(ts, F.try_element_at("_previous", F.lit(1)))
    return seen.withColumn(out, gap).drop("_previous")


def avg_rank(df: DataFrame, key: str, col: str, out: str = "avg_rank") -> DataFrame:
    """Rank within the key where equal values share their mean rank; null for null."""
    # Ties collapse to one line each before anything is ordered.
    counts = df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(counts, [key], [col], F.col("_n"), "_upto")
    ranks = upto.select(key, col, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(out))
    return df.join(ranks, [key, col], "left")


def lag_sequences(
    df: DataFrame, series: str, ts: str, value: str, length: int = 10
) -> DataFrame:
    """(series, ts, lags, y): the ``length`` values before each value, oldest first.

    Rows with a null value are dropped first; rows with a shorter history have
    no sequence. ``ts`` is unique within the series.
    """
    known = df.where(F.col(value).isNotNull()).select(series, ts, value)
    lagged = previous_values(known, [series], [ts], value, length, "lags")
    full = lagged.where(F.size("lags") == length)
    return full.select(series, ts, "lags", F.col(value).alias("y"))


def split_chronological(
    df: DataFrame, series: str, ts: str, fraction: float = 0.2, out: str = "is_test"
) -> DataFrame:
    """Flag the last ``ceil(fraction * count)`` rows of each series as test rows."""
    counts = df.groupBy(F.col(series).alias("_series")).agg(F.count(F.lit(1)).alias("_rows"))
    same = F.col(series).eqNullSafe(F.col("_series"))
    placed = row_numbers(df, [series], [ts], "_position").join(counts, same, "left").drop("_series")
    train = F.col("_rows") - F.ceil(F.col("_rows") * fraction)
    return placed.withColumn(out, F.col("_position") > train).drop("_position", "_rows")
