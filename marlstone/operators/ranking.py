"""Global deciles, tails and top-k of a score, without a one-task window."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.selection import Tie, find_ranks, find_ties


@dataclass(frozen=True)
class _Order:
    """A total order of rows: class of the score (null, value, NaN), score, key."""

    kind: Column
    value: Column  # 0 where the score is no number
    tie: Column
    key: str

    @classmethod
    def of(cls, score: str, key: str, descending: bool) -> _Order:
        """As Spark sorts: ascending null, numbers, NaN; descending the other way round."""
        s = F.col(score).cast("double")
        nan, null = (0, 2) if descending else (2, 0)
        kind = F.when(s.isNull(), null).when(F.isnan(s), nan).otherwise(1)
        signed = -s if descending else s
        return cls(kind, F.when(kind == 1, signed).otherwise(F.lit(0.0)), F.col(key), key)

    def after(self, kind: int, value: float, tie) -> Column:
        same = (self.kind == kind) & (self.value == value)
        beyond = (self.kind > kind) | ((self.kind == kind) & (self.value > value))
        return beyond | (same & F.coalesce(self.tie > F.lit(tie), F.lit(False)))


def _boundaries(
    df: DataFrame, order: _Order, positions: Callable[[int], list[int]]
) -> tuple[int, dict[int, tuple]]:
    """Number of rows, and (kind, value, key) of the rows at the positions wanted.

    One search finds the scores at all positions, one the keys among the rows that tie
    with them. Together at most five passes over ``df``: three for the scores, of which
    one stores the candidates between counted values, and two for the ties, of which
    one stores those of large groups; small tables take three.
    """
    counts: dict[int, int] = {}

    def ranks(sizes: dict[str, int], kinds: list) -> dict[str, list[int]]:
        counts.update({0: kinds[0], 1: sizes["score"], 2: kinds[1]})
        inner = [p - counts[0] for p in positions(sum(counts.values()))]
        return {"score": [r for r in inner if 0 < r <= counts[1]]}

    number = F.when(order.kind == 1, order.value)
    kinds = [F.count_if(order.kind == k) for k in (0, 2)]
    found = find_ranks(df, {"score": number}, ranks, kinds)["score"]
    total = sum(counts.values())
    places: dict[int, tuple[int, float]] = {}
    ties: dict[int, Tie] = {}
    for p in positions(total):
        kind, value, size, rank = 0, 0.0, counts[0], p
        if counts[0] < p <= counts[0] + counts[1]:
            value, below, size = found[p - counts[0]]
            kind, rank = 1, p - counts[0] - below
        elif p > counts[0]:
            kind, size, rank = 2, counts[2], p - counts[0] - counts[1]
        places[p] = (kind, value)
        ties[p] = Tie((order.kind == kind) & (order.value == value), size, rank)
    is_text = dict(df.dtypes)[order.key] in ("string", "binary")
    find_ties(df, order.tie, list(ties.values()), is_text)
    return total, {p: (*places[p], ties[p].found) for p in places}


def score_deciles(
    df: DataFrame, score: str, key: str, n: int = 10, out: str = "decile"
) -> DataFrame:
    """Equal-sized buckets 1..n, bucket 1 with the highest scores.

    Same result as ``ntile(n)`` over (score descending, key ascending): the
    first ``count % n`` buckets hold one row more; NaN scores come first, null
    scores last. ``key`` is a unique number or text without nulls.
    Only the n - 1 boundary rows are looked up; rows are then labelled by
    comparing with them, so nothing is sorted or moved.
    """
    order = _Order.of(score, key, descending=True)

    def ends(rows: int) -> list[int]:
        small, extra = divmod(rows, n)
        marks = {small * i + min(i, extra) for i in range(1, n)}
        return sorted(e for e in marks if 0 < e < rows)

    _, boundaries = _boundaries(df, order, ends)
    label = F.lit(1)
    for boundary in boundaries.values():
        label = label + order.after(*boundary).cast("int")
    return df.withColumn(out, label)


def score_tail(
    df: DataFrame, score: str, key: str, fraction: float = 0.1, side: str = "top"
) -> DataFrame:
    """The ``floor(fraction * count)`` rows with the highest or lowest scores.

    Rows are ordered by (score, key) ascending, null scores first and NaN last; the
    top tail is the end of that order. ``key`` is a unique number or text without nulls.
    """
    if side not in ("top", "bottom"):
        raise ValueError(f"unknown side: {side!r}")
    tails = _with_tails(df, score, key, fraction, {side})
    return tails.where(F.col("_tail") == side).drop("_tail")


def score_tails(
    df: DataFrame, score: str, key: str, fraction: float = 0.1, out: str = "side"
) -> DataFrame:
    """Both tails of ``score_tail`` in one table, told apart by ``out``: top or bottom.

    Both cuts come from the same search. Tails must not overlap.
    """
    if fraction > 0.5:
        raise ValueError("tails of more than a half overlap")
    tails = _with_tails(df, score, key, fraction, {"top", "bottom"})
    return tails.where(F.col("_tail").isNotNull()).withColumnRenamed("_tail", out)


def _with_tails(
    df: DataFrame, score: str, key: str, fraction: float, sides: set[str]
) -> DataFrame:
    """Add ``_tail``: top, bottom or null, for the wanted sides."""
    order = _Order.of(score, key, descending=False)

    def cuts(rows: int) -> dict[str, int]:
        size = math.floor(rows * fraction)
        return {"bottom": size, "top": rows - size}

    def inner(rows: int) -> list[int]:
        return sorted({at for side, at in cuts(rows).items() if side in sides and 0 < at < rows})

    rows, boundaries = _boundaries(df, order, inner)
    tail = F.lit(None).cast("string")
    for side, at in cuts(rows).items():
        if side not in sides or math.floor(rows * fraction) == 0:
            continue
        if at not in boundaries:
            own = F.lit(True)
        else:
            beyond = order.after(*boundaries[at])
            own = beyond if side == "top" else ~beyond
        tail = F.when(own, side).otherwise(tail)
    return df.withColumn("_tail", tail)


def top_k(df: DataFrame, col: str, k: int, key: str) -> DataFrame:
    """The k largest rows, ties by key; a partial top-k per task, then one merge."""
    return df.orderBy(F.desc(col), F.asc(key)).limit(k)
