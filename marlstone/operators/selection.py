"""Exact order statistics of large columns without a global sort.

A search looks for the value at one rank of one numeric expression. Two passes over
the table, whatever its size, leave few rows to look at: one takes a grid of
approximate percentiles, one counts the rows below each grid value next to a
wanted rank. What lies strictly between two of them, about two thousandths
of the rows per rank, is stored as a table of its own, and the rest of the search
reads only that: each round takes an approximate percentile on both sides of the wanted
rank, counts exactly, and goes on inside the bracket, until at most
``_FINAL_ROWS`` candidates per rank are left.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.session import stable

_GRID = 1_000
_ACCURACY = 10_000
_FINAL_ROWS = 20_000


@dataclass
class _Search:
    name: str  # which expression
    value: Column  # null where the row does not take part
    rank: int  # 1-based, ascending
    low: object = None  # candidates lie strictly between low and high
    high: object = None
    below: int = 0  # rows known to sort before every candidate
    inside: int = 0  # number of candidates
    found: object = None
    before: int = 0  # rows below the value found
    equal: int = 0  # rows that hold it

    def settle(self, value, before: int, equal: int) -> None:
        self.found, self.before, self.equal = value, before, equal

    def candidates(self) -> Column:
        return F.when(_between(self.value, self.low, self.high), self.value)


def _between(value: Column, low, high) -> Column:
    inside = value.isNotNull()
    if low is not None:
        inside = inside & (value > F.lit(low))
    if high is not None:
        inside = inside & (value < F.lit(high))
    return inside


def _one_row(df: DataFrame, exprs: Sequence[Column]) -> list:
    named = [e.alias(f"_{i}") for i, e in enumerate(exprs)]
    return list(df.agg(*named).first())


def _sharing(searches: list[_Search]) -> list[list[_Search]]:
    """Searches with the same candidates, which one digest or array can serve."""
    groups: dict = {}
    for s in searches:
        groups.setdefault((s.name, s.low, s.high), []).append(s)
    return list(groups.values())


def _narrow(df: DataFrame, searches: list[_Search]) -> None:
    """One round: every search loses all candidates outside its probes.

    The probes are data values, so even when they land badly at least their
    own rows are settled and the round makes progress.
    """
    margin = 2.0 / _ACCURACY
    groups = _sharing(searches)
    digests = []
    for group in groups:
        ends = []
        for s in group:
            centre = (s.rank - s.below) / s.inside
            ends += [max(0.0, centre - margin), min(1.0, centre + margin)]
        digests.append(F.percentile_approx(group[0].candidates(), ends, _ACCURACY))
    probes = []
    for group, values in zip(groups, _one_row(df, digests), strict=True):
        probes += [(s, values[2 * i], values[2 * i + 1]) for i, s in enumerate(group)]
    counts = []
    for s, low, high in probes:
        c = s.candidates()
        counts += [
            F.count_if(c < low),
            F.count_if(c == low),
            F.count_if((c > low) & (c < high)),
            F.count_if((c == high) & (c > low)),
        ]
    counts = _one_row(df, counts)
    for i, (s, low, high) in enumerate(probes):
        before, at_low, between, at_high = counts[4 * i : 4 * i + 4]
        rank = s.rank - s.below
        if rank <= before:
            s.high, s.inside = low, before
        elif rank <= before + at_low:
            s.settle(low, s.below + before, at_low)
        elif rank <= before + at_low + between:
            s.low, s.high = low, high
            s.below += before + at_low
            s.inside = between
        elif rank <= before + at_low + between + at_high:
            s.settle(high, s.below + before + at_low + between, at_high)
        else:
            settled = before + at_low + between + at_high
            s.low = high
            s.below += settled
            s.inside -= settled


def _finish(df: DataFrame, searches: list[_Search]) -> None:
    """Settle all searches on ``df``, which holds all their candidates."""
    while wide := [s for s in searches if s.found is None and s.inside > _FINAL_ROWS]:
        _narrow(df, wide)
    groups = _sharing([s for s in searches if s.found is None])
    if not groups:
        return
    # At most _FINAL_ROWS values per array; only the wanted entries come back.
    arrays = [F.sort_array(F.collect_list(g[0].candidates())).alias(f"a{i}") for i, g in enumerate(groups)]
    picks = []
    for i, group in enumerate(groups):
        for s in group:
            value = F.get(f"a{i}", F.lit(s.rank - s.below - 1))
            first = F.array_position(f"a{i}", value) - 1
            after = F.array_position(F.reverse(f"a{i}"), value) - 1
            picks.append(F.struct(value, first, F.size(f"a{i}") - first - after))
    found = iter(_one_row(df.agg(*arrays), [F.first(p) for p in picks]))
    for group in groups:
        for s in group:
            value, before, equal = next(found)
            s.settle(value, s.below + before, equal)


def find_ranks(
    df: DataFrame,
    values: Mapping[str, Column],
    wanted: Callable[[dict[str, int], list], Mapping[str, Iterable[int]]],
    extra: Sequence[Column] = (),
) -> dict[str, dict[int, tuple[object, int, int]]]:
    """(value, rows below it, rows that hold it) at 1-based ascending ranks of each named
    numeric expression.

    Nulls take no part. Where every expression has few values, the second pass reads them
    from ordered arrays and is the last. ``wanted`` names the ranks once the number of values of each
    expression and the ``extra`` aggregates are known; they come from the first pass.
    """
    values = dict(values)
    grid = [i / _GRID for i in range(_GRID + 1)]
    first = []
    for v in values.values():
        first += [F.count(v), F.percentile_approx(v, grid, _ACCURACY)]
    row = _one_row(df, [*first, *extra])
    sizes = {n: row[2 * i] for i, n in enumerate(values)}
    digests = {n: row[2 * i + 1] or [] for i, n in enumerate(values)}
    ranks = {n: sorted(set(r)) for n, r in wanted(sizes, row[2 * len(values) :]).items()}
    searches = []
    for name, own in ranks.items():
        for rank in own:
            if not 1 <= rank <= sizes[name]:
                raise ValueError(f"rank {rank} of {name} outside 1..{sizes[name]}")
            searches.append(_Search(name, values[name], rank, inside=sizes[name]))
    if not searches:
        return {name: {} for name in ranks}
    if all(s.inside <= _FINAL_ROWS for s in searches):
        _finish(df, searches)
        return _results(ranks, searches)
    probes = {name: _probes(digests[name], ranks[name], sizes[name]) for name in ranks}
    counts = []
    for name, own in probes.items():
        for p in own:
            counts += [F.count_if(values[name] < F.lit(p)), F.count_if(values[name] == F.lit(p))]
    counted = iter(_one_row(df, counts))
    known = {n: [(p, next(counted), next(counted)) for p in own] for n, own in probes.items()}
    for s in searches:
        _bracket(s, known[s.name])
    left = [s for s in searches if s.found is None]
    if left:
        # One column per expression, in as many rows as any of them has candidates.
        items = []
        for name in {s.name for s in left}:
            inside = F.lit(False)
            for s in left:
                if s.name == name:
                    inside = inside | _between(values[name], s.low, s.high)
            items.append((name, F.when(inside, values[name])))
        kept = df.select(*[v.alias(f"v{i}") for i, (_, v) in enumerate(items)]).na.drop("all")
        kept = stable(kept)
        for i, (name, _) in enumerate(items):
            for s in left:
                if s.name == name:
                    s.value = kept[f"v{i}"]
        _finish(kept, left)
    return _results(ranks, searches)


def _results(names: Iterable[str], searches: list[_Search]) -> dict[str, dict[int, tuple]]:
    out: dict[str, dict[int, tuple]] = {name: {} for name in names}
    for s in searches:
        out[s.name][s.rank] = (s.found, s.before, s.equal)
    return out


def _probes(digest: list, ranks: Sequence[int], size: int) -> list:
    """Sorted grid values next to the wanted ranks; a step more than the digest's error."""
    slack = 1 + 2 * _GRID / _ACCURACY
    found = set()
    for rank in ranks:
        at = rank / size * _GRID
        for end in (math.floor(at - slack), math.ceil(at + slack)):
            found.add(digest[min(max(end, 0), _GRID)])
    return sorted(found)


def _bracket(s: _Search, known: list[tuple[object, int, int]]) -> None:
    """Place a rank between two counted values, or at one of them."""
    # Rows up to and including each value.
    at = bisect_left([below + equal for _, below, equal in known], s.rank)
    if at < len(known):
        value, below, equal = known[at]
        if s.rank > below:
            s.settle(value, below, equal)
            return
        s.high, s.inside = value, below
    if at:
        value, below, equal = known[at - 1]
        s.low, s.below = value, below + equal
        s.inside -= s.below


def select_ranks(
    df: DataFrame, values: Mapping[str, Column], ranks: Mapping[str, Iterable[int]]
) -> dict[str, dict[int, object]]:
    """The values at the given 1-based ascending ranks of each named expression.

    Nulls and NaN take no part. Ranks must lie within the number of values.
    """
    exprs = {n: F.when(~F.isnan(v.cast("double")), v) for n, v in values.items()}
    found = find_ranks(df, exprs, lambda sizes, _: ranks)
    return {n: {r: v for r, (v, *_) in own.items()} for n, own in found.items()}


def _around(size: int, p: float) -> tuple[int, int, float]:
    """Ranks on both sides of a linear-interpolation percentile, and the way between."""
    position = (size - 1) * p
    return math.floor(position) + 1, math.ceil(position) + 1, position - math.floor(position)


def interpolated_percentiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]]
) -> dict[str, list[float | None]]:
    """Exact linear-interpolation percentiles per column (null for an empty column)."""
    return percentiles_of(df, {c: F.col(c) for c in wanted}, wanted)[0]


def percentiles_of(
    df: DataFrame,
    values: Mapping[str, Column],
    wanted: Mapping[str, Sequence[float]],
    extra: Sequence[Column] = (),
) -> tuple[dict[str, list[float | None]], list]:
    """``interpolated_percentiles`` of named expressions, and the ``extra`` aggregates, all
    in the same passes."""
    exprs = {c: v.cast("double") for c, v in values.items()}
    exprs = {c: F.when(~F.isnan(e), e) for c, e in exprs.items()}
    seen: dict[str, int] = {}
    others: list = []

    def ranks(sizes: dict[str, int], found: list) -> dict[str, list[int]]:
        seen.update(sizes)
        others.extend(found)
        return {
            c: [r for p in wanted[c] for r in _around(n, p)[:2]] for c, n in sizes.items() if n
        }

    values = find_ranks(df, exprs, ranks, extra)
    out: dict[str, list[float | None]] = {}
    for c, probabilities in wanted.items():
        out[c] = [None] * len(probabilities)
        for i, p in enumerate(probabilities if seen.get(c) else ()):
            lower, upper, way = _around(seen[c], p)
            low, high = values[c][lower][0], values[c][upper][0]
            out[c][i] = low + (high - low) * way
    return out, others


def exact_median(df: DataFrame, col: str) -> float | None:
    return interpolated_percentiles(df, {col: [0.5]})[col][0]


#: Bytes of a text that are compared as one number.
_PREFIX = 7


@dataclass
class Tie:
    """The ``rank``-th smallest tie among the ``size`` rows for which ``rows`` holds."""

    rows: Column
    size: int
    rank: int
    found: object = None


def find_ties(df: DataFrame, tie: Column, wanted: Sequence[Tie], is_text: bool) -> None:
    """Settle all ``wanted`` ties in the same passes.

    Few rows are read into ordered arrays, in one pass for all. Of the large groups the
    rows are stored once; numbers are searched there like any value, texts by their bytes,
    ``_PREFIX`` at a time: texts that begin alike are searched again by what follows.
    """
    large = [w for w in wanted if w.size > _FINAL_ROWS]
    if large:
        # A column for each group, as the groups of two searches may be the same.
        own = [w.rows.alias(f"in{i}") for i, w in enumerate(large)]
        held = df.select(*own, tie.alias("tie")).where(reduce(or_, [F.col(f"in{i}") for i in range(len(large))]))
        held = stable(held)
        left = [(w, Tie(F.col(f"in{i}"), w.size, w.rank)) for i, w in enumerate(large)]
        at, ended = 0, []
        while wide := [x for _, x in left if x.size > _FINAL_ROWS and x.found is None]:
            if not is_text:
                number = F.col("tie")
            else:
                part = F.substring(F.encode(F.col("tie").cast("string"), "utf-8"), at * _PREFIX + 1, _PREFIX)
                whole = F.rpad(F.hex(part), 2 * _PREFIX, "0")
                # Where nothing follows, the text comes first.
                number = F.when(F.length(part) == 0, F.lit(-1)).otherwise(F.conv(whole, 16, 10).cast("long"))
            found = find_ranks(
                held,
                {str(i): F.when(x.rows, number) for i, x in enumerate(wide)},
                lambda *_, wide=wide: {str(i): [x.rank] for i, x in enumerate(wide)},
            )
            for i, x in enumerate(wide):
                value, below, equal = found[str(i)][x.rank]
                if not is_text:
                    x.found = value
                    continue
                x.rows, x.rank, x.size = x.rows & (number == value), x.rank - below, equal
                if value == -1:
                    # Nothing but one text.
                    x.size = 0
                    ended.append(x)
            at += 1
        _pick_ties(held, F.col("tie"), [x for _, x in left if x.found is None and x.size], ended)
        for w, x in left:
            w.found = x.found
    _pick_ties(df, tie, [w for w in wanted if w.size <= _FINAL_ROWS], [])


def _pick_ties(df: DataFrame, tie: Column, few: Sequence[Tie], same: Sequence[Tie]) -> None:
    """Read ties from ordered arrays of few rows, or of rows that are all the same."""
    if not few and not same:
        return
    picks = [F.get(F.sort_array(F.collect_list(F.when(w.rows, tie))), F.lit(w.rank - 1)) for w in few]
    picks += [F.min(F.when(w.rows, tie)) for w in same]
    for w, value in zip([*few, *same], _one_row(df, picks), strict=True):
        w.found = value
