"""Numeric, labelling and array expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(col: Column) -> Column:
    """A number with all its decimals (up to twelve), whose sums do not depend on row order."""
    return col.cast("decimal(38,12)")


def exact_sum(col: Column) -> Column:
    """Sum as double, of the numbers as they are, independent of row order."""
    return F.sum(exact(col)).cast("double")


def rounded_sum(col: Column, digits: int = 2) -> Column:
    """Sum as double, rounded once at the end, half away from zero."""
    return F.round(F.sum(exact(col)), digits).cast("double")


def exact_mean(col: Column) -> Column:
    """Mean from the exact sum; null for an empty group."""
    return F.try_divide(exact_sum(col), F.count(col))


def exact_square(col: Column) -> Column:
    """Square as decimal of a number of up to six decimals."""
    return col.cast("decimal(18,6)") * col.cast("decimal(18,6)")


def stddev_from_sums(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares (decimals).

    Squared deviations from the mean in exact decimals: no cancellation error
    while the sum has at most 13 digits before the point, doubles beyond.
    Null below two rows.
    """
    short = total.try_cast("decimal(19,6)")
    spread = (squares - short * short / n.cast("decimal(12,0)")).cast("double")
    wide = squares.cast("double") - total.cast("double") * total.cast("double") / n
    deviation = F.greatest(F.coalesce(spread, wide), F.lit(0.0))
    return F.when(n > 1, F.sqrt(deviation / (n - 1)))


def parse_decimal_comma(text: Column) -> Column:
    """``'12,50'`` to 12.5; null where the text is no number."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def parse_number(text: Column) -> Column:
    return text.try_cast("double")


def product(*cols: Column) -> Column:
    return reduce(lambda a, b: a * b, cols)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def map_classes(col: Column, classes: Mapping[int, Sequence]) -> Column:
    """Class label for each listed value; null for values in no list."""
    branches = [(col.isin(list(values)), F.lit(label)) for label, values in classes.items()]
    out = F.when(*branches[0])
    for condition, label in branches[1:]:
        out = out.when(condition, label)
    return out


def map_values(col: Column, labels: Mapping) -> Column:
    """Code to label; null for codes without a label."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)


def cut(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(a, b]``; null outside the edges."""
    bins = list(zip(edges[:-1], edges[1:], labels, strict=True))
    out = F.when((col > bins[0][0]) & (col <= bins[0][1]), bins[0][2])
    for low, high, label in bins[1:]:
        out = out.when((col > low) & (col <= high), label)
    return out


def bucketize(col: Column, splits: Sequence[float], outside: str = "extend") -> Column:
    """Left-closed bucket index ``[a, b)``, the last bucket closed on both sides.

    ``outside``: ``extend`` opens the two outer buckets, ``null`` gives null,
    ``error`` fails the query on a value outside the splits.
    """
    inner = splits[1:-1]
    index = F.lit(0.0)
    for position, edge in enumerate(inner, start=1):
        index = F.when(col >= edge, float(position)).otherwise(index)
    inside = col.between(splits[0], splits[-1])
    if outside == "extend":
        return F.when(col.isNotNull(), index)
    if outside == "null":
        return F.when(inside, index)
    if outside == "error":
        problem = F.concat(F.lit("value outside bucket splits: "), col.cast("string"))
        return F.when(inside, index).when(col.isNotNull(), F.raise_error(problem).cast("double"))
    raise ValueError(f"unknown outside mode: {outside!r}")


def polarity(compound: Column, threshold: float = 0.05) -> Column:
    return (
        F.when(compound >= threshold, "positive")
        .when(compound <= -threshold, "negative")
        .otherwise("neutral")
    )


def interactions(pairs: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """Named pairwise products, for ``withColumns``."""
    return {name: F.col(a) * F.col(b) for name, (a, b) in pairs.items()}


def softmax(scores: Column) -> Column:
    peak = F.array_max(scores)
    weights = F.transform(scores, lambda x: F.exp(x - peak))
    total = F.aggregate(weights, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(weights, lambda x: x / total)


def argmax(scores: Column) -> Column:
    """Zero-based position of the first largest entry."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def confidence(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def last_step(sequence: Column) -> Column:
    return F.element_at(sequence, -1)


def positive_probability(vector: Column) -> Column:
    """P(class 1) of a Spark ML probability vector."""
    return vector_to_array(vector)[1]
