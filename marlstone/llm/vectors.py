"""Embedding columns as numpy arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) as doubles of the rows whose vector can be compared.

    Left out are vectors that are null or empty, or hold null or non-finite components.
    """
    vector = F.col(vector_col).cast("array<double>")
    return table.select(F.col(id_col).alias("id"), vector.alias("vector")).where(
        (F.size("vector") > 0) & F.forall("vector", _finite)
    )


def _finite(x: Column) -> Column:
    # Null components give false, as forall needs a certain answer.
    return F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))


def stacked(column) -> np.ndarray:
    """A pandas column of equally long vectors as a matrix of doubles."""
    return np.stack(column.to_numpy()).astype(np.float64, copy=False)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
