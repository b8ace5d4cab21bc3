"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.components import LocalForest, connected_components
from marlstone.llm.storage import store, with_position
from marlstone.llm.vectors import finite_vectors, stacked, unit_rows

#: Random hashes concatenated in a sorting key, one bit each.
BITS = 60


def passes_needed(rows: int, window: int, cosine: float, recall: float) -> int:
    """Passes after which a pair at ``cosine`` has met in a window with chance ``recall``.

    Two vectors at angle t agree in one random sign with chance 1 - t / pi. They
    are about ``window`` rows apart or less once their keys agree in the first
    log2(rows / window) signs.
    """
    depth = max(1.0, math.log2(max(2, rows / window)))
    met = (1 - math.acos(cosine) / math.pi) ** depth
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _keys(vectors: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """A sorting key per vector and pass: the signs of ``BITS`` random projections."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    keys = np.empty((len(vectors), passes), dtype=np.int64)
    for p in range(passes):
        planes = np.random.default_rng((seed, p)).standard_normal((vectors.shape[1], BITS))
        keys[:, p] = (vectors @ planes > 0) @ weights
    return keys


def projection_links(
    vectors: DataFrame, threshold: float, window: int, passes: int, block: int, seed: int
) -> DataFrame:
    """Links (src, dst) between vectors met in a window with cosine >= threshold.

    ``vectors`` has unique long ids (``id``) and finite, nonzero ``vector`` columns.
    Every pass sorts all vectors by their key and compares each with the next
    ``window`` ones. A pass is cut into blocks of ``block`` positions; a block also
    receives the ``window`` rows before it, so no window is cut short. Links are
    those of a spanning forest of the block.
    """

    def key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for _, part in pdf.groupby(pdf["vector"].map(len), sort=False):
                keys = _keys(unit_rows(stacked(part["vector"])), passes, seed)
                yield pd.DataFrame(
                    {
                        "dims": len(part["vector"].iloc[0]),
                        "pass": np.tile(np.arange(passes), len(part)),
                        "key": keys.ravel(),
                        "id": np.repeat(part["id"].to_numpy(), passes),
                    }
                )

    keyed = vectors.mapInPandas(key, "dims int, pass int, key long, id long")
    placed = with_position(keyed, ["dims", "pass"], ["key", "id"], "position")
    own = F.floor(F.col("position") / block)
    halo = F.col("position") % block >= block - window
    blocks = placed.select(
        "dims", "pass", "position", "id",
        F.explode(
            F.when(halo, F.array(own, own + 1)).otherwise(F.array(own))
        ).alias("block"),
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position")
        x = unit_rows(stacked(pdf["vector"]))
        forest = LocalForest(len(x))
        step = 256
        for at in range(0, len(x), step):
            near = x[at : at + step] @ x[at : at + step + window].T >= threshold
            i, j = np.nonzero(near)
            ahead = (j > i) & (j - i <= window)
            forest.link(i[ahead] + at, j[ahead] + at)
        ids = pdf["id"].to_numpy()
        nodes, roots = forest.edges()
        return pd.DataFrame({"src": ids[nodes], "dst": ids[roots]})

    met = blocks.join(vectors, "id").groupBy("dims", "pass", "block")
    return met.applyInPandas(compare, "src long, dst long").distinct()


def _count_links(members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(id, n): for each member of a component, the weights of the members it links with.

    ``members``: component, id, vector, weight. Components are cut into tiles of
    about ``tile`` vectors; each pair of tiles is compared in a task of its own and
    gives a count per vector, never the pairs.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select("component", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    dealt = members.join(parts, "component").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    )
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    paired = dealt.withColumn("other", F.explode(others)).select(
        "component", "id", "vector", "weight", "part",
        F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"),
    )

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        x, w = unit_rows(stacked(pdf["vector"])), pdf["weight"].to_numpy()
        same = pdf["a"].iloc[0] == pdf["b"].iloc[0]
        side = np.zeros(len(x), bool) if same else (pdf["part"] == pdf["a"]).to_numpy()
        n = np.zeros(len(x), dtype=np.int64)
        for at in range(0, len(x), 1024):
            rows = slice(at, at + 1024)
            near = x[rows] @ x.T >= threshold
            if not same:
                near &= side[rows, None] != side[None]
            n[rows] = near @ w
        return pd.DataFrame({"id": pdf["id"], "n": n})

    counted = paired.groupBy("component", "a", "b").applyInPandas(count, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicate_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    window: int = 256,
    recall: float = 0.99,
    block: int = 4096,
    tile: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """One row per row of ``table``: id, n_links, component_id, kept.

    Links are pairs with cosine (double precision) at or above ``threshold``. They
    are found by sorted projection passes (``projection_links``): vectors are
    ordered by concatenated random sign hashes, compared within a bounded window,
    and verified pairs are united over the passes. The number of passes follows
    from the number of vectors so that even a pair at ``threshold`` is met with
    chance ``recall`` (``passes_needed``). Groups larger than a window need no
    luck: equal vectors are one representative with a weight, and after the
    passes an exact check counts the links within each component, tile by tile, so
    n_links is whole for every component found. No link is below the threshold.

    component_id is the smallest id reachable; kept is id = component_id. Vectors that
    are null, empty, zero or hold null or non-finite components link with nothing;
    vectors of different lengths never link. Rows that repeat an id with the same
    vector count as one vector's copies; with null id a row is its own component
    (component_id null, kept true). An empty table gives an empty table; other columns are not read.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    usable = finite_vectors(rows.where(F.col("id").isNotNull()), "id", "vector").where(
        F.exists("vector", lambda x: x != 0)
    )
    # Equal vectors: one representative, the smallest id, that stands for all of them.
    stored = store(usable)
    classes = store(
        stored.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    )
    n = classes.count()
    passes = passes_needed(n, window, threshold, recall)
    links = projection_links(
        classes.select("id", "vector"), threshold, window, passes, block, seed
    )
    component = store(connected_components(store(links)))
    members = component.withColumnRenamed("node", "id").join(classes, "id")
    counts = _count_links(members.select("component", "id", "vector", "weight"), threshold, tile)
    found = (
        classes.join(component.withColumnRenamed("node", "id"), "id", "left")
        .join(counts, "id", "left")
        .select(
            "vector",
            # A class without links to others: its own copies only.
            (F.coalesce("n", "weight") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    copies = stored.join(found, "vector").select("id", "n_links", "component_id")
    known = copies.groupBy("id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    return rows.select("id").join(known, "id", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )
