"""Exact top-k by inner product: a Voronoi join of queries with candidates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from marlstone.llm.storage import store
from marlstone.llm.vectors import finite_vectors, stacked

#: Doubles hold every integer up to this.
EXACT = 2.0**53


def _exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond what doubles hold exactly, in Python integers."""
    most = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object) for m in (a, b)]
    return (whole[0] @ whole[1].T).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _assign(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector, and the distance to it."""
    squares = (pivots * pivots).sum(axis=1)
    cell = np.argmin(squares[None] - 2 * (vectors @ pivots.T), axis=1)
    gap = vectors - pivots[cell]
    return cell, np.sqrt((gap * gap).sum(axis=1))


def bounds(
    pivots: np.ndarray,
    groups: dict[int, tuple[float, float]],
    cells: dict[int, np.ndarray],
    k: int,
) -> dict[int, float]:
    """For each query group a score that each of its queries reaches k times, from summaries.

    ``groups``: cell -> (largest distance of a query to the pivot, largest norm of a
    query). ``cells``: cell -> the k + 1 smallest distances of candidates to its
    pivot. A candidate p_j + r scores at least p_g.p_j - u |p_j| - m |r| with any
    query q of group g (|q - p_g| <= u, |q| <= m). One more than k is taken, for
    the query itself.
    """
    norms = np.sqrt((pivots * pivots).sum(axis=1))
    found = {}
    for g, (u, m) in groups.items():
        low = np.concatenate(
            [pivots[g] @ pivots[j] - u * norms[j] - m * near for j, near in cells.items()]
        )
        found[g] = np.sort(low)[-(k + 1)] if len(low) > k else -math.inf
    return found


def top_k_inner_product(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 64.0,
    k: int = 20,
    queries_per_pivot: int = 1024,
    chunk: int = 16_384,
    sample: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query.

    Vectors are floor(scale * x). ``is_query`` picks the queries by the id column
    ``id_col``; candidates are all rows but those with the query's id; ties go to
    the smaller id, and fewer than k candidates are all returned.

    Voronoi join: pivots are drawn by a hash from at most ``sample`` vectors, about
    one per ``queries_per_pivot`` queries. Queries and candidates belong to the cell
    of their nearest pivot. Cells are summarised by radius, norm and the k + 1
    smallest distances to the pivot; from these alone each query group gets a score
    that all its queries reach k times (``bounds``). A candidate x is replicated to
    the group of pivot p only if p.x + radius * |x| reaches that score; all others
    can't be among the best. Groups are solved in chunks of about ``chunk``
    candidates, and the best k of the chunks are merged. The bounds only save
    work: the result is exact.

    Vectors that are null, empty or hold null or non-finite components take no part,
    nor do null ids. Vectors of different length have no inner product: each length is
    solved by itself, one after the other, so a table is expected to have few of them.
    Rows that repeat id and vector count once. Ids are whole numbers. An empty table
    gives an empty table; other columns are not read.
    """
    rows = table.where(F.col(id_col).isNotNull()).withColumn("_query", F.coalesce(is_query, F.lit(False)))
    whole = finite_vectors(
        rows.select(F.struct(F.col(id_col).cast("long").alias("id"), "_query").alias("_id"), F.col(vector_col).alias("_v")),
        "_id", "_v",
    ).select("id.*", F.transform("vector", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    data = store(whole.distinct())
    schema = "query_id long, rank int, vec_id long, score long"
    # One row per vector length.
    lengths = data.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_query").cast("long")).alias("q")
    )
    found = None
    for own in sorted(lengths.where(F.col("q") > 0).collect(), key=lambda r: r["d"]):
        part = _top_k_of_length(
            data.where(F.size("v") == own["d"]), own, k, queries_per_pivot, chunk, sample
        )
        found = part if found is None else found.union(part)
    return data.sparkSession.createDataFrame([], schema) if found is None else found


def _top_k_of_length(
    data: DataFrame, own: Row, k: int, queries_per_pivot: int, chunk: int, sample: int
) -> DataFrame:
    """The join over vectors of one length: ``own`` has d, the length, n, rows, and q, queries."""
    wanted = max(1, math.ceil(own["q"] / queries_per_pivot))
    drawn = (
        data.where(F.pmod(F.xxhash64("id"), F.lit(max(1, own["n"] // sample))) == 0)
        .orderBy(F.xxhash64("id", F.lit(1)), "v")
        .limit(min(wanted, sample))
    )
    pivots = np.array([r["v"] for r in drawn.select("v").collect()])
    if not len(pivots):
        pivots = np.zeros((1, own["d"]))

    def cell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                at, gap = _assign(stacked(pdf["v"]), pivots)
                yield pdf.assign(cell=at, gap=gap)

    placed = store(
        data.mapInPandas(cell, "id long, _query boolean, v array<double>, cell int, gap double")
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # One row per cell each: at most as many as pivots.
    summary = (
        placed.where("_query")
        .groupBy("cell")
        .agg(F.max("gap").alias("u"), F.max(norm).alias("m"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    groups = {r["cell"]: (r["u"], r["m"]) for r in summary}
    # A cell with many queries is dealt to several tasks.
    parts = {r["cell"]: math.ceil(r["n"] / (2 * queries_per_pivot)) for r in summary}
    nearest = _smallest(placed.select("cell", "gap"), k + 1)
    cells = {r["cell"]: np.array(r["near"]) for r in nearest.collect()}
    floor = bounds(pivots, groups, cells, k)
    names = np.array([(g, p) for g, n in sorted(parts.items()) for p in range(n)], dtype=np.int64)
    chunks = max(1, math.ceil(own["n"] / chunk))

    def replicate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to_cell = names[:, 0]
        radius = np.array([groups[g][0] for g in to_cell])
        least = np.array([floor[g] for g in to_cell])
        for pdf in frames:
            if not len(pdf):
                continue
            x = stacked(pdf["v"])
            reach = np.sqrt((x * x).sum(axis=1))[:, None] * radius
            along = x @ pivots[to_cell].T
            # A margin for rounding keeps every vector that could reach the bound.
            margin = 1e-9 * (1 + np.abs(along) + reach)
            row, to = np.nonzero(along + reach + margin >= least[None])
            yield pd.DataFrame(
                {
                    "cell": names[to, 0],
                    "part": names[to, 1],
                    "id": pdf["id"].to_numpy()[row],
                    "v": pdf["v"].to_numpy()[row],
                }
            )

    fitting = placed.select("id", "v").mapInPandas(
        replicate, "cell int, part int, id long, v array<double>"
    )
    candidates = fitting.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
    split = F.create_map(*[F.lit(x) for item in parts.items() for x in item])
    asking = (
        placed.where("_query")
        .select("cell", "id", "v")
        .withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), split[F.col("cell")]).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    )

    def solve(asked: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        found = [[np.empty(0, dtype=np.int64)] for _ in range(3)]
        if len(asked) and len(near):
            q, x = stacked(asked["v"]), stacked(near["v"])
            ids, own = near["id"].to_numpy(), asked["id"].to_numpy()
            for at in range(0, len(q), 128):
                for i, row in enumerate(_exact_product(q[at : at + 128], x), at):
                    others = np.flatnonzero(ids != own[i])
                    top = others[_best(row[others], ids[others], k)]
                    for column, values in zip(
                        found, (np.full(len(top), own[i]), ids[top], row[top]), strict=True
                    ):
                        column.append(values)
        return pd.DataFrame(
            dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, found), strict=True))
        )

    found = (
        asking.groupBy("cell", "part", "chunk")
        .cogroup(candidates.groupBy("cell", "part", "chunk"))
        .applyInPandas(solve, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _smallest(gaps: DataFrame, k: int) -> DataFrame:
    """The k smallest gaps of each cell, cut in every partition before they are shuffled."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None
        for pdf in frames:
            kept = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            kept = kept.sort_values("gap").groupby("cell").head(k)
        if kept is not None:
            yield kept

    few = gaps.mapInPandas(cut, "cell int, gap double")
    first = Window.partitionBy("cell").orderBy("gap")
    return (
        few.withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= k)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("gap")).alias("near"))
    )
