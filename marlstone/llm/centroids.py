"""Clustering around integer centroids, in JVM expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import store

# Components of at most this size have distances that fit a long at 64 components.
LARGEST = 1 << 27


def whole_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 256
) -> DataFrame:
    """(vec_id, v): the vectors of exactly ``size`` finite components as floor(scale * x).

    Left out are null vectors, those of another length, those that hold null or
    non-finite components, and those with a scaled component above 2 ** 27, whose
    squared distances a long can't hold.
    """
    scaled = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    # Comparing first keeps the cast of NaN and infinity out of floor's way.
    fits = F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & F.abs(x.cast("double")).between(0, (LARGEST - 1) / scale),
    )
    kept = F.when((F.size(vector) == size) & fits, scaled)
    table = df.select(F.col(key).cast("long").alias("vec_id"), kept.alias("v"))
    return table.where(F.col("v").isNotNull())


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``seed``:vec_id; ties by components."""
    drawn = F.sha2(F.concat_ws(":", F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(drawn.alias("draw"), "v").orderBy("draw", "v").limit(k).collect()
    return [list(row["v"]) for row in rows]


def _literal(centroids: list[list[int]]) -> Column:
    """The centroids as one array literal."""
    arrays = ", ".join("array(" + ", ".join(f"{x}L" for x in c) + ")" for c in centroids)
    return F.expr(f"array({arrays})")


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest literal centroid; ties go to the smaller number."""

    def squared(centroid: Column) -> Column:
        apart = F.zip_with(v, centroid, lambda x, y: x - y)
        return F.aggregate(apart, F.lit(0).cast("long"), lambda total, x: total + x * x)

    def numbered(centroid: Column, number: Column) -> Column:
        return F.struct(squared(centroid).alias("distance"), number.alias("cluster"))

    return F.array_min(F.transform(_literal(centroids), numbered))


def updated(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor(sum / count) of every cluster; an empty one keeps its centroid.

    Column sums with map-side combine; what reaches the driver is one row per cluster.
    """
    size = len(centroids[0])
    rows = (
        vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
        .groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("n"),
            # Decimals, since sums over very many rows outgrow a long.
            *[F.sum(F.get("v", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(size)],
        )
        .collect()
    )
    found = list(centroids)
    for row in rows:
        found[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(size)]
    return found


def cluster_vectors(
    df: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: str = "2",
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = 64,
    scale: int = 256,
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` rounds and a last assignment.

    Starts from ``first_centroids``, so a table with fewer than ``k`` vectors has fewer
    clusters; an empty one has none and gives no rows. Rows that repeat a vec_id are
    vectors of their own. Other columns are ignored. The centroids, ``k`` arrays, are the
    only thing the driver holds.
    """
    vectors = store(whole_vectors(df, key, vector, size, scale))
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        none = F.lit(None)
        empty = vectors.select("vec_id", none.cast("int").alias("cluster"), none.cast("long").alias("distance"))
        return empty.where(F.lit(False)), []
    for _ in range(rounds):
        centroids = updated(vectors, centroids)
    chosen = vectors.select("vec_id", nearest(F.col("v"), centroids).alias("at"))
    return chosen.select("vec_id", "at.cluster", "at.distance"), centroids


def centroid_clusters(df: DataFrame, **parameters) -> DataFrame:
    """``cluster_vectors`` with the inertias and the digest of each centroid in every row.

    An inertia beyond a long is null.
    """
    chosen, centroids = cluster_vectors(df, **parameters)
    placed = store(chosen)
    # At most one row per centroid.
    sums = placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("cluster_inertia")
    )
    everything = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    digest = F.get(F.array(*[F.lit(d) for d in digests] or [F.lit("")]), F.col("cluster"))
    return placed.join(F.broadcast(sums.crossJoin(everything)), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        F.expr("try_cast(cluster_inertia AS bigint)").alias("cluster_inertia"),
        F.expr("try_cast(inertia AS bigint)").alias("inertia"),
        digest.alias("centroid_sha256"),
    )
