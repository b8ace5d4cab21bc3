"""Best-fit packing of documents into bins that hold no two of a source or of a duplicate cluster."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.mixing import word_count
from marlstone.llm.storage import store

def numbers_of(values: pd.Series) -> np.ndarray:
    """A bit number of its own for each value that occurs more than once; -1 for the rest.

    Nulls and values that nothing else shares can't stand in the way of any piece.
    """
    codes, _ = pd.factorize(values)
    known = codes >= 0
    counts = np.bincount(codes[known], minlength=1)
    again = counts > 1
    own = np.where(again, np.cumsum(again) - 1, -1)
    return np.where(known, own[codes], -1)


def best_fit(
    sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in the given order.

    Bins are kept by their residual, with bitmaps of the sources and clusters they hold:
    Python integers, so every source and cluster has a bit of its own. A piece goes to the
    bin with the smallest residual that holds it and has neither its source bit nor its
    cluster bit (-1: none); among equals to the oldest. ``bins_at`` counts the bins of each
    residual, ``taken`` for each source those that hold it: the search moves to the next
    residual with a bin more than that, and on from there while cluster bits stand
    against it. If no bin is left the piece opens one.
    """
    bins_at = np.zeros(capacity + 1, dtype=np.int32)
    taken: dict[int, np.ndarray] = {}
    # Bins by residual, oldest first: bin -> its two bitmaps are looked up by number.
    held: list[dict[int, None]] = [{} for _ in range(capacity + 1)]
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    own_sources: list[list[int]] = []
    residual: list[int] = []
    bins, offsets = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    for i, (size, source, cluster) in enumerate(
        zip(sizes.tolist(), sources.tolist(), clusters.tolist(), strict=True)
    ):
        source_mark = 1 << source if source >= 0 else 0
        cluster_mark = 1 << cluster if cluster >= 0 else 0
        rivals = taken.get(source)
        found, at = -1, size
        while found < 0 and at <= capacity:
            ahead = bins_at[at:] > (0 if rivals is None else rivals[at:])
            step = int(ahead.argmax())
            if not ahead[step]:
                break
            at += step
            found = min(
                (b for b in held[at] if not source_bits[b] & source_mark and not cluster_bits[b] & cluster_mark),
                default=-1,
            )
            at += found < 0
        if found < 0:
            found = len(residual)
            residual.append(capacity)
            source_bits.append(0)
            cluster_bits.append(0)
            own_sources.append([])
        else:
            del held[at][found]
            bins_at[at] -= 1
            for s in own_sources[found]:
                taken[s][at] -= 1
        bins[i], offsets[i] = found, capacity - residual[found]
        residual[found] -= size
        source_bits[found] |= source_mark
        cluster_bits[found] |= cluster_mark
        if source >= 0:
            own_sources[found].append(source)
            if rivals is None:
                taken[source] = np.zeros(capacity + 1, dtype=np.int32)
        held[residual[found]][found] = None
        bins_at[residual[found]] += 1
        for s in own_sources[found]:
            taken[s][residual[found]] += 1
    return bins, offsets


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster: Column | None = None,
    capacity: int = 2048,
    block: int = 20_000,
) -> DataFrame:
    """Pieces of every row of ``docs`` and the bin that each lies in.

    Sizes are words (runs between ASCII white space). A text of more than ``capacity``
    words is cut into pieces of ``capacity`` and a rest. Pieces are dealt by a hash
    into blocks of about ``block``, one task each, and packed there largest first
    (``best_fit``): into the tightest bin that has room and holds neither a piece of the
    same source nor of the same duplicate cluster. ``cluster`` (default: a hash of the
    text, so equal texts) names the cluster of a row; null is in none.

    Returns id, piece (from 0), first_word (where it starts in the text), n_words, bin
    (block and number, unique), at (where it starts in the bin). Nothing is
    drawn at random, so reruns over the same files agree.

    Rows without words (null or empty texts too) have nothing to pack: one piece of 0
    words with null bin and at. Null sources are one source. Ids may repeat or
    be null: every row is packed. An empty table gives an empty table; other columns are not read.
    """
    text = F.col(text_col).cast("string")
    source = F.col(source_col).cast("string")
    sized = store(
        docs.select(
            F.col(id_col).alias("_id"),
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64(F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))).alias("source"),
            (F.xxhash64(text) if cluster is None else cluster.cast("long")).alias("cluster"),
            word_count(text).alias("size"),
        )
    )
    start = F.explode(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(capacity))
    )
    pieces = sized.withColumn("first_word", start).withColumns(
        {
            "n_words": F.least(F.col("size") - F.col("first_word"), F.lit(capacity)),
            "piece": F.expr(f"first_word div {capacity}").cast("int"),
        }
    )
    n = pieces.where(F.col("n_words") > 0).count()
    blocks = max(1, math.ceil(n / block))
    kind = dict(docs.dtypes)[id_col]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, at = best_fit(
            pdf["n_words"].to_numpy(), numbers_of(pdf["source"]), numbers_of(pdf["cluster"]), capacity
        )
        pdf["bin"] = (pdf["block"].to_numpy() << 32) + bins
        pdf["at"] = at
        return pdf[["_id", "piece", "first_word", "n_words", "bin", "at"]]

    some = pieces.where(F.col("n_words") > 0).withColumn(
        "block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)).cast("long")
    )
    packed = some.groupBy("block").applyInPandas(
        pack, f"_id {kind}, piece int, first_word long, n_words long, bin long, at long"
    )
    empty = pieces.where(F.col("n_words") <= 0).select(
        "_id", "piece", "first_word", F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("long").alias("bin"), F.lit(None).cast("long").alias("at"),
    )
    return packed.union(empty).withColumnRenamed("_id", id_col)
