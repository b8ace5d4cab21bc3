"""Shards of nearly equal bytes by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import store, with_position


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions into one by largest differencing.

    ``sums`` has a row per partial partition and a column per part. The two
    partial partitions with the largest spread are taken, one is laid on the other
    in opposite order, and the result goes back, until one is left. Returns the
    part sums of that one in descending order, and for each row of ``sums`` the
    part that each of its columns went to.
    """
    n, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")
    nodes = list(np.take_along_axis(sums, order, axis=1))
    # Children of a combined node: (left, right, order of the added parts).
    made: dict[int, tuple[int, int, np.ndarray]] = {}
    heap = [(-int(s[0] - s[-1]), i) for i, s in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = nodes[a] + nodes[b][::-1]
        rank = np.argsort(-total, kind="stable")
        new = len(nodes)
        nodes.append(total[rank])
        made[new] = (a, b, np.argsort(rank))
        nodes[a] = nodes[b] = None
        heapq.heappush(heap, (-int(total[rank[0]] - total[rank[-1]]), new))
    top = heap[0][1]
    place = {top: np.arange(k)}
    parts = np.empty((n, k), dtype=np.int64)
    stack = [top]
    while stack:
        at = stack.pop()
        here = place.pop(at)
        if at in made:
            a, b, to = made[at]
            place[a] = here[to]
            place[b] = here[to[::-1]]
            stack += [a, b]
        else:
            parts[at, order[at]] = here
    return nodes[top], parts


def shard_by_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 8,
    block: int = 50_000,
) -> DataFrame:
    """Every row's shard 0 .. shards-1, so that shards hold nearly equal bytes.

    A row's size is the UTF-8 bytes of its text plus 1. Rows of equal text form
    one group that isn't divided; groups are pre-aggregated by a 256-bit digest of
    the text. Karmarkar-Karp differencing runs in blocks of about ``block`` groups,
    one task each, that leave a partial partition of ``shards`` sums; the partial
    partitions of the blocks are differenced in the same way, level by level, until
    one is left. Tasks hold a bounded number of partial partitions at every level.

    Returns id, size, text_crc32 (unsigned), shard and slot (gapless from 0 within
    the shard, by id). Null texts are as empty ones: size 1, digest of no bytes.
    Ids may repeat or be null; an empty table gives an empty table; other columns
    are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = store(
        docs.select(
            F.col(id_col).alias("_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("_key"),
        )
    )
    groups = rows.groupBy("_key").agg(F.sum("size").alias("_bytes"))
    n = groups.count()
    levels = []
    # Level 0: a node is a group of equal texts, one part holds all of it.
    nodes = groups.select(
        F.col("_key").alias("node"),
        F.concat(
            F.array(F.col("_bytes")), F.array_repeat(F.lit(0).cast("long"), shards - 1)
        ).alias("sums"),
    )
    key = "binary"
    while True:
        blocks = max(1, math.ceil(n / block))
        stored = store(_combine(nodes, key, blocks, shards))
        levels.append(stored)
        if blocks == 1:
            break
        nodes = stored.where(F.col("block_sums").isNotNull()).select(
            F.col("block").alias("node"), F.col("block_sums").alias("sums")
        )
        n, key = blocks, "long"
    # From the top down: which shard each part of a block became.
    placed = levels[-1].where(F.col("node").isNotNull()).select("node", "parts")
    for lower in reversed(levels[:-1]):
        above = placed.select(F.col("node").alias("block"), F.col("parts").alias("_above"))
        placed = (
            lower.where(F.col("node").isNotNull())
            .join(above, "block")
            .select("node", F.transform("parts", lambda p: F.get("_above", p)).alias("parts"))
        )
    shard = placed.select(F.col("node").alias("_key"), F.get("parts", F.lit(0)).cast("int").alias("shard"))
    dealt = rows.join(shard, "_key").select("_id", "size", "text_crc32", "shard")
    out = with_position(dealt, ["shard"], ["_id", "text_crc32", "size"], "slot")
    return out.select(F.col("_id").alias(id_col), "size", "text_crc32", "shard", "slot")


def _combine(nodes: DataFrame, key: str, blocks: int, shards: int) -> DataFrame:
    """Difference the nodes of each block.

    A row per node with the part each of its columns went to, and one per block
    with the sums of its parts.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        sums, parts = difference(np.stack(pdf["sums"].to_numpy()).astype(np.int64))
        at = pdf["block"].iloc[0]
        return pd.DataFrame(
            {
                "block": at,
                "node": pd.Series([*pdf["node"], None], dtype=object),
                "parts": [*parts, None],
                "block_sums": [None] * len(parts) + [sums],
            }
        )

    dealt = nodes.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("long"))
    schema = f"block long, node {key}, parts array<long>, block_sums array<long>"
    return dealt.groupBy("block").applyInPandas(run, schema)
