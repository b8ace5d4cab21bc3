"""SimHash fingerprints and near-duplicate groups by tiled exact comparison."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marlstone.llm.components import LocalForest, connected_components
from marlstone.llm.storage import arrow_rows, store

SEED = 42
#: Shingles whose hashes are held at once while a text is fingerprinted.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits of a whole text, as a signed long.

    A-Z are lower-cased, words are separated by ASCII white space, and a shingle is
    ``words`` consecutive words joined by spaces, repeats included; a shorter text is
    one shingle, a text without words has the fingerprint zero. A bit is set where
    over half of the shingles' XXH64 values (UTF-8, seed 42) have it.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        last = np.cumsum(lengths + 1) - 1
        ends = last[words - 1 :].tolist()
        starts = (last - lengths)[: len(ends)].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array(
            [
                digest(joined[s:e], SEED)
                for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, words: int = 3) -> Column:
    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return of(text.cast("string"))


def _quarters(prints: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters, a row per fingerprint."""
    halves = np.ascontiguousarray(prints).view("<u2").reshape(-1, 4)
    return np.bitwise_count(halves).astype(np.int16)


def _boxes(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(0, len(counts), size)
    return np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)


def compare_tiles(
    a: np.ndarray, b: np.ndarray, same: bool, radius: int, size: int = 512
) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints of two tiles at most ``radius`` bits apart.

    Every pair is compared by exclusive-or and bit count, in sub-tiles of ``size``;
    a pair of sub-tiles is skipped where the population counts of their quarters
    differ by more than the radius in all. Returns a spanning forest of the links:
    the same groups with fewer links than fingerprints.
    """
    tiles = []
    for prints in (a,) if same else (a, b):
        counts = _quarters(prints)
        order = np.lexsort((prints, *counts.T, counts.sum(axis=1)))
        tiles.append((prints[order], *_boxes(counts[order], size)))
    (left, low_a, high_a), (right, low_b, high_b) = tiles[0], tiles[-1]
    gaps = np.maximum(
        np.maximum(low_a[:, None] - high_b[None], low_b[None] - high_a[:, None]), 0
    ).sum(axis=2)
    shift = 0 if same else len(left)
    forest = LocalForest(shift + len(right))
    for i, j in zip(*np.nonzero(gaps <= radius), strict=True):
        if same and j < i:
            continue
        x = left[i * size : (i + 1) * size]
        y = right[j * size : (j + 1) * size]
        p, q = np.nonzero(np.bitwise_count(x[:, None] ^ y[None]) <= radius)
        forest.link(p + i * size, q + j * size + shift)
    prints = left if same else np.concatenate([left, right])
    nodes, roots = forest.edges()
    return prints[nodes], prints[roots]


def link_fingerprints(prints: DataFrame, radius: int = 3, tile: int = 8192) -> DataFrame:
    """Links (src, dst) that join all fingerprints of ``prints`` within ``radius`` bits.

    ``prints`` has one long column ``print`` without repeats or nulls. Tiles hold
    about ``tile`` fingerprints of one population count; tiles whose population
    counts differ by more than the radius are never paired, all other pairs of tiles
    are compared whole (``compare_tiles``), each pair once. Links are those of
    spanning forests, so their number stays below the fingerprints compared.
    """
    ones = F.bit_count("print").cast("int")
    # At most 65 rows: fingerprints by population count.
    sizes = {r["ones"]: r["n"] for r in prints.groupBy(ones.alias("ones")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return prints.select(F.col("print").alias("src"), F.col("print").alias("dst"))
    split = F.create_map(*[F.lit(v) for p, n in sizes.items() for v in (p, math.ceil(n / tile))])
    tiles = store(
        prints.select("print", ones.alias("ones"))
        .withColumn("part", F.pmod(F.xxhash64("print"), split[F.col("ones")]).cast("int"))
        .groupBy("ones", "part")
        .agg(F.collect_list("print").alias("prints"))
    )
    near = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.lit(radius)),
                lambda d: F.transform(
                    F.when(
                        F.try_element_at(split, F.col("ones") + d).isNotNull(),
                        F.sequence(F.lit(0), F.try_element_at(split, F.col("ones") + d) - 1),
                    ).otherwise(F.array().cast("array<int>")),
                    lambda q: F.struct((F.col("ones") + d).alias("ones"), q.alias("part")),
                ),
            )
        )
    )
    first = tiles.select(
        F.col("ones").alias("ones_a"), F.col("part").alias("part_a"), F.col("prints").alias("a"),
        near.alias("to"),
    )
    first = first.where(
        (F.col("ones_a") < F.col("to.ones")) | (F.col("part_a") <= F.col("to.part"))
    )
    second = tiles.select(
        F.col("ones").alias("ones_b"), F.col("part").alias("part_b"), F.col("prints").alias("b")
    )
    # A partition per tile: small in bytes, but long to compare, so they aren't put together.
    n = sum(math.ceil(own / tile) for own in sizes.values())
    first = first.select("*", "to.*").withColumnsRenamed({"ones": "ones_b", "part": "part_b"})
    paired = (
        first.repartition(n, "ones_b", "part_b")
        .join(second.repartition(n, "ones_b", "part_b"), ["ones_b", "part_b"])
        .withColumn(
            "same", (F.col("ones_a") == F.col("ones_b")) & (F.col("part_a") == F.col("part_b"))
        )
        .select("a", "b", "same")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    for c in (0, 1)
                )
                src, dst = compare_tiles(a, b, batch.column(2)[i].as_py(), radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))],
                    names=["src", "dst"],
                )

    with arrow_rows(prints.sparkSession, 16):
        return store(paired.mapInArrow(compare, "src long, dst long"))


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    radius: int = 3,
) -> DataFrame:
    """Every row's id, fingerprint (hex), component_id, component and row.

    Rows with one fingerprint are one class, however many; classes link at
    ``radius`` or fewer differing bits, found by exact comparison of all
    classes that can be that near. component_id is the smallest id reachable,
    a class's own rows included. No pair of rows is ever listed. ``component`` is a
    number of the component; ``row`` numbers the rows of ``docs`` and can be joined back
    as long as ``docs`` reads the same rows in the same partitions, as stored files do.

    Null and empty texts have the fingerprint zero and link like any other. Ids may
    repeat; null ids take their component's smallest id, or null if it has none. An
    empty table gives an empty table; other columns are not read.
    """
    rows = store(
        docs.select(
            F.col(id_col).alias("_id"),
            fingerprint_column(F.col(text_col), words).alias("print"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    classes = store(rows.groupBy("print").agg(F.min("_id").alias("first")))
    links = link_fingerprints(classes.select("print"), radius)
    members = store(
        connected_components(links).select(F.col("node").alias("print"), "component")
    )
    labelled = classes.join(members, "print", "left").withColumn(
        "component", F.coalesce("component", "print")
    )
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    named = labelled.join(smallest, "component").select("print", "component_id", "component")
    out = rows.join(named, "print")
    return out.select(
        F.col("_id").alias(id_col),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
        "component",
        "row",
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id.

    Null ids come last; of repeated ids one row stays. Columns are those of ``docs``.
    """
    groups = simhash_groups(docs, id_col, **options)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("row"))
    name = "_row"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    kept = groups.groupBy("component").agg(F.min_by("row", order).alias(name)).select(name)
    numbered = docs.withColumn(name, F.monotonically_increasing_id())
    return numbered.join(kept, name, "left_semi").select(*docs.columns)
