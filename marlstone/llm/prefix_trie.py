"""The trie of conversations that share their first turns, with subtree totals by depth bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.storage import store, with_position

WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "a", "b"]
CHUNK = 4096


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row per node; ``ends``: one row per conversation, at its last node.

    A node is named by ``depth`` and the two longs ``a`` and ``b`` that its turns hash
    to; ``ends`` carries the same three columns and ``conv_id``.
    """

    nodes: DataFrame
    ends: DataFrame


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, a, b, words): the turns of each conversation, ``at`` counting from 0.

    Turns are ordered by ``turn`` (null first), equal ones by role and SHA-256 of the text.
    ``a`` and ``b`` are two hashes of role and text; a null role or text counts as
    empty. Rows without a conv_id belong to no conversation. Texts are read whole and
    don't leave the task that hashed them.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        "turn",
        role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.sha2(text.cast("binary"), 256).alias("tie"),
    )
    order = ["turn", "role", "tie"]
    # Stored, or the sampling of range bounds would hash all texts a second time.
    return with_position(store(turns), ["conv_id"], order, "at").drop(*order)


def with_shared_leads(turns: DataFrame, family: int = 20, leads: int = 4) -> DataFrame:
    """Rebuild every conversation from its family's first turns and its own later ones.

    Conversation c takes the first h turns of conversation c - c % ``family`` (all, if
    that has fewer; none, if there is no such conversation) and its own turns from the
    h-th on, h = crc32 of its number as text, modulo ``leads``. Rows (conv_id, at, a, b,
    words) keep ``at`` as their order, and each conversation gets a row at -1, so that
    one without turns stays. At most ``leads`` - 1 turns go to at most 2 ``family``
    conversations.
    """
    lead = F.crc32(F.col("conv_id").cast("string").cast("binary")) % leads
    own = turns.select("conv_id", "at", "a", "b", "words").where(F.col("at") >= lead)
    everyone = turns.groupBy("conv_id").agg(F.lit(-1).cast("long").alias("at"))
    first = turns.where(F.col("at") < leads - 1).select(
        F.col("conv_id").alias("head"), "at", "a", "b", "words"
    )
    wanted = everyone.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("head"), lead.alias("lead")
    )
    shared = wanted.join(first, "head").where(F.col("at") < F.col("lead"))
    none = F.lit(0).cast("long")
    starts = everyone.select("conv_id", "at", none.alias("a"), none.alias("b"), none.alias("words"))
    return own.union(shared.select("conv_id", "at", "a", "b", "words")).union(starts)


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, turn_a, turn_b, words): the prefixes of each conversation.

    ``a`` and ``b`` are exclusive-or sums of the turns' hashes tagged with their depth:
    sums that can be taken block by block, so a conversation with a large share of all
    turns is spread over range partitions and what a block needs from earlier ones is
    one row. Different prefixes agree in both with a chance of 2 ** -128 a pair.
    """
    block = ["conv_id", "part"]
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranged = store(
        turns.repartitionByRange("conv_id", "at").withColumn("part", F.spark_partition_id())
    )
    rows = ranged.groupBy(block).agg(F.count(F.lit(1)).alias("rows"))
    rows = rows.select(*block, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy(block)
    number = F.row_number().over(within.orderBy("at"))
    numbered = ranged.withColumn("number", number).join(rows, block)
    depth = F.col("before") + F.col("number") - 1

    def tagged(name: str) -> Column:
        return F.when(F.col("depth") > 0, F.xxhash64("depth", name)).otherwise(F.lit(0))

    numbered = store(
        numbered.withColumn("depth", depth)
        .withColumns({"turn_a": tagged("a"), "turn_b": tagged("b")})
        .select(*block, "depth", "turn_a", "turn_b", "words")
    )
    sums = numbered.groupBy(block).agg(
        F.bit_xor("turn_a").alias("sum_a"), F.bit_xor("turn_b").alias("sum_b")
    )
    none = F.lit(0).cast("long")
    sums = sums.select(
        *block,
        F.coalesce(F.bit_xor("sum_a").over(earlier), none).alias("before_a"),
        F.coalesce(F.bit_xor("sum_b").over(earlier), none).alias("before_b"),
    )
    upto = within.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = numbered.withColumns(
        {"a": F.bit_xor("turn_a").over(upto), "b": F.bit_xor("turn_b").over(upto)}
    ).join(sums, block)
    return summed.select(
        "conv_id",
        "depth",
        F.col("a").bitwiseXOR(F.col("before_a")).alias("a"),
        F.col("b").bitwiseXOR(F.col("before_b")).alias("b"),
        "turn_a",
        "turn_b",
        "words",
    )


def _with_parents(nodes: DataFrame, count: int, hot_parts: int = 1000) -> DataFrame:
    """Add parent_conv_id, n_children.

    A parent of more than ``count`` / ``hot_parts`` nodes is hot; there are at most
    ``hot_parts`` of those, so they are broadcast. No other key of the join has more
    rows than that.
    """
    up = [F.col("up_depth"), F.col("up_a"), F.col("up_b")]
    names = ["up_depth", "up_a", "up_b"]
    below = nodes.where(F.col("depth") > 0)
    children = below.groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.toDF(*KEY, "n_children")
    counted = store(nodes.join(children, KEY, "left").fillna({"n_children": 0}))
    parents = counted.where(F.col("n_children") > 0).select(
        F.col("depth").alias("up_depth"),
        F.col("a").alias("up_a"),
        F.col("b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"),
        (F.col("n_children") > count / hot_parts).alias("hot"),
    )
    hot = F.broadcast(parents.where("hot").drop("hot"))
    rest = parents.where(~F.col("hot")).drop("hot")
    below = counted.where(F.col("depth") > 0)
    linked = below.join(hot, names).unionByName(
        below.join(hot, names, "left_anti").join(rest, names)
    )
    top = counted.where(F.col("depth") == 0)
    return linked.unionByName(top.withColumn("parent_conv_id", F.lit(None).cast("long")))


def _subtree_totals(
    paths: DataFrame, nodes: DataFrame, values: list[str], deepest: int, band: int, step: int = 1
) -> DataFrame:
    """Sums of ``values`` over the subtree of each of ``nodes``, keyed by depth, a, b.

    ``nodes`` lie at multiples of ``step``. Each explodes only to its ancestors within
    its band of ``band`` steps, read off the path of its smallest member. Band roots
    with their sums are a trie of ``band`` times less depth, which this function
    completes in turn; their complete sums then enter the bands above as values of the
    nodes they hang from. The deepest trie takes log(depth) rounds, and a node has
    ``band`` rows at most in each.
    """
    width = step * band
    own_band = F.floor(F.col("depth") / width).alias("band")
    steps = paths.where(F.col("depth") % step == 0).select(
        "conv_id", own_band, F.col("depth").alias("above"), "a", "b"
    )

    def within_bands(valued: DataFrame) -> DataFrame:
        """Each node's sums over its subtree's part in its own band."""
        asked = valued.select("conv_id", own_band, "depth", *values)
        pairs = asked.join(steps, ["conv_id", "band"]).where(F.col("above") <= F.col("depth"))
        sums = pairs.groupBy(F.col("above").alias("depth"), "a", "b")
        return sums.agg(*[F.sum(v).alias(v) for v in values])

    if deepest < width:
        return within_bands(nodes)
    partial = within_bands(nodes)
    keyed = nodes.drop(*values)
    roots = store(keyed.where(F.col("depth") % width == 0).join(partial, KEY))
    complete = _subtree_totals(paths, roots, values, deepest, band, width)
    # What hangs from a node: the complete sums of the band roots one step below it.
    hanging = keyed.where((F.col("depth") % width == 0) & (F.col("depth") > 0))
    hanging = hanging.join(complete, KEY).select(
        "conv_id", (F.col("depth") - step).alias("above"), *values
    )
    hung = hanging.join(steps.drop("band"), ["conv_id", "above"])
    hung = hung.groupBy(F.col("above").alias("depth"), "a", "b").agg(
        *[F.sum(v).alias(f"_{v}") for v in values]
    )
    joined = nodes.join(hung, KEY, "left")
    added = {v: F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0)) for v in values}
    return within_bands(store(joined.withColumns(added).drop(*[f"_{v}" for v in values])))


def prefix_trie(turns: DataFrame, band: int = 16) -> Trie:
    """The trie of the conversations in ``turns`` (conv_id, at, a, b, words).

    A row with a negative ``at`` only says that its conversation exists (see
    ``with_shared_leads``); without such rows every conversation needs one. ``nodes``:
    depth, a, b, conv_id (smallest member), parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens over the subtree. Without conversations there is no node.
    """
    paths = store(_prefixes(turns))
    nodes = store(
        paths.groupBy(KEY)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("words").alias("words"),
            F.min("turn_a").alias("turn_a"),
            F.min("turn_b").alias("turn_b"),
        )
        .select(
            *KEY,
            "conv_id",
            "n_convs",
            "words",
            (F.col("depth") - 1).alias("up_depth"),
            F.col("a").bitwiseXOR(F.col("turn_a")).alias("up_a"),
            F.col("b").bitwiseXOR(F.col("turn_b")).alias("up_b"),
        )
    )
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest")).first()
    placed = store(
        _with_parents(nodes, size["n"])
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words"))
        .drop("up_depth", "up_a", "up_b", "words")
    )
    values = ["n_leaves", "saved_tokens"]
    totals = _subtree_totals(
        paths, placed.select(*KEY, "conv_id", *values), values, size["deepest"] or 0, band
    )
    last = paths.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("last"))
    return Trie(
        placed.drop(*values).join(totals, KEY), last.select("last.*", "conv_id")
    )


def _hashed_streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the joined chunks of each node; a partition's rows come in order."""
    at, state = None, None

    def row() -> pd.DataFrame:
        return pd.DataFrame([(*at, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    for batch in batches:
        for *key, ids in batch[[*KEY, "ids"]].itertuples(index=False):
            if key != at:
                if at is not None:
                    yield row()
                at, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if at is not None:
        yield row()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): SHA-256 of the ascending, comma-joined conv_ids of a node.

    Ids are sorted and joined in chunks by range partitions; a node of one chunk is
    hashed at once, the chunks of a larger one stream through one hash in order.
    """
    ranged = ends.repartitionByRange(*KEY, "conv_id").withColumn("part", F.spark_partition_id())
    number = F.row_number().over(Window.partitionBy(*KEY, "part").orderBy("conv_id"))
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    chunks = store(
        ranged.withColumn("chunk", F.floor((number - 1) / CHUNK))
        .groupBy(*KEY, "part", "chunk")
        .agg(F.array_join(ids, ",").alias("ids"))
    )
    large = store(chunks.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    small = chunks.join(large, KEY, "left_anti").select(
        *KEY, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256")
    )
    streams = chunks.join(large, KEY, "left_semi").repartition(*KEY)
    streams = streams.sortWithinPartitions(*KEY, "part", "chunk").select(*KEY, "ids")
    schema = "depth long, a long, b long, ends_sha256 string"
    return small.union(streams.mapInPandas(_hashed_streams, schema))


def conversation_trie(conversations: DataFrame, band: int = 16) -> DataFrame:
    """One row per trie node of the rebuilt conversations, with the digest of its ends.

    Nulls, ties and repeated rows: see ``ordered_turns``. Other columns are ignored;
    an empty table gives no rows.
    """
    trie = prefix_trie(with_shared_leads(ordered_turns(conversations)), band)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    joined = trie.nodes.join(ends_digests(trie.ends), KEY, "left")
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
