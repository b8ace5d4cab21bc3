"""Votes of forests whose trees are grown in tasks and never gathered.

Spark's forest keeps all trees on the driver and sends a full histogram for every node from
every partition, so that unlimited trees cost nodes x partitions. Here the rows are dealt
by (held-out fold, block of trees), and a task draws the bags of its trees and grows them where
the rows are; only votes, summed over the block, leave the task. Where there are more than
``group_rows`` rows, the bags are dealt instead, and a tree is first split by histograms that
Spark sums, node by node, until the rows below every node fit one group.

Trees are those of a random forest: Poisson bags, square root of the features at each node,
Gini impurity, thresholds from quantiles of the training rows; features are numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise
from math import ceil, exp, factorial, sqrt

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.session import stable

#: Stands for a fold without rows: trees of all rows, which are also scored.
NO_FOLD = -1
#: Records of a task that grows trees of dealt bags, about.
_TASK_ROWS = 100_000
#: Trees of a block, as long as they have no more than so many rows together; at least the first.
_BLOCK_TREES, _BLOCK_ROWS = (8, 25), 1_000_000
#: Rows of the trees that are grown at once.
_LIVE_ROWS = 250_000
#: Histogram cells that are held at once.
_CELLS = 200_000
_TREE = ["held", "tree"]
_NODE = [*_TREE, "node"]


def _gains(own, rest, rows_left, rows_right, square, rows):
    """Gain in purity of cuts by the squares of class weights on both sides."""
    return own / np.maximum(rows_left, 1) + rest / np.maximum(rows_right, 1) - square / np.maximum(rows, 1)


def _highest(gain: np.ndarray, rows_less: np.ndarray, leasts: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each least number of rows in a leaf: the place of every line's best cut and whether it gains."""
    lines = np.arange(len(gain))
    for least in leasts:
        allowed = np.where(rows_less >= least, gain, 0)
        best = allowed.argmax(axis=1)
        yield best, allowed[lines, best] > 1e-9


def _best_splits(hist: np.ndarray, leasts: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of (bins, classes, nodes, features), which is overwritten: (leasts, nodes) with each node's
    feature, -1 for none, and last bin on the left."""
    n_bins, classes, nodes, features = hist.shape
    left = hist.reshape(n_bins, classes, -1)
    for i in range(1, n_bins):
        left[i] += left[i - 1]
    whole, left = left[-1], left[:-1]
    rows, rows_left, square = whole.sum(axis=0), left.sum(axis=1), np.einsum("cx,cx->x", whole, whole)
    own = np.einsum("bcx,bcx->bx", left, left)
    # The squares of what is right of a cut, without holding it.
    rest = square - 2 * np.einsum("bcx,cx->bx", left, whole) + own
    gain = _gains(own, rest, rows_left, rows - rows_left, square, rows)

    def by_node(x: np.ndarray) -> np.ndarray:
        return x.reshape(-1, nodes, features).transpose(1, 2, 0).reshape(nodes, -1)

    feature, cut = np.empty((2, len(leasts), nodes), dtype=np.int64)
    for i, (best, gains) in enumerate(_highest(by_node(gain), by_node(np.minimum(rows_left, rows - rows_left)), leasts)):
        slot, cut[i] = np.divmod(best, n_bins - 1)
        feature[i] = np.where(gains, slot, -1)
    return feature, cut


def _few_rows_splits(bins, label, weight, leasts) -> tuple[np.ndarray, np.ndarray]:
    """As ``_best_splits``, of nodes with few rows, which are compared pair by pair: (rows, nodes,
    features) and two times (rows, nodes), rows that aren't there weigh 0."""
    n, nodes, features = bins.shape
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    # Of two rows the second comes first only with a smaller bin.
    swapped = [(bins[j] < bins[i]).astype(weight.dtype) for i, j in pairs]

    def up_to(own: np.ndarray) -> np.ndarray:
        """Of (rows, nodes or more): sums over the rows from the first in order to each."""
        out = np.broadcast_to(np.cumsum(own, axis=0), bins.shape).copy()
        for (i, j), s in zip(pairs, swapped, strict=True):
            out[i] += s * own[j]
            out[j] -= s * own[i]
        return out

    same = np.zeros_like(swapped[0], shape=bins.shape)  # weight of the rows of a class before each
    every = np.array(weight)  # and of all of them
    for (i, j), s in zip(pairs, swapped, strict=True):
        alike = label[i] == label[j]
        to_i, to_j = weight[j] * alike, weight[i] * alike
        every[i] += to_i
        every[j] += to_j
        same[i] += s * to_i[:, None]
        same[j] += (1 - s) * to_j[:, None]
    w = weight[:, :, None]
    own, rows_left = up_to(w * (2 * same + w)), up_to(w)
    square, rows = (weight * every).sum(axis=0)[:, None], weight.sum(axis=0)[:, None]
    rest = square - 2 * up_to(w * every[:, :, None]) + own
    gain = _gains(*(x.astype(np.float64) for x in (own, rest, rows_left, rows - rows_left, square, rows)))
    less = np.minimum(rows_left, rows - rows_left)
    less[np.broadcast_to(w == 0, less.shape)] = 0
    for i, j in pairs:
        # The last row in order of those in a bin stands for them.
        less[i][(bins[i] == bins[j]) & (weight[j] > 0)[:, None]] = 0
    gain, less, cuts = (x.transpose(1, 0, 2).reshape(nodes, -1) for x in (gain, less, bins))
    feature, cut = np.empty((2, len(leasts), nodes), dtype=np.int64)
    for i, (best, gains) in enumerate(_highest(gain, less, leasts)):
        feature[i], cut[i] = np.where(gains, best % features, -1), cuts[np.arange(nodes), best]
    return feature, cut


def _picked(rng: np.random.Generator, nodes: int, features: int) -> np.ndarray:
    """(nodes, picked): the features each node may split by."""
    most = ceil(sqrt(features))
    return rng.random((nodes, features)).argpartition(most - 1, axis=1)[:, :most]


def _node_splits(bins, label, weight, live, at, nodes, shape, leasts, rng) -> tuple[np.ndarray, np.ndarray]:
    """(leasts, nodes): feature, -1 for none, and cut of each of ``nodes``; ``weight`` and ``at``, a node, go with ``live``, rows."""
    n_bins, classes = shape
    number = np.full(int(at.max()) + 1, -1)
    number[nodes] = np.arange(len(nodes))
    mine = number[at]
    own = np.flatnonzero(mine >= 0)
    mine = mine[own]
    # Sixteen bits are sorted by counting.
    order = np.argsort(mine.astype(np.uint16) if len(nodes) <= 1 << 16 else mine, kind="stable")
    own = own[order]
    rows, weight, sizes = live[own], weight[own], np.bincount(mine, minlength=len(nodes))
    first = np.cumsum(sizes) - sizes
    flat, width = bins.ravel(), bins.shape[1]
    picked = _picked(rng, len(nodes), width)
    features = picked.shape[1]
    feature, cut = np.empty((2, len(leasts), len(nodes)), dtype=np.int64)

    def keep(some: np.ndarray, found: tuple[np.ndarray, np.ndarray]) -> None:
        slot, cut[:, some] = found
        feature[:, some] = np.where(slot < 0, -1, picked[some, slot])

    low = 0
    for most in (2, 4, 8):
        few = np.flatnonzero((sizes > low) & (sizes <= most))
        step = max(1, 2 * _CELLS // (most * most * features))
        for some in (few[i : i + step] for i in range(0, len(few), step)):
            place = np.arange(most)[:, None]
            entry = np.minimum(first[some] + place, len(rows) - 1)
            row, held = rows[entry], np.where(place < sizes[some], weight[entry], 0).astype(np.float32)
            found = flat.take((row * width)[:, :, None] + picked[some])
            keep(some, _few_rows_splits(found, label[row], held, leasts))
        low = most
    many = np.flatnonzero(sizes > low)
    step = max(1, _CELLS // (features * n_bins * classes))
    for some in (many[i : i + step] for i in range(0, len(many), step)):
        n, ends = len(some), np.cumsum(sizes[some])
        node = np.repeat(np.arange(n), sizes[some])
        entry = np.arange(ends[-1]) + (first[some] - ends + sizes[some])[node]
        row = rows[entry]
        cell = flat.take(picked[some].take(node, axis=0) + (row * width)[:, None]) * np.int64(classes * n * features)
        cell += ((label[row] * n + node) * features)[:, None]
        cell += np.arange(features)
        hist = np.bincount(cell.ravel(), np.repeat(weight[entry], features), n_bins * classes * n * features)
        keep(some, _best_splits(hist.reshape(n_bins, classes, n, features), leasts))
    return feature, cut


def _end_shares(bins, label, weight, shape, least, limits, depth, rng, scored=None) -> np.ndarray:
    """(leasts x limits, scored rows, classes): class shares at the node where each row ends,
    summed over the trees if ``weight`` is (trees, rows).

    A tree is grown to the greatest depth; under a limit (depth, rows of a split) a row ends
    at the first node of its way that the limit wouldn't have split. The trees of several
    ``least`` share the nodes down to where their splits part. A node is split only where
    scored rows (without ``scored`` all) pass it.
    """
    leasts, weight, classes = np.atleast_1d(least), np.atleast_2d(weight), shape[1]
    trees, deepest = len(weight), max(d for d, _ in limits)
    score = np.arange(len(label)) if scored is None else np.flatnonzero(scored)
    out = np.zeros((len(leasts), len(limits), trees * len(score), classes))
    # Training rows with their node and weight, and scored rows with node and place.
    at, live = np.nonzero(weight > 0)
    weight, place = weight[at, live], np.arange(trees * len(score))
    score, score_at = np.tile(score, trees), np.repeat(np.arange(trees), len(score))
    # Whose nodes they are, and which limits end above them.
    whose, past = np.ones((len(leasts), trees), dtype=bool), np.zeros((len(limits), trees), dtype=bool)
    while len(place):
        n = whose.shape[1]
        counts = np.bincount(at * classes + label[live], weight, n * classes).reshape(n, classes)
        rows = counts.sum(axis=1)
        share = counts / np.maximum(rows, 1)[:, None]
        stop = np.array([(rows < split_rows) | (depth >= most) for most, split_rows in limits])
        wanted = whose & (rows >= 2 * leasts[:, None]) & (counts.max(axis=1) < rows)
        wanted &= ~(past | stop).all(axis=0) & (depth < deepest)
        feature, cut = np.full((len(leasts), n), -1), np.zeros((len(leasts), n), dtype=np.int64)
        nodes = np.flatnonzero(wanted.any(axis=0))
        if len(nodes):
            feature[:, nodes], cut[:, nodes] = _node_splits(bins, label, weight, live, at, nodes, shape, leasts, rng)
        feature[~wanted] = -1
        for i, own in enumerate(whose):
            for j in range(len(limits)):
                ends = np.flatnonzero((own & ~past[j] & (stop[j] | (feature[i] < 0)))[score_at])
                out[i, j, place[ends]] = share[score_at[ends]]
        # The first with a split makes its nodes, the others join them.
        leader = np.tile(np.arange(len(leasts))[:, None], (1, n))
        for i in range(1, len(leasts)):
            for j in range(i):
                joins = (leader[i] == i) & (feature[j] == feature[i]) & (cut[j] == cut[i])
                leader[i, joins] = leader[j, joins]
        below, made = [], 0
        for i in range(len(leasts)):
            mine = np.flatnonzero((leader[i] == i) & (feature[i] >= 0))
            number = np.full(n, -1)
            number[mine] = made + np.arange(len(mine))
            made += len(mine)

            def children(rows, at, number=number, split=feature[i], last=cut[i]):
                go = np.flatnonzero(number[at] >= 0)
                at = at[go]
                return go, 2 * number[at] + (bins[rows[go], split[at]] > last[at])

            members = (leader[:, mine] == i) & (feature[:, mine] >= 0)
            below.append((*children(live, at), *children(score[place], score_at), members, (past | stop)[:, mine]))
        go, at, score_go, score_at = (np.concatenate([b[k] for b in below]) for k in range(4))
        # Nodes that scored rows have reached are numbered anew.
        reached = np.bincount(score_at, minlength=2 * made) > 0
        number = np.where(reached, np.cumsum(reached) - 1, -1)
        whose, past = (np.repeat(np.concatenate([b[k] for b in below], axis=1), 2, axis=1)[:, reached] for k in (4, 5))
        at, score_at, place, depth = number[at], number[score_at], place[score_go], depth + 1
        kept = np.flatnonzero(at >= 0)
        at, go = at[kept], go[kept]
        live, weight = live[go], weight[go]
    return out.reshape(len(leasts) * len(limits), trees, -1, classes).sum(axis=1)


def _binned(table: DataFrame, held: Sequence[int], n_bins: int) -> DataFrame:
    """A line per row and held-out fold, with the bins of its features among the training rows."""
    values = table.select("fold", F.posexplode(vector_to_array("features")).alias("feature", "x"))
    at = [i / (n_bins - 1) for i in range(n_bins - 1)]
    found = values.groupBy("feature").agg(
        *[F.percentile_approx(F.when(F.col("fold") != h, F.col("x")), at).alias(f"e{i}") for i, h in enumerate(held)]
    )
    lines = sorted(found.collect())
    edges = [[np.unique(line[i + 1] or []) for line in lines] for i in range(len(held))]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h, own in zip(held, edges, strict=True):
                if len(batch):
                    x = np.stack(batch["x"].to_numpy())
                    bins = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(own)], axis=1)
                    yield batch.drop(columns="x").assign(held=h, bins=list(bins.astype(np.int8)))

    rows = table.select(
        F.monotonically_increasing_id().alias("row"), F.col("label").cast("int").alias("label"), "fold",
        vector_to_array("features").alias("x"),
    )
    lines = rows.mapInPandas(number, "row long, label int, fold int, held int, bins array<tinyint>")
    scored = (F.col("fold") == F.col("held")) | (F.col("held") == NO_FOLD)
    return stable(lines.withColumn("scored", scored))


def _bags(lines: DataFrame, trees: int, seed: int) -> DataFrame:
    """The rows of every tree, with how often its bag has them; scored rows outside weigh 0."""
    draw = F.shiftrightunsigned(F.xxhash64("row", "held", "tree", F.lit(seed)), 11) / float(1 << 53)
    chance = np.cumsum([exp(-1) / factorial(k) for k in range(12)])
    times = sum(((draw >= float(c)).cast("int") for c in chance), F.lit(0))
    bags = lines.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    weight = F.when(F.col("fold") == F.col("held"), 0).otherwise(times)
    bags = bags.withColumn("weight", weight).where("weight > 0 OR scored").drop("fold")
    return bags.withColumn("node", F.lit(1).cast("long"))


def _split_large(bags: DataFrame, shape, features: int, least: int, deepest: int, group_rows: int, seed: int):
    """Bags whose nodes have at most ``group_rows`` rows or end, and {(held, tree, node):
    (feature, cut, class counts)} of the nodes above and of large ones that end (feature -1).
    The children of node n are 2n and 2n + 1."""
    spark, (n_bins, classes) = bags.sparkSession, shape
    top: dict[tuple, tuple] = {}
    while True:
        sizes = bags.groupBy(*_NODE).count().where(F.col("count") > group_rows).collect()
        large = [tuple(r)[:3] for r in sizes if tuple(r)[:3] not in top]
        if not large:
            return bags, top
        picks = {k: _picked(np.random.default_rng([seed, k[0] + 1, *k[1:]]), 1, features)[0].tolist() for k in large}
        places = spark.createDataFrame([(*k, v) for k, v in picks.items()], "held int, tree int, node long, picked array<int>")
        cells = (
            bags.where("weight > 0").join(F.broadcast(places), _NODE).withColumn("feature", F.explode("picked"))
            .groupBy(*_NODE, "feature", F.get("bins", "feature").cast("int").alias("bin"), "label")
            .agg(F.sum("weight").alias("weight"))
        )

        def split(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            own, slot = np.unique(part["feature"].to_numpy(), return_inverse=True)
            hist = np.zeros((n_bins, classes, 1, len(own)))
            hist[part["bin"], part["label"], 0, slot] = part["weight"]
            counts = hist[..., 0].sum(axis=(0, 2))
            ((feature,),), ((cut,),) = _best_splits(hist, [least])
            if key[2] >= 1 << deepest:
                feature = -1
            line = (*key, own[feature] if feature >= 0 else -1, cut, counts)
            return pd.DataFrame([line], columns=[*_NODE, "feature", "cut", "counts"])

        kind = "held int, tree int, node long, feature int, cut int, counts array<double>"
        found = cells.groupBy(*_NODE).applyInPandas(split, kind).collect()
        top |= {tuple(r)[:3]: (r["feature"], r["cut"], np.array(r["counts"])) for r in found}
        # A node without training rows isn't split either.
        top |= {k: (-1, 0, np.zeros(classes)) for k in large if k not in top}
        cuts = spark.createDataFrame(
            [(*k, *top[k][:2]) for k in large if top[k][0] >= 0], "held int, tree int, node long, feature int, cut int"
        )
        below = 2 * F.col("node") + (F.get("bins", "feature") > F.col("cut")).cast("long")
        bags = bags.join(F.broadcast(cuts), _NODE, "left")
        bags = bags.withColumn("node", F.coalesce(below, "node")).drop("feature", "cut")


def _blocks(sizes: Sequence[int], most: int) -> list[tuple[int, int, int]]:
    """(first tree, end, size) of blocks of at most ``most`` trees, each within a step of ``sizes``."""
    found = []
    for size, (low, high) in enumerate(pairwise([0, *sizes])):
        edges = np.linspace(low, high, ceil((high - low) / most) + 1).astype(int).tolist()
        found += [(*ends, size) for ends in pairwise(edges)]
    return found


def _lines_of(shares: np.ndarray, names: Sequence[str], row: np.ndarray, label: np.ndarray) -> pd.DataFrame:
    """A line per point and row of (points, rows, classes)."""
    points = len(shares)
    votes = pd.DataFrame(shares.reshape(-1, len(names)), columns=list(names))
    return votes.assign(row=np.tile(row, points), label=np.tile(label, points), point=np.repeat(np.arange(points), len(row)))


def _block_votes(lines: DataFrame, rows: int, folds: int, sizes, shape, limits, leaf_rows, names, kind, seed: int) -> DataFrame:
    """Votes of all trees; a group has all lines of a held-out fold and grows a block of trees."""
    least, most = _BLOCK_TREES
    blocks = _blocks(sizes, min(most, max(least, _BLOCK_ROWS // rows)))

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        held, (low, high, size) = key[0], blocks[key[1]]
        group = group.sort_values("row")
        bins, label = np.stack(group["bins"].to_numpy()), group["label"].to_numpy().astype(np.int64)
        scored = group["scored"].to_numpy()
        shares, step = 0, max(1, _LIVE_ROWS // len(group))
        for first in range(low, high, step):
            trees = range(first, min(first + step, high))
            weight = np.stack([np.random.default_rng([seed, held + 1, t]).poisson(1, len(group)) for t in trees]).astype(float)
            if held != NO_FOLD:
                weight[:, scored] = 0
            rng = np.random.default_rng([seed, held + 1, first, len(trees)])
            shares = shares + _end_shares(bins, label, weight, shape, leaf_rows, limits, 0, rng, scored)
        return _lines_of(shares, names, group["row"].to_numpy()[scored], label[scored]).assign(held=held, size=size)

    keys = ["held", "block"]
    dealt = lines.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))))
    dealt = dealt.select(*keys, "row", "label", "scored", "bins")
    # More tasks than groups, so that few tasks get several.
    return dealt.repartition(3 * folds * len(blocks), *keys).groupBy(*keys).applyInPandas(grow, kind)


def _bag_votes(
    lines: DataFrame, rows: int, trees: int, sizes, shape, features: int, limits, leaf_rows, names, kind, seed, group_rows: int
) -> DataFrame:
    """Votes of all trees; a group has the rows below a node of a tree."""
    spark, deepest = lines.sparkSession, max(d for d, _ in limits)
    bags = _bags(lines, sizes[-1], seed)
    bags, top = _split_large(bags, shape, features, max(leaf_rows), deepest, group_rows, seed)
    ended = [k for k, v in top.items() if v[0] < 0]
    slices = ceil(rows / group_rows)
    part = F.lit(0).cast("long")
    if ended:
        # Large nodes that end aren't grown: their scored rows are dealt at will.
        marks = spark.createDataFrame([(*k, True) for k in ended], "held int, tree int, node long, ended boolean")
        bags = bags.join(F.broadcast(marks), _NODE, "left").where("ended IS NULL OR scored")
        part = F.when(F.col("ended"), F.pmod("row", F.lit(slices))).otherwise(part)
    above = spark.sparkContext.broadcast(top)

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        held, tree, node, _ = key
        depth, scored = int(node).bit_length() - 1, group["scored"].to_numpy()
        way = [above.value.get((held, tree, node >> up)) for up in range(depth, -1, -1)]
        bins, classes = np.stack(group["bins"].to_numpy()), group["label"].to_numpy().astype(np.int64)
        weight = group["weight"].to_numpy().astype(np.float64)
        if way[-1] is None:
            rng = np.random.default_rng([seed, held + 1, tree, node])
            shares = _end_shares(bins, classes, weight, shape, leaf_rows, limits, depth, rng, scored)
        else:
            shares = np.zeros((len(leaf_rows) * len(limits), int(scored.sum()), shape[1]))
        for point, own in enumerate(shares):
            most, split_rows = limits[point % len(limits)]
            for level, line in enumerate(way):
                if line is not None and (level >= most or line[2].sum() < split_rows or line[0] < 0):
                    own[:] = line[2] / max(line[2].sum(), 1)
                    break
        votes = _lines_of(shares, names, group["row"].to_numpy()[scored], classes[scored])
        return votes.assign(held=held, size=int(np.searchsorted(sizes, tree, side="right")))

    tasks = max(4 * spark.sparkContext.defaultParallelism, rows * trees // _TASK_ROWS)
    keys = [*_NODE, "part"]
    groups = bags.withColumn("part", part).select(*keys, "row", "label", "weight", "scored", "bins")
    return groups.repartition(tasks, *keys).groupBy(*keys).applyInPandas(grow, kind)


def forest_predictions(
    table: DataFrame,
    held: Sequence[int],
    sizes: Sequence[int],
    limits: Sequence[tuple[int, int]],
    leaf_rows: Sequence[int],
    seed: int = 42,
    max_bins: int = 16,
    group_rows: int = 250_000,
) -> DataFrame:
    """(held, row, label, point, size, prediction): classes by forests of the first trees.

    ``table`` is stored and has ``features``, ``label`` (classes 0, 1, ...) and ``fold``. For
    each of ``held`` the trees learn from the other folds and score that one, ``NO_FOLD``
    all rows from all. ``point`` numbers leaf_rows x limits, ``size`` the ascending ``sizes``.
    """
    if not 2 <= max_bins <= 128:
        raise ValueError("max_bins must be from 2 to 128")
    width = F.size(vector_to_array("features"))
    label = F.col("label")
    facts = table.agg(
        F.count(F.lit(1)).alias("rows"), F.max("label").alias("top"), F.min(width).alias("least"), F.max(width).alias("most"),
        F.count_if(label.isNull() | (label < 0) | (label != F.floor(label))).alias("wrong"),
    ).first()
    if not facts["rows"] or facts["wrong"] or facts["least"] != facts["most"]:
        raise ValueError("forests need rows, classes 0, 1, ... and vectors of one length")
    rows, shape = facts["rows"], (max_bins, int(facts["top"]) + 1)
    names = [f"v{c}" for c in range(shape[1])]
    kind = ", ".join(f"{n} double" for n in names) + ", row long, label int, point int, held int, size int"
    lines, rest = _binned(table, held, max_bins), (names, kind, seed)
    if rows <= group_rows:
        votes = _block_votes(lines, rows, len(held), sizes, shape, limits, leaf_rows, *rest)
    else:
        trees = len(held) * sizes[-1]
        votes = _bag_votes(lines, rows, trees, sizes, shape, facts["most"], limits, leaf_rows, *rest, group_rows)
    own = ["held", "row", "label", "point"]
    votes = votes.groupBy(*own, "size").agg(*[F.sum(n).alias(n) for n in names])
    # Fewer than 200 lines a row: the first trees are the smaller forests.
    first = Window.partitionBy(*own).orderBy("size")
    # Rounded, so that the order of the sum doesn't decide a tie.
    total = F.array(*[F.round(F.sum(n).over(first), 9) for n in names])
    best = F.array_position(total, F.array_max(total)) - 1
    return votes.select(*own, "size", best.cast("int").alias("prediction"))
