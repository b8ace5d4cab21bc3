"""Forests grown in tasks: no tree on the driver, large nodes split first, limits kept."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import forests, models, tuning
from marlstone.session import stable


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        x, y, z = (rng.uniform(-1, 1) for _ in range(3))
        rows.append((x, y, z, float((x > 0) + (x * y > 0.1))))
    df = spark.createDataFrame(rows, "x double, y double, z double, label double").coalesce(2)
    return stable(models.assemble_columns(df, ["x", "y", "z"]))


def accuracy(found):
    return found.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def test_a_search_gathers_no_forest(points, monkeypatch):
    """A forest of unlimited trees on the driver is what kept the grid from ending."""

    def refuse(**_):
        raise AssertionError("a forest on the driver")

    monkeypatch.setattr(tuning, "forest", refuse)
    search = tuning.forest_search(points, [3, 20], [2, 30], [1, 4], folds=3)
    assert len(search.points) == 8 and max(search.metrics) > 0.8
    assert accuracy(tuning.refit_predictions(search, points)) > 0.9


def test_it_is_as_good_as_sparks_own_forest(points):
    grid = {"numTrees": [30], "maxDepth": [2, 10]}
    spark_points = {
        r["params"]: r["metric"]
        for r in models.grid_results(models.grid_search(models.forest(seed=2), grid, points, folds=4)).collect()
    }
    own = tuning.forest_search(points, [30], [2, 10], folds=4)
    for point, metric in zip(own.points, own.metrics, strict=True):
        name = f"maxDepth={point['maxDepth']}, numTrees=30"
        assert metric == pytest.approx(spark_points[name], abs=0.08)


def test_large_nodes_are_split_before_they_are_grouped(points):
    """Trees of more rows than a group may have, down to nodes of 100 rows."""
    table = tuning._folded(points, 3, 5)
    limits = [(1, 2), (30, 2), (30, 150)]
    args = (table, range(3), [2, 12], limits, [1, 5])
    whole, cut = (forests.forest_predictions(*args, group_rows=n).cache() for n in (50_000, 100))
    # Every row once a point and number of trees.
    assert whole.count() == cut.count() == 400 * len(limits) * 2 * 2
    for point in range(6):
        at = (F.col("point") == point) & (F.col("size") == 1)
        assert accuracy(cut.where(at)) == pytest.approx(accuracy(whole.where(at)), abs=0.08)

    bags = forests._bags(forests._binned(table, range(3), 16), 4, 5)
    bags, top = forests._split_large(bags, (16, 3), 3, 1, 30, 100, 5)
    sizes = bags.groupBy("held", "tree", "node").count().collect()
    assert all(r["count"] <= 100 or top[tuple(r)[:3]][0] < 0 for r in sizes)
    assert len(top) > 12


def test_equal_rows_end_in_a_large_node(spark):
    """Copies can't be split; their node is larger than a group and scored in slices."""
    rows = [(1.0, 2.0, float(i % 4 == 0)) for i in range(300)] + [(5.0, 2.0, 1.0)] * 60
    df = models.assemble_columns(spark.createDataFrame(rows, "x double, y double, label double"), ["x", "y"])
    table = tuning._folded(df.coalesce(1), 2, 1)
    found = forests.forest_predictions(table, range(2), [9], [(5, 2)], [1], group_rows=50)
    assert found.count() == 360
    kept = found.groupBy("label").agg(F.sum("prediction").alias("ones")).orderBy("label").collect()
    assert [r["ones"] for r in kept] == [0, 60]


def test_limits_hold_within_a_tree():
    rng = np.random.default_rng(1)
    bins, label = rng.integers(0, 16, (200, 5)).astype(np.int8), rng.integers(0, 3, 200)
    weight = np.ones(200)
    limits = [(0, 2), (30, 2), (30, 100)]
    root, deep, few = forests._end_shares(bins, label, weight, (16, 3), 1, limits, 0, rng)
    assert np.allclose(root, np.bincount(label, minlength=3) / 200)
    # Grown without a limit, every row's own class is its leaf's.
    assert (deep.argmax(axis=1) == label).mean() > 0.98 and len(np.unique(few, axis=0)) < 20
    (large,) = forests._end_shares(bins, label, weight, (16, 3), 40, [(30, 2)], 0, rng)
    _, rows = np.unique(large, axis=0, return_counts=True)
    assert rows.min() >= 40


def test_labels_and_vectors_are_checked(spark, points):
    wrong = points.withColumn("label", F.col("label") + 0.5)
    with pytest.raises(ValueError, match="classes"):
        tuning.forest_search(wrong, [2], [2])
    with pytest.raises(ValueError, match="classes"):
        tuning.forest_search(points.withColumn("label", F.when(F.rand(1) > 0.5, 1.0)), [2], [2])


def test_rows_are_dealt_by_blocks_of_trees(points, monkeypatch):
    """A bag and a vote per tree and row is what took the time and disk of large tables."""

    def refuse(*_):
        raise AssertionError("a bag for each tree")

    monkeypatch.setattr(forests, "_bags", refuse)
    monkeypatch.setattr(forests, "_BLOCK_TREES", (1, 3))
    table = tuning._folded(points, 2, 5)
    found = forests.forest_predictions(table, range(2), [2, 9], [(30, 2)], [1, 4])
    assert found.count() == 400 * 2 * 2 and accuracy(found.where("size = 1 AND point = 0")) > 0.85
    blocks = forests._blocks([2, 9], 3)
    assert sorted(t for low, high, _ in blocks for t in range(low, high)) == list(range(9))
    assert all(high - low <= 3 and size == (low >= 2) for low, high, size in blocks)


def test_trees_of_several_leaf_sizes_grow_together():
    """Each keeps its own limit, however much of the tree they share; trees add up."""
    rng = np.random.default_rng(3)
    bins, label = rng.integers(0, 16, (300, 9)).astype(np.int8), rng.integers(0, 3, 300)
    weight, scored = rng.poisson(1, (2, 300)).astype(float), np.arange(300) % 3 == 0
    shares = forests._end_shares(bins, label, weight, (16, 3), (1, 40), [(1, 2), (30, 2)], 0, rng, scored)
    assert shares.shape == (4, 100, 3) and np.allclose(shares.sum(axis=2), 2)
    # The first cut is far from either limit here, and so the same.
    assert np.allclose(shares[0], shares[2])
    # Leaves of one class without a limit, of several with it.
    assert (shares[1] % 1 == 0).all() and (shares[3] % 1 > 0).any(axis=1).all()


def test_few_rows_are_split_as_many_are():
    """Nodes compared pair by pair have the gain of the best cut that a histogram finds."""
    rng = np.random.default_rng(7)
    for _ in range(200):
        rows, least = int(rng.integers(2, 9)), int(rng.integers(1, 4))
        bins, label = rng.integers(0, 5, (rows, 3)), rng.integers(0, 3, rows)
        weight = rng.integers(1, 4, rows).astype(float)
        hist = np.zeros((5, 3, 1, 3))
        for k in range(3):
            np.add.at(hist, (bins[:, k], label, 0, k), weight)
        held = np.append(weight, 0.0)[:, None]  # one row that isn't there
        few = forests._few_rows_splits(
            np.append(bins, bins[:1], axis=0)[:, None], np.append(label, 0)[:, None], held, [least]
        )
        (feature,), (cut,) = (x[0] for x in forests._best_splits(hist, [least]))
        (own,), (own_cut,) = (x[0] for x in few)
        assert (own < 0) == (feature < 0)

        def gain(feature, cut):
            left = bins[:, feature] <= cut
            assert least <= weight[left].sum() <= weight.sum() - least
            return sum(np.square(np.bincount(label[s], weight[s])).sum() / weight[s].sum() for s in (left, ~left))

        if own >= 0:
            assert gain(own, own_cut) == pytest.approx(gain(feature, cut))
