"""Model operators on small separable data: shape, stability, and better than guessing."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from marlstone.operators import evaluate, models, scaling, stepwise
from marlstone.session import scratch_path


@pytest.fixture(scope="module")
def points(spark):
    """Two classes split by x; y is noise."""
    rng = random.Random(11)
    rows = []
    for i in range(300):
        x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
        rows.append((i, x, y, float(x + 0.1 * rng.uniform(-1, 1) > 0)))
    df = spark.createDataFrame(rows, "id long, x double, y double, label double").coalesce(2)
    return models.assemble_columns(df, ["x", "y"]).cache()


def accuracy(scored):
    return scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


@pytest.mark.parametrize(
    "make",
    [
        lambda: models.forest(numTrees=5, seed=1),
        lambda: models.boosted_trees(maxIter=3, seed=1),
        lambda: models.logistic(300),
        lambda: models.logistic(300, c=0.1, penalty="l1"),
        lambda: models.feed_forward([2, 4, 2], seed=1),
    ],
    ids=["forest", "boosted", "l2", "l1", "network"],
)
def test_classifiers_beat_the_majority(points, make):
    model = make().fit(points)
    assert accuracy(model.transform(points)) > 0.85
    scores = models.score(model, points.drop("label"), "id")
    assert scores.columns == ["id", "prediction", "probability"]
    assert scores.where("probability between 0 and 1").count() == 300


def test_seeded_training_repeats(points):
    first, second = (models.forest(numTrees=5, seed=3).fit(points).transform(points) for _ in range(2))
    both = first.select("id", F.col("prediction").alias("a")).join(
        second.select("id", F.col("prediction").alias("b")), "id"
    )
    assert both.where("a <> b").count() == 0


def test_grid_search_covers_the_grid(points):
    found = models.grid_search(models.forest(seed=1), {"numTrees": [2, 4], "maxDepth": [1, 2]}, points, folds=2)
    table = models.grid_results(found).collect()
    assert len(table) == 4 and sum(r["is_best"] for r in table) == 1
    best = next(r for r in table if r["is_best"])
    assert best["metric"] == max(r["metric"] for r in table)


def test_forward_selection_picks_the_telling_column_first(points):
    picked = stepwise.forward_select(points.drop("features"), ["y", "x"], k=2, folds=2, key="id")
    assert [name for name, _ in picked] == ["x", "y"]
    assert picked[0][1] > 0.9


def test_forward_selection_takes_half_of_the_features(points):
    table = points.drop("features").withColumns({"z": F.col("x") * 0 + 1.0, "w": F.col("y") * 2})
    picked = stepwise.forward_select(table, ["w", "x", "y", "z"], folds=3, key="id")
    assert [name for name, _ in picked][0] == "x" and len(picked) == 2
    assert all(0.0 <= auc <= 1.0 for _, auc in picked)


def plain_auc(x, y, fold, folds, c):
    """Mean held-out AUC of plainly fitted models, by ranks."""
    scores = []
    for at in range(folds):
        train, test = fold != at, fold == at
        if len(np.unique(y[train])) < 2 or len(np.unique(y[test])) < 2:
            continue
        full = np.column_stack([x, np.ones(len(x))])
        weight = np.where(y[train] == 1, 0.5 / y[train].mean(), 0.5 / (1 - y[train].mean()))
        penalty = np.append(np.full(x.shape[1], 1 / c), 1e-9)
        beta = np.zeros(full.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-full[train] @ beta))
            slope = full[train].T @ (weight * (p - y[train])) + penalty * beta
            curve = (full[train] * (weight * p * (1 - p))[:, None]).T @ full[train] + np.diag(penalty)
            beta -= np.linalg.solve(curve, slope)
        ranks, positive = pd.Series(full[test] @ beta).rank().to_numpy(), y[test] == 1
        n, m = positive.sum(), (~positive).sum()
        scores.append((ranks[positive].sum() - n * (n + 1) / 2) / (n * m))
    return float(np.mean(scores)) if scores else 0.5


def test_forward_selection_equals_plain_fits(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 6)) * [1, 5, 0.1, 2, 1, 1] + [0, 3, 9, 0, 0, 0]
    y = (x[:, 1] / 5 + 8 * x[:, 2] + 0.5 * x[:, 4] - 72.6 + rng.logistic(size=900) > 1).astype(float)
    names = [f"f{i}" for i in range(6)]
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(900)]
    schema = "id long, label double, " + ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame([*rows, (900, None, *[1e6] * 6)], schema).repartition(5)
    folds = {r[0]: r[1] for r in df.select("id", F.pmod(F.xxhash64("id"), F.lit(3)).cast("int")).collect()}
    fold = np.array([folds[i] for i in range(900)])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    want, left = [], list(range(6))
    for _ in range(4):
        chosen = [f for f, _ in want]
        scores = {f: plain_auc(z[:, [*chosen, f]], y, fold, 3, 1.0) for f in left}
        best = max(left, key=lambda f: (scores[f], -f))
        want.append((best, scores[best]))
        left.remove(best)
    picked = stepwise.forward_select(df, names, k=4, folds=3, key="id", bins=1 << 16)
    assert [n for n, _ in picked] == [names[f] for f, _ in want]
    assert [a for _, a in picked] == pytest.approx([a for _, a in want], abs=1e-4)
    monkeypatch.setattr(stepwise, "SUM_BYTES", 1)
    assert stepwise.forward_select(df, names, k=2, folds=3, key="id", bins=1 << 16) == picked[:2]


def test_forward_selection_sums_one_curvature_for_all_candidates(spark, monkeypatch):
    """After a step's first round, a candidate's X'WX is summed only where the shared one is slow."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] + 0.5 * x[:, 3] + rng.logistic(size=400) > 0).astype(float)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label double, a double, b double, c double, d double, e double")
    asked, shared = [], []
    sums_of = stepwise._newton_sums

    def counted(chosen, betas, slow, base, weights):
        asked.append((len(slow), len(betas)))
        shared.append(len(base))
        return sums_of(chosen, betas, slow, base, weights)

    monkeypatch.setattr(stepwise, "_newton_sums", counted)
    picked = stepwise.forward_select(df.repartition(3), ["a", "b", "c", "d", "e"], k=2, folds=3, key="id")
    assert [name for name, _ in picked] == ["a", "d"]
    own, fitted = np.sum(asked, axis=0)
    assert sum(shared) == 6 and own < fitted / 2


def test_forward_selection_without_usable_folds(spark):
    rows = [(i, 1.0, float(i), None) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, label double, a double, b double")
    assert stepwise.forward_select(df, ["a", "b"], k=2, folds=2, key="id") == [("a", 0.5), ("b", 0.5)]
    assert stepwise.forward_select(df.limit(0), ["a"], k=1, folds=2, key="id") == [("a", 0.5)]


def test_search_reaches_pipeline_stages_and_refits_the_best(spark):
    texts = [(i, ["wind", "solar"] if i % 2 else ["court", "goal"], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(texts, "id long, words array<string>, label double").coalesce(1)
    flow = Pipeline(stages=[models.text_embedder("tfidf", 32), models.logistic(60, maxIter=20)])
    grid = {"LogisticRegression.regParam": [1000.0, 0.01]}
    search = models.grid_search(flow, grid, df, folds=2)
    best = next(r for r in models.grid_results(search).collect() if r["is_best"])
    model = models.refit_best(search, df.where("id < 30"), df.where("id >= 30"))
    chosen = model.stages[-1].getOrDefault("regParam")
    assert best["params"] == f"regParam={chosen}"
    assert accuracy(model.transform(df)) == 1.0 or chosen == 1000.0
    with pytest.raises(ValueError, match="stages named"):
        models.grid_search(flow, {"GBTClassifier.maxIter": [1]}, df)


def test_a_search_fits_text_vectors_once_a_fold_in_a_bounded_number_of_partitions(spark, monkeypatch):
    texts = [(i, ["wind", "solar"] if i % 2 else ["court", "goal"], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(texts, "id long, words array<string>, label double").repartition(40)
    grid = {"LogisticRegression.regParam": [1000.0, 0.1, 0.01]}
    plain = Pipeline(stages=[models.text_embedder("tfidf", 32), models.logistic(60, maxIter=20)])
    want = models.grid_search(plain, grid, df, folds=2).avgMetrics
    seen = []
    rows_of = models.StoredPipeline._rows

    def counted(self, dataset):
        before, rows = rows_of(self, dataset)
        seen.append(rows.rdd.getNumPartitions())
        return before, rows

    monkeypatch.setattr(models.StoredPipeline, "_rows", counted)
    flow = models.text_classifier(models.logistic(60, maxIter=20), size=32)
    search = models.grid_search(flow, grid, df, folds=2)
    assert search.avgMetrics == pytest.approx(want)
    # Two folds and the best point on all rows.
    assert len(seen) == 3 and max(seen) <= spark.sparkContext.defaultParallelism
    assert accuracy(models.refit_best(search, df).transform(df)) == 1.0


def test_importances_name_every_slot(points):
    model = models.forest(numTrees=5, seed=1).fit(points)
    rows = models.feature_importance(model, points).collect()
    assert [r["name"] for r in rows] == ["x", "y"]
    assert sum(r["score"] for r in rows) == pytest.approx(1.0)


def test_encoder_keeps_training_order_on_a_holdout(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), ("c",)], "kind string")
    holdout = spark.createDataFrame([("a",), ("c",), ("new",)], "kind string")
    coded = models.encode_categories(train, holdout, ["kind"], "keep").collect()
    assert [r["kind_index"] for r in coded] == [2.0, 1.0, 3.0]  # b and c tie: alphabetical
    with pytest.raises(Exception, match="(?i)unseen"):
        models.encode_categories(train, holdout, ["kind"]).collect()


def test_formula_without_the_id(points):
    made = models.assemble(points.drop("features"), "label ~ . - id")
    assert models.feature_importance(models.forest(numTrees=2, seed=1).fit(made), made).count() == 2


def test_occlusion_of_the_deciding_block(spark, points):
    model = models.logistic(300).fit(points)
    rows = points.where("x > 0.5").select("id", F.array("x", "y").alias("v"))
    drops = models.occlusion_sensitivity(rows, model, "id", "v", 1, 2)
    by_block = {r["block"]: r["d"] for r in drops.groupBy("block").agg(F.avg("drop").alias("d")).collect()}
    assert by_block[0] > 0.2 and abs(by_block[1]) < 0.2


def test_text_classifier_survives_saving(spark):
    texts = [(i, ["wind", "solar"] if i % 2 else ["court", "goal"], float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(texts, "id long, words array<string>, label double").coalesce(1)
    flow = Pipeline(stages=[models.text_embedder("tfidf", 32), models.logistic(40)])
    model = models.refit(flow, df.where("id < 20"), df.where("id >= 20"))
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    relevant = models.classify_text(models.load_model(path), df)
    assert sorted(r["id"] for r in relevant.collect()) == list(range(1, 40, 2))


def test_user_supplied_text_scorer(spark):
    def scorer():
        import numpy as np

        return lambda texts: np.array([[float("bad" in t), float("good" in t)] for t in texts])

    df = spark.createDataFrame([(1, "good day"), (2, "bad day")], "id int, t string")
    rows = models.score_rows(df, "t", scorer, {0: "risk", 1: "chance"}, "label").collect()
    assert {r["id"]: r["label"] for r in rows} == {1: "chance", 2: "risk"}


def test_forecast_of_a_line_is_exact(spark):
    df = spark.createDataFrame([("s", t, 2.0 * t + 1) for t in range(60)], "s string, t int, v double")
    forecast = models.forecast_lags(df, "s", "t", "v", 5, LinearRegression())
    assert forecast.count() == 11  # a fifth of 55 sequences
    row = evaluate.evaluate_regression(forecast, "y", "prediction").first()
    assert row["mse"] < 1e-6 and row["r2"] > 0.999


def test_vectors_from_arrays(spark):
    df = spark.createDataFrame([([0.5, 0.25],)], "v array<double>")
    assert df.select(array_to_vector("v").alias("x")).first()["x"].toArray().tolist() == [0.5, 0.25]


def test_vectors_of_a_users_encoder_feed_a_classifier(spark):
    def _lengths():
        import numpy as np

        return lambda batch: np.array([[len(x), x.count("a")] for x in batch], dtype="float64")

    rows = [(i, "a" * (i % 7) + "b" if i % 2 else "b" * (i % 5), float(i % 2)) for i in range(100)]
    df = spark.createDataFrame([*rows, (100, None, 0.0), (101, "", 0.0)], "id long, t string, label double")
    vectors = models.embed_rows(df, "t", _lengths, 2, batch_size=8)
    by = {r["id"]: r["features"].toArray().tolist() for r in vectors.collect()}
    assert by[7] == [1.0, 0.0] and by[9] == [3.0, 2.0] and by[100] == by[101] == [0.0, 0.0]
    assert accuracy(models.logistic(102).fit(vectors).transform(vectors)) > 0.7
    with pytest.raises(Exception, match="must have 3 numbers"):
        models.embed_rows(df, "t", _lengths, 3).collect()


def test_open_categories_are_numbered_by_frequency(spark):
    rows = [(c,) for c, n in (("b", 3), ("a", 3), ("c", 5), ("é", 1)) for _ in range(n)]
    train = spark.createDataFrame(rows, "c string")
    other = spark.createDataFrame([("a",), ("c",), ("new",), (None,)], "c string")
    got = {r["c"]: r["i"] for r in scaling.index_by_frequency(train, other, "c", "i", "keep").collect()}
    assert got == {"a": 1.0, "c": 0.0, "new": 4.0, None: 4.0}
    assert scaling.index_by_frequency(train, other, "c", "i", "skip").count() == 2
    with pytest.raises(Exception, match="unknown c: "):
        scaling.index_by_frequency(train, other, "c", "i").collect()
    spark_own = models.encode_categories(train, train, ["c"]).select("c", "c_index").distinct().collect()
    own = scaling.index_by_frequency(train, train, "c", "i").select("c", "i").distinct().collect()
    assert {tuple(r) for r in own} == {tuple(r) for r in spark_own}


def test_a_million_categories(spark):
    """One of them holds a third of all rows."""
    ids = spark.range(1_500_000)
    df = ids.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("string").alias("c"))
    got = scaling.index_by_frequency(df, df, "c", "i").agg(
        F.countDistinct("i"), F.max("i"), F.count_if((F.col("c") == "-1") & (F.col("i") == 0))
    )
    assert tuple(got.first()) == (1_000_001, 1_000_000.0, 500_000)


def test_review_tables_fit_one_formula(spark, monkeypatch):
    """One formula serves the training and the test rows."""
    from marlstone.catalog import model_queries

    rows = [(i, "card" if i % 3 else "voucher", f"c{i % 2}", float(i % 7), i % 2, i % 3) for i in range(100)]
    base = spark.createDataFrame(
        rows,
        "order_id long, primary_payment_type string, category string, delivery_time double, "
        "binary_label int, multiclass_label int",
    )
    fits = []
    whole = models.formula_model
    monkeypatch.setattr(model_queries, "_base", lambda t: base)
    monkeypatch.setattr(models, "formula_model", lambda *a: fits.append(a[1]) or whole(*a))
    train, test = model_queries._review_tables(None, "binary_label")
    assert fits == ["binary_label ~ . - order_id"]
    assert (train.count(), test.count()) == (70, 30)
