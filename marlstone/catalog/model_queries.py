"""Queries that fit or apply models.

What a model predicts has no SQL form. The queries return what must hold of it (a row per
key, chances within 0 and 1, sizes, counts) and whether it reaches a baseline that SQL
computes too: the share of the commonest class, the rate of positives, the last value.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from marlstone.catalog.bindings import (
    CAMPAIGN,
    CAMPAIGNS,
    DONORS,
    GIFTS,
    HOURLY,
    ITEMS,
    LATER_CAMPAIGN,
    ORDERS,
    PAYMENTS,
    PRODUCTS,
    REVIEWS,
    SELECTION,
    TEXTS,
    Tables,
    with_,
)
from marlstone.catalog.donor_queries import donor_levels, history_sql
from marlstone.catalog.order_queries import (
    DELIVERY_FEATURES,
    ITEM_FEATURES,
    LABELS,
    LATEST_REVIEWS,
    PAYMENT_FEATURES,
)
from marlstone.catalog.registry import Registry
from marlstone.functions.text import SENTIMENT_LABELS
from marlstone.operators import evaluate, models, ordered, sampling, scaling, stepwise, tuning
from marlstone.plans import donors as donor_plan
from marlstone.plans import orders as order_plan
from marlstone.session import scratch_path, stable

QUERIES = Registry()

_CATEGORIES = ["primary_payment_type", "category"]

_BASE = with_(
    ITEMS, PRODUCTS, PAYMENTS, ORDERS, REVIEWS,
    ITEM_FEATURES, PAYMENT_FEATURES, DELIVERY_FEATURES, LATEST_REVIEWS,
    """holdout AS (SELECT order_id FROM delivery_features JOIN payment_features USING (order_id)
      JOIN item_features USING (order_id))""",
    f"base AS (SELECT order_id, {LABELS} FROM holdout JOIN latest_reviews USING (order_id))",
)


def _is_chance(col: str):
    return F.col(col).between(0.0, 1.0)


def _valid_scores(scored, key: str, col: str = "probability"):
    return scored.select(key, _is_chance(col).alias("valid"))


def _valid_report(report):
    """Classes that occur, their support, and whether the rates are rates."""
    rates = _is_chance("precision") & _is_chance("recall") & _is_chance("f1")
    return report.where("support > 0").select("class", "support", rates.alias("valid"))


def _commonest(df, label: str = "label"):
    """Share of the commonest class, a scalar."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.round(F.max("n") / F.sum("n"), 6)).scalar()


def _commonest_sql(table: str, label: str) -> str:
    return f"""(SELECT round(CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 6)
      FROM (SELECT count(*) AS n FROM {table} GROUP BY {label}))"""


def _accuracy(scored):
    return scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).scalar()


def _against_commonest(scored, out: str) -> dict:
    """The share of the commonest class, and whether the accuracy reaches it."""
    scored = stable(scored.select("label", "prediction"))
    share = _commonest(scored)
    return {"commonest": share, out: _accuracy(scored) >= share - 1e-6}


def _base(t: Tables):
    return order_plan.order_basetable(t.orders, t.items, t.products, t.payments, t.reviews)


_HIDDEN = [c for name in _CATEGORIES for c in (name, f"{name}_index")]


def _review_tables(t: Tables, label: str):
    """Encoded train and test rows; encoder and formula are fitted on the training rows."""
    base = order_plan.model_view(stable(_base(t)), label, keep=["order_id"])
    train, test = sampling.split_by_modulo(base, "order_id", 70)
    encoder = models.category_encoder(_CATEGORIES, "keep").fit(train)
    train, test = (encoder.transform(part).drop(*_HIDDEN) for part in (train, test))
    formula = models.formula_model(train, f"{label} ~ . - order_id")
    return [stable(formula.transform(part).select("order_id", "features", "label")) for part in (train, test)]


def _scored_reviews(t: Tables):
    train, test = _review_tables(t, "binary_label")
    model = models.boosted_trees(seed=123).fit(train)
    return model, model.transform(train), model.transform(test)


@QUERIES.add(
    "category_index",
    """SELECT p_partkey, CAST(rank AS DOUBLE) AS kind_index,
         CASE WHEN rank < (SELECT count(DISTINCT p_type) - 1 FROM part) THEN 1 ELSE 0 END AS slots
       FROM part JOIN (
         SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS rank
         FROM part WHERE p_partkey % 100 < 70 GROUP BY p_type) USING (p_type)""",
)
def category_index(t: Tables):
    parts = t.raw("part").select("p_partkey", F.col("p_type").alias("kind"))
    train, _ = sampling.split_by_modulo(parts, "p_partkey", 70)
    coded = models.encode_categories(train, parts, ["kind"])
    slots = F.aggregate(vector_to_array("kind_vector"), F.lit(0.0), lambda a, x: a + x).cast("int")
    return coded.select("p_partkey", "kind_index", slots.alias("slots"))


#: Features whose slots are compared with the columns they come from.
_SLOTS = (
    "total_voucher_payment", "total_non_voucher_payment", "total_installments", "max_payment_sequential",
    "delivery_time", "total_items_in_order",
)


@QUERIES.add(
    "assembled_features",
    _BASE + f"""SELECT order_id, CAST(binary_label AS DOUBLE) AS label, TRUE AS assembled,
        {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SLOTS)}
      FROM base JOIN delivery_features USING (order_id) JOIN payment_features USING (order_id)
        JOIN item_features USING (order_id) WHERE order_id % 100 < 70""",
)
def assembled_features(t: Tables):
    train, _ = _review_tables(t, "binary_label")
    attrs = train.schema["features"].metadata["ml_attr"]["attrs"]
    places = {a["name"]: a["idx"] for group in attrs.values() for a in group}
    rows = train.withColumn("v", vector_to_array("features"))
    whole = F.size("v") == F.lit(len(places))
    own = [F.get("v", F.lit(places[c])).alias(c) for c in _SLOTS]
    return rows.select("order_id", "label", whole.alias("assembled"), *own)


@QUERIES.add(
    "review_forest",
    _BASE + f"""SELECT multiclass_label AS class, count(*) AS support, TRUE AS valid,
        {_commonest_sql("(SELECT * FROM base WHERE order_id % 100 < 70)", "multiclass_label")} AS commonest, TRUE AS fits
      FROM base WHERE order_id % 100 >= 70 GROUP BY 1""",
)
def review_forest(t: Tables):
    train, test = _review_tables(t, "multiclass_label")
    model = models.forest(seed=123).fit(train)
    report = _valid_report(evaluate.classification_report(model.transform(test)))
    return report.withColumns(_against_commonest(model.transform(train), "fits"))


@QUERIES.add(
    "review_boosted_trees",
    _BASE + f"""SELECT count(*) > 0 AS accuracy, count(*) > 0 AS f1, count(*) > 0 AS auc,
        {_commonest_sql("(SELECT * FROM base WHERE order_id % 100 < 70)", "binary_label")} AS commonest, TRUE AS fits
      FROM base""",
)
def review_boosted_trees(t: Tables):
    """Rates of the test rows; the trees must fit the training rows better than one class for all."""
    _, train, scored = _scored_reviews(t)
    scored = stable(
        scored.select("order_id", "label", "prediction", models.positive_probability(F.col("probability")).alias("score"))
    )
    metrics = evaluate.evaluate_classifier(scored)
    rates = metrics.select(*[_is_chance(c).alias(c) for c in ("accuracy", "f1", "auc")])
    return rates.withColumns(_against_commonest(train, "fits"))


@QUERIES.add(
    "review_lift",
    _BASE + """SELECT decile, count(*) AS rows, TRUE AS valid,
        (SELECT CAST(sum(binary_label) AS BIGINT) FROM base WHERE order_id % 100 >= 70) AS all_positives FROM (
      SELECT CAST(ntile(10) OVER (ORDER BY order_id) AS INTEGER) AS decile FROM base WHERE order_id % 100 >= 70)
      GROUP BY decile""",
)
def review_lift(t: Tables):
    _, _, scored = _scored_reviews(t)
    scored = stable(
        scored.select("order_id", "label", models.positive_probability(F.col("probability")).alias("score"))
    )
    table = evaluate.lift_table(scored, "order_id")
    whole = F.col("positives").between(0, F.col("rows")) & (F.col("lift") >= 0)
    table = stable(table)
    everyone = table.agg(F.sum("positives").cast("long")).scalar()
    return table.select("decile", "rows", whole.alias("valid"), everyone.alias("all_positives"))


@QUERIES.add(
    "review_feature_importance",
    _BASE + "SELECT TRUE AS distinct_slots, TRUE AS adds_up, 'delivery_time' AS planted FROM base LIMIT 1",
)
def review_feature_importance(t: Tables):
    """Importances of the review model, and the slot found most important where the label is
    made from one: whether the delivery took longer than usual."""
    model, train, scored = _scored_reviews(t)
    train = train.select("order_id", "features", "label")
    table = models.feature_importance(model, scored)
    own = table.agg(
        (F.count("idx") == F.countDistinct("name")).alias("distinct_slots"),
        (F.abs(F.sum("score") - 1) < 1e-6).alias("adds_up"),
    )
    attrs = train.schema["features"].metadata["ml_attr"]["attrs"]
    place = {a["name"]: a["idx"] for group in attrs.values() for a in group}["delivery_time"]
    days = F.get(vector_to_array("features"), F.lit(place))
    usual = train.agg(F.percentile_approx(days, 0.5)).scalar()
    made = stable(train.select("features", (days > usual).cast("double").alias("label")))
    planted = models.feature_importance(models.forest(numTrees=20, featureSubsetStrategy="all", seed=1).fit(made), made)
    return own.withColumn("planted", planted.agg(F.max_by("name", "score")).scalar())


@QUERIES.add(
    "holdout_scores",
    _BASE + """SELECT order_id, TRUE AS valid, (SELECT round(avg(binary_label), 6) FROM base) AS rate, TRUE AS calibrated
      FROM holdout WHERE order_id NOT IN (SELECT order_id FROM base)""",
)
def holdout_scores(t: Tables):
    """Orders without reviews, scored by a model fitted on those with reviews, whose mean
    chance on its own rows must come near their rate of positives."""
    base = stable(_base(t))
    holdout = order_plan.order_basetable(t.orders, t.items, t.products, t.payments)
    holdout = holdout.join(base.select("order_id"), "order_id", "left_anti")
    fitted = models.category_encoder(_CATEGORIES, "keep").fit(base)
    train = fitted.transform(order_plan.model_view(base, "binary_label")).drop(*_HIDDEN)
    formula = models.formula_model(train, "binary_label ~ .")
    train = stable(formula.transform(train).select("features", "label"))
    model = models.boosted_trees(seed=123).fit(train)
    view = order_plan.model_view(holdout, None, keep=["order_id"])
    scores = models.score(model, formula.transform(fitted.transform(view).drop(*_HIDDEN)), "order_id")
    rate = train.agg(F.round(F.avg("label"), 6)).scalar()
    chance = models.positive_probability(F.col("probability"))
    mean = model.transform(train).agg(F.avg(chance)).scalar()
    return _valid_scores(scores, "order_id").withColumns({"rate": rate, "calibrated": F.abs(mean - rate) < 0.1})


def _vectors(t: Tables):
    return t.raw("embeddings").select(
        "vec_id", "label", "embedding", array_to_vector("embedding").alias("features")
    )


def _labelled_texts(t: Tables):
    """Labelled documents with their kept words: 70 % to train, 10 % to validate, 20 % to test."""
    texts = t.texts.join(t.raw("labels"), "doc_id").select(
        "doc_id", F.split("clean_text", " ").alias("words"), F.col("quality").cast("double").alias("label")
    )
    rest, test = sampling.split_by_modulo(stable(texts), "doc_id", 80)
    return *sampling.split_by_modulo(rest, "doc_id", 70), test


_TEST_TEXTS = "(SELECT quality FROM documents JOIN labels USING (doc_id) WHERE doc_id % 100 >= 80)"


@QUERIES.add(
    "model_round_trip",
    "SELECT doc_id, TRUE AS same FROM documents JOIN labels USING (doc_id) WHERE doc_id % 100 >= 80",
)
def model_round_trip(t: Tables):
    """Predictions of a saved and reloaded model next to the first ones."""
    train, _, test = _labelled_texts(t)
    flow = models.text_classifier(models.logistic(train.count()))
    model = flow.fit(train)
    path = scratch_path(t.spark, "model")
    models.save_model(model, path)
    again = models.load_model(path)
    first = model.transform(test).select("doc_id", F.col("prediction").alias("before"))
    second = again.transform(test).select("doc_id", F.col("prediction").alias("after"))
    return first.join(second, "doc_id").select("doc_id", (F.col("before") == F.col("after")).alias("same"))


@QUERIES.add(
    "tfidf_texts",
    "SELECT doc_id, CAST(1 AS DOUBLE) AS norm FROM documents",
)
def tfidf_texts(t: Tables):
    """Length of every text's vector, which is scaled to 1."""
    words = t.texts.select("doc_id", F.split("clean_text", " ").alias("words"))
    # The entries as they are stored, since a dense array would hold every hash slot.
    stored = F.from_json(F.to_json(F.struct("features")), "features struct<values: array<double>>")
    squares = F.aggregate(stored["features"]["values"], F.lit(0.0), lambda total, x: total + x * x)
    return models.embed_text(words, method="tfidf").select("doc_id", F.round(F.sqrt(squares), 6).alias("norm"))


@QUERIES.add(
    "word2vec_texts",
    "SELECT doc_id, CAST(16 AS INTEGER) AS size FROM documents",
)
def word2vec_texts(t: Tables):
    words = t.texts.select("doc_id", F.split("clean_text", " ").alias("words"))
    vectors = models.embed_text(words, method="word2vec", size=16)
    return vectors.select("doc_id", F.size(vector_to_array("features")).alias("size"))


def _letter_counts():
    """A stand-in encoder: characters, two letters and blanks of each text."""

    def encode(batch: np.ndarray) -> np.ndarray:
        return np.array([[len(x), x.count("a"), x.count("e"), x.count(" ")] for x in batch], dtype="float64")

    return encode


_COUNTED = ", ".join(
    f"CAST(length(clean_text) - length(replace(clean_text, '{c}', '')) AS INTEGER) AS {name}"
    for c, name in (("a", "a"), ("e", "e"), (" ", "blanks"))
)


@QUERIES.add(
    "encoded_texts",
    with_(TEXTS) + f"SELECT doc_id, CAST(length(clean_text) AS INTEGER) AS characters, {_COUNTED} FROM texts",
)
def encoded_texts(t: Tables):
    """Vectors of a user's encoder, entry by entry."""
    vectors = models.embed_rows(t.texts.select("doc_id", "clean_text"), "clean_text", _letter_counts, 4)
    entries = vectors.select("doc_id", vector_to_array("features").alias("v"))
    names = ("characters", "a", "e", "blanks")
    return entries.select("doc_id", *[F.get("v", F.lit(i)).cast("int").alias(n) for i, n in enumerate(names)])


@QUERIES.add(
    "open_category_index",
    """SELECT l_orderkey, l_linenumber, CAST(coalesce(rank, (SELECT count(DISTINCT l_partkey) FROM lineitem
           WHERE l_orderkey % 100 < 70)) AS DOUBLE) AS part_index
       FROM lineitem LEFT JOIN (
         SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS rank
         FROM lineitem WHERE l_orderkey % 100 < 70 GROUP BY l_partkey) USING (l_partkey)""",
)
def open_category_index(t: Tables):
    """A category with thousands of values, numbered without a dictionary on the driver."""
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    train, _ = sampling.split_by_modulo(lines, "l_orderkey", 70)
    return scaling.index_by_frequency(train, lines, "part", "part_index", "keep").drop("part")


@QUERIES.add(
    "relevant_texts",
    f"""SELECT TRUE AS relevant, TRUE AS known, count(*) > 0 AS once,
        {_commonest_sql(_TEST_TEXTS, "quality")} AS commonest, TRUE AS beats FROM documents""",
)
def relevant_texts(t: Tables):
    """Texts a classifier of text vectors finds relevant (fitted on the labelled ones)."""
    train, _, test = _labelled_texts(t)
    flow = models.text_classifier(models.logistic(train.count()))
    words = t.texts.select("doc_id", F.split("clean_text", " ").alias("words"))
    model = flow.fit(train)
    found = models.classify_text(model, words).select("doc_id", "relevance")
    known = t.raw("documents").select("doc_id", F.lit(1).alias("known"))
    checks = found.join(known, "doc_id", "left").agg(
        F.bool_and(F.col("relevance").between(0.5, 1.0)).alias("relevant"),
        F.bool_and(F.col("known").isNotNull()).alias("known"),
        (F.count("doc_id") == F.countDistinct("doc_id")).alias("once"),
    )
    return checks.withColumns(_against_commonest(model.transform(test), "beats"))


@QUERIES.add(
    "logistic_grid",
    "SELECT CAST(6 AS BIGINT) AS points, CAST(1 AS BIGINT) AS best, TRUE AS valid, TRUE AS highest, "
    f"{_commonest_sql('embeddings', 'label % 2')} AS commonest, TRUE AS beats FROM embeddings LIMIT 1",
)
def logistic_grid(t: Tables):
    """Penalty strength and kind by cross-validation on the vectors."""
    halves = (F.col("label") % 2).cast("double")
    table = stable(_vectors(t).select("features", halves.alias("label")))
    rows = table.count()
    # regParam = 1 / (C * rows) for C in 0.1, 1, 10; elastic net 1 is l1, 0 is l2.
    grid = {"regParam": [1.0 / (c * rows) for c in (0.1, 1.0, 10.0)], "elasticNetParam": [1.0, 0.0]}
    points = models.grid_results(models.grid_search(models.logistic(rows), grid, table))
    checks = {"commonest": _commonest(table), "beats": points.agg(F.max("metric")).scalar() >= _commonest(table)}
    return _grid_summary(points).withColumns(checks)


def _grid_summary(table):
    """Points searched, how many are best, and whether that one is the highest."""
    return table.agg(
        F.countDistinct("params").alias("points"),
        F.count_if("is_best").alias("best"),
        F.bool_and(_is_chance("metric")).alias("valid"),
        (F.max(F.when(F.col("is_best"), F.col("metric"))) == F.max("metric")).alias("highest"),
    )


@QUERIES.add(
    "refitted_text_classifier",
    f"""SELECT doc_id, TRUE AS valid, {_commonest_sql(_TEST_TEXTS, "quality")} AS commonest, TRUE AS beats
      FROM documents JOIN labels USING (doc_id) WHERE doc_id % 100 >= 80""",
)
def refitted_text_classifier(t: Tables):
    """The pipeline that a search over its classifier finds best, fitted again on training
    and validation rows; scores of the test rows."""
    train, validation, test = _labelled_texts(t)
    rows = train.count()
    flow = models.text_classifier(models.logistic(rows, maxIter=100))
    grid = {
        "LogisticRegression.regParam": [1.0 / (c * rows) for c in (0.1, 1.0, 10.0)],
        "LogisticRegression.elasticNetParam": [1.0, 0.0],
    }
    model = models.refit_best(models.grid_search(flow, grid, train), train, validation)
    scores = _valid_scores(models.score(model, test, "doc_id"), "doc_id")
    return scores.withColumns(_against_commonest(model.transform(test), "beats"))


@QUERIES.add(
    "vector_forest_grid",
    "SELECT CAST(27 AS BIGINT) AS points, CAST(1 AS BIGINT) AS best, TRUE AS valid, TRUE AS highest, "
    f"{_commonest_sql('embeddings', 'label')} AS commonest, TRUE AS fits FROM embeddings LIMIT 1",
)
def vector_forest_grid(t: Tables):
    """Number and depth of trees and rows per leaf by cross-validation on the vectors.

    Depth 30, the deepest there is, stands for no limit.
    """
    vectors = _vectors(t)
    search = tuning.forest_search(vectors, [50, 100, 200], [10, 20, 30], [1, 2, 4])
    # The labels don't follow from the vectors: only the rows it was fitted on show a good fit.
    fitted = tuning.refit_predictions(search, vectors)
    return _grid_summary(search.table()).withColumns(_against_commonest(fitted, "fits"))


def _campaign(t: Tables, spec):
    table = donor_plan.campaign_table(
        t.gifts, t.selection, t.donors, t.campaigns, spec, {"levels": donor_levels()}
    )
    return stable(table)


def _donor_features(table) -> list[str]:
    return [c for c in table.columns if c not in ("target", "donorID", "campaignID")]


#: Of all donor features, half are selected.
_HALF = len(donor_plan.feature_names(donor_levels())) // 2


@QUERIES.add(
    "selected_donor_features",
    f"SELECT CAST(unnest(range(1, {_HALF} + 1)) AS INTEGER) AS step, TRUE AS own, TRUE AS valid FROM (SELECT count(*) FROM orders)",
)
def selected_donor_features(t: Tables):
    """Half of all features, one by one."""
    table = _campaign(t, CAMPAIGN)
    picked = stepwise.forward_select(table, _donor_features(table), "target", key="donorID")
    names = [name for name, _ in picked]
    # The best of all features ranks better than chance.
    rows = [(i, names.count(name) == 1, 0.5 < auc <= 1.0) for i, (name, auc) in enumerate(picked, 1)]
    return t.spark.createDataFrame(rows, "step int, own boolean, valid boolean")


@QUERIES.add(
    "donor_scores",
    with_(GIFTS, DONORS, SELECTION, CAMPAIGNS, history_sql(LATER_CAMPAIGN)) + "SELECT DISTINCT donorID, TRUE AS valid FROM history",
)
def donor_scores(t: Tables):
    """Boosted trees on the features selected on one campaign, tested on a later one."""
    train, test = _campaign(t, CAMPAIGN), _campaign(t, LATER_CAMPAIGN)
    picked = stepwise.forward_select(train, _donor_features(train), "target", key="donorID")
    selected = [name for name, _ in picked]
    scaler = scaling.Standardizer.fit(train, selected)

    def ready(df):
        vectors = models.assemble_columns(scaler.transform(df), selected)
        return vectors.withColumn("label", F.col("target").cast("double"))

    model = models.boosted_trees(maxIter=50, stepSize=0.1, seed=42).fit(ready(train))
    return _valid_scores(models.score(model, ready(test), "donorID"), "donorID")


@QUERIES.add(
    "vector_network",
    f"""SELECT label AS class, count(*) AS support, TRUE AS valid,
        {_commonest_sql("(SELECT * FROM embeddings WHERE vec_id % 100 < 80)", "label")} AS commonest, TRUE AS fits
      FROM embeddings WHERE vec_id % 100 >= 80 GROUP BY 1""",
)
def vector_network(t: Tables):
    """Feed-forward network on the vectors; accuracy on held-out rows."""
    train, test = sampling.split_by_modulo(_vectors(t), "vec_id", 80)
    model = models.feed_forward([64, 32, 16, 10], seed=1).fit(train)
    report = _valid_report(evaluate.classification_report(model.transform(test)))
    return report.withColumns(_against_commonest(model.transform(train), "fits"))


@QUERIES.add(
    "vector_occlusion",
    "SELECT vec_id, CAST(unnest(range(0, 8)) AS INTEGER) AS block, TRUE AS valid, TRUE AS loses FROM embeddings",
)
def vector_occlusion(t: Tables):
    vectors = _vectors(t)
    model = models.feed_forward([64, 16, 10], maxIter=50, seed=1).fit(vectors)
    drops = stable(models.occlusion_sensitivity(vectors, model, "vec_id", "embedding", 8, 64))
    # Without a block the fitted network is less sure of its class, taken over all vectors.
    mean = drops.agg(F.avg("drop")).scalar()
    return drops.select(
        "vec_id", "block", F.col("drop").between(-1.0, 1.0).alias("valid"), (mean > 0).alias("loses")
    )


def _first_three():
    """A stand-in scorer: the first three entries of each vector are the logits."""

    def scorer(batch: np.ndarray) -> np.ndarray:
        return batch[:, :3].astype("float64")

    return scorer


@QUERIES.add(
    "scored_vectors",
    """SELECT vec_id, CASE WHEN embedding[1] >= embedding[2] AND embedding[1] >= embedding[3] THEN 'risk'
         WHEN embedding[2] >= embedding[3] THEN 'neutral' ELSE 'opportunity' END AS sentiment_label
       FROM embeddings""",
)
def scored_vectors(t: Tables):
    vectors = t.raw("embeddings").select("vec_id", "embedding")
    scored = models.score_rows(vectors, "embedding", _first_three, SENTIMENT_LABELS, "sentiment_label", size=64)
    return scored.drop("embedding")


@QUERIES.add(
    "hourly_forecast",
    with_(HOURLY)
    + """SELECT series, hour, y, TRUE AS finite FROM (
           SELECT series, hour, value AS y, row_number() OVER s - 10 AS pos, count(*) OVER (PARTITION BY series) - 10 AS n
           FROM hourly WHERE value IS NOT NULL WINDOW s AS (PARTITION BY series ORDER BY hour))
         WHERE pos >= 1 AND pos > n - CAST(ceil(n * 0.2) AS BIGINT)""",
)
def hourly_forecast(t: Tables):
    forecast = models.forecast_lags(t.hourly, "series", "hour", "value", 10, LinearRegression())
    finite = F.abs("prediction") < float("inf")
    return forecast.select("series", "hour", "y", finite.alias("finite"))


@QUERIES.add(
    "forecast_metrics",
    with_(HOURLY)
    + """SELECT TRUE AS mse, TRUE AS r2, round(avg((y - last) * (y - last)), 2) AS last_mse, TRUE AS beats FROM (
           SELECT value AS y, lag(value) OVER s AS last, row_number() OVER s - 10 AS pos,
             count(*) OVER (PARTITION BY series) - 10 AS n
           FROM hourly WHERE value IS NOT NULL WINDOW s AS (PARTITION BY series ORDER BY hour))
         WHERE pos >= 1 AND pos > n - CAST(ceil(n * 0.2) AS BIGINT)""",
)
def forecast_metrics(t: Tables):
    """Errors of the forecast, which must be below those of repeating the last value."""
    forecast = stable(models.forecast_lags(t.hourly, "series", "hour", "value", 10, LinearRegression()))
    metrics = evaluate.evaluate_regression(forecast, "y", "prediction")
    before = ordered.lag_sequences(t.hourly, "series", "hour", "value", 1)
    before = before.select("series", "hour", F.get("lags", F.lit(0)).cast("double").alias("last"))
    last = stable(evaluate.evaluate_regression(forecast.join(before, ["series", "hour"]), "y", "last"))
    both = metrics.withColumns({"last_mse": last.select("mse").scalar(), "last_r2": last.select("r2").scalar()})
    return both.select(
        (F.col("mse") >= 0).alias("mse"),
        (F.col("r2") <= 1).alias("r2"),
        F.round("last_mse", 2).alias("last_mse"),
        ((F.col("mse") < F.col("last_mse")) & (F.col("r2") > F.col("last_r2"))).alias("beats"),
    )
