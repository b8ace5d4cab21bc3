"""Spark ML recipes: encoding, training, tuning, scoring, explaining."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Normalizer,
    OneHotEncoder,
    RFormula,
    RFormulaModel,
    StringIndexer,
    VectorAssembler,
    Word2Vec,
)
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.numbers import argmax, map_values, positive_probability, softmax
from marlstone.operators.ordered import lag_sequences, split_chronological
from marlstone.operators.scaling import MinMaxScaler
from marlstone.session import stable

#: Hash slots of TF-IDF vectors; few words of a language share one.
TEXT_SLOTS = 1 << 18

# --- encoding and assembling ---------------------------------------------------


def category_encoder(cols: Sequence[str], handle_invalid: str = "error") -> Pipeline:
    """Index by falling frequency (ties alphabetical), then one-hot without the last."""
    stages = []
    for c in cols:
        stages.append(
            StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid=handle_invalid)
        )
        stages.append(OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_vector"))
    return Pipeline(stages=stages)


def encode_categories(
    train: DataFrame, apply: DataFrame, cols: Sequence[str], handle_invalid: str = "error"
) -> DataFrame:
    """Fit the encoder on one table and use it on another."""
    return category_encoder(cols, handle_invalid).fit(train).transform(apply)


def formula_model(train: DataFrame, formula: str) -> RFormulaModel:
    """An R formula such as ``y ~ . - id``, fitted on the training table."""
    return RFormula(formula=formula).fit(train)


def assemble(train: DataFrame, formula: str, apply: DataFrame | None = None) -> DataFrame:
    """``features`` (and ``label``, where the table has one) by an R formula."""
    return formula_model(train, formula).transform(train if apply is None else apply)


def assemble_columns(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


# --- training ------------------------------------------------------------------


def forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(**({"numTrees": 50, "maxDepth": 5, "maxBins": 16} | params))


def boosted_trees(**params) -> GBTClassifier:
    return GBTClassifier(**({"maxIter": 50} | params))


def logistic(rows: int, c: float = 1.0, penalty: str = "l2", **params) -> LogisticRegression:
    """Logistic regression with an inverse penalty strength ``c``.

    The penalty of the summed loss, 1 / c, becomes 1 / (c * rows) for Spark's
    mean loss; features are not standardised.
    """
    return LogisticRegression(
        **(
            {
                "regParam": 1.0 / (c * rows),
                "elasticNetParam": {"l1": 1.0, "l2": 0.0}[penalty],
                "standardization": False,
                "maxIter": 1000,
                "tol": 1e-4,
            }
            | params
        )
    )


def feed_forward(layers: Sequence[int], **params) -> MultilayerPerceptronClassifier:
    """Sigmoid hidden layers and a softmax output."""
    return MultilayerPerceptronClassifier(**({"layers": list(layers), "maxIter": 100} | params))


class StoredPipeline(Pipeline):
    """A pipeline whose last stage, which passes over its rows again and again, reads them stored.

    They are read in as many partitions as the session has cores: each sends a sum as wide as
    the vectors in every pass, so their number must not grow with the rows. A search over
    parameters of the last stage alone fits the stages before it once a fold.
    """

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        before, rows = self._rows(dataset)
        return PipelineModel([*before, self.getStages()[-1].fit(rows)])

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[Mapping]) -> Iterator:  # noqa: N802, N803
        last = self.getStages()[-1]
        if any(param.parent != last.uid for found in paramMaps for param in found):
            return super().fitMultiple(dataset, paramMaps)
        before, rows = self._rows(dataset)
        # Safe to share between threads, which a generator is not.
        fits = last.fitMultiple(rows, paramMaps)
        return map(lambda fit: (fit[0], PipelineModel([*before, fit[1]])), fits)

    def _rows(self, dataset: DataFrame) -> tuple[list, DataFrame]:
        *before, last = self.getStages()
        fitted = Pipeline(stages=before).fit(dataset)
        rows = stable(fitted.transform(dataset).select(last.getFeaturesCol(), last.getLabelCol()))
        return fitted.stages, rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def text_classifier(classifier: Estimator, method: str = "tfidf", size: int = TEXT_SLOTS) -> StoredPipeline:
    """Text vectors of ``words`` and a classifier that reads their ``features`` and ``label``."""
    return StoredPipeline(stages=[text_embedder(method, size), classifier])


def refit(best: Estimator, *tables: DataFrame):
    """Fit on the union of several tables (train and validation)."""
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table)
    return best.fit(union)


# --- tuning --------------------------------------------------------------------


def grid_search(
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    df: DataFrame,
    metric: str = "accuracy",
    folds: int = 5,
    parallelism: int = 8,
    seed: int = 42,
) -> CrossValidatorModel:
    """Cross-validated search over every combination of the grid.

    A name is a parameter of the estimator, or ``Stage.parameter`` for that of a
    pipeline's stage, as in ``LogisticRegression.regParam``.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(_param(estimator, name), list(values))
    if metric == "auc":
        evaluator = BinaryClassificationEvaluator(numBins=0)
    else:
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    return search.fit(df)


def _param(estimator: Estimator, name: str) -> Param:
    stage, _, own = name.rpartition(".")
    if not stage:
        return estimator.getParam(own)
    found = [s for s in estimator.getStages() if type(s).__name__ == stage]
    if len(found) != 1:
        raise ValueError(f"{len(found)} stages named {stage}")
    return found[0].getParam(own)


def _best_at(model: CrossValidatorModel) -> int:
    better = max if model.getEvaluator().isLargerBetter() else min
    return model.avgMetrics.index(better(model.avgMetrics))


def refit_best(search: CrossValidatorModel, *tables: DataFrame):
    """Fit the grid point that a search found best on the union of several tables."""
    best = search.getEstimatorParamMaps()[_best_at(search)]
    return refit(search.getEstimator().copy(best), *tables)


def grid_results(model: CrossValidatorModel) -> DataFrame:
    """(params, metric, is_best) per grid point; a line per point, no data."""
    maps = model.getEstimatorParamMaps()
    names = [", ".join(sorted(f"{p.name}={v}" for p, v in m.items())) for m in maps]
    best_at = _best_at(model)
    rows = [(n, float(m), i == best_at) for i, (n, m) in enumerate(zip(names, model.avgMetrics, strict=True))]
    return SparkSession.active().createDataFrame(rows, "params string, metric double, is_best boolean")


# --- scoring and explaining ----------------------------------------------------


def score(model, df: DataFrame, key: str) -> DataFrame:
    """(key, prediction, probability of class 1) for a table without labels."""
    return model.transform(df).select(
        key, "prediction", positive_probability(F.col("probability")).alias("probability")
    )


def feature_importance(model, scored: DataFrame, features: str = "features") -> DataFrame:
    """(idx, name, score) per feature slot, most important first."""
    spark = scored.sparkSession
    attrs = scored.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a.get("name", str(a["idx"]))) for group in attrs.values() for a in group)
    weights = model.featureImportances
    rows = [(i, name, float(weights[i])) for i, name in slots]
    table = spark.createDataFrame(rows, "idx int, name string, score double")
    return table.orderBy(F.desc("score"), "idx")


def occlusion_sensitivity(
    df: DataFrame, model, key: str, vector: str, block: int, size: int
) -> DataFrame:
    """(key, block, predicted_class, drop): loss of the predicted class's score
    when one block of the feature array is set to zero."""
    base = model.transform(df.select(key, vector, array_to_vector(vector).alias("features")))
    base = base.select(
        key,
        vector,
        F.col("prediction").cast("int").alias("predicted_class"),
        F.get(vector_to_array("probability"), F.col("prediction").cast("int")).alias("_base"),
    )
    blocks = F.sequence(F.lit(0), F.lit((size + block - 1) // block - 1))
    masked = base.withColumn("block", F.explode(blocks))
    low = F.col("block") * block
    zeroed = F.transform(
        vector, lambda x, i: F.when((i >= low) & (i < low + block), F.lit(0.0)).otherwise(x.cast("double"))
    )
    masked = model.transform(masked.withColumn("features", array_to_vector(zeroed)))
    hidden = F.get(vector_to_array("probability"), F.col("predicted_class"))
    return masked.select(key, "block", "predicted_class", (F.col("_base") - hidden).alias("drop"))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- text and series models ----------------------------------------------------


def text_embedder(
    method: str = "tfidf",
    size: int = TEXT_SLOTS,
    words: str = "words",
    out: str = "features",
    partitions: int = 8,
    min_count: int = 5,
):
    """Estimator from a token array to a vector: ``tfidf`` or ``word2vec``.

    Word2Vec trains in ``partitions`` tasks, whose vectors are averaged at the end; more of
    them than cores don't make it faster. It knows the words that occur at least ``min_count`` times: its vocabulary sits
    on the driver, so ``min_count`` must grow with the corpus.
    """
    if method == "tfidf":
        counts = HashingTF(inputCol=words, outputCol="_counts", numFeatures=size)
        weights = IDF(inputCol="_counts", outputCol="_weights")
        return Pipeline(stages=[counts, weights, Normalizer(inputCol="_weights", outputCol=out)])
    if method == "word2vec":
        return Pipeline(
            stages=[
                Word2Vec(
                    inputCol=words, outputCol=out, vectorSize=size, minCount=min_count,
                    numPartitions=partitions, seed=42,
                )
            ]
        )
    raise ValueError(f"unknown method: {method!r}")


def embed_text(df: DataFrame, words: str = "words", method: str = "tfidf", size: int = TEXT_SLOTS) -> DataFrame:
    """``df`` with text vectors in ``features``, fitted on all its rows.

    Word2Vec reads its rows three times (words, training, vectors), so they are made once and
    stored; it trains in a task for each core, eight at least.
    """
    if method == "word2vec":
        rows = stable(df)
        partitions = max(8, df.sparkSession.sparkContext.defaultParallelism)
        return text_embedder(method, size, words, partitions=partitions).fit(rows).transform(rows)
    return text_embedder(method, size, words).fit(df).transform(df).drop("_counts", "_weights")


def embed_rows(
    df: DataFrame,
    col: str,
    make_encoder: Callable,
    size: int,
    out: str = "features",
    batch_size: int = 32,
) -> DataFrame:
    """A vector column from a user-supplied encoder (batch of texts to (batch, size) numbers).

    ``make_encoder`` builds the encoder once per Python worker, such as a loaded
    transformer; it runs on Arrow batches of ``batch_size`` texts, and null texts reach it
    as ''. Vectors of another length fail the query. The column fits every estimator here.
    """
    encode = predict_batch_udf(
        make_encoder, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size
    )
    vectors = df.withColumn("_vector", encode(F.coalesce(F.col(col), F.lit(""))))
    wrong = F.raise_error(F.lit(f"the encoder's vectors must have {size} numbers")).cast("array<double>")
    checked = F.when(F.size("_vector") == size, F.col("_vector")).otherwise(wrong)
    return vectors.withColumn(out, array_to_vector(checked)).drop("_vector")


def classify_text(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Texts a fitted classifier finds relevant, with their probability."""
    scored = model.transform(df)
    relevant = scored.where(F.col("prediction") == 1)
    return relevant.withColumn("relevance", positive_probability(F.col("probability")))


def score_rows(
    df: DataFrame,
    col: str,
    make_scorer: Callable,
    labels: Mapping[int, str],
    out: str,
    batch_size: int = 32,
    size: int | None = None,
) -> DataFrame:
    """Class label of a user-supplied scorer (batch of values to batch of logits).

    ``make_scorer`` builds the scorer once per Python worker; ``size`` is the
    length of the arrays in ``col`` (None for texts or numbers). It runs on Arrow
    batches.
    """
    logits = predict_batch_udf(
        make_scorer,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=None if size is None else [[size]],
    )
    scored = df.withColumn("_logits", logits(F.col(col)))
    probabilities = softmax(F.col("_logits"))
    return scored.withColumn(out, map_values(argmax(probabilities), labels)).drop("_logits")


def forecast_lags(
    df: DataFrame,
    series: str,
    ts: str,
    value: str,
    length: int,
    regressor: Estimator,
    test_fraction: float = 0.2,
) -> DataFrame:
    """(series, ts, y, prediction) on the last part of each series.

    The value range is learned on the training rows, the regressor on scaled
    lags; both outputs are scaled back.
    """
    sequences = lag_sequences(df, series, ts, value, length)
    split = stable(split_chronological(sequences, series, ts, test_fraction))
    train = split.where(~F.col("is_test"))
    scaler = MinMaxScaler.fit(train, "y")
    scaled = split.select(
        series,
        ts,
        "is_test",
        F.col("y").alias("actual"),
        scaler.scale(F.col("y").cast("double")).alias("label"),
        array_to_vector(F.transform("lags", lambda x: scaler.scale(x.cast("double")))).alias("features"),
    )
    model = regressor.fit(scaled.where(~F.col("is_test")))
    predicted = model.transform(scaled.where("is_test"))
    return predicted.select(
        series, ts, F.col("actual").alias("y"), scaler.inverse(F.col("prediction")).alias("prediction")
    )
