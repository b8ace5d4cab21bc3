"""Reports on scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.operators.profile import summarize
from marlstone.operators.ranking import score_deciles, score_tails


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n), the long confusion matrix."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    df: DataFrame, classes: Sequence[int], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per label, one ``predicted_<class>`` column per class."""
    cells = [
        F.count_if(F.col(prediction) == c).alias(f"predicted_{c}") for c in classes
    ]
    return df.groupBy(F.col(label).cast("int").alias("label")).agg(*cells)


def binary_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, fn, tn, tpr, fpr; a rate without cases is 0."""
    is_pos, said_pos = F.col(label) == 1, F.col(prediction) == 1
    is_neg, said_neg = F.col(label) == 0, F.col(prediction) == 0
    cells = df.agg(
        F.count_if(is_pos & said_pos).alias("tp"),
        F.count_if(is_neg & said_pos).alias("fp"),
        F.count_if(is_pos & said_neg).alias("fn"),
        F.count_if(is_neg & said_neg).alias("tn"),
    )

    def rate(hit, miss):
        return F.coalesce(F.try_divide(F.col(hit), F.col(hit) + F.col(miss)), F.lit(0.0))

    return cells.withColumns({"tpr": rate("tp", "fn"), "fpr": rate("fp", "tn")})


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    # Small from here: one line per pair of classes.
    cells = confusion_counts(df, label, prediction)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).alias("hit"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(None).cast("long").alias("hit"),
                ),
            )
        ).alias("x")
    ).select("x.*")
    sums = sides.groupBy("class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("hit"),
    )
    zero = F.lit(0.0)
    return sums.select(
        "class",
        F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("hit"), F.col("support")), zero).alias("recall"),
        F.coalesce(
            F.try_divide(2 * F.col("hit"), F.col("predicted") + F.col("support")), zero
        ).alias("f1"),
        "support",
    )


#: Blocks of the score order are found by two comparisons with this many edges each.
_EDGES = 64


def _with_score_blocks(df: DataFrame, score: str, out: str) -> DataFrame:
    """Add a number that grows with the score and splits the rows into some 4,000 even blocks.

    The edges are approximate percentiles in a scalar subquery: first the wide ones,
    then those between two wide ones. A wrong guess makes blocks uneven, nothing else.
    """
    ends = [i / _EDGES**2 for i in range(1, _EDGES**2)]
    edges = df.agg(F.percentile_approx(score, ends, 10_000)).scalar()

    def passed(own: Column) -> Column:
        return F.coalesce(F.size(F.filter(own, lambda e: e < F.col(score))), F.lit(0))

    # A subquery must be a column before higher-order functions may read it.
    held = df.withColumn("_edges", edges)
    wide = F.transform(F.sequence(F.lit(1), F.lit(_EDGES - 1)), lambda i: F.get("_edges", i * _EDGES - 1))
    held = held.withColumn("_wide", passed(wide))
    narrow = passed(F.slice("_edges", F.col("_wide") * _EDGES + 1, F.lit(_EDGES - 1)))
    return held.withColumn(out, F.col("_wide") * _EDGES + narrow).drop("_edges", "_wide")


def _area(df: DataFrame, groups: Sequence[str], label: str, score: str) -> DataFrame:
    """(groups, score): the area of one score column, named after it."""
    names = [f"_g{i}" for i in range(len(groups))]
    # A group of its own where there are none.
    keys = [F.col(g).alias(n) for g, n in zip(groups, names, strict=True)] or [F.lit(0).alias("_g0")]
    names = names or ["_g0"]
    given = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *keys, F.col(score).cast("double").alias("_score"), (F.col(label) == 1).alias("_positive")
    )
    given = _with_score_blocks(given, "_score", "_block")
    # Equal scores share a row, however many they are.
    ties = given.groupBy(*names, "_block", "_score").agg(
        F.count_if("_positive").alias("_p"), F.count_if(~F.col("_positive")).alias("_n")
    )
    # At most one row per group and block from here to the join.
    sums = ties.groupBy(*names, "_block").agg(F.sum("_n").alias("_below"))
    earlier = Window.partitionBy(*names).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_below", F.coalesce(F.sum("_below").over(earlier), F.lit(0)))
    within = Window.partitionBy(*names, "_block").orderBy("_score")
    before = F.coalesce(
        F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = ties.withColumn("_before", before).join(sums, [*names, "_block"])
    beaten = F.col("_p") * (F.col("_below") + F.col("_before") + F.col("_n") / 2)
    wins = placed.groupBy(*names).agg(
        F.try_divide(F.sum(beaten), F.sum("_p").cast("double") * F.sum("_n")).alias(score)
    )
    return wins.select(*[F.col(n).alias(g) for g, n in zip(groups, names, strict=False)], score)


def auc_by(
    df: DataFrame, groups: Sequence[str], label: str = "label", scores: Sequence[str] = ("score",)
) -> DataFrame:
    """(groups, scores): the exact area under the ROC curve of each score in each group.

    The area is the share of pairs of a positive and a negative row that the score
    orders rightly, ties counting half: a sum over the positives of the negatives
    before them, which blocks of the score order and one offset per block give without
    a global sort. Lazy. Rows with a null score or label take no part, NaN comes last;
    a group without both classes has null.
    """
    table = None
    for score in scores:
        part = _area(df, groups, label, score)
        if table is None:
            table = part
        elif groups:
            table = table.join(part, list(groups))
        else:
            # One row on either side.
            table = table.crossJoin(part)
    return table


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row, ``auc``: the exact area under the ROC curve; no row for an empty table."""
    return auc_by(df.withColumn("auc", F.col(score)), [], label, ["auc"])


def evaluate_classifier(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """One row: accuracy, support-weighted F1, AUC."""
    report = classification_report(df, label, prediction)
    weighted = report.agg(
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
    )
    return weighted.withColumn("auc", auc(df, label, score).scalar())


def log_loss(df: DataFrame, label: str = "label", score: str = "score", eps: float = 1e-15) -> DataFrame:
    """One row with the mean negative log likelihood of a binary label."""
    p = F.greatest(F.least(F.col(score), F.lit(1 - eps)), F.lit(eps))
    truth = F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))
    return df.agg((-F.avg(truth)).alias("log_loss"))


def evaluate_regression(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: mse and r2."""
    error = (F.col(actual) - F.col(predicted)) * (F.col(actual) - F.col(predicted))
    return df.agg(
        F.avg(error).alias("mse"),
        (1 - F.try_divide(F.avg(error), F.var_pop(actual))).alias("r2"),
    )


def lift_table(
    df: DataFrame, key: str, label: str = "label", score: str = "score", n: int = 10
) -> DataFrame:
    """(decile, rows, positives, lift): response rate of each decile over the base rate."""
    deciles = score_deciles(df, score, key, n)
    grouped = deciles.groupBy("decile").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("positives")
    )
    # One row per decile.
    every = Window.partitionBy()
    base = F.try_divide(F.sum("positives").over(every), F.sum("rows").over(every))
    rate = F.col("positives") / F.col("rows")
    return grouped.withColumn("lift", F.try_divide(rate, base))


def cumulative_gain(
    df: DataFrame, key: str, label: str = "label", score: str = "score", n: int = 10
) -> DataFrame:
    """(decile, gain): share of all positives within the first deciles."""
    table = lift_table(df, key, label, score, n).select("decile", "positives")
    # One row per decile.
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("positives").over(Window.partitionBy())
    gains = table.withColumn("cumulative_positives", F.sum("positives").over(upto))
    return gains.withColumn("gain", F.try_divide("cumulative_positives", total)).drop("positives")


def profile_segment(scored: DataFrame, dims: Sequence[DataFrame], key: str) -> DataFrame:
    """Scored keys with the columns of their dimension and feature tables."""
    for dim in dims:
        scored = scored.join(dim, key, "left")
    return scored


def segment_tails(
    scored: DataFrame, key: str, score: str, dims: Sequence[DataFrame], fraction: float = 0.1
) -> DataFrame:
    """The top and the low tail of a score (``segment``) with the columns of their dimensions."""
    tails = score_tails(scored, score, key, fraction, "segment")
    named = F.when(F.col("segment") == "top", "top").otherwise("low")
    return profile_segment(tails.withColumn("segment", named), dims, key)


def segment_shares(tails: DataFrame, categories: Sequence[str]) -> DataFrame:
    """(attribute, category, top_percent, low_percent) of the two segments of ``segment_tails``.

    Null categories count in the percentages but have no line; a category that a segment
    lacks is null there. One pass for all attributes.
    """
    top, low = F.col("segment") == "top", F.col("segment") == "low"
    pairs = [
        F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("category")) for c in categories
    ]
    lines = tails.select("segment", F.inline(F.array(*pairs)))
    counts = lines.groupBy("attribute", "category").agg(
        F.count_if(top).alias("top"), F.count_if(low).alias("low")
    )
    # One row per category of the groups from here on.
    whole = counts.groupBy("attribute").agg(F.sum("top").alias("all_top"), F.sum("low").alias("all_low"))

    def percent(n: str, total: str) -> Column:
        return F.when(F.col(n) > 0, F.col(n) / F.col(total) * 100)

    return counts.where(F.col("category").isNotNull()).join(whole, "attribute").select(
        "attribute",
        "category",
        percent("top", "all_top").alias("top_percent"),
        percent("low", "all_low").alias("low_percent"),
    )


def segment_measures(tails: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(segment, column_name, count, mean, ..., max) of the two segments of ``segment_tails``.

    The measures are read several times for the exact quartiles: store the tails first
    where they are costly.
    """
    sides = {name: F.col("segment") == name for name in ("top", "low")}
    return summarize(tails, measures, sides)
