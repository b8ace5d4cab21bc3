"""Queries of the ordered operators and of the score reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.catalog.bindings import GIFTS, HOURLY, SCORED, Tables, with_
from marlstone.catalog.registry import Registry
from marlstone.functions.numbers import argmax, confidence, exact, exact_mean, last_step, softmax
from marlstone.operators import evaluate, ordered, ranking
from marlstone.session import stable

QUERIES = Registry()


@QUERIES.add(
    "gift_gaps",
    with_(GIFTS)
    + """SELECT gift_id, donorID, CAST(date_diff('day',
           lag(date) OVER (PARTITION BY donorID ORDER BY date, gift_id), date) AS INTEGER) AS gap_days
         FROM gifts""",
)
def gift_gaps(t: Tables):
    gifts = t.gifts.select("gift_id", "donorID", "date")
    return ordered.gap_days(gifts, "donorID", "date", ["gift_id"]).drop("date")


@QUERIES.add(
    "quantity_ranks",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity)
         + (count(*) OVER (PARTITION BY l_suppkey, l_quantity) - 1) / CAST(2 AS DOUBLE) AS avg_rank
       FROM lineitem""",
)
def quantity_ranks(t: Tables):
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return ordered.avg_rank(lines, "l_suppkey", "l_quantity")


@QUERIES.add(
    "lag_sequences",
    with_(HOURLY)
    + """SELECT series, hour, y, round(list_sum(lags), 2) AS lag_sum, lags[1] AS oldest, lags[-1] AS newest
         FROM (SELECT series, hour, value AS y, array_agg(value) OVER (
                 PARTITION BY series ORDER BY hour ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS lags
               FROM hourly) WHERE len(lags) = 10""",
)
def lag_sequences(t: Tables):
    table = ordered.lag_sequences(t.hourly, "series", "hour", "value", 10)
    total = F.aggregate("lags", F.lit(0.0), lambda a, x: a + x)
    return table.select(
        "series", "hour", "y",
        F.round(total, 2).alias("lag_sum"),
        F.get("lags", F.lit(0)).alias("oldest"),
        last_step(F.col("lags")).alias("newest"),
    )


@QUERIES.add(
    "chronological_split",
    with_(HOURLY)
    + """SELECT series, hour, rn > n - CAST(ceil(n * 0.2) AS BIGINT) AS is_test FROM (
           SELECT series, hour, row_number() OVER (PARTITION BY series ORDER BY hour) AS rn,
                  count(*) OVER (PARTITION BY series) AS n FROM hourly)""",
)
def chronological_split(t: Tables):
    return ordered.split_chronological(t.hourly.select("series", "hour"), "series", "hour", 0.2)


@QUERIES.add(
    "running_event_value",
    """SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY event_id) AS DOUBLE)
         AS running_value FROM events""",
)
def running_event_value(t: Tables):
    events = t.raw("events").select("event_id", "value")
    total = ordered.running_total(events, [], ["event_id"], exact(F.col("value")), "running_value")
    return total.select("event_id", F.col("running_value").cast("double").alias("running_value"))


@QUERIES.add(
    "score_deciles",
    with_(SCORED)
    + """SELECT id, score, CAST(ntile(10) OVER (ORDER BY score DESC, id) AS INTEGER) AS decile FROM scored""",
)
def score_deciles(t: Tables):
    return ranking.score_deciles(t.scored.select("id", "score"), "score", "id")


@QUERIES.add(
    "lowest_scores",
    with_(SCORED)
    + """SELECT id, score FROM (SELECT id, score, row_number() OVER (ORDER BY score, id) AS rn,
           count(*) OVER () AS n FROM scored) WHERE rn <= floor(n * 0.1)""",
)
def lowest_scores(t: Tables):
    return ranking.score_tail(t.scored.select("id", "score"), "score", "id", 0.1, "bottom")


@QUERIES.add(
    "highest_scores",
    with_(SCORED)
    + """SELECT id, score FROM (SELECT id, score, row_number() OVER (ORDER BY score, id) AS rn,
           count(*) OVER () AS n FROM scored) WHERE rn > n - floor(n * 0.1)""",
)
def highest_scores(t: Tables):
    return ranking.score_tail(t.scored.select("id", "score"), "score", "id", 0.1, "top")


_GAPPY = """gappy AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 97 AS DOUBLE) END
           AS score
  FROM orders)"""


def _gappy(t: Tables):
    """Scores with nulls and many ties, and text keys."""
    score = (F.floor("o_totalprice").cast("long") % 97).cast("double")
    return t.raw("orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderkey") % 7 != 0, score).alias("score"),
    )


@QUERIES.add(
    "gappy_score_deciles",
    with_(_GAPPY)
    + """SELECT id, score, CAST(ntile(10) OVER (ORDER BY score DESC NULLS LAST, id) AS INTEGER) AS decile
         FROM gappy""",
)
def gappy_score_deciles(t: Tables):
    return ranking.score_deciles(_gappy(t), "score", "id")


@QUERIES.add(
    "gappy_score_tails",
    with_(_GAPPY)
    + """SELECT CASE WHEN rn > n - floor(n * 0.3) THEN 'top' ELSE 'bottom' END AS side, id, score FROM (
           SELECT id, score, row_number() OVER (ORDER BY score NULLS FIRST, id) AS rn,
             count(*) OVER () AS n FROM gappy)
         WHERE rn > n - floor(n * 0.3) OR rn <= floor(n * 0.3)""",
)
def gappy_score_tails(t: Tables):
    return ranking.score_tails(_gappy(t), "score", "id", 0.3).select("side", "id", "score")


# --- reports on scored tables ---------------------------------------------------------


@QUERIES.add(
    "confusion_counts",
    with_(SCORED) + "SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction",
)
def confusion_counts(t: Tables):
    return evaluate.confusion_counts(t.scored)


@QUERIES.add(
    "confusion_matrix",
    with_(SCORED)
    + """SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,
           count(*) FILTER (prediction = 1) AS predicted_1 FROM scored GROUP BY label""",
)
def confusion_matrix(t: Tables):
    return evaluate.confusion_matrix(t.scored, [0, 1])


@QUERIES.add(
    "binary_rates",
    with_(SCORED)
    + """SELECT tp, fp, fn, tn, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS tpr,
           coalesce(fp / nullif(CAST(fp + tn AS DOUBLE), 0), 0) AS fpr FROM (
         SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp,
                count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                count(*) FILTER (label = 1 AND prediction = 0) AS fn,
                count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM scored)""",
)
def binary_rates(t: Tables):
    return evaluate.binary_rates(t.scored)


_REPORT = """report AS (
  SELECT c.class,
    coalesce(CAST(count(*) FILTER (label = c.class AND prediction = c.class) AS DOUBLE)
      / nullif(count(*) FILTER (prediction = c.class), 0), 0) AS precision,
    coalesce(CAST(count(*) FILTER (label = c.class AND prediction = c.class) AS DOUBLE)
      / nullif(count(*) FILTER (label = c.class), 0), 0) AS recall,
    coalesce(CAST(2 * count(*) FILTER (label = c.class AND prediction = c.class) AS DOUBLE)
      / nullif(count(*) FILTER (prediction = c.class) + count(*) FILTER (label = c.class), 0), 0) AS f1,
    count(*) FILTER (label = c.class) AS support
  FROM scored, (VALUES (0), (1)) c(class) GROUP BY c.class)"""


@QUERIES.add("classification_report", with_(SCORED, _REPORT) + "SELECT * FROM report")
def classification_report(t: Tables):
    return evaluate.classification_report(t.scored)


@QUERIES.add(
    "classifier_metrics",
    with_(
        SCORED,
        _REPORT,
        """ranks AS (SELECT label, rank() OVER (ORDER BY score)
             + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS r FROM scored)""",
    )
    + """SELECT round((SELECT sum(recall * support) / sum(support) FROM report), 6) AS accuracy,
           round((SELECT sum(f1 * support) / sum(support) FROM report), 6) AS f1,
           round((sum(r) FILTER (label = 1) - CAST(count(*) FILTER (label = 1) AS DOUBLE)
              * (count(*) FILTER (label = 1) + 1) / 2)
             / (CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0)), 6) AS auc
         FROM ranks""",
)
def classifier_metrics(t: Tables):
    table = evaluate.evaluate_classifier(t.scored)
    return table.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1", "auc")})


@QUERIES.add(
    "log_loss",
    with_(SCORED)
    + """SELECT round(-avg(CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss FROM (
           SELECT label, greatest(least(score, CAST(1 AS DOUBLE) - 1e-15), 1e-15) AS p FROM scored)""",
)
def log_loss(t: Tables):
    return evaluate.log_loss(t.scored).select(F.round("log_loss", 6).alias("log_loss"))


@QUERIES.add(
    "regression_metrics",
    with_(HOURLY)
    + """SELECT round(avg((value - 700) * (value - 700)), 2) AS mse,
           round(1 - avg((value - 700) * (value - 700)) / var_pop(value), 6) AS r2 FROM hourly""",
)
def regression_metrics(t: Tables):
    table = evaluate.evaluate_regression(t.hourly.withColumn("p", F.lit(700.0)), "value", "p")
    return table.select(F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2"))


_LIFT = """deciles AS (
  SELECT label, CAST(ntile(10) OVER (ORDER BY score DESC, id) AS INTEGER) AS decile FROM scored),
lift AS (
  SELECT decile, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM deciles GROUP BY decile)"""


@QUERIES.add(
    "lift_table",
    with_(SCORED, _LIFT)
    + """SELECT decile, rows, positives, (CAST(positives AS DOUBLE) / rows)
           / (SELECT CAST(sum(positives) AS DOUBLE) / CAST(sum(rows) AS DOUBLE) FROM lift) AS lift FROM lift""",
)
def lift_table(t: Tables):
    return evaluate.lift_table(t.scored, "id")


@QUERIES.add(
    "cumulative_gain",
    with_(SCORED, _LIFT)
    + """SELECT decile, CAST(sum(positives) OVER (ORDER BY decile) AS BIGINT) AS cumulative_positives,
           CAST(sum(positives) OVER (ORDER BY decile) AS DOUBLE)
           / CAST((SELECT sum(positives) FROM lift) AS DOUBLE) AS gain FROM lift""",
)
def cumulative_gain(t: Tables):
    return evaluate.cumulative_gain(t.scored, "id")


_CUSTOMER_SCORES = """cscored AS (
  SELECT c_custkey AS donorID, (c_acctbal + 1000) / 11000 AS score FROM customer),
placed AS (SELECT donorID, score, row_number() OVER (ORDER BY score, donorID) AS rn,
                  count(*) OVER () AS n FROM cscored),
tails AS (
  SELECT 'top' AS segment, donorID FROM placed WHERE rn > n - floor(n * 0.1)
  UNION ALL SELECT 'low', donorID FROM placed WHERE rn <= floor(n * 0.1)),
activity AS (
  SELECT o_custkey AS donorID, CAST(count(*) AS BIGINT) AS frequency,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price
  FROM orders GROUP BY 1),
described AS (
  SELECT segment, donorID, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey, frequency, mean_price
  FROM tails LEFT JOIN customer ON c_custkey = donorID LEFT JOIN activity USING (donorID))"""


def _customer_scores(t: Tables):
    scored = t.raw("customer").select(
        F.col("c_custkey").alias("donorID"), ((F.col("c_acctbal") + 1000) / 11000).alias("score")
    )
    dims = t.raw("customer").select(F.col("c_custkey").alias("donorID"), "c_mktsegment", "c_nationkey")
    mean = exact_mean(F.col("o_totalprice"))
    activity = t.raw("orders").groupBy(F.col("o_custkey").alias("donorID")).agg(
        F.count(F.lit(1)).alias("frequency"), mean.alias("mean_price")
    )
    return scored, [dims, activity]


def _share(attribute: str) -> str:
    return f"""SELECT '{attribute}' AS attribute, {attribute} AS category,
      CAST(count(*) FILTER (segment = 'top') AS DOUBLE)
        / (SELECT count(*) FROM described WHERE segment = 'top') * 100 AS top_percent,
      CAST(count(*) FILTER (segment = 'low') AS DOUBLE)
        / (SELECT count(*) FROM described WHERE segment = 'low') * 100 AS low_percent
    FROM described GROUP BY {attribute}"""


@QUERIES.add(
    "segment_profile",
    with_(_CUSTOMER_SCORES)
    + """SELECT donorID, c_mktsegment, c_nationkey, frequency, mean_price FROM described
         WHERE segment = 'top'""",
)
def segment_profile(t: Tables):
    scored, dims = _customer_scores(t)
    tail = ranking.score_tail(scored, "score", "donorID", 0.1, "top").drop("score")
    table = evaluate.profile_segment(tail, dims, "donorID")
    return table.withColumn("c_nationkey", F.col("c_nationkey").cast("string"))


@QUERIES.add(
    "segment_category_shares",
    with_(_CUSTOMER_SCORES)
    + f"""SELECT attribute, category, nullif(top_percent, 0) AS top_percent,
            nullif(low_percent, 0) AS low_percent
          FROM ({_share('c_mktsegment')} UNION ALL {_share('c_nationkey')})""",
)
def segment_category_shares(t: Tables):
    scored, dims = _customer_scores(t)
    tails = evaluate.segment_tails(scored, "donorID", "score", dims)
    return evaluate.segment_shares(tails, ["c_mktsegment", "c_nationkey"])


@QUERIES.add(
    "segment_measures",
    with_(_CUSTOMER_SCORES)
    + " UNION ALL ".join(
        f"""SELECT segment, '{m}' AS column_name, count({m}) AS count, round(avg({m}), 4) AS mean,
              round(stddev_samp({m}), 4) AS stddev, CAST(min({m}) AS DOUBLE) AS min,
              CAST(max({m}) AS DOUBLE) AS max,
              round(CAST(quantile_cont({m}, 0.25) AS DOUBLE), 4) AS q25,
              round(CAST(quantile_cont({m}, 0.5) AS DOUBLE), 4) AS median,
              round(CAST(quantile_cont({m}, 0.75) AS DOUBLE), 4) AS q75
            FROM described GROUP BY segment"""
        for m in ("frequency", "mean_price")
    ),
)
def segment_measures(t: Tables):
    scored, dims = _customer_scores(t)
    tails = evaluate.segment_tails(scored, "donorID", "score", dims)
    measures = ["frequency", "mean_price"]
    lines = evaluate.segment_measures(stable(tails.select("segment", *measures)), measures)
    return lines.withColumns({c: F.round(c, 4) for c in ("mean", "stddev", "q25", "median", "q75")})


# --- logits and probabilities -------------------------------------------------------------


@QUERIES.add(
    "softmax_scores",
    """SELECT vec_id, round(exp(a) / (exp(a) + exp(b) + exp(c)), 6) AS p0,
         round(exp(b) / (exp(a) + exp(b) + exp(c)), 6) AS p1,
         CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS predicted,
         round(exp(greatest(a, b, c)) / (exp(a) + exp(b) + exp(c)), 6) AS confidence
       FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b,
                    CAST(embedding[3] AS DOUBLE) AS c FROM embeddings)""",
)
def softmax_scores(t: Tables):
    logits = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))
    scored = t.raw("embeddings").select("vec_id", softmax(logits).alias("p"), argmax(logits).alias("predicted"))
    return scored.select(
        "vec_id",
        "predicted",
        F.round(F.get("p", F.lit(0)), 6).alias("p0"),
        F.round(F.get("p", F.lit(1)), 6).alias("p1"),
        F.round(confidence(F.col("p")), 6).alias("confidence"),
    )
