"""Operators against brute force on small fixtures, hot keys included."""

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone import session
from marlstone.functions.text import CLIMATE_ASPECTS, tag_aspects
from marlstone.operators import evaluate, grouping, ordered, profile, ranking, scaling, selection, text_ops
from marlstone.operators import clean

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def skewed(spark, rows=400, seed=5):
    """A third of the rows on one key, many ties in the value, some nulls."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 12)
        value = None if rng.random() < 0.05 else float(rng.randrange(30))
        data.append((i, key, rng.randrange(60), value))
    return spark.createDataFrame(data, "id long, key int, ts int, value double")


def blocks_of(df):
    return ordered._blocks(df, ["key"], ["ts", "id"])


def test_a_hot_key_spans_several_blocks(many_blocks):
    placed = blocks_of(skewed(many_blocks))
    spread = placed.where("key = 0").select("_block").distinct().count()
    assert spread > 1


def test_row_numbers_and_running_total(many_blocks):
    df = skewed(many_blocks)
    got = ordered.row_numbers(df, ["key"], ["ts", "id"], "rn").toPandas().sort_values(["key", "ts", "id"])
    want = got.groupby("key").cumcount() + 1
    assert (got["rn"] == want).all()
    total = ordered.running_total(df, [], ["ts", "id"], F.col("id"), "s").toPandas().sort_values(["ts", "id"])
    assert (total["s"] == total["id"].cumsum()).all()


@pytest.mark.parametrize("length", [1, 3, 40])
def test_previous_values_over_block_borders(many_blocks, length):
    got = ordered.previous_values(skewed(many_blocks), ["key"], ["ts", "id"], "value", length, "prev").toPandas()
    got = got.sort_values(["key", "ts", "id"])
    for _, group in got.groupby("key"):
        values = [None if pd.isna(v) else v for v in group["value"]]
        for i, prev in enumerate(group["prev"]):
            have = [None if pd.isna(v) else v for v in prev]
            assert have == values[max(0, i - length) : i]


def test_average_ranks(many_blocks):
    got = ordered.avg_rank(skewed(many_blocks), "key", "value").toPandas()
    want = got.groupby("key")["value"].rank()
    assert got["avg_rank"].fillna(-1).tolist() == want.fillna(-1).tolist()


def test_gaps_and_sequences(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-01", 1), ("a", "2020-01-05", 2), ("a", "2020-01-05", 3), ("b", "2020-02-01", 4)],
        "k string, d string, id int",
    ).withColumn("d", F.to_date("d"))
    gaps = {r["id"]: r["gap_days"] for r in ordered.gap_days(df, "k", "d", ["id"]).collect()}
    assert gaps == {1: None, 2: 4, 3: 0, 4: None}
    short = spark.createDataFrame([("s", i, float(i)) for i in range(4)], "s string, t int, v double")
    rows = ordered.lag_sequences(short, "s", "t", "v", 3).collect()
    assert [(r["lags"], r["y"]) for r in rows] == [([0.0, 1.0, 2.0], 3.0)]
    assert ordered.lag_sequences(short, "s", "t", "v", 4).count() == 0


def test_chronological_split_rounds_the_test_part_up(many_blocks):
    df = many_blocks.createDataFrame([("s", i) for i in range(11)], "s string, t int")
    got = ordered.split_chronological(df, "s", "t", 0.2).toPandas().sort_values("t")
    assert got["is_test"].tolist() == [False] * 8 + [True] * 3


def test_ranks_of_a_tied_column_without_the_final_array(spark, monkeypatch):
    """Narrowing alone finds every rank, also where one value fills most rows."""
    monkeypatch.setattr(selection, "_FINAL_ROWS", 0)
    monkeypatch.setattr(selection, "_ACCURACY", 20)
    rng = random.Random(1)
    values = [7.0] * 300 + [float(rng.randrange(1000)) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = [1, 2, 150, 299, 300, 301, 450, 599, 600]
    got = selection.select_ranks(df, {"v": F.col("v")}, {"v": wanted})["v"]
    ordered_values = sorted(values)
    assert got == {r: ordered_values[r - 1] for r in wanted}


def test_rank_search_takes_brackets_then_an_array(spark, monkeypatch):
    monkeypatch.setattr(selection, "_FINAL_ROWS", 20)
    monkeypatch.setattr(selection, "_ACCURACY", 50)
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    values = sorted(i * 7919 % 5003 for i in range(5000))
    wanted = [1, 10, 1250, 2500, 2501, 4999, 5000]
    got = selection.select_ranks(df, {"v": F.col("v")}, {"v": wanted})["v"]
    assert got == {r: values[r - 1] for r in wanted}
    with pytest.raises(ValueError):
        selection.select_ranks(df, {"v": F.col("v")}, {"v": [5001]})


def test_median_ignores_nulls_and_interpolates(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (None,), (float("nan"),)], "v double")
    assert selection.exact_median(df, "v") == 1.5
    assert selection.exact_median(df.where("v is null"), "v") is None


@QUICK
@given(scores=st.lists(st.integers(0, 4), min_size=1, max_size=60), n=st.integers(2, 10))
def test_deciles_are_even_and_ordered(spark, scores, n):
    df = spark.createDataFrame([(i, float(s)) for i, s in enumerate(scores)], "id long, score double")
    got = ranking.score_deciles(df, "score", "id", n).toPandas()
    got = got.sort_values(["score", "id"], ascending=[False, True]).reset_index(drop=True)
    rows = len(got)
    want = []
    for i in range(n):
        want += [i + 1] * (rows // n + (1 if i < rows % n else 0))
    assert got["decile"].tolist() == want


@pytest.mark.parametrize("side", ["top", "bottom"])
@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 1.0])
def test_tails(spark, side, fraction):
    rng = random.Random(3)
    data = [(i, float(rng.randrange(6))) for i in range(57)]
    df = spark.createDataFrame(data, "id long, score double")
    size = int(57 * fraction)
    by_score = sorted(data, key=lambda r: (r[1], r[0]))
    want = by_score[:size] if side == "bottom" else by_score[57 - size :]
    got = ranking.score_tail(df, "score", "id", fraction, side).collect()
    assert sorted((r["id"], r["score"]) for r in got) == sorted(want)


def test_picks_are_unique_and_deterministic(spark):
    df = skewed(spark)
    latest = grouping.latest_per_key(df, "key", "ts", ["id"]).toPandas()
    want = df.toPandas().sort_values(["ts", "id"]).groupby("key").tail(1)
    assert sorted(latest["id"]) == sorted(want["id"])
    first = grouping.first_per_key(df, "key", "ts", ["id"]).toPandas()
    assert first["key"].is_unique


def test_group_stats_keep_every_row(spark):
    df = skewed(spark)
    got = grouping.with_group_stats(df, "key", {"n": F.count(F.lit(1))}).toPandas()
    assert len(got) == 400
    assert (got["n"] == got.groupby("key")["id"].transform("size")).all()


def test_ratio_of_a_missing_group_is_null(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 0, 3.0)], "k string, early int, v double")
    early = F.sum(F.when(F.col("early") == 1, F.col("v")))
    got = {r["k"]: r["r"] for r in grouping.ratio_of_groups(df, "k", F.sum("v"), early, "r").collect()}
    assert got == {"a": 1.0, "b": None}


def test_sentinels_compare_as_text(spark):
    df = spark.createDataFrame([(1, "NA"), (2, None)], "a int, b string")
    assert profile.count_sentinel(df).first().asDict() == {"a": 0, "b": 1}
    assert profile.count_missing(df).first().asDict() == {"a": 0, "b": 1}


def test_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert profile.mode_of(df, "v").first()["mode"] == "a"
    filled = clean.impute_mode(df, "v").collect()
    assert [r["v"] for r in filled].count("a") == 5


def test_outliers_keep_rows_without_a_value(spark):
    df = spark.createDataFrame([(1.0,), (99.0,), (None,)], "v double")
    assert clean.drop_outliers(df, "v", 0, 10).count() == 2


def test_parallel_explode(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1, 2]), (2, [], [])], "k int, x array<string>, y array<int>")
    got = text_ops.explode_parallel(df, {"x": "s", "y": "n"}).collect()
    assert sorted((r["k"], r["s"], r["n"]) for r in got if r["k"] == 1) == [(1, "a", 1), (1, "b", 2)]
    assert [(r["s"], r["n"]) for r in got if r["k"] == 2] == [(None, None)]
    uneven = spark.createDataFrame([(1, ["a"], [1, 2])], df.schema)
    with pytest.raises(Exception, match="differ in length"):
        text_ops.explode_parallel(uneven, {"x": "s", "y": "n"}).collect()
    padded = text_ops.explode_parallel(uneven, {"x": "s", "y": "n"}, check=False).collect()
    assert [(r["s"], r["n"]) for r in padded] == [("a", 1), (None, 2)]


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_lexicon_and_lemmas_broadcast_or_not(spark, request, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    docs = spark.createDataFrame([(1, "good good bad"), (2, "plain"), (3, "")], "id int, t string")
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -3.0)], "token string, valence double")
    words = F.split("t", " ")
    got = {r["id"]: (r["compound"], r["sentiment"]) for r in text_ops.lexicon_sentiment(docs, "id", words, lexicon).collect()}
    assert got == {1: (0.25, "positive"), 2: (0.0, "neutral"), 3: (0.0, "neutral")}
    lemmas = spark.createDataFrame([("good", "go")], "token string, lemma string")
    texts = {r["id"]: r["lemma_text"] for r in text_ops.lemmatize(docs, "id", words, lemmas).collect()}
    assert texts == {1: "go go bad", 2: "plain", 3: ""}


def test_dummies_of_unseen_and_null_levels(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    got = scaling.dummies(df, "c", "is", levels=["a", "b"], drop_first=True).collect()
    assert [r["is_b"] for r in got] == [0, 1, 0, 0]


@QUICK
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=20))
def test_minmax_there_and_back(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    scaler = scaling.MinMaxScaler.fit(df, "v")
    back = df.select("v", scaler.inverse(scaler.scale(F.col("v"))).alias("w")).collect()
    assert all(r["w"] == pytest.approx(r["v"], abs=1e-6) for r in back)


def test_lift_weighted_by_size_is_one(spark):
    rng = random.Random(2)
    data = [(i, rng.random(), int(rng.random() < 0.3)) for i in range(203)]
    df = spark.createDataFrame(data, "id long, score double, label int")
    table = evaluate.lift_table(df, "id").toPandas()
    assert (table["lift"] * table["rows"]).sum() / table["rows"].sum() == pytest.approx(1.0)
    gain = evaluate.cumulative_gain(df, "id").toPandas().sort_values("decile")
    assert gain["gain"].is_monotonic_increasing and gain["gain"].iloc[-1] == 1.0


def test_rates_without_cases_are_zero(spark):
    df = spark.createDataFrame([(0, 0)], "label int, prediction int")
    row = evaluate.binary_rates(df).first()
    assert (row["tpr"], row["fpr"]) == (0.0, 0.0)


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, score double")
    assert evaluate.auc(df).first()[0] == pytest.approx(0.875)


def pairwise_auc(rows):
    positives = [s for y, s in rows if y == 1]
    negatives = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    return wins / (len(positives) * len(negatives))


def test_auc_of_groups_and_several_scores(spark):
    rng = random.Random(8)
    rows = [
        (i % 3, int(rng.random() < 0.3), rng.choice([rng.random(), 0.25, 0.5]), rng.gauss(0, 1)) for i in range(900)
    ]
    rows += [(0, 1, None, 0.0), (0, None, 0.4, 0.0), (7, 1, 0.5, 0.5), (7, 1, 0.1, 0.5)]
    df = spark.createDataFrame(rows, "g int, label int, a double, b double")
    got = {r["g"]: r for r in evaluate.auc_by(df, ["g"], "label", ["a", "b"]).collect()}
    for g in range(3):
        own = [r for r in rows if r[0] == g and r[1] is not None]
        assert got[g]["a"] == pytest.approx(pairwise_auc([(r[1], r[2]) for r in own if r[2] is not None]))
        assert got[g]["b"] == pytest.approx(pairwise_auc([(r[1], r[3]) for r in own]))
    assert got[7]["a"] is None and got[7]["b"] is None
    assert evaluate.auc(df.limit(0), "label", "a").collect() == []


def jobs_of(spark, work):
    """Spark jobs that ``work`` starts."""
    name = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_metrics_are_lazy(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (0, 1, 0.5)], "label int, prediction int, score double")
    assert jobs_of(spark, lambda: evaluate.evaluate_classifier(df)) == 0


@pytest.mark.parametrize("rows", [150, 15_000, 60_000])
def test_reports_take_few_jobs(spark, rows):
    """Also where the scores are too many for ordered arrays."""
    df = session_table(spark, rows)
    assert jobs_of(spark, lambda: evaluate.lift_table(df, "id").collect()) <= 12
    assert jobs_of(spark, lambda: ranking.score_tails(df, "score", "id").collect()) <= 12
    tails = session.stable(ranking.score_tails(df, "score", "id", 0.1, "segment"))
    assert jobs_of(spark, lambda: evaluate.segment_measures(tails, ["score"]).collect()) <= 5


def session_table(spark, rows):
    made = spark.range(rows).select("id", (F.col("id") * 37 % 1009).cast("double").alias("score"))
    return session.stable(made.withColumn("label", (F.col("id") % 3 == 0).cast("int")))


@pytest.mark.parametrize("final", [3, 20_000])
def test_both_tails_at_once(spark, monkeypatch, final):
    monkeypatch.setattr(selection, "_FINAL_ROWS", final)
    rows = [(f"k{i:04d}", None if i % 11 == 0 else float(i % 5)) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "id string, score double")
    got = {r["id"]: r["side"] for r in ranking.score_tails(df, "score", "id", 0.3).collect()}
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]))
    want = {r[0]: "bottom" for r in ordered[:119]} | {r[0]: "top" for r in ordered[-119:]}
    assert got == want
    with pytest.raises(ValueError, match="overlap"):
        ranking.score_tails(df, "score", "id", 0.6)
    assert ranking.score_tails(df.limit(2), "score", "id", 0.3).collect() == []


def test_deciles_and_tails_place_nulls_and_nan(spark):
    rows = [(i, None if i % 5 == 0 else float(i % 3)) for i in range(1, 51)] + [(51, float("nan"))]
    df = spark.createDataFrame(rows, "id long, score double")
    got = {r["id"]: r["decile"] for r in ranking.score_deciles(df, "score", "id").collect()}
    want = df.selectExpr("id", "ntile(10) OVER (ORDER BY score DESC, id) AS decile").collect()
    assert got == {r["id"]: r["decile"] for r in want}
    for side, order in (("top", "score DESC, id DESC"), ("bottom", "score, id")):
        tail = {r["id"] for r in ranking.score_tail(df, "score", "id", 0.3, side).collect()}
        first = df.selectExpr("id", f"row_number() OVER (ORDER BY {order}) AS n").where("n <= 15")
        assert tail == {r["id"] for r in first.collect()}
    empty = df.limit(0)
    assert ranking.score_deciles(empty, "score", "id").count() == 0
    assert ranking.score_tail(empty, "score", "id").count() == 0


def test_text_keys_break_ties_by_bytes(spark, monkeypatch):
    """Equal scores, keys that share long prefixes, and too few rows kept for a plain sort."""
    from marlstone.operators import selection

    monkeypatch.setattr(selection, "_FINAL_ROWS", 3)
    keys = [f"order-{'x' * (i % 4)}{i:03d}é" for i in range(60)] + ["order-", "o", "order-x"]
    df = spark.createDataFrame([(k, 1.0) for k in keys], "id string, score double")
    got = {r["id"]: r["decile"] for r in ranking.score_deciles(df, "score", "id").collect()}
    want = df.selectExpr("id", "ntile(10) OVER (ORDER BY score DESC, id) AS decile").collect()
    assert got == {r["id"]: r["decile"] for r in want}


def test_deciles_read_the_source_few_times(spark, tmp_path):
    """Counted by the jobs that scan the stored source."""
    path = str(tmp_path / "scores")
    spark.range(40_000).selectExpr("id", "double(id % 9973) AS score").write.parquet(path)
    source = spark.read.parquet(path)
    reads = []

    class Watched:
        """Counts the actions taken on the source itself."""

        def __init__(self, df):
            self.df = df

        def __getattr__(self, name):
            if name in ("agg", "select", "where", "withColumn"):
                reads.append(name)
            return getattr(self.df, name)

    labelled = ranking.score_deciles(Watched(source), "score", "id")
    assert labelled.groupBy("decile").count().where("count != 4000").count() == 0
    assert len(reads) <= 5


def test_null_groups_stay(spark):
    df = spark.createDataFrame([("a", 2), (None, 1), ("a", 1)], "c string, n long")
    assert [tuple(r) for r in grouping.order_by_total(df, "c", "n").collect()][0] == (None, 1, 1)
    assert grouping.order_by_total(df, "c", "n").count() == 3
    weights = {(r["c"], r["weight"]) for r in scaling.balanced_weights(df, "c").collect()}
    assert weights == {("a", 0.75), (None, 1.5)}
    codes = {r["c"]: r["i"] for r in scaling.index_labels(df, "c", "i").collect()}
    assert codes == {"a": 0, None: None}


def test_scratch_is_shared_or_refused():
    from marlstone.session import scratch_root

    class Conf(dict):
        def get(self, name, default=None):
            return super().get(name, default)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    Session.conf = Conf({"spark.sql.warehouse.dir": "file:/home/wh"})
    with pytest.raises(RuntimeError):
        scratch_root(Session)
    Session.conf = Conf({"spark.sql.warehouse.dir": "hdfs://host/wh"})
    assert scratch_root(Session) == "hdfs://host/wh/_scratch"
    Session.conf = Conf({"spark.checkpoint.dir": "s3a://bucket/tmp/"})
    assert scratch_root(Session) == "s3a://bucket/tmp"


def test_keywords_by_join_equal_the_scan(spark):
    rng = random.Random(4)
    parts = [k for some in CLIMATE_ASPECTS.values() for k in some] + ["soil", "", "of", "carbon", "tax", "climate"]
    texts = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 9)))) for i in range(300)]
    df = spark.createDataFrame([*texts, (300, None), (301, "carbon tax " * 50_000)], "id long, text string")
    keywords = text_ops.keyword_table(spark, CLIMATE_ASPECTS)
    got = text_ops.tag_keywords(df, "id", F.split("text", " "), keywords, 3).collect()
    want = df.select("id", F.coalesce(tag_aspects(F.col("text"), mode="word"), F.array())).collect()
    assert {r["id"]: r["aspects"] for r in got} == dict(map(tuple, want)) and len(got) == 302
    assert text_ops.tag_keywords(df.limit(0), "id", F.split("text", " "), keywords, 3).count() == 0
    with pytest.raises(Exception, match="more than 2 words"):
        text_ops.tag_keywords(df, "id", F.split("text", " "), keywords, 2).collect()


def test_keyword_plans_do_not_grow(spark):
    df = spark.createDataFrame([(1, "wind w7 w8")], "id long, text string")

    def tagged(n):
        return text_ops.tag_keywords(
            df, "id", F.split("text", " "), text_ops.keyword_table(spark, {"a": [f"w{i} w{i + 1}" for i in range(n)]}), 2
        )

    plans = [tagged(n)._jdf.queryExecution().optimizedPlan().toString() for n in (5, 20_000)]
    assert len(plans[0].splitlines()) == len(plans[1].splitlines())
    assert tagged(20_000).first()["aspects"] == ["a"] and tagged(5).first()["aspects"] == []
