"""Recipes: hand-made rows for the rules, leakage, and the shape of the plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlstone.catalog import all_queries
from marlstone.plans import donors, news, orders

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- orders -------------------------------------------------------------------


def test_payments_with_two_firsts_and_none(spark):
    rows = [
        ("a", 1, "voucher", 1, 10.10),
        ("a", 1, "card", 2, 20.20),
        ("b", 2, "card", 3, 5.0),  # no first payment
        ("c", 1, "voucher", 1, 7.0),
    ]
    payments = spark.createDataFrame(
        rows,
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    got = {r["order_id"]: r for r in orders.payment_features(payments).collect()}
    assert set(got) == {"a", "c"}
    assert got["a"]["primary_payment_type"] == "card"
    assert got["a"]["total_installments"] == 3
    assert (got["a"]["total_voucher_payment"], got["a"]["total_non_voucher_payment"]) == (10.1, 20.2)
    assert got["c"]["total_non_voucher_payment"] == 0.0


def test_item_totals_count_lines_without_product(spark):
    items = spark.createDataFrame(
        [("a", 1, "p", 1.0, 0.5), ("a", 2, "gone", 2.0, 0.5), ("b", 1, "gone", 3.0, 0.1)],
        "order_id string, order_item_id int, product_id string, price double, shipping_cost double",
    )
    products = spark.createDataFrame(
        [("p", "toys", 10, 400, 2, 100, 2, 3, 4)],
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int",
    )
    rows = orders.item_features(items, products).collect()
    assert [r["order_id"] for r in rows] == ["a"]
    row = rows[0]
    assert (row["total_items_in_order"], row["total_price_of_order"], row["category"]) == (2, 3.0, "toys")
    assert (row["Buckets_descr"], row["Buckets_name"], row["Buckets_weight"], row["Buckets_volume"]) == (1, 0, 0, 0)


def test_delivery_flags(spark):
    late, early, exact = ("2024-01-11", "2024-01-09", "2024-01-10")
    rows = [(n, "c", "delivered", "2024-01-01", "2024-01-01", "2024-01-02", d, "2024-01-10")
            for n, d in (("late", late), ("early", early), ("exact", exact), ("none", None))]
    names = [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    df = df.withColumns({n: F.col(n).cast("timestamp") for n in names[3:]})
    got = {r["order_id"]: r for r in orders.delivery_features(df).collect()}
    assert set(got) == {"late", "early", "exact"}
    flags = {k: (r["delivered_on_time"], r["delivered_early"], r["delay_status"]) for k, r in got.items()}
    assert flags == {"late": (False, False, True), "early": (True, True, False), "exact": (True, False, False)}


def test_latest_review_breaks_ties_by_id(spark):
    rows = [("r1", "a", 1, "2024-01-01", "2024-01-03"), ("r2", "a", 5, "2024-01-01", "2024-01-03"),
            ("r3", "a", 2, None, "2024-01-09")]
    df = spark.createDataFrame(
        rows, "review_id string, order_id string, review_score int, review_creation_date string, review_answer_timestamp string"
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("review_creation_date", "review_answer_timestamp")})
    row = orders.latest_reviews(df).first()
    assert (row["review_id"], row["review_score"], row["review_response_time"]) == ("r2", 5, 2)


# --- donors -------------------------------------------------------------------

SPEC = donors.CampaignSpec(as_of=dt.date(2018, 9, 4))


def _donor_tables(spark, gifts):
    g = spark.createDataFrame(gifts, "gift_id int, donorID string, campaignID string, amount double, date date")
    people = spark.createDataFrame(
        [("d1", "A", "M", "FR", dt.date(1980, 9, 5)), ("d2", "B", "F", "NL", dt.date(2000, 9, 4)),
         ("d3", "Missing", None, "EN", None), ("out", "A", "M", "FR", dt.date(1950, 1, 1))],
        "donorID string, region string, gender string, language string, dateOfBirth date",
    )
    chosen = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "donorID string")
    campaigns = spark.createDataFrame(
        [("c1", dt.date(2018, 1, 1)), ("c2", dt.date(2018, 6, 30))], "campaignID string, date date"
    )
    return g, chosen, people, campaigns


GIFTS = [
    (1, "d1", "c1", 10.0, dt.date(2017, 12, 22)),
    (2, "d1", "c2", 30.0, dt.date(2018, 7, 1)),
    (3, "d1", "c2", 20.0, dt.date(2018, 7, 1)),
    (4, "d2", None, 5.0, dt.date(2018, 8, 5)),  # the last day of the history
    (5, "d3", "c1", 7.5, dt.date(2018, 1, 3)),
    (6, "d3", "c1", 7.5, dt.date(2018, 1, 4)),
    (7, "d1", "c1", 9.99, dt.date(2018, 9, 5)),  # target window
    (8, "d2", "c1", 4.0, dt.date(2018, 9, 10)),
    (9, "d2", "c1", 6.0, dt.date(2018, 10, 4)),
    (10, "d3", "c1", 50.0, dt.date(2018, 10, 5)),  # a day too late
    (11, "out", "c1", 99.0, dt.date(2018, 1, 1)),
]


def test_window_bounds():
    assert (SPEC.history_end, SPEC.target_start, SPEC.target_end) == (
        dt.date(2018, 8, 5), dt.date(2018, 9, 5), dt.date(2018, 10, 4),
    )


def test_rfm_rules(spark):
    got = {r["donorID"]: r for r in donors.rfm_features(*_donor_tables(spark, GIFTS), SPEC).collect()}
    assert set(got) == {"d1", "d2", "d3"}
    one, two, three = got["d1"], got["d2"], got["d3"]
    assert (one["frequency"], one["monetary_value"], one["recency"]) == (3, 60.0, 65)
    assert (one["max_donations"], one["min_donations"], one["Age"]) == (30.0, 10.0, 37)
    assert one["lifespan_days"] == 191 and one["donation_density"] == 95.5
    assert one["avg_daysdiff"] == pytest.approx(-2.67)  # (-10 + 1 + 1) / 3
    assert (one["amount"], one["campaignID"], one["donation_rank"], one["days_between"]) == (20.0, "c2", 2.5, 0)
    assert one["donation_trend"] == 1.0 and one["donation_variability"] == pytest.approx(10.0)
    assert two["donation_variability"] == 0.0  # one gift
    assert two["donation_trend"] == 1.0 and two["Age"] == 18
    assert two["avg_timediff"] == 1.0  # median of the gaps 191, 0 and 1
    assert two["donation_density"] == 0.0 and two["campaign_engagement"] == 0
    assert one["donor_loyalty"] == 1.0 and three["donor_loyalty"] == 0.5
    # 'Missing' takes the region of most gifts; it was A (3 of d1) against B and Missing.
    assert "fl_region_is_A" not in one.asDict() and three["fl_region_is_B"] == 0
    assert (three["fl_gender_is_M"], three["Age"]) == (0, 0)
    assert one["recent_donations_ratio"] == 1.0


def test_later_gifts_do_not_change_features(spark):
    late = GIFTS + [(20, "d1", "c2", 1000.0, dt.date(2018, 8, 6)), (21, "d2", "c1", 1.0, dt.date(2019, 1, 1))]
    before = donors.rfm_features(*_donor_tables(spark, GIFTS), SPEC)
    after = donors.rfm_features(*_donor_tables(spark, late), SPEC)
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))


def test_target_bounds_and_threshold(spark):
    tables = _donor_tables(spark, GIFTS)
    target = {r["donorID"]: r["target"] for r in donors.campaign_target(tables[0], tables[1], SPEC).collect()}
    assert target == {"d1": 0, "d2": 1}  # 9.99 and 10.00
    joined = donors.campaign_table(*tables, SPEC)
    assert {r["donorID"]: r["target"] for r in joined.collect()} == {"d1": 0, "d2": 1, "d3": 0}


def test_unreadable_gifts(spark):
    raw = spark.createDataFrame([("12,50", "31/12/2017"), ("abc", "2017-12-31")], "amount string, date string")
    rows = donors.parse_gifts(raw).collect()
    assert [(r["amount"], r["date"]) for r in rows] == [(12.5, dt.date(2017, 12, 31)), (None, None)]


# --- news ---------------------------------------------------------------------


def test_news_to_aspect_rows(spark):
    raw = spark.createDataFrame(
        [(1, "acme", ["Environmental", "Social"], [("Solar wind is good",), ("oil",)]),
         (2, "zeta", ["Environmental"], [(None,)])],
        "doc long, entity string, labels array<string>, articles array<struct<description:string>>",
    )
    texts = news.labelled_texts(raw, "Environmental")
    assert sorted((r["entity"], r["text"]) for r in texts.collect()) == [("acme", "Solar wind is good"), ("zeta", "")]
    lexicon = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    rows = news.aspect_sentiment(texts, "doc", lexicon).collect()
    assert [(r["entity"], r["aspect"], r["sentiment"]) for r in rows] == [("acme", "renewables", "positive")]


# --- plans --------------------------------------------------------------------


def test_payment_features_need_one_exchange(spark):
    plan = plan_of(all_queries()["payment_features"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1


def test_stored_subjects_are_grouped_and_joined_without_a_shuffle(spark):
    """Nothing is exchanged between the scans and the joins, even where nothing is broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    try:
        df = all_queries()["bucketed_basetable"](spark, SF)
        plan = plan_of(df)
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 3
        assert "Exchange" not in plan and "Bucketed: true" in plan
        rows = df.collect()
    finally:
        spark.conf.unset(name)
    want = all_queries()["order_basetable"](spark, SF)
    assert sorted(rows, key=str) == sorted(want.select(df.columns).collect(), key=str)


def test_engagement_sketches_keep_to_their_bound(spark):
    """Campaigns that come back in several parts count once; a donor with a third of all rows."""
    gifts = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10 + 1).alias("donorID"),
        (F.col("id") * 7 % 20_000).cast("string").alias("campaignID"),
        (F.col("id") % 4).alias("part"),
    )
    exact = {r[0]: r[1] for r in gifts.groupBy("donorID").agg(F.countDistinct("campaignID")).collect()}
    sketches = donors.engagement_sketches(gifts, F.col("part"))
    got = {r["donorID"]: r for r in donors.engagement_estimates(sketches).collect()}
    assert set(got) == set(exact)
    for donor, n in exact.items():
        # Four standard deviations.
        assert abs(got[donor]["campaign_engagement"] - n) <= 4 * 1.04 / 64 * n + 1
    few = gifts.limit(40)
    small = {r[0]: r[1] for r in few.groupBy("donorID").agg(F.countDistinct("campaignID")).collect()}
    found = donors.engagement_estimates(donors.engagement_sketches(few)).collect()
    assert {r["donorID"]: r["campaign_engagement"] for r in found} == small


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(all_queries()["urgent_orders"](spark, SF))
    assert "PushedFilters: [In(o_orderpriority" in plan
    assert "o_totalprice" not in plan


def test_no_python_in_relational_plans(spark):
    for name in ("order_basetable", "aspect_sentiment_counts", "top_terms", "score_deciles"):
        plan = plan_of(all_queries()[name](spark, SF))
        assert "Python" not in plan and "Pandas" not in plan


def test_deciles_move_no_rows(spark):
    plan = plan_of(all_queries()["score_deciles"](spark, SF))
    assert "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize(
    "name", ["aspect_sentiment_counts", "climate_aspects", "top_terms", "lemmatized_documents"]
)
def test_texts_are_cleaned_once(name, spark):
    plan = plan_of(all_queries()[name](spark, SF))
    # The initial plan; the stop list makes the cleaning expression easy to spot.
    assert plan.count("INSET a, about") == 1


def test_word_scores_are_hash_aggregated(spark):
    plan = plan_of(all_queries()["aspect_sentiment_counts"](spark, SF))
    assert "SortAggregate" not in plan


def test_news_flow_from_texts_to_counts(spark):
    """Relevance, both scorers, lemmas before aspects, a row per aspect."""
    import numpy as np

    from marlstone.operators.text_ops import aspect_sentiment_counts
    from marlstone.plans import news

    def by_word(word):
        return lambda: lambda texts: np.array([[float(word not in t), float(word in t)] for t in texts])

    texts = spark.createDataFrame(
        [(1, "a", "Good winds, 12 solars"), (2, "a", "bad court"), (3, "b", "spam winds"), (4, "b", "bad winds")],
        "id int, entity string, text string",
    )
    lexicon = spark.createDataFrame([("good", 3.0), ("bad", -3.0)], "token string, valence double")
    lemmas = spark.createDataFrame([("winds", "wind"), ("solars", "solar")], "token string, lemma string")
    flow = news.classified_aspects(
        texts, "id", lambda df: df.where(~F.array_contains("words", "spam")), by_word("12"), by_word("court"),
        lexicon, lemmas, {"air": ["wind "], "energy": ["solar", "wind"]}, {0: "risk", 1: "chance"},
    )
    rows = {(r["id"], r["specific"], r["sentiment_label"], r["aspect"], r["sentiment"]) for r in flow.collect()}
    assert rows == {
        (1, "yes", "risk", "air", "positive"),
        (1, "yes", "risk", "energy", "positive"),
        (4, "no", "risk", "energy", "negative"),
    }
    assert aspect_sentiment_counts(flow).count() == 3


def test_rows_of_words_hold_no_text(spark):
    """The news flow explodes words beside the keys alone: no row of a word carries its text."""
    from marlstone.functions.text import SENTIMENT_LABELS
    from marlstone.plans import news

    def even():
        import numpy as np

        return lambda texts: np.array([[float(len(t) % 3 == i) for i in range(3)] for t in texts])

    texts = spark.createDataFrame(
        [(1, "a", "wind solar winds"), (1, "a", "wind solar winds"), (2, None, "")],
        "id int, entity string, text string",
    )
    lexicon = spark.createDataFrame([("wind", 2.0)], "token string, valence double")
    lemmas = spark.createDataFrame(
        [("winds", "wind"), ("solar", "sun"), ("solar", None)], "token string, lemma string"
    )
    flow = news.classified_aspects(
        texts, "id", lambda df: df, lambda: even(), lambda: even(), lexicon, lemmas,
        {"air": ["wind wind"], "sun": ["sun"], "both": ["solar solar sun sun"]}, SENTIMENT_LABELS,
    )
    plan = flow._jdf.queryExecution().optimizedPlan().toString()
    exploded = [line for line in plan.splitlines() if "Generate " in line]
    assert exploded and not any("clean_text" in line.rpartition(", [")[2] for line in exploded)
    assert not any("clean_text" in line.partition("), [")[2].partition("]")[0] for line in exploded)
    # Copies of a row are one, in which every word and each of its lemmas comes twice.
    assert sorted((r["id"], r["aspect"]) for r in flow.collect()) == [(1, "air"), (1, "both"), (1, "sun")]


def test_buckets_follow_from_the_rows(spark):
    """A bucket holds so many rows at most on average, however many there are."""
    from marlstone.plans import orders

    assert orders.buckets_for(spark.range(10)) == 8
    assert orders.buckets_for(spark.range(900), spark.range(100), rows=10) == 100
    assert orders.buckets_for(spark.range(45_000_000)) > 8
