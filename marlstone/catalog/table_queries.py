"""Queries on sources, projections, filters, fills, profiles, sorts and splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marlstone.catalog.bindings import (
    GIFTS,
    HOURLY,
    NEWS,
    ORDERS,
    PRODUCTS,
    REVIEWS,
    SCORED,
    Tables,
    with_,
)
from marlstone.catalog.registry import Registry
from marlstone.functions.dates import (
    age_years,
    parse_dmy,
    parse_timestamp,
    shift_days,
    shift_months,
)
from marlstone.functions.numbers import (
    bucketize,
    cut,
    exact_mean,
    flag,
    interactions,
    map_values,
    parse_decimal_comma,
    parse_number,
    polarity,
)
from marlstone.operators import clean, grouping, profile, ranking, sampling, scaling
from marlstone.operators.selection import exact_median, interpolated_percentiles
from marlstone.session import scratch_path
from marlstone.sources import files

QUERIES = Registry()


def exact_avg(col: str) -> str:
    """Mean from the exact sum."""
    return f"(CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE) / count({col}))"


# --- sources and sinks ----------------------------------------------------------


@QUERIES.add("csv_with_schema", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_with_schema(t: Tables):
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.raw("customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return files.read_csv(t.spark, path, schema)


@QUERIES.add(
    "csv_inferred_types",
    """SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def csv_inferred_types(t: Tables):
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.raw("supplier"), path)
    return files.read_csv(t.spark, path)


@QUERIES.add(
    "csv_semicolon_with_nulls",
    """SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_size END AS p_size,
         CASE WHEN p_brand <> 'Brand#2' THEN p_brand END AS p_brand FROM part""",
)
def csv_semicolon_with_nulls(t: Tables):
    path = scratch_path(t.spark, "csv")
    parts = t.raw("part").select(
        "p_partkey",
        F.when(F.col("p_size") % 5 == 0, "NA").otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.when(F.col("p_brand") == "Brand#2", "Missing").otherwise(F.col("p_brand")).alias("p_brand"),
    )
    parts.write.option("header", True).option("sep", ";").csv(path)
    schema = "p_partkey bigint, p_size int, p_brand string"
    return files.read_csv(t.spark, path, schema, sep=";", null_values=("NA", "Missing"))


@QUERIES.add(
    "labelled_corpus_scan",
    "SELECT doc_id, lang, source, n_chars, quality FROM documents JOIN labels USING (doc_id)",
)
def labelled_corpus_scan(t: Tables):
    documents = files.read_parquet(t.spark, f"{t.sf_dir}/documents.parquet")
    labels = files.read_parquet(t.spark, f"{t.sf_dir}/labels.parquet")
    return documents.join(labels, "doc_id").select("doc_id", "lang", "source", "n_chars", "quality")


@QUERIES.add(
    "nested_records",
    with_(NEWS)
    + """SELECT entity, count(DISTINCT conv_id) AS records, count(*) AS articles,
           CAST(sum(length(description)) AS BIGINT) AS chars FROM news GROUP BY entity""",
)
def nested_records(t: Tables):
    path = scratch_path(t.spark, "json")
    t.news.write.json(path)
    schema = "conv_id long, entity string, labels array<string>, articles array<struct<description:string>>"
    news = files.read_nested(
        t.spark, path, schema, {"conv_id": "conv_id", "entity": "entity", "articles": "text"}
    )
    lengths = F.aggregate("text", F.lit(0), lambda n, a: n + F.length(a["description"]))
    return news.groupBy("entity").agg(
        F.count("conv_id").alias("records"),
        F.sum(F.size("text")).alias("articles"),
        F.sum(lengths).alias("chars"),
    )


@QUERIES.add(
    "prediction_export",
    with_(SCORED) + "SELECT id, prediction, round(score, 3) AS score FROM scored",
)
def prediction_export(t: Tables):
    path = scratch_path(t.spark, "export")
    files.write_csv(t.scored.select("id", "prediction", F.round("score", 3).alias("score")), path)
    return files.read_csv(t.spark, path, "id long, prediction int, score double")


@QUERIES.add(
    "schema_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS data_type, count({c}) AS non_null, "
        "count(*) AS row_count FROM orders"
        for c, k in (
            ("o_orderkey", "bigint"),
            ("o_custkey", "bigint"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string"),
        )
    ),
)
def schema_profile(t: Tables):
    return profile.profile_schema(t.raw("orders"))


# --- projections and filters -----------------------------------------------------


@QUERIES.add(
    "product_volume",
    with_(PRODUCTS)
    + """SELECT product_id, product_length_cm * product_height_cm * product_width_cm
           AS product_volume FROM products""",
)
def product_volume(t: Tables):
    sides = [f"product_{s}_cm" for s in ("length", "height", "width")]
    return clean.with_product(t.products, sides, "product_volume").select("product_id", "product_volume")


@QUERIES.add("dropped_columns", "SELECT c_custkey, c_acctbal FROM customer")
def dropped_columns(t: Tables):
    return clean.feature_columns(t.raw("customer"), ["c_name", "c_nationkey", "c_mktsegment", "not_there"])


@QUERIES.add(
    "renamed_columns",
    "SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey AS region_id FROM nation",
)
def renamed_columns(t: Tables):
    names = {"n_nationkey": "nation_id", "n_name": "nation", "n_regionkey": "region_id"}
    return t.raw("nation").withColumnsRenamed(names)


@QUERIES.add(
    "first_payment_types",
    """SELECT l_orderkey AS order_id, l_returnflag AS primary_payment_type
         FROM lineitem WHERE l_linenumber = 1""",
)
def first_payment_types(t: Tables):
    return t.raw("lineitem").where(F.col("l_linenumber") == 1).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("primary_payment_type")
    )


@QUERIES.add(
    "unequal_filter_drops_nulls",
    with_(PRODUCTS)
    + """SELECT product_id, product_category_name FROM products
         WHERE product_category_name <> 'PROMO'""",
)
def unequal_filter_drops_nulls(t: Tables):
    return t.products.where(F.col("product_category_name") != "PROMO").select(
        "product_id", "product_category_name"
    )


@QUERIES.add(
    "known_category_products",
    with_(PRODUCTS)
    + "SELECT product_id, product_weight_g FROM products WHERE product_category_name IS NOT NULL",
)
def known_category_products(t: Tables):
    return t.products.where(F.col("product_category_name").isNotNull()).select(
        "product_id", "product_weight_g"
    )


@QUERIES.add(
    "gifts_until_cutoff",
    with_(GIFTS) + "SELECT gift_id, donorID, amount FROM gifts WHERE date <= DATE '1999-12-02'",
)
def gifts_until_cutoff(t: Tables):
    return clean.history_as_of(t.gifts, "date", dt.date(1999, 12, 2)).select("gift_id", "donorID", "amount")


@QUERIES.add(
    "gifts_in_target_window",
    with_(GIFTS)
    + """SELECT gift_id, donorID, amount FROM gifts
         WHERE date BETWEEN DATE '2000-01-02' AND DATE '2000-01-31'""",
)
def gifts_in_target_window(t: Tables):
    window = clean.between_dates(t.gifts, "date", dt.date(2000, 1, 2), dt.date(2000, 1, 31))
    return window.select("gift_id", "donorID", "amount")


@QUERIES.add(
    "urgent_orders",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def urgent_orders(t: Tables):
    return t.raw("orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority"
    )


@QUERIES.add(
    "compound_predicates",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE (l_returnflag = 'R' AND l_quantity > 25)
          OR (l_discount >= 0.09 AND NOT l_linestatus = 'O')""",
)
def compound_predicates(t: Tables):
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)
    discounted = (F.col("l_discount") >= 0.09) & ~(F.col("l_linestatus") == "O")
    return t.raw("lineitem").where(returned | discounted).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )


@QUERIES.add(
    "balance_outliers_dropped",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN -500 AND 9000",
)
def balance_outliers_dropped(t: Tables):
    return clean.drop_outliers(t.raw("customer"), "c_acctbal", -500, 9000).select("c_custkey", "c_acctbal")


@QUERIES.add(
    "customers_without_large_orders",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
         SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def customers_without_large_orders(t: Tables):
    large = t.raw("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return clean.drop_keys(t.raw("customer").select("c_custkey", "c_name"), large, "c_custkey")


@QUERIES.add(
    "complete_orders",
    with_(ORDERS)
    + """SELECT order_id, order_status FROM shop_orders
         WHERE order_delivered_customer_date IS NOT NULL""",
)
def complete_orders(t: Tables):
    return clean.drop_incomplete(t.orders).select("order_id", "order_status")


_GAPPY = """gappy AS (
  SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS price,
         CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS size,
         CASE WHEN p_partkey % 13 = 0 THEN 'Missing' ELSE p_type END AS kind
  FROM part)"""


def _gappy(t: Tables):
    """Parts with gaps in price and size and a marker text in the type."""
    key = F.col("p_partkey")
    return t.raw("part").select(
        "p_partkey",
        F.when(key % 7 != 0, F.col("p_retailprice")).alias("price"),
        F.when(key % 5 != 0, F.col("p_size")).alias("size"),
        F.when(key % 13 == 0, "Missing").otherwise(F.col("p_type")).alias("kind"),
    )


@QUERIES.add(
    "filled_constants",
    with_(_GAPPY)
    + """SELECT p_partkey, coalesce(price, -1) AS price, coalesce(size, 99) AS size, kind FROM gappy""",
)
def filled_constants(t: Tables):
    return clean.fill_constants(_gappy(t), {"price": -1, "size": 99})


@QUERIES.add(
    "filled_zeros",
    with_(_GAPPY)
    + """SELECT p_partkey, coalesce(price, 0) AS price, coalesce(size, 0) AS size, kind FROM gappy""",
)
def filled_zeros(t: Tables):
    return clean.fill_constants(_gappy(t), 0)


@QUERIES.add(
    "median_imputed_prices",
    with_(_GAPPY)
    + """SELECT p_partkey, coalesce(price, (SELECT median(price) FROM gappy)) AS price FROM gappy""",
)
def median_imputed_prices(t: Tables):
    return clean.impute_median(_gappy(t).select("p_partkey", "price"), "price")


@QUERIES.add(
    "mode_imputed_kinds",
    with_(_GAPPY)
    + """SELECT p_partkey, CASE WHEN kind = 'Missing' THEN (
           SELECT kind FROM gappy GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)
         ELSE kind END AS kind FROM gappy""",
)
def mode_imputed_kinds(t: Tables):
    return clean.impute_mode(_gappy(t).select("p_partkey", "kind"), "kind", "Missing")


@QUERIES.add(
    "voucher_flags",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END
         AS voucher_used FROM lineitem""",
)
def voucher_flags(t: Tables):
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", flag(F.col("l_returnflag") == "R").alias("voucher_used")
    )


@QUERIES.add(
    "threshold_targets",
    with_(GIFTS)
    + """SELECT donorID, CASE WHEN sum(CAST(amount AS DECIMAL(18,2))) >= 2500000 THEN 1 ELSE 0 END
           AS target FROM gifts GROUP BY donorID""",
)
def threshold_targets(t: Tables):
    total = F.sum(F.col("amount").cast("decimal(18,2)"))
    return t.gifts.groupBy("donorID").agg((total >= 2500000).cast("int").alias("target"))


@QUERIES.add("feature_view", "SELECT l_quantity, l_discount, l_tax FROM lineitem")
def feature_view(t: Tables):
    hidden = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    return clean.feature_columns(t.raw("lineitem"), hidden)


# --- profiles ---------------------------------------------------------------------


@QUERIES.add(
    "missing_counts",
    with_(ORDERS)
    + """SELECT """
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in (
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
        )
    )
    + " FROM shop_orders",
)
def missing_counts(t: Tables):
    return profile.count_missing(t.orders)


@QUERIES.add(
    "sentinel_counts",
    with_(_GAPPY)
    + """SELECT count(*) FILTER (CAST(p_partkey AS VARCHAR) = 'Missing') AS p_partkey,
           count(*) FILTER (CAST(price AS VARCHAR) = 'Missing') AS price,
           count(*) FILTER (CAST(size AS VARCHAR) = 'Missing') AS size,
           count(*) FILTER (kind = 'Missing') AS kind FROM gappy""",
)
def sentinel_counts(t: Tables):
    return profile.count_sentinel(_gappy(t), "Missing")


@QUERIES.add(
    "sentinels_as_null",
    with_(_GAPPY) + "SELECT p_partkey, nullif(kind, 'Missing') AS kind FROM gappy",
)
def sentinels_as_null(t: Tables):
    return profile.normalize_sentinels(_gappy(t).select("p_partkey", "kind"), ["Missing", "NA"])


@QUERIES.add(
    "category_frequencies",
    with_(PRODUCTS) + "SELECT product_category_name, count(*) AS n FROM products GROUP BY 1",
)
def category_frequencies(t: Tables):
    return profile.value_counts(t.products, "product_category_name", dropna=False)


@QUERIES.add(
    "repeat_reviewers",
    with_(REVIEWS) + "SELECT order_id, count(*) AS n FROM reviews GROUP BY order_id HAVING count(*) > 1",
)
def repeat_reviewers(t: Tables):
    return profile.duplicate_keys(t.reviews, "order_id")


@QUERIES.add(
    "distinct_categories",
    with_(PRODUCTS) + "SELECT DISTINCT product_category_name FROM products",
)
def distinct_categories(t: Tables):
    return t.products.select("product_category_name").distinct()


@QUERIES.add(
    "row_counts",
    """SELECT count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS delivered FROM orders""",
)
def row_counts(t: Tables):
    return t.raw("orders").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("delivered"),
    )


def _summary_sql(col: str, table: str) -> str:
    return f"""SELECT '{col}' AS column_name, count({col}) AS count,
      round(avg({col}), 3) AS mean, round(stddev_samp({col}), 3) AS stddev,
      CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max,
      round(CAST(quantile_cont({col}, 0.25) AS DOUBLE), 3) AS q25,
      round(CAST(quantile_cont({col}, 0.5) AS DOUBLE), 3) AS median,
      round(CAST(quantile_cont({col}, 0.75) AS DOUBLE), 3) AS q75 FROM {table}"""


@QUERIES.add(
    "numeric_summary",
    " UNION ALL ".join(_summary_sql(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")),
)
def numeric_summary(t: Tables):
    table = profile.summarize(t.raw("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    rounded = ("mean", "stddev", "q25", "median", "q75")
    return table.withColumns({c: F.round(c, 3) for c in rounded})


@QUERIES.add(
    "donor_frequencies",
    with_(GIFTS) + "SELECT donorID, count(*) AS frequency FROM gifts GROUP BY donorID",
)
def donor_frequencies(t: Tables):
    return t.gifts.groupBy("donorID").agg(F.count(F.lit(1)).alias("frequency"))


@QUERIES.add(
    "median_price",
    "SELECT round(median(l_extendedprice), 4) AS median_price FROM lineitem",
)
def median_price(t: Tables):
    median = exact_median(t.raw("lineitem"), "l_extendedprice")
    return t.spark.range(1).select(F.round(F.lit(median), 4).alias("median_price"))


@QUERIES.add(
    "price_percentiles",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(o_totalprice, {p}), 4) AS value FROM orders"
        for p in (0.01, 0.1, 0.9, 0.99)
    ),
)
def price_percentiles(t: Tables):
    wanted = [0.01, 0.1, 0.9, 0.99]
    values = interpolated_percentiles(t.raw("orders"), {"o_totalprice": wanted})["o_totalprice"]
    table = t.spark.createDataFrame(list(zip(wanted, values, strict=True)), "p double, value double")
    return table.withColumn("value", F.round("value", 4))


@QUERIES.add(
    "most_frequent_kind",
    with_(_GAPPY) + "SELECT kind AS mode FROM gappy GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1",
)
def most_frequent_kind(t: Tables):
    return profile.mode_of(_gappy(t), "kind")


@QUERIES.add(
    "segment_shares",
    """SELECT c_mktsegment, count(*) AS n,
         CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) * 100 AS percent
       FROM customer GROUP BY c_mktsegment""",
)
def segment_shares(t: Tables):
    return profile.distribution(t.raw("customer"), "c_mktsegment")


@QUERIES.add(
    "compared_shares",
    """WITH a AS (SELECT * FROM customer WHERE c_acctbal > 5000 AND c_mktsegment <> 'BUILDING'),
       b AS (SELECT * FROM customer WHERE c_acctbal < 0 AND c_mktsegment <> 'MACHINERY'),
       x AS (SELECT c_mktsegment, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM a) * 100 AS percent_a
             FROM a GROUP BY 1),
       y AS (SELECT c_mktsegment, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM b) * 100 AS percent_b
             FROM b GROUP BY 1)
       SELECT c_mktsegment, percent_a, percent_b FROM x FULL JOIN y USING (c_mktsegment)""",
)
def compared_shares(t: Tables):
    customers = t.raw("customer")
    a = customers.where("c_acctbal > 5000 and c_mktsegment <> 'BUILDING'")
    b = customers.where("c_acctbal < 0 and c_mktsegment <> 'MACHINERY'")
    return profile.compare_distributions(a, b, "c_mktsegment")


# --- groups, scalars, set operations -------------------------------------------------


@QUERIES.add(
    "orders_with_customer_mean",
    f"""SELECT o_orderkey, o_totalprice, m AS customer_mean FROM orders JOIN (
          SELECT o_custkey, {exact_avg('o_totalprice')} AS m FROM orders GROUP BY 1) USING (o_custkey)""",
)
def orders_with_customer_mean(t: Tables):
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    stats = {"customer_mean": exact_mean(F.col("o_totalprice"))}
    return grouping.with_group_stats(orders, "o_custkey", stats).drop("o_custkey")


@QUERIES.add(
    "segment_mean_balance",
    """SELECT c_custkey, round(avg(c_acctbal) OVER (PARTITION BY c_mktsegment), 4) AS segment_mean
       FROM customer""",
)
def segment_mean_balance(t: Tables):
    customers = t.raw("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    table = grouping.with_group_mean(customers, "c_mktsegment", "c_acctbal", "segment_mean")
    return table.select("c_custkey", F.round("segment_mean", 4).alias("segment_mean"))


@QUERIES.add(
    "late_to_early_ratio",
    """SELECT o_custkey,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderdate >= DATE '2000-01-01') AS DOUBLE)
         / nullif(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderdate < DATE '1996-01-01')
           AS DOUBLE), 0) AS ratio
       FROM orders GROUP BY o_custkey""",
)
def late_to_early_ratio(t: Tables):
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    late = F.sum(F.when(F.col("o_orderdate") >= F.lit(dt.date(2000, 1, 1)), amount)).cast("double")
    early = F.sum(F.when(F.col("o_orderdate") < F.lit(dt.date(1996, 1, 1)), amount)).cast("double")
    return grouping.ratio_of_groups(t.raw("orders"), "o_custkey", late, early, "ratio")


@QUERIES.add(
    "price_over_mean",
    f"""SELECT o_orderkey, o_totalprice / (SELECT {exact_avg('o_totalprice')} FROM orders)
          AS relative_price FROM orders""",
)
def price_over_mean(t: Tables):
    orders = t.raw("orders").select("o_orderkey", "o_totalprice")
    mean = orders.agg(exact_mean(F.col("o_totalprice"))).scalar()
    return orders.select("o_orderkey", (F.col("o_totalprice") / mean).alias("relative_price"))


@QUERIES.add(
    "train_and_validation_union",
    """SELECT doc_id, quality FROM labels WHERE doc_id % 100 < 80
       UNION ALL SELECT doc_id, quality FROM labels WHERE doc_id % 100 >= 80""",
)
def train_and_validation_union(t: Tables):
    labels = t.raw("labels").select("doc_id", "quality")
    train, validation = sampling.split_by_modulo(labels, "doc_id", 80)
    return grouping.union_all(train, validation.select("quality", "doc_id"))


# --- sorts, limits, splits ------------------------------------------------------------


@QUERIES.add(
    "orders_by_price",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey",
)
def orders_by_price(t: Tables):
    return t.raw("orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@QUERIES.add(
    "order_preview",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
)
def order_preview(t: Tables):
    return t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@QUERIES.add(
    "largest_balances",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5",
)
def largest_balances(t: Tables):
    return ranking.top_k(t.raw("customer").select("c_custkey", "c_acctbal"), "c_acctbal", 5, "c_custkey")


@QUERIES.add(
    "types_by_total",
    """SELECT event_type, user_bucket, n, CAST(sum(n) OVER (PARTITION BY event_type) AS BIGINT) AS total
       FROM (SELECT event_type, user_id % 3 AS user_bucket, count(*) AS n FROM events GROUP BY 1, 2)""",
)
def types_by_total(t: Tables):
    counts = t.raw("events").groupBy("event_type", (F.col("user_id") % 3).alias("user_bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return grouping.order_by_total(counts, "event_type", "n")


@QUERIES.add(
    "first_entity",
    "SELECT source FROM documents ORDER BY lang, source LIMIT 1",
)
def first_entity(t: Tables):
    return grouping.first_group(t.raw("documents"), ["lang", "source"], "source")


@QUERIES.add(
    "random_split_sizes",
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS in_both, TRUE AS near_share FROM orders",
)
def random_split_sizes(t: Tables):
    """A random split covers all rows, none twice, in about the shares asked for."""
    train, test = sampling.split_random(t.raw("orders").select("o_orderkey"), [0.7, 0.3], 123)
    both = train.withColumn("train", F.lit(1)).unionByName(test.withColumn("train", F.lit(0)))
    per_row = both.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("train").alias("train"))
    return per_row.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("n") > 1).alias("in_both"),
        (F.abs(F.avg("train") - 0.7) < 0.05).alias("near_share"),
    )


@QUERIES.add(
    "keyed_split",
    """SELECT doc_id, CASE WHEN doc_id % 100 < 80 THEN 'train' ELSE 'validation' END AS part FROM documents""",
)
def keyed_split(t: Tables):
    train, validation = sampling.split_by_modulo(t.raw("documents").select("doc_id"), "doc_id", 80)
    return train.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )


@QUERIES.add("hashed_split", "SELECT doc_id, lang, CAST(1 AS BIGINT) AS parts FROM documents")
def hashed_split(t: Tables):
    """Every row is in one part."""
    train, test = sampling.split_by_key(t.raw("documents").select("doc_id", "lang"), "doc_id", 80, 42)
    return train.unionByName(test).groupBy("doc_id", "lang").agg(F.count(F.lit(1)).alias("parts"))


@QUERIES.add(
    "random_sample",
    "SELECT least(count(*), 30) AS rows, least(count(*), 30) AS different, TRUE AS known FROM embeddings",
)
def random_sample(t: Tables):
    """So many rows, all different, all of the table."""
    table = t.raw("embeddings").select("vec_id", "label")
    sample = sampling.sample_n(table, 30, seed=7, keys=["vec_id"])
    known = sample.join(table.withColumn("known", F.lit(1)), ["vec_id", "label"], "left")
    return known.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("vec_id").alias("different"),
        F.bool_and(F.col("known").isNotNull()).alias("known"),
    )


# --- scalar functions -------------------------------------------------------------------


@QUERIES.add(
    "parsed_timestamps",
    """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN epoch_us(date_trunc('second', ts)) // 1000000 END
         AS seconds FROM events""",
)
def parsed_timestamps(t: Tables):
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("event_id") % 10 == 0, "not a time").otherwise(text)
    parsed = parse_timestamp(broken, "yyyy-MM-dd HH:mm:ss")
    return t.raw("events").select("event_id", F.unix_timestamp(parsed).alias("seconds"))


@QUERIES.add(
    "parsed_dates_and_amounts",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
         CASE WHEN o_orderkey % 8 NOT IN (0, 1) THEN o_totalprice END AS amount,
         CASE WHEN o_orderkey % 8 <> 0 THEN o_totalprice END AS plain
       FROM orders""",
)
def parsed_dates_and_amounts(t: Tables):
    key = F.col("o_orderkey")
    day = F.when(key % 9 == 0, "31/31/1999").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    number = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    comma = F.when(key % 8 == 0, "abc").when(key % 8 == 1, "").otherwise(F.replace(number, F.lit("."), F.lit(",")))
    plain = F.when(key % 8 == 0, "n/a").otherwise(number)
    return t.raw("orders").select(
        "o_orderkey",
        parse_dmy(day).cast("string").alias("day"),
        parse_decimal_comma(comma).alias("amount"),
        parse_number(plain).alias("plain"),
    )


@QUERIES.add(
    "ages",
    """WITH born AS (SELECT c_custkey, DATE '1920-01-15' + CAST(c_custkey * 37 % 24000 AS INTEGER) AS dob
                     FROM customer)
       SELECT c_custkey, CAST(date_part('year', age(DATE '2018-08-04', dob)) AS INTEGER) AS years
       FROM born""",
)
def ages(t: Tables):
    born = F.date_add(F.lit(dt.date(1920, 1, 15)), (F.col("c_custkey") * 37 % 24000).cast("int"))
    as_of = F.lit(dt.date(2018, 8, 4))
    return t.raw("customer").select("c_custkey", age_years(born, as_of).alias("years"))


@QUERIES.add(
    "calendar_offsets",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS plus_30_days,
         strftime(o_orderdate - INTERVAL 1 YEAR, '%Y-%m-%d') AS year_before,
         date_diff('day', o_orderdate::DATE, DATE '2001-12-31') AS days_left
       FROM orders""",
)
def calendar_offsets(t: Tables):
    day = F.to_date("o_orderdate")
    return t.raw("orders").select(
        "o_orderkey",
        shift_days(day, 30).cast("string").alias("plus_30_days"),
        shift_months(day, -12).cast("string").alias("year_before"),
        F.datediff(F.lit(dt.date(2001, 12, 31)), day).cast("long").alias("days_left"),
    )


@QUERIES.add(
    "size_groups",
    """SELECT p_partkey, CASE WHEN p_size > 1 AND p_size <= 10 THEN 'small'
         WHEN p_size > 10 AND p_size <= 30 THEN 'medium' WHEN p_size > 30 AND p_size <= 45 THEN 'large' END
         AS size_group FROM part""",
)
def size_groups(t: Tables):
    groups = cut(F.col("p_size"), [1, 10, 30, 45], ["small", "medium", "large"])
    return t.raw("part").select("p_partkey", groups.alias("size_group"))


@QUERIES.add(
    "price_buckets",
    """SELECT p_partkey,
         CAST(CASE WHEN p_retailprice >= 1500 THEN 2 WHEN p_retailprice >= 1000 THEN 1 ELSE 0 END AS DOUBLE)
           AS bucket,
         CAST(CASE WHEN p_retailprice NOT BETWEEN 950 AND 1800 THEN NULL WHEN p_retailprice >= 1500 THEN 2
           WHEN p_retailprice >= 1000 THEN 1 ELSE 0 END AS DOUBLE) AS bucket_or_null
       FROM part""",
)
def price_buckets(t: Tables):
    splits = [950, 1000, 1500, 1800]
    return t.raw("part").select(
        "p_partkey",
        bucketize(F.col("p_retailprice"), splits).alias("bucket"),
        bucketize(F.col("p_retailprice"), splits, "null").alias("bucket_or_null"),
    )


@QUERIES.add(
    "interaction_products",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * l_discount AS quantity_discount,
         l_quantity * l_tax AS quantity_tax, l_discount * l_tax AS discount_tax FROM lineitem""",
)
def interaction_products(t: Tables):
    pairs = {
        "quantity_discount": ("l_quantity", "l_discount"),
        "quantity_tax": ("l_quantity", "l_tax"),
        "discount_tax": ("l_discount", "l_tax"),
    }
    table = t.raw("lineitem").withColumns(interactions(pairs))
    return table.select("l_orderkey", "l_linenumber", "l_partkey", *pairs)


@QUERIES.add(
    "rounding_modes",
    """SELECT l_orderkey, l_partkey, l_quantity, CAST((q + 1) // 2 AS DOUBLE) AS half_up,
         CAST(CASE q % 4 WHEN 1 THEN (q - 1) // 2 WHEN 3 THEN (q + 1) // 2 ELSE q // 2 END AS DOUBLE)
           AS half_even
       FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem)""",
)
def rounding_modes(t: Tables):
    half = F.col("l_quantity") / 2
    return t.raw("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity",
        F.round(half, 0).alias("half_up"), F.bround(half, 0).alias("half_even"),
    )


@QUERIES.add(
    "values_as_text",
    "SELECT n_nationkey, CAST(n_regionkey AS VARCHAR) AS region_text FROM nation",
)
def values_as_text(t: Tables):
    return t.raw("nation").select("n_nationkey", F.col("n_regionkey").cast("string").alias("region_text"))


@QUERIES.add(
    "mapped_codes",
    """SELECT vec_id, CASE label WHEN 0 THEN 'risk' WHEN 1 THEN 'neutral' WHEN 2 THEN 'opportunity' END
         AS name FROM embeddings""",
)
def mapped_codes(t: Tables):
    from marlstone.functions.text import SENTIMENT_LABELS

    return t.raw("embeddings").select("vec_id", map_values(F.col("label"), SENTIMENT_LABELS).alias("name"))


@QUERIES.add(
    "polarity_classes",
    """SELECT event_id, CASE WHEN c >= 0.05 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END
         AS polarity FROM (SELECT event_id, CAST(event_id % 41 - 20 AS DOUBLE) / 100 AS c FROM events)""",
)
def polarity_classes(t: Tables):
    compound = (F.col("event_id") % 41 - 20).cast("double") / 100
    return t.raw("events").select("event_id", polarity(compound).alias("polarity"))


# --- fitted column transforms ---------------------------------------------------------------


@QUERIES.add(
    "segment_dummies",
    """SELECT c_custkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS segment_BUILDING,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS segment_FURNITURE,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS segment_HOUSEHOLD,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS segment_MACHINERY
       FROM customer""",
)
def segment_dummies(t: Tables):
    customers = t.raw("customer").select("c_custkey", "c_mktsegment")
    return scaling.dummies(customers, "c_mktsegment", "segment", drop_first=True)


@QUERIES.add(
    "label_indexes",
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS class_index
       FROM orders""",
)
def label_indexes(t: Tables):
    orders = t.raw("orders").select("o_orderkey", "o_orderpriority")
    return scaling.index_labels(orders, "o_orderpriority").drop("o_orderpriority")


@QUERIES.add(
    "standardized_columns",
    """SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer))
           / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal,
         round((c_nationkey - (SELECT avg(c_nationkey) FROM customer))
           / (SELECT stddev_pop(c_nationkey) FROM customer), 6) AS c_nationkey
       FROM customer""",
)
def standardized_columns(t: Tables):
    customers = t.raw("customer").select("c_custkey", "c_acctbal", "c_nationkey")
    cols = ["c_acctbal", "c_nationkey"]
    table = scaling.Standardizer.fit(customers, cols).transform(customers)
    return table.withColumns({c: F.round(c, 6) for c in cols})


@QUERIES.add(
    "minmax_scaled_series",
    with_(HOURLY)
    + """SELECT series, hour, (value - (SELECT min(value) FROM hourly))
           / ((SELECT max(value) FROM hourly) - (SELECT min(value) FROM hourly)) AS scaled,
         round(value, 6) AS restored FROM hourly""",
)
def minmax_scaled_series(t: Tables):
    scaler = scaling.MinMaxScaler.fit(t.hourly, "value")
    scaled = t.hourly.withColumn("scaled", scaler.scale(F.col("value")))
    return scaled.select("series", "hour", "scaled", F.round(scaler.inverse(F.col("scaled")), 6).alias("restored"))


@QUERIES.add(
    "balanced_class_weights",
    """SELECT doc_id, quality, (SELECT count(*) FROM labels) / (SELECT count(DISTINCT quality) FROM labels)
           / CAST(count(*) OVER (PARTITION BY quality) AS DOUBLE) AS weight FROM labels""",
)
def balanced_class_weights(t: Tables):
    return scaling.balanced_weights(t.raw("labels").select("doc_id", "quality"), "quality")
