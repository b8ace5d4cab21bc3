"""Queries of the order domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.catalog.bindings import (
    ITEMS,
    ORDERS,
    PAYMENTS,
    PRODUCTS,
    REVIEWS,
    Tables,
    days,
    seconds,
    with_,
)
from marlstone.catalog.registry import Registry
from marlstone.functions.dates import days_between, whole_days
from marlstone.operators.grouping import latest_per_key, with_group_count, with_group_stats
from marlstone.operators.profile import value_counts
from marlstone.functions.numbers import exact_sum, map_classes, rounded_sum
from marlstone.plans import orders as plan
from marlstone.session import scratch_path

QUERIES = Registry()

TOTALS = """SELECT order_id,
  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_price_of_order,
  CAST(round(sum(CAST(shipping_cost AS DECIMAL(18,4))), 2) AS DOUBLE) AS total_shipping_of_order
  FROM items GROUP BY order_id"""


def _bucket(value: str, splits: list[float], out: str) -> str:
    whens = "".join(
        f" WHEN {value} >= {edge} THEN {i}" for i, edge in reversed(list(enumerate(splits[1:-1], 1)))
    )
    return f"CAST(CASE{whens} ELSE 0 END AS DOUBLE) AS {out}"


ITEM_FEATURES = f"""item_lines AS (
  SELECT *, product_category_name IS NOT NULL AND product_weight_g IS NOT NULL AS complete
  FROM items LEFT JOIN products USING (product_id)),
item_totals AS (
  SELECT order_id, count(order_item_id) AS total_items_in_order,
         CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_price_of_order,
         CAST(round(sum(CAST(shipping_cost AS DECIMAL(18,4))), 2) AS DOUBLE) AS total_shipping_of_order
  FROM items GROUP BY order_id),
item_products AS (
  SELECT order_id,
         CAST(sum(product_description_lenght) AS DOUBLE) / count(*) AS descr,
         CAST(sum(product_name_lenght) AS DOUBLE) / count(*) AS name,
         sum(product_weight_g) AS weight,
         CAST(sum(product_photos_qty) AS BIGINT) AS total_photos_in_order,
         sum(product_length_cm * product_height_cm * product_width_cm) AS volume
  FROM item_lines WHERE complete GROUP BY order_id),
item_category AS (
  SELECT order_id, product_category_name AS category FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
             ORDER BY order_item_id, product_id, product_category_name) AS rn
    FROM item_lines WHERE complete) WHERE rn = 1),
item_features AS (
  SELECT order_id, total_items_in_order, total_price_of_order, total_shipping_of_order,
         total_photos_in_order, category,
         {_bucket('descr', plan.DESCRIPTION_SPLITS, 'Buckets_descr')},
         {_bucket('name', plan.NAME_SPLITS, 'Buckets_name')},
         {_bucket('weight', plan.WEIGHT_SPLITS, 'Buckets_weight')},
         {_bucket('volume', plan.VOLUME_SPLITS, 'Buckets_volume')}
  FROM item_totals JOIN item_products USING (order_id) JOIN item_category USING (order_id))"""

PAYMENT_FEATURES = """payment_features AS (
  SELECT order_id,
         max(CASE WHEN payment_type = 'voucher' THEN 1 ELSE 0 END) AS if_voucher_used,
         count(*) FILTER (payment_type = 'voucher') AS voucher_count,
         max(payment_sequential) AS max_payment_sequential,
         coalesce(CAST(sum(CAST(payment_value AS DECIMAL(18,2)))
           FILTER (payment_type = 'voucher') AS DOUBLE), 0) AS total_voucher_payment,
         coalesce(CAST(sum(CAST(payment_value AS DECIMAL(18,2)))
           FILTER (payment_type <> 'voucher') AS DOUBLE), 0) AS total_non_voucher_payment,
         CAST(sum(payment_installments) AS BIGINT) AS total_installments,
         min(payment_type) FILTER (payment_sequential = 1) AS primary_payment_type
  FROM payments GROUP BY order_id
  HAVING count(*) FILTER (payment_sequential = 1) > 0)"""

DELIVERY_FEATURES = f"""delivery_features AS (
  SELECT order_id, customer_id,
         {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS delivery_time,
         order_delivered_customer_date <= order_estimated_delivery_date AS delivered_on_time,
         {days('order_delivered_customer_date', 'order_estimated_delivery_date')}
           AS estimated_vs_actual_delay_days,
         order_delivered_customer_date < order_estimated_delivery_date AS delivered_early,
         {days('order_approved_at', 'order_purchase_timestamp')} AS approval_time,
         order_delivered_customer_date > order_estimated_delivery_date AS delay_status
  FROM shop_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL)"""

LATEST_REVIEWS = f"""latest_reviews AS (
  SELECT review_id, order_id, review_score,
         CAST(trunc(CAST({seconds('review_answer_timestamp', 'review_creation_date')} AS DOUBLE)
              / 86400) AS INTEGER) AS review_response_time
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY review_answer_timestamp DESC, review_id DESC) AS rn FROM reviews)
  WHERE rn = 1)"""

LABELS = """CASE WHEN review_score IN (1, 2) THEN 0 WHEN review_score IN (3, 4) THEN 1
         WHEN review_score = 5 THEN 2 END AS multiclass_label,
       CASE WHEN review_score IN (1, 2, 3) THEN 0 WHEN review_score IN (4, 5) THEN 1 END
         AS binary_label"""

# Timestamps are compared as features, not as output.
_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


@QUERIES.add("order_totals", with_(ITEMS) + TOTALS)
def order_totals(t: Tables):
    return plan.order_totals(t.items)


@QUERIES.add(
    "order_charges",
    """SELECT l_orderkey AS order_id,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS charges,
         CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))), 2) AS DOUBLE)
           AS rounded_charges
       FROM lineitem GROUP BY l_orderkey""",
)
def order_charges(t: Tables):
    """Amounts of four decimals: nothing is rounded before the sum."""
    charge = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")
    return t.raw("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        exact_sum(charge).alias("charges"), rounded_sum(charge).alias("rounded_charges")
    )


@QUERIES.add(
    "order_lines_with_totals",
    with_(ITEMS, f"totals AS ({TOTALS})")
    + """SELECT order_id, order_item_id, product_id, price, shipping_cost,
           total_price_of_order, total_shipping_of_order FROM items JOIN totals USING (order_id)""",
)
def order_lines_with_totals(t: Tables):
    return with_group_stats(
        t.items,
        "order_id",
        {
            "total_price_of_order": rounded_sum(F.col("price")),
            "total_shipping_of_order": rounded_sum(F.col("shipping_cost")),
        },
    )


@QUERIES.add(
    "order_item_counts",
    with_(ITEMS)
    + """SELECT order_id, order_item_id, product_id, price,
           count(order_item_id) OVER (PARTITION BY order_id) AS total_items_in_order FROM items""",
)
def order_item_counts(t: Tables):
    lines = t.items.select("order_id", "order_item_id", "product_id", "price")
    return with_group_count(lines, "order_id", "order_item_id", "total_items_in_order")


@QUERIES.add(
    "items_with_products",
    with_(ITEMS, PRODUCTS)
    + """SELECT order_id, order_item_id, product_id, price, product_category_name,
           product_weight_g FROM items LEFT JOIN products USING (product_id)""",
)
def items_with_products(t: Tables):
    return t.items.join(t.products, "product_id", "left").select(
        "order_id", "order_item_id", "product_id", "price", "product_category_name", "product_weight_g"
    )


@QUERIES.add("item_features", with_(ITEMS, PRODUCTS, ITEM_FEATURES) + "SELECT * FROM item_features")
def item_features(t: Tables):
    return plan.item_features(t.items, t.products)


@QUERIES.add("payment_features", with_(PAYMENTS, PAYMENT_FEATURES) + "SELECT * FROM payment_features")
def payment_features(t: Tables):
    return plan.payment_features(t.payments)


@QUERIES.add("delivery_features", with_(ORDERS, DELIVERY_FEATURES) + "SELECT * FROM delivery_features")
def delivery_features(t: Tables):
    return plan.delivery_features(t.orders).drop(*_TIMESTAMPS)


@QUERIES.add("latest_reviews", with_(REVIEWS, LATEST_REVIEWS) + "SELECT * FROM latest_reviews")
def latest_reviews(t: Tables):
    return plan.latest_reviews(t.reviews)


@QUERIES.add(
    "latest_event_per_user",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM events) WHERE rn = 1""",
)
def latest_event_per_user(t: Tables):
    events = t.raw("events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest_per_key(events, "user_id", "ts", ["event_id"]).drop("ts")


@QUERIES.add(
    "review_delay_days",
    with_(REVIEWS)
    + f"""SELECT review_id, {days('review_answer_timestamp', 'review_creation_date')} AS delay,
            CAST(trunc(CAST({seconds('review_creation_date', 'review_answer_timestamp')} AS DOUBLE)
                 / 86400) AS INTEGER) AS whole_days_back
          FROM reviews""",
)
def review_delay_days(t: Tables):
    return t.reviews.select(
        "review_id",
        days_between("review_answer_timestamp", "review_creation_date", -1).alias("delay"),
        whole_days("review_creation_date", "review_answer_timestamp", -1).alias("whole_days_back"),
    )


@QUERIES.add(
    "review_labels",
    with_(REVIEWS) + f"SELECT review_id, review_score, {LABELS} FROM reviews",
)
def review_labels(t: Tables):
    score = F.col("review_score")
    return t.reviews.select(
        "review_id",
        "review_score",
        map_classes(score, plan.MULTICLASS).alias("multiclass_label"),
        map_classes(score, plan.BINARY).alias("binary_label"),
    )


@QUERIES.add(
    "order_basetable",
    with_(
        ITEMS, PRODUCTS, PAYMENTS, ORDERS, REVIEWS,
        ITEM_FEATURES, PAYMENT_FEATURES, DELIVERY_FEATURES, LATEST_REVIEWS,
    )
    + f"""SELECT *, {LABELS} FROM delivery_features JOIN payment_features USING (order_id)
          JOIN item_features USING (order_id) JOIN latest_reviews USING (order_id)""",
)
def order_basetable(t: Tables):
    base = plan.order_basetable(t.orders, t.items, t.products, t.payments, t.reviews)
    return base.drop(*_TIMESTAMPS)


@QUERIES.add("bucketed_basetable", QUERIES["order_basetable"].sql)
def bucketed_basetable(t: Tables):
    """The base table from subjects stored in buckets of the order."""
    path = scratch_path(t.spark, "subjects")
    name = path.rpartition("/")[2].replace("-", "_")
    buckets = plan.buckets_for(t.raw("orders"), t.items, t.payments, t.reviews)
    stored = plan.store_subjects(t.orders, t.items, t.products, t.payments, t.reviews, name, buckets, path)
    return plan.basetable_of_subjects(stored).drop(*_TIMESTAMPS)


@QUERIES.add(
    "holdout_basetable",
    with_(ITEMS, PRODUCTS, PAYMENTS, ORDERS, ITEM_FEATURES, PAYMENT_FEATURES, DELIVERY_FEATURES)
    + """SELECT * FROM delivery_features JOIN payment_features USING (order_id)
         JOIN item_features USING (order_id)""",
)
def holdout_basetable(t: Tables):
    return plan.order_basetable(t.orders, t.items, t.products, t.payments).drop(*_TIMESTAMPS)


@QUERIES.add(
    "holdout_payment_types",
    with_(PAYMENTS, PAYMENT_FEATURES)
    + "SELECT primary_payment_type, count(*) AS n FROM payment_features GROUP BY 1",
)
def holdout_payment_types(t: Tables):
    return value_counts(plan.payment_features(t.payments), "primary_payment_type")
