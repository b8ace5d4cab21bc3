"""Order base table: one row per delivered order with delivery, payment, item
and review features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.dates import days_between, whole_days
from marlstone.functions.numbers import bucketize, map_classes, product, rounded_sum
from marlstone.operators.grouping import latest_per_key
from marlstone.sources.files import write_bucketed

# --- fixed values: bucket edges and label classes ------------------------------
DESCRIPTION_SPLITS = [3.0, 350.0, 600.0, 985.0, 4000.0]
NAME_SPLITS = [3.0, 50.0, 100.0]
WEIGHT_SPLITS = [0.0, 300.0, 800.0, 2000.0, 150000.0]
VOLUME_SPLITS = [0.0, 3000.0, 8000.0, 20000.0, 900000.0]
MULTICLASS = {0: (1, 2), 1: (3, 4), 2: (5,)}
BINARY = {0: (1, 2, 3), 1: (4, 5)}

# Columns a model must not see.
NOT_FEATURES = (
    "order_id",
    "customer_id",
    "review_id",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "review_score",
    "review_response_time",
)


def order_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        rounded_sum(F.col("price")).alias("total_price_of_order"),
        rounded_sum(F.col("shipping_cost")).alias("total_shipping_of_order"),
    )


def item_features(items: DataFrame, products: DataFrame, outside: str = "extend") -> DataFrame:
    """Per order: totals over all lines, product features over complete lines.

    Lines without (complete) product data count in the totals only; an order
    with no complete line drops out. One aggregation by order: the totals need
    no pass of their own. The category is that of the first line.
    """
    return line_features(item_lines(items, products), outside)


def item_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with the columns of their product, where there is one."""
    return items.join(products, "product_id", "left")


def line_features(lines: DataFrame, outside: str = "extend") -> DataFrame:
    """``item_features`` of lines that already have their product columns."""
    present = F.lit(True)
    for c in lines.columns:
        present = present & F.col(c).isNotNull()
    lines = lines.withColumn("_complete", present)

    def complete(col):
        return F.when(F.col("_complete"), col)

    volume = product(
        *[F.col(f"product_{side}_cm") for side in ("length", "height", "width")]
    )
    first_line = F.struct("order_item_id", "product_id", "product_category_name")
    grouped = lines.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_items_in_order"),
        rounded_sum(F.col("price")).alias("total_price_of_order"),
        rounded_sum(F.col("shipping_cost")).alias("total_shipping_of_order"),
        F.avg(complete(F.col("product_description_lenght"))).alias("average_product_desc_length"),
        F.avg(complete(F.col("product_name_lenght"))).alias("average_product_name_length"),
        F.sum(complete(F.col("product_weight_g"))).alias("sum_of_all_products_weight"),
        F.sum(complete(F.col("product_photos_qty"))).alias("total_photos_in_order"),
        F.sum(complete(volume)).alias("total_product_volume"),
        F.min(complete(first_line))["product_category_name"].alias("category"),
    )
    buckets = {
        "Buckets_descr": ("average_product_desc_length", DESCRIPTION_SPLITS),
        "Buckets_name": ("average_product_name_length", NAME_SPLITS),
        "Buckets_weight": ("sum_of_all_products_weight", WEIGHT_SPLITS),
        "Buckets_volume": ("total_product_volume", VOLUME_SPLITS),
    }
    binned = grouped.where(F.col("category").isNotNull()).withColumns(
        {out: bucketize(F.col(col), splits, outside) for out, (col, splits) in buckets.items()}
    )
    return binned.drop(*[col for col, _ in buckets.values()])


def payment_features(payments: DataFrame) -> DataFrame:
    """Per order, in one aggregation; orders without a first payment drop out."""
    voucher = F.col("payment_type") == "voucher"
    first_type = F.when(F.col("payment_sequential") == 1, F.col("payment_type"))

    def total(condition):
        return F.coalesce(rounded_sum(F.when(condition, F.col("payment_value"))), F.lit(0.0))

    return (
        payments.groupBy("order_id")
        .agg(
            F.max(F.when(voucher, 1).otherwise(0)).alias("if_voucher_used"),
            F.count_if(voucher).alias("voucher_count"),
            F.max("payment_sequential").alias("max_payment_sequential"),
            total(voucher).alias("total_voucher_payment"),
            total(F.col("payment_type") != "voucher").alias("total_non_voucher_payment"),
            F.sum("payment_installments").alias("total_installments"),
            F.min(first_type).alias("primary_payment_type"),
        )
        .where(F.col("primary_payment_type").isNotNull())
    )


def delivery_features(orders: DataFrame) -> DataFrame:
    """Delivered, complete orders with delivery times and flags."""
    bought = F.col("order_purchase_timestamp")
    arrived = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    delivered = orders.where(F.col("order_status") == "delivered").drop("order_status").na.drop()
    return delivered.withColumns(
        {
            "delivery_time": days_between(arrived, bought, -1),
            "delivered_on_time": arrived <= promised,
            "estimated_vs_actual_delay_days": days_between(arrived, promised),
            "delivered_early": arrived < promised,
            "approval_time": days_between("order_approved_at", bought, -1),
            "delay_status": F.unix_timestamp(arrived) > F.unix_timestamp(promised),
        }
    )


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The latest complete review of each order with its response time."""
    complete = reviews.na.drop().withColumn(
        "review_response_time",
        whole_days("review_answer_timestamp", "review_creation_date", -1),
    )
    latest = latest_per_key(complete, "order_id", "review_answer_timestamp", ["review_id"])
    return latest.drop("review_creation_date", "review_answer_timestamp")


def build_basetable(key: str, *subjects: DataFrame) -> DataFrame:
    """Inner join of subject tables with one row per key each."""
    base = subjects[0]
    for subject in subjects[1:]:
        base = base.join(subject, key)
    return base


def with_labels(base: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return base.withColumns(
        {"multiclass_label": map_classes(score, MULTICLASS), "binary_label": map_classes(score, BINARY)}
    )


def order_basetable(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    reviews: DataFrame | None = None,
) -> DataFrame:
    """The base table; without reviews (the holdout form) it has no labels."""
    subjects = [
        delivery_features(orders),
        payment_features(payments),
        item_features(items, products),
    ]
    if reviews is None:
        return build_basetable("order_id", *subjects)
    return with_labels(build_basetable("order_id", *subjects, latest_reviews(reviews)))


#: The subjects of the base table, as ``store_subjects`` names them.
SUBJECTS = ("orders", "lines", "payments", "reviews")


#: Rows of all stored subjects that share a bucket; bounds what one task groups and sorts.
BUCKET_ROWS = 2_000_000


def buckets_for(*tables: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """Number of buckets that holds about ``rows`` rows of all tables in each, whatever their size."""
    return max(least, -(-sum(table.count() for table in tables) // rows))


def store_subjects(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    name: str,
    buckets: int,
    path: str | None = None,
) -> dict[str, DataFrame]:
    """The four subjects as tables ``<name>_<subject>``, bucketed by order.

    Lines take their product columns along, so that nothing after this is joined by
    another key. For base tables that are built more than once from the same orders:
    one shuffle of each subject here saves one in every later run. ``buckets`` should
    follow from the tables' size (``buckets_for``), as a task takes a whole bucket.
    """
    given = dict(zip(SUBJECTS, (orders, item_lines(items, products), payments, reviews), strict=True))
    return {
        subject: write_bucketed(
            df, f"{name}_{subject}", "order_id", buckets, None if path is None else f"{path}/{subject}"
        )
        for subject, df in given.items()
    }


def basetable_of_subjects(subjects: Mapping[str, DataFrame]) -> DataFrame:
    """``order_basetable`` from stored subjects: grouped and joined bucket by bucket."""
    base = build_basetable(
        "order_id",
        delivery_features(subjects["orders"]),
        payment_features(subjects["payments"]),
        line_features(subjects["lines"]),
        latest_reviews(subjects["reviews"]),
    )
    return with_labels(base)


def model_view(base: DataFrame, label: str | None = "binary_label", keep=()) -> DataFrame:
    """Only what a model may see: features, one label (or none) and columns to keep."""
    labels = {"multiclass_label", "binary_label"} - {label}
    return base.drop(*((set(NOT_FEATURES) | labels) - set(keep)))
