"""The given tables in the shape of the domain tables.

Each binding exists twice, as a DataFrame and as a SQL common table expression
with the same columns.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.numbers import exact_sum
from marlstone.functions.text import normalize, tokens
from marlstone.plans.donors import CampaignSpec

CAMPAIGN = CampaignSpec(as_of=dt.date(2000, 1, 1), threshold=100000.0)
LATER_CAMPAIGN = CampaignSpec(as_of=dt.date(2000, 9, 1), threshold=100000.0)

# Keyword groups that occur in the given texts.
CORPUS_ASPECTS = {
    "people": ["erson", "ouou", "hand"],
    "process": ["tion", "ment", "ing"],
    "quality": ["bleed", "lyer", "est in"],
    "trade": ["land", "oil", "gas", "evil"],
}


class Tables:
    """Lazy access to the tables below one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- orders ----------------------------------------------------------------

    @cached_property
    def items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        tax = F.col("l_tax").cast("decimal(4,2)")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("price"),
            (price * tax).cast("double").alias("shipping_cost"),
        )

    @cached_property
    def products(self) -> DataFrame:
        size, name = F.col("p_size"), F.length("p_name")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 17 != 0, F.col("p_type")).alias("product_category_name"),
            (name * 6).alias("product_name_lenght"),
            (name * 50 + size * 5).alias("product_description_lenght"),
            (size % 5 + 1).alias("product_photos_qty"),
            (size * 20).alias("product_weight_g"),
            size.alias("product_length_cm"),
            (size % 10 + 1).alias("product_height_cm"),
            (size % 7 + 1).alias("product_width_cm"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.when(flag == "R", "voucher").when(flag == "A", "credit_card").otherwise("transfer")
            .alias("payment_type"),
            F.col("l_quantity").cast("int").alias("payment_installments"),
            F.col("l_extendedprice").alias("payment_value"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        kind = F.col("event_type")
        score = (
            F.when(kind == "error", 1)
            .when(kind == "view", 2)
            .when(kind == "click", 3)
            .when(kind == "signup", 4)
            .otherwise(5)
        )
        return self.raw("events").select(
            F.col("event_id").alias("review_id"),
            F.expr("event_id div 2").alias("order_id"),
            score.alias("review_score"),
            F.date_trunc("day", "ts").alias("review_creation_date"),
            F.expr("ts + make_dt_interval(cast(event_id % 5 as int))").alias(
                "review_answer_timestamp"
            ),
        )

    @cached_property
    def orders(self) -> DataFrame:
        shipped = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
        )
        def hours(n):
            return f"make_dt_interval(0, cast({n} as int))"

        return self.raw("orders").join(shipped, "o_orderkey", "left").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "delivered").otherwise("shipped")
            .alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.expr(f"o_orderdate + {hours('o_orderkey % 48')}").alias("order_approved_at"),
            F.col("first_ship").alias("order_delivered_carrier_date"),
            F.expr(f"last_ship + {hours('o_orderkey % 24')}").alias("order_delivered_customer_date"),
            F.expr("o_orderdate + interval 30 days").alias("order_estimated_delivery_date"),
        )

    # --- donors ----------------------------------------------------------------

    @cached_property
    def gifts(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("gift_id"),
            F.col("o_custkey").alias("donorID"),
            F.col("o_orderpriority").alias("campaignID"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderdate").alias("date"),
        )

    @cached_property
    def donors(self) -> DataFrame:
        places = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        key = F.col("c_custkey")
        return self.raw("customer").join(
            places, F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            key.alias("donorID"),
            F.when(key % 11 == 0, "Missing").otherwise(F.col("c_mktsegment")).alias("region"),
            F.when(key % 3 == 0, "F").when(key % 3 == 1, "M").alias("gender"),
            F.col("r_name").alias("language"),
            F.date_add(F.lit(dt.date(1920, 1, 15)), (key * 37 % 24000).cast("int")).alias("dateOfBirth"),
        )

    @cached_property
    def selection(self) -> DataFrame:
        return self.raw("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("donorID"))

    @cached_property
    def campaigns(self) -> DataFrame:
        return self.raw("orders").groupBy(F.col("o_orderpriority").alias("campaignID")).agg(
            F.min("o_orderdate").alias("date")
        )

    # --- texts -----------------------------------------------------------------

    @cached_property
    def texts(self) -> DataFrame:
        """Labelled documents with the words left after cleaning."""
        return self.raw("documents").select(
            "doc_id", F.col("source").alias("entity"), "text", "lang",
            normalize(F.col("text")).alias("clean_text"),
        )

    @cached_property
    def lexicon(self) -> DataFrame:
        """Words of the benchmark texts, valued by their length."""
        words = self.raw("benchmark").select(F.explode(tokens(F.lower("text"))).alias("token"))
        valence = (F.length("token") * 7 % 9 - 4).cast("double")
        return words.distinct().select("token", valence.alias("valence"))

    @cached_property
    def lemmas(self) -> DataFrame:
        """Words of the benchmark texts ending in 'tion' or 'ing', without the ending."""
        words = self.raw("benchmark").select(F.explode(tokens(F.lower("text"))).alias("token"))
        ending = "(tion|ing)$"
        return words.distinct().where(F.col("token").rlike(f"[a-z]{ending}")).select(
            "token", F.regexp_replace("token", ending, "").alias("lemma")
        )

    @cached_property
    def news(self) -> DataFrame:
        """Conversations as nested records, one each: parallel label and article arrays."""
        turn = F.struct("turn", "role", "text")
        nested = self.raw("conversations").groupBy("conv_id").agg(
            F.sort_array(F.collect_list(turn)).alias("turns")
        )
        return nested.select(
            "conv_id",
            F.concat(F.lit("company "), (F.col("conv_id") % 7).cast("string")).alias("entity"),
            F.col("turns.role").alias("labels"),
            F.transform("turns", lambda t: F.struct(t["text"].alias("description"))).alias("articles"),
        )

    # --- series, scores --------------------------------------------------------

    @cached_property
    def hourly(self) -> DataFrame:
        """Event values summed per hour and event type."""
        return self.raw("events").groupBy(
            F.col("event_type").alias("series"),
            F.expr("timestampdiff(HOUR, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("hour"),
        ).agg(exact_sum(F.col("value")).alias("value"))

    @cached_property
    def scored(self) -> DataFrame:
        """Orders with a score in (0, 1], a label and a predicted class."""
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            (F.floor("o_totalprice").cast("long") % 997 / 1000 + 0.001).alias("score"),
            ((F.floor("o_totalprice").cast("long") % 997 + F.col("o_custkey") % 800) > 900)
            .cast("int").alias("label"),
            ((F.floor("o_totalprice").cast("long") % 997) > 600).cast("int").alias("prediction"),
            F.col("o_custkey").alias("custkey"),
        )


# --- the same bindings in SQL --------------------------------------------------

ITEMS = """items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_extendedprice AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE)
           AS shipping_cost
  FROM lineitem)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 17 <> 0 THEN p_type END AS product_category_name,
         length(p_name) * 6 AS product_name_lenght,
         length(p_name) * 50 + p_size * 5 AS product_description_lenght,
         p_size % 5 + 1 AS product_photos_qty, p_size * 20 AS product_weight_g,
         p_size AS product_length_cm, p_size % 10 + 1 AS product_height_cm,
         p_size % 7 + 1 AS product_width_cm
  FROM part)"""

PAYMENTS = """payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
         CASE l_returnflag WHEN 'R' THEN 'voucher' WHEN 'A' THEN 'credit_card'
              ELSE 'transfer' END AS payment_type,
         CAST(l_quantity AS INTEGER) AS payment_installments, l_extendedprice AS payment_value
  FROM lineitem)"""

REVIEWS = """reviews AS (
  SELECT event_id AS review_id, event_id // 2 AS order_id,
         CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
              WHEN 'signup' THEN 4 ELSE 5 END AS review_score,
         date_trunc('day', ts) AS review_creation_date,
         ts + to_days(CAST(event_id % 5 AS INTEGER)) AS review_answer_timestamp
  FROM events)"""

ORDERS = """shop_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE 'shipped' END AS order_status,
         o_orderdate AS order_purchase_timestamp,
         o_orderdate + to_hours(o_orderkey % 48) AS order_approved_at,
         first_ship AS order_delivered_carrier_date,
         last_ship + to_hours(o_orderkey % 24) AS order_delivered_customer_date,
         o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
  FROM orders LEFT JOIN (
    SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""

GIFTS = """gifts AS (
  SELECT o_orderkey AS gift_id, o_custkey AS donorID, o_orderpriority AS campaignID,
         o_totalprice AS amount, o_orderdate AS date
  FROM orders)"""

DONORS = """donors AS (
  SELECT c_custkey AS donorID,
         CASE WHEN c_custkey % 11 = 0 THEN 'Missing' ELSE c_mktsegment END AS region,
         CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender,
         r_name AS language,
         DATE '1920-01-15' + CAST(c_custkey * 37 % 24000 AS INTEGER) AS dateOfBirth
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

SELECTION = "selection AS (SELECT c_custkey AS donorID FROM customer WHERE c_acctbal > 0)"

CAMPAIGNS = """campaigns AS (
  SELECT o_orderpriority AS campaignID, min(o_orderdate) AS date FROM orders GROUP BY 1)"""

HOURLY = """hourly AS (
  SELECT event_type AS series, epoch_us(ts) // 1000000 // 3600 AS hour,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM events GROUP BY 1, 2)"""

SCORED = """scored AS (
  SELECT o_orderkey AS id,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 997 AS DOUBLE) / 1000 + CAST(0.001 AS DOUBLE) AS score,
         CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 997 + o_custkey % 800 > 900
              THEN 1 ELSE 0 END AS label,
         CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 997 > 600 THEN 1 ELSE 0 END AS prediction,
         o_custkey AS custkey
  FROM orders)"""

NEWS = """news AS (
  SELECT conv_id, 'company ' || CAST(conv_id % 7 AS VARCHAR) AS entity,
         role AS label, text AS description
  FROM conversations)"""


def seconds(later: str, earlier: str) -> str:
    """Difference of two timestamps, each cut to whole seconds."""
    return f"(epoch_us({later}) // 1000000 - epoch_us({earlier}) // 1000000)"


def days(later: str, earlier: str) -> str:
    """Fractional days, two decimals, half away from zero, in whole-number arithmetic."""
    s = seconds(later, earlier)
    return f"(CAST(sign({s}) * ((abs({s}) * 100 + 43200) // 86400) AS DOUBLE) / 100)"


def clean_sql(text: str) -> str:
    """Letters and whitespace, lower case; outer whitespace removed."""
    space = r"\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    letters = f"lower(regexp_replace({text}, '[^a-zA-Z{space}]', '', 'g'))"
    return f"regexp_replace({letters}, '^[{space}]+|[{space}]+$', '', 'g')"


def words_sql(text: str) -> str:
    return f"regexp_extract_all({clean_sql(text)}, '[a-z]+')"


def kept_words_sql(text: str) -> str:
    """Words without stop words, repeats kept."""
    from marlstone.functions.text import ENGLISH_STOP_WORDS

    stops = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)
    return f"list_filter({words_sql(text)}, lambda w: w NOT IN ({stops}))"


def aspects_sql(text: str, aspects: dict, mode: str = "substring") -> str:
    """Comma-joined sorted aspects of a text."""
    pad = "" if mode == "substring" else " "
    hay = text if mode == "substring" else f"' ' || {text} || ' '"
    tags = []
    for aspect in sorted(aspects):
        hit = " OR ".join(f"contains({hay}, '{pad}{k}{pad}')" for k in aspects[aspect])
        tags.append(f"CASE WHEN {hit} THEN '{aspect}' END")
    return f"list_filter([{', '.join(tags)}], lambda x: x IS NOT NULL)"


TEXTS = f"""texts AS (
  SELECT doc_id, source AS entity, text, lang,
         array_to_string({kept_words_sql('text')}, ' ') AS clean_text
  FROM documents)"""

LEXICON = """lexicon AS (
  SELECT token, CAST(length(token) * 7 % 9 - 4 AS DOUBLE) AS valence FROM (
    SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM benchmark))"""

LEMMAS = """lemmas AS (
  SELECT token, regexp_replace(token, '(tion|ing)$', '') AS lemma FROM (
    SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM benchmark)
  WHERE regexp_matches(token, '[a-z](tion|ing)$'))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
