"""Queries of the donor domain."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from marlstone.catalog.bindings import (
    CAMPAIGN,
    CAMPAIGNS,
    DONORS,
    GIFTS,
    LATER_CAMPAIGN,
    SELECTION,
    Tables,
    with_,
)
from marlstone.catalog.registry import Registry
from marlstone.operators.grouping import first_per_key
from marlstone.plans import donors as plan

QUERIES = Registry()

_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_LANGUAGES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def history_sql(spec: plan.CampaignSpec) -> str:
    return f"""history AS (
      SELECT gifts.*, campaigns.date AS campaign_date, region, gender, language, dateOfBirth
      FROM gifts JOIN selection USING (donorID) JOIN donors USING (donorID)
           LEFT JOIN campaigns USING (campaignID)
      WHERE gifts.date <= DATE '{spec.history_end}')"""


def _features(spec: plan.CampaignSpec, recent_basis: str) -> str:
    top = (
        "(SELECT max(rank) FROM ranked)"
        if recent_basis == "global"
        else "max(rank) OVER (PARTITION BY donorID)"
    )
    return f"""ranked AS (
  SELECT *, rank() OVER d + (count(*) OVER (PARTITION BY donorID, date) - 1) / 2.0 AS rank,
         date_diff('day', lag(date) OVER (PARTITION BY donorID ORDER BY date, gift_id), date) AS gap,
         row_number() OVER (PARTITION BY donorID ORDER BY date DESC, gift_id DESC) AS from_last,
         date_diff('day', campaign_date, date) AS days_diff
  FROM history WINDOW d AS (PARTITION BY donorID ORDER BY date)),
marked AS (SELECT *, CAST(rank AS DOUBLE) > {top} - 3 AS recent FROM ranked),
sums AS (
  SELECT donorID, count(*) AS frequency, count(amount) AS n,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total,
         sum(CAST(amount AS DECIMAL(18,2))) AS dec_total,
         sum(CAST(CAST(amount AS DECIMAL(18,2)) * CAST(amount AS DECIMAL(18,2)) AS DECIMAL(38,4))) AS squares,
         max(amount) AS max_donations, min(amount) AS min_donations,
         min(date) AS first_date, max(date) AS last_date,
         sum(days_diff) AS s, count(days_diff) AS m,
         avg(CAST(gap AS DOUBLE)) AS mean_gap,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (recent) AS DOUBLE)
           / nullif(count(amount) FILTER (recent), 0) AS recent_mean,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (rank <= 3) AS DOUBLE)
           / nullif(count(amount) FILTER (rank <= 3), 0) AS early_mean,
         count(DISTINCT campaignID) AS campaign_engagement,
         count(amount) FILTER (date >= DATE '{spec.history_end}' - INTERVAL 1 YEAR) AS last_year
  FROM marked GROUP BY donorID),
last_gift AS (SELECT donorID, campaignID, amount, gap, rank FROM ranked WHERE from_last = 1),
usual AS (
  SELECT region FROM history WHERE region IS NOT NULL GROUP BY region ORDER BY count(*) DESC, region LIMIT 1),
people AS (
  SELECT donorID, language, gender,
         CASE WHEN region = 'Missing' THEN (SELECT region FROM usual) ELSE region END AS region,
         CAST(date_part('year', age(DATE '{spec.as_of}', dateOfBirth)) AS INTEGER) AS age
  FROM donors),
features AS (
  SELECT donorID, frequency, total AS monetary_value,
    CAST(date_diff('day', last_date, DATE '{spec.as_of}') AS INTEGER) AS recency,
    total / n AS Avg_donation, n AS total_donations, max_donations, min_donations,
    coalesce(CAST(CASE WHEN 2 * abs(100 * s - m * (100 * s // m)) > m
               OR (2 * abs(100 * s - m * (100 * s // m)) = m AND (100 * s // m) % 2 <> 0)
          THEN 100 * s // m + CASE WHEN s < 0 THEN -1 ELSE 1 END ELSE 100 * s // m END AS DOUBLE) / 100, 0)
      AS avg_daysdiff,
    coalesce(mean_gap, (SELECT median(gap) FROM ranked)) AS avg_timediff,
    CAST(date_diff('day', first_date, last_date) AS INTEGER) AS lifespan_days,
    coalesce(recent_mean / nullif(early_mean, 0), 0) AS donation_trend,
    CASE WHEN n > 1 THEN sqrt(greatest(CAST(CAST(n AS DECIMAL(12,0)) * squares - dec_total * dec_total
      AS DOUBLE), 0) / (CAST(n AS DOUBLE) * (CAST(n AS DOUBLE) - 1))) ELSE 0 END AS donation_variability,
    coalesce(mean_gap, 0) AS donation_density, campaign_engagement,
    CAST(last_year AS DOUBLE) / n AS recent_donations_ratio,
    CAST(campaign_engagement AS DOUBLE) / (SELECT count(DISTINCT campaignID) FROM history) AS donor_loyalty,
    last_gift.campaignID AS campaignID, last_gift.amount AS amount,
    CAST(last_gift.rank AS DOUBLE) AS donation_rank,
    CAST(coalesce(last_gift.gap, 0) AS INTEGER) AS days_between
  FROM sums JOIN last_gift USING (donorID))"""


def _flag(condition: str) -> str:
    return f"CAST(coalesce({condition}, FALSE) AS INTEGER)"


def _people_columns() -> str:
    """Age, dummies, age groups and interactions, spelled out for the given levels."""
    regions = {f"fl_region_is_{x}": _flag(f"region = '{x}'") for x in _SEGMENTS[1:]}
    gender = {"fl_gender_is_M": _flag("gender = 'M'")}
    languages = {
        f"fl_language_is_{x.replace(' ', '_')}": _flag(f"language = '{x}'") for x in _LANGUAGES
    }
    edges = plan.AGE_EDGES
    groups = {
        f"age_group_{name.replace('-', '_').replace('+', '')}": _flag(f"age > {low} AND age <= {high}")
        for low, high, name in zip(edges[:-1], edges[1:], plan.AGE_LABELS, strict=True)
    }
    crossed = {}
    later_languages = dict(list(languages.items())[1:])
    for name, value in (gender | regions | later_languages).items():
        crossed[f"age_{name}"] = f"age * {value}"
    for name, value in (regions | later_languages).items():
        crossed[f"gender_M_{name}"] = f"{gender['fl_gender_is_M']} * {value}"
    columns = {"Age": "age"} | regions | gender | languages | groups | crossed
    return ", ".join(f"{value} AS {name}" for name, value in columns.items())


def _rfm_sql(spec: plan.CampaignSpec, recent_basis: str = "global") -> str:
    return (
        with_(GIFTS, DONORS, SELECTION, CAMPAIGNS, history_sql(spec), _features(spec, recent_basis))
        + f"SELECT features.*, {_people_columns()} FROM features JOIN people USING (donorID)"
    )


def _target(spec: plan.CampaignSpec) -> str:
    return f"""target AS (
  SELECT donorID, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS target_amount,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) >= {spec.threshold} AS INTEGER) AS target
  FROM gifts JOIN selection USING (donorID)
  WHERE date BETWEEN DATE '{spec.target_start}' AND DATE '{spec.target_end}' GROUP BY donorID)"""


def donor_levels() -> plan.Levels:
    return plan.Levels(region=_SEGMENTS, gender=("F", "M"), language=_LANGUAGES)


def _inputs(t: Tables):
    return t.gifts, t.selection, t.donors, t.campaigns


# The four ratios of sums agree up to the last bits of a division; rounded on
# both sides where the two forms of the mean gap differ.
_ROUNDED = ("avg_timediff", "donation_density", "donation_variability")


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in _ROUNDED})


def _rounded_sql(sql: str, names=_ROUNDED) -> str:
    replaced = ", ".join(f"round({c}, 4) AS {c}" for c in names)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


@QUERIES.add("rfm_features", _rounded_sql(_rfm_sql(CAMPAIGN)))
def rfm_features(t: Tables):
    return _rounded(plan.rfm_features(*_inputs(t), CAMPAIGN, donor_levels()))


@QUERIES.add("rfm_features_own_rank", _rounded_sql(_rfm_sql(LATER_CAMPAIGN, "per_key")))
def rfm_features_own_rank(t: Tables):
    table = plan.rfm_features(*_inputs(t), LATER_CAMPAIGN, donor_levels(), recent_basis="per_key")
    return _rounded(table)


@QUERIES.add(
    "campaign_history",
    with_(GIFTS, DONORS, SELECTION, CAMPAIGNS)
    + """SELECT gift_id, donorID, campaignID, amount, gender, language,
           strftime(campaigns.date, '%Y-%m-%d') AS campaign_day
         FROM gifts JOIN selection USING (donorID) JOIN donors USING (donorID)
              LEFT JOIN campaigns USING (campaignID)""",
)
def campaign_history(t: Tables):
    return plan.campaign_history(*_inputs(t)).select(
        "gift_id", "donorID", "campaignID", "amount", "gender", "language",
        F.date_format("campaign_date", "yyyy-MM-dd").alias("campaign_day"),
    )


@QUERIES.add("campaign_target", with_(GIFTS, SELECTION, _target(CAMPAIGN)) + "SELECT * FROM target")
def campaign_target(t: Tables):
    return plan.campaign_target(t.gifts, t.selection, CAMPAIGN)


@QUERIES.add(
    "campaign_table",
    with_(GIFTS, DONORS, SELECTION, CAMPAIGNS, history_sql(CAMPAIGN), _features(CAMPAIGN, "global"), _target(CAMPAIGN))
    + """SELECT donorID, frequency, monetary_value, recency, donation_trend, coalesce(target, 0) AS target
         FROM features LEFT JOIN target USING (donorID)""",
)
def campaign_table(t: Tables):
    table = plan.campaign_table(*_inputs(t), CAMPAIGN, {"levels": donor_levels()})
    return table.select("donorID", "frequency", "monetary_value", "recency", "donation_trend", "target")


@QUERIES.add(
    "target_balance",
    with_(GIFTS, SELECTION, _target(dataclasses.replace(CAMPAIGN, threshold=200000.0)))
    + "SELECT target, count(*) AS n FROM target GROUP BY target",
)
def target_balance(t: Tables):
    spec = dataclasses.replace(CAMPAIGN, threshold=200000.0)
    target = plan.campaign_target(t.gifts, t.selection, spec)
    return target.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add(
    "donor_attributes",
    with_(
        DONORS,
        f"""people AS (
          SELECT donorID, language, gender,
                 CASE WHEN region = 'Missing' THEN 'MACHINERY' ELSE region END AS region,
                 CAST(date_part('year', age(DATE '{CAMPAIGN.as_of}', dateOfBirth)) AS INTEGER) AS age
          FROM donors)""",
    )
    + f"SELECT donorID, {_people_columns()} FROM people",
)
def donor_attributes(t: Tables):
    return plan.donor_attributes(t.donors, CAMPAIGN, F.lit("MACHINERY"))


@QUERIES.add(
    "first_gift_per_donor",
    with_(GIFTS)
    + """SELECT donorID, gift_id, amount FROM (
           SELECT *, row_number() OVER (PARTITION BY donorID ORDER BY date, gift_id) AS rn FROM gifts)
         WHERE rn = 1""",
)
def first_gift_per_donor(t: Tables):
    gifts = t.gifts.select("donorID", "gift_id", "amount", "date")
    return first_per_key(gifts, "donorID", "date", ["gift_id"]).drop("date")


@QUERIES.add(
    "parsed_gifts",
    """SELECT o_orderkey AS gift_id, o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day
       FROM orders""",
)
def parsed_gifts(t: Tables):
    text = F.replace(F.col("amount").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    raw = t.gifts.withColumns({"amount": text, "date": F.date_format("date", "dd/MM/yyyy")})
    return plan.parse_gifts(raw).select("gift_id", "amount", F.col("date").cast("string").alias("day"))


@QUERIES.add(
    "engagement_estimates",
    with_(GIFTS)
    + """SELECT donorID, count(DISTINCT campaignID) AS campaign_engagement,
           CAST(count(DISTINCT campaignID) AS DOUBLE)
             / (SELECT count(DISTINCT campaignID) FROM gifts) AS donor_loyalty
         FROM gifts GROUP BY donorID""",
)
def engagement_estimates(t: Tables):
    """Sketches of each year, united; so few campaigns are counted exactly."""
    return plan.engagement_estimates(plan.engagement_sketches(t.gifts, F.year("date").alias("year")))
