"""Donor features strictly as of a campaign date, and the campaign target.

One ``CampaignSpec`` drives history window, features and target window, so a
training, test and validation table differ in nothing but the spec.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions.dates import age_years, parse_dmy
from marlstone.functions.numbers import (
    cut,
    exact,
    exact_square,
    exact_sum,
    interactions,
    parse_decimal_comma,
    stddev_from_sums,
)
from marlstone.operators.clean import between_dates, fill_constants, history_as_of
from marlstone.operators.scaling import dummy_columns, dummy_name, learn_levels
from marlstone.session import stable

# --- fixed values: age groups --------------------------------------------------
AGE_EDGES = [18, 30, 40, 50, 60, 100]
AGE_LABELS = ["18-29", "30-39", "40-49", "50-59", "60+"]


@dataclass(frozen=True)
class CampaignSpec:
    """Dates and threshold of one campaign."""

    as_of: dt.date
    history_gap_days: int = 30
    target_days: int = 30
    threshold: float = 10.0

    @property
    def history_end(self) -> dt.date:
        return self.as_of - dt.timedelta(days=self.history_gap_days)

    @property
    def target_start(self) -> dt.date:
        return self.as_of + dt.timedelta(days=1)

    @property
    def target_end(self) -> dt.date:
        return self.as_of + dt.timedelta(days=self.target_days)


@dataclass(frozen=True)
class Levels:
    """Category levels learned on the training donors and reused elsewhere."""

    region: Sequence[str] = field(default_factory=tuple)
    gender: Sequence[str] = field(default_factory=tuple)
    language: Sequence[str] = field(default_factory=tuple)

    @classmethod
    def learn(cls, donors: DataFrame) -> Levels:
        known = donors.where(F.col("region") != "Missing")
        return cls(
            region=tuple(learn_levels(known, "region")),
            gender=tuple(learn_levels(donors, "gender")),
            language=tuple(learn_levels(donors, "language")),
        )


def parse_gifts(gifts: DataFrame) -> DataFrame:
    """Text amounts (decimal comma) and day/month/year dates; null where unreadable."""
    return gifts.withColumns(
        {"amount": parse_decimal_comma(F.col("amount")), "date": parse_dmy(F.col("date"))}
    )


def campaign_history(
    gifts: DataFrame, selection: DataFrame, donors: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """Gifts of selected donors with donor and campaign columns, a row per gift."""
    dated = campaigns.select("campaignID", F.col("date").alias("campaign_date"))
    return (
        gifts.join(selection.select("donorID"), "donorID", "left_semi")
        .join(donors, "donorID")
        .join(dated, "campaignID", "left")
    )


def _donor_days(gifts: DataFrame, spec: CampaignSpec) -> DataFrame:
    """History collapsed to one line per donor, day and campaign (money as exact decimals).

    However many gifts a donor has, this leaves at most (days x campaigns)
    lines for them, so everything after it may work donor by donor.
    """
    history = history_as_of(gifts, "date", spec.history_end)
    amount = F.col("amount")
    return history.groupBy("donorID", F.to_date("date").alias("date"), "campaignID").agg(
        F.count(F.lit(1)).alias("gifts"),
        F.count(amount).alias("amounts"),
        F.sum(exact(amount)).alias("total"),
        F.sum(exact_square(amount)).alias("squares"),
        F.max(amount).alias("largest"),
        F.min(amount).alias("smallest"),
        F.max_by(amount, "gift_id").alias("last_amount"),
        F.max("gift_id").alias("last_gift"),
    )


def _placed_days(days: DataFrame) -> DataFrame:
    """Average rank of each day within its donor, and the gap to the day before."""
    donor = Window.partitionBy("donorID")
    # Equal days share a frame, so the running count includes the whole day.
    upto = donor.orderBy("date").rangeBetween(Window.unboundedPreceding, 0)
    same_day = Window.partitionBy("donorID", "date")
    line = donor.orderBy("date", "campaignID")
    previous = F.lag("date").over(line)
    on_day = F.sum("gifts").over(same_day)
    return days.withColumns(
        {
            "avg_rank": F.sum("gifts").over(upto) - (on_day - 1) / 2,
            "on_day": on_day,
            # Null on a donor's first day; 0 for a further campaign on the same day.
            "gap": F.datediff("date", previous),
        }
    )


def _median_gap(placed: DataFrame) -> DataFrame:
    """One row: median days between neighbouring gifts over all donors.

    Gifts beyond the first on a line are gaps of 0. Gap lengths are whole days,
    so the frequency table is small whatever the number of gifts.
    """
    steps = placed.select(
        F.explode(
            F.array(
                F.struct(F.col("gap").alias("gap"), F.lit(1).cast("long").alias("n")),
                F.struct(F.lit(0).alias("gap"), (F.col("gifts") - 1).alias("n")),
            )
        ).alias("s")
    ).select("s.*")
    table = steps.where(F.col("gap").isNotNull() & (F.col("n") > 0)).groupBy("gap").agg(F.sum("n").alias("n"))
    return table.agg(F.expr("percentile(gap, 0.5, n)").alias("median_gap"))


def rfm_features(
    gifts: DataFrame,
    selection: DataFrame,
    donors: DataFrame,
    campaigns: DataFrame,
    spec: CampaignSpec,
    levels: Levels | None = None,
    recent_basis: str = "global",
) -> DataFrame:
    """One row per selected donor with a gift up to the end of the history.

    ``gifts``: gift_id (unique, orderable), donorID, campaignID, amount, date.
    Row-level columns (amount, campaignID, days_between, donation_rank) are
    those of the latest gift. ``recent_basis`` decides which gifts are recent
    in the trend: rank within 3 of the greatest rank of any donor (``global``)
    or of the donor itself (``per_key``). Nulls become 0 at the end.
    """
    if recent_basis not in ("global", "per_key"):
        raise ValueError(f"unknown recent_basis: {recent_basis!r}")
    wanted = donors.join(selection.select("donorID"), "donorID", "left_semi")
    ids = wanted.select("donorID")
    # The list meets the collapsed history, so no donor is too large for the join.
    days = _donor_days(gifts, spec).join(ids, "donorID", "left_semi")
    dated = campaigns.select("campaignID", F.to_date("date").alias("campaign_date"))
    # Stored: the scalars below and the features read the same collapsed table,
    # and the gifts are scanned once.
    placed = stable(_placed_days(days).join(dated, "campaignID", "left"))

    overall = placed.agg(
        F.max("avg_rank").alias("top_rank"), F.countDistinct("campaignID").alias("campaigns")
    )
    year_ago = F.add_months(F.lit(spec.history_end), -12)
    as_of = F.lit(spec.as_of)
    rank, date = F.col("avg_rank"), F.col("date")
    top_rank = (
        overall.select("top_rank").scalar()
        if recent_basis == "global"
        else F.max("avg_rank").over(Window.partitionBy("donorID"))
    )
    placed = placed.withColumn("is_recent", rank > top_rank - 3)

    def mean_amount(condition):
        total = F.sum(F.when(condition, F.col("total"))).cast("double")
        return F.try_divide(total, F.sum(F.when(condition, F.col("amounts"))))

    n, gift_count = F.sum("amounts"), F.sum("gifts")
    total = F.sum("total").cast("double")
    lag = F.datediff("date", "campaign_date")
    lagged = F.when(lag.isNotNull(), F.col("gifts"))
    last = F.max(
        F.struct(
            "date", "last_gift", "campaignID", "on_day", "gap",
            F.col("last_amount").alias("amount"), "avg_rank",
        )
    )
    grouped = placed.groupBy("donorID").agg(
        gift_count.alias("frequency"),
        total.alias("monetary_value"),
        F.datediff(as_of, F.max("date")).alias("recency"),
        F.try_divide(total, n).alias("Avg_donation"),
        n.alias("total_donations"),
        F.max("largest").alias("max_donations"),
        F.min("smallest").alias("min_donations"),
        F.bround(F.sum(lag * F.col("gifts")) / F.sum(lagged), 2).alias("avg_daysdiff"),
        # Gaps add up to the lifespan, so their mean needs no row-by-row gap.
        F.try_divide(F.datediff(F.max("date"), F.min("date")), gift_count - 1).alias("_mean_gap"),
        F.datediff(F.max("date"), F.min("date")).alias("lifespan_days"),
        F.try_divide(mean_amount(F.col("is_recent")), mean_amount(rank <= 3)).alias("donation_trend"),
        stddev_from_sums(n, F.sum("total"), F.sum("squares")).alias("donation_variability"),
        F.countDistinct("campaignID").alias("campaign_engagement"),
        F.try_divide(F.sum(F.when(date >= year_ago, F.col("amounts"))), n).alias("recent_donations_ratio"),
        last.alias("_last"),
    )
    features = grouped.select(
        "*",
        F.col("_last.campaignID").alias("campaignID"),
        F.col("_last.amount").alias("amount"),
        F.col("_last.avg_rank").alias("donation_rank"),
        # With other gifts on its day, the latest gift follows one of them.
        F.when(F.col("_last.on_day") > 1, 0).otherwise(F.col("_last.gap")).alias("days_between"),
        F.coalesce("_mean_gap", _median_gap(placed).scalar()).alias("avg_timediff"),
        F.col("_mean_gap").alias("donation_density"),
        F.try_divide(F.col("campaign_engagement"), overall.select("campaigns").scalar()).alias("donor_loyalty"),
    ).drop("_last", "_mean_gap")
    # The region of most gifts (not of most donors) stands in for 'Missing'.
    regions = wanted.join(grouped.select("donorID", "frequency"), "donorID")
    by_region = regions.groupBy("region").agg(F.sum("frequency").alias("n"))
    usual = by_region.where(F.col("region").isNotNull()).orderBy(F.desc("n"), "region")
    usual_region = usual.select("region").limit(1).scalar()
    attributes = donor_attributes(wanted, spec, usual_region, levels)
    return fill_constants(features.join(attributes, "donorID"), 0)


def donor_attributes(
    donors: DataFrame, spec: CampaignSpec, usual_region: Column, levels: Levels | None = None
) -> DataFrame:
    """donorID, age, category dummies, age groups and interactions per donor.

    Region 'Missing' becomes the usual region. Region and gender lose their
    first level, language keeps all.
    """
    levels = levels or Levels.learn(donors)
    missing = F.col("region") == "Missing"
    filled = donors.withColumn("region", F.when(missing, usual_region).otherwise(F.col("region")))
    age = age_years(F.to_date("dateOfBirth"), F.lit(spec.as_of))
    region = dummy_columns(F.col("region"), "fl_region_is", levels.region, True)
    gender = dummy_columns(F.col("gender"), "fl_gender_is", levels.gender, True)
    language = dummy_columns(F.col("language"), "fl_language_is", levels.language, False)
    group = dummy_columns(cut(F.col("Age"), AGE_EDGES, AGE_LABELS), "age_group", AGE_LABELS, False)
    table = filled.select("donorID", age.alias("Age"), "region", "gender", "language")
    table = table.withColumns(region | gender | language).drop("region", "gender", "language")
    return table.withColumns(group).withColumns(interactions(interaction_pairs(levels)))


def interaction_pairs(levels: Levels) -> dict[str, tuple[str, str]]:
    """Age x gender, age x region, age x language, gender x region, gender x language.

    Products use the dummies in the table; of the languages all but the first
    take part.
    """
    gender = [dummy_name("fl_gender_is", x) for x in levels.gender[1:]]
    region = [dummy_name("fl_region_is", x) for x in levels.region[1:]]
    language = [dummy_name("fl_language_is", x) for x in levels.language[1:]]
    pairs = {}
    for dummy in gender + region + language:
        pairs[f"age_{dummy}"] = ("Age", dummy)
    for g in gender:
        for dummy in region + language:
            pairs[f"{g.replace('fl_', '').replace('_is', '')}_{dummy}"] = (g, dummy)
    return pairs


#: Columns of ``rfm_features`` beside the donor attributes that a model may see.
def engagement_sketches(gifts: DataFrame, *by: Column, lg_size: int = 12) -> DataFrame:
    """(donorID, by, engagement): a mergeable sketch of each donor's campaigns.

    One per donor and value of ``by``, such as the year or the campaign that the gifts
    are selected for, so that later windows unite what is stored instead of reading the
    gifts again. Null campaigns don't count. The relative error is 1.04 / sqrt(2 ** lg_size)
    at one standard deviation; a few hundred campaigns are counted exactly.
    """
    sketch = F.hll_sketch_agg("campaignID", F.lit(lg_size)).alias("engagement")
    return gifts.groupBy("donorID", *by).agg(sketch)


def engagement_estimates(sketches: DataFrame) -> DataFrame:
    """(donorID, campaign_engagement, donor_loyalty) from the union of each donor's sketches.

    Estimates of what ``rfm_features`` counts exactly; loyalty is the share of the
    campaigns in all sketches.
    """
    united = F.hll_sketch_estimate(F.hll_union_agg("engagement"))
    overall = sketches.agg(united).scalar()
    own = sketches.groupBy("donorID").agg(united.alias("campaign_engagement"))
    return own.withColumn("donor_loyalty", F.try_divide("campaign_engagement", overall))


RFM_COLUMNS = (
    "frequency", "monetary_value", "recency", "Avg_donation", "total_donations", "max_donations",
    "min_donations", "avg_daysdiff", "lifespan_days", "donation_trend", "donation_variability",
    "campaign_engagement", "recent_donations_ratio", "amount", "donation_rank", "days_between",
    "avg_timediff", "donation_density", "donor_loyalty",
)


def feature_names(levels: Levels) -> list[str]:
    """All feature columns of a campaign table with the given levels."""
    dummies = [dummy_name("fl_region_is", x) for x in levels.region[1:]]
    dummies += [dummy_name("fl_gender_is", x) for x in levels.gender[1:]]
    dummies += [dummy_name("fl_language_is", x) for x in levels.language]
    groups = [dummy_name("age_group", x) for x in AGE_LABELS]
    return [*RFM_COLUMNS, "Age", *dummies, *groups, *interaction_pairs(levels)]


def campaign_target(gifts: DataFrame, selection: DataFrame, spec: CampaignSpec) -> DataFrame:
    """(donorID, target_amount, target) of selected donors with gifts in the target window."""
    window = between_dates(gifts, "date", spec.target_start, spec.target_end)
    sums = window.groupBy("donorID").agg(exact_sum(F.col("amount")).alias("target_amount"))
    chosen = sums.join(selection.select("donorID"), "donorID", "left_semi")
    reached = F.coalesce(F.col("target_amount") >= spec.threshold, F.lit(False))
    return chosen.withColumn("target", reached.cast("int"))


def attach_target(features: DataFrame, target: DataFrame) -> DataFrame:
    """Features with the target, 0 for donors without a gift in the window."""
    joined = features.join(target.select("donorID", "target"), "donorID", "left")
    return joined.withColumn("target", F.coalesce("target", F.lit(0)))


def campaign_table(
    gifts: DataFrame,
    selection: DataFrame,
    donors: DataFrame,
    campaigns: DataFrame,
    spec: CampaignSpec,
    options: Mapping | None = None,
) -> DataFrame:
    """Features and target of one campaign."""
    features = rfm_features(gifts, selection, donors, campaigns, spec, **(options or {}))
    return attach_target(features, campaign_target(gifts, selection, spec))
