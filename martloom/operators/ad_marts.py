"""Paid-media marts.

The ad fact is summed by ad first; ad sets and campaigns are then reached from at most one row per ad (and month), and
summed again where the grain is coarser.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import rules
from martloom.functions.measures import (
    mean,
    mean_of_ratio,
    mean_of_units,
    ratio_or_null,
    ratio_or_zero,
    ratio_units,
)
from martloom.operators.common import stamped
from martloom.operators.facts import totals
from martloom.operators.sales_marts import in_calendar

SUMS = ("impressions", "clicks", "spend", "conversions", "conversion_value", "reach")


def ad_parents(ad: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """Key of the ad set and campaign of each ad that has both."""
    return (
        ad.select("ad_key", "adset_key")
        .join(adset.select("adset_key", "campaign_key"), "adset_key")
        .join(campaign.select("campaign_key"), "campaign_key")
    )


def ratios(*names: str) -> list[Column]:
    known = {
        "ctr": ratio_or_zero("clicks", "impressions", 100),
        "cpc": ratio_or_zero("spend", "clicks"),
        "cpm": ratio_or_zero("spend", "impressions", 1000),
        "cost_per_conversion": ratio_or_zero("spend", "conversions"),
        "roas": ratio_or_zero("conversion_value", "spend"),
        "conversion_rate": ratio_or_zero("conversions", "clicks", 100),
    }
    return [known[name].alias(name) for name in names]


def weighted_rates(weights) -> Column:
    """Click rate, conversion rate and return on spend as fractions, each times its weight."""
    click, conversion, value = (F.lit(float(w)) for w in weights)
    return (
        ratio_or_zero("clicks", "impressions") * click
        + ratio_or_zero("conversions", "clicks") * conversion
        + ratio_or_zero("conversion_value", "spend") * value
    )


# ---- ad effectiveness -------------------------------------------------------------------------------------------


def ad_metrics(performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """Lifetime sums per ad, with names of ad, ad set and campaign."""
    return (
        performance.groupBy("ad_key")
        .agg(*totals(*SUMS))
        .join(ad.select(*"ad_key ad_id ad_name ad_type creative_headline destination_url adset_key".split()), "ad_key")
        .join(adset.select("adset_key", "ad_set_name", "targeting_gender", "campaign_key"), "adset_key")
        .join(campaign.select("campaign_key", "campaign_name", "objective"), "campaign_key")
        .select(
            *"ad_key ad_id ad_name ad_type creative_headline destination_url".split(),
            *"adset_key ad_set_name targeting_gender campaign_key campaign_name objective".split(),
            *SUMS,
        )
    )


def ad_effectiveness(
    performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    spent = F.col("spend") > 0
    score = F.when(spent, weighted_rates(rules.EFFECTIVENESS_WEIGHTS) * F.lit(100.0)).otherwise(0.0)
    tier = rules.above(F.col("effectiveness_score"), rules.EFFECTIVENESS_TIERS, rules.EFFECTIVENESS_TIER_ELSE)
    out = ad_metrics(performance, ad, adset, campaign).select(
        "*",
        *ratios("ctr", "cpc", "cpm", "cost_per_conversion", "roas", "conversion_rate"),
        score.alias("effectiveness_score"),
    )
    out = out.withColumn("effectiveness_tier", F.when(spent, tier).otherwise(rules.EFFECTIVENESS_NO_SPEND))
    return stamped(out, run_ts, "analysis_date")


# ---- targeting analysis -----------------------------------------------------------------------------------------


def targeting_metrics(performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """Lifetime sums per ad set, with its targeting and campaign."""
    by_ad = performance.groupBy("ad_key").agg(*totals(*SUMS))
    by_ad_set = by_ad.join(ad.select("ad_key", "adset_key"), "ad_key").groupBy("adset_key").agg(*totals(*SUMS))
    targeting = "targeting_age_min targeting_age_max targeting_gender targeting_locations targeting_interests".split()
    return (
        by_ad_set.join(adset.select("adset_key", "ad_set_id", "ad_set_name", *targeting, "campaign_key"), "adset_key")
        .join(campaign.select("campaign_key", "campaign_name", "objective"), "campaign_key")
        .select(
            "adset_key", "ad_set_id", "ad_set_name", *targeting, "campaign_key", "campaign_name", "objective", *SUMS
        )
    )


def targeting_by_age(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(rules.age_range().alias("age_range")).agg(*totals(*SUMS))


def targeting_by_gender(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("targeting_gender").agg(*totals(*SUMS))


def targeting_by_interest(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("targeting_interests").agg(*totals(*SUMS))


def targeting_analysis(
    performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """Ad sets against all ad sets of the same gender, age range and interests (100 = average).

    Groups are summed and joined back rather than windowed over: one gender may hold most ad sets.
    """
    metrics = targeting_metrics(performance, ad, adset, campaign).withColumn("age_range", rules.age_range())

    def group_sums(by: str, prefix: str) -> DataFrame:
        return metrics.groupBy(by).agg(
            F.sum("spend").alias(f"{prefix}_spend"), F.sum("conversion_value").alias(f"{prefix}_value")
        )

    def index(present: str, prefix: str) -> Column:
        own, group = ratio_or_null("conversion_value", "spend"), ratio_or_null(f"{prefix}_value", f"{prefix}_spend")
        comparable = F.col(present).isNotNull() & (F.col(f"{prefix}_spend") > 0) & (F.col("spend") > 0)
        # A group that earned nothing gives no index at all.
        return F.when(comparable, F.try_divide(own, group) * F.lit(100.0)).otherwise(100.0)

    score = F.when(F.col("spend") > 0, weighted_rates(rules.TARGETING_WEIGHTS)).otherwise(0.0)
    out = (
        metrics.join(group_sums("targeting_gender", "gender"), "targeting_gender", "left")
        # At most one row per age label.
        .join(F.broadcast(group_sums("age_range", "age")), "age_range", "left")
        .join(group_sums("targeting_interests", "interest"), "targeting_interests", "left")
        .select(
            *"adset_key ad_set_id ad_set_name targeting_age_min targeting_age_max age_range".split(),
            *"targeting_gender targeting_locations targeting_interests campaign_key campaign_name objective".split(),
            *SUMS,
            *ratios("ctr", "cpc", "cpm", "cost_per_conversion", "roas"),
            index("targeting_gender", "gender").alias("gender_roas_index"),
            index("targeting_age_min", "age").alias("age_roas_index"),
            index("targeting_interests", "interest").alias("interest_roas_index"),
            score.alias("targeting_effectiveness_score"),
        )
    )
    return stamped(out, run_ts, "analysis_date")


# ---- campaign performance ---------------------------------------------------------------------------------------

CAMPAIGN_COLUMNS = (
    "campaign_key campaign_id campaign_name objective status budget_type daily_budget lifetime_budget start_date"
    " end_date"
).split()


def campaign_metrics(
    performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Sums per campaign and month."""
    month = ("year_number", "month_number", "month_name")
    by_ad = in_calendar(performance, "date_key", calendar, *month).groupBy("ad_key", *month).agg(*totals(*SUMS))
    by_campaign = (
        by_ad.join(ad_parents(ad, adset, campaign), "ad_key").groupBy("campaign_key", *month).agg(*totals(*SUMS))
    )
    return by_campaign.join(campaign.select(*CAMPAIGN_COLUMNS), "campaign_key").select(
        *CAMPAIGN_COLUMNS, *month, *SUMS
    )


def campaign_month_spend(spend: DataFrame, campaign: DataFrame, calendar: DataFrame) -> DataFrame:
    """Money spent and budgeted per campaign and month."""
    monthly = in_calendar(spend, "date_key", calendar, "year_number", "month_number").groupBy(
        "campaign_key", "year_number", "month_number"
    ).agg(
        F.sum("amount_spent").cast("decimal(28,2)").alias("total_spend"),
        F.sum("daily_budget").cast("decimal(28,2)").alias("total_budget"),
        mean_of_ratio("budget_utilization_percentage").alias("avg_budget_utilization"),
    )
    return monthly.join(campaign.select("campaign_key"), "campaign_key")


def campaign_performance(
    performance: DataFrame,
    spend: DataFrame,
    ad: DataFrame,
    adset: DataFrame,
    campaign: DataFrame,
    calendar: DataFrame,
    run_ts: datetime | None = None,
) -> DataFrame:
    out = (
        campaign_metrics(performance, ad, adset, campaign, calendar)
        .join(
            campaign_month_spend(spend, campaign, calendar), ["campaign_key", "year_number", "month_number"], "left"
        )
        .select(
            *CAMPAIGN_COLUMNS,
            *"year_number month_number month_name".split(),
            *SUMS,
            *ratios("ctr", "cpc", "cpm", "cost_per_conversion", "roas", "conversion_rate"),
            *"total_spend total_budget avg_budget_utilization".split(),
        )
    )
    return stamped(out, run_ts, "analysis_date")


# ---- budget utilization -----------------------------------------------------------------------------------------

DAY_COLUMNS = ("full_date", "day_of_week", "day_name", "month_name")


def budget_daily(spend: DataFrame, campaign: DataFrame, calendar: DataFrame) -> DataFrame:
    """Spend, budget and mean use per campaign and day."""
    daily = in_calendar(spend, "date_key", calendar, *DAY_COLUMNS).groupBy("campaign_key", *DAY_COLUMNS).agg(
        F.sum("amount_spent").cast("decimal(28,2)").alias("daily_amount_spent"),
        F.sum("daily_budget").cast("decimal(28,2)").alias("total_daily_budget"),
        mean_of_ratio("budget_utilization_percentage").alias("avg_budget_utilization"),
    )
    about = "campaign_key campaign_id campaign_name objective budget_type daily_budget lifetime_budget".split()
    return daily.join(campaign.select(*about), "campaign_key").select(
        *about, *DAY_COLUMNS, "daily_amount_spent", "total_daily_budget", "avg_budget_utilization"
    )


def week_start(day: str = "full_date") -> Column:
    return F.trunc(day, "WEEK")


def month_start(day: str = "full_date") -> Column:
    return F.trunc(day, "MONTH")


def money_sum(c: str) -> Column:
    return F.sum(c).cast("decimal(28,2)")


def budget_weekly(daily: DataFrame) -> DataFrame:
    """Daily rows per campaign and week (from Monday). The mean is over days, not weighted by spend."""
    return daily.groupBy("campaign_key", "campaign_id", "campaign_name", week_start().alias("week_start_date")).agg(
        money_sum("daily_amount_spent").alias("weekly_amount_spent"),
        money_sum("total_daily_budget").alias("weekly_budget"),
        mean_of_ratio("avg_budget_utilization").alias("weekly_avg_utilization"),
        F.min("avg_budget_utilization").alias("min_daily_utilization"),
        F.max("avg_budget_utilization").alias("max_daily_utilization"),
    )


def budget_monthly(daily: DataFrame) -> DataFrame:
    return daily.groupBy("campaign_key", "campaign_id", "campaign_name", month_start().alias("month_start_date")).agg(
        money_sum("daily_amount_spent").alias("monthly_amount_spent"),
        money_sum("total_daily_budget").alias("monthly_budget"),
        mean_of_ratio("avg_budget_utilization").alias("monthly_avg_utilization"),
    )


def budget_weekday(daily: DataFrame) -> DataFrame:
    return daily.groupBy("campaign_key", "day_of_week", "day_name").agg(
        mean("daily_amount_spent").alias("avg_daily_spend"),
        mean_of_ratio("avg_budget_utilization").alias("avg_utilization"),
    )


def campaign_conversions(performance: DataFrame, ad: DataFrame, adset: DataFrame, campaign: DataFrame) -> DataFrame:
    """Lifetime conversions, their value and spend per campaign."""
    sums = ("conversions", "conversion_value", "spend")
    by_ad = performance.groupBy("ad_key").agg(*totals(*sums))
    by_campaign = by_ad.join(ad_parents(ad, adset, campaign), "ad_key").groupBy("campaign_key").agg(*totals(*sums))
    return by_campaign.select(
        "campaign_key",
        F.col("conversions").alias("total_conversions"),
        F.col("conversion_value").alias("total_conversion_value"),
        F.col("spend").alias("total_performance_spend"),
    )


def budget_utilization(
    spend: DataFrame,
    performance: DataFrame,
    ad: DataFrame,
    adset: DataFrame,
    campaign: DataFrame,
    calendar: DataFrame,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Days of a campaign next to their week, month and weekday, with a rating and a recommendation.

    The three roll-ups are windows over the daily rows: these are shuffled once, by campaign, instead of being built
    four times and joined. A campaign has one row per day, so the largest window is the length of the calendar.
    """
    daily = (
        budget_daily(spend, campaign, calendar)
        .withColumns({"week_start_date": week_start(), "month_start_date": month_start()})
        .repartition("campaign_key")
    )
    spent, budget, use = F.col("daily_amount_spent"), F.col("total_daily_budget"), F.col("avg_budget_utilization")
    week = Window.partitionBy("campaign_key", "week_start_date")
    month = Window.partitionBy("campaign_key", "month_start_date")
    weekday = Window.partitionBy("campaign_key", "day_of_week", "day_name")

    def money(value: Column, window) -> Column:
        return F.sum(value).over(window).cast("decimal(28,2)")

    def average_use(window) -> Column:
        return mean_of_units(F.sum(ratio_units(use)).over(window), F.count(use).over(window))

    average_spent = F.try_divide(
        F.sum(spent).over(weekday).cast("double"), F.count(spent).over(weekday).cast("double")
    )
    rolled = daily.select(
        "*",
        money(spent, week).alias("weekly_amount_spent"),
        money(budget, week).alias("weekly_budget"),
        average_use(week).alias("weekly_avg_utilization"),
        F.min(use).over(week).alias("min_daily_utilization"),
        F.max(use).over(week).alias("max_daily_utilization"),
        money(spent, month).alias("monthly_amount_spent"),
        money(budget, month).alias("monthly_budget"),
        average_use(month).alias("monthly_avg_utilization"),
        average_spent.alias("avg_spend_for_day_of_week"),
        average_use(weekday).alias("avg_utilization_for_day_of_week"),
    )
    # The conversions are those of the campaign's whole life, set against the spend of one day.
    lifetime = campaign_conversions(performance, ad, adset, campaign).drop("total_performance_spend")
    share, value = ratio_or_null(spent, budget), ratio_or_null("total_conversion_value", spent)
    out = rolled.join(lifetime, "campaign_key", "left").select(
        *"campaign_key campaign_id campaign_name objective budget_type daily_budget lifetime_budget".split(),
        *DAY_COLUMNS,
        *"daily_amount_spent total_daily_budget avg_budget_utilization".split(),
        *"week_start_date weekly_amount_spent weekly_budget weekly_avg_utilization".split(),
        *"min_daily_utilization max_daily_utilization".split(),
        *"month_start_date monthly_amount_spent monthly_budget monthly_avg_utilization".split(),
        *"avg_spend_for_day_of_week avg_utilization_for_day_of_week".split(),
        *"total_conversions total_conversion_value".split(),
        ratio_or_zero("total_conversions", spent).alias("conversions_per_spend_dollar"),
        ratio_or_zero("total_conversion_value", spent).alias("value_per_spend_dollar"),
        rules.budget_rating(share, budget).alias("budget_efficiency_rating"),
        rules.budget_recommendation(share, value).alias("budget_recommendation"),
    )
    return stamped(out, run_ts, "analysis_date")
