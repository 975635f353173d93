"""Business labels: thresholds and texts, and the expressions that apply them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------------------------
# Thresholds and label texts that results must carry.
# ---------------------------------------------------------------------------------------------------------------

# Above the number -> label; first match wins, then the last text.
REVENUE_TIERS = ((100000, "High"), (50000, "Medium"))
REVENUE_TIER_ELSE = "Low"

PROFIT_TIERS = ((0.3, "High Margin"), (0.15, "Medium Margin"))
PROFIT_TIER_ELSE = "Low Margin"

EFFECTIVENESS_TIERS = ((50, "High Performing"), (25, "Average"))
EFFECTIVENESS_TIER_ELSE = "Underperforming"
EFFECTIVENESS_NO_SPEND = "No Data"

BUDGET_RATINGS = ((0.95, "Optimal"), (0.85, "Good"), (0.70, "Average"))
BUDGET_RATING_ELSE = "Underutilized"
BUDGET_RATING_NO_BUDGET = "No Budget"

# At most this many days since the last order -> label.
RECENCY_SEGMENTS = ((30, "Active"), (90, "At Risk"), (180, "Lapsed"))
RECENCY_ELSE = "Inactive"

# Spend and monthly order frequency that make a customer high or medium value.
HIGH_VALUE = (1000, 0.5)
MEDIUM_VALUE = (500, 0.3)
HIGH_VALUE_LABEL, MEDIUM_VALUE_LABEL, LOW_VALUE_LABEL = "High Value", "Medium Value", "Low Value"

# Lower age below, upper age below -> label (the labels do not match the limits; kept as they are).
AGE_RANGES = ((18, 25, "Under 25"), (25, 35, "25-34"), (35, 45, "35-44"), (45, 55, "45-54"))
AGE_OLDEST = (55, "55+")
AGE_ELSE = "All Ages"

# Stock against reorder level.
REORDER, LOW_STOCK, OVERSTOCKED, ADEQUATE = "Reorder", "Low Stock", "Overstocked", "Adequate"
LOW_STOCK_FACTOR, OVERSTOCK_FACTOR = 1.5, 5

# Days of supply below the number -> label.
VELOCITIES = ((15, "Fast Moving"), (45, "Medium Moving"))
VELOCITY_NONE, VELOCITY_ELSE = "No Movement", "Slow Moving"

# Use of budget and value per unit of spend that trigger each recommendation.
BUDGET_FULL, BUDGET_LOOSE, VALUE_GOOD, VALUE_POOR = 0.95, 0.70, 2, 1
RAISE, LOWER, REWORK, KEEP = "Increase Budget", "Decrease Budget", "Optimize Campaign", "Maintain Budget"

STATUS_DESCRIPTIONS = {
    "ACTIVE": "Currently running",
    "PAUSED": "Temporarily paused",
    "COMPLETED": "Campaign has ended",
    "ARCHIVED": "Archived and not running",
    "DELETED": "Deleted from the system",
}
STATUS_ELSE = "Other status"

# Weights of click rate, conversion rate and return on spend.
EFFECTIVENESS_WEIGHTS = (0.2, 0.3, 0.5)
TARGETING_WEIGHTS = (30, 30, 40)

SOURCE_SYSTEM = "RAW_DATA"

# ---------------------------------------------------------------------------------------------------------------


def first_match(cases: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """The value of the first condition that holds; an unknown (NULL) condition does not hold."""
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def above(value: Column, steps: Iterable[tuple[float, str]], otherwise: str) -> Column:
    return first_match([(value > limit, label) for limit, label in steps], otherwise)


def age_range(low: str = "targeting_age_min", high: str = "targeting_age_max") -> Column:
    low_age, high_age = F.col(low), F.col(high)
    cases = [((low_age < a) & (high_age < b), label) for a, b, label in AGE_RANGES]
    return first_match([*cases, (low_age >= AGE_OLDEST[0], AGE_OLDEST[1])], AGE_ELSE)


def status_description(status: str = "status") -> Column:
    return first_match([(F.col(status) == code, text) for code, text in STATUS_DESCRIPTIONS.items()], STATUS_ELSE)


def value_segment(spend: Column, frequency: Column, high=HIGH_VALUE, medium=MEDIUM_VALUE) -> Column:
    return first_match(
        [
            ((spend > high[0]) & (frequency > high[1]), HIGH_VALUE_LABEL),
            ((spend > medium[0]) | (frequency > medium[1]), MEDIUM_VALUE_LABEL),
        ],
        LOW_VALUE_LABEL,
    )


def recency_segment(days: Column) -> Column:
    return first_match([(days <= limit, label) for limit, label in RECENCY_SEGMENTS], RECENCY_ELSE)


def inventory_status(stock: Column, reorder_level: Column) -> Column:
    return first_match(
        [
            (stock <= reorder_level, REORDER),
            (stock <= reorder_level * F.lit(LOW_STOCK_FACTOR), LOW_STOCK),
            (stock > reorder_level * F.lit(OVERSTOCK_FACTOR), OVERSTOCKED),
        ],
        ADEQUATE,
    )


def inventory_velocity(daily_rate: Column, days_of_supply: Column) -> Column:
    """A product without any sale has no rate at all and counts as slow."""
    return first_match(
        [(daily_rate == 0, VELOCITY_NONE), *[(days_of_supply < limit, label) for limit, label in VELOCITIES]],
        VELOCITY_ELSE,
    )


def budget_rating(use: Column, budget: Column) -> Column:
    return F.when(budget > 0, above(use, BUDGET_RATINGS, BUDGET_RATING_ELSE)).otherwise(BUDGET_RATING_NO_BUDGET)


def budget_recommendation(use: Column, value_per_spend: Column) -> Column:
    full = use > BUDGET_FULL
    return first_match(
        [
            (full & (value_per_spend > VALUE_GOOD), RAISE),
            (use < BUDGET_LOOSE, LOWER),
            (full & (value_per_spend < VALUE_POOR), REWORK),
        ],
        KEEP,
    )
