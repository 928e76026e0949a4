"""Customer rules: tier, category, score, prediction and recommendations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits and texts that results must equal.
VIP_ABOVE = 10000
PREMIUM_ABOVE = 5000
MODERATE_ABOVE = 1000
TOP_VIP_ABOVE = 20000
LOYAL_ORDERS_ABOVE = 5
PREMIUM_MEAN_ABOVE = 1000
LOYALTY_TEXT = "Loyalty reward eligible - 10% discount on next order"
PREMIUM_TEXT = "Premium customer - priority shipping available"
TOP_VIP_TEXT = "Top VIP - personal account manager assigned"


def customer_tier(spent: Column) -> Column:
    return (F.when(spent > VIP_ABOVE, "VIP")
            .when(spent > PREMIUM_ABOVE, "Premium")
            .otherwise("Regular"))


def is_vip(spent: Column) -> Column:
    return spent > VIP_ABOVE


def spending_category(spent: Column) -> Column:
    return (F.when(spent > VIP_ABOVE, "High Spender")
            .when(spent > MODERATE_ABOVE, "Moderate Spender")
            .otherwise("New Customer"))


def loyalty_score(orders: Column, spent: Column) -> Column:
    """Ten points an order plus one per hundred spent, cut (not rounded), at most 100."""
    points = orders * 10 + spent / 100
    return F.least(F.lit(100).cast("decimal(38,6)"), points).cast("bigint")


def predicted_lifetime_value(spent: Column) -> Column:
    return F.round(spent * F.lit("1.5").cast("decimal(2,1)"), 2)


def recommendations(orders: Column, mean: Column, spent: Column) -> Column:
    """The texts that apply, in fixed order."""
    every = F.array(
        F.when(orders > LOYAL_ORDERS_ABOVE, LOYALTY_TEXT),
        F.when(mean > PREMIUM_MEAN_ABOVE, PREMIUM_TEXT),
        F.when(spent > TOP_VIP_ABOVE, TOP_VIP_TEXT))
    return F.array_compact(every)


def vip_filter(vip_flag: Column, spent: Column) -> Column:
    """Flagged as VIP, or spent more than the limit; a missing field counts as no."""
    return (F.coalesce(vip_flag, F.lit(False))
            | (F.coalesce(spent, F.lit(0)) > VIP_ABOVE))
