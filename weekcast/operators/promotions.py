"""Promotion clean-up: which promotions count, and at what price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.functions.numbers import int_div, round_half_up
from weekcast.operators.keyed import match_null_safe, scalar_of
from weekcast.sources.schemas import PROMOTION_KEY, PROMOTION_MEASURES


def filter_valid_promotions(
    promo: DataFrame, nonzero_price: bool = False, plan_week: str = "row"
) -> DataFrame:
    """Keep promotions whose target week is not before the plan week.

    ``plan_week="row"`` compares with the row's own plan week,
    ``"global_min"`` with the earliest plan week of the whole table.
    """
    if plan_week == "row":
        kept = promo.filter(F.col("targetweek") >= F.col("planweek"))
    elif plan_week == "global_min":
        earliest = scalar_of(promo, F.min(F.col("planweek").cast("int")))
        kept = promo.filter(F.col("targetweek").cast("int") >= earliest)
    else:
        raise ValueError("plan_week must be 'row' or 'global_min'")
    return kept.filter(F.col("map_price") != 0) if nonzero_price else kept


def price_stats(promo: DataFrame) -> DataFrame:
    """Price total, row count and count of zero prices per promotion key."""
    return promo.groupBy(*PROMOTION_KEY).agg(
        F.sum(F.col("map_price").cast("bigint")).alias("sum_price"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("map_price") == 0).alias("zero_count"),
    )


def avg_nonzero_price(promo: DataFrame) -> DataFrame:
    """Whole-number average of the non-zero prices per key; 0 if there is none."""
    average = int_div(F.col("sum_price"), F.col("row_count") - F.col("zero_count"))
    return price_stats(promo).select(
        *PROMOTION_KEY, F.coalesce(average, F.lit(0)).cast("bigint").alias("avg_price")
    )


def refine_prices(promo: DataFrame) -> DataFrame:
    """Give every promotion its key's average price and derive the price columns.

    The averages are aggregated first (one small row per key) and joined back;
    a window over the key would put all rows of a busy key into one task.
    """
    priced = match_null_safe(promo, avg_nonzero_price(promo), PROMOTION_KEY, "left")
    has_price = F.col("avg_price") != 0
    pmap = (F.col("avg_price") - F.col("ir")).cast("double")
    pmap10 = round_half_up(pmap * F.lit(0.9))
    depth = F.lit(1.0) - pmap10 / F.col("avg_price")
    derived = {
        "map_price": F.col("avg_price"),
        "ir": F.when(has_price, F.col("ir")).otherwise(F.lit(0)).cast("bigint"),
        "pmap": F.when(has_price, pmap).otherwise(F.lit(0.0)),
        "pmap10": F.when(has_price, pmap10).otherwise(F.lit(0.0)),
        "pro_percent": F.when(has_price, depth).otherwise(F.lit(0.0)),
    }
    return priced.select(
        *PROMOTION_KEY,
        "targetweek",
        "planweek",
        *[derived[name].alias(name) for name in PROMOTION_MEASURES],
    )
