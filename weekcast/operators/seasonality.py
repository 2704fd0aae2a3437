"""Centred moving averages and the seasonality index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.config import REFERENCE, check_semantics
from weekcast.functions.numbers import safe_div
from weekcast.functions.weeks import (
    first_week_index,
    week_index,
    week_number,
    year_number,
    year_of_index,
)
from weekcast.operators.keyed import match_null_safe
from weekcast.sources.schemas import PANEL, PANEL_KEY, SERIES_KEY, name_of, named_as


def half_width(window: int) -> int:
    """Weeks on each side; an even window acts like the next smaller odd one."""
    return (window - 1) // 2


def visible_values(df: DataFrame, semantics: str) -> tuple[list[str], Column]:
    """Key of the look-up side of ``df`` and the condition for rows it can see.

    The reference looks values up with ``productseg1`` missing, so only rows
    without it are ever found; corrected look-ups use the row's own value.
    """
    if name_of(df, "productseg1") is None:
        return SERIES_KEY, F.lit(True)
    if semantics == REFERENCE:
        return SERIES_KEY, F.col("productseg1").isNull()
    return PANEL_KEY, F.lit(True)


def weekly_quantity(df: DataFrame, semantics: str = REFERENCE) -> tuple[DataFrame, list[str]]:
    """One row per series and week with its smallest visible quantity.

    A week known only through rows the look-up cannot see keeps a null quantity:
    it gets a moving average from its neighbours but adds nothing to theirs.
    """
    keys, visible = visible_values(df, semantics)
    weekly = df.groupBy(*keys, "yearweek").agg(F.min(F.when(visible, F.col("qty"))).alias("qty"))
    return weekly, keys


def weekly_moving_average(
    weekly: DataFrame, keys: list[str], window: int = 5, semantics: str = REFERENCE
) -> DataFrame:
    """Moving average per series and week over the weeks that exist around it.

    ``weekly`` has one row per (series, week), so a series is at most as long as
    the calendar and one window pass over the series key is enough, at any width.
    The reference's backward shift over new year is expressed in the same pass:
    see :func:`_reference_reach`.
    """
    check_semantics(semantics)
    half = half_width(window)
    spec = Window.partitionBy(*keys).orderBy("week_idx")
    indexed = weekly.withColumn("week_idx", week_index(F.col("yearweek")))

    # Every value over the window is a column of its own: one that is used twice in an expression is computed twice.
    def totals(total: str, hits: str, value: str, first: int, last: int) -> dict[str, Column]:
        frame = spec.rangeBetween(first, last)
        return {total: F.sum(value).over(frame), hits: F.count(value).over(frame)}

    some = [("_total", "_hits")]
    if semantics != REFERENCE or half == 0:
        indexed = indexed.withColumns(totals("_total", "_hits", "qty", -half, half))
        single = range(0)
    else:
        # Weeks 53 of earlier years are never met: the shift back over new year steps over them.
        past = F.when(week_number(F.col("yearweek")) != 53, F.col("qty"))
        indexed = indexed.withColumns({"_reach": _reference_reach(half), "_past": past})
        columns = totals("_total", "_hits", "qty", 0, half)
        slack = half // 52 + 2
        always = max(0, half - slack)
        if always:
            columns |= totals("_back", "_seen", "_past", -always, -1)
            some.append(("_back", "_seen"))
        # Beyond the weeks that every reach covers, single weeks join one by one.
        single = range(always + 1, half + slack + 1)
        columns |= {f"_at{d}": F.max("_past").over(spec.rangeBetween(-d, -d)) for d in single}
        indexed = indexed.withColumns(columns)
    total, hits = F.lit(0.0), F.lit(0).cast("bigint")
    for value, count in some:
        total, hits = total + F.coalesce(value, F.lit(0.0)), hits + F.col(count)
    for d in single:
        met = F.when(F.col("_reach") >= d, F.col(f"_at{d}"))
        total, hits = total + F.coalesce(met, F.lit(0.0)), hits + met.isNotNull().cast("bigint")
    averaged = indexed.withColumns({"_sum": total, "_count": hits})
    return averaged.select(*keys, "yearweek", "qty", safe_div(F.col("_sum"), F.col("_count")).alias("moving_avg"))


def _reference_reach(half: int) -> Column:
    """How many weeks back the reference's shifts by 1 to ``half`` weeks reach.

    Within the year that is ``half``.  Over new year the shift lands on a label of
    the year it leaves and takes one off the year: the week met last lies one week nearer or farther
    for each new year between years of different length.
    """
    year, within = year_number(F.col("yearweek")), week_number(F.col("yearweek")) - F.lit(half)
    landing = first_week_index(year + F.lit(1)) + within - F.lit(1)
    later = year_of_index(landing)
    # The landing's week number counted in the year before its own; week 53 of that may be week 1 of the next year, which
    # is where the step before it met too.
    farthest = first_week_index(later - F.lit(1)) + landing - first_week_index(later)
    return F.when(within > 0, F.lit(half)).otherwise(F.col("week_idx") - farthest)


def moving_average(df: DataFrame, window: int = 5, semantics: str = REFERENCE) -> DataFrame:
    """Every row of ``df`` with the moving average of its week."""
    df = named_as(df, PANEL)
    weekly, keys = weekly_quantity(df, semantics)
    means = weekly_moving_average(weekly, keys, window, semantics).drop("qty")
    joined = match_null_safe(df, means, [*keys, "yearweek"], "left")
    return joined.withColumn("moving_avg", F.coalesce("moving_avg", F.lit(0.0)))


def seasonality(df: DataFrame) -> DataFrame:
    """Seasonality index: quantity over its moving average, 0 where that is 0."""
    return df.withColumn("seasonality", safe_div(F.col("qty"), F.col("moving_avg")))


def add_seasonality(panel: DataFrame, window: int = 5, semantics: str = REFERENCE) -> DataFrame:
    """The panel with ``moving_avg`` and ``seasonality``."""
    return seasonality(moving_average(panel, window, semantics))
