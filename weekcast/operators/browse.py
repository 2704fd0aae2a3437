"""The final mart and the views people read from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.functions.weeks import in_years, week_of, year_of
from weekcast.sources.schemas import DISPLAY_COLUMNS, MART_COLUMNS

_DRILL_COLUMNS = ("regionseg", "regionseg3", "productgroup", "item")


def final_mart(forecast: DataFrame) -> DataFrame:
    """19 mart columns: year and week split off, promotion flag as 0 or 1."""
    flag = F.when(F.col("promotionNY") == "Y", F.lit(1)).otherwise(F.lit(0))
    return forecast.withColumns(
        {
            "year": year_of(F.col("yearweek")),
            "week": week_of(F.col("yearweek")),
            "promotionNY": flag,
        }
    ).select(*MART_COLUMNS)


def display_view(mart: DataFrame) -> DataFrame:
    """The 17 columns shown in tables."""
    return mart.select(*DISPLAY_COLUMNS)


def mart_filter(
    mart: DataFrame,
    productgroup: str,
    before: int | None = None,
    after: int | None = None,
) -> DataFrame:
    """Rows of a product group before and/or after a week.

    Labels have six digits, so their order as text is that of the numbers, and a
    text bound reaches the scan; the year bound leaves out whole folders of a mart written by year.
    """
    condition = F.col("productgroup") == F.lit(productgroup)
    if before is not None:
        condition &= F.col("yearweek") < F.lit(_as_label(before))
    if after is not None:
        condition &= F.col("yearweek") > F.lit(_as_label(after))
    years = {"last": _as_label(before)} if before is not None else {}
    years |= {"first": _as_label(after)} if after is not None else {}
    return in_years(mart, **years).filter(condition)


def _as_label(number: int) -> str:
    """A bound in text order: below all labels for negative numbers, above all for longer ones."""
    return "" if number < 0 else ":" if number > 999999 else f"{number:06d}"


def drill_down_rows(mart: DataFrame, **equals: str) -> DataFrame:
    """Rows matching the given region, site, product group and item."""
    unknown = set(equals) - set(_DRILL_COLUMNS)
    if unknown:
        raise ValueError(f"cannot drill down on {sorted(unknown)}")
    rows = mart
    for name, value in equals.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    return rows


def drill_down(mart: DataFrame, **equals: str) -> DataFrame:
    """The same rows by week, in a total order that range partitioning can cut anywhere."""
    rows = drill_down_rows(mart, **equals)
    return rows.orderBy("yearweek", *[c for c in rows.columns if c != "yearweek"])


def item_series(mart: DataFrame, site: str, item: str, value: str = "time_series") -> DataFrame:
    """Week and value of one item at one site, by week."""
    picked = (F.col("regionseg3") == F.lit(site)) & (F.col("item") == F.lit(item))
    return mart.filter(picked).select("yearweek", value).orderBy("yearweek", value)


def item_list(mart: DataFrame) -> DataFrame:
    """Distinct items in order."""
    return mart.select("item").distinct().orderBy("item")


def series_array(
    mart: DataFrame, keys: tuple[str, ...] = ("regionseg3", "item"), value: str = "time_series"
) -> DataFrame:
    """Per selection, its (week, value) points in week order.

    A week with several rows keeps its largest value.  That reduction comes
    first, so an array is never longer than the calendar.
    """
    points = mart.groupBy(*keys, "yearweek").agg(F.max(value).alias("value"))
    return points.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("yearweek", "value"))).alias("points")
    )


def chart_points(series: DataFrame) -> DataFrame:
    """``points`` as chart text: ``['201401', 1.5],['201402', 0.0]``."""
    pieces = F.transform(
        "points",
        lambda p: F.concat(
            F.lit("['"), p["yearweek"], F.lit("', "), p["value"].cast("string"), F.lit("]")
        ),
    )
    return series.withColumn("points", F.array_join(pieces, ","))


def drill_down_series(
    mart: DataFrame, value: str = "time_series", **equals: str
) -> DataFrame:
    """Series of each region, site, product group and item of a selection, as chart points."""
    return series_array(drill_down_rows(mart, **equals), _DRILL_COLUMNS, value)
