"""Sales panel: promotions joined to sales, missing weeks filled, promotions flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.config import REFERENCE
from weekcast.functions.weeks import (
    checked_week,
    label_of_index,
    shift_week,
    week_index,
    week_range,
    year_of,
)
from weekcast.operators.keyed import match_null_safe, not_in
from weekcast.sources.schemas import JOINED_SALES, PANEL_KEY, PROMOTION_MEASURES

# Sales column -> promotion column of the join, output name -> sales column, sort order.
_SALES_TO_PROMOTION = {
    "regionSeg1": "regionseg",
    "regionSeg2": "salesid",
    "productSeg2": "productgroup",
    "productSeg3": "item",
    "yearweek": "targetweek",
}
_SALES_NAMES = {
    "regionseg": "regionSeg1",
    "productseg1": "productSeg1",
    "productgroup": "productSeg2",
    "salesid": "regionSeg2",
    "regionseg3": "regionSeg3",
    "item": "productSeg3",
    "yearweek": "yearweek",
}
_SORT_KEY = ["regionseg", "productgroup", "salesid", "regionseg3", "item"]


def join_promotions(sales: DataFrame, promo: DataFrame, project: str = "panel") -> DataFrame:
    """Sales left outer join promotions on key and week.

    ``project`` picks the output: ``"panel"`` renames the sales columns and
    turns missing promotion measures into 0, ``"promo"`` keeps the promotion
    columns and ``qty``, ``"sales"`` keeps the sales columns and the promotion
    measures with their nulls.  Several promotions of one key and week repeat
    the sales row.
    """
    s, p = sales.alias("s"), promo.alias("p")
    condition = None
    for left, right in _SALES_TO_PROMOTION.items():
        equal = F.col(f"s.{left}") == F.col(f"p.{right}")
        condition = equal if condition is None else condition & equal
    joined = s.join(p, condition, "left")
    if project == "promo":
        return joined.select("p.*", "s.qty")
    if project == "sales":
        return joined.select("s.*", *[F.col(f"p.{m}") for m in PROMOTION_MEASURES])
    if project != "panel":
        raise ValueError("project must be 'panel', 'promo' or 'sales'")
    kinds = {field.name: field.dataType for field in JOINED_SALES}
    return joined.select(
        *[F.col(f"s.{old}").alias(new) for new, old in _SALES_NAMES.items()],
        *[
            F.coalesce(F.col(f"p.{m}"), F.lit(0)).cast(kinds[m]).alias(m)
            for m in PROMOTION_MEASURES
        ],
        F.col("s.qty").cast(kinds["qty"]).alias("qty"),
    )


def series_bounds(df: DataFrame, keys: list[str] = PANEL_KEY) -> DataFrame:
    """First and last week, and first and last year, of each series.

    Labels are compared as numbers, which gives the same order: aggregates over
    integers are hashed, while those over text would sort every row first.
    """
    number = checked_week(F.col("yearweek")).cast("int")
    bounds = df.groupBy(*keys).agg(F.min(number).alias("_first"), F.max(number).alias("_last"))
    return bounds.select(
        *keys,
        F.lpad(F.col("_first").cast("string"), 6, "0").alias("first_week"),
        F.lpad(F.col("_last").cast("string"), 6, "0").alias("last_week"),
        F.floor(F.col("_first") / F.lit(100)).cast("int").alias("first_year"),
        F.floor(F.col("_last") / F.lit(100)).cast("int").alias("last_year"),
    )


def week_calendar(df: DataFrame, keys: list[str] = PANEL_KEY) -> DataFrame:
    """All weeks of each series from its first to its last."""
    index = F.explode(week_range(F.col("first_week"), F.col("last_week")))
    return (
        series_bounds(df, keys)
        .select(*keys, index.alias("week_idx"))
        .select(*keys, label_of_index(F.col("week_idx")).alias("yearweek"))
    )


def missing_weeks(df: DataFrame, keys: list[str] = PANEL_KEY) -> DataFrame:
    """Weeks between a series' first and last that have no row.

    Each series is reduced to its distinct weeks; a window then compares every
    week with the next one, and only real gaps are expanded.  No full grid is
    built and no join is needed.  A label that is no calendar week is an error, here and
    in :func:`week_calendar`.
    """
    weeks = (
        df.select(*keys, "yearweek")
        .distinct()
        .withColumn("week_idx", week_index(F.col("yearweek")))
    )
    following = F.lead("week_idx").over(Window.partitionBy(*keys).orderBy("week_idx"))
    gaps = weeks.withColumn("next_idx", following).filter(
        F.col("next_idx") - F.col("week_idx") > 1
    )
    missing = F.explode(F.sequence(F.col("week_idx") + 1, F.col("next_idx") - 1))
    return gaps.select(*keys, missing.alias("gap_idx")).select(
        *keys, label_of_index(F.col("gap_idx")).alias("yearweek")
    )


def missing_weeks_by_difference(df: DataFrame, keys: list[str] = PANEL_KEY) -> DataFrame:
    """The same weeks as a set difference: full calendar minus weeks present."""
    return not_in(week_calendar(df, keys), df, [*keys, "yearweek"])


def empty_measures(df: DataFrame, keys: list[str], values: dict[str, Column] | None = None):
    """Columns of ``df`` for generated rows: keys kept, measures 0, flags ``N``."""
    values = {name.lower(): column for name, column in (values or {}).items()}
    kept = {name.lower() for name in keys}
    columns = []
    for field in df.schema:
        name = field.name.lower()
        if name in kept:
            column = F.col(field.name)
        elif name in values:
            column = values[name].cast(field.dataType)
        elif name == "promotionny" and isinstance(field.dataType, T.StringType):
            column = F.lit("N")
        else:
            column = F.lit(0).cast(field.dataType)
        columns.append(column.alias(field.name))
    return columns


def gap_fill(df: DataFrame, keys: list[str] = PANEL_KEY) -> DataFrame:
    """Add a zero row for each missing week; original rows pass through unmoved."""
    filler = missing_weeks(df, keys)
    return df.unionByName(filler.select(*empty_measures(df, [*keys, "yearweek"])))


def promotion_flag(df: DataFrame) -> DataFrame:
    """``promotionNY``: N where the promotion depth is 0, otherwise Y."""
    flag = F.when(F.col("pro_percent") == 0, F.lit("N")).otherwise(F.lit("Y"))
    return df.withColumn("promotionNY", flag)


def sort_panel(df: DataFrame) -> DataFrame:
    """Global order by series, then week.

    Week and measures extend the sort key, so that range partitioning can cut
    inside a long series and the order is the same on every run.
    """
    rest = [c for c in df.columns if c.lower() not in (*_SORT_KEY, "yearweek")]
    return df.orderBy(*_SORT_KEY, "yearweek", *rest)


def prior_year_join(
    rows: DataFrame, history: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    """Rows joined to the same week number of earlier years of their series."""
    past = history.select(
        *keys,
        F.col("yearweek").alias("prior_yearweek"),
        F.substring("yearweek", 5, 2).alias("_week"),
        *values,
    )
    probes = rows.select(*keys, "yearweek", F.substring("yearweek", 5, 2).alias("_week"))
    joined = match_null_safe(probes, past, [*keys, "_week"], "inner")
    earlier = year_of(F.col("prior_yearweek")) < year_of(F.col("yearweek"))
    return joined.filter(earlier).drop("_week")


def shifted_join(
    rows: DataFrame,
    values: DataFrame,
    keys: list[str],
    value: str,
    offsets: range,
    semantics: str = REFERENCE,
) -> DataFrame:
    """Each distinct (series, week) of ``rows`` joined to the weeks around it.

    ``values`` holds one row per (series, week).  The output has one row per
    hit: the own week, the offset, the week met and its value.
    """
    reach = F.explode(F.array(*[F.lit(i) for i in offsets]))
    probes = (
        rows.select(*keys, "yearweek")
        .distinct()
        .withColumn("offset", reach)
        .withColumn("met_week", shift_week(F.col("yearweek"), F.col("offset"), semantics))
    )
    met = values.select(*keys, F.col("yearweek").alias("met_week"), F.col(value).alias("met_value"))
    return match_null_safe(probes, met, [*keys, "met_week"], "inner")
