"""Base level, week-of-year seasonality and the forecast rows built from them.

Forecast values depend only on the series and the forecast week.  They are
computed on the small (series x horizon) frame; history rows are passed on
without joining them to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.config import (
    CORRECTED,
    INACTIVE_AFTER_WEEKS,
    REFERENCE,
    ZERO_DEMAND_WEEKS,
    ForecastConfig,
)
from weekcast.functions.numbers import safe_div
from weekcast.functions.weeks import (
    in_years,
    shift_label,
    shift_week,
    week_of,
    year_number,
    year_of,
)
from weekcast.operators.keyed import exists_in, match_null_safe, one_value_per_key, scalar_of
from weekcast.operators.panel import empty_measures
from weekcast.operators.seasonality import (
    half_width,
    visible_values,
    weekly_moving_average,
)
from weekcast.sources.schemas import (
    MART,
    MART_COLUMNS,
    PANEL_KEY,
    SEASONALITY,
    SERIES_KEY,
    conform,
    named_as,
)


@dataclass(frozen=True)
class ForecastCalendar:
    """The weeks a forecast refers to, as constants that reach the scans."""

    max_week: str
    base: list[str]
    horizon: list[str]
    active_from: str

    @property
    def trailing_from(self) -> str:
        return self.base[0]

    @property
    def same_weeks(self) -> list[str]:
        """Two-digit week numbers of the horizon."""
        return [week[4:] for week in self.horizon]


def latest_week(df: DataFrame) -> str:
    """Latest week of a table: one aggregate over one column, one value returned.

    Of a table written by year only the last year is read.
    """
    if "year" in df.columns:
        df = df.filter(F.col("year").isNull() | (F.col("year") == scalar_of(df, F.max("year"))))
    latest = df.agg(F.max("yearweek")).first()[0]
    if latest is None:
        raise ValueError("the table has no rows to take the latest week from")
    return latest


def forecast_calendar(df: DataFrame, config: ForecastConfig) -> ForecastCalendar:
    """Weeks derived from the cut-off week of ``config`` or the latest in ``df``."""
    latest = config.max_week or latest_week(df)

    def shifted(n: int) -> str:
        return shift_label(latest, n, config.semantics)

    return ForecastCalendar(
        max_week=latest,
        base=[shifted(n) for n in range(-config.base_back, 1)],
        horizon=[shifted(n) for n in range(1, config.horizon + 1)],
        active_from=shifted(-INACTIVE_AFTER_WEEKS),
    )


def _constants(labels: list[str]) -> Column:
    return F.array(*[F.lit(label) for label in labels])


def cut_history(df: DataFrame, max_week: str | Column) -> DataFrame:
    """Drop rows after the cut-off week (forecasts of an earlier run)."""
    if isinstance(max_week, str):
        df = in_years(df, last=max_week)
    return df.filter(F.col("yearweek") <= max_week)


def trailing_output(df: DataFrame, config: ForecastConfig) -> DataFrame:
    """Keep rows from the start of the base window on."""
    return _from_week(df, forecast_calendar(df, config).trailing_from)


def _from_week(df: DataFrame, first: str) -> DataFrame:
    return in_years(df, first=first).filter(F.col("yearweek") >= first)


def recent_series(
    df: DataFrame, since: str | Column, keys: list[str], sold: bool = False
) -> DataFrame:
    """Keys of the series with a row (that sold something) since a week.

    "The last week is recent" is the same as "some row is recent", so only the
    recent weeks are read.
    """
    recent = _from_week(df, since) if isinstance(since, str) else df.filter(F.col("yearweek") >= since)
    if sold:
        recent = recent.filter(F.col("qty") != 0)
    return recent.select(*keys).distinct()


def _weeks_before_latest(df: DataFrame, weeks: int, semantics: str) -> Column:
    return scalar_of(df, shift_week(F.max("yearweek"), -weeks, semantics))


def drop_inactive(
    df: DataFrame,
    weeks: int = INACTIVE_AFTER_WEEKS,
    semantics: str = REFERENCE,
    keys: list[str] = PANEL_KEY,
) -> DataFrame:
    """Keep series with a row no more than ``weeks`` weeks before the latest week."""
    since = _weeks_before_latest(df, weeks, semantics)
    return exists_in(df, recent_series(df, since, keys), keys)


def drop_zero_demand(
    df: DataFrame,
    weeks: int = ZERO_DEMAND_WEEKS,
    semantics: str = REFERENCE,
    keys: list[str] = PANEL_KEY,
) -> DataFrame:
    """Keep series that sold anything in the last ``weeks`` weeks; absent weeks count as 0."""
    since = _weeks_before_latest(df, weeks - 1, semantics)
    return exists_in(df, recent_series(df, since, keys, sold=True), keys)


def horizon_rows(df: DataFrame, calendar: ForecastCalendar, keys: list[str]) -> DataFrame:
    """One empty row per series and forecast week."""
    series = df.select(*keys).distinct()
    weeks = series.withColumn("yearweek", F.explode(_constants(calendar.horizon)))
    label = F.col("yearweek")
    filled = {"year": year_of(label), "week": week_of(label)}
    schema_rows = empty_measures(df, [*keys, "yearweek"], filled)
    return weeks.select(*schema_rows)


def extend_horizon(
    df: DataFrame, config: ForecastConfig = ForecastConfig(), keys: list[str] = PANEL_KEY
) -> DataFrame:
    """Add empty rows for the forecast weeks of every series.

    The weeks follow the cut-off week (or the latest week of the table), not the
    end of each series.
    """
    return df.unionByName(horizon_rows(df, forecast_calendar(df, config), keys))


def week_values(
    lookups: DataFrame, calendar: ForecastCalendar, keys: list[str], keep: str = "first"
) -> DataFrame:
    """Per series, a map from week to (quantity, seasonality).

    Only base weeks and earlier weeks with a forecast week number are kept, so a
    map has at most base + horizon x years entries whatever the table size.
    Rows are reduced to one per (series, week) before they are gathered: the one
    with the smallest (largest) quantity, then seasonality.
    """
    label = F.col("yearweek")
    needed = label.isin(calendar.base) | week_of(label).isin(calendar.same_weeks)
    weekly = one_value_per_key(
        lookups.filter(needed), [*keys, "yearweek"], ["qty", "seasonality"], keep
    )
    entry = F.struct("yearweek", F.struct("qty", "seasonality"))
    return weekly.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(entry)).alias("week_values")
    )


def base_window(frame: DataFrame, calendar: ForecastCalendar) -> DataFrame:
    """Quantity and seasonality totals over the base weeks, added in week order."""

    def total(field: str) -> Column:
        def add(acc: Column, week: Column) -> Column:
            found = F.try_element_at("week_values", week)[field]
            return acc + F.coalesce(found, F.lit(0.0))

        return F.aggregate(_constants(calendar.base), F.lit(0.0), add)

    return frame.withColumns(
        {"base_qty": total("qty"), "base_seasonality": total("seasonality")}
    )


def base_level(frame: DataFrame, config: ForecastConfig) -> DataFrame:
    """Base level: base quantity over 4 (reference) or over the base length."""
    return frame.withColumn("fcst", F.col("base_qty") / F.lit(float(config.base_divisor)))


def _week_seasonality_reference(label: Column, first_year: Column, last_year: Column) -> Column:
    """Running division: every year from the first hit on divides by the hits so far."""

    def step(acc: Column, year: Column) -> Column:
        found = F.try_element_at(
            "week_values", F.concat(F.lpad(year.cast("string"), 4, "0"), week_of(label))
        )["seasonality"]
        hits = acc["hits"] + F.when(found.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = acc["value"] + F.coalesce(found, F.lit(0.0))
        value = F.when(hits != 0, total / hits).otherwise(total)
        return F.struct(value.alias("value"), hits.alias("hits"))

    start = F.struct(F.lit(0.0).alias("value"), F.lit(0).alias("hits"))
    folded = F.aggregate(F.sequence(first_year, last_year), start, step)["value"]
    return F.when(first_year <= last_year, folded).otherwise(F.lit(0.0))


def _week_seasonality_corrected(label: Column) -> Column:
    """Mean over the earlier years that have the week, added in year order."""
    prior = F.filter(
        F.map_entries("week_values"),
        lambda e: (week_of(e["key"]) == week_of(label))
        & (year_number(e["key"]) < year_number(label)),
    )
    ordered = F.array_sort(prior)
    total = F.aggregate(
        ordered, F.lit(0.0), lambda acc, e: acc + F.coalesce(e["value"]["seasonality"], F.lit(0.0))
    )
    return F.coalesce(safe_div(total, F.size(ordered)), F.lit(0.0))


def week_seasonality(frame: DataFrame, config: ForecastConfig) -> DataFrame:
    """Usual seasonality of each forecast week from earlier years of the series."""
    label = F.col("yearweek")
    if config.semantics == REFERENCE:
        last_year = F.col("last_forecast_year") - F.lit(1)
        value = _week_seasonality_reference(label, F.col("first_year"), last_year)
    else:
        value = _week_seasonality_corrected(label)
    known = F.when(F.col("week_values").isNotNull(), value)
    return frame.withColumn("seasonality", F.coalesce(known, F.lit(0.0)))


def time_series(frame: DataFrame, config: ForecastConfig) -> DataFrame:
    """Base level x week seasonality over the base seasonality (total or average)."""
    scale = F.col("base_seasonality")
    if config.semantics != REFERENCE:
        scale = scale / F.lit(float(config.base_weeks))
    return frame.withColumn("time_series", safe_div(F.col("fcst") * F.col("seasonality"), scale))


def first_years(
    history: DataFrame,
    keys: list[str],
    active_from: str | None = None,
    sold: bool = False,
) -> DataFrame:
    """One row per series with the year of its first week.

    With ``active_from``, only series with a row (that sold something) since
    then.  Weeks are compared as numbers: integer aggregates are hashed, text
    ones would sort every row first.
    """
    label = F.col("yearweek")
    found = {"first_year": F.min(year_number(label))}
    if active_from is not None:
        counted = F.when(F.col("qty") != 0, label) if sold else label
        found["_last_week"] = F.max(counted.cast("int"))
    series = history.groupBy(*keys).agg(*[c.alias(name) for name, c in found.items()])
    if active_from is None:
        return series
    return series.filter(F.col("_last_week") >= int(active_from)).drop("_last_week")


def series_frame(
    series: DataFrame,
    lookups: DataFrame,
    calendar: ForecastCalendar,
    config: ForecastConfig,
    keep: str = "first",
) -> DataFrame:
    """``series`` (see :func:`first_years`) with base totals, base level and week values."""
    lookup_keys, visible = visible_values(lookups, config.semantics)
    values = week_values(lookups.filter(visible), calendar, lookup_keys, keep)
    frame = match_null_safe(series, values, lookup_keys, "left")
    return base_level(base_window(frame, calendar), config)


def forecast_frame(
    series: DataFrame,
    lookups: DataFrame,
    calendar: ForecastCalendar,
    config: ForecastConfig,
    keys: list[str],
    keep: str = "first",
) -> DataFrame:
    """One row per series and forecast week with fcst, seasonality and time_series."""
    frame = series_frame(series, lookups, calendar, config, keep).withColumns(
        {
            "last_forecast_year": F.lit(int(calendar.horizon[-1][:4])),
            "yearweek": F.explode(_constants(calendar.horizon)),
        }
    )
    valued = time_series(week_seasonality(frame, config), config)
    return valued.select(*keys, "yearweek", "fcst", "seasonality", "time_series")


def _as_rows_of(df: DataFrame, frame: DataFrame, keys: list[str]) -> DataFrame:
    """Forecast values as full rows with the columns of ``df`` (measures 0)."""
    label = F.col("yearweek")
    values = {"year": year_of(label), "week": week_of(label)}
    carried = [c for c in frame.columns if c not in keys]
    values.update({c: F.col(c) for c in carried})
    return frame.select(*empty_measures(df, keys, values))


def forecast(
    panel: DataFrame,
    config: ForecastConfig = ForecastConfig(),
    drop_zero: bool = False,
) -> DataFrame:
    """Active series of the seasonality panel, with forecast rows appended.

    History rows carry 0 in ``fcst`` and ``time_series``; forecast rows carry the
    base level, the usual seasonality of their week and the forecast.
    """
    panel = named_as(panel, SEASONALITY)
    calendar = forecast_calendar(panel, config)
    active = recent_series(panel, calendar.active_from, PANEL_KEY, sold=drop_zero)
    history = exists_in(panel, active, PANEL_KEY).withColumns(
        {"fcst": F.lit(0.0), "time_series": F.lit(0.0)}
    )
    series = first_years(panel, PANEL_KEY, calendar.active_from, sold=drop_zero)
    frame = forecast_frame(series, panel, calendar, config, PANEL_KEY)
    return history.unionByName(_as_rows_of(history, frame, PANEL_KEY))


def reforecast(
    mart: DataFrame, config: ForecastConfig, recompute: bool = False
) -> DataFrame:
    """Forecast again from a mart with other settings; returns the trailing rows.

    Rows after the cut-off week are old forecasts and are replaced.  Under the
    reference semantics look-ups still see them; corrected look-ups do not.
    Without ``recompute`` the stored moving averages and seasonality are passed
    on.  With it, both are computed anew from ``average_window``; corrected
    forecasts then use the new seasonality, reference forecasts the stored one.
    """
    mart = conform(mart, MART)
    calendar = forecast_calendar(mart, config)
    corrected = config.semantics != REFERENCE
    history = cut_history(mart, calendar.max_week)
    lookups = history if corrected else mart
    trailing = _from_week(history, calendar.trailing_from)
    renewed = None
    if recompute:
        needed = _near_needed_weeks(calendar, config, same_weeks=corrected)
        renewed = _renewed_averages(history, lookups.filter(needed), calendar, config)
        if corrected:
            lookups = renewed.filter(F.col("qty").isNotNull()).withColumn(
                "seasonality", safe_div(F.col("qty"), F.col("moving_avg"))
            )
    series = first_years(history, SERIES_KEY)
    frame = forecast_frame(series, lookups, calendar, config, SERIES_KEY, keep="last")
    trailing = trailing.withColumns({"fcst": F.lit(0.0), "time_series": F.lit(0.0)})
    if renewed is not None:
        means = renewed.filter(F.col("yearweek") >= calendar.trailing_from).drop("qty")
        on = [*SERIES_KEY, "yearweek"]
        joined = match_null_safe(trailing.drop("moving_avg"), means, on, "left")
        filled = joined.withColumn("moving_avg", F.coalesce("moving_avg", F.lit(0.0)))
        trailing = filled.withColumn(
            "seasonality", safe_div(F.col("qty"), F.col("moving_avg"))
        )
        frame = match_null_safe(frame, means, on, "left").withColumn(
            "moving_avg", F.coalesce("moving_avg", F.lit(0.0))
        )
    rows = trailing.unionByName(_as_rows_of(trailing, frame, SERIES_KEY))
    return rows.select(*MART_COLUMNS)


def _near_needed_weeks(
    calendar: ForecastCalendar, config: ForecastConfig, same_weeks: bool
) -> Column:
    """Weeks that can enter a moving average of a week the re-forecast uses.

    Those are the trailing weeks and, with ``same_weeks``, the forecast's week
    numbers in every year, each with one week more than the window reaches on
    both sides (years have 52 or 53 weeks).  Other weeks need not be read.
    """
    reach = half_width(config.average_window) + 1
    label = F.col("yearweek")
    near = label >= shift_label(calendar.trailing_from, -reach, CORRECTED)
    if not same_weeks:
        return near
    numbers = {
        (int(week) - 1 + step) % length + 1
        for week in calendar.same_weeks
        for step in range(-reach, reach + 1)
        for length in (52, 53)
    }
    return near | week_of(label).isin([f"{number:02d}" for number in sorted(numbers)])


def _renewed_averages(
    history: DataFrame, lookups: DataFrame, calendar: ForecastCalendar, config: ForecastConfig
) -> DataFrame:
    """Moving averages per series and week, forecast weeks included.

    Forecast weeks enter with a null quantity: they get an average of the known
    weeks around them and add nothing themselves.
    """
    known = lookups.select(*SERIES_KEY, "yearweek", "qty")
    ahead = (
        history.select(*SERIES_KEY)
        .distinct()
        .select(
            *SERIES_KEY,
            F.explode(_constants(calendar.horizon)).alias("yearweek"),
            F.lit(None).cast("double").alias("qty"),
        )
    )
    weekly = known.unionByName(ahead).groupBy(*SERIES_KEY, "yearweek").agg(
        F.max("qty").alias("qty")
    )
    return weekly_moving_average(weekly, SERIES_KEY, config.average_window, config.semantics)
