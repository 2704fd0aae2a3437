"""Named queries over the order star schema, one per operator.

Queries on a stage read the table the previous stage wrote, as the batch job
itself does.  A stage is written at most once per session and input folder, and
only when a query needs it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.config import CORRECTED, MAX_YEAR_WEEK, REFERENCE, ForecastConfig
from weekcast.functions import weeks
from weekcast.functions.numbers import numeric_text_to_int
from weekcast.operators import browse, forecasting, keyed, parameters, promotions
from weekcast.operators import panel as panels
from weekcast.operators import seasonality as seasonal
from weekcast.plans import jobs
from weekcast.sources import files, rejects, schemas, star_schema
from weekcast.sources.shared import identity, shared_folder, write_stage
from weekcast.sources.versions import VersionedTable

K5, K6 = schemas.SERIES_KEY, schemas.PANEL_KEY
_SALES_SERIES = [
    "regionSeg1", "productSeg1", "productSeg2", "regionSeg2", "regionSeg3", "productSeg3",
]
_LINE_KEY = [*_SALES_SERIES, "yearweek"]
_SALES_TO_PROMO = {
    "regionSeg1": "regionseg", "regionSeg2": "salesid", "productSeg2": "productgroup",
    "productSeg3": "item", "yearweek": "targetweek",
}
# Fixed values of the browsing queries.
GROUP, SITE, ITEM, REGION = "ECONOMY", "ASIA", "gear", "A01"
BEFORE_WEEK, AFTER_WEEK = 199710, 200130
UPDATED_WINDOW = 6


class Stages:
    """Tables of one input folder, each written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.folder = shared_folder(spark)

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        return write_stage(df, self.folder, name)

    def rewritten(self, name: str) -> str:
        """A new path for a copy that a query writes on every call; earlier ones stay, since results that read them are lazy."""
        return f"{shared_folder(self.spark)}/{name}"

    @cached_property
    def lines(self):
        return self._write(star_schema.sales_lines(self.spark, self.sf_dir), "lines")

    @cached_property
    def line_values(self):
        return self._write(star_schema.line_values(self.spark, self.sf_dir), "line_values")

    @cached_property
    def weekly_lines(self):
        return self._write(star_schema.weekly_lines(self.spark, self.sf_dir), "weekly_lines")

    @cached_property
    def sales(self):
        return self._write(star_schema.sales(self.weekly_lines), "sales")

    @cached_property
    def promotions(self):
        return self._write(star_schema.promotions(self.weekly_lines), "promotions")

    @cached_property
    def entries(self):
        return star_schema.parameter_entries(self.spark, self.sf_dir)

    @cached_property
    def typed_entries(self):
        return self.entries.withColumn("value", numeric_text_to_int(F.col("value")))

    @cached_property
    def joined(self):
        priced = jobs.price_promotions(self.promotions)
        return self._write(panels.join_promotions(self.sales, priced), "joined")

    @cached_property
    def panel(self):
        return self._write(panels.promotion_flag(panels.gap_fill(self.joined)), "panel")

    @cached_property
    def seasonal(self):
        return jobs.write_by_week(seasonal.add_seasonality(self.panel), self.folder, "seasonal")

    @cached_property
    def seasonal_cor(self):
        corrected = seasonal.add_seasonality(self.panel, semantics=CORRECTED)
        return jobs.write_by_week(corrected, self.folder, "seasonal_cor")

    @cached_property
    def mart(self):
        return jobs.write_mart(browse.final_mart(forecasting.forecast(self.seasonal)), self.folder)

    @cached_property
    def browse_mart(self):
        path = f"{self.folder}/browse_mart"
        jobs.write_browse_mart(self.mart, path, row_group_bytes=1 << 20)
        return files.read_table(self.spark, path, schemas.MART)

    def seasonal_of(self, semantics: str) -> DataFrame:
        return self.seasonal if semantics == REFERENCE else self.seasonal_cor

    @cached_property
    def parameter_table(self):
        """Valid entries, and the latest sales week as the cut-off."""
        valid = parameters.validate_params(self.typed_entries)
        latest = self.seasonal.agg(F.max("yearweek").cast("int").alias("value")).select(
            F.lit(MAX_YEAR_WEEK).alias("parameter"), "value"
        )
        return valid.unionByName(latest)

    @cached_property
    def earlier_parameter_table(self):
        """The same settings, cut off in week 50 of the year before the last one."""
        year = weeks.year_of(F.col("value").cast("string")).cast("int") - F.lit(1)
        moved = F.when(F.col("parameter") == MAX_YEAR_WEEK, year * 100 + 50)
        return self.parameter_table.withColumn("value", F.coalesce(moved, F.col("value")))


_stages: dict[tuple[str, str], tuple[str, Stages]] = {}


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    """The stages of a folder; when its tables change, new ones."""
    key = (spark.conf.get("spark.app.id"), str(sf_dir).rstrip("/"))
    now = identity(spark, key[1])
    if key not in _stages or _stages[key][0] != now:
        _stages[key] = (now, Stages(spark, key[1]))
    return _stages[key][1]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    """Register a query under its function name."""
    QUERIES[make.__name__] = lambda spark, sf_dir: make(stages(spark, sf_dir))
    return make


# Sources, sinks and previews


@query
def csv_roundtrip(t: Stages):
    path = t.rewritten("promotions.csv")
    files.write_csv(t.promotions, path)
    return files.read_csv(t.spark, path, schemas.PROMOTION)


@query
def csv_reordered(t: Stages):
    path = t.rewritten("reordered.csv")
    other = t.promotions.select(*[F.col(c).alias(c.upper()) for c in reversed(t.promotions.columns)], F.lit("x").alias("note"))
    files.write_csv(other, path)
    return files.read_csv(t.spark, path, schemas.PROMOTION)


def _faulty_load(t: Stages) -> tuple[DataFrame, str]:
    """Promotions written as CSV with bad prices for one item and bad weeks in week 20, and loaded again."""
    path, quarantine = t.rewritten("faulty.csv"), t.rewritten("rejected")
    text = files.cast_to(t.promotions, schemas.as_text(schemas.PROMOTION))
    price = F.when(F.col("item") == ITEM, F.lit("n/a")).otherwise(F.col("map_price"))
    label = F.col("targetweek")
    week = F.when(weeks.week_of(label) == "20", F.concat(weeks.year_of(label), F.lit("60"))).otherwise(label)
    files.write_csv(text.withColumns({"map_price": price, "targetweek": week}), path)
    loaded = rejects.load_csv(t.spark, path, schemas.PROMOTION, quarantine, ("targetweek", "planweek"), most_rejected=1.0)
    return loaded, quarantine


@query
def csv_accepted(t: Stages):
    return _faulty_load(t)[0]


@query
def csv_rejected(t: Stages):
    rows = rejects.read_rejected(t.spark, _faulty_load(t)[1])
    return rows.groupBy("column", "reason").agg(F.count("*").alias("n"))


@query
def scan_all(t: Stages):
    t.sales.createOrReplaceTempView("weekly_sales")
    return files.scan(t.spark, "weekly_sales")


@query
def partitioned_roundtrip(t: Stages):
    path = t.rewritten("mart_by_year")
    files.write_table(t.mart, path, partition_by=["year"])
    return files.read_table(t.spark, path, schemas.MART).select(*schemas.MART_COLUMNS)


@query
def preview_top2(t: Stages):
    return files.preview(t.sales, 2, t.sales.columns)


@query
def normalize_columns(t: Stages):
    return files.normalize_columns(t.sales)


@query
def typed_panel(t: Stages):
    text = files.cast_to(t.panel, schemas.as_text(schemas.PANEL))
    return files.cast_to(text, schemas.PANEL)


# Week functions


def _shifted(t: Stages, semantics: str):
    steps = (F.col("qty").cast("int") % F.lit(17)) - F.lit(8)
    shifted = weeks.shift_week(F.col("yearweek"), steps, semantics)
    return t.sales.select(*_LINE_KEY, steps.alias("weeks"), shifted.alias("shifted"))


@query
def shift_week_ref(t: Stages):
    return _shifted(t, REFERENCE)


@query
def shift_week_cor(t: Stages):
    return _shifted(t, CORRECTED)


@query
def weeks_in_year(t: Stages):
    years = t.sales.select(weeks.year_number(F.col("yearweek")).alias("year")).distinct()
    return years.select("year", weeks.weeks_in_year(F.col("year")).alias("weeks"))


# Promotions


@query
def promo_filter_row(t: Stages):
    return promotions.filter_valid_promotions(t.promotions)


@query
def promo_filter_row_price(t: Stages):
    return promotions.filter_valid_promotions(t.promotions, nonzero_price=True)


@query
def promo_filter_global(t: Stages):
    return promotions.filter_valid_promotions(
        t.promotions, nonzero_price=True, plan_week="global_min"
    )


@query
def min_plan_week(t: Stages):
    return keyed.min_value(t.promotions, "planweek", "min_plan_week")


@query
def price_stats(t: Stages):
    return promotions.price_stats(promotions.filter_valid_promotions(t.promotions))


@query
def avg_nonzero_price(t: Stages):
    return promotions.avg_nonzero_price(promotions.filter_valid_promotions(t.promotions))


@query
def price_refinement(t: Stages):
    return jobs.price_promotions(t.promotions)


# Panel


@query
def sales_promo_join(t: Stages):
    return panels.join_promotions(t.sales, jobs.price_promotions(t.promotions))


@query
def sales_promo_join_promo_side(t: Stages):
    valid = promotions.filter_valid_promotions(t.promotions, nonzero_price=True)
    return panels.join_promotions(t.sales, valid, project="promo")


@query
def sales_promo_join_sales_side(t: Stages):
    valid = promotions.filter_valid_promotions(
        t.promotions, nonzero_price=True, plan_week="global_min"
    )
    return panels.join_promotions(t.sales, valid, project="sales")


@query
def key_exists(t: Stages):
    return keyed.exists_in(t.sales, jobs.price_promotions(t.promotions), _SALES_TO_PROMO)


@query
def series_bounds(t: Stages):
    return panels.series_bounds(t.joined)


@query
def week_calendar(t: Stages):
    return panels.week_calendar(t.joined)


@query
def missing_weeks(t: Stages):
    return panels.missing_weeks(t.joined)


@query
def missing_weeks_by_difference(t: Stages):
    return panels.missing_weeks_by_difference(t.joined)


@query
def gap_fill(t: Stages):
    return panels.gap_fill(t.joined)


@query
def promotion_flag(t: Stages):
    return panels.promotion_flag(t.joined)


@query
def panel_sorted(t: Stages):
    return panels.sort_panel(t.panel)


@query
def panel(t: Stages):
    return jobs.build_panel(t.sales, t.promotions)


# Look-ups and one-row-per-key


@query
def qty_lookup(t: Stages):
    return keyed.lookup(t.lines, t.lines, _LINE_KEY, {"qty": "first_qty"})


@query
def seasonality_lookup(t: Stages):
    probes = t.seasonal.select(
        *K6, "yearweek", weeks.shift_week(F.col("yearweek"), -1).alias("previous_week")
    )
    keys = {**{k: k for k in K6}, "previous_week": "yearweek"}
    return keyed.lookup(probes, t.seasonal, keys, {"seasonality": "previous_seasonality"})


@query
def dedupe_first(t: Stages):
    return keyed.dedupe(t.lines, _LINE_KEY, ["qty"])


@query
def dedupe_last(t: Stages):
    return keyed.dedupe(t.lines, _LINE_KEY, ["qty"], keep="last")


@query
def max_year_week(t: Stages):
    return keyed.max_value(t.sales, "yearweek", "max_year_week")


# Moving averages and seasonality


def _averages(t: Stages, window: int, semantics: str):
    means = seasonal.moving_average(t.panel, window, semantics)
    return means.select(*K6, "yearweek", "qty", "moving_avg")


@query
def moving_avg_ref(t: Stages):
    return _averages(t, 5, REFERENCE)


@query
def moving_avg_cor(t: Stages):
    return _averages(t, 5, CORRECTED)


@query
def moving_avg_w4(t: Stages):
    return _averages(t, 4, REFERENCE)


@query
def moving_avg_w7(t: Stages):
    return _averages(t, 7, REFERENCE)


@query
def shifted_join(t: Stages):
    weekly, keys = seasonal.weekly_quantity(t.panel)
    return panels.shifted_join(weekly, weekly, keys, "qty", range(-2, 3))


@query
def seasonality_ref(t: Stages):
    return seasonal.add_seasonality(t.panel)


@query
def seasonality_cor(t: Stages):
    return seasonal.add_seasonality(t.panel, semantics=CORRECTED)


# Forecast


@query
def drop_inactive(t: Stages):
    return forecasting.drop_inactive(t.seasonal)


@query
def drop_zero_demand(t: Stages):
    return forecasting.drop_zero_demand(t.seasonal)


@query
def extend_horizon(t: Stages):
    return forecasting.extend_horizon(t.seasonal)


@query
def prior_year_join(t: Stages):
    ahead = forecasting.horizon_rows(
        t.seasonal, forecasting.forecast_calendar(t.seasonal, ForecastConfig()), K6
    )
    return panels.prior_year_join(ahead, t.seasonal, K6, ["seasonality"])


def _series(t: Stages, semantics: str):
    rows, config = t.seasonal_of(semantics), ForecastConfig(semantics=semantics)
    calendar = forecasting.forecast_calendar(rows, config)
    series = forecasting.first_years(rows, K6)
    return forecasting.series_frame(series, rows, calendar, config)


@query
def base_window_ref(t: Stages):
    return _series(t, REFERENCE).select(*K6, "base_qty", "base_seasonality")


@query
def base_window_cor(t: Stages):
    return _series(t, CORRECTED).select(*K6, "base_qty", "base_seasonality")


def _line_series(t: Stages, semantics: str):
    rows, config = t.line_values, ForecastConfig(semantics=semantics)
    calendar = forecasting.forecast_calendar(rows, config)
    series = forecasting.first_years(rows, K6)
    return forecasting.series_frame(series, rows, calendar, config).select(*K6, "base_qty", "base_seasonality")


@query
def base_window_lines_ref(t: Stages):
    return _line_series(t, REFERENCE)


@query
def base_window_lines_cor(t: Stages):
    return _line_series(t, CORRECTED)


@query
def base_level_ref(t: Stages):
    return _series(t, REFERENCE).select(*K6, "fcst")


@query
def base_level_cor(t: Stages):
    return _series(t, CORRECTED).select(*K6, "fcst")


def _week_seasonality(t: Stages, semantics: str):
    rows, config = t.seasonal_of(semantics), ForecastConfig(semantics=semantics)
    calendar = forecasting.forecast_calendar(rows, config)
    series = forecasting.first_years(rows, K6)
    frame = forecasting.forecast_frame(series, rows, calendar, config, K6)
    return frame.select(*K6, "yearweek", "seasonality")


@query
def week_of_year_seasonality_ref(t: Stages):
    return _week_seasonality(t, REFERENCE)


@query
def week_of_year_seasonality_cor(t: Stages):
    return _week_seasonality(t, CORRECTED)


@query
def forecast_ref(t: Stages):
    return forecasting.forecast(t.seasonal)


@query
def forecast_cor(t: Stages):
    return forecasting.forecast(t.seasonal_cor, ForecastConfig(semantics=CORRECTED))


@query
def forecast_drop_zero(t: Stages):
    return forecasting.forecast(t.seasonal, drop_zero=True)


# Parameters and the re-forecast


@query
def param_validate(t: Stages):
    return parameters.validate_params(t.typed_entries)


@query
def param_append(t: Stages):
    table = parameters.resolve_params(t.entries)
    return parameters.append_params(table, t.typed_entries)


@query
def param_update(t: Stages):
    return parameters.update_param(t.typed_entries, "average_window", UPDATED_WINDOW)


@query
def param_versions(t: Stages):
    path = t.rewritten("parameters")
    parameters.write_version(parameters.resolve_params(t.entries), path)
    appended = parameters.append_params(parameters.read_version(t.spark, path), t.typed_entries)
    parameters.write_version(appended, path)
    updated = parameters.update_param(parameters.read_version(t.spark, path), "average_window", UPDATED_WINDOW)
    parameters.write_version(updated, path)
    return parameters.read_version(t.spark, path)


@query
def param_edits(t: Stages):
    table = VersionedTable(t.spark, t.rewritten("kept_parameters"))
    table.replace(parameters.resolve_params(t.entries))
    parameters.append_to(table, t.typed_entries)
    parameters.update_in(table, "average_window", UPDATED_WINDOW)
    return table.read()


#: Keys of a mart's rows.
_MART_KEY = ["regionseg", "regionseg3", "salesid", "productgroup", "item", "yearweek"]


def _edited_mart(t: Stages, compacted: bool) -> DataFrame:
    """The mart after an update, an append, a deletion and another update, made as keyed edits."""
    table = VersionedTable(t.spark, t.rewritten("kept_mart"))
    table.replace(t.mart, partition_by=["year"], sort_by=jobs.MART_ORDER)
    group = t.mart.where((F.col("productgroup") == GROUP) & (F.col("week") == "10"))
    table.update(group.groupBy(*_MART_KEY).agg((F.max("qty") + 1000).alias("qty")), _MART_KEY)
    table.append(t.mart.where((F.col("productgroup") == GROUP) & (F.col("week") == "30")).withColumn("fcst", F.lit(-1.0)))
    table.delete(t.mart.where((F.col("item") == ITEM) & (F.col("week") == "20")), ["item", "yearweek"])
    if compacted:
        table.compact(partition_by=["year"], sort_by=jobs.MART_ORDER)
    region = t.mart.where((F.col("regionseg") == REGION) & (F.col("week") == "30")).select("regionseg", "yearweek").distinct()
    table.update(region.withColumn("ir", F.lit(7)), ["regionseg", "yearweek"])
    return table.read()


@query
def mart_edits(t: Stages):
    return _edited_mart(t, compacted=False)


@query
def mart_edits_compacted(t: Stages):
    return _edited_mart(t, compacted=True)


@query
def reforecast_published(t: Stages):
    table = VersionedTable(t.spark, t.rewritten("published_mart"))
    table.replace(t.mart, partition_by=["year"], sort_by=jobs.MART_ORDER)
    jobs.republish(table, lambda: t.parameter_table)
    return table.read()


@query
def resolve_params(t: Stages):
    return parameters.resolve_params(t.entries)


@query
def reforecast_ref(t: Stages):
    return jobs.reforecast_with_params(t.mart, t.parameter_table)


def _upper(df: DataFrame) -> DataFrame:
    return files.normalize_columns(df, upper=True)


@query
def reforecast_upper_columns(t: Stages):
    return jobs.reforecast_with_params(_upper(t.mart), t.parameter_table)


@query
def reforecast_job(t: Stages):
    mart, result = t.rewritten("job_mart"), t.rewritten("job_result")
    files.write_table(_upper(t.mart), mart)
    jobs.run_reforecast(
        lambda: t.parameter_table,
        lambda: files.read_table(t.spark, mart),
        lambda rows: files.write_table(_upper(rows), result),
    )
    return files.read_table(t.spark, result, schemas.MART)


@query
def reforecast_recompute(t: Stages):
    return jobs.reforecast_with_params(t.mart, t.parameter_table, recompute=True)


@query
def reforecast_cor(t: Stages):
    return jobs.reforecast_with_params(t.mart, t.parameter_table, semantics=CORRECTED)


@query
def reforecast_recompute_cor(t: Stages):
    return jobs.reforecast_with_params(
        t.mart, t.parameter_table, recompute=True, semantics=CORRECTED
    )


@query
def reforecast_earlier_ref(t: Stages):
    return jobs.reforecast_with_params(t.mart, t.earlier_parameter_table, recompute=True)


@query
def reforecast_earlier_cor(t: Stages):
    return jobs.reforecast_with_params(
        t.mart, t.earlier_parameter_table, recompute=True, semantics=CORRECTED
    )


@query
def cut_history(t: Stages):
    latest = keyed.scalar_of(t.sales, F.max("yearweek"))
    return forecasting.cut_history(t.mart, latest)


@query
def trailing_output(t: Stages):
    return forecasting.trailing_output(t.mart, ForecastConfig(base_back=4))


# Mart


@query
def final_mart(t: Stages):
    return browse.final_mart(forecasting.forecast(t.seasonal))


@query
def display_view(t: Stages):
    return browse.display_view(t.mart)


@query
def mart_before(t: Stages):
    return browse.mart_filter(t.mart, GROUP, before=BEFORE_WEEK)


@query
def mart_after(t: Stages):
    return browse.mart_filter(t.mart, GROUP, after=AFTER_WEEK)


@query
def drill_down(t: Stages):
    return browse.drill_down(
        t.mart, regionseg=REGION, regionseg3=SITE, productgroup=GROUP, item=ITEM
    )


@query
def drill_down_series(t: Stages):
    arrays = browse.drill_down_series(t.mart, regionseg=REGION, productgroup=GROUP)
    keys = ["regionseg", "regionseg3", "productgroup", "item"]
    return arrays.select(*keys, F.posexplode("points").alias("pos", "point")).select(
        *keys, "pos", "point.yearweek", "point.value"
    )


@query
def item_series(t: Stages):
    return browse.item_series(t.mart, SITE, ITEM)


@query
def item_series_clustered(t: Stages):
    return browse.item_series(t.browse_mart, SITE, ITEM)


@query
def drill_down_clustered(t: Stages):
    return browse.drill_down(t.browse_mart, regionseg=REGION, regionseg3=SITE, productgroup=GROUP, item=ITEM)


@query
def item_list(t: Stages):
    return browse.item_list(t.mart)


@query
def row_count(t: Stages):
    return keyed.row_count(t.mart)


@query
def series_array(t: Stages):
    arrays = browse.series_array(t.mart)
    return arrays.select("regionseg3", "item", F.posexplode("points").alias("pos", "point")).select(
        "regionseg3", "item", "pos", "point.yearweek", "point.value"
    )


@query
def chart_points(t: Stages):
    return browse.chart_points(browse.series_array(t.mart, value="qty"))
