"""The user-level jobs: from raw sales and promotions to the mart and back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.config import REFERENCE, ForecastConfig
from weekcast.functions.weeks import agreeing_years, check_years, year_of
from weekcast.operators.browse import final_mart
from weekcast.operators.forecasting import forecast, reforecast
from weekcast.operators.panel import gap_fill, join_promotions, promotion_flag
from weekcast.operators.parameters import config_from_params
from weekcast.operators.promotions import filter_valid_promotions, refine_prices
from weekcast.operators.seasonality import add_seasonality
from weekcast.sources.clustering import write_clustered
from weekcast.sources.schemas import MART, PROMOTION, SALES, conform
from weekcast.sources.shared import shared_folder, write_stage
from weekcast.sources.versions import VersionedTable

#: Order of a mart's rows inside a year: product group and item first, which browsing filters on.
MART_ORDER = ["productgroup", "item", "regionseg3", "yearweek"]


def write_mart(mart: DataFrame, folder: str, name: str = "mart") -> DataFrame:
    """Write a mart by year, its files in an order that lets a reader skip product groups."""
    return write_stage(agreeing_years(conform(mart, MART)), folder, name, partition_by=["year"], sort_by=MART_ORDER)


def write_browse_mart(mart: DataFrame, path: str, **layout) -> None:
    """Write a mart for browsing: filters on group, site or item, alone or together, read a small part of it in any year."""
    rows = agreeing_years(conform(mart, MART))
    write_clustered(rows, path, ["productgroup", "regionseg3", "item"], then_by=["yearweek"], **layout)


def price_promotions(promo: DataFrame) -> DataFrame:
    """Valid promotions at their refined prices."""
    return refine_prices(filter_valid_promotions(conform(promo, PROMOTION)))


def build_panel(sales: DataFrame, promo: DataFrame) -> DataFrame:
    """Sales with refined promotions, all weeks present, promotions flagged."""
    return promotion_flag(gap_fill(join_promotions(conform(sales, SALES), price_promotions(promo))))


def write_by_week(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a panel with few years to a file, in week order: the recent weeks lie in few files."""
    year = year_of(F.col("yearweek"))
    return write_stage(rows, folder, name, sort_by=["yearweek", "productgroup", "item"], cluster_by=year)


@dataclass(frozen=True)
class StagedMart:
    """Tables written by :func:`run_stages`, as scans."""

    joined: DataFrame
    panel: DataFrame
    seasonality: DataFrame
    mart: DataFrame


def run_stages(
    spark: SparkSession,
    sales: DataFrame,
    promo: DataFrame,
    config: ForecastConfig = ForecastConfig(),
    folder: str | None = None,
) -> StagedMart:
    """Run the job from raw tables to the mart, writing a table after each stage.

    Later stages read a stage several times with different columns.  Reading a
    written table keeps those reads narrow and ends the lineage.
    """
    target = folder or shared_folder(spark)
    joined = write_stage(join_promotions(conform(sales, SALES), price_promotions(promo)), target, "joined")
    panel = write_stage(promotion_flag(gap_fill(joined)), target, "panel")
    seasonal = write_by_week(
        add_seasonality(panel, config.average_window, config.semantics), target, "seasonality"
    )
    mart = write_mart(final_mart(forecast(seasonal, config)), target)
    return StagedMart(joined, panel, seasonal, mart)


def reforecast_with_params(
    mart: DataFrame, params: DataFrame, recompute: bool = False, semantics: str = REFERENCE
) -> DataFrame:
    """Forecast again with the settings of a parameter table."""
    return reforecast(mart, config_from_params(params, semantics), recompute)


def run_reforecast(
    read_params: Callable[[], DataFrame],
    read_mart: Callable[[], DataFrame],
    write_result: Callable[[DataFrame], None],
    recompute: bool = False,
    semantics: str = REFERENCE,
) -> None:
    """The production job: parameter table and mart from any source, the result to any sink.

    Readers and writers are those of ``sources``, a database's or a table's; the mart's names may be in any case.
    A row whose year is missing counts by its week; one whose year is not that of its week ends the job.
    """
    mart = conform(read_mart(), MART)
    check_years(mart)
    write_result(reforecast_with_params(mart, read_params(), recompute, semantics))


def republish(
    table: VersionedTable, read_params: Callable[[], DataFrame], recompute: bool = False, semantics: str = REFERENCE
) -> int:
    """Forecast a kept mart again and put the result in its place, all at once.  Returns the version's number.

    Readers see the old mart or the new one; a failure in between leaves the old one, and a change that somebody
    commits meanwhile is an error rather than lost.
    """
    based_on = table.commit().number
    rows = reforecast_with_params(conform(table.read(based_on), MART), read_params(), recompute, semantics)
    return table.replace(agreeing_years(conform(rows, MART)), expected=based_on, partition_by=["year"], sort_by=MART_ORDER)
