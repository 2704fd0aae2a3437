"""The shape of the physical plans: what is shuffled, split and pushed down."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.data import KEY, golden_rows, mart_frame, panel_row, seasonal_frame
from weekcast.config import CORRECTED, REFERENCE, ForecastConfig
from weekcast.plans.registry import QUERIES
from weekcast.operators import browse, forecasting, keyed, panel, promotions
from weekcast.operators import seasonality as seasonal
from weekcast.sources import schemas

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    plan = plan_of(df)
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_no_query_leaves_the_jvm_or_crosses_rows(spark):
    for name, make in QUERIES.items():
        plan = plan_of(make(spark, SF_DIR))
        for word in ("Python", "Arrow", "MapPartitions", "CartesianProduct", "BroadcastNestedLoop",
                     "ExistingRDD"):
            assert word not in plan, f"{name}: {word}"


def _written(spark, tmp_path, df):
    path = f"{tmp_path}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_constant_cutoff_reaches_the_scan(spark, tmp_path):
    mart = _written(spark, tmp_path, mart_frame(spark, [("201610", 1, 1, 1), ("201552", 1, 1, 1)]))
    plan = plan_of(forecasting.reforecast(mart, ForecastConfig(max_week="201610")))
    assert "LessThanOrEqual(yearweek,201610)" in plan
    assert "GreaterThanOrEqual(yearweek,201607)" in plan


def test_series_frame_reads_only_what_it_needs(spark, tmp_path):
    rows = _written(spark, tmp_path, seasonal_frame(spark, [("201610", 1, 1)]))
    frame = forecasting.first_years(rows, schemas.PANEL_KEY)
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(frame)).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {*schemas.PANEL_KEY, "yearweek"}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_grouped_aggregates_are_hashed(spark):
    for name in ("series_bounds", "week_calendar", "gap_fill", "seasonality_ref", "forecast_ref",
                 "reforecast_recompute", "series_array", "price_refinement"):
        assert "SortAggregate" not in plan_of(QUERIES[name](spark, SF_DIR)), name
    from weekcast.sources import star_schema

    weekly = star_schema.weekly_lines(spark, SF_DIR)
    for frame in (weekly, star_schema.sales(weekly), star_schema.promotions(weekly)):
        assert "SortAggregate" not in plan_of(frame)


def test_browsing_filters_reach_the_scan(spark, tmp_path):
    mart = _written(spark, tmp_path, mart_frame(spark, [("201610", 1, 1, 1)]))
    plan = plan_of(browse.mart_filter(mart, "PG01", before=201620))
    assert "EqualTo(productgroup,PG01)" in plan and "LessThan(yearweek,201620)" in plan
    plan = plan_of(browse.drill_down(mart, regionseg3="S", item="I"))
    assert "EqualTo(regionseg3,S)" in plan and "EqualTo(item,I)" in plan
    plan = plan_of(browse.item_series(mart, "S", "I"))
    assert "ReadSchema: struct<regionseg3:string,item:string,yearweek:string,time_series:double>" in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_week_bounds_leave_out_years(spark):
    for name in ("reforecast_ref", "reforecast_cor", "mart_before", "mart_after", "trailing_output"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert re.search(r"PartitionFilters: \[[^\]]", plan), name


def test_a_panel_by_week_has_few_years_to_a_file(spark, tmp_path):
    import pyarrow.parquet as pq

    from weekcast.plans import jobs

    labels = [f"{year}{week:02d}" for year in range(1990, 2020) for week in range(1, 53)]
    rows = seasonal_frame(spark, [(w, 1, 1) for w in labels])
    sizes = ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")
    for name in sizes:
        spark.conf.set(f"spark.sql.adaptive.{name}", "2KB")
    try:
        jobs.write_by_week(rows, str(tmp_path), "panel")
    finally:
        for name in sizes:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    years = []
    for path in tmp_path.glob("*/*.parquet"):
        found = pq.read_table(path, columns=["yearweek"])["yearweek"].to_pylist()
        assert found == sorted(found)
        years.append(len({w[:4] for w in found}))
    assert sum(years) == 30 and len(years) > 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_order_lines_are_read_once_and_look_ups_read_a_stage(spark):
    from weekcast.sources import star_schema

    assert plan_of(star_schema.weekly_lines(spark, SF_DIR)).count("l_orderkey") > 0
    for name in ("qty_lookup", "dedupe_first", "sales_promo_join"):
        assert "lineitem" not in plan_of(QUERIES[name](spark, SF_DIR)), name


def test_recent_weeks_reach_the_scan_as_a_subquery(spark, tmp_path):
    rows = _written(spark, tmp_path, seasonal_frame(spark, [("201610", 1, 1)]))
    assert "GreaterThanOrEqual(yearweek,ScalarSubquery" in plan_of(forecasting.drop_inactive(rows))


def test_original_rows_are_not_shuffled_by_gap_fill(spark, no_broadcast):
    df = spark.createDataFrame([panel_row(*r) for r in golden_rows()], schemas.JOINED_SALES)
    assert shuffles(panel.gap_fill(df)) == 2  # distinct weeks, then the window over them


def test_moving_average_shuffles(spark, no_broadcast):
    rows = [(*panel_row(*r), "N") for r in golden_rows()]
    df = spark.createDataFrame(rows, schemas.PANEL)
    for semantics in (REFERENCE, CORRECTED):
        # weekly totals, window, and both sides of the join back.
        assert shuffles(seasonal.moving_average(df, 5, semantics)) == 4


def test_hot_keys_are_split(spark, no_broadcast, tmp_path):
    """One key holding most rows: each look-up join must be cut by adaptive execution."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string"))
        # Written by several tasks, so that the hot partition comes in many pieces.
        base = spark.range(0, 600_000, 1, 24).withColumn("item", hot)
        padding = F.sha2(F.col("id").cast("string"), 256)
        promo = base.select(
            F.lit("A01").alias("regionseg"), F.lit("S").alias("salesid"),
            F.lit("PG").alias("productgroup"), "item", F.lit("201401").alias("targetweek"),
            F.lit("201401").alias("planweek"), F.col("id").alias("map_price"),
            F.col("id").alias("ir"), padding.alias("note"),
        )
        weekly = base.select(
            *[F.lit(v).alias(n) for n, v in zip(schemas.SERIES_KEY[:4], KEY)], "item",
            F.lit(None).cast("string").alias("productseg1"), F.lit("201401").alias("yearweek"),
            F.col("id").cast("double").alias("qty"), padding.alias("note"),
        )
        sales = weekly.select(
            F.col("regionseg").alias("regionSeg1"), F.col("salesid").alias("regionSeg2"),
            F.col("productgroup").alias("productSeg2"), F.col("item").alias("productSeg3"),
            F.col("regionseg3").alias("regionSeg3"), "yearweek", "qty", "note",
        )
        plans = sales.select(
            F.col("regionSeg1").alias("regionseg"), F.col("regionSeg2").alias("salesid"),
            F.col("productSeg2").alias("productgroup"), F.col("productSeg3").alias("item"),
            F.col("yearweek").alias("targetweek"),
        ).distinct()
        measured = plans.withColumns({m: F.lit(1) for m in schemas.PROMOTION_MEASURES})
        # A promotion table is read, not aggregated, before this join.
        measured = _written(spark, tmp_path, measured)
        for df in (
            panel.join_promotions(sales, measured, project="sales"),
            keyed.match_null_safe(
                promo, promotions.avg_nonzero_price(promo), schemas.PROMOTION_KEY, "left"
            ),
            seasonal.moving_average(weekly),
            keyed.exists_in(weekly, weekly.filter("qty > 3"), schemas.PANEL_KEY),
            keyed.lookup(weekly, weekly, ["item", "yearweek"], {"qty": "first_qty"}),
        ):
            df.write.format("noop").mode("overwrite").save()
            executed = df.groupBy().agg(F.count("note").alias("n"))
            assert executed.collect()[0].n == 600_000
            assert "skew=true" in plan_of(executed), plan_of(executed)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
