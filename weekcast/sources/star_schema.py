"""Sales, promotion and parameter tables derived from an order star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.config import AVERAGE_WINDOW, BASE_DATA, PREDICT_RANGE
from weekcast.functions.weeks import date_year_week
from weekcast.sources.files import read_table


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their keys; join strategies are left to Spark's size checks.

    Derived columns are computed on the small tables before the joins, and dates
    are only cut to their Monday here: labels are made after aggregating.
    """
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    parts = _table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_type").alias("productgroup"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("item"),
    )
    nations = _table(spark, folder, "nation")
    regions = _table(spark, folder, "region")
    places = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    customers = _table(spark, folder, "customer")
    buyers = customers.join(places, customers.c_nationkey == places.n_nationkey).select(
        "c_custkey",
        F.lit("A01").alias("regionseg"),
        F.col("c_mktsegment").alias("salesid"),
        F.col("r_name").alias("regionseg3"),
    )
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(buyers, orders.o_custkey == buyers.c_custkey)
        .withColumn("ship_monday", F.trunc("l_shipdate", "week"))
    )


def _as_sales(rows: DataFrame, quantity: str) -> DataFrame:
    return rows.select(
        F.col("regionseg").alias("regionSeg1"),
        F.lit(None).cast("string").alias("productSeg1"),
        F.col("productgroup").alias("productSeg2"),
        F.col("salesid").alias("regionSeg2"),
        F.col("regionseg3").alias("regionSeg3"),
        F.col("item").alias("productSeg3"),
        date_year_week(F.col("ship_monday")).alias("yearweek"),
        F.col(quantity).alias("qty"),
    )


def sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Sales columns for every order line: a week of a series has many rows."""
    return _as_sales(_order_lines(spark, folder), "l_quantity")


def weekly_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines summed up per region, key and Monday: sales and promotions both roll up from it.

    The price counts as unknown where R is the lowest return flag; two boolean
    aggregates say so without sorting the lines, as a minimum over text would.
    """
    flag, cheap = F.col("l_returnflag"), F.col("l_discount") >= 0.05
    return (
        _order_lines(spark, folder)
        .groupBy("regionseg", "salesid", "regionseg3", "productgroup", "item", "ship_monday")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.min(F.when(cheap, F.col("o_orderdate"))).alias("first_order"),
            F.bool_and(F.when(cheap, flag >= "R")).alias("from_r_on"),
            F.bool_or(F.when(cheap, flag == "R")).alias("any_r"),
            F.max(F.when(cheap, F.col("l_extendedprice") / F.col("l_quantity"))).alias("unit_price"),
            F.max(F.when(cheap, F.col("l_discount"))).alias("discount"),
        )
    )


def sales(weekly: DataFrame) -> DataFrame:
    """Weekly sales: one row per series and week."""
    return _as_sales(weekly, "quantity")


def promotions(weekly: DataFrame) -> DataFrame:
    """Promotions: discounted lines summarised per key and week, over all regions."""
    rolled = (
        weekly.filter(F.col("first_order").isNotNull())
        .groupBy("regionseg", "salesid", "productgroup", "item", "ship_monday")
        .agg(
            F.min("first_order").alias("first_order"),
            F.bool_and("from_r_on").alias("from_r_on"),
            F.bool_or("any_r").alias("any_r"),
            F.max("unit_price").alias("unit_price"),
            F.max("discount").alias("discount"),
        )
    )
    lowest_is_r = F.col("from_r_on") & F.col("any_r")
    price = F.when(lowest_is_r, F.lit(0)).otherwise(F.floor("unit_price"))
    return rolled.select(
        "regionseg",
        "salesid",
        "productgroup",
        "item",
        date_year_week(F.col("ship_monday")).alias("targetweek"),
        date_year_week(F.col("first_order")).alias("planweek"),
        price.cast("bigint").alias("map_price"),
        F.floor(F.col("unit_price") * F.col("discount")).cast("bigint").alias("ir"),
        F.lit(0.0).alias("pmap"),
        F.lit(0.0).alias("pmap10"),
        F.lit(0.0).alias("pro_percent"),
    )


def line_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as rows of a seasonality table: many rows of a series and week, whose quantity and
    seasonality (the discount) do not rise together, and a product segment on some of them."""
    flag = F.col("l_returnflag")
    return _order_lines(spark, folder).select(
        "regionseg",
        F.when(flag != "N", flag).alias("productseg1"),
        "productgroup",
        "salesid",
        "regionseg3",
        "item",
        date_year_week(F.col("ship_monday")).alias("yearweek"),
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("seasonality"),
    )


def parameter_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Parameter entries typed by users, one per event; values are numeric text."""
    kind = F.col("event_type")
    name = (
        F.when(kind == "click", F.lit(AVERAGE_WINDOW))
        .when(kind == "view", F.lit(PREDICT_RANGE))
        .when(kind == "purchase", F.lit(BASE_DATA))
        .otherwise(kind)
    )
    return _table(spark, folder, "events").select(
        name.alias("parameter"), F.col("value").cast("string").alias("value")
    )
