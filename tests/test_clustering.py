"""Z-ordered tables: the same rows, and most row groups passed over for a filter on any of the columns."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekcast.operators import browse
from weekcast.plans import jobs, registry
from weekcast.sources import clustering, files, schemas
from weekcast.sources.clustering import rank, rank_bounds, write_clustered, z_value

SF = "/root/testdata/sf0.01"


def read_rows(df):
    """Rows that the scans of a query hand on: those of the row groups that were not passed over."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, found = [plan.executedPlan() if "Adaptive" in plan.nodeName() else plan], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().get("numOutputRows").get().value()
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
    return found


@pytest.fixture(scope="module")
def grid(spark, tmp_path_factory):
    """200,000 rows over 300 sites, 400 items and a hot item with a third of them."""
    item = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("item%03d", F.col("id") * 7919 % 400))
    rows = spark.range(200_000).select(item.alias("item"), F.format_string("site%03d", F.xxhash64("id") % 150 + 150).alias("site"), "id")
    path = str(tmp_path_factory.mktemp("z") / "t")
    write_clustered(rows, path, ["site", "item"], then_by=["id"], files=32, row_group_bytes=64 << 10)
    return rows, spark.read.parquet(path)


def test_the_same_rows_come_back(grid):
    rows, laid = grid
    assert laid.columns == rows.columns and laid.count() == rows.count()
    assert laid.exceptAll(rows).count() == rows.exceptAll(laid).count() == 0


@pytest.mark.parametrize("condition, share", [("site = 'site017'", 0.2), ("item = 'item123'", 0.2), ("site = 'site017' AND item = 'item123'", 0.03), ("site BETWEEN 'site010' AND 'site019'", 0.3)])
def test_filters_on_either_column_read_a_part(grid, condition, share):
    rows, laid = grid
    assert laid.where(condition).select("id").exceptAll(rows.where(condition).select("id")).count() == 0
    assert laid.where(condition).count() == rows.where(condition).count() > 0 or "AND item" in condition
    assert read_rows(laid.where(condition).select("id")) <= share * 200_000


def test_a_hot_value_lies_in_several_files(grid):
    _, laid = grid
    sizes = laid.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 16 and max(r["count"] for r in sizes) < 0.1 * 200_000


@given(st.lists(st.integers(-50, 50), unique=True, max_size=40), st.integers(1, 5))
@settings(max_examples=15, deadline=None)
def test_ranks_are_counts_of_bounds(spark, bounds, bits):
    bounds = sorted(bounds)
    values = spark.createDataFrame([(k,) for k in range(-52, 53)] + [(None,)], "v int")
    for v, r in values.select("v", rank(F.col("v"), bounds)).collect():
        assert r == (0 if v is None else sum(b <= v for b in bounds))


def test_z_values_take_bits_in_turns(spark):
    pairs = spark.createDataFrame([(x, y) for x in range(16) for y in range(16)], "x int, y int")
    for x, y, z in pairs.select("x", "y", z_value([F.col("x"), F.col("y")], 4)).collect():
        assert z == sum((x >> b & 1) << 2 * b + 1 | (y >> b & 1) << 2 * b for b in range(4))


def test_bounds_of_odd_columns(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (None, "b")], "none string, few string")
    assert rank_bounds(rows, ["none", "few"]) == {"none": [], "few": ["b"]}
    assert rank_bounds(rows.limit(0), ["few"]) == {"few": []}
    many = spark.range(100_000).select(F.col("id").cast("string").alias("v"))
    bounds = rank_bounds(many, ["v"])["v"]
    assert len(bounds) == 255 and bounds == sorted(set(bounds))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_browsing_reads_a_part_of_the_mart(spark, tmp_path):
    mart = registry.stages(spark, SF).mart
    path = str(tmp_path / "mart")
    jobs.write_browse_mart(mart, path, files=16, row_group_bytes=64 << 10)
    laid, rows = files.read_table(spark, path, schemas.MART), mart.count()
    some = mart.select("regionseg3", "item", "regionseg", "productgroup").first()
    series = lambda table: browse.item_series(table, some.regionseg3, some.item)
    down = lambda table: browse.drill_down(table, regionseg=some.regionseg, regionseg3=some.regionseg3, productgroup=some.productgroup, item=some.item)
    for made in (series, down, lambda table: browse.drill_down(table, item=some.item), lambda table: browse.drill_down(table, regionseg3=some.regionseg3)):
        assert sorted(map(str, made(laid).collect())) == sorted(map(str, made(mart).collect()))
    assert read_rows(browse.drill_down_rows(laid, item=some.item)) < 0.5 * rows
    assert read_rows(browse.drill_down_rows(laid, item=some.item, regionseg3=some.regionseg3)) < 0.2 * rows
