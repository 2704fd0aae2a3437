import pytest

from tests.data import KEY, mart_frame, seasonal_frame
from weekcast.config import ForecastConfig
from weekcast.functions.weeks import agreeing_years, check_years
from weekcast.operators import browse, forecasting
from weekcast.sources import schemas

LATE = ("A01", "SITEID0002", "SALESID0002", "PG02", "ITEM0002")


@pytest.fixture(scope="module")
def mart(spark):
    rows = [(f"2016{w:02d}", w, 1, 1, k) for w in range(8, 13) for k in (KEY, LATE)]
    return mart_frame(spark, rows)


def test_final_mart(spark):
    df = forecasting.forecast(seasonal_frame(spark, [("201552", 1, 1.0)]))
    out = browse.final_mart(df)
    assert out.columns == schemas.MART_COLUMNS
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.MART]
    assert {(r.year, r.week, r.promotionNY) for r in out.collect()} >= {("2015", "52", 0), ("2016", "01", 0)}
    assert browse.display_view(out).columns == [c for c in schemas.MART_COLUMNS if c not in ("year", "week")]
    assert len(browse.display_view(out).columns) == 17


def test_filters(mart):
    weeks = lambda df: sorted(r.yearweek for r in df.collect())
    assert weeks(browse.mart_filter(mart, "PG01", before=201610)) == ["201608", "201609"]
    assert weeks(browse.mart_filter(mart, "PG01", after=201610)) == ["201611", "201612"]
    out = browse.drill_down(mart, regionseg="A01", regionseg3="SITEID0002", item="ITEM0002")
    assert [r.yearweek for r in out.collect()] == ["201608", "201609", "201610", "201611", "201612"]
    assert browse.drill_down(mart, item="x' OR '1'='1").count() == 0
    with pytest.raises(ValueError):
        browse.drill_down(mart, qty="1")


def test_week_bounds_outside_six_digits(mart):
    assert browse.mart_filter(mart, "PG01", before=3_000_000).count() == 5
    assert browse.mart_filter(mart, "PG01", after=99).count() == 5
    assert browse.mart_filter(mart, "PG01", before=99).count() == 0


def test_series(spark, mart):
    rows = browse.item_series(mart, "SITEID0001", "ITEM0001", "qty").collect()
    assert [(r.yearweek, r.qty) for r in rows] == [(f"2016{w:02d}", float(w)) for w in range(8, 13)]
    assert [r.item for r in browse.item_list(mart).collect()] == ["ITEM0001", "ITEM0002"]
    doubled = mart.unionByName(mart_frame(spark, [("201608", 99, 1, 1)]))
    arrays = {r.item: r.points for r in browse.series_array(doubled, value="qty").collect()}
    assert [(p.yearweek, p.value) for p in arrays["ITEM0001"]][:2] == [("201608", 99.0), ("201609", 9.0)]
    text = browse.chart_points(browse.series_array(mart, value="qty")).filter("item = 'ITEM0001'").first()
    assert text.points.startswith("['201608', 8.0],['201609', 9.0]")


def test_rows_without_a_year_count_by_their_week(spark):
    rows = spark.createDataFrame([("201601", "2016", "G", 1.0), ("201602", None, "G", 2.0), ("201501", None, "G", 3.0), ("201552", "2015", "G", 4.0)], "yearweek string, year string, productgroup string, qty double")
    weeks = lambda df: sorted(r.yearweek for r in df.collect())
    assert weeks(browse.mart_filter(rows, "G", after=201552)) == ["201601", "201602"]
    assert weeks(browse.mart_filter(rows, "G", before=201601)) == ["201501", "201552"]
    assert weeks(forecasting.cut_history(rows, "201552")) == ["201501", "201552"] and forecasting.latest_week(rows) == "201602"
    assert weeks(forecasting.trailing_output(rows, ForecastConfig(base_back=0))) == ["201602"]


def test_years_that_disagree_with_their_weeks_are_errors(spark):
    rows = spark.createDataFrame([("201601", "2016"), ("201602", "2015"), ("201603", None)], "yearweek string, year string")
    with pytest.raises(ValueError, match="year 2015 does not fit week 201602"):
        check_years(rows)
    check_years(rows.where("yearweek <> '201602'"))
    with pytest.raises(Exception, match="year 2015 does not fit week 201602"):
        agreeing_years(rows).collect()
    assert agreeing_years(rows.where("yearweek <> '201602'")).count() == 2
