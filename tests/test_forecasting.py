import pytest
from pyspark.sql import functions as F

from tests.data import KEY, by_week, mart_frame, panel_row, seasonal_frame
from weekcast.config import CORRECTED, REFERENCE, ForecastConfig
from weekcast.operators import forecasting as fc
from weekcast.operators import seasonality as seasonal
from weekcast.operators.panel import prior_year_join
from weekcast.sources import schemas

LATE = ("A01", "SITEID0002", "SALESID0001", "PG01", "ITEM0001")


def _forecast_weeks(df):
    return df.filter("yearweek > '201603'")


@pytest.mark.parametrize(
    "y2013, y2014, y2015, reference, mean",
    [(1.0, 2.0, 4.0, 1.8333333333333333, 2.3333333333333335), (1.0, 2.0, None, 0.75, 1.5),
     (2.0, None, 4.0, 3.0, 3.0)],
)
def test_week_of_year_seasonality(spark, y2013, y2014, y2015, reference, mean):
    rows = [(w, 5, s) for w, s in (("201305", y2013), ("201405", y2014), ("201505", y2015)) if s]
    rows += [("201301", 1, 1.0), ("201604", 4, 1.0)]
    df = seasonal_frame(spark, rows)
    for semantics, expected in ((REFERENCE, reference), (CORRECTED, mean)):
        out = by_week(fc.forecast(df, ForecastConfig(semantics=semantics)), "seasonality")
        assert out["201605"] == pytest.approx(expected, rel=1e-12)


def test_forecast_without_earlier_years_is_zero(spark):
    df = seasonal_frame(spark, [("201610", 4, 1.0), ("201611", 6, 1.5)])
    for semantics in (REFERENCE, CORRECTED):
        out = fc.forecast(df, ForecastConfig(semantics=semantics)).filter("yearweek > '201611'")
        rows = out.collect()
        assert len(rows) == 5
        assert all(r.seasonality == 0 and r.time_series == 0 and r.fcst == 2.5 for r in rows)
        assert all(r.promotionNY == "N" and r.qty == 0 and r.moving_avg == 0 for r in rows)


def test_forecast_week_53_skips_years_without_it(spark):
    rows = [("201452", 2, 3.0), ("200953", 2, 5.0), ("201552", 4, 1.0)]
    df = seasonal_frame(spark, rows)
    for semantics in (REFERENCE, CORRECTED):
        config = ForecastConfig(predict_range=1, semantics=semantics)
        out = by_week(fc.forecast(df, config), "seasonality")
        assert out["201553"] == 5.0


def test_inactive_series(spark):
    rows = [("201620", 1, 1.0), ("201627", 1, 1.0), ("201619", 1, 1.0, LATE)]
    df = seasonal_frame(spark, rows)
    assert fc.drop_inactive(df).select("regionseg3").distinct().count() == 1
    kept = seasonal_frame(spark, [*rows[:2], ("201620", 1, 1.0, LATE)])
    assert fc.drop_inactive(kept).count() == 3
    out = fc.forecast(df)
    assert out.count() == 2 + 5 and out.filter("regionseg3 = 'SITEID0002'").count() == 0


def test_zero_demand_series(spark):
    rows = [("201619", 9, 1.0), ("201620", 0, 1.0), ("201627", 0, 1.0), ("201627", 3, 1.0, LATE)]
    df = seasonal_frame(spark, rows)
    assert [r.regionseg3 for r in fc.drop_zero_demand(df).collect()] == ["SITEID0002"]
    assert fc.forecast(df).select("regionseg3").distinct().count() == 2
    assert fc.forecast(df, drop_zero=True).select("regionseg3").distinct().count() == 1


@pytest.mark.parametrize("asked, weeks", [(5, 5), (1, 1), (0, 1), (-3, 1)])
def test_horizon_has_at_least_one_week(spark, asked, weeks):
    df = seasonal_frame(spark, [("201551", 1, 1.0), ("201550", 1, 1.0, LATE)])
    out = fc.extend_horizon(df, ForecastConfig(predict_range=asked))
    ahead = [r.yearweek for r in out.filter("yearweek > '201551'").collect()]
    assert len(ahead) == 2 * weeks and out.count() == 2 + 2 * weeks
    assert set(ahead) == set(["201552", "201553", "201601", "201602", "201603"][:weeks])


def test_duplicate_weeks_use_one_value_and_keep_both_rows(spark):
    rows = [(*panel_row(w, q), "N") for w, q in (("201501", 4), ("201501", 10), ("201502", 8))]
    out = seasonal.moving_average(spark.createDataFrame(rows, schemas.PANEL))
    assert sorted((r.yearweek, r.qty, r.moving_avg) for r in out.collect()) == [
        ("201501", 4.0, 6.0), ("201501", 10.0, 6.0), ("201502", 8.0, 6.0),
    ]


def test_series_of_one_week(spark):
    rows = [(*panel_row("201501", 4), "N"), (*panel_row("201501", 0, LATE), "N")]
    out = seasonal.add_seasonality(spark.createDataFrame(rows, schemas.PANEL))
    assert sorted((r.moving_avg, r.seasonality) for r in out.collect()) == [(0.0, 0.0), (4.0, 1.0)]


def test_lookups_see_only_rows_without_productseg1(spark):
    rows = [
        (*panel_row("201510", 4), "N"), (*panel_row("201511", 6), "N"),
        (*panel_row("201511", 100, productseg1="X"), "N"),
        (*panel_row("201512", 50, productseg1="X"), "N"),
        (*panel_row("201511", 7, LATE, productseg1="X"), "N"),
    ]
    df = spark.createDataFrame(rows, schemas.PANEL)
    found = lambda d: {
        (r.regionseg3, r.productseg1, r.yearweek): r.moving_avg for r in d.collect()
    }
    one, two = KEY[1], LATE[1]
    ref = found(seasonal.moving_average(df, 3))
    assert ref[one, None, "201510"] == 5.0 and ref[one, None, "201511"] == 5.0
    assert ref[one, "X", "201511"] == 5.0  # sees the rows without productseg1
    assert ref[one, "X", "201512"] == 6.0  # only a neighbour exists
    assert ref[two, "X", "201511"] == 0.0  # nothing to see
    cor = found(seasonal.moving_average(df, 3, CORRECTED))
    assert cor[one, "X", "201511"] == 75.0 and cor[two, "X", "201511"] == 7.0


def test_forecast_of_a_series_with_productseg1(spark):
    rows = [("201410", 5, 2.0, KEY, "X"), ("201509", 8, 1.0, KEY, "X")]
    df = seasonal_frame(spark, rows)
    ref = fc.forecast(df, ForecastConfig(predict_range=1)).filter("yearweek = '201510'").first()
    assert (ref.fcst, ref.seasonality, ref.time_series) == (0.0, 0.0, 0.0)
    config = ForecastConfig(predict_range=1, semantics=CORRECTED)
    cor = fc.forecast(df, config).filter("yearweek = '201510'").first()
    assert (cor.fcst, cor.seasonality, cor.time_series) == (2.0, 2.0, 16.0)
    assert cor.productseg1 == "X"


def test_base_divisor_and_length(spark):
    df = mart_frame(spark, [("201501", 3, 1, 1.0), ("201610", 8, 1, 2.0), ("201611", 4, 1, 1.0)])
    ref = fc.reforecast(df, ForecastConfig(base_back=4, max_week="201611"))
    assert ref.filter("yearweek = '201612'").first().fcst == 3.0  # always over 4
    cor = fc.reforecast(df, ForecastConfig(base_back=4, max_week="201611", semantics=CORRECTED))
    assert cor.filter("yearweek = '201612'").first().fcst == 2.4  # over 5 weeks


def test_old_forecast_rows_are_replaced_and_seen_only_by_the_reference(spark):
    """Cut in week 50 with later rows present: a forecast week meets its own old row."""
    rows = [("201552", 4, 2.0, 3.0), ("201650", 8, 4.0, 2.0), ("201652", 99, 9.0, 7.0)]
    df = mart_frame(spark, rows)
    settings = dict(predict_range=4, max_week="201650")
    ref = fc.reforecast(df, ForecastConfig(**settings))
    cor = fc.reforecast(df, ForecastConfig(**settings, semantics=CORRECTED))
    # 2015 and, for the reference only, the old row of 2016 itself: (3 / 1 + 7) / 2.
    assert by_week(ref, "seasonality")["201652"] == 5.0
    assert by_week(cor, "seasonality")["201652"] == 3.0
    for out in (ref, cor):
        assert out.filter("yearweek = '201652'").count() == 1
        assert out.filter("qty = 99").count() == 0
        assert out.columns == schemas.MART_COLUMNS
        ahead = out.filter("yearweek > '201650'").orderBy("yearweek").collect()
        assert [(r.yearweek, r.year, r.week) for r in ahead] == [
            ("201651", "2016", "51"), ("201652", "2016", "52"), ("201701", "2017", "01"),
            ("201702", "2017", "02"),
        ]


def test_recompute_changes_the_emitted_columns(spark):
    rows = [("201608", 6, 1.0, 9.0), ("201609", 2, 1.0, 9.0), ("201610", 4, 1.0, 9.0)]
    df = mart_frame(spark, rows)
    config = ForecastConfig(average_window=3, predict_range=4, max_week="201610")
    kept = fc.reforecast(df, config)
    assert by_week(kept, "moving_avg")["201610"] == 1.0
    assert by_week(kept, "seasonality")["201610"] == 9.0
    new = fc.reforecast(df, config, recompute=True)
    average, index = by_week(new, "moving_avg"), by_week(new, "seasonality")
    assert (average["201608"], average["201609"], average["201610"]) == (4.0, 4.0, 3.0)
    assert index["201609"] == 0.5
    assert average["201611"] == 4.0 and average["201612"] == 0.0  # only 201610 is next to it
    assert by_week(new, "time_series") == by_week(kept, "time_series")


def test_trailing_and_cut(spark):
    df = mart_frame(spark, [(f"2016{w:02d}", 1, 1, 1) for w in range(1, 21)])
    assert fc.cut_history(df, "201610").count() == 10
    assert fc.trailing_output(df, ForecastConfig(base_back=4)).count() == 5
    late = fc.reforecast(df, ForecastConfig(base_back=3, predict_range=4, max_week="201610"))
    assert sorted(by_week(late, "qty")) == [f"2016{w:02d}" for w in range(7, 15)]


def test_last_value_wins_in_the_mart(spark):
    df = mart_frame(spark, [("201610", 4, 1, 1.0), ("201610", 12, 1, 1.0)])
    out = fc.reforecast(df, ForecastConfig(max_week="201610"))
    assert out.filter("yearweek = '201611'").first().fcst == 3.0
    assert out.filter("yearweek = '201610'").count() == 2


def test_prior_year_join(spark):
    history = seasonal_frame(spark, [("201405", 1, 1.0), ("201505", 1, 2.0), ("201605", 1, 3.0)])
    rows = history.filter("yearweek = '201605'")
    out = prior_year_join(rows, history, schemas.PANEL_KEY, ["seasonality"])
    assert sorted((r.prior_yearweek, r.seasonality) for r in out.collect()) == [
        ("201405", 1.0), ("201505", 2.0),
    ]


def test_config_is_checked():
    with pytest.raises(ValueError):
        ForecastConfig(semantics="other")
    with pytest.raises(ValueError):
        ForecastConfig(base_back=-1)
    with pytest.raises(ValueError):
        ForecastConfig(average_window=0)
