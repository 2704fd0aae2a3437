"""The golden series under both semantics."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.data import GOLDEN_WEEKS, by_week, golden, iso_labels, joined_frame
from weekcast.config import CORRECTED, REFERENCE, ForecastConfig
from weekcast.operators.forecasting import forecast, reforecast
from weekcast.operators.browse import final_mart
from weekcast.operators.keyed import match_null_safe
from weekcast.operators.panel import gap_fill, missing_weeks, promotion_flag, shifted_join
from weekcast.operators.seasonality import add_seasonality, weekly_quantity
from weekcast.operators import seasonality as seasonal

MOVING = {
    "201401": (13.0, 13.0, 0.7692307692307693, 0.7692307692307693),
    "201452": (11.2, 11.2, 1.4285714285714286, 1.4285714285714286),
    "201501": (13.5, 13.4, 0.8888888888888888, 0.8955223880597015),
    "201502": (13.0, 13.6, 1.1538461538461537, 1.1029411764705883),
    "201552": (9.6, 9.6, 1.1458333333333335, 1.1458333333333335),
    "201553": (9.8, 9.8, 0.0, 0.0),
    "201601": (12.25, 8.5, 0.8163265306122449, 1.1764705882352942),
    "201602": (11.333333333333334, 7.666666666666667, 1.1470588235294117, 1.6956521739130435),
}
FORECAST = {
    "201603": (1.0496089931573802, 2.8584710231789643, 8.881805803573076),
    "201604": (1.0912698412698414, 2.971928823090054, 9.234340475969459),
    "201605": (1.0485197368421053, 2.855504577927136, 8.8725885015819),
    "201606": (0.5, 1.361683751670352, 4.2310069089896425),
    "201607": (1.4573906485671193, 3.9690103319803245, 12.332459806368757),
}
BASE_LEVEL = {REFERENCE: 12.25, CORRECTED: 8.5}


@pytest.fixture(scope="module")
def panel(spark):
    return promotion_flag(gap_fill(golden(spark))).cache()


def test_gap_fill(spark, panel):
    missing = {r.yearweek for r in missing_weeks(golden(spark)).collect()}
    assert missing == {
        "201406", "201417", "201428", "201439", "201450", "201509", "201520", "201531", "201542",
        "201553",
    }
    assert panel.count() == 107 and sorted(by_week(panel, "qty")) == GOLDEN_WEEKS
    assert all(by_week(panel, "qty")[w] == 0 for w in missing)


@pytest.mark.parametrize("semantics, at", [(REFERENCE, 0), (CORRECTED, 1)])
def test_moving_average_and_seasonality(panel, semantics, at):
    out = add_seasonality(panel, semantics=semantics)
    averages, index = by_week(out, "moving_avg"), by_week(out, "seasonality")
    for week, values in MOVING.items():
        assert averages[week] == pytest.approx(values[at], rel=1e-9)
        assert index[week] == pytest.approx(values[2 + at], rel=1e-9)


@pytest.mark.parametrize("semantics, at", [(REFERENCE, 1), (CORRECTED, 2)])
def test_forecast(panel, semantics, at):
    config = ForecastConfig(semantics=semantics)
    out = forecast(add_seasonality(panel, semantics=semantics), config)
    assert out.count() == 107 + 5
    level, season, value = (by_week(out, c) for c in ("fcst", "seasonality", "time_series"))
    for week, expected in FORECAST.items():
        assert level[week] == pytest.approx(BASE_LEVEL[semantics], rel=1e-9)
        assert season[week] == pytest.approx(expected[0], rel=1e-9)
        assert value[week] == pytest.approx(expected[at], rel=1e-9)
    assert all(level[w] == 0 and value[w] == 0 for w in GOLDEN_WEEKS)


@pytest.mark.parametrize("semantics, at", [(REFERENCE, 1), (CORRECTED, 2)])
def test_reforecast_with_same_settings_repeats_the_forecast(panel, semantics, at):
    config = ForecastConfig(semantics=semantics)
    mart = final_mart(forecast(add_seasonality(panel, semantics=semantics), config))
    again = reforecast(mart, ForecastConfig(max_week="201602", semantics=semantics))
    values = by_week(again, "time_series")
    assert {w: values[w] for w in FORECAST} == pytest.approx(
        {w: v[at] for w, v in FORECAST.items()}, rel=1e-9
    )
    first = {REFERENCE: "201551", CORRECTED: "201552"}[semantics]
    assert min(values) == first and max(values) == "201607"


def mean_by_join(weekly, keys, half, semantics):
    """The average of every week by looking each shifted week up."""
    known = weekly.filter("qty IS NOT NULL")
    met = shifted_join(weekly, known, keys, "qty", range(-half, half + 1), semantics)
    means = met.groupBy(*keys, "yearweek").agg(F.avg("met_value").alias("moving_avg"))
    joined = match_null_safe(weekly, means, [*keys, "yearweek"], "left")
    return joined.withColumn("moving_avg", F.coalesce("moving_avg", F.lit(0.0)))


@pytest.mark.parametrize("window", [1, 2, 5, 8, 11, 53, 61, 105])
@pytest.mark.parametrize("semantics", [REFERENCE, CORRECTED])
def test_window_frames_equal_the_shifted_join(panel, window, semantics):
    """Two independent ways to find the weeks around a week."""
    weekly, keys = weekly_quantity(panel, semantics)
    half = seasonal.half_width(window)
    fast = by_week(seasonal.weekly_moving_average(weekly, keys, window, semantics), "moving_avg")
    slow = by_week(mean_by_join(weekly, keys, half, semantics), "moving_avg")
    assert fast == slow and len(fast) == 107


@pytest.mark.parametrize("window", [8, 61, 105, 231])
def test_window_frames_equal_the_shifted_join_over_many_years(spark, window):
    labels = iso_labels(date(1998, 1, 5), 1200)
    rows = [(w, (7 * k) % 23) for k, w in enumerate(labels) if k % 9 and k % 53]
    weekly, keys = weekly_quantity(joined_frame(spark, rows))
    fast = by_week(seasonal.weekly_moving_average(weekly, keys, window), "moving_avg")
    slow = by_week(mean_by_join(weekly, keys, seasonal.half_width(window), REFERENCE), "moving_avg")
    assert fast == slow


def test_wide_window_over_a_year_of_53_weeks(panel):
    weekly, keys = weekly_quantity(panel)
    out = by_week(seasonal.weekly_moving_average(weekly, keys, 61), "moving_avg")
    # 201501 - 1 .. - 30 land on 201453 (absent), 201452 .. 201424; forward 30 weeks.
    span = [w for w in GOLDEN_WEEKS if "201424" <= w <= "201531"]
    qty = by_week(panel, "qty")
    assert out["201501"] == pytest.approx(sum(qty[w] for w in span) / len(span))
