import pytest

from weekcast.functions.numbers import int_div, round_half_up, safe_div
from weekcast.operators import promotions
from weekcast.sources import schemas
from pyspark.sql import functions as F


def promo_rows(spark, rows):
    """Rows of (item, targetweek, planweek, map_price, ir)."""
    return spark.createDataFrame(
        [("A01", "S1", "PG01", item, t, p, price, ir, 0.0, 0.0, 0.0) for item, t, p, price, ir in rows],
        schemas.PROMOTION,
    )


def test_price_refinement_golden(spark):
    df = promo_rows(spark, [
        ("I1", "201401", "201401", 100, 10), ("I1", "201402", "201401", 0, 5),
        ("I1", "201403", "201401", 151, 20), ("I2", "201401", "201401", 0, 7),
        ("I2", "201402", "201401", 0, 9),
    ])
    out = {
        (r.item, r.targetweek): (r.map_price, r.ir, r.pmap, r.pmap10, r.pro_percent)
        for r in promotions.refine_prices(df).collect()
    }
    assert out["I1", "201401"] == (125, 10, 115.0, 104.0, pytest.approx(0.16800000000000004, rel=1e-12))
    assert out["I1", "201402"] == (125, 5, 120.0, 108.0, pytest.approx(0.136))
    assert out["I1", "201403"] == (125, 20, 105.0, 95.0, pytest.approx(0.24))
    assert out["I2", "201401"] == out["I2", "201402"] == (0, 0, 0.0, 0.0, 0.0)


def test_negative_price_rounds_half_up(spark):
    out = promotions.refine_prices(promo_rows(spark, [("I1", "201401", "201401", 10, 15)])).first()
    assert (out.pmap, out.pmap10) == (-5.0, -4.0)  # -4.5 rounds up
    assert out.pro_percent == pytest.approx(1.4)


def test_filters(spark):
    df = promo_rows(spark, [
        ("a", "201401", "201402", 5, 0), ("b", "201402", "201402", 0, 0),
        ("c", "201403", "201402", 5, 0), ("d", "201350", "201351", 5, 0),
    ])
    items = lambda d: sorted(r.item for r in d.collect())
    assert items(promotions.filter_valid_promotions(df)) == ["b", "c"]
    assert items(promotions.filter_valid_promotions(df, nonzero_price=True)) == ["c"]
    kept = promotions.filter_valid_promotions(df, nonzero_price=True, plan_week="global_min")
    assert items(kept) == ["a", "c"]
    with pytest.raises(ValueError):
        promotions.filter_valid_promotions(df, plan_week="other")


def test_missing_key_parts_form_one_group(spark):
    rows = [("A01", None, "PG01", "I1", w, "201401", p, 1, 0.0, 0.0, 0.0)
            for w, p in (("201401", 10), ("201402", 21))]
    out = promotions.refine_prices(spark.createDataFrame(rows, schemas.PROMOTION))
    assert [r.map_price for r in out.collect()] == [15, 15]


def test_price_sum_does_not_overflow(spark):
    df = promo_rows(spark, [("a", f"2014{w:02d}", "201401", 2_000_000_000, 0) for w in range(1, 5)])
    assert promotions.avg_nonzero_price(df).first().avg_price == 2_000_000_000


def test_number_helpers(spark):
    df = spark.createDataFrame([(-2.5, -3), (2.5, 3), (0.4, 0)], "x double, n int")
    rows = df.select(
        round_half_up(F.col("x")).alias("r"), int_div(F.col("n"), F.lit(2)).alias("d"),
        int_div(F.lit(7), F.col("n")).alias("z"), safe_div(F.col("x"), F.col("n")).alias("s"),
    ).collect()
    assert [r.r for r in rows] == [-2.0, 3.0, 0.0]
    assert [r.d for r in rows] == [-1, 1, 0]
    assert [r.z for r in rows] == [-2, 2, None] and rows[2].s == 0.0
