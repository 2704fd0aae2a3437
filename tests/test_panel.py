import pytest
from pyspark.sql import functions as F

from tests.data import KEY, joined_frame, panel_row
from weekcast.operators import keyed, panel, seasonality
from weekcast.sources import schemas

OTHER = ("A01", "SITEID0002", "SALESID0001", "PG01", "ITEM0001")


def sales(spark, rows):
    return spark.createDataFrame(
        [("A01", None, "PG01", "S1", site, "I1", w, w[:4], w[4:], q) for site, w, q in rows],
        schemas.ACTUAL_SALES,
    )


def promo(spark, rows):
    return spark.createDataFrame(
        [("A01", "S1", "PG01", "I1", w, plan, 100, 10, 90.0, 81.0, depth) for w, plan, depth in rows],
        schemas.PROMOTION,
    )


def test_join_keeps_sales_and_multiplies_on_two_promotions(spark):
    s = sales(spark, [("A", "201401", 3.0), ("A", "201402", 4.0), ("B", "201401", 5.0)])
    p = promo(spark, [("201401", "201401", 0.1), ("201401", "201352", 0.2), ("201409", "201401", 0.3)])
    out = panel.join_promotions(s, p)
    assert out.schema.names == schemas.JOINED_SALES.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.JOINED_SALES]
    found = sorted((r.regionseg3, r.yearweek, r.pro_percent, r.qty) for r in out.collect())
    assert found == [
        ("A", "201401", 0.1, 3.0), ("A", "201401", 0.2, 3.0), ("A", "201402", 0.0, 4.0),
        ("B", "201401", 0.1, 5.0), ("B", "201401", 0.2, 5.0),
    ]
    side = panel.join_promotions(s, p, project="promo")
    assert side.filter("regionseg is null and qty = 4").count() == 1
    other = panel.join_promotions(s, p, project="sales")
    assert other.filter("map_price is null").count() == 1 and other.columns[:10] == s.columns
    with pytest.raises(ValueError):
        panel.join_promotions(s, p, project="all")


def test_gap_fill_invariants(spark):
    rows = [panel_row(w, q, key) for key, w, q in [
        (KEY, "201450", 1), (KEY, "201450", 2), (KEY, "201503", 3), (OTHER, "201401", 9),
        (OTHER, "201403", 1), (("A01", None, "S", "P", "I"), "201401", 1),
        (("A01", None, "S", "P", "I"), "201404", 1),
    ]]
    rows.append(panel_row("201452", 8, KEY, productseg1="X"))
    df = joined_frame(spark, rows)
    out = panel.gap_fill(df)
    assert out.agg(F.sum("qty")).first()[0] == df.agg(F.sum("qty")).first()[0]
    assert out.count() == len(rows) + 4 + 1 + 2
    wanted = panel.week_calendar(df).distinct()
    assert out.select(wanted.columns).distinct().exceptAll(wanted).count() == 0
    assert wanted.exceptAll(out.select(wanted.columns).distinct()).count() == 0
    assert out.schema == df.schema


def test_both_ways_to_missing_weeks_agree(spark):
    rows = [panel_row(w, 1, k) for k in (KEY, OTHER) for w in ("201401", "201409", "201552", "201602")]
    df = joined_frame(spark, rows)
    a, b = panel.missing_weeks(df), panel.missing_weeks_by_difference(df)
    # Per series: 201402..08, 201410..201551 and 201553, 201601.
    assert a.count() == b.count() == 2 * (7 + 94 + 2)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("label", ["201453", "201600"])
def test_a_label_that_is_no_week_is_an_error(spark, label):
    df = joined_frame(spark, [panel_row(w, 1) for w in ("201451", label, "201702")])
    for make in (panel.missing_weeks, panel.missing_weeks_by_difference, panel.gap_fill):
        with pytest.raises(Exception, match=f"no ISO week: {label}"):
            make(df).collect()
    with pytest.raises(Exception, match=f"no ISO week: {label}"):
        seasonality.moving_average(panel.promotion_flag(df)).collect()


def test_flag_and_sort(spark):
    df = joined_frame(spark, [panel_row("201402", 1, depth=0.2), panel_row("201401", 1)])
    out = panel.sort_panel(panel.promotion_flag(df)).collect()
    assert [(r.yearweek, r.promotionNY) for r in out] == [("201401", "N"), ("201402", "Y")]


def test_dedupe_and_lookup(spark):
    df = spark.createDataFrame(
        [("a", 3.0, "x"), ("a", 1.0, "z"), ("a", 1.0, "y"), (None, 5.0, "q"), (None, 4.0, "p")],
        "k string, v double, tag string",
    )
    rows = lambda keep: {r.k: (r.v, r.tag) for r in keyed.dedupe(df, ["k"], ["v"], keep).collect()}
    assert rows("first") == {"a": (1.0, "y"), None: (4.0, "p")}
    assert rows("last") == {"a": (3.0, "x"), None: (5.0, "q")}
    holes = spark.createDataFrame([("a", None, "x"), ("a", 2.0, "y")], df.schema)
    for keep in ("first", "last"):
        assert keyed.dedupe(holes, ["k"], ["v"], keep).first().v == 2.0
        assert keyed.dedupe(holes.drop("tag"), ["k"], ["v"], keep).first().v == 2.0
    probes = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    found = keyed.lookup(probes, df, ["k"], {"v": "best"}, keep="last")
    assert {r.k: r.best for r in found.collect()} == {"a": 3.0, None: 5.0, "b": None}
    assert {r.k for r in keyed.exists_in(probes, df, ["k"]).collect()} == {"a", None}
    assert {r.k for r in keyed.not_in(probes, df, ["k"]).collect()} == {"b"}
    assert keyed.with_scalar(probes, "top", F.max("k")).filter("top = 'b'").count() == 3
