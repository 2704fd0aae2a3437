from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.data import iso_labels
from weekcast.config import CORRECTED, REFERENCE
from weekcast.functions import weeks


def _weeks(year):
    return date(year, 12, 28).isocalendar()[1]


def _iso(label, n):
    day = date.fromisocalendar(int(label[:4]), int(label[4:]), 1) + timedelta(weeks=n)
    year, week, _ = day.isocalendar()
    return f"{year:04d}{week:02d}"


def _expected_reference(label, n):
    """One step over new year, with the length of the starting year."""
    year, week = int(label[:4]), int(label[4:])
    if n > 0:
        return _iso(label, n)
    if week + n >= 1:
        return f"{year}{week + n:02d}"
    return f"{year - 1}{week + n + _weeks(year):02d}"


@pytest.fixture(scope="module")
def grid(spark):
    labels = iso_labels(date(2012, 12, 31), 731)  # 201301 .. 202653
    assert labels[0] == "201301" and labels[-1] == "202653"
    pairs = [(w, n) for w in labels for n in range(-8, 9)]
    return spark.createDataFrame(pairs, "yearweek string, n int")


def test_shift_is_exhaustively_right(grid):
    out = grid.select(
        "yearweek",
        "n",
        weeks.shift_week(F.col("yearweek"), F.col("n"), REFERENCE).alias("ref"),
        weeks.shift_week(F.col("yearweek"), F.col("n"), CORRECTED).alias("cor"),
    ).collect()
    assert len(out) == 12427
    differ = 0
    for r in out:
        assert r.cor == _iso(r.yearweek, r.n)
        assert r.ref == _expected_reference(r.yearweek, r.n)
        assert weeks.shift_label(r.yearweek, r.n, REFERENCE) == r.ref
        assert weeks.shift_label(r.yearweek, r.n, CORRECTED) == r.cor
        if r.ref != r.cor:
            differ += 1
            assert r.n < 0 and r.yearweek[:4] in ("2015", "2016", "2020", "2021", "2026")
    assert differ == 180


@pytest.mark.parametrize(
    "label, n, reference, corrected",
    [
        ("201627", -7, "201620", "201620"),
        ("201601", -1, "201552", "201553"),
        ("201501", -1, "201453", "201452"),
        ("201553", 1, "201601", "201601"),
        ("201601", 0, "201601", "201601"),
        ("201610", 60, "201718", "201718"),
    ],
)
def test_shift_golden(spark, label, n, reference, corrected):
    row = spark.range(1).select(
        weeks.shift_week(F.lit(label), n, REFERENCE).alias("ref"),
        weeks.shift_week(F.lit(label), n, CORRECTED).alias("cor"),
    ).first()
    assert (row.ref, row.cor) == (reference, corrected)


def test_reference_shift_back_over_several_years(spark):
    """Each new year passed on the way back adds the length of the year left."""
    year, week = 2017, 3 - 60
    while week <= 0:
        week += _weeks(year)
        year -= 1
    found = spark.range(1).select(weeks.shift_week(F.lit("201703"), -60).alias("w")).first().w
    assert found == weeks.shift_label("201703", -60) == f"{year}{week:02d}"


def test_weeks_in_year_and_index(spark):
    years = spark.range(1990, 2060).select(
        F.col("id").cast("int").alias("y"), weeks.weeks_in_year(F.col("id").cast("int")).alias("n")
    )
    assert all(r.n == _weeks(r.y) for r in years.collect())
    labels = iso_labels(date(1970, 1, 5), 4000)
    df = spark.createDataFrame([(i, w) for i, w in enumerate(labels)], "i int, w string")
    out = df.select(
        "i", "w", weeks.week_index(F.col("w")).alias("idx"),
        weeks.label_of_index(F.col("i")).alias("back"), weeks.is_iso_week(F.col("w")).alias("ok"),
    )
    assert out.filter("i != idx or w != back or not ok").count() == 0
    bad = spark.createDataFrame([("201453",), ("201600",), ("201554",)], "w string")
    assert bad.filter(weeks.is_iso_week(F.col("w"))).count() == 0
