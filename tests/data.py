"""Hand-made inputs: the golden series and small panels."""

from __future__ import annotations

from datetime import date, timedelta

from weekcast.sources import schemas

KEY = ("A01", "SITEID0001", "SALESID0001", "PG01", "ITEM0001")  # order of SERIES_KEY


def iso_labels(first: date, count: int) -> list[str]:
    labels = []
    for i in range(count):
        year, week, _ = (first + timedelta(weeks=i)).isocalendar()
        labels.append(f"{year:04d}{week:02d}")
    return labels


GOLDEN_WEEKS = iso_labels(date(2013, 12, 30), 107)  # 201401 .. 201602


def panel_row(week, qty, key=KEY, productseg1=None, price=0, depth=0.0):
    region, site, channel, group, item = key
    return (region, productseg1, group, channel, site, item, week, price, 0, 0.0, 0.0, depth, float(qty))


def joined_frame(spark, rows):
    return spark.createDataFrame([panel_row(*r) if len(r) == 2 else r for r in rows], schemas.JOINED_SALES)


def golden_rows():
    return [(w, 10 + 3 * k % 7) for k, w in enumerate(GOLDEN_WEEKS) if k % 11 != 5]


def golden(spark):
    return joined_frame(spark, golden_rows())


def seasonal_frame(spark, rows):
    """Rows of (week, qty, seasonality[, key[, productseg1]])."""
    full = []
    for week, qty, season, *rest in rows:
        full.append((*panel_row(week, qty, *rest), "N", 1.0, float(season)))
    return spark.createDataFrame(full, schemas.SEASONALITY)


def mart_frame(spark, rows):
    """Rows of (week, qty, moving_avg, seasonality[, key])."""
    full = []
    for week, qty, average, season, *rest in rows:
        key = rest[0] if rest else KEY
        full.append((*key, week, week[:4], week[4:], 0, 0, 0.0, 0.0, 0.0, float(qty), 0,
                     float(average), float(season), 7.0, 7.0))
    return spark.createDataFrame(full, schemas.MART)


def by_week(df, column):
    return {r["yearweek"]: r[column] for r in df.select("yearweek", column).collect()}
