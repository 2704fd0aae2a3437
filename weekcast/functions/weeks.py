"""Arithmetic on ISO year-week labels (``YYYYWW`` strings).

Everything is a built-in date expression, so it stays inside code generation.
``week_index`` maps a label to a consecutive integer (weeks since Monday
1970-01-05); windows and sequences run over that integer.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.config import REFERENCE, check_semantics

_EPOCH_MONDAY = "1970-01-05"


def year_of(yearweek: Column) -> Column:
    """Year part of a label, as text."""
    return F.substring(yearweek, 1, 4)


def week_of(yearweek: Column) -> Column:
    """Week part of a label, as two-digit text."""
    return F.substring(yearweek, 5, 2)


def year_number(yearweek: Column) -> Column:
    return year_of(yearweek).cast("int")


def week_number(yearweek: Column) -> Column:
    return week_of(yearweek).cast("int")


def year_week_label(year: Column, week: Column) -> Column:
    """Build a label from a year and a week number."""
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lpad(week.cast("string"), 2, "0"))


def weeks_in_year(year: Column) -> Column:
    """Number of ISO weeks in a year: the week that holds 28 December."""
    return F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))


def first_week_index(year: Column) -> Column:
    """:func:`week_index` of week 1 of a year."""
    # 4 January is always in week 1; the first Monday counted is day 4.
    days = F.unix_date(F.make_date(year, F.lit(1), F.lit(4))) - F.lit(4)
    return F.floor(days / F.lit(7)).cast("int")


def checked_week(yearweek: Column) -> Column:
    """The label; one that is no ISO week, such as 201453 or 201600, is an error."""
    wrong = F.raise_error(F.concat(F.lit("no ISO week: "), yearweek)).cast("string")
    return F.when(yearweek.isNull() | is_iso_week(yearweek), yearweek).otherwise(wrong)


def week_index(yearweek: Column) -> Column:
    """Whole weeks between Monday 1970-01-05 and the Monday of the (checked) label."""
    label = checked_week(yearweek)
    return first_week_index(year_number(label)) + week_number(label) - F.lit(1)


def is_iso_week(yearweek: Column) -> Column:
    """True for labels that exist in the ISO calendar (week 53 only in long years)."""
    week = week_number(yearweek)
    return week.between(1, 52) | (
        (week == 53) & (weeks_in_year(year_number(yearweek)) == 53)
    )


def _monday(index: Column) -> Column:
    return F.date_add(F.to_date(F.lit(_EPOCH_MONDAY)), (index * F.lit(7)).cast("int"))


def date_year_week(day: Column) -> Column:
    """ISO year-week label of a date or timestamp."""
    return year_week_label(F.extract(F.lit("yearofweek"), day), F.weekofyear(day))


def label_of_index(index: Column) -> Column:
    """Label of a week index; inverse of :func:`week_index`."""
    return date_year_week(_monday(index))


def year_of_index(index: Column) -> Column:
    """ISO year of a week index: the year its Thursday lies in."""
    return F.year(F.date_add(_monday(index), 3))


def shift_week(yearweek: Column, weeks: int | Column, semantics: str = REFERENCE) -> Column:
    """Shift a label by a number of weeks.

    Forward shifts follow the ISO calendar under both semantics.  Backward
    shifts that leave the year differ: the reference counts back with the
    length of the year being left instead of the year being entered.  That
    equals shifting the same week number of the *following* year and taking
    one off the resulting year, which is how it is written here.
    """
    check_semantics(semantics)
    if isinstance(weeks, int):
        if semantics == REFERENCE and weeks == 0:
            return yearweek
        step = F.lit(weeks)
    else:
        step = weeks
    iso = label_of_index(week_index(yearweek) + step)
    if semantics != REFERENCE:
        return iso
    backward = _shift_back_reference(yearweek, step)
    if isinstance(weeks, int):
        return iso if weeks > 0 else backward
    return F.when(step > 0, iso).otherwise(backward)


def _shift_back_reference(yearweek: Column, step: Column) -> Column:
    year, week = year_number(yearweek), week_number(yearweek)
    within_year = week + step
    landing = _monday(first_week_index(year + F.lit(1)) + within_year - F.lit(1))
    crossed = year_week_label(
        F.extract(F.lit("yearofweek"), landing) - F.lit(1), F.weekofyear(landing)
    )
    return F.when(within_year > 0, year_week_label(year, within_year)).otherwise(crossed)


def shift_label(label: str, weeks: int, semantics: str = REFERENCE) -> str:
    """:func:`shift_week` for one known label, so that plans hold plain constants."""
    check_semantics(semantics)
    year, week = int(label[:4]), int(label[4:])
    within_year = week + weeks
    if semantics == REFERENCE and weeks <= 0:
        if within_year > 0:
            return f"{year:04d}{within_year:02d}"
        later, landed = _iso_position(year + 1, within_year)
        return f"{later - 1:04d}{landed:02d}"
    return "{:04d}{:02d}".format(*_iso_position(year, within_year))


def _iso_position(year: int, week: int) -> tuple[int, int]:
    day = date.fromisocalendar(year, 1, 1) + timedelta(weeks=week - 1)
    return day.isocalendar()[:2]


def week_range(first: Column, last: Column) -> Column:
    """Array of the week indexes from ``first`` to ``last`` (labels), step one week."""
    return F.sequence(week_index(first), week_index(last))


def in_years(df: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows whose ``year`` column lies between the years of two labels, or is missing; a table without one stays whole.

    Used beside a bound on the week, which it follows from: a table written by
    year is then read only in part.  Years that disagree with their weeks are for :func:`check_years` to find.
    """
    if "year" not in df.columns:
        return df
    if first is not None:
        df = df.filter(F.col("year").isNull() | (F.col("year") >= F.lit(first[:4])))
    if last is not None:
        df = df.filter(F.col("year").isNull() | (F.col("year") <= F.lit(last[:4])))
    return df


def _disagrees() -> Column:
    return F.col("year") != year_of(F.col("yearweek"))


def agreeing_years(df: DataFrame) -> DataFrame:
    """``df``, in which a year that is not that of its week is an error when the row is read."""
    wrong = F.raise_error(F.concat(F.lit("year "), F.col("year"), F.lit(" does not fit week "), F.col("yearweek")))
    return df.withColumn("yearweek", F.when(_disagrees(), wrong.cast("string")).otherwise(F.col("yearweek")))


def check_years(df: DataFrame) -> None:
    """Look for a year that is not that of its week in a whole table from elsewhere; raises an error that names both.

    Reads two columns.  Such a row would be passed over by a bound on the year that the bound on its week allows.
    """
    found = df.filter(_disagrees()).select("year", "yearweek").first()
    if found is not None:
        raise ValueError(f"year {found.year} does not fit week {found.yearweek}")
