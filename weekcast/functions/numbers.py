"""Numeric column helpers that hold under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, or 0.0 where the denominator is 0."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def round_half_up(value: Column) -> Column:
    """Round to a whole number with ties towards plus infinity (-2.5 -> -2)."""
    return F.floor(value + F.lit(0.5)).cast("double")


def int_div(numerator: Column, denominator: Column) -> Column:
    """Integer division truncating toward zero; null where the denominator is 0."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def numeric_text_to_int(text: Column) -> Column:
    """Numeric text to a truncated integer: ``'7.9'`` -> 7."""
    return text.cast("double").cast("int")
