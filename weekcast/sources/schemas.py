"""Column lists and typed schemas of the tables the library works on.

Fixed values: names and order of all columns are part of the data contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_KEY = ["regionseg", "regionseg3", "salesid", "productgroup", "item"]
PANEL_KEY = ["regionseg", "productseg1", "productgroup", "salesid", "regionseg3", "item"]
PROMOTION_KEY = ["regionseg", "salesid", "productgroup", "item"]
PROMOTION_MEASURES = ["map_price", "ir", "pmap", "pmap10", "pro_percent"]


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

PROMOTION = _schema(
    regionseg=_S, salesid=_S, productgroup=_S, item=_S, targetweek=_S, planweek=_S,
    map_price=_L, ir=_L, pmap=_D, pmap10=_D, pro_percent=_D,
)
ACTUAL_SALES = _schema(
    regionSeg1=_S, productSeg1=_S, productSeg2=_S, regionSeg2=_S, regionSeg3=_S,
    productSeg3=_S, yearweek=_S, year=_S, week=_S, qty=_D,
)
#: What the jobs need of the sales.
SALES = T.StructType([f for f in ACTUAL_SALES if f.name not in ("year", "week")])
JOINED_SALES = _schema(
    regionseg=_S, productseg1=_S, productgroup=_S, salesid=_S, regionseg3=_S, item=_S,
    yearweek=_S, map_price=_L, ir=_L, pmap=_D, pmap10=_D, pro_percent=_D, qty=_D,
)
PANEL = T.StructType(JOINED_SALES.fields + [T.StructField("promotionNY", _S)])
SEASONALITY = T.StructType(
    PANEL.fields + [T.StructField("moving_avg", _D), T.StructField("seasonality", _D)]
)
FORECAST = T.StructType(
    SEASONALITY.fields + [T.StructField("fcst", _D), T.StructField("time_series", _D)]
)
MART = _schema(
    regionseg=_S, regionseg3=_S, salesid=_S, productgroup=_S, item=_S, yearweek=_S,
    year=_S, week=_S, map_price=_L, ir=_L, pmap=_D, pmap10=_D, pro_percent=_D, qty=_D,
    promotionNY=_I, moving_avg=_D, seasonality=_D, fcst=_D, time_series=_D,
)
PARAMETERS = _schema(parameter=_S, value=_I)

MART_COLUMNS = MART.fieldNames()
DISPLAY_COLUMNS = [name for name in MART_COLUMNS if name not in ("year", "week")]


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns as plain strings, which is how CSV files hold them."""
    return T.StructType([T.StructField(field.name, T.StringType()) for field in schema])


def name_of(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that Spark resolves ``name`` to, whatever its case; several are an error."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) > 1:
        raise ValueError(f"columns {found} differ only in case")
    return found[0] if found else None


def named_as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` spelt as declared there, whatever their case; others stay."""
    names = {old: field.name for field in schema if (old := name_of(df, field.name)) is not None}
    if all(old == new for old, new in names.items()):
        return df
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, found by name in any order and case and cast; a missing one is an error."""
    names = {field.name: name_of(df, field.name) for field in schema}
    missing = [name for name, old in names.items() if old is None]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(names[f.name]).cast(f.dataType).alias(f.name) for f in schema])
