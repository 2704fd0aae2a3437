"""The parameter table: entry rules, edits and resolution into settings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.config import (
    AVERAGE_WINDOW,
    BASE_DATA,
    CORRECTED,
    MAX_YEAR_WEEK,
    PARAMETER_DEFAULTS,
    PARAMETER_RANGES,
    PREDICT_RANGE,
    REFERENCE,
    ForecastConfig,
    check_semantics,
)
from weekcast.functions.numbers import numeric_text_to_int
from weekcast.sources.shared import folder_names
from weekcast.sources.versions import VersionedTable


def validate_params(entries: DataFrame) -> DataFrame:
    """Entries with a known name and a value in its range; others are dropped silently.

    ``value`` must already be a whole number.
    """
    rules = [
        (F.col("parameter") == name) & F.col("value").between(low, high)
        for name, (low, high) in PARAMETER_RANGES.items()
    ]
    return entries.filter(reduce(lambda a, b: a | b, rules))


def append_params(table: DataFrame, entries: DataFrame) -> DataFrame:
    """The table with the valid entries added; a name may then occur several times."""
    return table.unionByName(validate_params(entries))


def update_param(table: DataFrame, name: str, value: int) -> DataFrame:
    """A new version of the table with every row of ``name`` set to ``value``.

    An unknown name or a value out of range leaves the table as it is.
    """
    low, high = PARAMETER_RANGES.get(name, (1, 0))
    if not low <= value <= high:
        return table
    new = F.lit(value).cast(table.schema["value"].dataType)
    return table.withColumn(
        "value", F.when(F.col("parameter") == name, new).otherwise(F.col("value"))
    )


def effective_params(params: DataFrame, semantics: str = REFERENCE) -> DataFrame:
    """One row with the value each setting takes.

    A name given several times takes its largest value; a missing one its
    default.  ``base_data`` becomes the number of weeks before the cut-off week:
    one less than the value given, and under the reference semantics 4 when
    nothing is given.
    """
    check_semantics(semantics)
    value = numeric_text_to_int(F.col("value").cast("string"))
    given = {
        name: F.max(F.when(F.col("parameter") == name, value)) for name in PARAMETER_DEFAULTS
    }
    given[BASE_DATA] = given[BASE_DATA] - F.lit(1)
    default = dict(PARAMETER_DEFAULTS)
    if semantics == CORRECTED:
        default[BASE_DATA] -= 1
    return params.agg(
        *[F.coalesce(given[name], F.lit(default[name])).alias(name) for name in PARAMETER_DEFAULTS]
    )


def resolve_params(params: DataFrame, semantics: str = REFERENCE) -> DataFrame:
    """The effective settings as (parameter, value) rows."""
    row = effective_params(params, semantics)
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("parameter"), F.col(name).alias("value"))
            for name in PARAMETER_DEFAULTS
        ]
    )
    return row.select(F.inline(pairs))


def config_from_params(params: DataFrame, semantics: str = REFERENCE) -> ForecastConfig:
    """Read the effective settings (one row) into a :class:`ForecastConfig`."""
    row = effective_params(params, semantics).first()
    return ForecastConfig(
        average_window=row[AVERAGE_WINDOW],
        predict_range=row[PREDICT_RANGE],
        base_back=row[BASE_DATA],
        max_week=str(row[MAX_YEAR_WEEK]),
        semantics=semantics,
    )


def append_to(table: VersionedTable, entries: DataFrame) -> int:
    """Add the valid entries to a kept parameter table; only they are written.  Returns the version's number."""
    return table.append(validate_params(entries))


def update_in(table: VersionedTable, name: str, value: int) -> int | None:
    """Set every row of ``name`` in a kept parameter table; an unknown name or a value out of range changes nothing."""
    low, high = PARAMETER_RANGES.get(name, (1, 0))
    if not low <= value <= high:
        return None
    row = table.spark.range(1).select(F.lit(name).alias("parameter"), F.lit(value).alias("value"))
    return table.update(row, ["parameter"])


def write_version(table: DataFrame, path: str) -> int:
    """Keep a table as the next version under ``path``; earlier versions stay.  Returns its number."""
    spark = table.sparkSession
    number = current_number(spark, path) + 1
    table.select("parameter", "value").write.mode("errorifexists").parquet(f"{path}/version={number}")
    return number


def current_number(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version, 0 without one."""
    names = folder_names(spark, path)
    numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return max(filter(lambda n: "_SUCCESS" in folder_names(spark, f"{path}/version={n}"), numbers), default=0)


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A version of the table, the newest one by default."""
    number = current_number(spark, path) if number is None else number
    return spark.read.schema("parameter string, value int").parquet(f"{path}/version={number}")
