"""Loading tables that hold bad rows: typed rows on one side, a quarantine table on the other.

A value that its declared type can't hold, a week label that is no ISO week and a line with too many or too few fields
reject their row, and only that.  Every fault is one row of the quarantine: the source line, the column and the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.functions.weeks import is_iso_week
from weekcast.sources.files import write_table
from weekcast.sources.schemas import name_of

LINE = "line"
REJECTED = T.StructType([T.StructField(c, T.StringType()) for c in (LINE, "column", "reason")])


class TooManyRejected(ValueError):
    """More rows were rejected than a load allows."""


def _fault(name: str, wrong: Column, reason: str) -> Column:
    return F.when(wrong, F.struct(F.lit(name).alias("column"), F.lit(reason).alias("reason")))


def faults(text: DataFrame, schema: T.StructType, weeks: tuple[str, ...] = ()) -> Column:
    """An array of (column, reason) for each row of a table of strings; empty for a row that can be typed.

    Missing values are no faults.  ``weeks`` are columns that must hold ISO week labels.
    """
    found = []
    for field in schema:
        value = F.col(name_of(text, field.name))
        if not isinstance(field.dataType, T.StringType):
            wrong = value.isNotNull() & value.try_cast(field.dataType).isNull()
            found.append(_fault(field.name, wrong, f"not a value of type {field.dataType.simpleString()}"))
        if field.name in weeks:
            label = F.when(value.rlike("^[0-9]{6}$"), value)
            good = F.coalesce((F.substring(label, 1, 4) > "0000") & is_iso_week(label), F.lit(False))
            found.append(_fault(field.name, value.isNotNull() & ~good, "no ISO week"))
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array()


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    quarantine: str,
    weeks: tuple[str, ...] = (),
    most_rejected: float = 0.0,
) -> DataFrame:
    """The rows of a CSV table that can be typed; the others go to a parquet table at ``quarantine``.

    One pass writes the quarantine and counts.  A greater share of rejected rows than ``most_rejected`` is an error, which
    leaves the quarantine for inspection; the default allows none.  Columns are found by name, as by ``read_csv``.
    """
    reader = spark.read.option("header", True).option("sep", ",")
    names = reader.csv(path).columns
    broken = "_broken_line"
    given = T.StructType([T.StructField(n, T.StringType()) for n in [*names, broken]])
    # A reader that skips columns doesn't count the fields of a line.
    whole = reader.option("enforceSchema", False).option("columnPruning", False)
    text = whole.schema(given).option("columnNameOfCorruptRecord", broken).csv(path)
    missing = [f.name for f in schema if name_of(text, f.name) is None]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    malformed = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit("wrong number of fields").alias("reason")))
    checked = text.withColumn("_faults", F.when(F.col(broken).isNotNull(), malformed).otherwise(faults(text, schema, weeks)))
    bad = F.size("_faults") > 0
    seen = Observation()
    watched = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"))
    line = F.coalesce(F.col(broken), F.to_json(F.struct(*[F.col(n) for n in names])))
    rejected = watched.where(bad).select(line.alias(LINE), F.explode("_faults").alias("f")).select(LINE, "f.column", "f.reason")
    write_table(rejected, quarantine)
    counts = seen.get
    if counts["bad"] > most_rejected * counts["rows"]:
        raise TooManyRejected(f"{counts['bad']} of {counts['rows']} rows rejected, see {quarantine}")
    typed = [F.col(name_of(text, f.name)).try_cast(f.dataType).alias(f.name) for f in schema]
    return checked.where(~bad).select(*typed)


def read_rejected(spark: SparkSession, quarantine: str) -> DataFrame:
    """(line, column, reason) of every fault of a load; a line with the wrong number of fields has no column."""
    return spark.read.schema(REJECTED).parquet(quarantine)
