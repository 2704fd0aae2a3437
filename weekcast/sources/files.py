"""CSV and parquet readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.sources.schemas import conform


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast each column to its declared type; bad text fails under ANSI mode."""
    return df.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )


def normalize_columns(df: DataFrame, upper: bool = False) -> DataFrame:
    """Fold column names to one case."""
    return df.toDF(*[c.upper() if upper else c.lower() for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read comma-separated text by the names of its header and cast it once, at the edge.

    Columns may come in any order and case, and others beside them; a missing
    one is an error.  Only the first header is read beforehand (no inference pass);
    ``enforceSchema`` is off, so that a part file with another header is an error
    instead of a silent column swap.
    """
    reader = spark.read.option("header", True).option("sep", ",")
    names = reader.csv(path).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return conform(reader.schema(text).option("enforceSchema", False).csv(path), schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a folder of CSV part files with headers, one part per task."""
    df.write.mode(mode).option("header", True).option("sep", ",").csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a parquet table; with a schema given, its names hold whatever the case in the files.

    A declared column that the table lacks is an error, not a column of nulls.
    """
    found = spark.read.parquet(path)
    return found if schema is None else conform(found, schema)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    cluster_by: Column | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Write a parquet table; ``options`` go to the writer.

    With ``partition_by``, rows are first rebalanced on those columns: adaptive
    execution merges small pieces and splits an outsized value over several
    tasks, so one hot value neither floods a task nor leaves tiny files.  ``sort_by``
    orders the rows of each file, so that a reader can skip parts of it.  ``cluster_by``
    rebalances on an expression without folders: a file then holds few of its values, and the
    minima and maxima in its footer let a filter on them pass it over.
    """
    if cluster_by is not None:
        dealt = df.withColumn("_cluster", cluster_by).hint("rebalance", F.col("_cluster"))
        df = dealt.drop("_cluster").sortWithinPartitions(*(sort_by or []))
    if not partition_by:
        df.write.mode(mode).options(**(options or {})).parquet(path)
        return
    balanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        balanced = balanced.sortWithinPartitions(*partition_by, *sort_by)
    balanced.write.mode(mode).options(**(options or {})).partitionBy(*partition_by).parquet(path)


def scan(spark: SparkSession, table: str) -> DataFrame:
    """All rows and columns of a table or view known to the session."""
    return spark.table(table)


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with rows added; duplicates are kept."""
    return table.unionByName(rows)


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows in a stated order (a per-task top-n, then a merge)."""
    return df.orderBy(*order_by).limit(n)
