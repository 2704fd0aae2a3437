"""Database tables through Spark's JDBC source.

Connection settings always come from the caller.  A read must say how it is
split: either bounds of a numeric or date column, or a list of predicates that
together cover the table once.  Otherwise one task would pull the whole table
over one connection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.sources.files import normalize_columns


def split_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """JDBC options that split a read by ranges of a column."""
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def label_predicates(column: str, cuts: Sequence[str]) -> list[str]:
    """Predicates that cover a text column once, cut at the given sorted labels."""
    if not cuts:
        raise ValueError("at least one cut is needed")
    if list(cuts) != sorted(set(cuts)) or not all(c.isalnum() for c in cuts):
        raise ValueError("cuts must be distinct, sorted, and made of letters and digits")
    first = f"{column} < '{cuts[0]}' OR {column} IS NULL"
    middle = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(cuts, cuts[1:])]
    return [first, *middle, f"{column} >= '{cuts[-1]}'"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    split: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table in parallel; filters and column choices run in the database.

    Names come in lower case; ``schemas.conform`` gives them their declared form.
    """
    if (split is None) == (predicates is None):
        raise ValueError("give either split (see split_options) or predicates")
    settings = {"fetchsize": str(fetch_size), **properties}
    if predicates is not None:
        rows = spark.read.jdbc(url, table, predicates=list(predicates), properties=settings)
    else:
        rows = spark.read.format("jdbc").options(url=url, dbtable=table, **settings, **split).load()
    return normalize_columns(rows)


def read_parameters(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], names: Sequence[str]
) -> DataFrame:
    """Read the parameter table: the database reduces it to one row per known name."""
    rows = spark.read.format("jdbc").options(url=url, query=parameter_query(table, names), **properties).load()
    return rows.select(F.col("parameter"), F.col("value").cast("string").alias("value"))


def parameter_query(table: str, names: Sequence[str]) -> str:
    """The largest value of each name, compared as numbers also where the column holds text."""
    wanted = ", ".join("'{}'".format(name.replace("'", "''")) for name in names)
    return (
        f"SELECT parameter, MAX(CAST(value AS DECIMAL(20, 4))) AS value FROM {table} "
        f"WHERE parameter IN ({wanted}) GROUP BY parameter"
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    mode: str = "overwrite",
    connections: int = 16,
    batch_size: int = 10_000,
    truncate: bool = False,
) -> None:
    """Write a table over a bounded number of connections, upper-case column names.

    The rows are dealt anew to that many tasks: a bound on the connections alone would make the
    stage before run in as few.  ``truncate`` keeps a table that is overwritten, with its
    types and grants, instead of dropping it.
    """
    written = outgoing(df, connections).write.mode(mode).options(**write_options(connections, batch_size, truncate))
    written.jdbc(url, table, properties=dict(properties))


def outgoing(df: DataFrame, connections: int) -> DataFrame:
    """The rows as they go out: upper-case names, one task per connection."""
    return df.toDF(*[c.upper() for c in df.columns]).repartition(connections)


def write_options(connections: int, batch_size: int, truncate: bool) -> dict[str, str]:
    return {
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": str(truncate).lower(),
    }
