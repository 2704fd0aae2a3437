"""Keyed look-ups, existence tests and one-row-per-key selection.

Keys compare null-safe: two missing values are the same key.  Look-up sides are
always reduced to one row per key by an aggregate with a map-side part before
they meet the big side, and the joins are plain shuffled joins whose big side
adaptive execution can split when one key holds an outsized share of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RIGHT = "_right_"


def match_null_safe(
    left: DataFrame, right: DataFrame, keys: list[str] | dict[str, str], how: str
) -> DataFrame:
    """Join on equal keys where null equals null; the left key columns are kept.

    ``keys`` is a list of shared names, or a mapping from left to right names.
    """
    pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
    right_keys = {name.lower() for name in pairs.values()}
    renamed = right.select(
        *[F.col(r).alias(_RIGHT + r) for r in pairs.values()],
        *[F.col(c) for c in right.columns if c.lower() not in right_keys],
    )
    condition = reduce(
        lambda a, b: a & b, [left[l].eqNullSafe(renamed[_RIGHT + r]) for l, r in pairs.items()]
    )
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[_RIGHT + r for r in pairs.values()])


def one_value_per_key(
    df: DataFrame, keys: list[str], values: list[str], keep: str = "first"
) -> DataFrame:
    """One row per key: the one with the smallest (``first``) or largest (``last``) value.

    Of several values the first decides, then the next, so that all come from one
    row.  A missing value loses to any other.  The values are narrowed down one after another by
    plain aggregates, which are hashed; a pick of whole structs would sort.
    """
    pick = {"first": F.min, "last": F.max}[keep]
    by = {"first": F.min_by, "last": F.max_by}[keep]
    *ordered, final = values
    picked = df.groupBy(*keys, *ordered).agg(pick(final).alias(final))
    for k in range(len(ordered) - 1, -1, -1):
        lead = ordered[k]

        def beside(value: str, lead: str = lead) -> Column:
            # One row is left for each leading value; that of the missing one counts only where no other is.
            alone = pick(F.when(F.col(lead).isNull(), F.col(value)))
            return F.when(pick(lead).isNull(), alone).otherwise(by(value, lead)).alias(value)

        rest = [beside(value) for value in values[k + 1 :]]
        picked = picked.groupBy(*keys, *ordered[:k]).agg(pick(lead).alias(lead), *rest)
    return picked.select(*keys, *values)


def dedupe(df: DataFrame, keys: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One whole row per key: the first or last one by ``order``.

    A missing order value loses to any other.  Ties are broken by the remaining
    columns, so the result is always the same.  The pick is an aggregate, so
    each task reduces its own rows before the shuffle and a key with many copies
    stays small.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if len(order) == 1 and not rest:
        return one_value_per_key(df, keys, order, keep).select(*df.columns)
    pick, loses = {
        "first": (F.min, Column.isNull),
        "last": (F.max, Column.isNotNull),
    }[keep]
    ranked = [part for c in order for part in (loses(F.col(c)).alias(f"_{c}"), F.col(c))]
    row = F.struct(*ranked, *[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(pick(row).alias("_row"))
    return picked.select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: list[str] | dict[str, str],
    values: dict[str, str],
    keep: str = "first",
) -> DataFrame:
    """Attach values found by key; null where the key is unknown.

    ``values`` maps column names in ``table`` to the names they get in the result.
    """
    table_keys = list(keys.values()) if isinstance(keys, dict) else list(keys)
    found = one_value_per_key(table, table_keys, list(values), keep)
    renamed = found.select(*table_keys, *[F.col(c).alias(new) for c, new in values.items()])
    return match_null_safe(df, renamed, keys, "left")


def exists_in(df: DataFrame, table: DataFrame, keys: list[str] | dict[str, str]) -> DataFrame:
    """Rows whose key occurs in ``table``."""
    table_keys = list(keys.values()) if isinstance(keys, dict) else list(keys)
    return match_null_safe(df, table.select(*table_keys).distinct(), keys, "left_semi")


def not_in(df: DataFrame, table: DataFrame, keys: list[str] | dict[str, str]) -> DataFrame:
    """Rows whose key does not occur in ``table``."""
    table_keys = list(keys.values()) if isinstance(keys, dict) else list(keys)
    return match_null_safe(df, table.select(*table_keys).distinct(), keys, "left_anti")


def scalar_of(df: DataFrame, aggregate: Column) -> Column:
    """A whole-table aggregate as a value usable in any expression.

    It becomes a scalar subquery: no join, and a filter that compares a column
    with it is still pushed to the parquet scan.
    """
    return df.agg(aggregate).scalar()


def with_scalar(df: DataFrame, name: str, aggregate: Column) -> DataFrame:
    """Every row with a whole-table aggregate beside it."""
    return df.withColumn(name, scalar_of(df, aggregate))


def min_value(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.min(F.col(column).cast("int")).alias(alias))


def max_value(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.max(column).alias(alias))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))
