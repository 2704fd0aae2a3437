"""Tables laid out for filters on any of several columns: Z-order by ranks.

Sorting by one column serves filters on that column alone.  Here every value is ranked among its column's values, and
rows are dealt and sorted by the bits of all ranks in turns.  A file, and a row group in it, then holds a small
range of each column, and the minima and maxima in the footers let a reader pass over most row groups for a
filter on any of the columns, with plain Parquet and no index of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.sources.files import write_table

#: Ranks have this many bits: 256 ranges of each column's values.
BITS = 8
#: Distinct values of a column that come to the driver to find the ranges, about.
SAMPLED = 8_192


def rank_bounds(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list]:
    """For each column, up to ``2 ** bits - 1`` of its values that cut it into ranges with about as many distinct values.

    Where a column has many distinct values, a range of their hashes picks ``SAMPLED`` of them, about.
    """
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    bounds = {}
    for c in columns:
        values = df.select(c).where(F.col(c).isNotNull())
        share = SAMPLED / max(counts[c], 1)
        if share < 1:
            values = values.where(F.xxhash64(c) < int(-(2**63) + 2**64 * share))
        found = sorted(r[0] for r in values.distinct().collect())
        cuts = min(len(found), 2**bits) - 1
        bounds[c] = [found[(k + 1) * len(found) // (cuts + 1)] for k in range(max(cuts, 0))]
    return bounds


def rank(column: Column, bounds: list) -> Column:
    """How many of the ascending ``bounds`` are not above the value; 0 for a missing one.  A tree of comparisons."""

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column < F.lit(bounds[middle]), below(low, middle)).otherwise(below(middle + 1, high))

    return F.when(column.isNull(), F.lit(0)).otherwise(below(0, len(bounds)))


def z_value(ranks: list[Column], bits: int = BITS) -> Column:
    """The bits of all ranks in turns, the first rank's before the others', the highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r, bit).bitwiseAND(F.lit(1)))
    return out


def write_clustered(
    df: DataFrame,
    path: str,
    columns: list[str],
    mode: str = "overwrite",
    then_by: list[str] | None = None,
    files: int | None = None,
    row_group_bytes: int = 32 << 20,
) -> None:
    """Write a parquet table in the Z-order of ``columns``; rows of equal ranks in the order of ``columns`` and ``then_by``.

    Ranges of the Z-order are dealt to tasks, rows of one value by what follows it in the order, so that a hot value fills
    several files.  ``row_group_bytes`` is the unit that a reader can pass over.
    """
    bounds = rank_bounds(df, columns)
    # Ranks as columns of their own: each is used once for every bit.
    ranks = {f"_rank{k}": rank(F.col(c), bounds[c]) for k, c in enumerate(columns)}
    order = ["_z", *columns, *(then_by or [])]
    keyed = df.withColumns(ranks).withColumn("_z", z_value([F.col(r) for r in ranks])).drop(*ranks)
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    laid = ranged.sortWithinPartitions(*order).drop("_z")
    write_table(laid, path, mode, options={"parquet.block.size": str(row_group_bytes)})
