"""Near duplicates among embeddings with a pivot-permutation index.

Reference points, the pivots, are drawn from a bounded sample and kept apart, so that a large group of copies gets one.
Every vector is described by its ``NEAREST`` nearest pivots in order and stands in the inverted list of
each.  Within a list, vectors that share at least ``SHARED`` pivots are candidates; their cosine is then
computed in double precision.  Long lists are compared in blocks.  A pair that shares several pivots counts in the list of the
smallest.  Only sums and a spanning forest of the links leave a task.

The index may miss links; the tests measure its recall against brute force.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors
link only with those of the same length; equal vectors form one class and link with each other; a row with a null id links with nothing and
has a null component; repeated rows are vectors of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_arrow, table, written
from .graph import components, joined_split

NEAREST = 8
SHARED = 2
#: Most pivots, and most vectors that they are drawn from.
MOST_PIVOTS = 8192
#: Pivots for each square root of a vector count.
PER_ROOT = 4
#: Cosine from which a pivot is too close to an earlier one.
APART = 0.8
BLOCK = 256

ASSIGNED = "key long, copies long, pivots array<long>, vector binary"
LINKS = "key long, root long, links long"


def unit(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=-1, keepdims=True)
    return values / np.linalg.norm(values, axis=-1, keepdims=True)


def valid(column: str = "embedding"):
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def choose_pivots(classes: DataFrame) -> list[np.ndarray]:
    """Pivots from a sample in the order of a hash: ``PER_ROOT`` times the root of the number of vectors, at most ``MOST_PIVOTS``."""
    total = classes.count()
    count = min(MOST_PIVOTS, math.ceil(PER_ROOT * math.sqrt(total)))
    # Keys are hashes: a bound on them leaves about twice as many as needed, so that no task hands on more.
    near = classes.where(F.col("key") < int(-(2**63) + 2**64 * (2 * count / total))) if total > 3 * count else classes
    sample = near.orderBy("key").limit(count).select("embedding").toArrow()["embedding"]
    pivots: list[np.ndarray] = []
    for row in sample:
        x = unit(np.array(row.as_py(), np.float64))
        same = [p for p in pivots if len(p) == len(x)]
        if not same or (np.array(same) @ x).max() < APART:
            pivots.append(x)
    return pivots


def assign(classes: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Each class with its nearest pivots, nearest first; vectors of a length without pivots share one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = {n: (np.array([i for i, p in enumerate(pivots) if len(p) == n]), np.array([p for p in pivots if len(p) == n])) for n in {len(p) for p in pivots}}
        for batch in batches:
            rows = [np.array(x, np.float64) for x in batch.column("embedding").to_pylist()]
            nearest: list = [None] * len(rows)
            for length in {len(x) for x in rows}:
                at = [i for i, x in enumerate(rows) if len(x) == length]
                numbers, points = by_length.get(length, (None, None))
                if numbers is None:
                    for i in at:
                        nearest[i] = [-length]
                    continue
                near = unit(np.array([rows[i] for i in at])) @ points.T
                few = np.argsort(-near, axis=1, kind="stable")[:, :NEAREST]
                for i, row in zip(at, numbers[few].tolist()):
                    nearest[i] = row
            yield as_arrow(ASSIGNED, {"key": batch.column("key"), "copies": batch.column("copies"), "pivots": nearest, "vector": [x.tobytes() for x in rows]})

    return classes.mapInArrow(run, ASSIGNED)


def candidates(left: list[list[int]], right: list[list[int]] | None, pivot: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that share at least ``SHARED`` pivots and none below ``pivot``, by counting along the inverted lists of a cell."""
    lists = left + (right or [])
    member = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    point = np.concatenate([np.array(x, np.int64) for x in lists])
    order = np.lexsort((member, point))
    member, point = member[order], point[order]
    begins = np.flatnonzero(np.diff(point, prepend=point[0] - 1))
    n, half = len(lists), len(left) if right is not None else 0
    counts, early = np.zeros((n, n), np.int16), np.zeros((n, n), bool)
    for begin, end in zip(begins, np.append(begins[1:], len(point))):
        if end - begin > 1:
            among = np.ix_(member[begin:end], member[begin:end])
            counts[among] += 1
            if point[begin] < pivot:
                early[among] = True
    good = (counts >= min(SHARED, min(map(len, lists)))) & ~early
    i, j = np.nonzero(np.triu(good, 1))
    if right is not None:
        across = (i < half) & (j >= half)
        i, j = i[across], j[across]
    return i, j


def cell_links(members: list[tuple], sides: int, pivot: int, least: float) -> list[tuple[int, int, int]]:
    """(key, root in this cell, links); members are (key, copies, pivots, vector), the first ``sides`` on the left, all if that is 0."""
    lists = [m[2] for m in members]
    i, j = candidates(lists[:sides] if sides else lists, lists[sides:] if sides else None, pivot)
    if not len(i):
        return []
    if len({len(m[3]) for m in members}) > 1:
        sizes = np.array([len(m[3]) for m in members])
        same = sizes[i] == sizes[j]
        i, j = i[same], j[same]
    vectors = np.zeros((len(members), max(len(m[3]) for m in members)))
    for k, m in enumerate(members):
        vectors[k, : len(m[3])] = m[3]
    vectors = unit(vectors)
    close = np.concatenate([np.einsum("ij,ij->i", vectors[i[a : a + 8192]], vectors[j[a : a + 8192]]) for a in range(0, len(i), 8192)] or [np.empty(0)]) >= least
    i, j = i[close], j[close]
    if not len(i):
        return []
    copies = np.array([m[1] for m in members])
    links = np.bincount(i, copies[j], len(members)) + np.bincount(j, copies[i], len(members))
    labels = np.arange(len(members))
    while True:
        low = np.minimum(labels[i], labels[j])
        new = labels.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == labels).all():
            break
        labels = new
    return [(members[k][0], members[labels[k]][0], int(links[k])) for k in np.flatnonzero(links)]


def compare_cells(cells: DataFrame, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides, out = None, ([], []), []

        def close():
            left, right = sides
            if current and (len(left) > 1 if current[1] == current[2] else left and right):
                out.extend(cell_links(left + right, 0 if current[1] == current[2] else len(left), current[0], least))

        for batch in batches:
            for pivot, low, high, block, key, copies, pivots, vector in zip(*(batch.column(c).to_pylist() for c in ("pivot", "low", "high", "block", "key", "copies", "pivots", "vector"))):
                if current != (pivot, low, high):
                    close()
                    current, sides = (pivot, low, high), ([], [])
                sides[block != low].append((key, copies, pivots, np.frombuffer(vector)))
            if out:
                yield as_arrow(LINKS, dict(zip(("key", "root", "links"), zip(*out))))
                out.clear()
        close()
        if out:
            yield as_arrow(LINKS, dict(zip(("key", "root", "links"), zip(*out))))

    return cells.mapInArrow(run, LINKS)


def near_vectors(rows: DataFrame, least: float = 0.9) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``; links join vectors with a cosine of at least ``least``."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = valid() & F.col("vec_id").isNotNull()
    keyed = rows.select("vec_id", F.when(good, F.xxhash64(F.transform("embedding", lambda x: x + F.lit(0.0)))).alias("key"), F.when(good, F.col("embedding")).alias("embedding"))
    classes = keyed.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("copies"), F.min("vec_id").alias("vec_id"), F.min("embedding").alias("embedding"))
    classes = written(classes, "classes")
    assigned = written(assign(classes, choose_pivots(classes)), "assigned")
    listed = assigned.select("*", F.explode("pivots").alias("pivot"))
    # One row per pivot or vector length: small enough to go everywhere.
    sizes = written(listed.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
    sized = listed.join(F.broadcast(sizes), "pivot").withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    cells = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "pivot", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "copies", "pivots", "vector"
    )
    cells = cells.repartition("pivot", "low", "high").sortWithinPartitions("pivot", "low", "high")
    links = written(compare_cells(cells, least), "links")
    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    placed = classes.select("key", "vec_id", "copies").join(roots.withColumnRenamed("node", "key"), "key", "left").join(counts, "key", "left")
    placed = written(placed.select("key", "vec_id", "copies", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "placed")
    smallest = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    placed = joined_split(placed, smallest, "root").select("key", "component_id", (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"))
    component = F.coalesce("component_id", "vec_id")
    return joined_split(keyed.select("vec_id", "key"), placed, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def op5_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
