"""Jaccard join of documents on word shingles, with token-combination prefixes.

1. A document's set is the hashes of its distinct shingles; equal sets form one class.
2. Linked sets differ in few tokens, so in a common order of the tokens the first ones of either, its
   prefix, must share some.  A class's prefix starts with its private tokens, which yield no signature, goes on
   with rare tokens, which yield one signature each, and ends with frequent ones (in ``FREQUENT`` classes or
   more).  Frequent tokens are dealt into token classes, and of each token class the prefix's
   pairs are signatures; as a token class of n tokens may share one without sharing a pair, it counts
   n - 1 towards the length of the prefix, which is extended accordingly.
   To keep the counting small, tokens are taken from a fixed part of the hash space first, a part that depends on the size
   of the set by powers of two; a class near the lower end of its power joins both.  A set with too few tokens there
   uses all its tokens, the others last.
3. Classes connected by signatures form families.  All pairs of a family are compared exactly inside tasks: families of
   up to ``PIECE`` classes at once; larger ones are packed into pieces, ``BLOCK`` pieces make a block, and a task compares two
   blocks.  Only the packed pieces, sums and a spanning forest of the links leave a task.
4. Components of the links.

Defined results: rows with a null id link with nothing and have a null component, but ``drop_near_duplicates``
links them as any others; a null or empty text has
an empty set and links with nothing; repeated rows and rows sharing an id are returned once each; an empty table gives no
rows; other columns are ignored (``drop_near_duplicates`` keeps them, whatever they are called); of equal candidates the smallest id,
then the smallest hash of the row is a component's first; texts are read whole, in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, as_arrow, free_name, mix, released, shingles, slices, table, text_chunks, words, written
from .graph import components, joined_split

FREQUENT = 16
#: Classes of a piece, and tokens; pieces of a block.
PIECE, PIECE_TOKENS, BLOCK = 64, 1 << 15, 16

SETS = "row long, doc_id long, n long, key long, main boolean, tokens array<long>"
SIGNATURES = "sig long, key long"
MEMBER = "family long, piece int, pieces int, key long, n long, copies long, tokens binary"
LINKS = "key long, root long, links long"
PIECES = f"{LINKS}, family long, piece int, pieces int, size long, packed binary"


def counted_share(scale: int, percent: int) -> float:
    """The part of the hash space whose tokens make prefixes of sets of 2**scale tokens and more."""
    return min(1.0, 1.3 * (1 - percent / 100) + 1.2 / 2 ** (scale / 2))


def share_bound(scale: int, percent: int) -> np.uint64:
    return U64(min(int(counted_share(scale, percent) * 2**64), 2**64 - 1))


def token_classes(scale: int, percent: int) -> int:
    """Number of token classes that frequent tokens are dealt into: some six of a set's tokens to each."""
    return max(1, int(2**scale * counted_share(scale, percent) / 6))


def needed(n: int, percent: int) -> int:
    """Length of a plain prefix: one more than a linked set can miss."""
    return n - -(-percent * n // 100) + 1


def document_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for low, high, data, offsets in text_chunks(batch):
        _, _, owner, hashes = words(data, offsets)
        texts, values = shingles(owner, hashes, k)
        bounds = np.searchsorted(texts, np.arange(high - low + 1))
        for i in range(high - low):
            yield low + i, np.unique(values[bounds[i] : bounds[i + 1]])


def set_key(values: np.ndarray) -> int:
    parts = np.array([values.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(values)), len(values)], np.uint64)
    return int(mix(parts * np.array([1, 3, 5], np.uint64)).sum(dtype=np.uint64).astype(np.int64))


def sets(docs: DataFrame, k: int, percent: int, no_ids: bool) -> DataFrame:
    """Size, class and prefix tokens of each document's set; tokens once per class and task, without an id only with ``no_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            ids, numbers, out = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), []
            for row, values in document_sets(batch, k):
                n = len(values)
                if not n:
                    out.append((numbers[row], ids[row], 0, None, True, None))
                    continue
                key = set_key(values)
                scale, length = n.bit_length() - 1, needed(n, percent)
                scales = [scale] if percent * n >= 100 << scale else [scale, scale - 1]
                for s in scales:
                    tokens = None
                    # Without a miss allowed and below the size from which one is, only equal sets link.
                    if (no_ids or ids[row] is not None) and (key, s) not in met and n * (100 - percent) >= percent:
                        met.add((key, s))
                        salted = mix(values ^ U64(0xD1B54A32D192ED03 * (s + 1) % (1 << 64)))
                        chosen = salted[salted < share_bound(s, percent)]
                        tokens = chosen if len(chosen) - token_classes(s, percent) >= length else salted
                    if s == scale or tokens is not None:
                        out.append((numbers[row], ids[row], n, key, s == scale, None if tokens is None else tokens.astype(np.int64)))
            yield as_arrow(SETS, dict(zip([x.split()[0] for x in SETS.split(", ")], zip(*out) if out else [[]] * 6)))

    return docs.mapInArrow(run, SETS)


def prefix_signatures(n: int, main: bool, size: int, df: np.ndarray, tokens: np.ndarray, percent: int) -> list[int]:
    """Signatures of a set of ``n`` tokens, ``size`` of them candidates for its prefix, with those not private given."""
    scale = n.bit_length() - 1 - (not main)
    parts = token_classes(scale, percent)
    late = tokens.view(np.uint64) >= share_bound(scale, percent)
    order = np.lexsort((tokens, df, late))
    strength, length = size - len(tokens), needed(n, percent)
    out, groups = [], {}
    for t, count in zip(tokens[order].tolist(), df[order].tolist()):
        if strength >= length:
            break
        if count < FREQUENT:
            out.append(t)
            strength += 1
        else:
            group = groups.setdefault((t >> 3) % parts, [])
            strength += bool(group)
            group.append(t)
    for group in groups.values():
        pairs = np.array(list(combinations(sorted(group), 2)), np.int64).view(np.uint64).reshape(-1, 2)
        out += mix(pairs[:, 0] * U64(0xA0761D6478BD642F) + pairs[:, 1]).astype(np.int64).tolist()
    return out


def signatures(hits: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The hits of all rows, one behind the other.
            ends = np.cumsum(batch.column("hits").value_lengths().to_numpy(zero_copy_only=False)).tolist()
            flat = batch.column("hits").flatten()
            df, tokens = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("df", "token"))
            sigs, keys, low = [], [], 0
            for key, main, n, size, high in zip(*(batch.column(c).to_pylist() for c in ("key", "main", "n", "size")), ends):
                found = prefix_signatures(n, main, size, df[low:high], tokens[low:high], percent)
                sigs.append(np.array(found, np.int64))
                keys.append(np.full(len(found), key, np.int64))
                low = high
            if sigs:
                yield as_arrow(SIGNATURES, {"sig": np.concatenate(sigs), "key": np.concatenate(keys)})
        released()

    return hits.mapInArrow(run, SIGNATURES)


def families(found: DataFrame, percent: int) -> DataFrame:
    """(key, family) of every class that shares a signature with another."""
    # A class may come from several tasks; its tokens then count several times, like shared ones, which only costs a signature.
    tokens = found.where("tokens IS NOT NULL")
    place = F.when(F.col("main"), F.col("key")).otherwise(F.bitwise_not("key"))
    shared = tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    shared = written(shared.where("df > 1"), "shared")
    postings = tokens.select(place.alias("place"), F.explode("tokens").alias("token"))
    hits = joined_split(postings, shared, "token").groupBy("place").agg(F.collect_set(F.struct("df", "token")).alias("hits"))
    sizes = tokens.select(place.alias("place"), "key", "main", "n", F.size("tokens").alias("size")).groupBy("place", "key", "main", "n", "size").agg(F.count("*"))
    hits = joined_split(hits, sizes, "place").select("key", "main", "n", "size", "hits")
    sigs = written(signatures(hits, percent), "signatures")
    leaders = sigs.groupBy("sig").agg(F.min("key").alias("leader"), F.max("key").alias("last")).where("leader != last").drop("last")
    edges = joined_split(sigs, leaders, "sig").select(F.col("key").alias("a"), F.col("leader").alias("b"))
    return components(edges).select(F.col("node").alias("key"), F.col("root").alias("family"))


def compare(left: list, right: list | None, percent: int) -> np.ndarray:
    """Which pairs link, as a matrix; members are (key, n, copies, tokens); without ``right`` within ``left``."""
    members = left + (right or [])
    sizes = np.array([m[1] for m in members])
    rows, cols = slice(0, len(left)), slice(len(left) if right else 0, len(members))
    common = np.zeros((len(left), len(right or left)))
    flat = np.concatenate([m[3] for m in members])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(members)), [len(m[3]) for m in members])[order]
    starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    counts = np.diff(starts, append=len(flat))
    # A token of few members counts for each pair of them, one of many in a product of matrices.
    few = int(common.size**0.5) // 8
    for count in range(2, few + 1):
        first, second = np.triu_indices(count, 1)
        begins = starts[counts == count]
        for at in range(0, len(begins), step := max(1, (1 << 20) // len(first))):
            own = owner[begins[at : at + step, None] + np.arange(count)]
            a, b = own[:, first].ravel(), own[:, second].ravel() - cols.start
            if right:
                across = (a < len(left)) & (b >= 0)
                a, b = a[across], b[across]
            np.add.at(common.ravel(), a * common.shape[1] + b, 1)
    if not right:
        common += common.T
    many = counts > max(few, 1)
    kept = np.repeat(many, counts)
    owner, column = owner[kept], np.repeat(np.arange(np.count_nonzero(many)), counts[many])
    for at in range(0, np.count_nonzero(many), step := max(64, (1 << 22) // len(members))):
        low, high = np.searchsorted(column, [at, at + step])
        dense = np.zeros((len(members), min(step, np.count_nonzero(many) - at)), np.float32)
        dense[owner[low:high], column[low:high] - at] = 1
        common += dense[rows] @ dense[cols].T
    return 100 * common >= percent * (sizes[rows][:, None] + sizes[cols][None, :] - common)


def linked(left: list, right: list | None, percent: int) -> list[tuple[int, int, int]]:
    """(key, root in this cell, links) of each member with a link here."""
    match = compare(left, right, percent)
    members, n = left + (right or []), len(left) + len(right or [])
    if not right:
        np.fill_diagonal(match, False)
    if not match.any():
        return []
    copies = np.array([m[2] for m in members])
    links = np.concatenate([match @ copies[len(left) :], copies[: len(left)] @ match]) if right else match @ copies
    labels = np.arange(n, dtype=np.int32)
    while True:
        least = np.where(match, labels[None, len(left) if right else 0 :], n).min(axis=1)
        if right:
            least = np.concatenate([least, np.where(match, labels[: len(left), None], n).min(axis=0)])
        new = np.minimum(labels, least)
        # The root takes the smaller label as well, and what hangs on it follows.
        np.minimum.at(new, labels, new.copy())
        while (new[new] != new).any():
            new = new[new]
        if (new == labels).all():
            break
        labels = new
    return [(members[i][0], members[labels[i]][0], int(links[i])) for i in np.flatnonzero(links)]


def packed(members: list) -> np.ndarray:
    """Members as one array of 64-bit numbers."""
    head = [len(members), *(m[k] for k in range(3) for m in members)]
    return np.concatenate([np.array(head, np.int64).view(np.uint64), *(m[3] for m in members)])


def unpacked(values: np.ndarray) -> list:
    count = int(values[0])
    keys, sizes, copies = values[1 : 1 + 3 * count].view(np.int64).reshape(3, count)
    tokens = np.split(values[1 + 3 * count :], np.cumsum(sizes)[:-1])
    return list(zip(keys.tolist(), sizes.tolist(), copies.tolist(), tokens))


def piece_links(members: DataFrame, percent: int) -> DataFrame:
    """Links of each family of one piece; of larger ones the pieces, packed; rows of a piece follow one another.

    Near copies repeat one another's tokens, so that a packed piece takes a fraction of its members' bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found, out = None, {}, []

        def close():
            if current is not None:
                whole = list(found.values())
                if current[2] > 1:
                    values = packed(whole)
                    out.append((None, None, None, *current, values.nbytes, pa.compress(values.tobytes(), codec="zstd", asbytes=True)))
                elif len(whole) > 1:
                    out.extend((*x, None, None, None, None, None) for x in linked(whole, None, percent))

        def flush():
            names = [x.split()[0] for x in PIECES.split(", ")]
            return as_arrow(PIECES, dict(zip(names, zip(*out) if out else [[]] * len(names))))

        for batch in slices(batches):
            for family, piece, pieces, key, n, copies, tokens in zip(*(batch.column(c).to_pylist() for c in ("family", "piece", "pieces", "key", "n", "copies", "tokens"))):
                if current != (family, piece, pieces):
                    close()
                    current, found = (family, piece, pieces), {}
                # By class: an id that comes with the same text twice brings it twice.
                found[key] = (key, n, copies, np.frombuffer(tokens, np.uint64))
            if out:
                yield flush()
                out.clear()
        close()
        yield flush()
        released()

    return members.mapInArrow(run, PIECES)


def cell_links(cells: DataFrame, percent: int) -> DataFrame:
    """Links within each cell, two blocks of packed pieces; rows of a cell follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides, out = None, ([], []), []

        def close():
            if current is not None:
                left, right = sides
                diagonal = current[1] == current[2]
                if len(left) > 1 if diagonal else left and right:
                    out.extend(linked(left, None if diagonal else right, percent))

        def flush():
            columns = zip(*out) if out else [[]] * 3
            return as_arrow(LINKS, dict(zip(("key", "root", "links"), columns)))

        for batch in slices(batches, 1):
            family, low, high, block, size, data = (batch.column(c)[0] for c in ("family", "low", "high", "block", "size", "packed"))
            cell = family.as_py(), low.as_py(), high.as_py()
            if current != cell:
                close()
                current, sides = cell, ([], [])
                if out:
                    yield flush()
                    out.clear()
            sides[block.as_py() != cell[1]].extend(unpacked(np.frombuffer(pa.decompress(data.as_buffer(), size.as_py(), codec="zstd"), np.uint64)))
        close()
        yield flush()
        released()

    return cells.mapInArrow(run, LINKS)


def member_sets(members: DataFrame, k: int) -> DataFrame:
    """The whole token sets of class representatives, from their texts; once per task where the row is repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in MEMBER.split(", ")][:-1]
        met: set[tuple[int, int]] = set()
        for batch in batches:
            families, keys, rows, tokens = batch.column("family").to_pylist(), batch.column("key").to_pylist(), [], []
            for row, values in document_sets(batch, k):
                if len(values) and (families[row], keys[row]) not in met and set_key(values) == keys[row]:
                    met.add((families[row], keys[row]))
                    rows.append(row)
                    tokens.append(values.tobytes())
            part = batch.take(pa.array(rows, pa.int64()))
            yield as_arrow(MEMBER, {n: part.column(n) for n in names} | {"tokens": tokens})

    return members.mapInArrow(run, MEMBER)


def with_rows(docs: DataFrame, name: str = "_row") -> DataFrame:
    """The documents with a number ``name`` made of id and text, which repeated rows share."""
    return docs.withColumn(name, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, no_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, n_links`` and ``_row, kept``.

    Sets of ``k``-word shingles link when their Jaccard similarity is at least ``percent`` hundredths.
    ``n_links`` counts the other documents that a document links with directly, equal sets included.
    ``kept`` marks one document of each component, one with the smallest id, and all that link with nothing.
    With ``no_ids`` rows without an id link as well; they are kept only where no row with one links.
    """
    docs = with_rows(docs).select(F.col("_row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = written(sets(docs, k, percent, no_ids), "sets")
    every = found.where("main").select("row", "doc_id", "n", "key")
    alone = F.col("doc_id").isNull() & ~F.lit(no_ids)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    classes = every.where(F.col("key").isNotNull() & ~alone).groupBy("key", "n").agg(first, F.count("*").alias("copies"))
    classes = written(classes.select("key", "n", "first", "first.row", "copies"), "classes")
    family = written(families(found, percent), "families")
    members = family.join(classes.drop("first"), "key")
    sizes = members.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / PIECE, F.sum("n") / PIECE_TOKENS)).cast("int").alias("pieces"))
    members = joined_split(members, sizes, "family").withColumn("piece", F.pmod(F.xxhash64("key"), "pieces").cast("int"))
    # A class's representative is one id and text, but these may come in several rows.
    whole = member_sets(joined_split(docs.select("row", "text"), members, "row"), k)
    pieces = whole.repartition("family", "piece").sortWithinPartitions("family", "piece")
    pieces = written(piece_links(pieces, percent), "pieces")
    block, last = F.floor(F.col("piece") / BLOCK).cast("int"), F.floor((F.col("pieces") - 1) / BLOCK).cast("int")
    cells = pieces.where("packed IS NOT NULL").select("family", block.alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("other"), "size", "packed")
    cells = cells.select("family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "size", "packed")
    cells = cells.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high")
    links = pieces.where("key IS NOT NULL").select("key", "root", "links").unionByName(cell_links(cells, percent))
    links = written(links, "links")
    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    placed = classes.drop("row").join(roots.withColumnRenamed("node", "key"), "key", "left").join(counts, "key", "left")
    placed = written(placed.select("key", "first", "copies", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "placed")
    smallest = placed.groupBy("root").agg(F.min("first").alias("first"))
    placed = joined_split(placed.drop("first"), smallest, "root").select("key", "first", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    out = joined_split(every, placed, "key", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(~alone, F.coalesce("first.doc_id", "doc_id")).alias("component_id"),
        F.when(alone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.col("row").alias("_row"),
        (alone | F.col("first").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each component one row stays, also among null ids; empty texts stay all."""
    row, more, lone = (free_name(docs.columns, c) for c in ("_row", "_several", "_lone"))
    found = jaccard_components(docs, k, percent, no_ids=True).where("kept").withColumnRenamed("_row", row)
    kept = written(found.groupBy(row).agg((F.count("*") > 1).alias(more), F.first(F.col("n_shingles").eqNullSafe(0)).alias(lone)), "kept")
    several = F.col(more) & ~F.col(lone)
    rows = joined_split(with_rows(docs, row), kept, row)
    if kept.where(several).isEmpty():
        return rows.select(*docs.columns)
    # A row that comes several times, the same id and text, stays once.
    once = rows.where(several).dropDuplicates([row])
    return rows.where(~several).unionByName(once).select(*docs.columns)


def op9_jaccard(spark, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")
