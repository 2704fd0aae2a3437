"""Removal of long repeated byte strings with suffix arrays built by two-stage sorting.

A suffix array over a whole corpus fits no task, so the windows of ``length`` bytes are first dealt
out such that equal windows meet.  The smallest hash among a window's grams of ``GRAM`` bytes is its
anchor; neighbouring windows mostly share theirs and make up one block, a stretch of text.

1. Blocks whose anchor occurs once hold nothing repeated.  Where all blocks of an anchor are equal,
   they are repeated as a whole, as are equal ones among several; one of each kind goes on.
2. Different blocks of one anchor overlap in part.  Their bytes are sorted in tasks: two-stage sorting orders directly only
   the suffixes smaller than their successors, the others follow from scans over the buckets; adjacent common prefixes
   of at least ``length`` bytes mark repeated windows.
3. An anchor with many blocks would overload a task.  Its blocks are cut into pieces of ``STEP`` windows, and
   pieces meet only where the bytes that all their windows share are equal.  Where still too many meet, at the
   ends of a passage that stands in very many texts, single windows do.

Defined results: a null or empty text, and any shorter than ``length``, keeps all its bytes; repeated rows are repeated text, so both
lose it; a null id is kept as such; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, as_arrow, table, text_chunks, written
from .graph import joined_split

LENGTH = 400
GRAM = 128
#: Blocks of one anchor that are sorted together; more are cut into pieces.
TOGETHER = 64
STEP = 16
#: Bytes sorted at once, if no single anchor has more.
SORTED_BYTES = 2 << 20

#: Low bits of a gram's hash that give way to its place, more than a window's grams need.
PLACE_BITS = U64(9)

BLOCKS = "row long, start long, size int, anchor long, content long, again boolean"
SLICES = "anchor long, hot boolean, row long, start long, many boolean, bytes binary"
PIECES = "bucket long, content long, row long, start long, size int, many boolean"
WINDOWS = "window long, row long, start long, many boolean"
SPANS = "row long, start long, stop long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values, by doubling."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def find_blocks(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text number, first byte in it, bytes, anchor, content hash, whether a window has its anchor twice) of every block."""
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty, empty.astype(bool)
    hashes = SpanHash(data)
    grams = hashes.windows(GRAM)
    grams &= ~U64(511)
    place = np.arange(len(grams), dtype=np.uint64) & U64(511)
    # Ties are won by another place when places count backwards.
    anchor = sliding_min(grams | place, length - GRAM + 1)
    backwards = sliding_min(grams | (place ^ U64(511)), length - GRAM + 1)
    tied = np.concatenate([[0], np.cumsum((anchor ^ backwards) != U64(511))])
    anchor >>= PLACE_BITS
    sizes = np.diff(offsets)
    inside = np.zeros(len(anchor) + 1, np.int8)
    long = np.flatnonzero(sizes >= length)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long] + sizes[long] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    begins = inside.copy()
    begins[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    begins[offsets[long]] = True
    starts = np.flatnonzero(begins)
    owner = np.searchsorted(offsets, starts, "right") - 1
    counts = np.minimum(np.append(starts[1:], len(anchor)), offsets[owner] + sizes[owner] - length + 1) - starts
    # One anchor value may repeat on and on, in periodic text: cut there.
    most = length - GRAM + 1
    parts = -(-counts // most)
    which = np.repeat(np.arange(len(starts)), parts)
    step = (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * most
    starts, owner, counts = starts[which] + step, owner[which], np.minimum(counts[which] - step, most)
    bytes_ = counts + length - 1
    return owner, starts - offsets[owner], bytes_, anchor[starts].astype(np.int64), hashes.spans(starts, starts + bytes_).astype(np.int64), tied[starts + counts] > tied[starts]


def blocks(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for low, _, data, offsets in text_chunks(batch):
                owner, start, size, anchor, content, again = find_blocks(data, offsets, length)
                yield as_arrow(BLOCKS, {"row": rows[low + owner], "start": start, "size": size.astype(np.int32), "anchor": anchor, "content": content, "again": again})

    return docs.mapInArrow(run, BLOCKS)


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` bytes at least, by two-stage sorting."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    # A suffix is smaller than its successor when the byte after its leading run of equal bytes is larger.
    changes = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)
    following = changes[np.searchsorted(changes, np.arange(n))]
    small = np.zeros(n, bool)
    inner = following < n - 1
    small[inner] = data[following[inner]] < data[following[inner] + 1]

    counts, larger = np.bincount(data, minlength=256), np.bincount(data[~small], minlength=256)
    first = np.cumsum(counts) - counts
    order = np.empty(n, np.int64)

    # Stage one: sort the small suffixes directly, bucket by bucket of their first two bytes.
    text = data.tobytes()
    at = np.flatnonzero(small)
    pair = data[at].astype(np.int32) << 8 | data[at + 1]
    grouped = np.argsort(pair, kind="stable")
    at, pair = at[grouped], pair[grouped]
    edges = np.flatnonzero(np.diff(pair, prepend=-1, append=-1))
    place = first + larger
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        c = int(pair[low]) >> 8
        bucket = at[low:high].tolist()
        if len(bucket) > 1:
            bucket.sort(key=lambda i: text[i + 2 : i + 2 + depth])
        order[place[c] : place[c] + high - low] = bucket
        place[c] += high - low

    # Stage two: a suffix larger than its successor stands, in its bucket, in the order of the successors.
    head = first.copy()

    def induce(found: np.ndarray) -> None:
        before = found - 1
        before = before[before >= 0]
        before = before[~small[before]]
        if not len(before):
            return
        chars = data[before]
        by = np.argsort(chars, kind="stable")
        before, chars = before[by], chars[by]
        cuts = np.flatnonzero(np.diff(chars.astype(np.int16), prepend=-1, append=-1))
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            c = chars[low]
            order[head[c] : head[c] + high - low] = before[low:high]
            head[c] += high - low

    induce(np.array([n]))
    for c in np.flatnonzero(counts).tolist():
        low = first[c]
        while low < head[c]:
            high = head[c]
            induce(order[low:high])
            low = high
        induce(order[first[c] + larger[c] : first[c] + counts[c]])
    return order


def common_prefixes(data: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``left`` and ``right``, up to ``most``; hashes of spans halve the rest each time."""
    hashes, found = SpanHash(data), np.zeros(len(left), np.int64)
    limit = np.minimum(most, len(data) - np.maximum(left, right))
    step = 1 << (most.bit_length() - 1)
    while step:
        fits = found + step <= limit
        end = np.where(fits, step, 0)
        same = hashes.spans(left + found, left + found + end) == hashes.spans(right + found, right + found + end)
        found += np.where(fits & same, step, 0)
        step >>= 1
    return found


def repeated_windows(slices: list[bytes], length: int) -> list[np.ndarray]:
    """For each slice which of its windows also start elsewhere among the slices."""
    sizes = np.array([len(s) for s in slices])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(slices), np.uint8)
    window = np.zeros(len(data), bool)
    for end, size in zip(ends, sizes):
        window[end - size : end - length + 1] = True
    order = suffix_array(data, length)
    order = order[window[order]]
    close = common_prefixes(data, order[:-1], order[1:], length) >= length
    again = np.zeros(len(data), bool)
    again[order[:-1][close]] = True
    again[order[1:][close]] = True
    return [again[end - size : end - length + 1] for end, size in zip(ends, sizes)]


def sort_slices(pieces: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows among pieces of one bucket; a bucket's rows follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bool, bytes]] = []
        total, last, alone = 0, None, 0

        def flush():
            out = []
            for (row, start, many, _), again in zip(held, repeated_windows([h[3] for h in held], length)):
                if many:
                    continue
                edge = np.flatnonzero(np.diff(again.astype(np.int8), prepend=0, append=0))
                out += [(row, start + int(a), start + int(b) + length - 1) for a, b in zip(edge[::2], edge[1::2])]
            return as_arrow(SPANS, dict(zip(("row", "start", "stop"), zip(*out) if out else [[]] * 3)))

        for batch in batches:
            for bucket, row, start, many, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "row", "start", "many", "bytes"))):
                if bucket != last and total >= SORTED_BYTES:
                    yield flush()
                    held.clear()
                    total = 0
                last = bucket
                held.append((row, start, many, data))
                total += len(data)
        if held:
            yield flush()

    return pieces.mapInArrow(run, SPANS)


def slices(mixed: DataFrame) -> DataFrame:
    """The bytes of blocks, from rows of a text and the places of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text, places in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("places").to_pylist()):
                data = text.as_py().encode()
                out += [(p["anchor"], p["hot"], row, p["start"], p["many"], data[p["start"] : p["start"] + p["size"]]) for p in places]
            yield as_arrow(SLICES, dict(zip([x.split()[0] for x in SLICES.split(", ")], zip(*out) if out else [[]] * 6)))

    return mixed.mapInArrow(run, SLICES)


def pieces(hot: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """Blocks cut into at most ``STEP`` windows at fixed distances from the anchor; the bucket is what all these windows share."""
    schema = PIECES + (", bytes binary" if with_bytes else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            out = []
            for anchor, row, start, many, block in zip(*(batch.column(c).to_pylist() for c in ("anchor", "row", "start", "many", "bytes"))):
                data = np.frombuffer(block, np.uint8)
                hashes, count = SpanHash(data), len(data) - length + 1
                anchors = np.flatnonzero((hashes.windows(GRAM) >> PLACE_BITS).astype(np.int64) == anchor)
                windows = np.arange(count)
                ahead = anchors[np.searchsorted(anchors, windows)] - windows
                # Equal windows have their first anchor at the same distance: same group, same place in it.
                group = ahead // STEP
                cuts = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(ahead, prepend=0) > 0))
                stops = np.append(cuts[1:], count)
                # All windows of a group, were it whole, share the bytes from its last window's start to its first one's end.
                low = cuts + ahead[cuts] - group[cuts] * STEP
                high = low - (STEP - 1) + length
                core = hashes.spans(low, high) * np.uint64(0x9E3779B97F4A7C15) + group[cuts].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                content = hashes.spans(cuts, stops + length - 1) ^ (stops - cuts).astype(np.uint64)
                for a, b, bucket, c in zip(cuts.tolist(), stops.tolist(), core.astype(np.int64).tolist(), content.astype(np.int64).tolist()):
                    item = (bucket, c, row, start + a, b - a + length - 1, many)
                    out.append((*item, block[a : b + length - 1]) if with_bytes else item)
            yield as_arrow(schema, dict(zip(names, zip(*out) if out else [[]] * len(names))))

    return hot.mapInArrow(run, schema)


def single_windows(crowded: DataFrame, length: int) -> DataFrame:
    """Every window of the given pieces by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in WINDOWS.split(", ")]
        for batch in batches:
            parts = []
            for row, start, many, data in zip(*(batch.column(c).to_pylist() for c in ("row", "start", "many", "bytes"))):
                found = SpanHash(np.frombuffer(data, np.uint8)).windows(length).astype(np.int64)
                parts.append((found, np.full(len(found), row), start + np.arange(len(found)), np.full(len(found), many)))
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[]] * 4
            yield as_arrow(WINDOWS, dict(zip(names, columns)))

    return crowded.mapInArrow(run, WINDOWS)


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(row, start, stop) of stretches all of whose windows are repeated; every repeated window is in one."""
    found = written(blocks(docs, length), "blocks")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"), F.max("again").alias("again"))
    same = (F.col("low") == F.col("high")) & ~F.col("again")
    anchors = written(anchors.where("n > 1 OR again").select("anchor", same.alias("same"), F.col("low").alias("content")), "anchors")
    near = joined_split(found.drop("again"), anchors.where(~F.col("same")).select("anchor"), "anchor")
    contents = near.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.min(F.struct("row", "start", "size")).alias("one"))
    contents = written(contents, "contents")
    # From all blocks, in the order of the texts: dealt by anchor before, all copies of a block would come from a few tasks.
    copied = anchors.where("same").select("anchor", "content").unionByName(contents.where("times > 1").select("anchor", "content"))
    whole = found.alias("f").join(copied.alias("c"), F.expr("f.content <=> c.content AND f.anchor <=> c.anchor"), "left_semi")
    kinds = contents.groupBy("anchor").agg((F.count("*") > TOGETHER).alias("hot"))
    reps = joined_split(contents, kinds, "anchor").select("one.*", "anchor", "hot", (F.col("times") > 1).alias("many"))
    by_row = reps.groupBy("row").agg(F.collect_list(F.struct("start", "size", "anchor", "hot", "many")).alias("places"))
    cut = written(slices(docs.join(by_row, "row").select("row", "text", "places")), "slices")

    hot = cut.where("hot")
    parts = pieces(hot, length, False)
    kept = parts.groupBy("bucket", "content").agg(F.count("*").alias("times"), F.max("many").alias("many"), F.min(F.struct("row", "start", "size")).alias("one"))
    kept = written(kept, "pieces")
    twice = kept.where("times > 1").select("bucket", F.col("content").alias("__content"))
    also = parts.join(twice, parts["content"].eqNullSafe(twice["__content"]) & parts["bucket"].eqNullSafe(twice["bucket"]), "left_semi")
    several = kept.groupBy("bucket").agg(F.count("*").alias("kinds")).where("kinds > 1").select("bucket", (F.col("kinds") > TOGETHER).alias("crowded"))
    rest = joined_split(kept, several, "bucket").select(
        "bucket", "crowded", F.col("one.row").alias("row"), F.col("one.start").alias("start"), (F.col("many") | (F.col("times") > 1)).alias("many")
    )
    rest = pieces(hot, length, True).drop("many").join(rest, ["bucket", "row", "start"]).select("bucket", "crowded", "row", "start", "many", "bytes")
    rest = written(rest, "rest")
    windows = single_windows(rest.where("crowded"), length)
    repeated = windows.groupBy("window").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("times")).where("times > 1").select("window")
    windows = joined_split(windows, repeated, "window").where(~F.col("many"))
    rest = rest.where(~F.col("crowded")).drop("crowded")
    cold = cut.where(~F.col("hot")).select(F.col("anchor").alias("bucket"), "row", "start", "many", "bytes")
    ready = cold.unionByName(rest).repartition("bucket").sortWithinPartitions("bucket", "row", "start")
    # Written first, so that these joins, with many small rows, are not planned in one stage with the sorting, with few large ones.
    stop = (F.col("start") + F.col("size")).alias("stop")
    equal = written(whole.select("row", "start", stop).unionByName(also.select("row", "start", stop)), "equal")
    return equal.unionByName(windows.select("row", "start", (F.col("start") + length).alias("stop"))).unionByName(sort_slices(ready, length))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def with_rows(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.withColumn("row", F.xxhash64("doc_id", "text"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, and the hash of what is kept."""
    docs = with_rows(docs)
    spans = repeated_spans(docs.select("row", "text"), length)
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans").to_pylist()):
                data, gone, kept, at = text.as_py().encode(), merged(found or []), hashlib.sha256(), 0
                for a, b in gone:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out.append((doc_id, len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
            yield as_arrow(RESULT, dict(zip([x.split()[0] for x in RESULT.split(", ")], zip(*out) if out else [[]] * 5)))

    return docs.join(by_row, "row", "left").select("doc_id", "text", "spans").mapInArrow(run, RESULT)


def op3_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
