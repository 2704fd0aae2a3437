"""Document fingerprints by context-triggered piecewise hashing.

1. A rolling hash of the last ``WINDOW`` bytes ends a chunk where its low bits are all ones.  How many bits follows from the text's length:
   the block size is the smallest power of two that gives ``CHUNKS`` chunks or fewer on average.  A place less than
   a quarter of a block behind the last end is passed over, and a chunk of four blocks ends in any case: texts that say the same again and again
   have few or very many places, and would else have one chunk or as many as bytes.
2. Each chunk becomes two letters of its hash, a signature those of all chunks.  A fingerprint is
   ``block:signature:signature at twice the block``.
3. Fingerprints are compared where a block size is in both, by the edit distance of the signatures (one for each chunk put in or left
   out): ``1 - distance / chunks of both``, the larger one of two; without a common size they are not alike at all.

An edit moves the chunk ends in its neighbourhood only, so the chunks before and after keep their letters.
Each letter pair has 12 bits: two different chunks share one by chance in one case of 4,096.

Defined results: a null text is an empty one, whose signatures are empty; empty texts are like each other (1.0) and like no
other text (0.0); rows with a null id come first; rows that share an id follow one another by the hash of their texts, repeated ones
in any order, which changes no result; one row follows itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, SpanHash, as_arrow, table, text_chunks, written

WINDOW = 7
CHUNKS = 64
LEAST_BLOCK = 4
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

FINGERPRINT = "doc_id long, fingerprint string"
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: ``kind`` 0: a result; 1: a partition's first text, 2: its last one, which waits for the first of the next.
STREAMED = RESULT + ", part int, kind int, text string"


def block_sizes(lengths: np.ndarray) -> np.ndarray:
    """The smallest power of two, ``LEAST_BLOCK`` at least, that is a ``CHUNKS``-th of the length or more."""
    need = np.maximum(-(-lengths // CHUNKS), LEAST_BLOCK)
    return 1 << np.ceil(np.log2(need)).astype(np.int64)


def _chunk_ends(places: list[int], least: int, most: int, start: int, end: int) -> list[int]:
    """The ends of a text's chunks, of ``least`` to ``most`` bytes, among ``places``, and the end of the text."""
    ends, last = [], start
    for place in places:
        while place - last > most:
            last += most
            ends.append(last)
        if place - last >= least:
            last = place
            ends.append(last)
    ends += range(last + most, end, most)
    if last < end:
        ends.append(end)
    return ends


def chunk_fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprints of texts that lie one behind the other in ``data``."""
    lengths = np.diff(offsets)
    blocks = block_sizes(lengths)
    hashes = SpanHash(data)
    rolled = hashes.windows(WINDOW)
    bits = np.repeat(blocks - 1, lengths).astype(np.uint64)[: len(rolled)]
    triggered = np.flatnonzero((rolled & bits) == bits)
    # Ends of windows that lie in one text.
    text = np.searchsorted(offsets, triggered, "right") - 1
    inside = triggered + WINDOW <= offsets[text + 1]
    triggered, text = triggered[inside], text[inside]
    wide = (rolled[triggered] & U64(1) * blocks[text].astype(np.uint64)) != 0
    signatures = []
    for scale, some in ((1, np.ones(len(triggered), bool)), (2, wide)):
        places = (triggered[some] + WINDOW).tolist()
        bounds = np.searchsorted(text[some], np.arange(len(lengths) + 1)).tolist()
        ends, counts = [], []
        for k, (block, start, end) in enumerate(zip((scale * blocks).tolist(), offsets[:-1].tolist(), offsets[1:].tolist())):
            found = _chunk_ends(places[bounds[k] : bounds[k + 1]], block // 4, 4 * block, start, end)
            ends += found
            counts.append(len(found))
        ends = np.array(ends, np.int64)
        # Texts leave no gaps, so a chunk begins where the one before it ends.
        values = hashes.spans(np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)], ends)
        letters = np.stack([_LETTERS[(values >> U64(6)) & U64(63)], _LETTERS[values & U64(63)]], axis=1).tobytes().decode()
        stops = (2 * np.cumsum(counts)).tolist()
        signatures.append([letters[a:b] for a, b in zip([0, *stops], stops)])
    return [f"{b}:{x}:{y}" for b, x, y in zip(blocks.tolist(), *signatures)]


def fingerprint_of(texts: list[str]) -> list[str]:
    encoded = [x.encode() for x in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in encoded])]).astype(np.int64)
    return chunk_fingerprints(np.frombuffer(b"".join(encoded), np.uint8), offsets)


def common_chunks(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by one addition of whole rows of bits for each chunk of ``b``."""
    places: dict[str, int] = {}
    for k, chunk in enumerate(a):
        places[chunk] = places.get(chunk, 0) | 1 << k
    every = (1 << len(a)) - 1
    free = every
    for chunk in b:
        hit = places.get(chunk, 0) & free
        if hit:
            free = (free + hit | free - hit) & every
    return len(a) - free.bit_count()


def _similarity(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = ([s[k : k + 2] for k in range(0, len(s), 2)] for s in (a, b))
    return 2 * common_chunks(x, y) / (len(x) + len(y))


def likeness(a: str, b: str) -> float:
    """How alike two fingerprints are, 0 to 1."""
    if a == b:
        return 1.0
    (size_a, *signs_a), (size_b, *signs_b) = a.split(":"), b.split(":")
    sizes_a, sizes_b = ({int(size) << k: s for k, s in enumerate(signs)} for size, signs in ((size_a, signs_a), (size_b, signs_b)))
    return max((_similarity(sizes_a[s], sizes_b[s]) for s in sizes_a.keys() & sizes_b.keys()), default=0.0)


def fingerprint_likeness(a: Column, b: Column) -> Column:
    """Likeness of two columns of fingerprints; null where one is null."""

    def of(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else likeness(p, q) for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(of, "double")(a, b)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch):
                yield as_arrow(FINGERPRINT, {"doc_id": batch.column("doc_id").slice(low, high - low), "fingerprint": chunk_fingerprints(data, offsets)})

    return _rows(docs).mapInArrow(run, FINGERPRINT)


def edited(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by the beginning of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list, texts: list[str], prints: list[str], following: list[str], next_prints: list[str]) -> dict:
    changed = [edited(x, y) for x, y in zip(texts, following)]
    changed_prints = fingerprint_of(changed)
    return {
        "doc_id": ids,
        "n_chars": [len(x) for x in texts],
        "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in changed],
        "fingerprint": prints,
        "edited_fingerprint": changed_prints,
        "near_edited": [likeness(x, y) for x, y in zip(prints, changed_prints)],
        "near_next": [likeness(x, y) for x, y in zip(prints, next_prints)],
    }


_NO_RESULT = dict.fromkeys(x.split()[0] for x in RESULT.split(", "))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each compared with the next; the last text of a chunk is kept until the next chunk comes."""
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), None

    def end(kind: int, row: tuple) -> pa.RecordBatch:
        one = _NO_RESULT | {"doc_id": row[0], "part": part, "kind": kind, "text": row[1]}
        return as_arrow(STREAMED, {name: [value] for name, value in one.items()})

    for batch in batches:
        for low, high, data, offsets in text_chunks(batch):
            ids = batch.column("doc_id").slice(low, high - low).to_pylist()
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
            prints = chunk_fingerprints(data, offsets)
            if held is None:
                yield end(1, (ids[0], texts[0]))
            else:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
            held = ids[-1], texts[-1], prints[-1]
            if len(ids) > 1:
                out = _compared(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
                n = len(ids) - 1
                yield as_arrow(STREAMED, out | {"part": [part] * n, "kind": [0] * n, "text": [None] * n})
    if held is not None:
        yield end(2, held)


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            doc_id, text, following = (batch.column(c)[row].as_py() for c in ("doc_id", "text", "following"))
            prints = fingerprint_of([text, following])
            yield as_arrow(RESULT, _compared([doc_id], [text], prints[:1], [following], prints[1:]))


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of the text edited with the beginning of the next document, by ascending id.

    One shuffle sorts the texts by ranges of ids.  Tasks compare neighbours as they stream by; only the first
    and the last text of each range are kept for a second, small step across its borders.
    """
    keyed = _rows(docs).withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    order = ["doc_id", "tie", "place"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(ranged.select("doc_id", "text").mapInArrow(_streamed, STREAMED), "neighbours")
    heads = found.where("kind = 1").select("part", F.col("text").alias("following"))
    # One number for each range that has rows.
    by_part = Window.orderBy("part")
    first = F.min("part").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select(F.col("part").alias("before"), F.coalesce(F.lead("part").over(by_part), first).alias("after"))
    tails = found.where("kind = 2").select("part", "doc_id", "text")
    pairs = tails.join(after, tails["part"] == after["before"]).drop("part").join(heads, F.col("after") == heads["part"])
    closed = pairs.select("doc_id", "text", "following").mapInArrow(_closed, RESULT)
    return found.where("kind = 0").select(*_NO_RESULT).unionByName(closed)


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))
