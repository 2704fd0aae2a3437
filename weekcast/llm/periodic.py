"""Periodic runs of words, found on a run-length grammar made by recompression.

A run is a maximal stretch of words that repeats itself with some period at least twice.

1. The words of a chunk of texts are numbered; one string holds them all, with a border before, between and after the texts.
2. Recompression: maximal blocks of one symbol become a symbol each, then pairs of a symbol of the left and one of the
   right half of the alphabet do, in turns, until each text is one symbol.  A level keeps for each symbol its place on
   the next one and back: the run-length grammar, laid out by levels.
3. Two equal stretches are cut alike except at their ends, so the common extension of two places climbs the levels as
   long as the symbols are equal, one step aside at most on each, and comes down the same way where they differ.
   Extensions to the left climb the mirrored grammar.
4. A run with period p and two repeats covers two neighbours of the grid 0, p, 2p, ...  For each p the grid gives
   candidates, n / 1 + n / 2 + ... in all; two extensions settle each exactly.  Nothing is compared by a hash.

Each text is worked on whole, in the task that reads it: no shuffle.  Memory follows ``CHUNK_BYTES`` or the longest
text of a chunk, candidates are made ``BLOCK`` at a time.

Defined results: a null or empty text has no words, no runs and an empty ``collapsed``; repeated rows and rows with a null
id are worked on once each; of one stretch with several periods only the smallest is a run; runs come by
start, then period; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, table, text_chunks

MIN_LENGTH = 12
#: Grid candidates made at a time.
BLOCK = 1 << 20

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass
class Level:
    """One string of the grammar and how it is cut into the symbols of the next.

    ``parent``: the place on the next level that covers a place; ``first``: the first place that one on the next level
    covers, and the string's length at its end; ``left``: whether a symbol can only begin a pair (None: cut into blocks).
    """

    symbols: np.ndarray
    parent: np.ndarray | None = None
    first: np.ndarray | None = None
    left: np.ndarray | None = None

    def mirrored(self) -> Level:
        if self.first is None:
            return Level(self.symbols[::-1])
        parent = (len(self.first) - 2 - self.parent)[::-1]
        first = len(self.symbols) - self.first[::-1]
        return Level(self.symbols[::-1], parent, first, None if self.left is None else ~self.left[::-1])


def _next(level: Level, heads: np.ndarray, keys: np.ndarray) -> Level:
    """The level above, its symbols beginning at the places ``heads``; equal keys get equal numbers, borders stay 0."""
    level.first = np.append(heads, len(level.symbols)).astype(np.int32)
    level.parent = np.repeat(np.arange(len(heads), dtype=np.int32), np.diff(level.first))
    names = pd.factorize(keys)[0] + 1
    names[level.symbols[heads] == 0] = 0
    return Level(names)


def _blocks(level: Level) -> Level | None:
    """Maximal blocks of one symbol, one symbol for each length; None where nothing repeats."""
    s = level.symbols
    again = (s[1:] == s[:-1]) & (s[1:] != 0)
    if not again.any():
        return None
    heads = np.flatnonzero(np.concatenate([[True], ~again]))
    lengths = np.diff(np.append(heads, len(s)))
    return _next(level, heads, s[heads] * (int(lengths.max()) + 1) + lengths)


def _pairs(level: Level, owner: np.ndarray, number: int) -> Level | None:
    """Pairs of a left and a right symbol; which half is left is chosen in each text by where more pairs are."""
    s = level.symbols
    bit = (mix(s.astype(np.uint64) + U64(number << 40)) & U64(1)).astype(bool)
    inside = (s[1:] != 0) & (s[:-1] != 0)
    n = int(owner[-1]) + 1
    up = np.bincount(owner[:-1][inside & ~bit[:-1] & bit[1:]], minlength=n)
    down = np.bincount(owner[:-1][inside & bit[:-1] & ~bit[1:]], minlength=n)
    left = bit == (down > up)[owner]
    paired = inside & left[:-1] & ~left[1:]
    if not paired.any():
        return None
    level.left = left
    heads = np.flatnonzero(np.concatenate([[True], ~paired]))
    mate = np.append(np.where(paired, s[1:] + 1, 0), 0)[heads]
    return _next(level, heads, s[heads] * (int(s.max()) + 2) + mate)


def grammar(symbols: np.ndarray, owner: np.ndarray) -> list[Level]:
    """All levels of a string whose borders are 0; ``owner`` numbers the text of each place in ascending order."""
    levels, number = [Level(symbols)], 0
    while True:
        above = _blocks(levels[-1])
        if above is not None:
            owner = owner[levels[-1].first[:-1]]
            levels.append(above)
        s = levels[-1].symbols
        if not ((s[1:] != 0) & (s[:-1] != 0)).any():
            return levels
        above = None
        while above is None:
            number += 1
            above = _pairs(levels[-1], owner, number)
        owner = owner[levels[-1].first[:-1]]
        levels.append(above)


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For how many places the strings from ``i`` and from ``j``, places of one text, are the same."""
    a, b, who = i.astype(np.int64), j.astype(np.int64), np.arange(len(i))
    stopped = []
    for level in levels:
        same = level.symbols[a] == level.symbols[b]
        if level.first is None:
            stopped.append((a, b, who))
            break
        differ = ~same
        halts = [(a[differ], b[differ], who[differ])]
        a, b, who = a[same], b[same], who[same]
        over_a, over_b = level.parent[a], level.parent[b]
        begun = (level.first[over_a] == a) & (level.first[over_b] == b)
        if level.left is not None:
            # A symbol of the left half begins a pair or stands alone: both places begin a symbol of the next level.
            step = np.where(begun | level.left[a], 0, 1)
        else:
            rest_a, rest_b = level.first[over_a + 1] - a, level.first[over_b + 1] - b
            step = np.where(begun & (rest_a == rest_b), 0, np.minimum(rest_a, rest_b))
            differ = rest_a != rest_b
            halts.append(((a + step)[differ], (b + step)[differ], who[differ]))
            a, b, who, step = a[~differ], b[~differ], who[~differ], step[~differ]
        stopped.append(tuple(np.concatenate(x) for x in zip(*halts)))
        a, b = level.parent[a + step].astype(np.int64), level.parent[b + step].astype(np.int64)
    a, b, who = stopped.pop()
    for level, halted in zip(levels[len(stopped) - 1 :: -1] if stopped else [], reversed(stopped)):
        over_a, over_b = a, b
        a, b = level.first[over_a].astype(np.int64), level.first[over_b].astype(np.int64)
        step = (level.symbols[a] == level.symbols[b]).astype(np.int64)
        if level.left is None:
            step *= np.minimum(level.first[over_a + 1] - a, level.first[over_b + 1] - b)
        a, b, who = (np.concatenate(x) for x in zip((a + step, b + step, who), halted))
    out = np.empty(len(i), np.int64)
    out[who] = a
    return out - i


def grid(begins: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) for each text, period and place of its grid that has another one grid step on."""
    most = lengths // 2
    text = np.repeat(np.arange(len(lengths)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    counts = (lengths[text] - 1) // period
    ends = np.cumsum(counts)
    low = 0
    while low < len(text):
        done = int(ends[low - 1]) if low else 0
        high = max(int(np.searchsorted(ends, done + BLOCK, "right")), low + 1)
        some = counts[low:high]
        p = np.repeat(period[low:high], some)
        step = np.arange(len(p)) - np.repeat(np.cumsum(some) - some, some)
        yield np.repeat(begins[text[low:high]], some) + step * p, p
        low = high


def _smallest(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One period, the smallest, for each stretch; by start, then period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    order = np.flatnonzero(new)
    order = order[np.lexsort((period[order], start[order]))]
    return start[order], end[order], period[order]


def find_runs(numbers: np.ndarray, lengths: np.ndarray, least: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in texts of ``lengths`` words, whose numbers, from 0, follow one another.

    Places count over all texts; by start, then period.
    """
    texts = len(lengths)
    before = np.cumsum(lengths) - lengths
    # A border before each text and after the last: place k of text t is k + t + 1 in the string.
    symbols = np.zeros(len(numbers) + texts + 1, np.int64)
    owner = np.append(np.repeat(np.arange(texts), lengths + 1), max(texts - 1, 0))
    symbols[np.arange(len(numbers)) + np.repeat(np.arange(texts), lengths) + 1] = numbers + 1
    levels = grammar(symbols, owner)
    mirror = [x.mirrored() for x in levels]
    found = [(np.empty(0, np.int64),) * 3]
    for i, p in grid(before + np.arange(texts) + 1, lengths):
        alike = symbols[i] == symbols[i + p]
        i, p = i[alike], p[alike]
        right = extensions(levels, i, i + p)
        last = len(symbols) - 1
        # To the left of i + p and i, in the mirror; it has the later place first.
        left = extensions(mirror, last - (i + p - 1), last - (i - 1))
        long = (left + right >= p) & (left + right + p >= least)
        i, p, left, right = i[long], p[long], left[long], right[long]
        found.append(_smallest(i - left, i + p + right, p))
    start, end, period = _smallest(*(np.concatenate(x) for x in zip(*found)))
    shift = owner[start] + 1
    return start - shift, end - shift, period


def _collapsed(words: list[bytes], kept: np.ndarray) -> bytes:
    return b" ".join(words if kept.all() else [words[k] for k in np.flatnonzero(kept)])


def word_runs(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``.

    ``runs`` are (start, length, period) in words, by start, then period, of ``least`` words and two periods or more;
    ``collapsed`` are the words, joined by blanks, without those that a run holds after its first period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch):
                texts = [data[a:b].tobytes().split() for a, b in zip(offsets, offsets[1:])]
                lengths = np.array([len(x) for x in texts], np.int64)
                words = pa.array([w for x in texts for w in x], pa.binary())
                numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
                del words
                start, end, period = find_runs(numbers, lengths, least)
                begins = np.cumsum(lengths) - lengths
                change = np.zeros(len(numbers) + 1, np.int32)
                np.add.at(change, start + period, 1)
                np.add.at(change, end, -1)
                kept = np.cumsum(change)[:-1] == 0
                collapsed = [_collapsed(x, kept[a : a + len(x)]) for x, a in zip(texts, begins)]
                bounds = np.searchsorted(start, np.append(begins, len(numbers)))
                text = np.repeat(np.arange(len(texts)), np.diff(bounds))
                structs = pa.StructArray.from_arrays([pa.array(x) for x in (start - begins[text], end - start, period)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, RUNS)


def echoed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the words of every tenth document, by the crc32 of its id, repeated from some word on.

    Where that hash leaves 0, its tenth g gives the first repeated word g % n and the period; other texts stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))

    def repeated(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(words, lambda w, i: F.get(words, place(i.cast("long")).cast("int"))), " ")

    # An array of one, so that the words are found once and not once per word.
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.transform(F.array(words), lambda x: F.when(F.size(x) > 0, repeated(x)))[0]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text")
    )


def digests(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one and digests of the runs and the collapsed words."""
    best = F.element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("rank"), r["start"].alias("start"), r["period"].alias("period")))), 1
    )
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        (-F.col("best.rank")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-F.col("best.rank") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_runs(spark, sf_dir: str) -> DataFrame:
    return digests(word_runs(echoed(table(spark, sf_dir, "documents"))))
