"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower case, and single characters of scripts that set no blanks.  Every n-gram of a test item is a seed, however many documents
hold it.  A document with a seed is aligned locally with the item around the seed, so that changed, added and dropped
words cost little; the score is the share of the item's best possible score.  A window that holds too few of the
item's words to reach the threshold is not aligned.

Items come in blocks of about ``BLOCK_BYTES`` of text, one pass over the corpus each: what goes to the executors is bounded
however large the benchmark.

Defined results: null and empty texts match nothing; items of fewer than ``MIN_WORDS`` words match word for word only,
those of fewer than ``SEED_WORDS`` are too common to tell a leak and match nothing; repeated rows match once each; rows with a null id keep it; equal items match alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, as_arrow, lowered, mix, runs, table, text_chunks, written

SEED_WORDS = 3
MIN_WORDS = 8
#: Share of an item's best possible score from which a document counts as contaminated.
THRESHOLD = 0.4
MATCH, OTHER, GAP = 2, -1, -1
BLOCK_BYTES = 2 << 20
#: Cells of one batch of alignments.
CELLS = 1 << 21
#: Places of seeds that are looked at together.
PLACES = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

#: Ranges of the first three UTF-8 bytes of letters of scripts without blanks.
_BLANKLESS = (
    (0xE0B880, 0xE0BFBF),  # Thai, Lao, Tibetan
    (0xE18080, 0xE1829F),  # Burmese
    (0xE19E80, 0xE19FBF),  # Khmer
    (0xE38180, 0xE383BF),  # Hiragana, Katakana
    (0xE387B0, 0xE387BF),
    (0xE39080, 0xE4B6BF),  # Han
    (0xE4B880, 0xE9BFBF),
    (0xEFA480, 0xEFABBF),
    (0xEFBDA6, 0xEFBE9D),  # half-width Katakana
    (0xF0A080, 0xF0BFBF),  # Han beyond 16 bits
)
_HEAD = np.zeros(256, bool)
_HEAD[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True

HITS = "doc_id long, item_id long, score double, start long, stop long"


def blankless(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every character of a script without blanks."""
    at = np.flatnonzero(_HEAD[data[:-2]])
    code = data[at].astype(np.int64) << 16 | data[at + 1].astype(np.int64) << 8 | data[at + 2]
    at = at[np.any([(code >= low) & (code <= high) for low, high in _BLANKLESS], axis=0)]
    return at, at + np.where(data[at] == 0xF0, 4, 3)


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(first byte, end, text number, hash) of every word."""
    starts, ends = runs(_WORD[data], np.concatenate([offsets, *blankless(data)]))
    owner = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, owner, SpanHash(lowered(data)).spans(starts, ends)


def grams(owner: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, hash) of every run of ``SEED_WORDS`` words in one text."""
    n = max(0, len(word) - SEED_WORDS + 1)
    total = np.zeros(n, np.uint64)
    for j in range(SEED_WORDS):
        total = total * U64(0xD6E8FEB86659FD93) + word[j : j + n]
    inside = np.flatnonzero(owner[:n] == owner[SEED_WORDS - 1 :]) if n else np.empty(0, np.int64)
    return inside, mix(total[inside])


class Lookup:
    """Exact membership in a sorted array of hashes, most others ruled out by one bit."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(values & U64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``hashes``, number in the values) of all that are there."""
        near = np.flatnonzero(self.bits[(hashes & U64((1 << 20) - 1)).astype(np.int64)])
        if not len(near) or not len(self.values):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.values, hashes[near]), len(self.values) - 1)
        same = self.values[at] == hashes[near]
        return near[same], at[same]


@dataclass
class Items:
    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray  # distinct, sorted
    first: np.ndarray  # where each seed's places begin
    item: np.ndarray  # places: item number
    at: np.ndarray  # places: word number in it

    @staticmethod
    def of(rows: list[tuple[int, str]]) -> Items:
        ids, words, seeds, item, at = [], [], [], [], []
        for item_id, text in rows:
            data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
            _, _, owner, word = word_hashes(data, np.array([0, len(data)]))
            if len(word) < SEED_WORDS:
                continue
            place, found = grams(owner, word)
            if len(word) < MIN_WORDS:
                # Only the whole sequence counts, and that has its first seed.
                place, found = place[:1], found[:1]
            seeds.append(found)
            item.append(np.full(len(found), len(ids)))
            at.append(place)
            ids.append(item_id)
            words.append(word)
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        return Items(ids, words, *Items.index(cat(seeds, np.uint64), cat(item, np.int64), cat(at, np.int64)))

    @staticmethod
    def index(seed, item, at):
        order = np.lexsort((at, item, seed))
        seed, item, at = seed[order], item[order], at[order]
        seeds, first = np.unique(seed, return_index=True)
        return seeds, np.append(first, len(seed)), item, at


def align(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of ``item`` in each row of ``windows`` and the column after its end; 0 in a window fits no word."""
    count, width = windows.shape
    ramp = np.arange(width, dtype=np.int32) * -GAP
    last = np.zeros((count, width + 1), np.int32)
    best, stop = np.zeros(count, np.int32), np.zeros(count, np.int64)
    for word in item:
        here = np.maximum(last[:, :-1] + np.where(windows == word, MATCH, OTHER).astype(np.int32), last[:, 1:] + GAP)
        here = np.maximum(here, 0)
        # A gap in the item costs the same for each word, so the best one behind is a running maximum.
        here = np.maximum.accumulate(here + ramp, axis=1) - ramp
        last[:, 1:] = here
        top = here.argmax(axis=1)
        score = here[np.arange(count), top]
        better = score > best
        best[better], stop[better] = score[better], top[better] + 1
    return best, stop


def can_reach(item: np.ndarray, windows: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a row of ``windows`` holds words of ``item`` enough for a score of ``threshold``: each match takes one."""
    known = np.unique(item)
    held = known[np.minimum(np.searchsorted(known, windows), len(known) - 1)] == windows
    return held.sum(axis=1) / len(item) >= threshold


def candidate_windows(owner, place, items: Items, at) -> Iterator[np.ndarray]:
    """Distinct (text number, item, first word, end) around seeds, seeds on near diagonals together.

    They come in parts of whole texts with about ``PLACES`` places; a text with more is cut into ranges of items.
    """
    counts = items.first[at + 1] - items.first[at]
    text = owner[place]
    begins = np.flatnonzero(np.diff(text, prepend=-1))
    ends, sums = np.append(begins[1:], len(at)), np.append(0, np.cumsum(counts))
    k = 0
    while k < len(begins):
        low = begins[k]
        last = max(k, int(np.searchsorted(sums[ends], sums[low] + PLACES, "right")) - 1)
        high, k = ends[last], last + 1
        pieces = min(len(items.ids), int(-(-(sums[high] - sums[low]) // PLACES)))
        bounds = np.linspace(0, len(items.ids), pieces + 1).astype(np.int64)
        for first, stop in zip(bounds[:-1], bounds[1:]):
            yield windows_of_items(owner, place[low:high], items, at[low:high], first, stop)


def windows_of_items(owner, place, items: Items, at, first: int, stop: int) -> np.ndarray:
    """``candidate_windows`` with the items from ``first`` to before ``stop``."""
    begins, ends = items.first[at], items.first[at + 1]
    if stop - first < len(items.ids):
        # The places of a seed are in the order of the items.
        seed = np.repeat(np.arange(len(items.seeds)), np.diff(items.first))
        keys = seed * len(items.ids) + items.item
        begins, ends = (np.searchsorted(keys, at * len(items.ids) + x) for x in (first, stop))
    counts = ends - begins
    total = int(counts.sum())
    if not total:
        return np.empty((0, 4), np.int64)
    which = np.repeat(np.arange(len(at)), counts)
    entry = np.repeat(begins, counts) + np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    item, text = items.item[entry], owner[place[which]]
    diagonal = place[which] - items.at[entry]
    order = np.lexsort((diagonal, item, text))
    item, text, diagonal = item[order], text[order], diagonal[order]
    lengths = np.array([len(w) for w in items.words])
    new = np.ones(total, bool)
    new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (np.diff(diagonal) > lengths[item[1:]] // 2)
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], total) - 1
    slack = lengths[item[begins]] // 2
    return np.stack([text[begins], item[begins], diagonal[begins] - slack, diagonal[ends] + lengths[item[begins]] + slack], axis=1)


def search(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    """The best alignment of every contaminated document with each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(items.seeds)
        for batch in batches:
            ids, out = batch.column("doc_id").to_pylist(), []
            for low, high, data, offsets in text_chunks(batch):
                starts, ends, owner, word = word_hashes(data, offsets)
                place, found = grams(owner, word)
                hit, at = lookup.find(found)
                bounds = np.searchsorted(owner, np.arange(high - low + 1))
                best: dict[tuple[int, int], tuple[float, int, int]] = {}
                for windows in candidate_windows(owner, place[hit], items, at):
                    windows = windows[np.lexsort((windows[:, 3] - windows[:, 2], windows[:, 1]))]
                    k = 0
                    while k < len(windows):
                        number = windows[k, 1]
                        width, n = 0, 0
                        while k + n < len(windows) and windows[k + n, 1] == number:
                            wider = max(width, int(windows[k + n, 3] - windows[k + n, 2]))
                            if n and wider * (n + 1) > CELLS:
                                break
                            width, n = wider, n + 1
                        part = windows[k : k + n]
                        k += n
                        first = np.maximum(part[:, 2], bounds[part[:, 0]])
                        last = np.minimum(part[:, 3], bounds[part[:, 0] + 1])
                        width = int((last - first).max())
                        columns = first[:, None] + np.arange(width)
                        matrix = np.where(columns < last[:, None], word[np.minimum(columns, len(word) - 1)], U64(0))
                        target = items.words[number]
                        least = threshold if len(target) >= MIN_WORDS else 1.0
                        near = can_reach(target, matrix, least)
                        part, first, matrix = part[near], first[near], matrix[near]
                        score, stop = align(target, matrix)
                        share = score / (MATCH * len(target))
                        for i in np.flatnonzero(share >= least).tolist():
                            key = (int(part[i, 0]), int(number))
                            if key not in best or share[i] > best[key][0]:
                                end = int(first[i] + stop[i])
                                begin = int(first[i])
                                # Aligned backwards from the end, the best score ends where the match starts.
                                begin = end - int(align(target[::-1], word[begin:end][::-1][None, :])[1][0])
                                best[key] = (float(share[i]), begin, end)
                for (text, number), (share, begin, end) in best.items():
                    base, body = int(offsets[text]), data[offsets[text] : offsets[text + 1]].tobytes()
                    left, right = int(starts[begin]) - base, int(ends[end - 1]) - base
                    start = len(body[:left].decode())
                    out.append((ids[low + text], items.ids[number], share, start, start + len(body[left:right].decode())))
            yield as_arrow(HITS, dict(zip([x.split()[0] for x in HITS.split(", ")], zip(*out) if out else [[]] * 5)))

    return docs.mapInArrow(run, HITS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id, score, start, stop`` (code points of the match)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = []
    for k in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow().to_pylist()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        items = Items.of([(r["item_id"], r["text"]) for r in rows])
        found.append(search(docs, items, threshold))
        if blocks > 1:
            found[-1] = written(found[-1], "leaks")
    return reduce(DataFrame.unionByName, found)


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
