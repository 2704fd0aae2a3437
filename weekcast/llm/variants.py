"""Spelling variants: words one letter apart, found in a trie of letter counts.

1. Words are counted in each task, then over all.  The letters of the vocabulary are dealt into ``GROUPS`` groups by
   their frequency; a word's frequency vector holds how many of its letters are in each group.
2. Words one inserted, deleted or replaced letter apart have vectors that differ by at most one count too many and one too few.
   The vectors form a trie, one level for each group.  Its upper levels are dealt over tasks: a subtree is the words whose
   first counts are the same, and a word is looked for in all subtrees that its budget of one surplus and one deficit reaches,
   of two subtrees in the later one only: a pair found there counts for both words.
   The depth of the cut follows from the sizes of all subtrees; larger ones are searched in parts of ``TREE`` words, and
   each part by ``ASKING`` words at a time, in tasks of their own.
3. In a task a depth-first search, for many words at once, spends what is left of the budget level by level.
4. At the leaves common beginnings and endings tell whether a word is really one letter away.
5. A word's form is its most frequent near word, if that is frequent enough; forms are followed to the last by
   pointer doubling.

Defined results: null and empty texts have no words; of a null id no letter is deleted; repeated rows count once each;
of near words with equal counts the first in code-point order is the form; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_arrow, table, text_chunks, written
from .graph import joined_split

GROUPS = 12
#: Letters that are dealt by frequency; the letters of the words here are 90 at most, rarer ones go by their number.
LETTERS = 512
#: Words of a subtree that a task holds at once, words that one group looks for in them, and words looked for at once.
TREE = 16_384
ASKING = 32_768
SEARCHED = 4096
#: The trie is cut at two levels at least.
LEAST_DEPTH = 2
#: Code points up to which words are compared as rows of a matrix.
WIDTH = 32

_RUN = re.compile("[a-zÀ-ÿ]+")
COUNTS = "word string, n long"
NEAR = "word string, n_near long, best_n long, best string"
#: What a row of a subtree is: a word of its own, or one to look for from there or from another subtree.
OWN, INSIDE, OUTSIDE = 0, 1, 2


def word_counts(docs: DataFrame, least_length: int = 5, slip: int = 0) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z lowered, of ``least_length`` code points or more.

    With ``slip`` a run loses a letter, before it is measured, in each document where ``slip`` divides the crc32 of ``<doc_id>:<run>``;
    the crc32 modulo the run's length is the place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush():
            out = as_arrow(COUNTS, {"word": list(counts), "n": list(counts.values())})
            counts.clear()
            return out

        for batch in batches:
            ids = batch.column("doc_id")
            for low, high, data, offsets in text_chunks(batch):
                for k in range(high - low):
                    text = data[offsets[k] : offsets[k + 1]].tobytes().lower().decode()
                    found = Counter(x for x in _RUN.findall(text) if len(x) >= least_length)
                    doc_id = ids[low + k].as_py()
                    if slip and doc_id is not None:
                        begun = zlib.crc32(f"{doc_id}:".encode())
                        for word in [x for x in found if zlib.crc32(x.encode(), begun) % slip == 0]:
                            n, at = found.pop(word), zlib.crc32(word.encode(), begun) % len(word)
                            shorter = word[:at] + word[at + 1 :]
                            if len(shorter) >= least_length:
                                counts[shorter] += n
                    counts.update(found)
                    if len(counts) > 100_000:
                        yield flush()
        yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


class LetterGroups:
    """Frequency vectors: the letters by falling frequency go to the groups in turn, others by their number."""

    def __init__(self, letters: list[str], groups: int = GROUPS):
        ranks = {ord(c): k % groups for k, c in enumerate(letters)}
        self.groups = groups
        self.codes = np.array(sorted(ranks), np.int64)
        self.group = np.array([ranks[c] for c in self.codes.tolist()], np.int64)

    def vectors(self, words: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        group = codes % self.groups
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            group = np.where(self.codes[at] == codes, self.group[at], group)
        flat = np.bincount(owner * self.groups + group, minlength=len(words) * self.groups)
        return flat.reshape(len(words), self.groups)


def letter_groups(words: DataFrame) -> LetterGroups:
    """Of the vocabulary's letters, the ``LETTERS`` most frequent at most; every word counts once."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter != ''")
    counted = letters.groupBy("letter").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "letter").limit(LETTERS)
    return LetterGroups([r.letter for r in counted.collect()])


class Trie:
    """Words below one another by their counts; level g has a node for each beginning of g + 1 counts that occurs."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        rows = vectors[self.order]
        self.base = int(vectors.max(initial=0)) + 2
        self.keys = []
        new = np.zeros(len(rows), bool)
        new[:1] = True
        above = np.zeros(len(rows), np.int64)
        for g in range(rows.shape[1]):
            new[1:] |= rows[1:, g] != rows[:-1, g]
            self.keys.append((above * self.base + rows[:, g])[new])
            above = np.cumsum(new) - 1
        self.leaves = np.append(np.flatnonzero(new), len(rows))

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(searched row, word) for all words whose counts are at most one too many and one too few."""
        who = np.arange(len(vectors))
        node, surplus, deficit = (np.zeros(len(vectors), np.int64) for _ in range(3))
        for g, keys in enumerate(self.keys):
            found = []
            for change in (0, 1, -1):
                count = vectors[who, g] + change
                able = (count >= 0) & (count < self.base)
                if change:
                    able &= (surplus if change > 0 else deficit) == 0
                key = node[able] * self.base + count[able]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                found.append((who[able][hit], at[hit], surplus[able][hit] + (change > 0), deficit[able][hit] + (change < 0)))
            who, node, surplus, deficit = (np.concatenate(x) for x in zip(*found))
        sizes = self.leaves[node + 1] - self.leaves[node]
        step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(who, sizes), self.order[np.repeat(self.leaves[node], sizes) + step]


class Letters:
    """Words as rows of code points, from the left and from the right."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.ahead = self._rows(words)
        self.back = self._rows([w[::-1] for w in words])

    @staticmethod
    def _rows(words: list[str]) -> np.ndarray:
        return np.array(words, f"U{WIDTH}").view(np.uint32).reshape(len(words), WIDTH)


def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many places from the first on are the same in each pair of rows."""
    differ = x != y
    return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])


def one_apart(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    least, at = min(len(a), len(b)), 0
    while at < least and a[at] == b[at]:
        at += 1
    return a[at + 1 :] == b[at + 1 :] or a[at:] == b[at + 1 :] or a[at + 1 :] == b[at:]


def near(left: Letters, right: Letters, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words ``i`` of ``left`` and ``j`` of ``right`` are one apart."""
    out = np.zeros(len(i), bool)
    most = np.maximum(left.lengths[i], right.lengths[j])
    short = np.flatnonzero((most <= WIDTH) & (np.abs(left.lengths[i] - right.lengths[j]) <= 1))
    for at in range(0, len(short), 1 << 16):
        some = short[at : at + (1 << 16)]
        begin = common(left.ahead[i[some]], right.ahead[j[some]])
        end = common(left.back[i[some]], right.back[j[some]])
        out[some] = (begin < most[some]) & (begin + end >= most[some] - 1)
    for k in np.flatnonzero(most > WIDTH).tolist():
        out[k] = one_apart(left.words[i[k]], right.words[j[k]])
    return out


def _node(counts: list[int]) -> str:
    return ",".join(map(str, counts))


def reached(counts: list[int]) -> list[str]:
    """The subtrees that a search with these first counts can enter, its own first; some may not exist."""
    out = [_node(counts)]
    for g in range(len(counts)):
        for change in (1, -1):
            one = counts.copy()
            one[g] += change
            if one[g] < 0:
                continue
            out.append(_node(one))
            if change > 0:
                for other in range(len(counts)):
                    if other != g and one[other] > 0:
                        both = one.copy()
                        both[other] -= 1
                        out.append(_node(both))
    return out


def entered(counts: list[int]) -> list[str]:
    """Of the subtrees reached, the own one and those behind it in the order of their names."""
    own, *others = reached(counts)
    return [own, *(x for x in others if x > own)]


def subtree_depth(words: DataFrame, groups: LetterGroups) -> int:
    """At how many levels to cut: the fewest at which a word's subtree has at most ``TREE`` words on average."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes: Counter[tuple[int, str]] = Counter()
            for vector in groups.vectors(batch.column("word").to_pylist()).tolist():
                sizes.update((d, _node(vector[:d])) for d in range(LEAST_DEPTH, groups.groups + 1))
            yield as_arrow("depth long, node string, n long", {"depth": [d for d, _ in sizes], "node": [x for _, x in sizes], "n": list(sizes.values())})

    sizes = words.select("word").mapInArrow(run, "depth long, node string, n long").groupBy("depth", "node").agg(F.sum("n").alias("n"))
    # One row for each of the levels.
    rows = sizes.groupBy("depth").agg((F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n")).alias("mean")).collect()
    return min((r.depth for r in rows if r.mean <= TREE), default=groups.groups)


def placed(words: DataFrame, groups: LetterGroups, depth: int, kinds: tuple[int, ...]) -> DataFrame:
    """(node, kind, word, n): each word in its own subtree, and as one to look for in all that it enters."""
    schema = "node string, kind int, word string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            out = []
            for word, n, vector in zip(names, counts, groups.vectors(names)[:, :depth].tolist()):
                if OWN in kinds:
                    out.append((_node(vector), OWN, word, n))
                if INSIDE in kinds:
                    out += [(node, OUTSIDE if k else INSIDE, word, n) for k, node in enumerate(entered(vector))]
            yield as_arrow(schema, dict(zip(("node", "kind", "word", "n"), zip(*out) if out else [[]] * 4)))

    return words.select("word", "n").mapInArrow(run, schema)


def shares(own: DataFrame) -> DataFrame:
    """(node, parts, slices): into how many parts the words of a subtree are dealt, and those that look for near ones there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(x, n) for node, n in zip(batch.column("node").to_pylist(), batch.column("n").to_pylist()) for x in entered(list(map(int, node.split(","))))]
            yield as_arrow("node string, asking long", dict(zip(("node", "asking"), zip(*out) if out else [[]] * 2)))

    sizes = written(own.groupBy("node").agg(F.count("*").alias("n")), "sizes")
    asking = sizes.mapInArrow(run, "node string, asking long").groupBy("node").agg(F.sum("asking").alias("asking"))
    parts, slices = (F.ceil(F.col(c) / most).cast("int").alias(x) for c, most, x in (("n", TREE, "parts"), ("asking", ASKING, "slices")))
    return joined_split(sizes, asking, "node").select("node", parts, slices)


class Subtree:
    """The words of one subtree, or of one part of it, and the search in them."""

    def __init__(self, words: list[str], counts: list[int], groups: LetterGroups):
        self.letters, self.counts = _in_order(words, counts)
        self.groups = groups
        self.trie = Trie(groups.vectors(self.letters.words))

    def search(self, words: list[str], counts: list[int], outside: bool) -> Iterator[dict]:
        """The number of near words and the best of each word that has any; with ``outside`` for the subtree's words as well."""
        asked, asked_counts = _in_order(words, counts)
        who, found = self.trie.search(self.groups.vectors(asked.words))
        real = near(asked, self.letters, who, found)
        who, found = who[real], found[real]
        yield _best(asked, who, self.letters, self.counts, found)
        if outside:
            yield _best(self.letters, found, asked, asked_counts, who)


def _in_order(words: list[str], counts: list[int]) -> tuple[Letters, np.ndarray]:
    """Words in code-point order, so that the first of several is the smallest, and their counts."""
    order = sorted(range(len(words)), key=words.__getitem__)
    return Letters([words[k] for k in order]), np.array([counts[k] for k in order], np.int64)


def _best(words: Letters, who: np.ndarray, others: Letters, counts: np.ndarray, found: np.ndarray) -> dict:
    order = np.lexsort((found, -counts[found], who))
    who, found = who[order], found[order]
    some, first, n = np.unique(who, return_index=True, return_counts=True)
    best = found[first]
    return {
        "word": [words.words[k] for k in some.tolist()], "n_near": n, "best_n": counts[best],
        "best": [others.words[k] for k in best.tolist()],
    }


def searched(rows: DataFrame, groups: LetterGroups) -> DataFrame:
    """Searches in each subtree; rows of one ``place`` follow one another by ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, kind, tree, own, asked = None, None, None, [], []

        def answers():
            nonlocal tree
            if own and asked:
                tree = tree or Subtree(*map(list, zip(*own)), groups)
                for found in tree.search(*map(list, zip(*asked)), kind == OUTSIDE):
                    yield as_arrow(NEAR, found)
            asked.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("node", "part", "slice", "kind", "word", "n")]
            for *at, what, word, n in zip(*columns):
                if at != place or what != kind:
                    yield from answers()
                    if at != place:
                        place, tree, own = at, None, []
                    kind = what
                if kind == OWN:
                    own.append((word, n))
                else:
                    asked.append((word, n))
                    if len(asked) >= SEARCHED:
                        yield from answers()
        yield from answers()

    return rows.mapInArrow(run, NEAR)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word that has near words; ``words`` are distinct (word, n)."""
    groups = letter_groups(words)
    depth = subtree_depth(words, groups)
    own = written(placed(words, groups, depth, (OWN,)), "subtrees")
    into = written(shares(own), "shares")

    def dealt(column: str, by: str):
        return F.pmod(F.xxhash64("word", F.lit(by)), column).cast("int")

    def every(column: str):
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    held = joined_split(own, into, "node").select("node", dealt("parts", "part").alias("part"), every("slices").alias("slice"), "kind", "word", "n")
    asking = joined_split(placed(words, groups, depth, (INSIDE, OUTSIDE)), into, "node")
    asking = asking.select("node", every("parts").alias("part"), dealt("slices", "slice").alias("slice"), "kind", "word", "n")
    place = ["node", "part", "slice"]
    rows = held.unionByName(asking).repartition(*place).sortWithinPartitions(*place, "kind")
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best").alias("best")))
    found = searched(rows, groups).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.rank")).alias("best_n"), "best.best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): every word's last form.  Each round doubles the steps taken; forms grow in frequency, so none comes back."""
    now = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        new = written(joined_split(now, ahead, "root", "left"), "forms")
        if new.where("beyond IS NOT NULL").isEmpty():
            return now
        now = new.select("word", F.coalesce("beyond", "root").alias("root"))


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct (word, n).

    ``form``: the most frequent near word, if it comes ``ratio`` times as often; ``root``: where the forms lead.
    """
    found = joined_split(words.select("word", "n"), near_words(words), "word", "left")
    formed = F.col("best_n") >= ratio * F.col("n")
    found = written(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")),
        "near",
    )
    last = roots(found.where("form IS NOT NULL"))
    return joined_split(found, last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_variants(spark, sf_dir: str) -> DataFrame:
    words = word_counts(table(spark, sf_dir, "documents"), slip=97)
    return group_variants(written(words.where("n >= 3"), "words"))
