"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Each document becomes token ids and an end id; only documents longer than a sequence are cut.
Whole-sequence pieces fill a sequence each.  All others are dealt by a hash into groups of about
``GROUP_PIECES`` pieces; each group is packed on its own, longest piece first, every piece into the
gap that keeps the sum over gaps of (number of open sequences with that gap) squared smallest.

Defined results: a null or empty text is its end id alone; repeated rows are packed
once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_arrow, released, table, text_chunks, written

CAPACITY = 4096
END_ID = 1
#: Pieces packed together: bounds the memory of a task; more pieces than this per group would fill no better.
GROUP_PIECES = 50_000
#: Distinct chunks and words whose ids a worker remembers.
REMEMBERED = 1_500_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECE + ", sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkEncoder:
    """Ids of whole texts as little-endian bytes.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its chunks between
    blanks and line feeds.  Letters and a tail of punctuation never share a token either, and case is ignored;
    so each distinct word is encoded once.
    """

    #: Punctuation that no contraction and no special token ends with.
    TAIL = ",.!*%&#$?:;"
    #: Letters below U+0130 stay single letters when lowered and normalised, the same in Python and the tokenizer.
    plain_word = re.compile(f"([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+)([{re.escape(TAIL)}]*)").fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.letters: dict[str, bool] = {}
        # The same model for words already lowered, without the patterns that find them.
        self.words = Tokenizer(self.tokenizer.model)
        steps = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.words.pre_tokenizer = pre_tokenizers.Sequence(steps)
        vocabulary = self.words.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        letters = [x.lower() for x in map(chr, range(0x130)) if self.plain_word(x)]
        probe = " ".join(f"{x}a{x}" for x in letters)
        both = [t.encode(probe, add_special_tokens=False).ids for t in (self.words, self.tokenizer)]
        # A tokenizer that changes such letters in other ways gets every word through its patterns.
        self.has_words = both[0] == both[1]

    def split(self, chunk: str) -> tuple[str, str]:
        word = chunk.rstrip(self.TAIL)
        if not word.isalpha() or not self.stays_letter(word[-1]):
            return chunk, ""
        return word, chunk[len(word) :]

    def stays_letter(self, letter: str) -> bool:
        """Whether a letter, lowered and normalised, ends in one; a mark would join the punctuation behind it."""
        known = self.letters.get(letter)
        if known is None:
            known = self.letters[letter] = self.tokenizer.normalizer.normalize_str(letter)[-1:].isalpha()
        return known

    def learn_words(self, words: list[str]) -> None:
        """Lowered plain words, in one text: the last token of each tells where it ends."""
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
        if len(cuts) != len(words):
            return self.learn_others(words)
        ids, low = ids.tobytes(), 0
        for word, high in zip(words, cuts.tolist()):
            self.known[word] = ids[low:high]
            low = high

    def learn_others(self, parts: list[str]) -> None:
        """Any other parts, in one text that is cut again where its tokens begin: a call for each part costs three times as much."""
        found = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        begins = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
        lengths = np.array([len(p) + 1 for p in parts], np.int64)
        cuts = (4 * np.searchsorted(begins, np.cumsum(lengths))).tolist()
        for part, low, high in zip(parts, [0, *cuts], cuts):
            self.known[part] = ids[low:high]

    def learn(self, chunks: list[str]) -> None:
        """A part of a chunk is a chunk as well, with the same ids: one dictionary holds both."""
        known, composed = self.known, []
        words: dict[str, None] = {}
        others: dict[str, None] = {}
        for chunk in chunks:
            match = self.plain_word(chunk)
            if match:
                word, tail = match.groups()
                word = word.lower()
                if word not in known:
                    words[word] = None
            else:
                word, tail = self.split(chunk)
                if word not in known:
                    others[word] = None
            if tail and tail not in known:
                others[tail] = None
            if word != chunk:
                composed.append((chunk, word, tail))
        if words and not self.has_words:
            others |= words
        elif words:
            self.learn_words(list(words))
        if others:
            self.learn_others(list(others))
        for chunk, word, tail in composed:
            known[chunk] = known[word] + known[tail] if tail else known[word]

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; each distinct chunk is looked up once."""
        chunks = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        counts = pc.list_value_length(chunks).to_numpy()
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        missing = [chunk for chunk, ids in zip(distinct, found) if ids is None]
        if missing:
            if len(self.known) > REMEMBERED:
                self.known.clear()
                missing = distinct
            self.learn(missing)
            found = list(map(self.known.__getitem__, distinct))
        ids = map(found.__getitem__, coded.indices.to_numpy().tolist())
        for count in counts.tolist():
            yield b"".join(islice(ids, count))

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text])))


_encoders: dict[str, ChunkEncoder] = {}


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: document, number, first id, length and crc32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer not in _encoders:
            _encoders[tokenizer] = ChunkEncoder(tokenizer)
        encode_all, end, size = _encoders[tokenizer].encode_all, np.uint32(END_ID).astype("<u4").tobytes(), 4 * capacity
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").fill_null("")
            for low, high, _, _ in text_chunks(batch):
                out = []
                for doc_id, ids in zip(doc_ids[low:high], encode_all(texts[low:high])):
                    ids += end
                    for k in range(0, len(ids), size):
                        piece = ids[k : k + size]
                        out.append((doc_id, k // size, k // 4, len(piece) // 4, zlib.crc32(piece)))
                yield as_arrow(PIECE, dict(zip([x.split()[0] for x in PIECE.split(", ")], zip(*out) if out else [[]] * 5)))
        released()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECE)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) for each piece, taken longest first.

    A piece of length s put into a gap g changes the sum of squares by
    2 * (open[g - s] - open[g]) + 2; a sequence that gets full leaves the sum, a
    new one enters it with gap capacity - s.  Of equal changes the smallest gap wins.
    """
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = np.zeros(capacity + 1, np.int64)
    holders: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, far = 0, np.iinfo(np.int64).max
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        here = opened[s:capacity]
        after = opened[: capacity - s].copy()
        after[:1] = 0
        change = np.where(here > 0, 2 * (after - here) + 2, far)
        if len(change):
            change[0] -= 1
        g = int(np.argmin(change)) + s if len(change) else capacity
        # A new sequence is opened only when no open one has room.
        if g < capacity and opened[g] > 0:
            opened[g] -= 1
            k = holders[g].pop()
        else:
            g, k, used = capacity, used, used + 1
        sequence[i], offset[i] = k, capacity - g
        if g > s:
            opened[g - s] += 1
            holders[g - s].append(k)
    return sequence, offset


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    pieces = written(token_pieces(docs, tokenizer or default_tokenizer(), capacity), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    names = [x.split()[0] for x in PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # The worker may have encoded texts before; nothing is encoded from here on.
        _encoders.clear()
        released()
        first = TaskContext.get().partitionId() << 33
        held, count = [], 0

        def placed() -> Iterator[pa.RecordBatch]:
            nonlocal first
            # One order whatever order the shuffle delivered, so that a repeated task gives the same places.
            rows = pa.Table.from_batches(held).sort_by([(n, "ascending") for n in PIECE_COLUMNS])
            sequence, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
            rows = rows.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
            first += int(sequence.max()) + 1
            yield from rows.select(names).combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            # A group that repeated rows have swollen is packed in parts.
            if count >= 4 * GROUP_PIECES:
                yield from placed()
                held, count = [], 0
        if held:
            yield from placed()

    packed = rest.repartition(groups, F.xxhash64("doc_id", "piece", "ids_crc32")).mapInArrow(run, PLACED)
    # Negative numbers: no packed group uses them.
    alone = whole.select(
        *PIECE_COLUMNS,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(alone)


PIECE_COLUMNS = [x.split()[0] for x in PIECE.split(", ")]


def op6_pack(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
