"""Toxicity: logistic regression over hashed word n-grams and skip-grams, fitted by FTRL-proximal.

Features of a text are its distinct words, word pairs and pairs with one word between, hashed
into ``2**BITS`` places.  FTRL-proximal gives each coordinate a rate of its own and, by its L1
term, leaves most at exactly zero; only the others go to the executors.

Defined results: a null or empty text has no feature and gets the score of the intercept;
repeated rows are scored once each; a null id is never held out and never trained on; without
training rows every score is 0; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, free_name, held_out, lowered, released, runs, table, text_chunks, training_rows

BITS = 20
#: Bound on the labelled rows that the model is fitted on.
TRAINING_ROWS = 8_000
THRESHOLD = 0.5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place) of every word, word pair and skip pair."""
    starts, ends = runs(_LETTER[data], offsets)
    owner = np.searchsorted(offsets, starts, "right") - 1
    word = SpanHash(lowered(data)).spans(starts, ends)
    owners, places = [owner], [word]
    for gap, salt in ((1, 0xA0761D6478BD642F), (2, 0xE7037ED1A0B428DB)):
        same = owner[:-gap] == owner[gap:]
        owners.append(owner[:-gap][same])
        places.append(((word[:-gap] * U64(salt)) + word[gap:])[same] * U64(0x9E3779B97F4A7C15))
    return np.concatenate(owners), (np.concatenate(places) >> U64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    places: np.ndarray
    weights: np.ndarray
    intercept: float


def fit(rows: Iterable[tuple[str, int]], alpha=3.0, beta=1.0, l1=6.0, l2=0.1, passes=8, least=4) -> Model:
    """FTRL-proximal over (text, label) rows.

    Features of fewer than ``least`` of the texts are left out: they would take up the
    gradient of their one text and teach nothing about others.
    """
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(7)

    def places(text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        return np.unique(features(data, np.array([0, len(data)]))[1])

    # Two passes over the texts: only what counts is kept of them.
    seen = np.zeros(size, np.int32)
    for text, _ in rows:
        seen[places(text)] += 1
    often = seen >= least
    examples = [(np.append(at[often[at]], size).astype(np.int32), label) for at, label in ((places(text), label) for text, label in rows)]
    if not examples:
        return Model(np.empty(0, np.int64), np.empty(0), -math.inf)

    def weights(at):
        zs = z[at]
        bound = np.where(at == size, 0.0, l1)
        return np.where(np.abs(zs) <= bound, 0.0, -(zs - np.sign(zs) * bound) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(passes):
        for k in rng.permutation(len(examples)):
            at, label = examples[k]
            w = weights(at)
            gradient = 1 / (1 + math.exp(-max(-35.0, min(35.0, w.sum())))) - label
            square = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + square) - np.sqrt(n[at])) / alpha * w
            n[at] += square
    w = weights(np.arange(size + 1))
    kept = np.flatnonzero(w[:size])
    return Model(kept, w[kept], float(w[size]))


def score_texts(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and a double ``column`` between 0 and 1, whose name gets underscores behind it where it is taken."""
    column = free_name(docs.columns, column)
    schema = docs.withColumn(column, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS, np.float32)
        dense[model.places] = model.weights
        for batch in batches:
            total = np.full(batch.num_rows, model.intercept)
            for low, high, data, offsets in text_chunks(batch):
                owner, place = features(data, offsets)
                hit = np.flatnonzero(dense[place])
                if len(hit):
                    pairs = np.unique(owner[hit].astype(np.int64) << BITS | place[hit])
                    total[low:high] += np.bincount(pairs >> BITS, dense[pairs & ((1 << BITS) - 1)], high - low)
            scores = 1 / (1 + np.exp(-np.clip(total, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, column])
        released()

    return docs.mapInArrow(run, schema)


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from at most ``TRAINING_ROWS`` labelled rows outside the held-out fold."""
    model = fit(training_rows(docs, labels, "toxic", TRAINING_ROWS))
    released()
    return model


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = trained(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, model, "score").select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
