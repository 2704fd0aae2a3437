"""Language identification: averaged hashed subword embeddings and a linear softmax, fitted by SGD in numpy.

A text is the average of the embeddings of its byte 2-, 3- and 4-grams (lower case, everything that is
no letter as a blank), each n-gram hashed into ``2**BITS`` places.  As average and softmax layer are both
linear, a place's embedding times the layer is one row of scores per language: this table goes
to the executors.  Part of the training rows calibrates the temperature of the softmax and the probability
below which a prediction is rejected.

Defined results: ``und`` with score 0 for a null text or one without a letter; repeated rows are scored once each; a
null id is never held out and never trained on; without training rows every result is ``und``; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, held_out, lowered, one_per_id, released, sampled, table, text_chunks

BITS = 15
SIZES = (2, 3, 4)
#: Bound on the rows that the model is fitted on.
TRAINING_ROWS = 5_000
#: Share of accepted calibration rows below which no right prediction may fall.
REJECTED_SHARE = 0.01

_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each n-gram size the place of every n-gram by its start; ``2**BITS`` where it would leave its text."""
    data = lowered(data)
    data[_NO_LETTER[data]] = 32
    wide = data.astype(np.uint32)
    for n in SIZES:
        if len(wide) < n:
            continue
        value = np.full(len(wide) - n + 1, n, np.uint32)
        for j in range(n):
            value = value * np.uint32(0x01000193) ^ wide[j : len(wide) - n + 1 + j]
        place = ((value * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32)
        leaving = (offsets[1:-1, None] - np.arange(1, n)).ravel()
        place[leaving[(leaving >= 0) & (leaving < len(place))]] = 1 << BITS
        yield place


@dataclass
class Model:
    languages: list[str]
    #: One row of scores per language and place, one more column for n-grams that do not count.
    scores: np.ndarray = field(repr=False)
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams of a text and their shares."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    parts = list(subwords(data, np.array([0, len(data)])))
    if not parts:
        return np.empty(0, np.int64), np.empty(0)
    places, counts = np.unique(np.concatenate(parts), return_counts=True)
    return places.astype(np.int32), (counts / counts.sum()).astype(np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: pa.Table, width=16, passes=6, rate=0.5) -> Model | None:
    """Stochastic gradient descent over the columns text and lang; every tenth row only calibrates."""
    languages = sorted(set(rows["lang"].to_pylist()))
    if not languages:
        return None
    number = {x: k for k, x in enumerate(languages)}
    rng = np.random.default_rng(11)
    embed = rng.normal(0, 0.1, (1 << BITS, width))
    layer, bias = np.zeros((width, len(languages))), np.zeros(len(languages))
    examples = [(*counted(text.as_py()), number[x.as_py()]) for text, x in zip(rows["text"], rows["lang"])]
    kept = examples[::10] if len(examples) >= 200 else []
    learned = [x for k, x in enumerate(examples) if k % 10 or not kept]
    for step in range(passes):
        eta = rate * (1 - step / passes)
        for k in rng.permutation(len(learned)):
            places, shares, language = learned[k]
            if not len(places):
                continue
            hidden = shares @ embed[places]
            error = softmax(hidden @ layer + bias)
            error[language] -= 1
            # An average moves each of its embeddings very little: a share's gradient is scaled up by the number of places.
            embed[places] -= eta * len(places) * 0.1 * np.outer(shares, layer @ error)
            layer -= eta * np.outer(hidden, error)
            bias -= 0.01 * eta * error
    scores = np.zeros((len(languages), (1 << BITS) + 1), np.float32)
    scores[:, :-1] = (embed @ layer).T
    model = Model(languages, scores, bias)
    if kept:
        logits = np.array([scores[:, p] @ s + bias if len(p) else bias for p, s, _ in kept])
        truth = np.array([x for _, _, x in kept])
        likelihood = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()
        model.temperature = float(min(np.geomspace(0.05, 20, 61), key=likelihood))
        best = softmax(logits / model.temperature)
        right = best.max(axis=1)[best.argmax(axis=1) == truth]
        model.least = float(np.quantile(right, REJECTED_SHARE)) if len(right) else 0.0
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred``, ``score`` and ``accepted`` (the score reaches the calibrated bound).

    Names that are taken get underscores behind them.
    """
    pred, chance, accepted = (free_name(docs.columns, c) for c in ("lang_pred", "score", "accepted"))
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumns({pred: F.lit("und"), chance: F.lit(0.0), accepted: F.lit(False)})
    schema = docs.withColumns({pred: F.lit("a"), chance: F.lit(0.0), accepted: F.lit(True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(model.languages)
        for batch in batches:
            logits = np.zeros((batch.num_rows, count))
            for low, high, data, offsets in text_chunks(batch):
                lengths, total = np.diff(offsets), np.zeros((high - low, count))
                full = np.flatnonzero(lengths)
                for place in subwords(data, offsets):
                    # A start past the last n-gram belongs to a text too short for one.
                    own = full[offsets[full] < len(place)]
                    for k in range(count):
                        total[own, k] += np.add.reduceat(model.scores[k][place], offsets[own], dtype=np.float64)
                grams = sum(np.maximum(lengths - n + 1, 0) for n in SIZES)
                logits[low:high] = total / np.maximum(grams, 1)[:, None] + model.bias
            chances = softmax(logits / model.temperature)
            best, score = chances.argmax(axis=1), chances.max(axis=1)
            names = pa.array(model.languages, pa.string()).take(pa.array(best))
            columns = [*batch.columns, names, pa.array(score), pa.array(score >= model.least)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, pred, chance, accepted])

    found = docs.mapInArrow(run, schema)
    return found.withColumns({
        pred: F.when(letters, F.col(pred)).otherwise("und"),
        chance: F.when(letters, F.col(chance)).otherwise(0.0),
        accepted: letters & F.col(accepted),
    })


def trained(docs: DataFrame) -> Model | None:
    """A model from at most ``TRAINING_ROWS`` rows with a language outside the held-out fold, by the hash of the id."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(4, 2))
    picked = sampled(usable.select("doc_id").distinct(), TRAINING_ROWS)
    rows = usable.select("doc_id", "lang", "text").join(F.broadcast(picked), "doc_id")
    rows = one_per_id(rows, ["order", "doc_id"], ["lang", "text"], TRAINING_ROWS).select("text", "lang").toArrow()
    model = fit(rows)
    released()
    return model


def op8_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = trained(docs)
    found = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "accepted")
