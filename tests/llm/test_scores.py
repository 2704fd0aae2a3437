"""Quality, toxicity and language: held-out accuracy, and the models against plain versions of themselves."""

import functools
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weekcast.llm import common, language, quality, secrets, toxicity
from weekcast.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def truth(spark, column):
    rows = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", column).collect()
    return {r[0]: r[1] for r in rows if not zlib.crc32(str(r[0]).encode()) % 5}


def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op1_quality"](spark, SF).collect()}
    held = truth(spark, "quality")
    assert all(got[i].held_out for i in held) and len(got) == 1000
    assert np.mean([got[i].predicted == y for i, y in held.items()]) > 0.97


def test_quality_reads_the_jvm_only(spark):
    plan = QUERIES["op1_quality"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rule_columns_equal_the_rules(spark, odd):
    rng = np.random.default_rng(0)
    names = ["words", "upper", "distinct_words"]
    values = {n: rng.random(400) * 4 for n in names}
    labels = ((values["words"] > 2) & (values["upper"] < 1)).astype(float)
    model = quality.fit(values, labels, trees=10)
    assert model.rules and sum(labels) > 20
    frame = spark.createDataFrame(list(map(list, zip(*[values[n].tolist() for n in names]))), names)
    got = [r[0] for r in frame.select(model.column()).collect()]
    total = model.intercept + sum(w * r.holds(values) for r, w in model.rules)
    assert np.allclose(got, 1 / (1 + np.exp(-total)))
    assert np.mean((np.array(got) > 0.5) == labels) > 0.95
    assert quality.score_quality(odd, quality.fit({n: np.empty(0) for n in names}, np.empty(0))).count() == odd.count()


def test_statistics_are_finite(spark, odd):
    for row in quality.with_statistics(odd).collect():
        assert all(math.isfinite(v) for k, v in row.asDict().items() if k != "doc_id")


def test_toxicity_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, SF).collect()}
    held = truth(spark, "toxic")
    clean = [got[i].predicted for i, y in held.items() if y == 0]
    assert np.mean([got[i].predicted == y for i, y in held.items()]) > 0.88 and np.mean(clean) < 0.05


def test_ftrl_learns_words_and_stays_sparse(spark):
    rng = np.random.default_rng(1)
    common = [f"w{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(10)]
    rows = []
    for k in range(600):
        words = list(rng.choice(common, 60))
        if k % 4 == 0:
            words[int(rng.integers(60))] = "BADWORD,"
        rows.append((" ".join(words), int(k % 4 == 0)))
    model = toxicity.fit(rows)
    assert 0 < len(model.places) < 500
    docs = spark.createDataFrame([(1, "wab wcd badword wef"), (2, "wab wcd wef"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.toxicity for r in toxicity.score_texts(docs, model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4] == pytest.approx(1 / (1 + math.exp(-model.intercept)))
    assert toxicity.fit([]).intercept == -math.inf


LOWER = {c: c + 32 for c in [*range(0x41, 0x5B), *range(0xC0, 0xDF)] if c != 0xD7}


@functools.cache
def place_of(words):
    """Where a feature is hashed to, from a text that holds nothing else; ``None`` stands for the word between."""
    data = " ".join(w or "x" for w in words).encode()
    return int(toxicity.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[1][-1])


def word_features(text):
    """Places of distinct words, pairs of neighbours and pairs with one word between."""
    words = re.findall("[A-Za-z\\u0080-\U0010ffff]+", text.translate(LOWER))
    found = {(w,) for w in words} | set(zip(words, words[1:])) | {(a, None, b) for a, b in zip(words, words[2:])}
    return {place_of(f) for f in found}


def plain_ftrl(rows, alpha=3.0, beta=1.0, l1=6.0, l2=0.1, passes=8, least=4):
    """Weight of each feature, number by number; the intercept has the place -1."""
    counts = Counter(f for text, _ in rows for f in word_features(text))
    examples = [([*(f for f in word_features(text) if counts[f] >= least), -1], label) for text, label in rows]
    z, n, rng = defaultdict(float), defaultdict(float), np.random.default_rng(7)

    def weight(f):
        bound = l1 if f >= 0 else 0.0
        return 0.0 if abs(z[f]) <= bound else -(z[f] - math.copysign(bound, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    for _ in range(passes):
        for k in rng.permutation(len(examples)):
            found, label = examples[k]
            weights = {f: weight(f) for f in found}
            gradient = 1 / (1 + math.exp(-max(-35.0, min(35.0, math.fsum(weights.values()))))) - label
            for f, w in weights.items():
                z[f] += gradient - (math.sqrt(n[f] + gradient**2) - math.sqrt(n[f])) / alpha * w
                n[f] += gradient**2
    return {f: weight(f) for f in z}


def test_toxicity_query_against_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = list(common.training_rows(docs, labels, "toxic", toxicity.TRAINING_ROWS))
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    learned = sorted((t, toxic[i]) for i, t in texts.items() if toxic.get(i) in (0, 1) and zlib.crc32(str(i).encode()) % 5)
    assert sorted(rows) == learned
    weights = plain_ftrl(rows)
    assert any(w for f, w in weights.items() if f >= 0)
    for r in QUERIES["op10_toxicity"](spark, sf).collect():
        total = weights[-1] + math.fsum(weights.get(f, 0.0) for f in word_features(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5), r.doc_id


def plain_language(text, model):
    """Prediction from every n-gram of a text, one after another."""
    data = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.translate(LOWER).encode())
    total, grams = np.zeros(len(model.languages)), 0
    for n in language.SIZES:
        for i in range(len(data) - n + 1):
            value = n
            for b in data[i : i + n]:
                value = (value * 0x01000193 % 2**32) ^ b
            total += model.scores[:, (value * 0x9E3779B1 % 2**32) >> (32 - language.BITS)]
            grams += 1
    logits = (total / max(grams, 1) + model.bias) / model.temperature
    chances = np.exp(logits - logits.max())
    chances /= chances.sum()
    return model.languages[int(chances.argmax())], float(chances.max())


def test_language_query_against_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model, texts = language.trained(docs), {r.doc_id: r.text for r in docs.collect()}
    got = QUERIES["op8_language"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        text = texts[r.doc_id]
        expected = plain_language(text, model) if text and any(c.isalpha() for c in text) else ("und", 0.0)
        assert r.lang_pred == expected[0] and r.score == pytest.approx(expected[1], abs=1e-6), r.doc_id


def test_scores_of_odd_rows(spark, odd, nothing, small):
    model = toxicity.fit([("a b", 0), ("c d", 1)] * 5)
    out = toxicity.score_texts(odd, model, "_toxicity")
    assert out.columns == [*odd.columns, "_toxicity"] and out.count() == odd.count()
    assert toxicity.score_texts(nothing, model).count() == 0
    named = small("documents").select("doc_id", "text", "lang")
    learned = language.trained(named)
    found = {r.doc_id: r for r in language.predict(odd.select("doc_id", "text"), learned).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[1].score == 0.0
    assert found[4].lang_pred in learned.languages and found[8].lang_pred in learned.languages
    assert language.predict(nothing, None).count() == 0 and language.trained(nothing) is None


def test_an_id_with_many_rows_is_learned_from_once(spark, monkeypatch):
    keys = common.sampled(spark.range(1, 60).withColumnRenamed("id", "doc_id"), 60).where(~common.held_out(5, 0) & ~common.held_out(4, 2))
    ids = [r.doc_id for r in keys.orderBy("order").collect()]
    rows = [(i, f"text of {i}", "en") for i in ids] + [(ids[0], f"again {k}", "fr") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in ids], "doc_id long, quality int, toxic int")
    texts = [t for t, _ in common.training_rows(docs, labels, "toxic", 20)]
    assert len(texts) == 20 and texts[1:] == [f"text of {i}" for i in ids[1:20]]
    seen = {}
    for module in (quality, language):
        monkeypatch.setattr(module, "TRAINING_ROWS", 20)
        monkeypatch.setattr(module, "fit", lambda *x, name=module.__name__: seen.setdefault(name, x))
    quality.trained(docs, labels)
    language.trained(docs)
    values, truth = seen[quality.__name__]
    assert truth.tolist() == [i % 2 for i in ids[:20]] and all(len(v) == 20 for v in values.values())
    assert seen[language.__name__][0]["text"].to_pylist()[1:] == [f"text of {i}" for i in ids[1:20]]


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect() if r.lang}
    got = [r for r in QUERIES["op8_language"](spark, SF).collect() if r.doc_id in lang]
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    accepted = [r for r in held if r.accepted]
    assert len(accepted) > 0.9 * len(held) and np.mean([r.lang_pred == lang[r.doc_id] for r in accepted]) > 0.98


def test_subwords_stay_in_their_text():
    texts = ["abc", "", "d", "efgh ij", "é"]
    data = [t.encode() for t in texts]
    whole = np.frombuffer(b"".join(data), np.uint8)
    offsets = np.cumsum([0, *map(len, data)])
    together = list(language.subwords(whole, offsets))
    for k, d in enumerate(data):
        own = [p.tolist() for p in language.subwords(np.frombuffer(d, np.uint8), np.array([0, len(d)]))]
        cut = [p[offsets[k] : max(offsets[k], offsets[k + 1] - n + 1)].tolist() for n, p in zip(language.SIZES, together)]
        assert [c for c in cut if c] == own


CLASHES = ["_row", "_toxicity", "_n_secrets", "_several", "_lone", "__key", "SCORE", "lang_pred", "accepted"]


def test_columns_with_clashing_names_come_back(spark, small):
    docs = small("documents").limit(30)
    own = {name: F.lit(k).cast("long") + F.col("doc_id") for k, name in enumerate(CLASHES)}
    docs = docs.withColumns(own)
    stages = [stage for _, stage in corpus_pipeline.STAGES[:-1]]
    model = toxicity.trained(docs, small("labels"))
    frames = [stage(spark, docs, SF) for stage in stages]
    frames += [toxicity.score_texts(docs, model, "score"), language.predict(docs, None), language.predict(docs, language.trained(small("documents"))), secrets.redact(docs)]
    for k, found in enumerate(frames):
        assert found.columns[: len(docs.columns)] == docs.columns and len({c.lower() for c in found.columns}) == len(found.columns)
        assert k >= 4 or found.columns == docs.columns
        rows = found.collect()
        assert rows and all(r[name] == n + r.doc_id for r in rows for n, name in enumerate(CLASHES))
