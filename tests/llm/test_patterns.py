"""Periodic runs, spelling variants and fingerprints against plain versions."""

import hashlib
import os
import random
import statistics

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weekcast.llm import fingerprints, periodic, variants
from weekcast.llm.common import SpanHash
from weekcast.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain_runs(words, least):
    """Every period at every place; the smallest period of each stretch."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e, p) for (s, e), p in found.items())


def repetitive(rng):
    """Words from a small alphabet, often a repeated beginning with a fault in it."""
    words = [rng.randrange(rng.choice([1, 2, 3, 10])) for _ in range(rng.choice([0, 1, 2, 5, 30, 100, 200]))]
    if words and rng.random() < 0.5:
        words = (words[: rng.randint(1, len(words))] * 20)[: len(words)]
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = 99
    return words


def found_runs(texts, least):
    lengths = np.array([len(x) for x in texts], np.int64)
    numbers = np.array([w for x in texts for w in x], np.int64)
    return [x.tolist() for x in periodic.find_runs(numbers, lengths, least)]


@pytest.mark.parametrize("seed", range(60))
def test_runs_against_every_period_at_every_place(seed):
    rng = random.Random(seed)
    texts, least = [repetitive(rng) for _ in range(rng.randint(0, 6))], rng.choice([2, 12])
    expected, at = [], 0
    for words in texts:
        expected += [(s + at, e + at, p) for s, e, p in plain_runs(words, least)]
        at += len(words)
    assert list(zip(*found_runs(texts, least))) == sorted(expected, key=lambda x: (x[0], x[2]))


def test_candidates_in_small_blocks_find_the_same(monkeypatch):
    texts = [repetitive(random.Random(k)) for k in range(100, 120)]
    whole = found_runs(texts, 2)
    monkeypatch.setattr(periodic, "BLOCK", 7)
    assert found_runs(texts, 2) == whole


@pytest.mark.parametrize("seed", range(20))
def test_grammar_extensions_against_comparing_word_by_word(seed):
    rng = random.Random(seed)
    texts = [x for x in (repetitive(rng) for _ in range(5)) if len(x) > 1] or [[1, 1]]
    symbols, owner, pairs = [0], [0], []
    for t, words in enumerate(texts):
        begin = len(symbols)
        symbols += [w + 1 for w in words] + [0]
        owner = owner[:-1] + [t] * (len(words) + 2)
        pairs += [sorted(rng.sample(range(begin, begin + len(words)), 2)) for _ in range(50)]
    levels = periodic.grammar(np.array(symbols), np.array(owner))
    # One symbol for each text at the top, and every level spells the one below.
    assert len(levels[-1].symbols) == 2 * len(texts) + 1
    for low, high in zip(levels, levels[1:]):
        assert len(high.symbols) < len(low.symbols) == low.first[-1] and (low.symbols[low.first[:-1]] == 0).tolist() == (high.symbols == 0).tolist()
    i, j = np.array(pairs).T

    def same(a, b, step):
        n = 0
        while symbols[a] == symbols[b] != 0:
            n, a, b = n + 1, a + step, b + step
        return n

    assert periodic.extensions(levels, i, j).tolist() == [same(a, b, 1) for a, b in pairs]
    last = len(symbols) - 1
    back = periodic.extensions([x.mirrored() for x in levels], last - j, last - i)
    assert back.tolist() == [same(a, b, -1) for a, b in pairs]


def test_long_repeated_and_long_random_texts():
    assert found_runs([[0] * 200_000], 12) == [[0], [200_000], [1]]
    words = np.random.default_rng(1).integers(0, 50_000, 200_000).tolist()
    assert found_runs([words + words[-500:]], 12) == [[199_500], [200_500], [500]]


def test_word_runs_of_odd_texts(spark, odd, nothing):
    own = [(20, "a b " * 6 + "a"), (21, "x " * 12 + "y z " * 7), (22, " ".join("abcdefghijkl"))]
    docs = odd.unionByName(spark.createDataFrame(own, "doc_id long, text string"), allowMissingColumns=True)
    rows = periodic.word_runs(docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() and sum(r.doc_id == 7 for r in rows) == 2
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[1].collapsed == "" and got[1].runs == []
    assert [tuple(r) for r in got[5].runs] == [(0, 30_000, 1)] and got[5].collapsed == "word"
    assert [tuple(r) for r in got[20].runs] == [(0, 13, 2)] and got[20].collapsed == "a b"
    assert [tuple(r) for r in got[21].runs] == [(0, 12, 1), (12, 14, 2)] and got[21].collapsed == "x y z"
    assert got[22].runs == [] and got[None].n_words == 5
    assert periodic.word_runs(nothing).count() == 0
    digests = {r.doc_id: r for r in periodic.digests(periodic.word_runs(periodic.echoed(docs.where("doc_id < 4 OR doc_id IS NULL")))).collect()}
    assert digests[1].n_runs == 0 and digests[1].start is None and digests[1].runs_sha256 == hashlib.sha256(b"").hexdigest()
    assert digests[None].collapsed_sha256 == hashlib.sha256(b"a row without an id").hexdigest()
    assert periodic.digests(periodic.word_runs(periodic.echoed(nothing))).count() == 0


def plain_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words, ratio=2):
    near = {w: [x for x in words if plain_near(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words}


def made_up_words(seed, n):
    """Words and copies of them with one letter changed, some too long for a matrix row, some with letters outside Latin."""
    rng, words = random.Random(seed), {}
    while len(words) < n:
        word = "".join(rng.choice("abcéüxyж") for _ in range(rng.choice([1, 2, 4, 5, 6, 8, 31, 32, 33, 40])))
        for _ in range(rng.randint(1, 4)):
            words[word] = rng.choice([1, 2, 3, 5, 8, 16, 40])
            k = rng.randrange(len(word))
            word = rng.choice([word[:k] + word[k + 1 :], word[:k] + "q" + word[k + 1 :], word[:k] + "a" + word[k:]]) or "a"
    return words


@pytest.mark.parametrize("tree", [16_384, 20])
def test_variants_against_all_pairs(spark, monkeypatch, tree):
    monkeypatch.setattr(variants, "TREE", tree)
    monkeypatch.setattr(variants, "SEARCHED", 50)
    monkeypatch.setattr(variants, "ASKING", 2 * tree)
    words = made_up_words(tree, 400)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    if tree == 20:
        assert variants.subtree_depth(frame, variants.letter_groups(frame)) > variants.LEAST_DEPTH
    got = [tuple(r) for r in variants.group_variants(frame).collect()]
    assert len(got) == len(words) and set(got) == plain_variants(words)


@given(st.text("abé", max_size=6), st.text("abé", max_size=6))
@settings(max_examples=300, deadline=None)
def test_one_apart_against_all_edits(a, b):
    expected = plain_near(a, b)
    assert variants.one_apart(a, b) == expected
    zero = np.zeros(1, np.int64)
    assert variants.near(variants.Letters([a]), variants.Letters([b]), zero, zero).tolist() == [expected]
    if expected:
        groups = variants.LetterGroups(["a", "b"], 3)
        x, y = groups.vectors([a, b])
        for depth in range(1, 4):
            assert ",".join(map(str, y[:depth])) in variants.reached(x[:depth].tolist())
        assert variants.Trie(groups.vectors([b])).search(groups.vectors([a]))[0].tolist() == [0]


def test_forms_are_followed_to_the_last(spark):
    words = {"a" * k: 2**k for k in range(1, 14)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r.root for r in variants.group_variants(frame).collect()} == {"a" * 13}


def test_words_of_odd_texts(spark, odd, nothing):
    own = [(20, "Straße STRASSE straßen Ünïcode ünïcode x×y÷zz"), (21, "abcdeF abcdef1abcdef")]
    docs = odd.unionByName(spark.createDataFrame(own, "doc_id long, text string"), allowMissingColumns=True)
    got = {r.word: r.n for r in variants.word_counts(docs).collect()}
    assert got["straße"] == got["strasse"] == got["straßen"] == 1 and got["Ünïcode"] == got["ünïcode"] == 1
    assert got["x×y÷zz"] == 1 and got["abcdef"] == 3 and got["words"] == 3 and got["q" * 5000] == 1 and "word" not in got
    assert variants.word_counts(nothing, slip=97).count() == 0
    empty = spark.createDataFrame([], "word string, n long")
    assert variants.group_variants(empty).count() == 0


def plain_fingerprint(data):
    """Byte by byte, each window and chunk hashed alone."""
    block = fingerprints.LEAST_BLOCK
    while block * fingerprints.CHUNKS < len(data):
        block *= 2

    def hashed(part):
        array = np.frombuffer(part, np.uint8)
        return int(SpanHash(array).spans(np.array([0]), np.array([len(part)]))[0])

    signatures = []
    for size in (block, 2 * block):
        signature, last = "", 0
        for i in range(1, len(data) + 1):
            ends = i >= 7 and hashed(data[i - 7 : i]) % size == size - 1 and i - last >= size // 4
            if ends or i - last == 4 * size or i == len(data):
                value = hashed(data[last:i])
                signature += chr(fingerprints._LETTERS[value >> 6 & 63]) + chr(fingerprints._LETTERS[value & 63])
                last = i
        signatures.append(signature)
    return f"{block}:{signatures[0]}:{signatures[1]}"


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (size_a, *x), (size_b, *y) = a.split(":"), b.split(":")
    best = 0.0
    for i in range(2):
        for j in range(2):
            if int(size_a) << i == int(size_b) << j:
                s, t = ([z[k : k + 2] for k in range(0, len(z), 2)] for z in (x[i], y[j]))
                row = list(range(len(t) + 1))
                for k, c in enumerate(s):
                    new = [k + 1]
                    for m, d in enumerate(t):
                        new.append(row[m] if c == d else 1 + min(row[m + 1], new[m]))
                    row = new
                best = max(best, 1 - row[-1] / (len(s) + len(t)) if s or t else 1.0)
    return best


TEXTS = st.lists(st.one_of(st.text(max_size=20), st.sampled_from(["a" * 300, "To " * 50, "é" * 40, "\n"])), max_size=4).map("".join)


@given(st.lists(TEXTS, max_size=4))
@settings(max_examples=60, deadline=None)
def test_fingerprints_against_bytes_one_by_one(texts):
    prints = fingerprints.fingerprint_of(texts)
    assert prints == [plain_fingerprint(x.encode()) for x in texts]
    for a in prints:
        for b in prints:
            assert fingerprints.likeness(a, b) == pytest.approx(plain_likeness(a, b), abs=1e-12)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_neighbours_of_the_whole_table(spark, small, partitions):
    texts = [r.text or "" for r in small("documents").orderBy("doc_id").collect()]
    following = texts[1:] + texts[:1]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = QUERIES["op13_fingerprints"](spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows.sort(key=lambda r: r.doc_id)
    assert len(rows) == len(texts)
    changed = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for x, y in zip(texts, following)]
    prints, changed_prints = fingerprints.fingerprint_of(texts), fingerprints.fingerprint_of(changed)
    for k, r in enumerate(rows):
        assert r.n_chars == len(texts[k]) and r.edited_sha256 == hashlib.sha256(changed[k].encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (prints[k], changed_prints[k])
        assert r.near_edited == pytest.approx(plain_likeness(prints[k], changed_prints[k]), abs=1e-12)
        assert r.near_next == pytest.approx(plain_likeness(prints[k], prints[(k + 1) % len(rows)]), abs=1e-12)
    long = [r for r in rows if r.n_chars > 200]
    assert statistics.mean(r.near_edited > 0.3 for r in long) > 0.95 and statistics.mean(r.near_edited for r in long) > 0.45
    assert statistics.mean(r.near_next < 0.1 for r in long) > 0.95


def test_neighbours_of_odd_rows(spark, odd, nothing):
    rows = fingerprints.edited_neighbours(odd).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count() and sum(r.doc_id == 7 for r in rows) == 2
    assert got[1].fingerprint == got[2].fingerprint == "4::" and got[1].near_next == got[1].near_edited == 1.0
    assert got[2].near_next == 0.0 and got[6].fingerprint == got[7].fingerprint and got[6].near_next == 1.0
    # The last one is followed by the first, the row without an id.
    assert got[10].edited_sha256 == hashlib.sha256(("q" * 2500 + "a row without an id").encode()).hexdigest()
    assert fingerprints.edited_neighbours(nothing).count() == 0
    one = fingerprints.edited_neighbours(odd.where("doc_id = 4")).collect()
    assert [(r.doc_id, r.near_next, r.near_edited) for r in one] == [(4, 1.0, 1.0)]
    alone = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(odd).collect()}
    assert alone == {i: r.fingerprint for i, r in got.items()}
    same = spark.createDataFrame([("4:AB:AB", "4:AB:AB"), ("4:AB:CD", None)], "a string, b string")
    assert [r[0] for r in same.select(fingerprints.fingerprint_likeness(same.a, same.b)).collect()] == [1.0, None]


def test_batches_of_any_size_stream_alike(spark, small):
    docs = small("documents").orderBy("doc_id").limit(50).toArrow()
    texts = pa.table({"doc_id": docs["doc_id"], "text": docs["text"]})
    expected = {r.doc_id: r for r in fingerprints.edited_neighbours(spark.createDataFrame(texts.to_pandas())).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.doc_id: r for r in fingerprints.edited_neighbours(spark.createDataFrame(texts.to_pandas())).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected
