"""Jaccard join, embeddings, decontamination and the pipeline against brute force."""

import os
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weekcast.llm import decontamination, graph, jaccard, packing, secrets, toxicity, vectors
from weekcast.llm.common import CLEANUP, written

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def roots_of(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return [find(a) for a in range(n)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(a, a + 1) for a in range(100, 160)] + [(300, b) for b in range(301, 400)] + [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(120)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    roots = roots_of(700, edges)
    assert got == {a: roots[a] for e in edges if e[0] != e[1] for a in e}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, k):
    found = re.findall(r"[^\x20\t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < k:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def plain_jaccard(rows, k, percent):
    sets = [shingle_set(t, k) if i is not None else frozenset() for i, t in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    pairs.append((a, b))
    roots, links = roots_of(len(rows), pairs), Counter(x for p in pairs for x in p)
    smallest = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            smallest[roots[a]] = min(smallest.get(roots[a], i), i)
    return [(i, len(shingle_set(t, k)), None if i is None else smallest[roots[a]], links[a]) for a, (i, t) in enumerate(rows)]


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_join_against_brute_force(spark, small, odd, k, percent):
    rng = random.Random(k)
    long, short = [f"w{rng.randrange(500)}" for _ in range(130)], [f"s{n}" for n in range(12)]
    own = [(1000 + n, edited(rng, long, rng.randrange(7))) for n in range(140)]
    own += [(2000 + n, " ".join(short[: rng.randrange(1, 13)])) for n in range(40)]
    # Sizes about a power of two, where two scales meet.
    own += [(3000 + n, " ".join(f"t{j}" for j in range(rng.randrange(58, 76)))) for n in range(30)]
    docs = small("documents").select("doc_id", "text").unionByName(spark.createDataFrame(own, "doc_id long, text string"))
    docs = docs.unionByName(odd.select((F.col("doc_id") + 50_000).alias("doc_id"), "text"))
    found = jaccard.jaccard_components(docs, k, percent)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted([tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "n_links").collect()], key=key)
    assert got == sorted(plain_jaccard([tuple(r) for r in docs.select("doc_id", "text").collect()], k, percent), key=key)
    # Repeated rows share their mark; of each component one row is kept.
    kept = found.where("kept AND component_id IS NOT NULL AND n_shingles > 0").select("_row", "component_id").distinct()
    assert kept.count() == found.where("component_id IS NOT NULL AND n_shingles > 0").select("component_id").distinct().count()


def test_jaccard_join_in_many_pieces(spark, monkeypatch):
    """A family that is cut into many blocks has the links of the whole, copies and repeated rows included."""
    monkeypatch.setattr(jaccard, "PIECE", 5)
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rng = random.Random(11)
    long = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = [(n, edited(rng, long, rng.randrange(6))) for n in range(90)]
    rows += [(200 + n, " ".join(long[n // 2 :])) for n in range(40)] + rows[:7] + [(300 + n, t) for n, t in rows[:9]] + [(None, rows[0][1]), (400, "alone in here")]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 90)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted([tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "n_links").collect()], key=key)
    assert got == sorted(plain_jaccard(rows, 3, 90), key=key)


def test_large_families_travel_packed(spark, monkeypatch):
    """What is dealt out to compare a family of near copies takes less than their token sets, not a copy for each hundred members."""
    rng = random.Random(12)
    long = [f"w{rng.randrange(10**6)}" for _ in range(250)]
    docs = spark.createDataFrame([(n, edited(rng, long, 1 + n % 3)) for n in range(900)], "doc_id long, text string").repartition(4)
    dealt, plain = [], jaccard.cell_links

    def measured(cells, percent):
        binary = [c for c, kind in cells.dtypes if kind == "binary"]
        dealt.append(cells.agg(F.sum(sum(F.octet_length(c) for c in binary)), F.count("*")).first())
        return plain(cells, percent)

    monkeypatch.setattr(jaccard, "cell_links", measured)
    found = jaccard.jaccard_components(docs, 3, 90).collect()
    assert len(found) == 900 and {r.component_id for r in found} == {0}
    assert 0 < dealt[0][0] < 0.5 * sum(8 * r.n_shingles for r in found) and dealt[0][1] < 100


def test_linked_blocks_as_plain_pairs():
    """Both ways to count shared tokens, by pairs and by matrices, and the roots of long chains."""
    rng = np.random.default_rng(4)
    for trial in range(60):
        count, size = int(rng.integers(2, 120)), int(rng.integers(5, 60))
        base = rng.integers(0, 2**63, size, dtype=np.uint64)
        pool, members = rng.integers(0, 2**63, 40, dtype=np.uint64), []
        for n in range(count):
            tokens = base[n % 7 :].copy() if trial % 2 else np.arange(n, n + 30, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            tokens[: rng.integers(0, 3)] = pool[rng.integers(0, 38)]
            tokens = np.unique(tokens)
            members.append((n * 7919 % 1009, len(tokens), int(rng.integers(1, 4)), tokens))
        cut = int(rng.integers(1, count))
        for left, right in ((members, None), (members[:cut], members[cut:])):
            every = left + (right or [])
            sides = [0] * len(left) + [1] * len(right or [])
            pairs = []
            for a in range(len(every)):
                for b in range(a):
                    both = len(set(every[a][3].tolist()) & set(every[b][3].tolist()))
                    if (right is None or sides[a] != sides[b]) and 100 * both >= 90 * (every[a][1] + every[b][1] - both):
                        pairs.append((a, b))
            links, roots = Counter(), roots_of(len(every), pairs)
            for a, b in pairs:
                links[a] += every[b][2]
                links[b] += every[a][2]
            assert sorted(jaccard.linked(left, right, 90)) == sorted((every[a][0], every[roots[a]][0], links[a]) for a in links)
        again = jaccard.unpacked(jaccard.packed(members))
        assert [m[:3] for m in again] == [m[:3] for m in members] and all((x[3] == y[3]).all() for x, y in zip(again, members))


def test_written_leaves_no_shuffle_files(spark):
    blocks = lambda: {b.name() for b in map(disk.getAllBlocks().apply, range(disk.getAllBlocks().size())) if b.name().startswith("shuffle_")}
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before, kept = blocks(), spark.conf.get(CLEANUP, None)
    left = spark.range(20_000).select((F.col("id") % 1013).alias("k"), "id").repartition(5, "k")
    out = written(left.groupBy("id").agg(F.count("*").alias("n")), "counts")
    for _ in range(50):
        if not blocks() - before:
            break
        time.sleep(0.1)
    assert not blocks() - before
    assert out.count() == 20_000 and left.count() == 20_000 and spark.conf.get(CLEANUP, None) == kept


def test_pair_signatures_meet():
    """Sets that link share a signature, whatever the frequencies."""
    rng = np.random.default_rng(3)
    for trial in range(300):
        n, percent = int(rng.integers(9, 200)), int(rng.choice([80, 90]))
        universe = rng.integers(-(2**62), 2**62, 2 * n)
        df = dict(zip(universe.tolist(), rng.integers(2, 40, len(universe)).tolist()))
        most = n - -(-percent * n // 100)
        x = set(universe[:n].tolist())
        gone = int(rng.integers(0, most + 1))
        y = set(list(x)[gone:])
        if 100 * len(y) < percent * n:
            continue
        scale = n.bit_length() - 1
        sigs = []
        for s in (x, y):
            own = len(s).bit_length() - 1
            tokens = np.array(sorted(s), np.int64)
            sigs.append(set(jaccard.prefix_signatures(len(s), own == scale or own < scale, len(s), np.array([df[t] for t in tokens.tolist()]), tokens, percent)))
        if len(y).bit_length() == n.bit_length():
            assert sigs[0] & sigs[1], (trial, n, gone)


def test_near_duplicates_of_odd_rows(spark, odd, nothing):
    out = jaccard.drop_near_duplicates(odd)
    assert out.columns == odd.columns
    left = Counter(r.doc_id for r in out.collect())
    assert left == Counter([1, 2, 3, 4, 5, 6, 8, None, 9, 10])
    assert jaccard.drop_near_duplicates(nothing).count() == 0


def test_near_duplicates_without_an_id(spark):
    word = lambda k: " ".join(f"w{k}n{j}" for j in range(60))
    rows = [(None, word(1)), (None, word(1)), (None, word(1) + " more"), (None, word(2)), (7, word(2) + " more"), (None, word(3)), (8, word(4)), (None, ""), (None, None), (None, "")]
    rows += [(None, word(5))] * 40 + [(None, f"{word(5)} x{j}") for j in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    left = jaccard.drop_near_duplicates(docs).collect()
    full = [(r.doc_id, r.text.split("n")[0]) for r in left if r.text]
    assert sorted(full, key=lambda x: x[1]) == [(None, "w1"), (7, "w2"), (None, "w3"), (8, "w4"), (None, "w5")]
    assert len(left) == 5 + 3
    plain = jaccard.jaccard_components(docs).collect()
    assert len(plain) == len(rows) and all(r.kept and r.n_links == 0 and r.component_id is None for r in plain if r.doc_id is None)


def plain_vectors(rows, least):
    ok = [v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v) and i is not None for i, v in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    pairs.append((a, b))
    return pairs


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 32))
    near = base[:120] + rng.normal(size=(120, 32)) * rng.uniform(0.01, 0.4, (120, 1))
    hot = base[:1] + 0.05 * rng.normal(size=(400, 32))
    x = np.concatenate([base, near, hot, base[5:15] * 3, base[20:25]])
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(9001, None), (9002, []), (9003, [0.0] * 32), (9004, [float("nan")] * 32), (9005, [float("inf")] + [1.0] * 31), (9006, [None] + [1.0] * 31), (9007, [1.0, 2.0]), (9008, [2.0, 4.0]), (None, x[0].tolist())]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    pairs = plain_vectors(rows, 0.9)
    links = Counter(k for p in pairs for k in p)
    found = sum(r.n_links for i, r in got.items() if i is not None)
    assert len(got) == len(rows) and found >= 0.98 * 2 * len(pairs)
    assert all(got[i].n_links <= links[k] for k, (i, _) in enumerate(rows) if i is not None)
    roots = roots_of(len(rows), pairs)
    same = [got[i].component_id == rows[roots[k]][0] for k, (i, _) in enumerate(rows) if i is not None]
    assert np.mean(same) > 0.98
    for i in (9001, 9002, 9003, 9004, 9005, 9006):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[9008].component_id == 9007 and got[9008].n_links == 1 and not got[9008].kept
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_vectors(empty).count() == 0


def plain_alignment(a, b):
    h, best = np.zeros((len(a) + 1, len(b) + 1), int), 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
            best = max(best, h[i, j])
    return best


def test_alignment_against_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item = rng.integers(1, 5, rng.integers(1, 12)).astype(np.uint64)
        windows = rng.integers(1, 6, (3, int(rng.integers(1, 20)))).astype(np.uint64)
        assert decontamination.align(item, windows)[0].tolist() == [plain_alignment(item, w) for w in windows]


def test_leaks_are_found_and_clean_documents_left(spark, small):
    rng = random.Random(6)
    items = {r.item_id: r.text for r in small("benchmark").collect()}
    docs = {r.doc_id: r.text for r in small("documents").collect()}
    own = []
    for k, (i, text) in enumerate(items.items()):
        words = text.split()
        for n in range(max(1, len(words) // 10)):
            words[rng.randrange(len(words))] = "changed"
        body = docs[k].split(" ")
        at = rng.randrange(len(body) + 1)
        own.append((5000 + i, " ".join(body[:at] + words + body[at:])))
    frame = small("documents").select("doc_id", "text").unionByName(spark.createDataFrame([*own, (None, None), (9999, "")], "doc_id long, text string"))
    found = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(frame, small("benchmark")).collect()}
    assert sum((5000 + i, i) in found for i in items) >= 0.95 * len(items)
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert exact <= set(found) and all(found[e].score == 1.0 for e in exact)
    for d, i in exact:
        assert docs[d][found[d, i].start : found[d, i].stop].rstrip(".") == items[i].rstrip(".")
    # Whatever else is reported repeats words of its item.
    for (d, i), r in found.items():
        if d < 5000 and (d, i) not in exact:
            match = docs[d][r.start : r.stop].lower().split()
            assert len(set(match) & set(items[i].lower().split())) > 0.4 * len(set(match))


def edited_copies(items, docs):
    """(doc_id, item_id, document) with edited and halved items inside the given documents, in 1, 3 and 30 copies."""
    rng = random.Random(11)
    out = []
    for i, text in items.items():
        for kind, change in (("fourth", 0.25), ("20", 0.2), ("30", 0.3), ("half", 0)):
            words = text.split()
            if kind == "half":
                words = words[: -(-len(words) // 2)]
            elif kind == "fourth":
                words[3::4] = ["changed"] * len(words[3::4])
            else:
                for k in rng.sample(range(len(words)), round(change * len(words))):
                    words[k] = "changed"
            for _ in range((1, 3, 30)[i % 3]):
                body = rng.choice(docs).split(" ")
                at = rng.randrange(len(body) + 1)
                out.append((100_000 + len(out), i, kind, " ".join(body[:at] + words + body[at:])))
    return out


def test_edited_copies_are_found_however_many_there_are(spark, small):
    items = {r.item_id: r.text for r in small("benchmark").collect()}
    copies = edited_copies(items, [r.text[:2000] for r in small("documents").collect() if r.text])
    frame = spark.createDataFrame([(d, t) for d, _, _, t in copies], "doc_id long, text string").unionByName(small("documents").select("doc_id", "text"))
    found = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame, small("benchmark")).collect()}
    share = {kind: np.mean([(d, i) in found for d, i, k, _ in copies if k == kind]) for kind in ("fourth", "20", "30", "half")}
    assert share["fourth"] == share["half"] == 1.0 and share["20"] >= 0.99 and share["30"] >= 0.9, share


def test_leaks_are_the_same_in_parts_of_items(monkeypatch):
    rng = np.random.default_rng(3)
    items = decontamination.Items.of([(i, " ".join(rng.choice(["a", "b", "c", "d"], 12))) for i in range(30)])
    data = np.frombuffer("".join(f"{x} " for x in rng.choice(["a", "b", "c", "d"], 900)).encode(), np.uint8)
    _, _, owner, word = decontamination.word_hashes(data, np.array([0, 400, 500, 1800]))
    place, found = decontamination.grams(owner, word)
    hit, at = decontamination.Lookup(items.seeds).find(found)

    def windows():
        return sorted(tuple(w) for part in decontamination.candidate_windows(owner, place[hit], items, at) for w in part.tolist())

    whole = windows()
    monkeypatch.setattr(decontamination, "PLACES", 100)
    assert windows() == whole and {w[0] for w in whole} == {0, 1, 2}


def test_windows_left_out_reach_no_threshold():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item = rng.integers(1, 9, 10).astype(np.uint64)
        windows = rng.integers(1, 30, (20, 25)).astype(np.uint64)
        near = decontamination.can_reach(item, windows, 0.4)
        assert (decontamination.align(item, windows[~near])[0] / 20 < 0.4).all()


def test_leaks_of_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "word word"), (None, "one two three four five six seven eight nine")], "item_id long, text string")
    assert decontamination.find_leaks(odd, benchmark).count() == 0
    assert decontamination.find_leaks(nothing, benchmark).count() == 0
    assert decontamination.find_leaks(odd, benchmark.limit(0)).count() == 0
    hit = spark.createDataFrame([(1, "so: One, two three FOUR five six seven eight nine. end")], "doc_id long, text string")
    assert [tuple(r)[:3] for r in decontamination.find_leaks(hit, benchmark).collect()] == [(1, None, 1.0)]


def test_short_items_match_word_for_word(spark):
    benchmark = spark.createDataFrame([(1, "Who wrote Faust?"), (2, "one two three four five six seven"), (3, "Faust wrote")], "item_id long, text string")
    docs = [(1, "quiz: who wrote FAUST, then"), (2, "who wrote the Faust"), (3, "one two three four five six seven"), (4, "one two three four five six eight seven"), (5, "who wrote faust")]
    found = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.score, r.start, r.stop) for r in found) == [(1, 1, 1.0, 6, 21), (3, 2, 1.0, 0, 33), (5, 1, 1.0, 0, 15)]


def test_scripts_without_blanks(spark):
    items = [(1, "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"), (2, "いろはにほへとちりぬるをわかよたれそつねならむ"), (3, "ประเทศไทยมีกรุงเทพมหานครเป็นเมืองหลวง"), (4, "\U00020000\U00020001\U00020002\U00020003")]
    edited = items[0][1][:8] + "好" + items[0][1][9:]
    docs = [(i, f"前文 text {t} 。end") for i, t in items] + [(5, f"abc{edited}"), (6, "春天来了花开了鸟儿在树上唱歌夜里下了一场雨")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1)]
    texts = dict(docs)
    for r in found:
        assert texts[r.doc_id][r.start : r.stop] == (edited if r.doc_id == 5 else dict(items)[r.item_id])
        assert (r.score == 1.0) == (r.doc_id != 5)


def test_blocks_of_items_find_the_same(spark, small, monkeypatch):
    whole = decontamination.find_leaks(small("documents"), small("benchmark")).select("doc_id", "item_id", "start", "stop").collect()
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 3000)
    parts = decontamination.find_leaks(small("documents"), small("benchmark")).select("doc_id", "item_id", "start", "stop").collect()
    assert sorted(whole) == sorted(parts) and whole


def test_pipeline_stage_by_stage(spark, small):
    docs = small("documents")
    labels, columns = small("labels"), docs.columns
    score = {r.doc_id: r.s for r in toxicity.score_texts(docs.select("doc_id", "text"), toxicity.trained(docs, labels), "s").collect()}
    one = written(corpus_pipeline.drop_toxic(spark, docs, SF), "one")
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {i for i, s in score.items() if s < 0.5}

    two = written(corpus_pipeline.drop_near_duplicates(spark, one, SF), "two")
    rows = [(r.doc_id, r.text) for r in one.collect()]
    groups = {c for _, _, c, _ in plain_jaccard(rows, 5, 80)}
    assert two.columns == columns and sorted(r.doc_id for r in two.collect()) == sorted(groups)

    three = written(corpus_pipeline.drop_leaks(spark, two, SF), "three")
    items = [r.text for r in small("benchmark").collect()]
    before, after = {r.doc_id: r.text for r in two.collect()}, {r.doc_id: r.text for r in three.collect()}
    assert three.columns == columns and not any(x in t for t in after.values() for x in items)
    assert all(any(len(set(x.split()) & set(before[i].split())) > 0.4 * len(set(x.split())) for x in items) for i in set(before) - set(after))

    four = written(corpus_pipeline.redact_secrets(spark, three, SF), "four")
    assert four.columns == columns and four.count() == three.count()
    for r in four.collect():
        spans, text = secrets.find(after[r.doc_id]), after[r.doc_id]
        assert (r.text == text) == (not spans) and r.n_chars == len(r.text)
        assert not any(text[a:b] in r.text for kind, a, b in spans if kind == "assign")

    last = corpus_pipeline.pack(spark, four, SF)
    lengths = {r.doc_id: r.n for r in last.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert set(lengths) == {r.doc_id for r in four.collect()} and packing.PLACED.split(",")[0].split()[0] == last.columns[0]


def test_pipeline_takes_odd_and_empty_tables(spark, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, SF), "stage")
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.columns == docs.columns
            docs = out if stage is not corpus_pipeline.STAGES[-1][1] else docs


def test_stages_are_listed_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and set(corpus_pipeline.QUERIES) == {"pipeline"}
