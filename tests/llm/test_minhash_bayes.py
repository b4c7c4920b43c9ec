"""Near-duplicates against all pairs."""

import itertools
import random
import re

import numpy as np

from convometrics.llm import minhash_bayes as mb
from convometrics.llm.components import components

SCHEMA = "doc_id long, text string, component_id string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, k):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute(rows, k, threshold):
    sets = sets_of(rows, k)
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus(seed, groups=8, copies=14):
    rnd, texts = random.Random(seed), []
    for _ in range(groups):
        base = [f"W{rnd.randrange(400)}" for _ in range(rnd.randint(2, 120))]
        for _ in range(rnd.randint(1, copies)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 14))):
                w[rnd.randrange(len(w))] = f"v{rnd.randrange(99)}"
            texts.append(" ".join(w if rnd.random() < 0.7 else [x.lower() for x in w]))
    texts += [None, "", " \n", "one", "One", "two words", "TWO  words", "two words"]
    rnd.shuffle(texts)
    return list(enumerate(texts, 5))


def check(spark, rows, k, threshold=80):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in mb.near_duplicates(df, k, threshold).collect()}
    assert got == brute(rows, k, threshold)


def test_against_all_pairs(spark):
    check(spark, corpus(1), 2)
    check(spark, corpus(2), 5)


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mb, "SMALL", 3)
    monkeypatch.setattr(mb, "BLOCK", 7)
    check(spark, corpus(3, groups=4, copies=60), 2)


def test_chain_of_links(spark):
    """Neighbours are similar, the ends are not; all are one component."""
    words = [f"w{i}" for i in range(400)]
    check(spark, [(i, " ".join(words[4 * i : 4 * i + 80])) for i in range(40)], 2)


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c", ""), (4, "a b c", ""), (4, "a b c", ""), (9, "A B C", "")], SCHEMA)
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in mb.near_duplicates(df, 2).collect()), key=str)
    assert got == sorted([(None, None, True), (4, 4, True), (4, 4, True), (9, 4, False)], key=str)
    assert mb.near_duplicates(spark.createDataFrame([], SCHEMA), 2).count() == 0


def test_sequential_pruning_keeps_similar_pairs():
    rnd = np.random.default_rng(2)
    for similarity, least, most in ((0.82, 0.999, 1.0), (0.5, 0.0, 0.01)):
        a = np.zeros((4000, 120), np.uint16)
        b = (rnd.random((4000, 120)) > similarity).astype(np.uint16)
        assert least <= len(mb.survivors(a, b)) / 4000 <= most


def test_shape_follows_the_corpus():
    assert mb.band_shape(1000) == (5, 24) and mb.band_shape(10**6)[0] == 5 and mb.band_shape(10**9)[0] > 6


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert got == {i: find(i) for i in parent if any(i in e and e[0] != e[1] for e in edges)}


def test_columns_that_clash_stay_as_they_are(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, 7, "x"), (2, text, 8, "y"), (3, "b", 9, "z")], "doc_id long, text string, __keep int, keep string")
    got = mb.keep_one(docs)
    assert got.columns == docs.columns and sorted(tuple(r)[2:] for r in got.collect()) == [(7, "x"), (9, "z")]


def test_very_long_texts(spark):
    rnd = random.Random(11)
    long = [f"w{rnd.randrange(10**6)}" for _ in range(60_000)]
    near = [w if i % 40 else "other" for i, w in enumerate(long)]  # shares 95 per cent of its shingles
    half = long[:30_000] + [f"v{i}" for i in range(30_000)]
    docs = spark.createDataFrame([(9, " ".join(long)), (4, " ".join(near)), (6, " ".join(half))], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in mb.near_duplicates(docs, k=2).collect()}
    assert got == {9: 4, 4: 4, 6: 6}
