"""Ranked search against a plain ranking in Python."""

import math
import random
import re
from collections import Counter

import numpy as np

from convometrics.llm import dense_search as ds

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """{(item_id, item text): [(doc_id, score)]}, best first."""
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    tfs = [(i, tf) for i, tf in tfs if tf]
    n_docs, n_terms = len(tfs), sum(sum(tf.values()) for _, tf in tfs)
    df = Counter(t for _, tf in tfs for t in tf)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
    out = {}
    for item_id, text in set(items):
        found = []
        for i, tf in tfs:
            m = 75 + 25 * sum(tf.values()) * n_docs // n_terms
            score = sum(weight.get(t, 0) * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms(text) if t in tf)
            if score > 0:
                found.append((i, score))
        found.sort(key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        if found:
            out[item_id, text] = found[:k]
    return out


def corpus(seed, n=150):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "B", "Ab", "\u00c9t\u00e9", "\u00e9t\u00e9", "x1", "\u4f60\u597d", "\u00bd"]) + str(rnd.randrange(12))
    text = lambda k: rnd.choice([" ", "-", "\x00", "\n", "\u007f"]).join(word() for _ in range(k))
    docs = [(i, text(rnd.randrange(0, 40))) for i in range(n)]
    docs += [(n + i, docs[i][1]) for i in range(60)]  # copies: equal scores
    docs += [(n + 70, None), (n + 71, ""), (n + 72, "--- !!"), (None, docs[3][1]), (5, docs[4][1]), (5, "x1"), (n + 73, text(30000))]
    items = [(j, text(rnd.randrange(1, 30))) for j in range(20)]
    items += [(30, None), (31, ""), (32, "nowhere"), (33, "x1 x1 " * 50), (34, docs[3][1]), (34, "A1"), (0, items[0][1])]
    return docs, items


def check(spark, docs, items, k=20, **more):
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, score int")
    b = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, rank string")
    got = {}
    for r in ds.search(d, b, k, **more).orderBy("item_id", "item_key", "rank").collect():
        got.setdefault((r["item_id"], r["item_key"]), []).append((r["rank"], r["doc_id"], r["score"]))
    assert all([r[0] for r in rows] == list(range(1, len(rows) + 1)) for rows in got.values())
    plain = brute(docs, items, k)
    want = sorted((item_id, found) for (item_id, _), found in plain.items())
    key = lambda x: (x[0], [(s, i is None, i or 0) for i, s in x[1]])
    assert sorted(((i, [r[1:] for r in rows]) for (i, _), rows in got.items()), key=key) == sorted(((i, f) for i, f in want), key=key)


def test_against_brute_force(spark):
    check(spark, *corpus(1))
    check(spark, *corpus(2), k=3)


def test_groups_of_items_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(ds, "ITEM_TILE", 4)
    monkeypatch.setattr(ds, "COLUMN_TILE", 5)
    monkeypatch.setattr(ds, "DOC_TILE", 16)
    check(spark, *corpus(3), group_terms=100)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    none = ds.search(docs.filter("false"), items)
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score", "item_key"]
    assert ds.search(docs, items.filter("false")).collect() == []


def test_column_tiles_stay_below_the_limit():
    rnd = random.Random(4)
    weights = {(rnd.randrange(30), rnd.randrange(5)): rnd.choice([1, 7, 90, 250, 1000]) for _ in range(80)}
    tiles = ds.column_tiles(weights, 5, limit=100, width=6)
    total = {}
    for columns, entries in tiles:
        matrix = ds.dense((len(columns), 5), *entries)
        assert len(columns) <= 6 and matrix.sum(axis=0).max() <= 100 and len(set(columns.tolist())) == len(columns)
        for row, column in enumerate(columns.tolist()):
            for item in range(5):
                total[column, item] = total.get((column, item), 0) + int(matrix[row, item])
    assert {k: v for k, v in total.items() if v} == weights
    assert len(tiles) > 10


def test_ties_at_the_edge_of_a_tile():
    scores = np.array([5, 9, 5, 0, 5, 9, 5])
    ids = np.array([70, 3, 10, 1, 40, 2, 20])
    assert ids[ds.tile_top(scores, ids, 4)].tolist() == [2, 3, 10, 20]
    assert ids[ds.tile_top(scores, ids, 40)].tolist() == [2, 3, 10, 20, 40, 70]


def test_terms_are_compared_byte_by_byte():
    words = ds.Vocabulary([b"abc", b"x"])
    words.hashes = words.hashes.copy()
    words.start, words.end = words.start[::-1], words.end[::-1]  # hashes that name the wrong terms
    data = np.frombuffer(b"abc x", np.uint8)
    assert words.columns(data, np.array([0, 4]), np.array([3, 5])).tolist() == [-1, -1]
