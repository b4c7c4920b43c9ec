"""Packing: every word once, no bin over capacity, no conflict in a bin, bins as tight as a plain best fit."""

import random
from collections import defaultdict

import pandas as pd

from convometrics.llm import best_fit

SCHEMA = "doc_id long, text string, source string, size string"


def make(spark, n=300, hot=0.4, seed=4):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        k = rnd.choice([0, 1, 5, 17, 33, 64, 100, 128, 300])
        text = None if k == 0 and i % 2 else " ".join([f"d{i}"] * k)
        rows.append((i, text, "hot" if rnd.random() < hot else rnd.choice(["a", "b", None]), "x"))
    rows += [(1000 + i, "same text here", rnd.choice(["a", "b", "c", "d"]), "x") for i in range(40)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def check(rows, got, capacity, one_per_source, cluster_of):
    texts = {r[0]: (r[1] or "") for r in rows}
    source = {r[0]: r[2] for r in rows}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
    assert set(pieces) == set(texts)
    for d, parts in pieces.items():
        parts.sort(key=lambda r: r["piece"])
        assert sum(p["n_words"] for p in parts) == len(texts[d].split())
        assert [p["first_word"] for p in parts] == [i * capacity for i in range(len(parts))]
    for parts in bins.values():
        parts.sort(key=lambda r: r["bin_start"])
        at = 0
        for p in parts:
            assert p["bin_start"] == at
            at += p["n_words"]
        assert at <= capacity
        ids = [p["doc_id"] for p in parts]
        assert len({cluster_of(d) for d in ids}) == len(ids)
        if one_per_source:
            assert len({source[d] for d in ids}) == len(ids)
    return len(bins)


def test_constraints(spark):
    rows, df = make(spark)
    texts = {r[0]: r[1] for r in rows}
    for one in (True, False):
        got = best_fit.pack(df, capacity=128, one_per_source=one).collect()
        check(rows, got, 128, one, lambda d: texts[d])


def test_cluster_column(spark):
    rows, df = make(spark)
    got = best_fit.pack(df, capacity=200, cluster="doc_id").collect()
    check(rows, got, 200, True, lambda d: d)


def test_tightest_compatible_bin_is_found():
    """Against a plain search over all open bins."""
    rnd = random.Random(8)
    bins, plain = best_fit.Bins(100), []
    for _ in range(600):
        size, bits = rnd.randint(1, 100), rnd.choice([1, 2, 4, 8, 3, 0])
        fitting = [b for b in plain if b[0] + size <= 100 and not b[1] & bits]
        number, start = bins.place(size, bits)
        if fitting:
            best = max(b[0] for b in fitting)
            assert plain[number][0] == best == start and not plain[number][1] & bits
            plain[number][0] += size
            plain[number][1] |= bits
        else:
            assert number == len(plain) and start == 0
            plain.append([size, bits])


def test_empty_and_hot_shard(spark):
    assert best_fit.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    hot = pd.DataFrame({"shard": 0, "doc_id": range(3000), "source": "hot", "cluster": "c", "size": 7, "row": range(3000)})
    made = best_fit.pack_shard(hot, 2048, True)
    assert made["bin_id"].nunique() == 3000


def test_few_sources_fill_their_bins(spark):
    one = [(i, " ".join(["w"] * 100) + f" d{i}", "only", "x") for i in range(400)]
    packed = best_fit.pack(spark.createDataFrame(one, SCHEMA), source_limit="share")
    got = best_fit.fill(packed).first()
    assert got["bins"] <= 21 and got["words"] == 40400 and got["fill"] > 0.93
    rows, df = make(spark, n=800)
    packed = best_fit.pack(df, capacity=512, cluster="doc_id", source_limit="share").collect()
    check(rows, packed, 512, False, lambda d: d)


def test_share_limit_of_a_source():
    limits = best_fit.source_limits(["a"] * 50 + ["b"] * 5 + [None], [100] * 56, 1000)
    assert limits == {"a": 18, "b": 2, None: 1}  # ten pieces a bin, twice the share of each
    assert best_fit.source_limits([], [], 10) == {}
    rows = pd.DataFrame({"shard": 0, "doc_id": range(56), "source": ["a"] * 50 + ["b"] * 5 + [None], "cluster": [f"c{i}" for i in range(56)], "size": 100, "row": range(56)})
    made = best_fit.pack_shard(rows, 1000, False, True)
    source = dict(zip(rows["doc_id"], rows["source"]))
    for _, part in made.groupby("bin_id"):
        held = [source[d] for d in part["doc_id"]]
        assert all(held.count(s) <= n for s, n in limits.items())


def test_empty_bins_have_no_fill(spark):
    assert best_fit.fill(best_fit.pack(spark.createDataFrame([], SCHEMA))).first()["fill"] == 0.0
