"""Repeated passages against brute force over all windows."""

import hashlib
import random

import numpy as np

from convometrics.llm import phrase_automata as pa_
from convometrics.llm.common import poly_run_hashes

SCHEMA = "doc_id long, text string, starts string"


def brute(rows, window):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n=60, vocabulary=200):
    rnd = random.Random(seed)
    fresh = lambda k: [f"w{rnd.randrange(vocabulary)}" for _ in range(k)]
    passages = [fresh(rnd.randint(8, 90)) for _ in range(6)]
    texts = []
    for _ in range(n):
        w = fresh(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 3)
            w += p[a : len(p) - rnd.randint(0, len(p) // 3)] + fresh(rnd.randint(0, 30))
        texts.append(rnd.choice([" ", "\n", "\t "]).join(w))
    texts += [None, "", "one", rnd.choice(texts), texts[3], "a " * 300, "a " * 120, "b a " * 100]
    return list(enumerate(texts))


def check(spark, rows, window, phrase, shard_bytes=2000):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in pa_.repeated_passages(df, window, phrase, shard_bytes).collect()}
    assert got == brute(rows, window)


def test_against_brute_force(spark):
    check(spark, corpus(1), 20, 5)
    check(spark, corpus(2, vocabulary=4), 12, 3)


def test_rows_that_share_a_doc_id(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (2, "a b c"), (2, long + " tail"), (2, None), (2, long + " tail"), (None, long)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = sorted(tuple(r)[:3] for r in pa_.repeated_passages(df, 20, 5, 2000).collect() if r["doc_id"] is not None)
    assert got == [(1, 60, 0), (2, 0, 0), (2, 3, 0), (2, 61, 60), (2, 61, 60)]
    texts = sorted(str(r["text"]) for r in pa_.without_repeats(df, 20).collect() if r["doc_id"] == 2)
    assert texts == ["None", "a b c", "tail", "tail"]


def test_the_automaton_decides(spark):
    """A phrase that is left out of the automaton is not located, and its windows are no candidates."""
    import pandas as pd

    words = [f"w{i}" for i in range(40)]
    text = " ".join(words).encode()
    docs = pd.DataFrame({"doc_id": [4, 5], "text": [text, b"nothing here " * 20]})
    sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in docs["text"]]
    phrases = [" ".join(words[i : i + 5]).encode() for i in (3, 30)]
    known = lambda held: pd.DataFrame({"doc_id": [4.0, 5.0, *[None] * len(held)], "sha": [*sha, *[None] * len(held)], "words": [None, None, *held]})
    starts = lambda held: [s for row in pa_._locate(docs, known(held), 10, 5)["starts"] for s in row]
    assert starts(phrases) == [0, 1, 2, 3, 25, 26, 27, 28, 29, 30]
    assert starts(phrases[:1]) == [0, 1, 2, 3] and starts(phrases[1:]) == [25, 26, 27, 28, 29, 30] and starts([]) == []
    # whole words only
    assert len(pa_.occurrences(pa_.automaton_of([b"b c"]), b"ab cd b c x", np.array([0, 3, 6, 8, 10]))) == 1


def test_very_long_texts(spark):
    rnd = random.Random(9)
    long = [f"w{rnd.randrange(50000)}" for _ in range(120_000)]
    check(spark, [(1, " ".join(long)), (2, " ".join(long[50_000:50_100])), (3, " ".join(["x"] * 30 + long[119_900:]))], 50, 8)


def test_contract_parameters_on_copies(spark):
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(3000)}" for _ in range(700)]
    rows = [(7, " ".join(base))]
    for i in range(40):
        w = list(base)
        for _ in range(rnd.randint(0, 12)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(50)}"
        rows.append((rnd.choice([i, 100 + i]) if i != 7 else 300, " ".join(w[rnd.randint(0, 100) :])))
    check(spark, rows, 50, 8)


def test_cut_texts_and_empty_table(spark):
    rows = corpus(3)
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r["text"] for r in pa_.without_repeats(df, 20).collect()}
    for i, (n, gone, sha) in brute(rows, 20).items():
        assert hashlib.sha256(b" ".join((got[i] or "").encode().split())).hexdigest() == sha
    assert pa_.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_run_hashes_depend_on_the_words_alone():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 5, 4000).astype(np.uint64)
    for k in (1, 2, 3, 7, 8, 50):
        h = poly_run_hashes(a, k)
        assert len(h) == len(a) - k + 1
        seen = {}
        for i in range(len(h)):
            assert seen.setdefault(tuple(a[i : i + k]), h[i]) == h[i]
        assert len(set(h.tolist())) == len(seen)
