"""Mixing: targets against a direct reading of the contract, and what the schedule takes."""

import random

import pytest

from convometrics.llm import mix_schedule as ms

SCHEMA = "doc_id long, text string, source string, n_chars long"


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    left = float(total)
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.remove(s)
    return target


def make(spark, sizes, seed=1):
    rnd, rows = random.Random(seed), []
    for s, n in sizes.items():
        left = n
        while left > 0:
            k = min(left, rnd.choice([1, 3, 20, 80, 400]))
            rows.append((len(rows), " ".join(["w"] * k), s, 7))
            left -= k
        rows.append((len(rows), rnd.choice([None, "", " \n"]), s, 0))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "sizes",
    [{"a": 5000, "b": 4000, "c": 3000, None: 2000}, {"a": 100, "B": 60000, "é": 10, "z": 3}, {"x": 900}, {"a": 0, "b": 50}, {None: 4000, "q": 10, "r": 1}],
)
def test_targets_and_taken(spark, sizes):
    docs = make(spark, sizes)
    got = ms.mix(docs).collect()
    assert len(got) == docs.count()
    expected = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - expected[s]) < 1e-6 * max(1, expected[s]) and r["source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - expected[s]) <= 1
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert sorted(ms.mix(docs).collect()) == sorted(got)


def test_blocks_of_many_words(spark):
    sizes = {f"s{i}": 3000 + 100 * i for i in range(7)}
    got = ms.mix(make(spark, sizes), block_words=64).collect()
    for s, target in brute_targets(sizes).items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target) <= 1


def test_the_schedule_is_the_mix(spark):
    sizes = {f"s{i}": 2500 + 700 * i for i in range(6)} | {None: 900}
    docs = make(spark, sizes)
    slots = sorted(ms.schedule(docs, block_words=32).collect())
    taken = {r["doc_id"]: r["taken"] for r in ms.mix(docs, block_words=32).collect()}
    length = {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
    words, per_slot, order = {}, {}, []
    for r in slots:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["words"]
        per_slot.setdefault(r["slot"], []).append(r)
        assert r["words"] > 0 and 0 <= r["first_word"] and r["first_word"] + r["words"] <= length[r["doc_id"]]
    assert words == {k: v for k, v in taken.items() if v}
    for slot in sorted(per_slot):  # one block of one source in a slot
        assert len({(r["source"], r["block"]) for r in per_slot[slot]}) == 1
        order.append(per_slot[slot][0]["source"])
    # whatever stretch of the mix is read, it holds the sources in their shares
    target = brute_targets(sizes)
    total = sum(target.values())
    for length_ in (50, 200, 1000):
        for at in range(0, len(order) - length_ - 60, 37):
            run = order[at : at + length_]
            for s, t in target.items():
                assert abs(run.count(s) - length_ * t / total) <= 4


def test_columns_that_clash_stay_as_they_are(spark):
    docs = spark.createDataFrame([(i, "w " * 30, "s", 60, 1, "x") for i in range(5)], SCHEMA + ", __copy int, `taken` string")
    mixed = ms.mixed_documents(docs, ms.mix(docs))
    assert mixed.columns == docs.columns and {(r["__copy"], r["taken"]) for r in mixed.collect()} == {(1, "x")}


def test_offsets_in_three_levels(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ms, "CHUNKS_PER_GROUP", 3)
    rows = spark.range(500).select((F.col("id") % 3).alias("key"), F.floor(F.col("id") / 7).alias("chunk"), "id", (F.col("id") % 11).alias("n"))
    total = {}
    for r in sorted(ms._offsets(rows, "chunk", ["id"], "n", "before").collect(), key=lambda r: r["id"]):
        assert r["before"] == total.get(r["key"], 0)
        total[r["key"]] = r["before"] + r["n"]


def test_documents_follow_the_decisions(spark):
    docs = make(spark, {"a": 300, "b": 900, "c": 40})
    decisions = ms.mix(docs)
    mixed = ms.mixed_documents(docs, decisions).collect()
    words = {}
    for r in mixed:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {r["doc_id"]: r["taken"] for r in decisions.collect() if r["taken"]}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ms.mix(empty).count() == 0
    assert ms.mixed_documents(empty, ms.mix(empty)).count() == 0


def test_very_long_texts(spark):
    rows = [(0, "w " * 150_000, "a", 0), (1, "x y", "a", 0), (2, "z " * 40_000, "b", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in ms.mix(docs, block_words=64).collect()}
    targets = brute_targets({"a": 150_002, "b": 40_000})
    assert abs(got[0]["taken"] + got[1]["taken"] - targets["a"]) <= 1 and abs(got[2]["taken"] - targets["b"]) <= 1
    assert all(r["taken"] <= 3 * r["size"] for r in got.values())
