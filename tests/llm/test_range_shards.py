"""Sharding against a plain placing of all rows in one list."""

import hashlib
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from convometrics.llm import range_shards as rs

SCHEMA = "doc_id long, text string, shard string, key string, part string, copy int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "clash", "k", "p", 1) for i, t in rows], SCHEMA).repartition(parts)


def brute(rows, shards, overhead=8):
    made = [(hashlib.md5((t or "").encode()).hexdigest(), i is not None, i or 0, len((t or "").encode()) + overhead, zlib.crc32((t or "").encode()), i) for i, t in rows]
    made.sort(key=lambda x: x[:5])
    total, start, slots, out = sum(x[3] for x in made), 0, Counter(), []
    for x in made:
        shard = min(shards - 1, (2 * start + x[3]) * shards // (2 * total))
        out.append((x[5], x[3], x[4], "bytes", shard, slots[shard], None))
        slots[shard] += 1
        start += x[3]
    return Counter(out)


def corpus(seed, n=400):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(-5, 10 * n), "".join(rnd.choice("aé b") for _ in range(int(rnd.expovariate(0.02))))) for _ in range(n)]
    rows += [(7, "hot text " * 3)] * 300  # a third of the rows: equal in all
    rows += [(i, "shared by many") for i in range(200)]
    rows += [(None, None), (None, ""), (3, None), (None, "shared by many"), (1, "long " * 4000)]
    return rows


def check(spark, rows, shards, **more):
    got = rs.shard_documents(frame(spark, rows, **more), shards)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, shards)


def test_against_a_plain_list(spark):
    check(spark, corpus(1), 24)
    check(spark, corpus(2), 5, parts=1)
    check(spark, [(1, "one")], 24)


def test_shards_are_near_equal_and_slots_gapless(spark):
    rows = corpus(3, 1500)
    out = rs.shard_documents(frame(spark, rows), 8).collect()
    sizes, slots = Counter(), {}
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    share, largest = sum(sizes.values()) / 8, max(r["size"] for r in out)
    assert all(abs(size - share) <= largest for size in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(rs, "DRAWS_PER_RANGE", 1)  # poor quantiles
    entries = rs.stored(rs.record_entries(frame(spark, corpus(4, 3000))), "test-entries")
    total, count = entries.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    splitters = rs.sampled_splitters(entries, 40, total, count)
    assert splitters == sorted(set(splitters))
    sums = entries.groupBy(rs.splitters_below(splitters, F.col("key")).alias("range")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("keys")
    )
    largest = entries.agg(F.max("bytes")).first()[0]
    for r in sums.collect():
        assert r["keys"] == 1 or (r["bytes"] <= 2 * total / 40 + largest and r["n"] <= 2 * count / 40 + 1)


def test_binary_search_over_splitters(spark):
    keys = sorted(f"{k:03d}" for k in random.Random(5).sample(range(300), 77))
    rows = spark.range(300).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("key"))
    for held in (keys, keys[:1], []):
        for r in rows.select("key", rs.splitters_below(held, F.col("key")).alias("n")).collect():
            assert r["n"] == sum(k <= r["key"] for k in held)


def test_empty_table(spark):
    assert rs.shard_documents(frame(spark, [(1, "a")]).filter("false")).collect() == []


def test_written_shards(spark, tmp_path):
    rows = corpus(6)
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, user int")
    rs.write_shards(docs, str(tmp_path / "out"), 6, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["user"] for r in back.collect()) == list(range(len(rows)))
    where = {}
    for r in back.collect():
        where.setdefault((r["doc_id"], r["text"]), Counter())[r["shard"]] += 1
    want = {}
    for (i, _, crc, _, shard, _, _), n in brute(rows, 6).items():
        want.setdefault((i, crc), Counter())[shard] += n
    for (i, t), shards in where.items():
        assert set(shards) <= set(want[i, zlib.crc32((t or "").encode())])
