"""Exact deduplication against a plain grouping."""

import hashlib
import re

from convometrics.llm import exact_index
from convometrics.session import scratch_path

SCHEMA = "doc_id long, text string, keep_id string"
TEXTS = [None, "", " ", "a  b", "a b", "a\tb", "A b", "a b ", "a\x0bb", "a b", "x" * 100000, "x" * 100000, "é", "é"]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = {}
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            out[(i, sha)] = (keep, len(ids), i == keep)
    return out


def check(spark, rows, batches):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = exact_index.exact_dedup(df, batches=batches, buckets=4).collect()
    assert len(got) == len(rows)
    expected = brute(rows)
    assert {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in got} == expected


def test_groups_and_batches(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    check(spark, rows, 1)
    check(spark, list(reversed(rows)) + [(100 + i, "hot  text") for i in range(300)], 3)


def test_null_and_repeated_ids(spark):
    check(spark, [(None, "p"), (3, "p"), (3, "p"), (None, "q"), (None, "q"), (1, "r")], 2)


def test_new_data_meets_the_index(spark):
    path = scratch_path(spark, "digest_index")
    first = spark.createDataFrame([(10, "a", ""), (11, "b", "")], SCHEMA)
    exact_index.exact_dedup(first, path=path, batches=1, buckets=4).collect()
    later = spark.createDataFrame([(1, "a", ""), (2, "c", "")], SCHEMA)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_index.exact_dedup(later, path=path, batches=1, buckets=4).collect()}
    assert got == {1: (10, False), 2: (2, True)}  # what was there before stays
    index = exact_index.DigestIndex(spark, path, 4).attach().read()
    assert index.count() == 3


def test_keep_first_and_empty(spark):
    df = spark.createDataFrame([(2, "a b", "x"), (1, "a  b", "y"), (1, "a  b", "y"), (3, None, "z")], SCHEMA)
    assert sorted((r["doc_id"], r["text"], r["keep_id"]) for r in exact_index.keep_first(df, buckets=4).collect()) == [(1, "a  b", "y"), (3, None, "z")]
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_index.exact_dedup(empty, buckets=4).count() == 0 and exact_index.keep_first(empty, buckets=4).count() == 0


def test_indexes_whose_paths_end_alike(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    for where, rows in (("one", 3), ("two", 1)):
        got = exact_index.exact_dedup(docs.limit(rows) if rows == 3 else docs.filter("doc_id = 3"), str(tmp_path / where / "index") + "/")
        assert got.count() == rows
    one = exact_index.DigestIndex(spark, str(tmp_path / "one" / "index")).attach()
    assert one.read().count() == 2
    # reopened with another wish, an index keeps the buckets that it was made with
    assert exact_index.DigestIndex(spark, str(tmp_path / "one" / "index"), 7).attach().buckets == exact_index.BUCKETS


def test_buckets_follow_the_number_of_digests():
    n = [exact_index.buckets_for(rows) for rows in (0, 10**6, 10**9, 10**11)]
    assert n[:2] == [32, 32] and n == sorted(n)
    assert all(rows / b <= exact_index.DIGESTS_PER_BUCKET for rows, b in zip((10**9, 10**11), n[2:]))


def test_columns_that_clash_stay_as_they_are(spark):
    docs = spark.createDataFrame([(1, "a", 7, "x"), (2, "a", 8, "y"), (3, "b", 9, "z")], "doc_id long, text string, __id int, __digest string")
    got = exact_index.keep_first(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a", 7, "x"), (3, "b", 9, "z")]


def test_very_long_texts(spark):
    long = "word  \n" * 400_000
    docs = spark.createDataFrame([(5, long), (3, "word " * 400_000), (4, long + "x")], "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_index.exact_dedup(docs).collect()}
    assert got == {5: (3, 2), 3: (3, 2), 4: (4, 1)}
