"""Language mixtures on invented languages, and the held-out accuracy on the documents."""

import random

import numpy as np
import pyarrow as pa

from convometrics.llm import lang_mixture as lm
from convometrics.llm.queries import llm_queries

SCHEMA = "doc_id long, text string, lang string, source string, score double"
LETTERS = {"xa": "aeiouklmn", "xb": "bdgprstvw", "xc": "éèàçùâêîô"}


def words(lang, k, rnd):
    return " ".join("".join(rnd.choice(LETTERS[lang]) for _ in range(rnd.randint(2, 8))) for _ in range(k))


def corpus(spark, n=120):
    rnd = random.Random(1)
    rows = [(i, words(lang, rnd.randint(5, 80), rnd), lang, "s", 0.0) for i, lang in enumerate(rnd.choice(list(LETTERS)) for _ in range(n))]
    rows += [(1000, None, "xa", None, 0.0), (1001, "", None, None, 0.0), (1002, "123 456 !?", "xb", None, 0.0), (1005, "\u00bd \u00b2 \u2460 \u2163", None, None, 0.0), (1003, words("xa", 30000, rnd), None, None, 0.0),
             (1004, words("xa", 200, rnd) + " " + words("xc", 100, rnd), None, "s", 0.0), (1004, words("xb", 3, rnd), None, "s", 0.0), (None, words("xb", 9, rnd), "xb", None, 0.0)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_predictions_and_defined_cases(spark):
    rows, df = corpus(spark)
    got = lm.languages(df).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == lang for i, _, lang, _, _ in rows[:120])
    assert all(0 <= r["score"] <= 1 for r in got)
    for i in (1000, 1001, 1002, 1005):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[1003]["lang_pred"] == "xa" and by_id[None]["lang_pred"] == "xb" and not by_id[None]["held_out"]


def test_proportions_of_a_mixture(spark):
    rows, df = corpus(spark)
    langs, table = lm.train(df)
    rnd = random.Random(9)
    texts = pa.array([(words("xa", 200, rnd) + " " + words("xc", 100, rnd)).encode(), words("xb", 50, rnd).encode(), b""], pa.binary())
    share, has = lm.mixtures(texts, table)
    assert abs(share[0][langs.index("xa")] - 2 / 3) < 0.02 and abs(share[0][langs.index("xc")] - 1 / 3) < 0.02 and share[0][langs.index("xb")] == 0
    assert share[1][langs.index("xb")] == 1 and np.all(share[2] == 0) and list(has) == [True, True, False]


def test_proportions_of_many_languages():
    """Sets are not limited in size: five and seven of eight learned languages in a text."""
    rnd = random.Random(11)
    letters = [chr(0x4E00 + 40 * i) + "".join(chr(0x4E00 + 40 * i + j) for j in range(1, 12)) for i in range(8)]

    def some(i, k):
        return " ".join("".join(rnd.choice(letters[i]) for _ in range(rnd.randint(2, 6))) for _ in range(k))

    counts = [np.bincount(lm.grams(pa.array([some(i, 3000).encode()], pa.binary()))[0], minlength=1 << lm.BUCKET_BITS) for i in range(8)]
    table = np.stack(counts, 1) + lm.SMOOTHING
    table = np.log(table / table.sum(0)).astype(np.float32)
    texts = [" ".join(some(i, 100) for i in of) for of in ((0, 1, 2, 3, 4), range(7), range(8), (6,), (2, 5))]
    share, _ = lm.mixtures(pa.array([t.encode() for t in texts], pa.binary()), table)
    assert [(row > 0).sum() for row in share] == [5, 7, 8, 1, 2]
    assert all(np.abs(row[row > 0] - 1 / (row > 0).sum()).max() < 0.02 for row in share)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None, None, 0.0)], SCHEMA)
    assert [r["lang_pred"] for r in lm.languages(df).collect()] == ["und"]
    assert lm.languages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = llm_queries()["op1_language_mixture"](spark, sf).filter("held_out")
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    judged = got.join(truth, "doc_id").filter("lang IS NOT NULL AND lang_pred <> 'und'").selectExpr("avg(int(lang = lang_pred)) a").first()["a"]
    assert judged >= 0.98
