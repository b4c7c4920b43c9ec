"""The classifier: gradients, defined cases, and held-out accuracy."""

import numpy as np
import pyarrow as pa

from convometrics.llm import quality_mil as qm
from convometrics.llm.queries import llm_queries

DOCS = "doc_id long, text string, quality int"
LABELS = "doc_id long, quality int, toxic int"


def test_gradients_agree_with_differences():
    rnd = np.random.default_rng(1)
    model = qm.AttentionMil()
    model.w["o"] = rnd.normal(0, 1, qm.HIDDEN)
    x, bounds, y = rnd.normal(0, 1, (9, qm.N_FEATURES)), np.array([0, 4, 5, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = model.forward(x, bounds)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grads = model.gradients(model.forward(x, bounds), y)
    for k, w in model.w.items():
        for at in ([0] if w.ndim == 1 else [(0, 0), (1, 2)]):
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-5 - grads[k][at]) < 1e-6, k


def test_one_passage_can_decide():
    """Bags of good passages against bags with a single shouting one among many."""
    rnd = np.random.default_rng(2)

    def bag(bad):
        w = ["".join(rnd.choice(list("abcdefgh"), 5)) for _ in range(640)]
        if bad:
            at = 64 * rnd.integers(0, 10)
            w[at : at + 64] = [x.upper() + "!!" for x in w[at : at + 64]]
        return " ".join(w).encode()

    x, bounds = qm.encode(pa.array([bag(i % 2) for i in range(200)], pa.binary()))
    model = qm.AttentionMil().fit(x, bounds, np.array([1.0 - i % 2 for i in range(200)]))
    x, bounds = qm.encode(pa.array([bag(i % 2) for i in range(60)], pa.binary()))
    scores = model.forward(x, bounds)["score"]
    assert (scores[::2] > 0.7).all() and (scores[1::2] < 0.3).all()


def test_training_keeps_whole_bags(spark, monkeypatch):
    """Long texts whose only junk is the last passage: learned as such; the sample is bounded by rows alone."""
    rnd = np.random.default_rng(3)
    words = ["".join(rnd.choice(list("abcdefgh"), 5)) for _ in range(2000)]

    def text(bad):
        w = [words[i] for i in rnd.integers(len(words), size=64 * 419)]
        return " ".join(w + ["#JUNK!!" if bad else "plain"] * 64)

    texts = {i: text(i % 2) for i in range(60)}
    docs = spark.createDataFrame([(i, t, 9) for i, t in texts.items()], DOCS).repartition(8)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in texts], LABELS)
    given, fit = [], qm.AttentionMil.fit
    monkeypatch.setattr(qm.AttentionMil, "fit", lambda self, x, bounds, y: given.append((x, bounds, y)) or fit(self, x, bounds, y, epochs=30, batch=8))
    model = qm.train(docs, labels)
    x, bounds = qm.encode(pa.array([t.encode() for t in texts.values()], pa.binary()))
    assert (given[0][0] == x).all() and (given[0][1] == bounds).all()
    good, bad = (qm.scores_of(model, pa.array([text(b).encode() for _ in range(10)], pa.binary())) for b in (0, 1))
    assert good.min() > 0.9 and bad.max() < 0.1
    qm.train(docs, labels, train_passages=420 * 10 + 419)
    assert np.diff(given[1][1]).tolist() == [420] * 10
    assert qm.train(docs, labels, train_passages=419) == 1.0  # no bag fits


def test_defined_cases(spark):
    texts = [None, "", " \n", "word", "long " * 50000] + [f"plain words here number {i} and more of them" for i in range(60)]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)] + [(None, "no id", 9)], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(21, None, 0), (22, 1, 0), (22, 0, 0)], LABELS)
    got = qm.quality_scores(docs, labels).collect()
    assert len(got) == len(texts) + 1
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["score"] == 0.0 and by_id[i]["predicted"] == 0 for i in range(3))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    kept = qm.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["predicted"]}
    none = qm.quality_scores(docs, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in none.filter("doc_id > 2").collect()} == {1.0}
    assert qm.quality_scores(spark.createDataFrame([], DOCS), labels).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = llm_queries()["op7_quality_mil"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = got.selectExpr("avg(int(predicted = quality)) a", "avg(if(quality = 1, predicted, null)) kept").first()
    assert r["a"] >= 0.97 and r["kept"] >= 0.99
