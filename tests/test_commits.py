"""What may run again: appended batches, versions, model jobs, streams, and transcripts of any length."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, rows
from convometrics.operators import extract as ex
from convometrics.operators import messages as msg
from convometrics.operators import repair as rp
from convometrics.plans.evaluation_run import run_evaluation
from convometrics.sources import chatml
from convometrics.sources import fixture_models as fm
from convometrics.sources.commits import BatchStore, CommitLog, Versions
from convometrics.streaming import requests as rq


def test_commit_log(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.read() == []
    assert [log.append({"a": i, "t": "é"}) for i in range(12)] == list(range(1, 13))
    assert [(c["commit"], c["a"], c["t"]) for c in log.read()] == [(i + 1, i, "é") for i in range(12)]
    with pytest.raises(RuntimeError, match="commit 12"):
        log.append({}, after=11)
    assert len(log.read()) == 12 and len(CommitLog(spark, str(tmp_path / "log")).read()) == 12


def test_a_batch_counts_once(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "rows"))
    assert store.read() is None and store.read("id long").count() == 0
    assert store.write(spark.range(3), "one") and store.write(spark.range(10, 12), "two")
    assert not store.write(spark.range(3), "one") and not store.write(spark.range(99), "two")
    spark.range(1000).write.parquet(f"{store.path}/data/died")
    assert sorted(r["id"] for r in rows(store.read())) == [0, 1, 2, 10, 11]


def test_two_writers_of_one_batch(spark, tmp_path, monkeypatch):
    store = BatchStore(spark, str(tmp_path / "rows"))
    once = CommitLog.append
    state = {"late": False}

    def append(self, record, after=None):
        if not state["late"]:
            state["late"] = True
            once(self, {"batch": "b", "dir": "data/other", "schema": spark.range(1).schema.json()})  # another was first
        return once(self, record, after)

    spark.range(2).write.parquet(f"{store.path}/data/other")
    monkeypatch.setattr(CommitLog, "append", append)
    assert not store.write(spark.range(2), "b")
    assert store.read().count() == 2


def test_appended_lines(spark, tmp_path):
    df = spark.createDataFrame([([("user", "é"), ("assistant", "b")],)], "messages array<struct<role:string,content:string>>")
    assert chatml.append_jsonl(df, str(tmp_path / "x"), "b1") and not chatml.append_jsonl(df, str(tmp_path / "x"), "b1")
    assert chatml.append_jsonl(df, str(tmp_path / "x"), "b2")
    assert chatml.read_appended(spark, str(tmp_path / "x")).count() == 2


def test_versions(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "corpus"))
    assert versions.current() is None
    lines = lambda *v: spark.createDataFrame([(x,) for x in v], "line string")
    read = lambda: sorted(r["value"] for r in rows(spark.read.text(f"{versions.current()}/lines")))
    rp.publish_lines(lines("a", "b"), "line", versions)
    assert read() == ["a", "b"]
    with pytest.raises(ValueError, match="there is no version"):
        versions.rollback()
    rp.publish_lines(lines("c"), "line", versions)
    assert read() == ["c"]

    def dies(path):
        lines("d").write.text(f"{path}/lines")
        raise OSError("lost")

    with pytest.raises(OSError):
        versions.publish(dies, lambda path: 1, 1)  # between write and switch
    assert read() == ["c"]
    with pytest.raises(ValueError, match="2 were to be written"):
        versions.publish(lambda path: lines("e").write.text(f"{path}/lines"), lambda path: spark.read.text(f"{path}/lines").count(), 2)
    assert read() == ["c"]
    versions.rollback()
    assert read() == ["a", "b"]
    rp.publish_lines(lines("f"), "line", versions)
    assert read() == ["f"]
    versions.rollback()
    assert read() == ["a", "b"]


def counting(path):
    """A factory whose models note every prompt in a file of ``path``."""

    def factory():
        inner = fm.extractor_factory()

        def model(prompt):
            with open(os.path.join(path, str(os.getpid())), "a") as f:
                f.write(json.dumps(prompt) + "\n")
            return inner(prompt)

        return model

    return factory


def calls(path):
    return sorted(json.loads(line) for f in os.listdir(path) for line in open(os.path.join(path, f)))


def dying(monkeypatch, after):
    """Commits of the model's outputs fail after so many, before the rows are made."""
    once, state = BatchStore.write, {"n": 0}

    def write(self, df, batch, **note):
        if "model_outputs" in self.path or "replies" in self.path:
            state["n"] += 1
            if state["n"] > after:
                raise OSError("the job dies here")
        return once(self, df, batch, **note)

    monkeypatch.setattr(BatchStore, "write", write)


def test_a_model_job_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    noted = tmp_path / "calls"
    noted.mkdir()
    lines = "\n".join(
        json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": f"Agent: {i}"}, {"role": "assistant", "content": "{}"}]})
        for i in range(40)
    )
    (tmp_path / "eval.jsonl").write_text(lines + "\n")
    run = lambda out: run_evaluation(spark, str(tmp_path / "eval.jsonl"), counting(str(noted)), str(tmp_path / out), chunks=4)
    with monkeypatch.context() as m:
        dying(m, 2)
        with pytest.raises(OSError):
            run("run")
    half = calls(noted)
    assert 0 < len(half) < 40
    again = run("run")
    assert len(calls(noted)) == 40 and len(set(calls(noted))) == 40  # each call once
    assert again.summary["total"] == 40
    same = run("run")
    assert len(calls(noted)) == 40 and same.report == again.report
    clean = run("other")
    cut = lambda s: {k: v for k, v in s.items() if "latency" not in k}
    assert cut(clean.summary) == cut(again.summary)


def test_a_changed_prompt_is_asked_anew(spark, tmp_path):
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, prompt string")
    call = lambda todo: todo.select("k", "_asked", F.upper("prompt").alias("reply"))
    once = lambda df: {r["k"]: r["reply"] for r in rows(ex.run_once(df, ["k"], ["prompt"], str(tmp_path / "o"), call, 2))}
    assert once(asked) == {1: "A", 2: "B", None: "C"}
    assert once(asked.withColumn("prompt", F.when(F.col("k") == 2, "z").otherwise(F.col("prompt")))) == {1: "A", 2: "Z", None: "C"}
    assert BatchStore(spark, str(tmp_path / "o")).read().count() == 4


def test_a_stream_stopped_in_a_batch(spark, tmp_path, monkeypatch):
    noted = tmp_path / "calls"
    noted.mkdir()
    bodies = [(i, json.dumps({"transcript": f"Agent: {i}"})) for i in range(30)] + [(100 + i, "{}") for i in range(5)]
    spark.createDataFrame(bodies, rq.REQUEST_SCHEMA).write.json(str(tmp_path / "in"))
    run = lambda: rq.run_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt"), counting(str(noted)), chunks=5)
    with monkeypatch.context() as m:
        dying(m, 2)
        with pytest.raises(Exception, match="the job dies here"):
            run()
    assert 0 < len(calls(noted)) < 30
    run()
    assert len(calls(noted)) == 30 and len(set(calls(noted))) == 30
    sinks = rq.Sinks(spark, str(tmp_path / "out"))
    answers, dead = rows(sinks.answers.read()), rows(sinks.dead_letters.read())
    assert sorted(r["request_id"] for r in answers) == list(range(30)) and {r["http_status"] for r in answers} <= {200, 500}
    assert sorted(r["request_id"] for r in dead) == list(range(100, 105)) and {r["http_status"] for r in dead} == {400}
    run()
    assert sinks.answers.read().count() == 30 and sinks.dead_letters.read().count() == 5


def test_pieces_of_long_conversations(spark):
    turns = [(1, t, "Agent" if t % 2 else "Customer", f"turn {t} " + "x" * (t * 37 % 90)) for t in range(3000)]  # a third of all rows and more
    turns += [(k, t, "Agent", f"{k} {t}") for k in range(2, 500) for t in range(3)]
    turns += [(500, 0, "Agent", "y" * 5000), (500, 1, "Customer", "z")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, speaker string, text string")
    whole = {r["conv_id"]: r["transcript"] for r in rows(msg.assemble_transcripts(df))}
    pieces = {}
    for r in sorted(rows(msg.assemble_pieces(df, piece_chars=1000)), key=lambda r: r["piece"]):
        pieces.setdefault(r["conv_id"], []).append(r)
        assert r["n_turns"] == 1 or len(r["transcript"]) < 1000 + 110
    assert {k: "\n".join(p["transcript"] for p in v) for k, v in pieces.items()} == whole
    assert len(pieces[1]) > 100 and [p["piece"] for p in pieces[500]] == [0, 5] and len(pieces[2]) == 1
    plan = msg.assemble_pieces(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_dead_letters_are_not_among_the_answers(spark):
    from convometrics.plans import ops_queries as oq

    sinks = oq._stream(spark, SF0001, None)
    assert {r["http_status"] for r in rows(sinks.answers.read())} == {200}
    assert {r["http_status"] for r in rows(sinks.dead_letters.read())} == {400}
