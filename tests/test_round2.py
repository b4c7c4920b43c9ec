"""Model interface, rewritten lines, narrow plans and the smaller rules."""

import json

import pytest
from pyspark.sql import functions as F

from convometrics.functions.jsontext import canon, parse_strict
from convometrics.operators import audit, evaluate, extract, messages, release, repair
from convometrics.plans import eval_queries
from convometrics.plans.catalog import all_queries
from convometrics.schema import SYSTEM_PROMPT
from convometrics.session import scratch_path

from conftest import SF0001


def test_model_gets_lists_and_falls_back(spark):
    def factory():
        class Model:
            def __call__(self, prompt):
                if prompt == "bad":
                    raise RuntimeError("one")
                return prompt + "!"

            def many(self, prompts):
                if "bad" in prompts:
                    raise RuntimeError("all")
                return [f"{p}*{len(prompts)}" for p in prompts]

        return Model()

    df = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "b", "c", "bad", "d", "e"])], "k long, p string").coalesce(1)
    got = {r["k"]: (r["reply"], r["model_error"]) for r in extract.run_model(df, factory, "k", "p", batch_size=3).collect()}
    assert got == {0: ("a*3", None), 1: ("b*3", None), 2: ("c*3", None), 3: (None, "one"), 4: ("d!", None), 5: ("e!", None)}


def test_a_factory_is_built_once_a_worker(spark):
    def factory(path):
        def make():
            import os
            import uuid

            open(f"{path}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
            return lambda p: p

        return make

    import os
    import tempfile

    d = tempfile.mkdtemp(prefix="built-")
    df = spark.range(400).select("id", F.lit("x").alias("p")).repartition(16)
    assert extract.run_model(df, factory(d), "id", "p").count() == 400
    pids = [f.split("-")[0] for f in os.listdir(d)]
    assert len(pids) == len(set(pids))
    other = extract.run_model(df, lambda: lambda p: "other", "id", "p")
    assert other.filter("reply = 'other'").count() == 400


def test_blank_replies_are_errors_and_retried(spark):
    df = spark.createDataFrame([(1, "p")], "k long, p string")
    r = extract.run_model(df, lambda: lambda p: "  \n", "k", "p", retries=5, sleep=extract.no_sleep, accept=extract.not_blank).first()
    assert (r["attempts"], r["model_error"], r["reply"]) == (5, "Empty transcript returned", None)


def test_rewritten_lines_keep_every_field(spark):
    inner = {"behavioral_analytics": {"z": 1}, "operational_analytics": {}, "diagnostic_reasoning": {"a": "ü"}}
    content = json.dumps(inner, ensure_ascii=False).replace('"', '\\"')
    record = {
        "id": 7, "messages": [
            {"role": "system", "content": "s", "name": "n"}, {"name": "m", "role": "user", "content": "u \"q\"\n", "extra": [1, None, 2.5]},
            {"role": "assistant", "content": content, "weight": 0, "tags": None},
        ], "meta": {"b": True},
    }
    df = spark.createDataFrame([(1, json.dumps(record, ensure_ascii=False))], "line_num long, value string")
    r = repair.normalize_lines(df).first()
    assert r["outcome"] == "rewritten"
    got = json.loads(r["normalized"])
    assert json.loads(got["messages"][2].pop("content")) == inner
    record["messages"][2].pop("content")
    assert got == record and list(got) == list(record) and list(got["messages"][1]) == list(record["messages"][1])


def test_written_lines_read_back(spark):
    df = spark.createDataFrame([(1, "x"), (2, "{}")], "line_num long, value string")
    path = repair.write_normalized(repair.normalize_lines(df))
    assert spark.read.json(f"{path}/dropped").select("reason").count() == 2
    with pytest.raises(Exception, match="already exists"):
        repair.write_normalized(repair.normalize_lines(df), path)


@pytest.mark.parametrize("query", ["eval_summary", "field_accuracy", "strict_failures", "field_matches"])
def test_no_document_crosses_the_join(spark, query):
    plan = all_queries()[query](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    exchanges = [s for s in plan.split("\n") if "Exchange" in s]
    assert exchanges
    # the exchanged columns: keys, flags, canonical values -- no JSON text, variant or struct
    out = evaluate.evaluate(eval_queries.fx.gold_table(spark, SF0001), eval_queries.fx.prediction_table(spark, SF0001))
    assert not {"gold_json", "reply", "body", "payload", "violations", "metrics", "pred_json"} & set(out.columns)
    assert "payload" not in " ".join(s for s in plan.split("\n") if "SortMergeJoin" in s or "Sort [" in s)


def test_building_queries_starts_no_shuffle(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "build-only")
    for name in ("batch_extract", "retry_outcomes", "eval_summary", "grounding_audit"):
        all_queries()[name](spark, SF0001)
    jobs = tracker.getJobIdsForGroup("build-only")
    stages = [tracker.getStageInfo(s) for j in jobs for s in (tracker.getJobInfo(j).stageIds if tracker.getJobInfo(j) else [])]
    spark.sparkContext.setJobGroup("rest", "rest")
    assert len(stages) <= len(jobs)  # footer reads: one stage each


def test_duplicate_predictions_are_found(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert [tuple(r) for r in evaluate.duplicate_keys(df).collect()] == [(1, 2)]


def test_numbers_compare_exactly(spark):
    texts = ["9007199254740993", "9007199254740992", "9007199254740992.0", "4", "4.0", "true", "1", '"4"', "1e3", "1000", "0.1", "123456789012345678901234567890"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", canon(parse_strict(F.col("t"))).alias("c"))
    c = {texts[r["i"]]: r["c"] for r in df.collect()}
    values = {t: json.loads(t) for t in texts}
    for a in texts:
        for b in texts:
            assert (c[a] == c[b]) == (values[a] == values[b] and isinstance(values[a], str) == isinstance(values[b], str)), (a, b, c[a], c[b])


def test_missing_system_prompt_is_no_match(spark):
    df = spark.createDataFrame([(SYSTEM_PROMPT,), (None,), ("x",)], "system_prompt string")
    assert {r["matches_training"]: r["n"] for r in messages.system_prompt_audit(df).collect()} == {True: 1, False: 2}


def test_publish_gate(spark):
    df = spark.createDataFrame([("4111 1111 1111 1111 and 999.999.999.999",), ("4111-1111-1111-1112 at 10.0.0.256",), ("nothing",)], "text string")
    got = {r["kind"]: (r["n_docs"], r["n_matches"], r["passed"]) for r in audit.publish_gate(df).collect()}
    assert got == {"email": (0, 0, True), "ipv4": (0, 0, True), "card_number": (1, 1, False), "secret_token": (0, 0, True)}


def test_artifacts_are_listed(spark):
    path = scratch_path(spark, "release-test")
    release.stage_splits(spark.createDataFrame([(1, "train")], "a int, split string"), path)
    present = release.present_artifacts(spark, path)
    assert {r["artifact"] for r in present.collect()} >= {"train.jsonl"}
    missing = {r["artifact"] for r in release.missing_artifacts(release.required_artifacts(spark), present).filter("repo = 'dataset'").collect()}
    assert missing == {"README.md", "test.jsonl"}


def test_checkpoint_folder_is_demanded_on_a_cluster():
    from convometrics import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_oversized_conversations_are_set_aside(spark):
    turns = spark.createDataFrame([(c, i, "Agent", "t") for c, n in ((1, 3), (2, 9)) for i in range(n)], "conv_id long, turn int, speaker string, text string")
    kept, aside = messages.oversized_turns(turns, 5)
    assert [r["conv_id"] for r in messages.assemble_transcripts(kept).collect()] == [1]
    assert [tuple(r) for r in aside.collect()] == [(2, 9, "too_many_turns")]
