"""Round 3: one evaluation of a line, a reply and a written corpus."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F

from convometrics.functions.jsontext import json_valid, parse_strict
from convometrics.operators import payload as pl
from convometrics.operators import repair as rp
from convometrics.plans import eval_queries as eq
from convometrics.plans.ops_queries import OUTPUT_SCHEMA, write_eval_outputs


def test_repair_line_searches_a_line_a_few_times(spark):
    lines = spark.createDataFrame([(1, 'x')], "line_num long, value string")
    plan = rp.repair_lines(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("locate(") <= 6 and plan.count("reverse(") == 1


def test_write_repaired_evaluates_the_lines_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def note(value):
        seen.add(1)
        return value

    good = '{"messages":[{"role":"user","content":"a "b" c"},{"role":"assistant","content":"{"x":1}"}]}'
    rows = [Row(line_num=1, value=good), Row(line_num=2, value="no line")]
    noted = spark.createDataFrame(rows).withColumn("value", F.udf(note).asNondeterministic()("value"))
    out = rp.write_repaired(rp.repair_lines(noted), str(tmp_path / "out"))
    assert seen.value == 2
    assert [r.value for r in spark.read.text(f"{out}/lines").collect()] == [good.replace('a "b" c', r"a \"b\" c").replace('{"x":1}', r"{\"x\":1}")]
    assert [r.line_num for r in spark.read.json(f"{out}/dropped").collect()] == [2]


def test_outputs_are_compressed_and_read_back(spark, tmp_path):
    rows = [(1, '{"a":"x"}', '{"a":"y"}', 1500, True, None), (2, None, None, None, None, "no reply")]
    scored = spark.createDataFrame(rows, "line_num long, pred_json string, gold_json string, latency_ms long, strict boolean, error string")
    write_eval_outputs(scored, str(tmp_path / "out"), ["line_num"])
    parts = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.endswith(".json.gz") for p in parts)
    back = spark.read.schema(OUTPUT_SCHEMA).json(str(tmp_path / "out")).orderBy("line_num").collect()
    assert [tuple(r) for r in back] == [(1, '{"a":"x"}', '{"a":"y"}', 1.5, True, None), (2, None, None, None, None, "no reply")]


def test_pair_with_gaps_builds_replies_once(spark, tmp_path):
    rows = [(k, "F") for k in [1, 29, 31, 41, 62, 62, None]]
    spark.createDataFrame(rows, "o_orderkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    out = eq.q_pair_with_gaps(spark, str(tmp_path))
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    errors = {(r.k, r.error) for r in out.collect()}
    several, none = eq.ev.SEVERAL_PREDICTIONS, eq.ev.NO_PREDICTION
    assert {(31, several), (62, several), (29, none), (41, eq.ev.BAD_GOLD), (None, none), (1, None)} == errors


def test_strict_json_is_one_pass_and_whole(spark):
    texts = ['{"a":[1]}', ' "x" ', "1", "null", "", " ", "1]", '1,"x"', '1,"x"]', '{"a":1}] }', "[1", '"x', "1,", ",", '1},{"b":2', "{'a':1}", "1 2", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    plan = df.select(parse_strict(F.col("t")).isNotNull().alias("v"))._jdf.queryExecution().analyzed().toString()
    assert '{"x":' not in plan
    got = df.select("i", json_valid(F.col("t")).alias("ok"), parse_strict(F.col("t")).isNotNull().alias("v")).orderBy("i").collect()
    assert [r.ok for r in got] == [r.v for r in got] == [True] * 4 + [False] * (len(texts) - 4)


def test_shapes_of_odd_groups(spark):
    groups = ["behavioral_analytics", "operational_analytics", "diagnostic_reasoning"]
    texts = ["{}", "5", "null", '{"behavioral_analytics":null,"operational_analytics":5,"diagnostic_reasoning":{"intent_reasoning":null}}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = pl.validate(df.withColumn("payload", parse_strict(F.col("t"))))
    assert "transform(" not in pl.explode_payload(df.withColumn("payload", parse_strict(F.col("t"))), typed=False)._jdf.queryExecution().analyzed().toString()
    got = [list(r.violations) for r in out.orderBy("i").collect()]
    assert got[0] == [g + ":required" for g in groups]
    assert got[1] == got[2] == ["root:type"]
    assert got[3][:2] == ["behavioral_analytics:type", "operational_analytics:type"]
    assert "diagnostic_reasoning.intent_reasoning:type" in got[3] and "diagnostic_reasoning.effort_reasoning:required" in got[3]
