"""What the evaluation's plan must keep: small generated methods, one row for each gold key."""

import re

import pytest

from conftest import SF0001, rows
from convometrics.operators import evaluate as ev
from convometrics.plans import eval_queries as q

HOTSPOT_LIMIT = 8000  # bytecode; larger methods are not compiled by default


def largest_method(spark, df):
    held = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes
    return max(sizes)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Gold and predictions as files, so that the plan is the evaluation's alone."""
    d = str(tmp_path_factory.mktemp("fx1"))
    q.fx.gold_table(spark, SF0001).write.parquet(f"{d}/gold")
    q.fx.prediction_table(spark, SF0001).write.parquet(f"{d}/pred")
    return d


def frames(spark, d):
    return spark.read.parquet(f"{d}/gold"), spark.read.parquet(f"{d}/pred")


@pytest.mark.parametrize("report", [ev.eval_summary, ev.field_accuracy, ev.strict_failures, ev.runtime_errors, ev.latency_summary])
def test_no_method_too_large_to_be_compiled(spark, written, report):
    gold, pred = frames(spark, written)
    assert largest_method(spark, report(ev.evaluate(gold, pred))) < HOTSPOT_LIMIT


def test_validation_compiles(spark, written):
    _, pred = frames(spark, written)
    assert largest_method(spark, ev.prepare_predictions(pred).select("k", "status", "violations")) < HOTSPOT_LIMIT


def test_total_is_the_number_of_gold_keys(spark, written):
    gold, pred = frames(spark, written)
    n = gold.count()
    for table in (pred, pred.union(pred), pred.limit(0), pred.union(pred.filter("k % 3 = 0")).filter("k % 5 <> 0")):
        s = ev.eval_summary(ev.evaluate(gold, table)).first()
        assert s.total == n and s.valid + s.errors == n
    double = ev.evaluate(gold, pred.union(pred))
    assert {r["error"] for r in rows(double.select("error"))} == {ev.SEVERAL_PREDICTIONS}
    assert {r["latency_ms"] for r in rows(double.select("latency_ms"))} == {None}


def test_failfast_names_a_key_with_several_predictions(spark, written):
    gold, pred = frames(spark, written)
    k = pred.agg({"k": "max"}).first()[0]
    with pytest.raises(ValueError, match=f"2 predictions for k {k}"):
        ev.evaluate(gold, pred.union(pred.filter(f"k = {k}")), duplicates="failfast")
    ev.evaluate(gold, pred, duplicates="failfast")


def test_the_count_uses_the_shuffle_of_the_join(spark, written):
    gold, pred = frames(spark, written)
    held = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ev.evaluate(gold, pred)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
