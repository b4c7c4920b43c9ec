import json
import os
import tempfile

import pytest

from convometrics.operators import report as rep
from convometrics.plans.evaluation_run import run_evaluation
from convometrics.schema import SCORED_FIELDS
from convometrics.sources.fixture_models import case_key_factory, record_for_key

SYSTEM = "You are a SOTA Logistics AI. Extract the exact logistics and CX metrics from the following transcript."


def line(k, gold=None):
    gold = json.dumps(record_for_key(k, [], "r")) if gold is None else gold
    messages = [
        {"role": "system", "content": SYSTEM},
        {"role": "user", "content": f"Agent: hi\nCustomer: case {k} please"},
        {"role": "assistant", "content": gold},
    ]
    return json.dumps({"messages": messages})


def write(files):
    d = tempfile.mkdtemp(prefix="evalrun-")
    for name, lines in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    return d


def complete_report(spark, run):
    parts = sorted(p for p in os.listdir(run.report_path) if p.startswith("part-"))
    return "".join(open(os.path.join(run.report_path, p)).read() for p in parts)


def test_end_to_end_report(spark):
    lines = [line(1), line(2), "", line(3), line(4), line(5)]  # the blank line is skipped, still counted
    run = run_evaluation(spark, write({"eval.jsonl": lines}), case_key_factory)
    s = run.summary
    assert (s["total"], s["valid"], s["errors"]) == (5, 4, 1)
    assert s["per_field_accuracy"]["customer_intent"] == 0.75
    assert "**Total examples:** 5" in run.report
    text = complete_report(spark, run)
    assert "- **Line 2**: missed customer_intent\n" in text
    assert "- Line 4: model crashed\n" in text  # line 4 because of the blank line
    assert text.index("## Failures (strict)") < text.index("- **Line 2**") < text.index("## Runtime errors") < text.index("- Line 4")
    out = spark.read.json(run.outputs_path)
    assert out.count() == 5 and {"pred", "gold", "file_path"} <= set(out.columns)
    results = spark.read.parquet(run.results_path)
    assert results.filter("match.strict").count() == 3 and results.filter("gold IS NOT NULL").count() == 5


def test_line_numbers_that_repeat_over_files(spark):
    d = write({"a.jsonl": [line(k) for k in (1, 2, 4, 5, 6)], "b.jsonl": [line(k) for k in (7, 8, 2, 9, 10)]})
    run = run_evaluation(spark, d, case_key_factory)
    assert (run.summary["total"], run.summary["valid"], run.summary["strict_correct"]) == (10, 10, 8)
    failures = {(os.path.basename(r["file_path"]), r["line_num"]) for r in spark.read.parquet(run.failures_path).collect()}
    assert failures == {("a.jsonl", 2), ("b.jsonl", 3)}


def test_fail_fast_on_bad_lines_and_bad_gold(spark):
    with pytest.raises(ValueError, match="line 2: invalid_json"):
        run_evaluation(spark, write({"e.jsonl": [line(1), "{broken"]}), case_key_factory)
    bad_gold = write({"e.jsonl": [line(1), line(2, "not json")]})
    with pytest.raises(ValueError, match="line 2: gold payload is not valid JSON"):
        run_evaluation(spark, bad_gold, case_key_factory)
    run = run_evaluation(spark, bad_gold, case_key_factory, mode="quarantine")
    assert (run.summary["total"], run.summary["errors"]) == (2, 1)
    with pytest.raises(ValueError, match="No valid rows"):
        run_evaluation(spark, write({"e.jsonl": [""]}), case_key_factory)


def test_report_head_wording():
    counts = {"total": 3, "valid": 2, "strict_correct": 1, "latency_ms_total": 6000, "latency_ms_min": 1000, "latency_ms_max": 3000}
    summary = rep.summary_of(counts | {f: 2 for f in SCORED_FIELDS})
    lines = rep.head_lines("eval.jsonl", summary)
    assert lines[:6] == [
        "# Evaluation Report", "", "**Eval file:** `eval.jsonl`  ", "**Total examples:** 3  ", "**Valid (no runtime error):** 2  ", "**Errors:** 1  ",
    ]
    assert lines[6:15] == [
        "", "## Summary", "", "| Metric | Value |", "|--------|--------|",
        "| Strict accuracy (all key fields match) | 50.0% (1/2) |", "| Latency (mean) | 2.00s |",
        "| Latency (min / max) | 1.00s / 3.00s |", "| Latency (total) | 6.00s |",
    ]
    assert lines[15:20] == ["", "## Per-field accuracy", "", "| Field | Correct | Accuracy |", "|-------|---------|----------|"]
    assert lines[20] == "| customer_intent | 2/2 | 100.0% |" and lines[-2:] == ["", "## Failures (strict)"]
